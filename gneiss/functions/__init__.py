"""Part of gneiss; see the README for the layout."""
