"""Names of people and organisations, and phone numbers, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gneiss.functions.address import lookup, spelled
from gneiss.functions.convert import let, squeezed, trimmed
from gneiss.functions.fixed import NAME_WORDS, NULL_NAMES, ORG_MARKERS

_WORDS = spelled(NAME_WORDS)


def bare(c: Column) -> Column:
    """Upper case without punctuation, single spaces."""
    return squeezed(F.regexp_replace(F.upper(c), r"""[.,;:'"/\\()&#!?*]""", " "))


def name(c: Column) -> Column:
    """The comparable form: no punctuation, known words in one spelling; null for placeholders and one or two characters."""
    def spell(text: Column) -> Column:
        words = F.array_join(F.transform(F.split(text, " "), lambda w: F.coalesce(lookup(_WORDS, w), w)), " ")
        words = F.regexp_replace(F.regexp_replace(words, r"\bL L C\b", "LLC"), r"\bL P\b", "LP")
        return F.when(~(text.isin([*NULL_NAMES, "N A"]) | (F.length(text) <= 2)), words)

    return F.when(~F.upper(trimmed(c)).isin(NULL_NAMES), let(bare(c), spell))


def person(first: Column, last: Column, middle: Column | None = None) -> Column:
    """First, middle and last name; a middle initial may be one letter."""
    parts = [name(first), name(last)]
    if middle is not None:
        m = bare(middle)
        parts.insert(1, F.when(~m.isin([*NULL_NAMES, "N A"]), m))
    return F.nullif(F.concat_ws(" ", *parts), F.lit(""))


def is_organisation(c: Column) -> Column:
    """A marker word or a digit in the comparable form; false for null."""
    markers = F.array(*[F.lit(m) for m in ORG_MARKERS])
    return F.coalesce(let(name(c), lambda n: F.arrays_overlap(F.split(n, " "), markers) | n.rlike("[0-9]")), F.lit(False))


def last_first(c: Column) -> Column:
    """'LAST, FIRST' in reading order, parted at the first comma, unless it is an organisation."""
    parts = F.split(c, ",", 2)
    turned = F.concat_ws(" ", trimmed(F.try_element_at(parts, F.lit(2))), trimmed(parts[0]))
    return F.when(F.contains(c, F.lit(",")) & ~is_organisation(c), name(turned)).otherwise(name(c))


def phone(c: Column) -> Column:
    """Ten digits, a leading 1 of eleven dropped; zeros alone are none."""
    digits = F.regexp_replace(F.regexp_replace(c, "[^0-9]", ""), "^1([0-9]{10})$", "$1")
    return F.when(digits.rlike("^[0-9]{10}$") & (digits != "0" * 10), digits)


def mailing_key(address: Column, city: Column, state: Column, zip_: Column) -> Column:
    """One text for a mailing address with a ZIP or city; missing parts print as None."""
    parts = [F.coalesce(x, F.lit("None")) for x in (address, city, state, zip_)]
    return F.when(address.isNotNull() & (zip_.isNotNull() | city.isNotNull()), F.concat_ws("|", *parts))


def entity_id(prefix: str, *parts: Column) -> Column:
    """A stable id: the first ten hex digits of a SHA-1 of the parts, joined by bars."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])), 1, 10))


def truth(c: Column) -> Column:
    """True or False as ids spell them."""
    return F.when(c, "True").otherwise("False")
