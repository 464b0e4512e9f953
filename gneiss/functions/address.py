"""Street addresses, boroughs, ZIP codes and lot numbers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gneiss.functions.convert import blank_to_null, let, squeezed, trimmed
from gneiss.functions.fixed import BOROUGHS, DIRECTIONS, STREET_SUFFIXES, UNIT_LABELS


def spelled(groups: dict[str, list[str]]) -> dict[str, str]:
    """Every spelling, the name itself among them, to its name."""
    return {s: name for name, others in groups.items() for s in [name, *others]}


def lookup(table: dict[str, str], key: Column) -> Column:
    """The table's value; null where the key is null or unknown."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


_BOROUGHS, _SUFFIXES = spelled(BOROUGHS), spelled(STREET_SUFFIXES)


def borough(c: Column) -> Column:
    return lookup(_BOROUGHS, squeezed(F.upper(c)))


def zip_code(c: Column) -> Column:
    """The five digits of a ZIP or ZIP+4; 00000 is none."""
    five = F.regexp_extract(c, r"^\s*([0-9]{5})(?:-[0-9]{4})?\s*$", 1)
    return F.when(~five.isin("", "00000"), five)


def lot(c: Column) -> Column:
    """A ten-digit lot number, decimals cut off: borough 1 to 5, and not zeros alone after it."""
    ten = F.substring_index(trimmed(c.cast("string")), ".", 1)
    return F.when(ten.rlike("^[1-5][0-9]{9}$") & ~ten.endswith("0" * 9), ten)


def lot_from_parts(borough_text: Column, block: Column, lot_no: Column) -> Column:
    """Borough code, block in five digits and lot in four; null unless all are there and positive."""
    code = lookup({name: others[0] for name, others in BOROUGHS.items()}, borough(borough_text))
    b, n = (trimmed(x.cast("string")).try_cast("int") for x in (block, lot_no))
    return F.when((b > 0) & (n > 0) & code.isNotNull(), F.concat(code, F.format_string("%05d", b), F.format_string("%04d", n)))


def cleaned(c: Column) -> Column:
    """Upper case, punctuation to spaces, # a word of its own."""
    return squeezed(F.replace(F.regexp_replace(F.upper(c), r"""[.,;:'"()]""", " "), F.lit("#"), F.lit(" # ")))


def _words(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def _at_unit(words: Column) -> Column:
    """The 1-based place of the first unit label; 0 without one."""
    hits = F.transform(words, lambda w, i: F.when(w.isin(UNIT_LABELS), i + 1))
    return F.coalesce(F.array_min(hits), F.lit(0))


def split_unit(words: Column) -> Column:
    """struct(street words, unit): what follows the first unit label is the unit."""
    def cut(w: Column, at: Column) -> Column:
        unit = F.when(at > 0, F.nullif(F.array_join(F.slice(w, at + 1, F.greatest(F.size(w) - at, F.lit(0))), " "), F.lit("")))
        return F.struct(F.when(at > 0, F.slice(w, 1, at - 1)).otherwise(w).alias("words"), unit.alias("unit"))

    return let(words, lambda w: let(_at_unit(w), lambda at: cut(w, at)))


def street(words: Column) -> Column:
    """struct(name, suffix): ordinals bare, a leading direction spelled out, a trailing suffix apart."""
    def spell(w: Column, i: Column, several: Column) -> Column:
        bare = F.regexp_replace(w, r"\b([0-9]+)(?:ST|ND|RD|TH)\b", "$1")
        return F.when((i == 0) & several, F.coalesce(lookup(DIRECTIONS, bare), bare)).otherwise(bare)

    def part(full: Column, suffix: Column) -> Column:
        name = F.when(suffix.isNotNull(), F.slice(full, 1, F.greatest(F.size(full) - 1, F.lit(0)))).otherwise(full)
        return F.struct(F.nullif(F.array_join(name, " "), F.lit("")).alias("name"), suffix.alias("suffix"))

    full = let(words, lambda ws: F.transform(ws, lambda w, i: spell(w, i, F.size(ws) > 1)))
    return let(full, lambda f: let(F.when(F.size(f) > 1, lookup(_SUFFIXES, F.try_element_at(f, F.lit(-1)))), lambda s: part(f, s)))


def _address(house: Column, street_: Column, unit: Column, borough_: Column, zip_: Column) -> Column:
    def whole(x: Column) -> Column:
        return F.when(x["s"]["name"].isNotNull(), F.concat_ws(" ", x["house"], x["s"]["name"], x["s"]["suffix"]))

    def fields(x: Column, address: Column) -> Column:
        unit_address = F.when(address.isNotNull(), F.concat_ws(" UNIT ", address, x["unit"]))
        return F.struct(
            x["house"].alias("house_number"), x["s"]["name"].alias("street_name"), x["s"]["suffix"].alias("street_suffix"), x["unit"].alias("unit"), x["borough"].alias("borough"),
            x["zip"].alias("zipcode"), address.alias("normalized_address"), unit_address.alias("unit_address"),
        )

    parts = F.struct(house.alias("house"), street_.alias("s"), unit.alias("unit"), borough_.alias("borough"), zip_.alias("zip"))
    return let(parts, lambda x: let(whole(x), lambda a: fields(x, a)))


_HOUSE = r"^([0-9]+[A-Z]?(?:-[0-9]+[A-Z]?)?) (.*)$"


def from_parts(house_number: Column, street_text: Column, borough_text: Column | None = None, zip_text: Column | None = None, unit: Column | None = None) -> Column:
    """An address struct from fields that are apart. A unit inside the street text is dropped."""
    none = F.lit(None).cast("string")
    s = street(split_unit(_words(cleaned(F.coalesce(street_text, F.lit("")))))["words"])
    return _address(F.upper(blank_to_null(house_number)), s, F.upper(blank_to_null(none if unit is None else unit)), borough(none if borough_text is None else borough_text), zip_code(none if zip_text is None else zip_text))


def from_free_text(text: Column, borough_text: Column | None = None, zip_text: Column | None = None) -> Column:
    """An address struct from one text: a leading house number, the street, and a labelled unit.

    Borough and ZIP come from their own fields. Shapes that only a trained
    address tagger could part are read by these rules too.
    """
    none = F.lit(None).cast("string")
    borough_, zip_ = borough(none if borough_text is None else borough_text), zip_code(none if zip_text is None else zip_text)

    def read(clean: Column, house: Column) -> Column:
        rest = F.when(house.isNotNull(), F.regexp_extract(clean, _HOUSE, 2)).otherwise(clean)
        return let(split_unit(_words(rest)), lambda p: _address(house, street(p["words"]), blank_to_null(F.replace(p["unit"], F.lit("#"), F.lit(""))), borough_, zip_))

    clean = cleaned(F.coalesce(text, F.lit("")))
    return let(clean, lambda c: let(F.nullif(F.regexp_extract(c, _HOUSE, 1), F.lit("")), lambda house: read(c, house)))
