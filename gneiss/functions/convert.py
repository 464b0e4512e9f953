"""Converters of raw text fields. Garbage becomes null; nothing raises under ANSI mode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value evaluated once however often the body names it."""
    return F.transform(F.array(value), body)[0]


_OFFSET = r"(?i)(Z|[+-]\d{2}:?\d{2})$"


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(trimmed(c), F.lit(""))


def squeezed(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def number(c: Column) -> Column:
    """A double, thousands commas and $ taken out; NaN and infinities count as garbage."""
    n = F.nullif(F.regexp_replace(trimmed(c), "[,$]", ""), F.lit("")).try_cast("double")
    return F.when(~F.isnan(n) & (F.abs(n) < float("inf")), n)


def integer(c: Column) -> Column:
    """A long, cut towards zero."""
    return number(c).try_cast("long")


def local_timestamp(c: Column) -> Column:
    """ISO text as a timestamp without zone; an offset is dropped, not applied."""
    return F.regexp_replace(trimmed(c), _OFFSET, "").try_cast("timestamp_ntz")


def utc_timestamp(c: Column) -> Column:
    """ISO text as a timestamp without zone in UTC; an offset is applied. Wants a session in UTC."""
    return F.coalesce(F.when(trimmed(c).rlike(_OFFSET), F.to_utc_timestamp(trimmed(c).try_cast("timestamp"), "UTC").try_cast("timestamp_ntz")), trimmed(c).try_cast("timestamp_ntz"))


def coordinates(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Both or neither: inside the city's box, else null."""
    y, x = number(lat), number(lon)
    inside = y.between(40.4, 41.0) & x.between(-74.3, -73.6)
    return F.when(inside, y), F.when(inside, x)


def payload_fields(payload: Column) -> Column:
    """A JSON object as a map without the system's keys, which begin with a colon."""
    return F.map_filter(F.from_json(payload, "map<string,string>"), lambda k, _: ~k.startswith(":"))
