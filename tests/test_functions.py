"""Converters, addresses, names and similarities on golden values."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gneiss.functions import address, convert, names, similarity


def one(spark, make, *values):
    """make(columns) on a single row of texts."""
    cols = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([values], ", ".join(f"{c} string" for c in cols))
    return df.select(make(*[F.col(c) for c in cols])).head()[0]


@pytest.mark.parametrize(("raw", "whole", "unit"), [
    ("123 W. 42nd St Apt 4B", "123 WEST 42 STREET", "4B"),
    ("123 WEST 42 STREET #4B", "123 WEST 42 STREET", "4B"),
    ("761 Clarence Ave.", "761 CLARENCE AVENUE", None),
    ("20 CLINTON ST", "20 CLINTON STREET", None),
    ("78-15 PARSONS BLVD", "78-15 PARSONS BOULEVARD", None),
    ("100 E 42ND ST", "100 EAST 42 STREET", None),
    ("305 GRAND CONCOURSE", "305 GRAND CONCOURSE", None),
    ("350 5TH AVE STE 4100", "350 5 AVENUE", "4100"),
    ("1 CENTRE ST FL", "1 CENTRE STREET", None),
    ("   ", None, None),
    (None, None, None),
])
def test_free_addresses(spark, raw, whole, unit):
    a = one(spark, address.from_free_text, raw)
    assert (a.normalized_address, a.unit) == (whole, unit)
    assert a.unit_address == (f"{whole} UNIT {unit}" if unit else whole)


def test_address_parts(spark):
    a = one(spark, address.from_parts, "60", "BAY 34 ST", "kings", "11214-0001")
    assert (a.normalized_address, a.borough, a.zipcode, a.street_name, a.street_suffix) == ("60 BAY 34 STREET", "BROOKLYN", "11214", "BAY 34", "STREET")
    # an AVENUE W keeps its letter; a direction alone is a name
    assert one(spark, address.from_parts, None, "AVENUE W").normalized_address == "AVENUE W"
    assert one(spark, address.from_parts, None, "N").normalized_address == "N"


def test_codes(spark):
    assert [one(spark, address.zip_code, x) for x in ("11226-3402", "1122", "00000", None)] == ["11226", None, None, None]
    assert [one(spark, address.lot, x) for x in ("2054800111.00000000", "6054800111", "1000000000", " 4051980021 ", None)] == ["2054800111", None, None, "4051980021", None]
    assert [one(spark, address.lot_from_parts, *x) for x in (("QUEENS", "5198", "21"), ("BROOKLYN", "06861", "00067"), ("QUEENS", "0", "21"), ("?", "1", "1"), ("3", "x", "1"))] == ["4051980021", "3068610067", None, None, None]
    assert [one(spark, address.borough, x) for x in ("the  bronx", "5", "Qns", "NOWHERE", None)] == ["BRONX", "STATEN ISLAND", "QUEENS", None, None]


def test_names(spark):
    want = {"ACME PROPERTY LLC": "ACME PROPERTIES LLC", "Acme Properties, L.L.C.": "ACME PROPERTIES LLC", "HENRYSMITH PROPERTY MGMT": "HENRYSMITH PROPERTIES MANAGEMENT", "N/A": None, "PR": None, "": None, "X L P": "X LP", None: None}
    assert {k: one(spark, names.name, k) for k in want} == want
    assert one(spark, names.last_first, "RODRIGUEZ, JOSE R") == "JOSE R RODRIGUEZ"
    assert one(spark, names.last_first, "SMITH, A, B") == "A B SMITH"
    assert one(spark, names.last_first, "BAKER, INC") == "BAKER INC"
    assert one(spark, lambda a, b, c: names.person(a, b, c), "JOSE", "DIAZ", "r.") == "JOSE R DIAZ"
    assert [one(spark, names.is_organisation, x) for x in ("JOHN DOE", "DOE TRUST", "123 MAIN", None)] == [False, True, True, False]
    assert [one(spark, names.phone, x) for x in ("(718) 237-1166", "1-718-237-1166", "123", "0000000000")] == ["7182371166", "7182371166", None, None]
    assert one(spark, names.mailing_key, "1 A STREET", None, None, "10001") == "1 A STREET|None|None|10001"
    assert one(spark, names.mailing_key, "1 A STREET", None, "NY", None) is None


def test_converters(spark):
    assert [one(spark, convert.number, x) for x in ("$1,000", "nan", " ", "abc", "-2.5")] == [1000.0, None, None, None, -2.5]
    assert [one(spark, convert.integer, x) for x in ("7.9", "-7.9", "inf")] == [7, -7, None]
    assert one(spark, convert.local_timestamp, "2026-01-05T11:01:32-05:00") == datetime(2026, 1, 5, 11, 1, 32)
    assert one(spark, convert.utc_timestamp, "2026-01-05T11:01:32-05:00") == datetime(2026, 1, 5, 16, 1, 32)
    assert one(spark, convert.utc_timestamp, "2026-06-01T12:30:00.000Z") == datetime(2026, 6, 1, 12, 30)
    assert one(spark, convert.local_timestamp, "garbage") is None
    assert one(spark, lambda a, b: convert.coordinates(a, b)[0], "40.7", "-74.0") == 40.7
    assert one(spark, lambda a, b: convert.coordinates(a, b)[0], "40.7", "-70.0") is None
    assert one(spark, convert.payload_fields, '{":id": "1", "a": "x"}') == {"a": "x"}


def test_ratios():
    assert similarity.ratio("", "") == 1.0
    assert similarity.ratio("abc", "") == 0.0
    assert similarity.lcs("abcbdab", "bdcaba") == 4
    assert similarity.sorted_ratio("B A", "A B") == 1.0
    assert similarity.set_ratio("A B", "A B C") == 1.0
    assert similarity.set_ratio("", "A") == 0.0
    assert similarity.set_ratio("A X", "A Y") == pytest.approx(max(similarity.ratio("A X", "A Y"), similarity.ratio("A", "A X")))


def test_name_rules(spark):
    pairs = [("PARKASH 2165 LLC", "PARKASH 2454 LLC", True), ("207 SHERMAN ASSOCIATES", "207 SHERMAN ASSOCIATES LLC", True), ("T F CORNERSTONE", "TF CORNERSTONE", True), ("JOSE DIAZ", "JOSE R DIAZ", False), ("ANGEL", "ANGEL CHU", False), ("THE MOINIAN GROUP", "MOINIAN GROUP", True)]
    df = spark.createDataFrame(pairs, "a string, b string, o boolean")
    got = {(r.a, r.b): r.s for r in df.select("a", "b", similarity.name_similarity(F.col("a"), F.col("b"), F.col("o")).alias("s")).collect()}
    assert got[pairs[0][:2]] <= 0.89
    assert all(got[p[:2]] >= 0.96 for p in (pairs[1], pairs[2], pairs[3], pairs[5]))
    assert got[pairs[4][:2]] < 0.85
