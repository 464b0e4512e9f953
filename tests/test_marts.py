"""Marts and questions against values worked out by hand."""

from __future__ import annotations

from datetime import datetime

import pytest

from gneiss.plans import marts

AS_OF = datetime(2026, 7, 1)


def test_status_is_three_valued(spark):
    clean = spark.createDataFrame(
        [("a", "Closed", "GAS", datetime(2026, 6, 1), datetime(2026, 6, 4)), ("b", "Open", "GAS", datetime(2026, 6, 21), None), ("c", None, "NOISE", datetime(2026, 6, 21), None)],
        "complaint_id string, status string, complaint_type string, created_date timestamp_ntz, closed_date timestamp_ntz",
    ).selectExpr("*", "complaint_id as source_record_id")
    links = spark.createDataFrame([(x, "P1") for x in "abc"], "source_record_id string, property_id string")
    stg = marts.stg_complaints(clean, links, AS_OF)
    assert {r.complaint_id: (r.is_closed, r.days_open) for r in stg.collect()} == {"a": (True, 3), "b": (False, 10), "c": (None, 10)}
    r = marts.property_complaints(stg, AS_OF).head()
    # a complaint without a status is neither open nor closed
    assert (r.complaints_total, r.complaints_open, r.avg_days_to_close) == (3, 1, 3.0)


@pytest.fixture
def complaints(spark):
    schema = "property_id string, complaints_12m long, complaints_total long, complaints_90d long, complaints_prior_90d long, complaints_open long, complaints_emergency long, complaints_emergency_open long, avg_days_to_close double, last_complaint_date timestamp_ntz"
    return spark.createDataFrame([("P1", 7, 9, 6, 5, 3, 2, 1, 4.0, datetime(2026, 6, 1)), ("P2", 1, 1, 1, 0, 0, 0, 0, None, datetime(2026, 5, 1)), ("P3", 20, 20, 9, 6, 8, 10, 4, 2.0, datetime(2026, 6, 20))], schema)


@pytest.fixture
def permits(spark):
    return spark.createDataFrame([("P1", 2, 2, 100.0, datetime(2026, 6, 10)), ("P3", 1, 1, None, datetime(2026, 1, 1))], "property_id string, permits_12m long, permits_total long, total_estimated_cost double, last_permit_date timestamp_ntz")


@pytest.fixture
def dim(spark):
    rows = [("P1", "5 OAK STREET", "QUEENS", "11101", 10, 1931), ("P2", "7 ELM ROAD", "QUEENS", "11101", 2000, None), ("P3", "9 MAPLE ROAD", "BRONX", "10451", 30, None), ("P4", "1 QUIET WAY", "BRONX", None, 5, None)]
    return spark.createDataFrame(rows, "property_id string, canonical_address string, borough string, zipcode string, units_res long, year_built long").selectExpr("*", "'X LLC' as pluto_owner_name", "units_res as units_total", "substr(property_id, 2) as bbl")


def test_business_complaints_count_once_a_licence(spark, complaints):
    businesses = spark.createDataFrame([("B1", "DELI", 3), ("B2", "BAR", 1)], "business_id string, canonical_business_name string, n_licenses long")
    day = lambda d: datetime(2025, 1, d)
    rows = [("B1", "P1", "Active", "Food", day(3), day(9)), ("B1", "P1", "Expired", "Food", day(1), day(4)), ("B1", "P2", "Active", "Bar", day(2), day(8)), ("B2", None, None, None, None, None)]
    stg = spark.createDataFrame(rows, "business_id string, property_id string, license_status string, business_category string, license_created timestamp_ntz, license_expires timestamp_ntz")
    got = {r.business_id: r for r in marts.business_activity(businesses, stg, complaints).collect()}
    b = got["B1"]
    assert (b.n_locations, b.active_licenses, b.first_licensed, b.latest_expiry, b.categories) == (2, 2, day(1), day(9), "Bar, Food")
    assert (b.location_complaints_12m, b.location_complaints_total) == (7 + 7 + 1, 9 + 9 + 1)
    assert (got["B2"].n_locations, got["B2"].active_licenses, got["B2"].location_complaints_12m) == (0, 0, 0)
    # only businesses with an active licence are hot spots
    assert [r.business_id for r in marts.business_hot_spots(marts.business_activity(businesses, stg, complaints)).collect()] == ["B1"]


def test_licence_counts_of_a_property(spark):
    rows = [("P1", "B1", "Active", "Food"), ("P1", "B1", "Expired", "Bar"), ("P1", "B2", "Expired", None), (None, "B3", "Active", "Food")]
    stg = spark.createDataFrame(rows, "property_id string, business_id string, license_status string, business_category string")
    assert [tuple(r) for r in marts.property_businesses(stg).collect()] == [("P1", 2, 1, 2, 3)]


def test_portfolio_counts_a_property_once(spark, complaints, permits, dim):
    groups = spark.createDataFrame([("G1", "X GROUP")], "group_id string, group_label string")
    members = spark.createDataFrame([("P1", "G1"), ("P2", "G1"), ("P4", "G1")], "property_id string, group_id string")
    rows = marts.portfolio_performance(groups, members, dim, complaints, permits).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.n_properties, r.distinct_owner_names, r.total_units_res, r.complaints_12m, r.complaints_open, r.permits_12m) == (3, 1, 2015, 8, 3, 2)
    assert r.complaints_per_unit_12m == pytest.approx(8 / 2015) and r.group_label == "X GROUP"


def test_questions(spark, complaints, permits, dim):
    none = spark.createDataFrame([], "property_id string, businesses_active long, licenses_total long")
    risk = marts.property_risk(dim, complaints, permits, none)
    got = {r.property_id: (r.complaint_trend_pct, r.flag_active_work_with_complaints, r.flag_open_complaints_new_permits) for r in risk.collect()}
    assert got == {"P1": (20.0, True, True), "P2": (None, False, False), "P3": (50.0, False, True)}
    assert [r.property_id for r in marts.renovation_pressure(risk).collect()] == ["P1"]
    # P3's last permit is more than 90 days older than its last complaint
    assert [r.property_id for r in marts.open_then_permits(risk, complaints, permits).collect()] == ["P1"]
    owned = marts.owner_properties(spark.createDataFrame([("P1", "O1"), ("P3", "O1"), ("P2", "O2")], "property_id string, owner_id string"), dim)
    owners = spark.createDataFrame([("O1", "ANN", False), ("O2", "BOB", False)], "owner_id string, canonical_owner_name string, owner_is_org boolean")
    landlords = marts.landlord_performance(owned, complaints, permits, owners)
    o = {r.owner_id: r for r in landlords.collect()}
    assert (o["O1"].n_properties, o["O1"].total_units_res, o["O1"].complaints_12m, o["O1"].permits_12m, o["O1"].in_scoring_pool) == (2, 40, 27, 3, True)
    assert (o["O1"].complaints_per_unit_12m, o["O1"].emergency_share, o["O1"].avg_days_to_close) == (pytest.approx(27 / 40), pytest.approx(12 / 29), 3.0)
    assert o["O2"].in_scoring_pool is False and o["O2"].operational_risk_score is None and o["O1"].operational_risk_score == 0.0
    assert [(r.owner_id, r.complaints_per_unit_12m) for r in marts.complaints_per_unit(landlords).collect()] == [("O1", 0.68)]
    assert [(r.owner_id, r.complaint_growth_pct) for r in marts.rising_landlords(landlords).collect()] == [("O1", 36.4)]
    assert [(r.canonical_owner_name, r.problem_properties) for r in marts.problem_owners(risk, owned, landlords).collect()] == [("ANN", 2)]
    hoods = marts.neighborhood_operations(dim, complaints, permits, none)
    got = {(r.borough, r.zipcode): (r.properties, r.units_res, r.complaints_12m, r.complaints_per_1k_units_12m, r.permits_per_1k_properties_12m) for r in hoods.collect()}
    assert got == {("QUEENS", "11101"): (2, 2010, 8, 3.98, 1000.0), ("BRONX", "10451"): (1, 30, 20, 666.67, 1000.0)}
    assert [(r.zipcode, r.neighborhood_pattern) for r in marts.neighborhood_patterns(hoods).collect()] == [("11101", "baseline")]
    assert [(r.borough, r.complaints_per_permit_12m) for r in marts.complaints_per_permit(hoods).collect()] == [("BRONX", 20.0), ("QUEENS", 4.0)]
