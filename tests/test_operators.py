"""Versions, matching, clustering, portfolios, quality and components on seeded rows."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gneiss.config import Settings
from gneiss.operators import clustering, matching, quality, versions
from gneiss.operators.components import connected_components

D = datetime


def test_latest_version_and_ties(spark, rows):
    raw = spark.createDataFrame([("a", D(2024, 1, 1), D(2024, 2, 1), "1"), ("a", D(2024, 1, 2), D(2024, 1, 3), "2"), ("b", None, D(2024, 1, 1), "3"), ("b", None, D(2024, 1, 2), "4")], "source_record_id string, updated_at timestamp, ingested_at timestamp, payload string")
    assert [r[3] for r in rows(versions.latest_versions(raw))] == ["2", "4"]


def test_dup_rank_groups_nulls(spark, rows):
    df = spark.createDataFrame([("j", None, 2), ("j", None, 1), ("j", "w", 3)], "job string, work string, id int")
    assert rows(versions.dup_rank(df, ["job", "work"], ["id"]).select("id", "dup_rank")) == [(1, 1), (2, 2), (3, 1)]


def test_appending_twice_adds_nothing(spark, rows):
    schema = "source_record_id string, updated_at timestamp_ntz, payload string"
    batch = spark.createDataFrame([("a", D(2024, 1, 1), "x"), ("a", D(2024, 1, 1), "y"), ("b", None, "z")], schema)
    first = versions.new_versions(batch, spark.createDataFrame([], schema), "source_record_id", "updated_at", "payload")
    assert rows(first.select("source_record_id", "payload")) == [("a", "y"), ("b", "z")]
    assert versions.new_versions(batch, first, "source_record_id", "updated_at", "payload").count() == 0
    assert versions.new_versions(spark.createDataFrame([("a", D(2024, 1, 2), "n")], schema), first).count() == 1
    assert versions.watermark(first) == D(2024, 1, 1)
    assert versions.watermark(spark.createDataFrame([], schema)) is None


def test_incremental_misses_late_rows_unless_refreshed(spark, rows):
    schema = "id int, at timestamp_ntz, v string"
    target = spark.createDataFrame([(1, D(2024, 1, 5), "old")], schema)
    new = spark.createDataFrame([(1, D(2024, 1, 5), "changed"), (2, D(2024, 1, 4), "late"), (3, D(2024, 1, 6), "new")], schema)
    assert [r[2] for r in rows(versions.incremental(target, new, "id", "at"))] == ["old", "new"]
    assert len(rows(versions.incremental(target, new, "id", "at", full_refresh=True))) == 3


def test_record_ids(spark):
    df = spark.createDataFrame([(" 340 ", "01"), ("340", " ")], "a string, b string")
    assert [r[0] for r in df.select(versions.record_id(F.col("a"), F.col("b"))).collect()] == ["340|01", None]


def test_run_log(spark, tmp_path):
    log = versions.RunLog(spark, str(tmp_path / "runs"))
    log.write("r", "s", "running", at=D(2024, 1, 1))
    log.write("r", "s", "success", 5, at=D(2024, 1, 2))
    assert [(r.status, r.records) for r in log.state().collect()] == [("success", 5)]


def test_components_name_the_smallest_node(spark):
    random.seed(3)
    edges = [(random.randrange(60), random.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7), (None, 3)]
    root = list(range(200))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    random.shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src int, dst int")).collect()}
    assert got == {x: find(x) for e in edges if e[0] is not None for x in e}
    assert connected_components(spark.createDataFrame([], "src int, dst int")).count() == 0


ADDRESS = "source_record_id string, house_number string, street_name string, street_suffix string, borough string, zipcode string, bbl string, normalized_address string, latitude double, longitude double"


def _mentions(spark):
    rows = [
        ("1", "5", "OAK", "STREET", "QUEENS", "11101", "4000010001", "5 OAK STREET", None, None),
        ("2", "5", "OAK", "STREET", "QUEENS", "11101", "4999999999", "5 OAK STREET", None, None),
        ("3", "7", "ELM", "ROAD", "QUEENS", "11101", None, "7 ELM ROAD", None, None),
        ("4", "9", "MAPLEE", "ROAD", "QUEENS", "11101", None, "9 MAPLEE ROAD", None, None),
        ("5", "9", "QUINCE", None, "QUEENS", None, None, "9 QUINCE", None, None),
        ("6", None, "LOST", None, None, None, None, "LOST", None, None),
    ]
    return spark.createDataFrame(rows, ADDRESS)


def _lots(spark):
    schema = "bbl string, house_number string, street_name string, street_suffix string, borough string, zipcode string, normalized_address string, latitude double, longitude double, units_res long, units_total long, owner_name string, owner_is_org boolean, year_built long, bldg_class string"
    rows = [
        ("4000010001", "5", "OAK", "STREET", "QUEENS", "11101", "5 OAK STREET", None, None, 3, 3, "A B", False, 1900, "A1"),
        ("4000020001", "7", "ELM", "ROAD", "QUEENS", "11101", "7 ELM ROAD", None, None, 1, 1, None, False, None, None),
        ("4000020002", "7", "ELM", "ROAD", "QUEENS", "11101", "7 ELM ROAD", None, None, 2, 2, None, False, None, None),
        ("4000030001", "9", "MAPLE", "ROAD", "QUEENS", "11101", "9 MAPLE ROAD", 40.7, -73.9, 4, 4, None, False, None, None),
        ("4000030002", "9", "MAPLE", "ROAD", "QUEENS", "11101", "9 MAPLE ROAD", 40.7, -73.9, 4, 4, None, False, None, None),
    ]
    return spark.createDataFrame(rows, schema)


def test_property_cascade(spark):
    mention = matching.mentions(complaints=_mentions(spark))
    found = matching.match_properties(mention, _lots(spark), Settings(review_threshold=0.3, auto_match_threshold=0.85))
    got = {r.normalized_address + (r.bbl or ""): (r.match_method, r.property_id, r.match_score) for r in found["matches"].collect()}
    assert got["5 OAK STREET4000010001"] == ("bbl_exact", "P4000010001", 1.0)
    assert got["5 OAK STREET4999999999"] == ("bbl_standalone", "P4999999999", 1.0)
    assert got["7 ELM ROAD"][:2] == ("address_exact", "P4000020002")
    assert got["9 MAPLEE ROAD"][:2] == ("fuzzy", "P4000030001")  # of equal scores the smallest lot
    assert got["9 QUINCE"][0] == "standalone" and got["9 QUINCE"][1].startswith("PX")
    queued = {r.candidate_bbl for r in found["review"].collect()}
    assert queued == {"4000030001"}  # the queued mention is minted too
    assert found["counters"]["missing_block_key"] == 1
    props = {r.property_id: r for r in matching.properties(found["matches"], _lots(spark)).collect()}
    assert props["P4000010001"].in_pluto and props["P4000010001"].units_res == 3
    assert not props["P4999999999"].in_pluto and props["P4999999999"].house_number == "5"
    links = matching.record_map(_mentions(spark).withColumnRenamed("source_record_id", "complaint_id"), "complaint_id", "complaints", mention, found["matches"])
    assert links.count() == 6


def test_blinded_evaluation(spark):
    at = lambda n, bbl, house, street, address: (str(n), house, street, "ROAD", "QUEENS", "11101", bbl, address, None, None)
    rows = [
        at(1, "4000010001", "5", "OAK", "5 OAK STREET"),
        at(2, "4000020001", "7", "ELM", "7 ELM ROAD"),  # two lots share the address; the larger is taken
        at(3, "4000030002", "9", "MAPLEE", "9 MAPLEE ROAD"),  # of equal scores the smaller lot
        at(4, "4000010001", "80", "FAR", "80 FAR ROAD"),
        at(5, "4000010001", None, None, None),
        at(6, None, "5", "OAK", "5 OAK STREET"),
        at(7, "4999999999", "5", "OAK", "5 OAK STREET"),  # no such lot
    ]
    mention = matching.mentions(complaints=spark.createDataFrame(rows, ADDRESS))
    for auto, maple in ((0.85, "fuzzy"), (0.999, "review")):
        outcomes = matching.blinded_outcomes(mention, _lots(spark), Settings(review_threshold=0.3, auto_match_threshold=auto))
        got = {r.band: (r.n, r.strict_correct, r.building_correct, r.precision_strict, r.precision_building) for r in matching.blinded_evaluation(outcomes).collect()}
        assert got == {"address_exact": (2, 1, 2, 0.5, 1.0), maple: (1, 0, 1, 0.0, 1.0), "unmatched": (1, 0, 0, None, None), "no_address": (1, 0, 0, None, None)}
        r = matching.blinded_measures(outcomes).head()
        wrong = 2 if maple == "fuzzy" else 1
        assert (r.eval_n, r.excluded_no_address, r.unmatched, r.tp, r.fp) == (4, 1, 1, 1, wrong)
        assert (r.precision_strict, r.recall_strict, r.false_positive_rate, r.false_negative_rate) == (round(1 / (1 + wrong), 4), 0.25, wrong / 4, (3 - wrong) / 4)


def test_oversize_blocks_are_skipped(spark):
    found = matching.match_properties(matching.mentions(complaints=_mentions(spark)), _lots(spark), Settings(max_block_size=1))
    assert found["counters"]["oversize_skips"] == 2
    assert found["matches"].where("match_method = 'fuzzy'").count() == 0


@pytest.mark.parametrize(("street", "za", "zb", "sa", "sb", "want"), [(1.0, "1", "1", "A", "A", 0.55 + 0.15 + 0.075 + 0.15), (0.0, "1", "2", None, None, 0.075 + 0.15), (1.0, None, "2", "A", None, 0.55 + 0.075 * 3)])
def test_pair_scores(spark, street, za, zb, sa, sb, want):
    df = spark.createDataFrame([(za, zb, sa, sb, None, None, None, None)], "zipcode string, r_zipcode string, street_suffix string, r_street_suffix string, latitude double, r_latitude double, longitude double, r_longitude double")
    assert df.select(matching.pair_score(F.lit(street), "", "r_", Settings())).head()[0] == pytest.approx(want)


def test_name_clusters(spark):
    names = spark.createDataFrame([("ACME REALTY", True, 1), ("ACME REALTY LLC", True, 5), ("ACME REALTY", False, 1), ("ZED FOODS", True, 1), ("FOODS ZED CO", True, 1)], "name string, is_org boolean, weight int")
    extra = spark.createDataFrame([("ZED FOODS", "FOODS ZED CO", 0.9, "phone+name"), ("ZED FOODS", "MISSING", 0.9, "phone+name")], "name_a string, name_b string, score double, method string")
    found = clustering.cluster_names(names, extra_edges=extra)
    got = {(r.name, r.is_org): r.canonical for r in found["assignment"].collect()}
    assert got == {("ACME REALTY", True): "ACME REALTY LLC", ("ACME REALTY LLC", True): "ACME REALTY LLC", ("ACME REALTY", False): "ACME REALTY", ("ZED FOODS", True): "ZED FOODS", ("FOODS ZED CO", True): "ZED FOODS"}
    assert {r.method for r in found["evidence"].collect()} == {"name_fuzzy", "phone+name"}


def test_businesses_of_one_phone(spark):
    rows = [("l1", "THE MOINIAN GROUP", "7180000001"), ("l2", "MOINIAN GROUP", "7180000001"), ("l3", "MOINIAN GRP HOLDINGS", "7180000001"), ("l4", None, "7180000001")]
    found = clustering.resolve_businesses(spark.createDataFrame(rows, "license_id string, business_name string, contact_phone string"))
    # alike beyond the automatic threshold but in different blocks: not merged by the phone
    ids = {r.license_id: r.business_id for r in found["map_license_business"].collect()}
    assert set(ids) == {"l1", "l2", "l3"} and ids["l1"] != ids["l2"]


def test_owner_fanout(spark):
    permits = spark.createDataFrame([("p1", "ACME LLC", True, 1), ("p2", "ACME LLC", True, 2)], "permit_row_id string, owner_name string, owner_is_org boolean, dup_rank long")
    links = spark.createDataFrame([("p1", "P1"), ("p2", "P1")], "source_record_id string, property_id string")
    props = spark.createDataFrame([("P1", "ACME LLC", True, True, 4)], "property_id string, pluto_owner_name string, pluto_owner_is_org boolean, in_pluto boolean, n_source_records long")
    out = clustering.resolve_owners(permits, links, props)
    assert out["map_property_owners"].count() == 2  # one for each relation
    assert [(r.n_properties, r.n_records) for r in out["owners"].collect()] == [(1, 5)]


def test_portfolios(spark):
    rows = [("P1", "CorporateOwner", "X LLC", None), ("P2", "Officer", "X LLC", "k"), ("P3", "IndividualOwner", None, "k"), ("P4", "CorporateOwner", "Y LLC", "k"), ("P5", "Officer", None, "q"), ("P6", "Officer", None, "q")]
    out = clustering.portfolio_groups(spark.createDataFrame(rows, "property_id string, contact_type string, corporation_name string, mailing_key string"))
    groups: dict = {}
    for r in out["property_owner_group"].collect():
        groups.setdefault(r.group_id, set()).add(r.property_id)
    # officers' mail gives no edges
    assert sorted(map(sorted, groups.values())) == [["P1", "P2"], ["P3", "P4"], ["P5"], ["P6"]]
    assert {r.group_label for r in out["owner_groups"].collect()} == {"X LLC", "Y LLC", None}


def test_quality_gate(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "id int, v string")
    with pytest.raises(ValueError, match="dup"):
        quality.gate([quality.Check("dup", quality.unique(df, "id"))])
    quality.gate([quality.Check("few", quality.not_null(df, "v"), 0, 1000)])
    assert quality.missing_fields(["id", "zip"], df) == ["zip"]


def test_percent_ranks(spark, rows):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([3.0, 1.0, 1.0, None, 9.0])], "id int, v double")
    want = df.selectExpr("id", "percent_rank() over (order by coalesce(v, 0)) as r")
    assert rows(quality.percent_ranks(df, 3, r=F.coalesce("v", F.lit(0.0))).select("id", "r")) == rows(want)
    assert rows(quality.percent_ranks(df.limit(1), 3, r=F.col("v")).select("r")) == [(0.0,)]


def test_settings_are_checked(monkeypatch):
    with pytest.raises(ValueError, match="review"):
        Settings(auto_match_threshold=0.7)
    with pytest.raises(ValueError, match="sum"):
        Settings(weight_street=0.9)
    monkeypatch.setenv("ER_MAX_BLOCK_SIZE", "7")
    assert Settings.from_env().max_block_size == 7
