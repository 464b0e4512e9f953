"""From raw pages to published marts; the paged API and the streaming load."""

from __future__ import annotations

import http.server
import json
import logging
import re
import threading
import urllib.parse
from datetime import datetime

import pytest

from gneiss.config import IngestSettings
from gneiss.plans import dashboard, marts, pipeline, reports
from gneiss.sources import api
from gneiss.sources.registry import SOURCES, read_pages, source
from gneiss.streaming.ingest import stream_pages


def _raw(folder):
    def put(key, rows):
        (folder / key).mkdir(parents=True)
        (folder / key / "page.json").write_text("\n".join(json.dumps({":id": f"row-{i}", ":updated_at": "2026-06-01T12:30:00.000Z", **r}) for i, r in enumerate(rows)))

    put("nyc_311", [{"unique_key": str(i), "created_date": f"2026-06-{1 + i:02d}T10:00:00", "status": "Closed" if i % 2 else "Open", "complaint_type": "GAS", "incident_address": "5 OAK ST", "borough": "QUEENS", "incident_zip": "11101", "bbl": "4000010001"} for i in range(6)] + [{"unique_key": "  "}])
    put("dob_permits", [{"job_filing_number": "J1", "work_permit": "W", "house_no": "5", "street_name": "OAK ST", "borough": "QUEENS", "zip_code": "11101", "bbl": "4000010001", "issued_date": "2026-06-02", "estimated_job_costs": "$1,000", "owner_name": "DOE, JANE"}] * 2)
    put("dca_licenses", [{"license_nbr": "L1", "business_name": "Corner Deli Inc.", "license_status": "Active", "business_category": "Food", "address_building": "5", "address_street_name": "OAK ST", "address_borough": "Queens", "address_zip": "11101", "contact_phone": "7182371166"}])
    put("pluto", [{"bbl": "4000010001.0", "address": "5 OAK STREET", "borough": "QN", "zipcode": "11101", "unitsres": "12", "unitstotal": "12", "ownername": "OAK HOLDINGS LLC", "yearbuilt": "1931"}, {"bbl": "9", "address": "x"}])
    put("hpd_registrations", [{"registrationid": "R1", "boro": "QUEENS", "block": "1", "lot": "1"}])
    put("hpd_contacts", [{"registrationcontactid": "C1", "registrationid": "R1", "type": "CorporateOwner", "corporationname": "Oak Holdings LLC"}])


def test_whole_run(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    _raw(raw)
    w = pipeline.run(spark, str(raw), str(out), datetime(2026, 7, 1))
    assert w.read("raw.nyc_311").count() == 6
    assert w.read("meta.rejected_records").count() == 1
    risk = w.read("marts.mart_property_risk").collect()
    assert [(r.property_id, r.complaints_total, r.complaints_open, r.permits_total, r.businesses_active) for r in risk] == [("P4000010001", 6, 3, 1, 1)]
    owners = {r.canonical_owner_name: r for r in w.read("marts.mart_landlord_performance").collect()}
    assert set(owners) == {"OAK HOLDINGS LLC", "JANE DOE"}
    assert owners["OAK HOLDINGS LLC"].total_units_res == 12
    assert w.read("marts.mart_portfolio_performance").head().group_label == "OAK HOLDINGS LLC"
    assert (out / "published" / "dim_property").exists()
    hoods = w.read("marts.mart_neighborhood_operations")
    assert marts.complaints_per_permit(hoods).head().complaints_per_permit_12m == 6.0
    c, p = w.read("intermediate.int_property_complaints"), w.read("intermediate.int_property_permits")
    landlords, owned, props = w.read("marts.mart_landlord_performance"), w.read("intermediate.int_owner_properties"), w.read("marts.mart_property_risk")
    for q in (marts.complaints_per_unit(landlords), marts.rising_landlords(landlords), marts.renovation_pressure(props), marts.business_hot_spots(w.read("marts.mart_business_activity")), marts.neighborhood_patterns(hoods), marts.problem_owners(props, owned, landlords), marts.open_then_permits(props, c, p), marts.lineage_drilldown(w.read("marts.bridge_property_source"), w.read("marts.dim_property"), props)):
        q.collect()
    assert marts.lineage_drilldown(w.read("marts.bridge_property_source"), w.read("marts.dim_property"), props).count() == 8
    # a second load of the same pages adds nothing
    assert pipeline.ingest(w, "nyc_311", read_pages(spark, f"{raw}/nyc_311")) == 0
    cards = dashboard.overview(w, datetime(2026, 7, 1), "QUEENS")
    assert len(cards) == 9 and cards["complaints_12m"].head().n == 6 and cards["priority_properties"].count() == 1
    health = dashboard.health(w)
    assert health["rejected"].head().rejected_records == 2 and health["freshness"].count() == 6 and health["reviews"].count() == 3
    (tmp_path / "pairs.csv").write_text("name_a,name_b,is_org,label,note\nACME LLC,ACME,1,match,\nJANE DOE,JOHN ROE,0,nonmatch,\n")
    text = reports.evaluation(w, str(tmp_path / "pairs.csv"))
    assert "address_exact" in text and "| 1 | 0 | 0 | 1 |" in text
    assert reports.benchmark(w)["resolve"]["records"] > 0
    steps = {r.step: r.status for r in w.runs.state().collect()}
    assert set(steps.values()) == {"success"} and "marts" in steps


def test_missing_critical_fields_stop_the_load(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.json").write_text('{"registrationid": "1", ":id": "r"}')
    with pytest.raises(RuntimeError, match="boro"):
        pipeline.ingest(pipeline.Warehouse(spark, str(tmp_path / "w")), "hpd_registrations", read_pages(spark, str(tmp_path / "p")))


def test_unknown_source():
    with pytest.raises(KeyError, match="nyc_311"):
        source("nope")
    assert SOURCES["nyc_311"].predicate("2026-01-01").count("AND") == 1


class Server:
    """Pages of ids 1 to n, and failures first."""

    def __init__(self, n, failures=()):
        self.ids, self.failures, self.asked = [f"{i:04d}" for i in range(1, n + 1)], list(failures), []

    def __call__(self, url, params):
        self.asked.append(params)
        if self.failures:
            return self.failures.pop(0), {"Retry-After": "3"}, ""
        after = params.get("$where", "").rpartition(":id > '")[2][:4]
        rows = [x for x in self.ids if x > after][: int(params["$limit"])]
        return 200, {}, json.dumps([{":id": x} for x in rows])


def test_paging_by_last_id():
    s = Server(5)
    assert [len(p) for p in api.pages("u", None, (), IngestSettings(page_size=3), get_=s)] == [3, 2]
    assert [len(p) for p in api.pages("u", "a = 1", ("a",), IngestSettings(page_size=3, max_records=4), get_=Server(9))] == [3, 1]
    assert "(" not in s.asked[0].get("$where", "")


def test_retries():
    waits = []
    s = Server(1, [429, 503])
    assert api.get("u", {"$limit": "5"}, IngestSettings(), s, waits.append) == [{":id": "0001"}]
    assert waits == [3.0, 3.0]
    with pytest.raises(RuntimeError, match="400"):
        api.get("u", {"$limit": "5"}, IngestSettings(), Server(1, [400]), waits.append)
    with pytest.raises(RuntimeError, match="3 attempts"):
        api.get("u", {"$limit": "5"}, IngestSettings(max_retries=2), Server(1, [503] * 9), waits.append)
    assert api.delay(10, {}, IngestSettings(), 0.0) == 60.0


@pytest.fixture
def served():
    """(address, rows that can be changed, what was asked) of an API that applies `:updated_at >`, `:id >` and equality."""
    rows, asked = [], []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            q = dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(self.path).query))
            asked.append(q)
            found = sorted(rows, key=lambda r: r[":id"])
            for name, mark, value in re.findall(r"([:\w]+) (>|=) '([^']*)'", q.get("$where", "")):
                found = [r for r in found if (r[name] > value if mark == ">" else r[name] == value)]
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(found[: int(q["$limit"])]).encode())

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", rows, asked
    server.shutdown()


def _licence(i, at="2026-06-01T00:00:00.000"):
    return {":id": f"row-{i:03d}", ":updated_at": at, "license_nbr": str(i), "kind": "ab"[i % 2], "size": i}


def test_the_api_as_a_source(spark, served):
    base, served_rows, asked = served
    served_rows += [_licence(i) for i in range(10)]
    read = lambda **o: api.read_api(spark, base, fields="kind,size", page_size="4", **o)
    assert read().columns == [":id", ":updated_at", "kind", "size", "payload"]
    assert read().count() == 10 and len(asked) == 3
    asked.clear()
    some = read().where("kind = 'a' and `:id` > 'row-003' and size > '4'")
    assert sorted(r["size"] for r in some.collect()) == ["6", "8"]
    assert "kind = 'a'" in asked[0]["$where"] and ":id > 'row-003'" in asked[0]["$where"] and "size" not in asked[0]["$where"]
    assert json.loads(some.head().payload)["license_nbr"] == "6"
    cut = read(bounds="row-002,row-006", max_records="0")
    assert cut.rdd.getNumPartitions() == 3
    # a cap holds over the whole read
    assert sorted(r[":id"] for r in read(bounds="row-002,row-006", max_records="5").collect()) == [f"row-{i:03d}" for i in range(5)]


def test_incremental_pull(spark, tmp_path, served):
    base, served_rows, asked = served
    w = pipeline.Warehouse(spark, str(tmp_path))
    served_rows += [_licence(i) for i in range(5)]
    assert pipeline.pull(w, "dca_licenses", base, incremental=True) == 5
    assert "$where" not in asked[0]
    asked.clear()
    served_rows += [_licence(1, "2026-06-02T00:00:00.000"), _licence(7, "2026-06-03T00:00:00.000")]
    assert pipeline.pull(w, "dca_licenses", base, incremental=True) == 2
    assert ":updated_at > '2026-06-01T00:00:00.000'" in asked[0]["$where"]
    assert pipeline.pull(w, "dca_licenses", base) == 0
    assert pipeline.pull(pipeline.Warehouse(spark, str(tmp_path / "b")), "dca_licenses", base, max_records=3) == 3
    assert w.read("raw.dca_licenses").count() == 7


def test_complaints_grow_by_what_is_new(spark, tmp_path):
    w = pipeline.Warehouse(spark, str(tmp_path))
    rows = lambda *x: spark.createDataFrame(x, "complaint_id string, created_date timestamp_ntz, status string")
    day = lambda d: datetime(2026, 6, d)
    pipeline.update_complaints(w, rows(("a", day(1), "Open"), ("b", day(2), "Open")))
    changed = rows(("a", day(1), "Closed"), ("b", day(3), "Closed"), ("c", day(4), "Open"), ("d", day(1), "late"))
    state = lambda: sorted((r.complaint_id, r.status) for r in w.read("marts.fct_complaints").collect())
    pipeline.update_complaints(w, changed)
    assert state() == [("a", "Open"), ("b", "Closed"), ("c", "Open")]
    pipeline.update_complaints(w, changed)
    assert state() == [("a", "Open"), ("b", "Closed"), ("c", "Open")]
    pipeline.update_complaints(w, changed, full_refresh=True)
    assert state() == [("a", "Closed"), ("b", "Closed"), ("c", "Open"), ("d", "late")]


def test_streaming_load(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()

    def load():
        stream_pages(spark, str(pages), SOURCES["nyc_311"], str(tmp_path / "raw"), str(tmp_path / "bad"), str(tmp_path / "ck")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "raw")).count()

    (pages / "1.json").write_text('{"unique_key": "1", ":updated_at": "2026-01-01T00:00:00Z"}\n{"unique_key": ""}')
    assert load() == 1
    (pages / "2.json").write_text('{"unique_key": "1", ":updated_at": "2026-01-01T00:00:00Z"}\n{"unique_key": "1", ":updated_at": "2026-01-02T00:00:00Z"}')
    assert load() == 2
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1


def test_profile_reports(spark):
    df = spark.createDataFrame([("5 OAK ST", "2024-01-01", "40.7", "-74"), ("6 OAK STREET", "2999-01-01", "10", "10"), ("7 ELM RD", "bad", None, None)], "address string, issue_date string, latitude string, longitude string")
    d = reports.date_ranges(df, "2026-01-01").head()
    assert (d.unparseable, d.future) == (1, 1)
    assert tuple(reports.coordinate_check(df).head()) == (1, 1)
    assert [r.suffix for r in reports.suffix_spellings(df, "address").collect()] == ["STREET"]
    assert "| 7 ELM RD | bad |  |  |" in reports.markdown(df, "x")
    line = json.loads(reports.JsonLines().format(logging.makeLogRecord({"msg": "m", "rows": 3})))
    assert line["rows"] == 3 and line["message"] == "m"
