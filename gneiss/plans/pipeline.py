"""The whole run: raw pages to clean tables, resolved entities, marts and a gated publication.

python -m gneiss.plans.pipeline RAW OUT_DIR --as-of 2026-07-01 [--only STEP] [--incremental] [--max-records N] [--full-refresh]
RAW is a folder with a folder of JSON lines for each source, of which missing
ones are skipped, or the address of an API. From an API, --incremental asks
for records updated after the newest stored one and --max-records (0: none)
caps each source. --full-refresh rebuilds the incremental facts.
"""

from __future__ import annotations

import argparse
import logging
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.config import Settings
from gneiss.functions.fixed import OWNER_CONTACTS
from gneiss.operators import clustering, matching, quality
from gneiss.operators.versions import RunLog, incremental, watermark
from gneiss.plans import marts, normalize
from gneiss.sources.api import read_api
from gneiss.sources.registry import SOURCES, envelope, read_pages
from gneiss.streaming.ingest import append_new

log = logging.getLogger(__name__)

#: What publishing copies, besides run metadata.
PUBLISHED = ["dim_property", "dim_owner", "dim_business", "bridge_property_source", "fct_complaints", "mart_property_risk", "mart_landlord_performance", "mart_neighborhood_operations", "mart_business_activity", "property_matches", "review_queue", "owner_matches"]


class Warehouse:
    """Parquet tables under one folder, a folder for each layer."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.runs = RunLog(spark, f"{self.root}/meta/pipeline_runs")

    def path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def exists(self, table: str) -> bool:
        jvm, path = self.spark._jvm, self.path(table)
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def replace(self, table: str, rows: DataFrame) -> DataFrame:
        """The table's new content, by a temporary folder that takes its place when whole."""
        rows.write.mode("overwrite").parquet(self.path(table) + "__new")
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path
        old, new = fs_path(self.path(table)), fs_path(self.path(table) + "__new")
        fs = old.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(old, True)
        if not fs.rename(new, old):
            raise OSError(f"{table} could not be put in place")
        return self.read(table)

    def step(self, name: str, work) -> None:
        """Runs work() with start and end in the run log; an error is logged and raised again."""
        run = str(uuid.uuid4())
        self.runs.write(run, name, "running")
        try:
            n = work()
        except Exception as e:
            self.runs.write(run, name, "failed", error=str(e)[:500])
            raise
        self.runs.write(run, name, "success", n)


def pull(w: Warehouse, key: str, base: str, incremental: bool = False, max_records: int | None = None) -> int:
    """ingest() from the API at `base`; incremental: only records updated after the newest one in raw.<key>."""
    src = SOURCES[key]
    mark = watermark(w.read(f"raw.{key}")) if incremental and w.exists(f"raw.{key}") else None
    where = src.predicate(mark.isoformat(timespec="milliseconds") if mark else None)
    cap = None if max_records is None else str(max_records)
    return ingest(w, key, read_api(w.spark, f"{base.rstrip('/')}/resource/{src.dataset_id}.json", where=where, fields=",".join(src.select_fields), max_records=cap).select("payload"))


def ingest(w: Warehouse, key: str, pages: DataFrame) -> int:
    """Appends the pages' new versions to raw.<key>, rejects to meta.rejected_records; fails before loading if a critical field is missing."""
    src = SOURCES[key]
    pages = pages.persist()  # an API is asked once
    first = pages.limit(50)
    if src.critical_fields and first.count():
        keys = {r[0] for r in first.select(F.explode(F.expr("json_object_keys(payload)"))).distinct().collect()}
        if gone := sorted(set(src.critical_fields) - keys):
            raise RuntimeError(f"{key}: fields {gone} are missing from the source")
    marked = envelope(pages, src, str(uuid.uuid4())).persist()
    n = append_new(marked.where("reason is null").drop("reason"), w.path(f"raw.{key}"))
    marked.where("reason is not null").withColumn("source", F.lit(key)).write.mode("append").parquet(w.path("meta.rejected_records"))
    marked.unpersist()
    pages.unpersist()
    return n


def normalise(w: Warehouse, only: str | None = None) -> int:
    n = 0
    for table, (key, build) in normalize.BUILDERS.items():
        if only not in (None, table):
            continue
        if not w.exists(f"raw.{key}"):
            log.warning("no raw.%s, %s is skipped", key, table)
            continue
        n += w.replace(f"clean.{table}", build(w.read(f"raw.{key}"))).count()
    return n


def resolve(w: Warehouse, settings: Settings) -> int:
    complaints, permits, licences, lots = (w.read(f"clean.{t}") for t in ("complaints", "permits", "licenses", "pluto_lots"))
    used = {"complaints": complaints, "permits": permits.where("dup_rank = 1"), "licenses": licences.where("is_nyc_premises")}
    mention = w.replace("er.property_mentions", matching.mentions(**used))
    found = matching.match_properties(mention, lots, settings)
    matches = w.replace("er.property_matches", found["matches"])
    w.replace("er.review_queue", found["review"])
    props = w.replace("er.properties", matching.properties(matches, lots))
    for name, key in (("complaints", "complaint_id"), ("permits", "permit_row_id"), ("licenses", "license_id")):
        w.replace(f"er.map_{name}", matching.record_map(used[name].drop("source_record_id"), key, name, mention, matches))
    for name, rows in clustering.resolve_owners(permits, w.read("er.map_permits"), props, settings).items():
        w.replace(f"er.{name}", rows)
    for name, rows in clustering.resolve_businesses(licences, settings).items():
        w.replace(f"er.{name}", rows)
    if w.exists("clean.hpd_registrations") and w.exists("clean.hpd_contacts"):
        c = w.read("clean.hpd_contacts").where(F.col("contact_type").isin(OWNER_CONTACTS))
        rows = w.read("clean.hpd_registrations").where("bbl is not null").select("registration_id", F.concat(F.lit("P"), "bbl").alias("property_id")).join(c, "registration_id")
        for name, out in clustering.portfolio_groups(rows.join(props.select("property_id"), "property_id", "left_semi"), settings).items():
            w.replace(f"er.{name}", out)
    return matches.count()


def update_complaints(w: Warehouse, staged: DataFrame, full_refresh: bool = False) -> DataFrame:
    """marts.fct_complaints with the staged complaints created after its newest one; older changes wait for a full refresh."""
    table = "marts.fct_complaints"
    return w.replace(table, incremental(w.read(table), staged, "complaint_id", "created_date", full_refresh) if w.exists(table) else staged)


def build_marts(w: Warehouse, as_of: datetime, full_refresh: bool = False) -> int:
    er = lambda t: w.read(f"er.{t}")
    c_stg = marts.stg_complaints(w.read("clean.complaints"), er("map_complaints"), as_of)
    p_stg = marts.stg_permits(w.read("clean.permits"), er("map_permits"))
    l_stg = marts.stg_licences(w.read("clean.licenses"), er("map_licenses"), er("map_license_business"), as_of)
    dim = w.replace("marts.dim_property", er("properties"))
    owners = w.replace("marts.dim_owner", er("owners"))
    businesses = w.replace("marts.dim_business", er("businesses"))
    c = w.replace("intermediate.int_property_complaints", marts.property_complaints(c_stg, as_of))
    p = w.replace("intermediate.int_property_permits", marts.property_permits(p_stg, as_of))
    b = w.replace("intermediate.int_property_businesses", marts.property_businesses(l_stg))
    owned = w.replace("intermediate.int_owner_properties", marts.owner_properties(er("map_property_owners"), dim))
    w.replace("marts.bridge_property_source", marts.bridge(er("map_complaints"), er("map_permits"), er("map_licenses")))
    update_complaints(w, c_stg, full_refresh)
    w.replace("marts.mart_property_risk", marts.property_risk(dim, c, p, b))
    w.replace("marts.mart_landlord_performance", marts.landlord_performance(owned, c, p, owners))
    w.replace("marts.mart_neighborhood_operations", marts.neighborhood_operations(dim, c, p, b))
    w.replace("marts.mart_business_activity", marts.business_activity(businesses, l_stg, c))
    if w.exists("er.owner_groups"):
        w.replace("marts.mart_portfolio_performance", marts.portfolio_performance(er("owner_groups"), er("property_owner_group"), dim, c, p))
    return dim.count()


def checks(w: Warehouse, settings: Settings) -> list[quality.Check]:
    dim, owner, matches = w.read("marts.dim_property"), w.read("marts.dim_owner"), w.read("er.property_matches")
    return [
        quality.Check("dim_property.property_id unique", quality.unique(dim, "property_id")),
        quality.Check("dim_property.property_id not null", quality.not_null(dim, "property_id")),
        quality.Check("dim_owner.owner_id unique", quality.unique(owner, "owner_id")),
        quality.Check("fct_complaints.property_id known", quality.relationship(w.read("marts.fct_complaints"), "property_id", dim, "property_id")),
        quality.Check("risk score in 0..100", quality.within_range(w.read("marts.mart_landlord_performance"), "operational_risk_score", 0, 100)),
        quality.Check("automatic matches reach the threshold", quality.auto_below_threshold(matches, settings.auto_match_threshold)),
        quality.Check("queued pairs are never automatic", quality.review_also_matched(w.read("er.review_queue"), matches)),
        quality.Check("permit dates in order", quality.ordered(w.read("clean.permits"), "issued_date", "expired_date"), 0, 1000),
    ]


def publish(w: Warehouse, target: str, settings: Settings) -> int:
    """Copies the serving tables to `target`, a folder or a JDBC URL, once all checks pass."""
    quality.gate(checks(w, settings))
    for table in PUBLISHED:
        layer = "er" if table in ("property_matches", "review_queue", "owner_matches") else "marts"
        rows = w.read(f"{layer}.{table}")
        if target.startswith("jdbc:"):
            rows.write.jdbc(target, table, mode="overwrite")
        else:
            rows.write.mode("overwrite").parquet(f"{target.rstrip('/')}/{table}")
    return len(PUBLISHED)


def run(spark: SparkSession, raw: str, out_dir: str, as_of: datetime, only: str | None = None, settings: Settings | None = None, new_only: bool = False, max_records: int | None = None, full_refresh: bool = False) -> Warehouse:
    s, w = settings or Settings.from_env(), Warehouse(spark, out_dir)
    here = Warehouse(spark, raw)
    if raw.startswith(("http://", "https://")):
        steps = {f"ingest.{k}": (lambda k=k: pull(w, k, raw, new_only, max_records)) for k in SOURCES}
    else:
        steps = {f"ingest.{k}": (lambda k=k: ingest(w, k, read_pages(spark, f"{raw}/{k}")) if here.exists(k) else 0) for k in SOURCES}
    steps |= {"normalize": lambda: normalise(w), "resolve": lambda: resolve(w, s), "marts": lambda: build_marts(w, as_of, full_refresh), "publish": lambda: publish(w, f"{out_dir}/published", s)}
    for name, work in steps.items():
        if only is None or name == only or name.startswith(f"{only}."):
            w.step(name, work)
    return w


if __name__ == "__main__":
    from gneiss.session import session

    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("raw")
    p.add_argument("out_dir")
    p.add_argument("--as-of", required=True, type=datetime.fromisoformat)
    p.add_argument("--only")
    p.add_argument("--incremental", action="store_true")
    p.add_argument("--max-records", type=int)
    p.add_argument("--full-refresh", action="store_true")
    a = p.parse_args()
    run(session("gneiss"), a.raw, a.out_dir, a.as_of, a.only, None, a.incremental, a.max_records, a.full_refresh)
