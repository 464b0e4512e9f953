"""The overview and health cards, as frames of a warehouse's tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.plans.pipeline import Warehouse


def _count(rows: DataFrame, name: str = "n") -> DataFrame:
    return rows.agg(F.count("*").alias(name))


def _in_borough(rows: DataFrame, borough: str | None) -> DataFrame:
    return rows if borough is None else rows.where(F.col("borough") == borough)


def overview(w: Warehouse, as_of: datetime, borough: str | None = None) -> dict[str, DataFrame]:
    """Nine cards; a borough narrows the last two."""
    year = w.read("marts.fct_complaints").where(F.col("created_date") >= F.lit(as_of).cast("timestamp_ntz") - F.expr("interval 365 day"))
    landlords, risk = w.read("marts.mart_landlord_performance"), _in_borough(w.read("marts.mart_property_risk"), borough)
    hoods = _in_borough(w.read("marts.mart_neighborhood_operations"), borough).where("complaints_per_1k_units_12m is not null and units_res >= 500")
    return {
        "properties": _count(w.read("marts.dim_property")),
        "complaints_12m": _count(year),
        "owners": _count(w.read("marts.dim_owner")),
        "businesses": _count(w.read("marts.dim_business")),
        "match_methods": w.read("marts.bridge_property_source").groupBy("match_method").agg(F.count("*").alias("records")).orderBy(F.col("records").desc(), "match_method"),
        "by_borough": year.where("borough is not null").groupBy("borough").agg(F.count("*").alias("complaints")).orderBy(F.col("complaints").desc(), "borough"),
        "top_landlords": landlords.where("in_scoring_pool").orderBy(F.col("complaints_per_unit_12m").desc_nulls_last(), "owner_id").limit(15),
        "priority_properties": risk.orderBy(F.col("complaints_12m").desc(), "property_id").limit(15),
        "construction": hoods.select("zipcode", "borough", "complaints_per_1k_units_12m", "permits_per_1k_properties_12m").orderBy(F.col("complaints_per_1k_units_12m").desc(), "borough", "zipcode"),
    }


def health(w: Warehouse) -> dict[str, DataFrame]:
    """Recent runs of loads and of the other steps, rejects, open reviews, and when each load last succeeded."""
    runs = w.runs.state()
    loads = F.col("step").startswith("ingest.")
    queue = lambda name, table: _count(w.read(table), "pairs").select(F.lit(name).alias("queue"), "pairs")
    return {
        "ingest_runs": runs.where(loads).orderBy(F.col("at").desc(), "run_id").limit(20),
        "pipeline_runs": runs.where(~loads).orderBy(F.col("at").desc(), "run_id").limit(20),
        "rejected": _count(w.read("meta.rejected_records"), "rejected_records"),
        "reviews": queue("property", "er.review_queue").unionByName(queue("owner", "er.owner_review_queue")).unionByName(queue("business", "er.business_review_queue")),
        "freshness": runs.where(loads & (F.col("status") == "success")).groupBy(F.substring_index("step", ".", -1).alias("source")).agg(F.max("at").alias("last_success")),
    }
