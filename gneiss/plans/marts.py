"""Staging views, rollups and marts over the resolved tables, and the questions asked of them.

Look-backs count from `as_of`. Ratios of counts are doubles; a zero
denominator gives null. Owner rollups add a property once for each relation
that links it, as the links are kept by relation.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.functions.fixed import EMERGENCY_TYPES
from gneiss.operators.quality import percent_ranks


def share(a: Column, b: Column) -> Column:
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def _ago(as_of: datetime, days: int) -> Column:
    return F.lit(as_of).cast("timestamp_ntz") - F.expr(f"interval {days} day")


def stg_complaints(clean: DataFrame, links: DataFrame, as_of: datetime) -> DataFrame:
    end = F.coalesce("closed_date", F.lit(as_of).cast("timestamp_ntz"))
    out = clean.drop("source_record_id").join(links, F.col("source_record_id") == F.col("complaint_id"), "left").drop("source_record_id")
    return out.withColumns({"days_open": F.datediff(end, "created_date").cast("long"), "is_closed": F.col("status") == "Closed", "is_emergency": F.col("complaint_type").isin(EMERGENCY_TYPES)})


def stg_permits(clean: DataFrame, links: DataFrame) -> DataFrame:
    return clean.drop("source_record_id").where("dup_rank = 1").join(links, F.col("source_record_id") == F.col("permit_row_id"), "left").drop("source_record_id")


def stg_licences(clean: DataFrame, links: DataFrame, businesses: DataFrame, as_of: datetime) -> DataFrame:
    out = clean.drop("source_record_id").where("is_nyc_premises").join(links, F.col("source_record_id") == F.col("license_id"), "left").drop("source_record_id")
    return out.join(businesses, "license_id", "left").withColumn("is_expired", F.col("license_expires") < F.lit(as_of).cast("timestamp_ntz"))


def property_complaints(stg: DataFrame, as_of: datetime, year: int = 365, quarter: int = 90) -> DataFrame:
    made, open_ = F.col("created_date"), ~F.col("is_closed")
    return stg.where("property_id is not null").groupBy("property_id").agg(
        F.count("*").alias("complaints_total"),
        F.count_if(made >= _ago(as_of, year)).alias("complaints_12m"),
        F.count_if(made >= _ago(as_of, quarter)).alias("complaints_90d"),
        F.count_if((made >= _ago(as_of, 2 * quarter)) & (made < _ago(as_of, quarter))).alias("complaints_prior_90d"),
        F.count_if(open_).alias("complaints_open"),
        F.count_if("is_emergency").alias("complaints_emergency"),
        F.count_if(F.col("is_emergency") & open_).alias("complaints_emergency_open"),
        F.avg(F.when(F.col("is_closed"), F.col("days_open"))).alias("avg_days_to_close"),
        F.max("created_date").alias("last_complaint_date"),
        F.count_distinct("complaint_type").alias("distinct_complaint_types"),
    )


def property_permits(stg: DataFrame, as_of: datetime, year: int = 365) -> DataFrame:
    return stg.where("property_id is not null").groupBy("property_id").agg(
        F.count("*").alias("permits_total"),
        F.count_if(F.col("issued_date") >= _ago(as_of, year)).alias("permits_12m"),
        F.count_if(F.col("filing_reason").ilike("%renewal%")).alias("permits_renewals"),
        F.count_distinct("job_filing_number").alias("distinct_jobs"),
        F.sum("estimated_job_cost").alias("total_estimated_cost"),
        F.max("issued_date").alias("last_permit_date"),
        F.count_distinct("work_type").alias("distinct_work_types"),
        F.count_distinct("owner_name").alias("distinct_permit_owners"),
    )


def property_businesses(stg: DataFrame) -> DataFrame:
    return stg.where("property_id is not null").groupBy("property_id").agg(
        F.count_distinct("business_id").alias("businesses_total"),
        F.count_distinct(F.when(F.col("license_status") == "Active", F.col("business_id"))).alias("businesses_active"),
        F.count_distinct("business_category").alias("distinct_categories"),
        F.count("*").alias("licenses_total"),
    )


def owner_properties(links: DataFrame, dim_property: DataFrame) -> DataFrame:
    return links.join(dim_property.select("property_id", "units_res", "units_total", "borough", "zipcode"), "property_id")


def bridge(complaints: DataFrame, permits: DataFrame, licences: DataFrame) -> DataFrame:
    """Every source record's property, method and score."""
    parts = [links.select(F.lit(name).alias("source_system"), "source_record_id", "property_id", "match_method", "match_score") for name, links in (("nyc_311", complaints), ("dob_permits", permits), ("dca_licenses", licences))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def property_risk(dim: DataFrame, c: DataFrame, p: DataFrame, b: DataFrame) -> DataFrame:
    rows = dim.join(c, "property_id", "left").join(p, "property_id", "left").join(b, "property_id", "left")
    rows = rows.where(zero("complaints_total") + zero("permits_total") + zero("licenses_total") > 0)
    counts = ("complaints_total", "complaints_12m", "complaints_90d", "complaints_prior_90d", "complaints_open", "complaints_emergency", "permits_12m", "permits_total", "businesses_active")
    out = rows.select("property_id", "canonical_address", "borough", "zipcode", "units_res", "year_built", *[zero(k).alias(k) for k in counts], "avg_days_to_close", "total_estimated_cost")
    return out.withColumns({
        "complaints_per_unit_12m": share(F.col("complaints_12m"), F.col("units_res")),
        "complaint_trend_pct": F.round(share((F.col("complaints_90d") - F.col("complaints_prior_90d")) * 100, F.col("complaints_prior_90d")), 1),
        "flag_active_work_with_complaints": (F.col("complaints_90d") >= 5) & (F.col("permits_12m") >= 2),
        "flag_open_complaints_new_permits": (F.col("complaints_open") > 0) & (F.col("permits_12m") > 0),
    })


#: Weight of each ranked component of the risk score.
RISK_WEIGHTS = {"complaints_per_unit_12m": 0.40, "emergency_share": 0.20, "open_share": 0.15, "trend": 0.15, "permits_per_property_12m": 0.10}


def risk_score(pool: DataFrame) -> DataFrame:
    """pool with operational_risk_score: weighted percent ranks of its components, nulls ranked as 0."""
    ranked = percent_ranks(pool, **{f"rank_{k}": F.coalesce(F.col(k), F.lit(0.0)) for k in RISK_WEIGHTS})
    total = None
    for k, w in RISK_WEIGHTS.items():
        term = F.lit(w) * F.col(f"rank_{k}")
        total = term if total is None else total + term
    return ranked.withColumn("operational_risk_score", F.round(100 * total, 1)).drop(*[f"rank_{k}" for k in RISK_WEIGHTS])


def landlord_performance(owned: DataFrame, c: DataFrame, p: DataFrame, owners: DataFrame, min_units: int = 10, min_complaints: int = 3) -> DataFrame:
    """Owners' rollups with a risk score for those with enough units and complaints."""
    sums = {"total_units_res": "units_res", "complaints_total": "complaints_total", "complaints_12m": "complaints_12m", "complaints_90d": "complaints_90d", "complaints_prior_90d": "complaints_prior_90d", "complaints_open": "complaints_open", "complaints_emergency": "complaints_emergency", "permits_12m": "permits_12m", "permit_cost_total": "total_estimated_cost"}
    rolled = owned.join(c, "property_id", "left").join(p, "property_id", "left").groupBy("owner_id").agg(
        F.count_distinct("property_id").alias("n_properties"), *[F.sum(zero(v)).alias(k) for k, v in sums.items()], F.avg("avg_days_to_close").alias("avg_days_to_close")
    )
    rows = rolled.withColumns({
        "complaints_per_unit_12m": share(F.col("complaints_12m"), F.col("total_units_res")), "emergency_share": share(F.col("complaints_emergency"), F.col("complaints_total")),
        "open_share": share(F.col("complaints_open"), F.col("complaints_total")), "trend": share(F.col("complaints_90d") - F.col("complaints_prior_90d"), F.col("complaints_prior_90d")),
        "permits_per_property_12m": share(F.col("permits_12m"), F.col("n_properties")), "in_scoring_pool": (F.col("total_units_res") >= min_units) & (F.col("complaints_12m") >= min_complaints),
    })
    scored = risk_score(rows.where("in_scoring_pool")).select("owner_id", "operational_risk_score")
    return rows.join(owners.select("owner_id", "canonical_owner_name", "owner_is_org"), "owner_id").join(scored, "owner_id", "left")


def neighborhood_operations(dim: DataFrame, c: DataFrame, p: DataFrame, b: DataFrame) -> DataFrame:
    rows = dim.where("borough is not null and zipcode is not null").join(c, "property_id", "left").join(p, "property_id", "left").join(b, "property_id", "left")
    sums = {"units_res": "units_res", "complaints_12m": "complaints_12m", "complaints_open": "complaints_open", "complaints_emergency": "complaints_emergency", "permits_12m": "permits_12m", "construction_cost": "total_estimated_cost", "businesses_active": "businesses_active"}
    out = rows.groupBy("borough", "zipcode").agg(F.count("*").alias("properties"), *[F.sum(zero(v)).alias(k) for k, v in sums.items()])
    out = out.where(F.col("complaints_12m") + F.col("permits_12m") + F.col("businesses_active") > 0)
    return out.withColumns({"complaints_per_1k_units_12m": F.round(share(F.col("complaints_12m") * 1000, F.col("units_res")), 2), "permits_per_1k_properties_12m": F.round(share(F.col("permits_12m") * 1000, F.col("properties")), 2)})


def business_activity(businesses: DataFrame, stg: DataFrame, c: DataFrame) -> DataFrame:
    """Businesses' rollups; a location's complaints are added once for each of its licences."""
    rows = businesses.select("business_id", "canonical_business_name", "n_licenses").join(stg, "business_id").join(c.select("property_id", "complaints_12m", "complaints_total"), "property_id", "left")
    return rows.groupBy("business_id", "canonical_business_name", "n_licenses").agg(
        F.count_distinct("property_id").alias("n_locations"), F.count_if(F.col("license_status") == "Active").alias("active_licenses"), F.min("license_created").alias("first_licensed"),
        F.max("license_expires").alias("latest_expiry"), F.array_join(F.array_sort(F.collect_set("business_category")), ", ").alias("categories"),
        F.sum(zero("complaints_12m")).alias("location_complaints_12m"), F.sum(zero("complaints_total")).alias("location_complaints_total"),
    )


def portfolio_performance(groups: DataFrame, members: DataFrame, properties: DataFrame, c: DataFrame, p: DataFrame) -> DataFrame:
    rows = members.join(properties.select("property_id", "units_res", "pluto_owner_name"), "property_id").join(c, "property_id", "left").join(p, "property_id", "left")
    sums = {"total_units_res": "units_res", "complaints_12m": "complaints_12m", "complaints_open": "complaints_open", "complaints_emergency": "complaints_emergency", "permits_12m": "permits_12m"}
    out = rows.groupBy("group_id").agg(F.count_distinct("property_id").alias("n_properties"), F.count_distinct("pluto_owner_name").alias("distinct_owner_names"), *[F.sum(zero(v)).alias(k) for k, v in sums.items()])
    return out.withColumn("complaints_per_unit_12m", share(F.col("complaints_12m"), F.col("total_units_res"))).join(groups.select("group_id", "group_label"), "group_id")


# --- questions -----------------------------------------------------------------


def complaints_per_permit(hoods: DataFrame) -> DataFrame:
    out = hoods.groupBy("borough").agg(F.sum("complaints_12m").alias("complaints_12m"), F.sum("permits_12m").alias("permits_12m"))
    return out.withColumn("complaints_per_permit_12m", F.round(share(F.col("complaints_12m"), F.col("permits_12m")), 2)).orderBy(F.col("complaints_per_permit_12m").desc_nulls_last(), "borough")


def complaints_per_unit(landlords: DataFrame, k: int = 25) -> DataFrame:
    out = landlords.where("in_scoring_pool").withColumn("complaints_per_unit_12m", F.round("complaints_per_unit_12m", 2))
    return out.select("owner_id", "canonical_owner_name", "n_properties", "total_units_res", "complaints_12m", "complaints_per_unit_12m", "operational_risk_score").orderBy(F.col("complaints_per_unit_12m").desc_nulls_last(), "owner_id").limit(k)


def rising_landlords(landlords: DataFrame, k: int = 25) -> DataFrame:
    out = landlords.where("complaints_prior_90d >= 5").withColumn("complaint_growth_pct", F.round(F.col("trend") * 100, 1))
    return out.orderBy(F.col("complaint_growth_pct").desc_nulls_last(), "owner_id").limit(k)


def renovation_pressure(risk: DataFrame, k: int = 25) -> DataFrame:
    return risk.where("flag_active_work_with_complaints").orderBy(F.col("complaints_12m").desc(), "property_id").limit(k)


def business_hot_spots(activity: DataFrame, k: int = 25) -> DataFrame:
    return activity.where("active_licenses > 0").orderBy(F.col("location_complaints_12m").desc(), "business_id").limit(k)


def neighborhood_pattern(high: Column, low_investment: Column) -> Column:
    return F.when(high & low_investment, "high-complaint / low-investment").when(high, "high-complaint / active-construction").otherwise("baseline")


def neighborhood_patterns(hoods: DataFrame, k: int = 30) -> DataFrame:
    pattern = neighborhood_pattern(F.col("complaints_per_1k_units_12m") > 400, F.col("permits_per_1k_properties_12m") < 50)
    return hoods.where("units_res >= 1000").withColumn("neighborhood_pattern", pattern).orderBy(F.col("complaints_per_1k_units_12m").desc_nulls_last(), "borough", "zipcode").limit(k)


def problem_owners(risk: DataFrame, owned: DataFrame, landlords: DataFrame, k: int = 25) -> DataFrame:
    bad = risk.where("complaints_per_unit_12m > 0.5 or complaints_open >= 5").select("property_id")
    keys = ["canonical_owner_name", "n_properties", "total_units_res", "complaints_12m", "operational_risk_score"]
    out = bad.join(owned, "property_id").select("owner_id").join(landlords, "owner_id").groupBy(*keys).agg(F.count("*").alias("problem_properties")).where("problem_properties >= 2")
    return out.orderBy(F.col("problem_properties").desc(), F.col("operational_risk_score").desc_nulls_last(), "canonical_owner_name").limit(k)


def open_then_permits(risk: DataFrame, c: DataFrame, p: DataFrame, k: int = 25) -> DataFrame:
    rows = risk.where("flag_open_complaints_new_permits").join(c.select("property_id", "complaints_emergency_open", "last_complaint_date"), "property_id").join(p.select("property_id", "last_permit_date"), "property_id")
    rows = rows.where(F.col("last_permit_date") > F.col("last_complaint_date") - F.expr("interval 90 day"))
    return rows.orderBy(F.col("complaints_emergency_open").desc(), F.col("complaints_open").desc(), "property_id").limit(k)


def lineage_drilldown(bridge_: DataFrame, dim: DataFrame, risk: DataFrame, k: int = 50) -> DataFrame:
    """The source records of the property with most complaints; the target is a scalar subquery."""
    target = risk.orderBy(F.col("complaints_12m").desc(), "property_id").limit(1).select("property_id")
    rows = bridge_.where(F.col("property_id") == target.scalar()).join(dim.select("property_id", "canonical_address", "bbl"), "property_id")
    return rows.orderBy("source_system", "source_record_id").limit(k)
