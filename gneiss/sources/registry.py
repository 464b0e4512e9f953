"""The known sources, and their files read as raw records."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.functions.convert import utc_timestamp
from gneiss.operators.versions import record_id


@dataclass(frozen=True)
class Source:
    """One source: its data set, key fields (none: the row id), and filters that are pushed to it."""

    key: str
    dataset_id: str
    pk_fields: tuple[str, ...] = ()
    where: str | None = None
    select_fields: tuple[str, ...] = ()
    critical_fields: tuple[str, ...] = field(default=())

    def predicate(self, watermark: str | None = None) -> str | None:
        """The source's own filter and the watermark's, for the source to apply."""
        parts = [p for p in (self.where, f":updated_at > '{watermark}'" if watermark else None) if p]
        return " AND ".join(f"({p})" for p in parts) or None


# Data set ids, keys and filters of the public API.
SOURCES = {
    s.key: s
    for s in (
        Source("nyc_311", "erm2-nwe9", ("unique_key",), "created_date >= '2026-02-09T00:00:00'"),
        Source("dob_permits", "rbx6-tga4", (), "issued_date >= '2025-08-01T00:00:00'"),
        Source("dca_licenses", "w7w3-xahh", ("license_nbr",)),
        Source("pluto", "64uk-42ks", ("bbl",), None, ("bbl", "address", "borough", "zipcode", "unitsres", "unitstotal", "ownername", "yearbuilt", "bldgclass", "latitude", "longitude")),
        Source("hpd_registrations", "tesw-yqqr", ("registrationid",), None, ("registrationid", "buildingid", "boro", "housenumber", "streetname", "zip", "block", "lot", "bin", "lastregistrationdate", "registrationenddate"), ("registrationid", "boro", "block", "lot")),
        Source("hpd_contacts", "feu5-w2e2", ("registrationcontactid",), None, ("registrationcontactid", "registrationid", "type", "contactdescription", "corporationname", "firstname", "lastname", "businesshousenumber", "businessstreetname", "businessapartment", "businesscity", "businessstate", "businesszip"), ("registrationcontactid", "registrationid", "type")),
    )
}


def source(key: str) -> Source:
    """The source of that key; an unknown key raises KeyError with the known ones."""
    if key not in SOURCES:
        raise KeyError(f"unknown source {key!r}; known: {', '.join(SOURCES)}")
    return SOURCES[key]


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """API pages kept as JSON lines, one object in a row, as text."""
    return spark.read.text(path).withColumnRenamed("value", "payload")


def envelope(pages: DataFrame, src: Source, run_id: str) -> DataFrame:
    """Raw records with a reject reason where the key is blank or the update time is garbage."""
    item = lambda k: F.get_json_object("payload", f"$['{k}']")
    raw_time = item(":updated_at")
    rows = pages.select(
        record_id(*[item(k) for k in src.pk_fields or (":id",)]).alias("source_record_id"), item(":id").alias("socrata_row_id"), utc_timestamp(raw_time).alias("updated_at"),
        "payload", F.lit(run_id).alias("run_id"), F.current_timestamp().cast("timestamp_ntz").alias("ingested_at"), raw_time.alias("_raw_time"),
    )
    reason = F.when(F.col("source_record_id").isNull(), "blank key").when(F.col("_raw_time").isNotNull() & F.col("updated_at").isNull(), "bad :updated_at")
    return rows.withColumn("reason", reason).drop("_raw_time")
