"""Versioned records: latest version, duplicate ranks, idempotent and incremental writes, run log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def epoch() -> Column:
    """The version of rows without one."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def first_by(rows: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row for each key: the first in the order, which should be total."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def latest_versions(raw: DataFrame, key: str = "source_record_id", version: str = "updated_at", loaded: str = "ingested_at", *ties: str) -> DataFrame:
    """The newest version of each record; missing versions are oldest, later loads win, then the columns in `ties`."""
    return first_by(raw, [key], F.col(version).desc_nulls_last(), F.col(loaded).desc_nulls_last(), *[F.col(t) for t in ties])


def dup_rank(rows: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "dup_rank") -> DataFrame:
    """The row's place among those of its business key, from 1; nulls in the key are one value."""
    window = Window.partitionBy(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]).orderBy(*order)
    return rows.withColumn(out, F.row_number().over(window).cast("long"))


def new_versions(batch: DataFrame, stored: DataFrame, key: str = "source_record_id", version: str = "updated_at", *ties: str) -> DataFrame:
    """The batch's rows whose (key, version) isn't stored, once each, the last by `ties`; a missing version is the epoch."""
    when = F.coalesce(F.col(version), epoch())
    once = first_by(batch.withColumn("_v", when), [key, "_v"], *[F.col(t).desc_nulls_last() for t in ties or (key,)])
    known = stored.select(F.col(key).alias("_key"), when.alias("_known"))
    return once.join(known, (F.col(key) == F.col("_key")) & (F.col("_v") == F.col("_known")), "left_anti").drop("_v")


def watermark(stored: DataFrame, version: str = "updated_at") -> datetime | None:
    """The largest stored version, or None."""
    return stored.agg(F.max(version)).head()[0]


def since(rows: DataFrame, stored: DataFrame, version: str) -> DataFrame:
    """Rows after the stored watermark, which stays a scalar subquery of the plan."""
    mark = stored.agg(F.coalesce(F.max(version), epoch()).alias("m")).select("m")
    return rows.where(F.col(version) > mark.scalar())


def replace_keys(target: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Delete and insert: the target without the delta's keys, and the delta."""
    return target.join(delta.select(key).distinct(), key, "left_anti").unionByName(delta)


def incremental(target: DataFrame, rows: DataFrame, key: str, version: str, full_refresh: bool = False) -> DataFrame:
    """The target after an incremental run; late and changed rows below the watermark need a full refresh."""
    return rows if full_refresh else replace_keys(target, since(rows, target, version), key)


def route_rejects(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(rows without a reason, rejected rows with theirs)."""
    marked = rows.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def record_id(*parts: Column) -> Column:
    """Key parts without outer spaces, joined by bars; null if any is blank."""
    clean = [F.nullif(F.trim(p.cast("string")), F.lit("")) for p in parts]
    missing = clean[0].isNull()
    for p in clean[1:]:
        missing = missing | p.isNull()
    return F.when(~missing, F.concat_ws("|", *clean))


RUN_LOG = "run_id string, step string, status string, records long, at timestamp, error string"


class RunLog:
    """Runs as appended events; the state of a run is its latest event."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, run_id: str, step: str, status: str, records: int | None = None, error: str | None = None, at: datetime | None = None) -> None:
        row = [(run_id, step, status, records, at or datetime.now(), error)]
        self.spark.createDataFrame(row, RUN_LOG).write.mode("append").parquet(self.path)

    def state(self) -> DataFrame:
        events = self.spark.read.schema(RUN_LOG).parquet(self.path)
        return first_by(events, ["run_id"], F.col("at").desc(), (F.col("status") == "running").asc())
