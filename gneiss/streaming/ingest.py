"""The streaming twin of the batch load: raw pages arrive as files, each micro-batch is appended once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gneiss.operators.versions import new_versions
from gneiss.sources.registry import Source, envelope


def append_new(batch: DataFrame, path: str) -> int:
    """Appends the batch's versions that the raw table at `path` lacks; how many. Running it again adds none."""
    spark = batch.sparkSession
    try:
        stored = spark.read.parquet(path).select("source_record_id", "updated_at")
    except Exception as e:  # noqa: BLE001 - the table's first batch
        if "PATH_NOT_FOUND" not in str(e):
            raise
        stored = spark.createDataFrame([], batch.select("source_record_id", "updated_at").schema)
    fresh = new_versions(batch, stored, "source_record_id", "updated_at", "ingested_at", "payload").persist()
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(path)
    fresh.unpersist()
    return n


def stream_pages(spark: SparkSession, pages_dir: str, src: Source, raw_path: str, reject_path: str, checkpoint: str, run_id: str = "stream") -> StreamingQuery:
    """Starts the load of JSON-line files as they appear; stops once what is there is done."""
    rows = spark.readStream.format("text").load(pages_dir).withColumnRenamed("value", "payload")

    def load(batch: DataFrame, _: int) -> None:
        marked = envelope(batch, src, run_id).persist()
        append_new(marked.where("reason is null").drop("reason"), raw_path)
        marked.where("reason is not null").write.mode("append").parquet(reject_path)
        marked.unpersist()

    return rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str = "ts", kind: str = "event_type", width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts by event-time window and kind; a stream keeps state only as long as events may come late."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), kind, "n")
