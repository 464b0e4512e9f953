"""Profiles, evaluations and timings as Markdown or JSON, and their command line.

python -m gneiss.plans.reports profile TABLE_PATH
python -m gneiss.plans.reports evaluate WAREHOUSE [--pairs CSV] [--sample N] [--seed S]
python -m gneiss.plans.reports benchmark WAREHOUSE
"""

from __future__ import annotations

import argparse
import json
import logging
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.functions import names
from gneiss.functions.convert import coordinates, local_timestamp
from gneiss.functions.fixed import STREET_SUFFIXES
from gneiss.functions.similarity import name_similarity, token_set_ratio
from gneiss.operators import matching, quality
from gneiss.operators.lineage import cut
from gneiss.plans.pipeline import Warehouse


class JsonLines(logging.Formatter):
    """One JSON object a line; what a call gives as extra becomes keys of it."""

    _PLAIN = set(vars(logging.makeLogRecord({}))) | {"message", "asctime"}

    def format(self, record: logging.LogRecord) -> str:
        extra = {k: v for k, v in vars(record).items() if k not in self._PLAIN}
        return json.dumps({"level": record.levelname, "logger": record.name, "message": record.getMessage(), **extra}, default=str)


def markdown(rows: DataFrame, title: str) -> str:
    """A small frame as a Markdown table."""
    lines = [f"## {title}", "", "| " + " | ".join(rows.columns) + " |", "|" + "-|" * len(rows.columns)]
    lines += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows.collect()]
    return "\n".join(lines) + "\n"


def date_ranges(rows: DataFrame, now: str) -> DataFrame:
    """Range, unparseable and future values of every column named like a date; one row each."""
    found = [c for c in rows.columns if re.search(r"date|_dd$", c, re.I)]
    parts = []
    for c in found:
        text = F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
        at = local_timestamp(text)
        parts.append(F.struct(F.lit(c).alias("column"), F.min(at).alias("low"), F.max(at).alias("high"), F.count_if(text.isNotNull() & at.isNull()).alias("unparseable"), F.count_if(at > F.lit(now).cast("timestamp_ntz") + F.expr("interval 1 day")).alias("future")))
    if not parts:
        return rows.sparkSession.createDataFrame([], "column string, low timestamp_ntz, high timestamp_ntz, unparseable long, future long")
    return rows.agg(F.array(*parts).alias("p")).select(F.inline("p"))


def coordinate_check(rows: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows without coordinates and rows with some outside of the city."""
    there = F.col(lat).cast("string").try_cast("double").isNotNull() & F.col(lon).cast("string").try_cast("double").isNotNull()
    inside = coordinates(F.col(lat).cast("string"), F.col(lon).cast("string"))[0].isNotNull()
    return rows.agg(F.count_if(~there).alias("missing"), F.count_if(there & ~inside).alias("outside"))


def suffix_spellings(rows: DataFrame, column: str) -> DataFrame:
    """Street suffixes that the column's last words spell in several ways."""
    known = [(s, name) for name, others in STREET_SUFFIXES.items() for s in [name, *others]]
    table = F.array(*[F.struct(F.lit(a).alias("spelling"), F.lit(b).alias("suffix")) for a, b in known])
    names_ = rows.sparkSession.range(1).select(F.inline(table))
    last = rows.select(F.element_at(F.split(F.trim(F.upper(column)), r"\s+"), -1).alias("spelling")).groupBy("spelling").count()
    met = last.join(names_, "spelling").groupBy("suffix").agg(F.array_sort(F.collect_list(F.struct("spelling", "count"))).alias("spellings"))
    return met.where("size(spellings) > 1")


def labelled_pairs(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of name_a, name_b, is_org and label (match or nonmatch), names in comparable form."""
    rows = spark.read.option("header", True).csv(path)
    return rows.select(names.name(F.col("name_a")).alias("name_a"), names.name(F.col("name_b")).alias("name_b"), (F.col("is_org") == "1").alias("is_org"), (F.col("label") == "match").cast("int").alias("label"))


def hash_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows by the order of a seeded hash of their key; the same rows in every run."""
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)


def evaluation(w: Warehouse, pairs: str | None = None, sample: int = 20_000, seed: int = 7) -> str:
    """Blinded property bands, and the name rules beside plain set ratios."""
    known = hash_sample(w.read("er.property_mentions").where("bbl is not null"), "mention_id", sample, seed)
    outcomes = cut(matching.blinded_outcomes(known, w.read("clean.pluto_lots")))
    out = markdown(matching.blinded_evaluation(outcomes), "Property matching, lots hidden") + "\n" + markdown(matching.blinded_measures(outcomes), "All bands")
    if pairs:
        rows = labelled_pairs(w.spark, pairs)
        a, b = F.col("name_a"), F.col("name_b")
        out += "\n" + markdown(matching.name_evaluation(rows, name_similarity(a, b, F.col("is_org"))), "Name rules")
        out += "\n" + markdown(matching.name_evaluation(rows, token_set_ratio(a, b)), "Set ratios alone")
    return out


def benchmark(w: Warehouse) -> dict[str, float]:
    """Records and seconds of each step's runs that succeeded."""
    e = w.runs.state().where("status = 'success'")
    events = w.spark.read.parquet(w.runs.path).groupBy("run_id").agg((F.max("at").cast("double") - F.min("at").cast("double")).alias("s"))
    rows = e.join(events, "run_id").groupBy("step").agg(F.sum("records").alias("records"), F.round(F.sum("s"), 3).alias("seconds"))
    return {r.step: {"records": r.records, "seconds": r.seconds} for r in rows.collect()}


if __name__ == "__main__":
    from gneiss.session import session

    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("report", choices=["profile", "evaluate", "benchmark"])
    p.add_argument("path")
    p.add_argument("--pairs")
    p.add_argument("--sample", type=int, default=20_000)
    p.add_argument("--seed", type=int, default=7)
    a = p.parse_args()
    spark = session("gneiss reports")
    if a.report == "profile":
        print(markdown(quality.column_profile(spark.read.parquet(a.path)), a.path))
    elif a.report == "evaluate":
        print(evaluation(Warehouse(spark, a.path), a.pairs, a.sample, a.seed))
    else:
        print(json.dumps(benchmark(Warehouse(spark, a.path)), indent=2))
