"""Quality tests that return their violations, column profiles, and a gate before publishing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.operators.lineage import cut


def unique(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNotNull()).groupBy(column).count().where("count > 1")


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


def accepted_values(rows: DataFrame, column: str, values: Sequence) -> DataFrame:
    return rows.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def relationship(rows: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias("_key"))
    return rows.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_key"), "left_anti")


def within_range(rows: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    c = F.col(column)
    out = F.lit(False)
    if low is not None:
        out = out | (c < low)
    if high is not None:
        out = out | (c > high)
    return rows.where(out)


def not_in_future(rows: DataFrame, column: str, as_of: Column) -> DataFrame:
    return rows.where(F.col(column) > as_of)


def ordered(rows: DataFrame, first: str, second: str) -> DataFrame:
    return rows.where(F.col(second) < F.col(first))


def auto_below_threshold(matches: DataFrame, threshold: float) -> DataFrame:
    return matches.where((F.col("match_method") == "fuzzy") & (F.col("match_score") < threshold))


def review_also_matched(review: DataFrame, matches: DataFrame) -> DataFrame:
    auto = matches.where(F.col("match_method") == "fuzzy").select("mention_id")
    return review.join(auto, "mention_id", "left_semi")


def missing_fields(required: Sequence[str], rows: DataFrame) -> list[str]:
    """Required names that the source's columns don't have; a load with any should fail before it starts."""
    return sorted(set(required) - set(rows.columns))


@dataclass(frozen=True)
class Check:
    """A named frame of violations; more than `warn` of them warn, more than `error` fail."""

    name: str
    violations: DataFrame
    warn: int = 0
    error: int = 0


def report(checks: Sequence[Check]) -> DataFrame:
    """name, violations and status of each check, in one job."""
    def line(c: Check) -> DataFrame:
        n = F.count("*")
        status = F.when(n > c.error, "error").when(n > c.warn, "warn").otherwise("pass")
        return c.violations.agg(F.lit(c.name).alias("name"), n.alias("violations"), status.alias("status"))

    return reduce(DataFrame.unionByName, map(line, checks))


def gate(checks: Sequence[Check]) -> None:
    """Raises if any check fails; publishing comes after it."""
    failed = [r.name for r in report(checks).where("status = 'error'").collect()]
    if failed:
        raise ValueError(f"quality checks failed: {', '.join(failed)}")


def column_profile(rows: DataFrame) -> DataFrame:
    """Rows, nulls, distinct values, range as text, and key and sparsity marks for each column; one scan."""
    measures = []
    for c in rows.columns:
        x = F.col(c)
        measures.append(F.struct(F.lit(c).alias("column"), F.count("*").alias("n_rows"), F.count_if(x.isNull()).alias("n_null"), F.count_distinct(x).alias("n_distinct"), F.min(x).cast("string").alias("low"), F.max(x).cast("string").alias("high")))
    one = rows.agg(F.array(*measures).alias("m")).select(F.inline("m"))
    return one.withColumns({"is_key": (F.col("n_null") == 0) & (F.col("n_distinct") == F.col("n_rows")), "sparse": F.col("n_null") * 2 > F.col("n_rows")})


def top_values(rows: DataFrame, column: str, k: int = 3) -> DataFrame:
    """The k most frequent non-null values, ties to the smallest."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), "value").limit(k)


def duplicated_rows(rows: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one in all columns."""
    return rows.groupBy(*rows.columns).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))


def fill_rates(rows: DataFrame, **columns: str) -> DataFrame:
    """Percent of rows where each column is there, to two digits."""
    return rows.agg(*[F.round(100 * F.avg(F.col(c).isNotNull().cast("double")), 2).alias(k) for k, c in columns.items()])


def percent_ranks(rows: DataFrame, partitions: int | None = None, **ranks: Column) -> DataFrame:
    """rows with a percent rank over all of them for each named numeric expression, without a one-partition sort.

    All expressions are ranked in one pass: their values are counted by
    (expression, value), dealt by range once, summed within each range and
    offset by the sums of the ranges before. The table of ranges has a row for
    each partition and expression; `partitions` sets the number of ranges, else
    it follows the session. Values are compared as doubles, nulls first.
    """
    rows = cut(rows)
    measures = F.array(*[F.struct(F.lit(k).alias("m"), value.cast("double").alias("v")) for k, value in enumerate(ranks.values())])
    counts = rows.select(F.inline(measures)).groupBy("m", "v").agg(F.count("*").alias("k"))
    placed = counts.repartitionByRange(*([partitions] if partitions else []), "m", "v").withColumn("p", F.spark_partition_id())
    ahead = Window.partitionBy("p", "m").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut(placed.withColumn("before", F.coalesce(F.sum("k").over(ahead), F.lit(0))))
    ranges = placed.groupBy("p", "m").agg(F.sum("k").alias("s"))
    ranges = ranges.select("p", "m", F.coalesce(F.sum("s").over(Window.partitionBy("m").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"), F.sum("s").over(Window.partitionBy("m")).alias("n"))
    placed = cut(placed.join(F.broadcast(ranges), ["p", "m"]).select("m", "v", ((F.col("before") + F.col("start")) / F.greatest(F.col("n") - 1, F.lit(1))).alias("rank")))
    out = rows
    for k, (name, value) in enumerate(ranks.items()):
        rank = placed.where(F.col("m") == k).select(F.col("v").alias(f"_{name}"), F.col("rank").alias(name))
        out = out.join(rank, value.cast("double").eqNullSafe(F.col(f"_{name}"))).drop(f"_{name}")
    return out
