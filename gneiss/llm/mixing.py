"""Mixing sources to target weights, to the exact word budget of each source.

Every document gets a key from a hash of its id, uniform and the same in every
run. Key ranges of equal width cut each source into `RANGES` pieces; sums of
the pieces give every piece its offset in its source, a sort inside the piece
gives every document its own. A source's budget is then cut at its exact word:
documents wholly before the cut are taken, the one across it in part, and a
budget of more than the source's size repeats it, epoch after epoch. No task
holds more than one piece of one source, however large the source is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hexadecimal digits of the key that name a piece: 16**3 key ranges for a source.
DIGITS = 3

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], percent: int, most: int) -> DataFrame:
    """sizes(source, source_size) with each source's target.

    Sources in order of code points, null last, weigh `weights` in turn and
    share `percent` % of all sizes; a target stops at `most` times its source's
    size, and the excess is shared again by weight. That fixed point is
    reached in one pass: by falling weight per size, sources are full until
    the share of a unit of weight no longer fills the next one. There is one
    row for each source here, never one for each document.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank - 1) % len(weights) + 1))
    order = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    filled = (
        weighed.withColumn("room", (F.lit(most) * F.col("source_size")).cast("double"))
        .withColumn("left", F.sum("source_size").over(every) * (percent / 100) - F.coalesce(F.sum("room").over(before), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("weight_left"))
        .withColumn("open", F.col("level") * F.col("weight") < F.col("room"))
    )
    level = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return filled.withColumn("flat", level).select("source", "source_size", F.when(F.col("flat").isNull(), F.col("room")).otherwise(F.least("room", F.col("flat") * F.col("weight"))).alias("target"))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), percent: int = 150, most: int = 2) -> DataFrame:
    """docs(doc_id, source, text) with size, source_size, target and taken; the order is doc_id, source, size, ...

    size: words of the text, 0 for null or blank; such rows stay, with nothing
    taken. taken: words that the mix takes of the row, repeats counted; a
    source's rows sum to its target rounded down. Sources differ by code point;
    null is a source of its own. Equal doc_ids (null too) sort by size, and rows
    that are equal in both are interchangeable. Columns besides the three are
    left out; an empty table gives an empty result.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", "source", word_count(F.col("text").cast("string")).alias("size"), key.alias("key"))
    rows = rows.withColumn("piece", F.substring("key", 1, DIGITS))
    pieces = rows.groupBy("source", "piece").agg(F.sum("size").alias("piece_size"))
    targets = source_targets(pieces.groupBy("source").agg(F.sum("piece_size").alias("source_size")), weights, percent, most)
    by_key = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.withColumn("offset", F.coalesce(F.sum("piece_size").over(by_key), F.lit(0)))
    offsets = offsets.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(F.col("source").alias("in_source"), F.col("piece").alias("in_piece"), "offset", "source_size", "target")
    inside = Window.partitionBy("source", "piece").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(offsets, F.col("source").eqNullSafe(F.col("in_source")) & (F.col("piece") == F.col("in_piece")))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    partly = F.least(F.greatest(rest - F.col("offset") - F.col("ahead"), F.lit(0)), F.col("size"))
    return placed.select("doc_id", "source", "size", "source_size", "target", (epochs * F.col("size") + partly).cast("long").alias("taken"))
