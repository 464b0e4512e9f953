"""Near-duplicate lines by a segment-partition edit join, in DataFrame operations only.

A line of length l is cut into `distance` + 1 segments. By the pigeonhole
principle one segment of the shorter of two lines within that edit distance
occurs unchanged in the longer one, at an offset that the lengths bound; only
those substrings are probed, each as one hashed key. Keys that a single line
has are dropped; a key with more than `crowd` lines is refined by segments of
what remains of its lines beside the shared segment, level by level, so that
common beginnings and endings don't meet all pairs of their lines. Pairs whose letter counts differ by more than
the distance allows are not made. The others are verified on their texts: common ends are stripped by bisection, and
the rest is compared by a bit-parallel banded edit distance, one word of
2 * distance + 1 bits for each column.

Lines are compared by code points. Two edits are too many for short lines;
these are compared exactly, where asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.operators.lineage import cut, small

#: Lines that occur so often send their keys once, not from every occurrence.
OFTEN = 64
LEVELS = 4
#: Letters whose counts are compared before a pair is made.
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _probes(distance: int) -> list[tuple[int, int, int]]:
    """(length difference, segment, shift) of every substring to probe; (0, i, 0) are the line's own segments."""
    out = []
    for shorter in range(distance + 1):
        for i in range(distance + 1):
            low, high = max(-i, shorter - (distance - i)), min(i, shorter + (distance - i))
            out += [(shorter, i, shift) for shift in range(low, high + 1)]
    return out


def segment_keys(lines: DataFrame, distance: int) -> DataFrame:
    """(id, key, own, at, width) for lines(id, line, own, base); own: the line's segment, not a probe of it.

    Segment i of a line of n code points has n div parts of them, one more for
    the last n mod parts segments. The probes are rows of a literal, so that
    one small formula makes all keys and its code stays within what the JVM
    compiles.
    """
    parts = distance + 1
    table = F.array(*[F.struct(*[F.lit(x).alias(c) for c, x in zip(("shorter", "i", "shift"), p)]) for p in _probes(distance)])
    rows = lines.withColumn("n", F.length("line")).select("*", F.explode(table).alias("p")).select("id", "line", "base", "n", "own", "p.*").where("n >= shorter")
    rows = rows.withColumns({"size": F.expr(f"cast((n - shorter) div {parts} as int)"), "extra": F.expr(f"(n - shorter) % {parts}")})
    rows = rows.withColumns({"at": F.expr(f"size * i + greatest(0, i + extra - {parts}) + shift"), "width": F.expr(f"size + if(i >= {parts} - extra, 1, 0)")})
    rows = rows.where("at >= 0 and at + width <= n")
    return rows.selectExpr("id", "xxhash64(substring(line, at + 1, width), n - shorter, i, base) as key", "own and shorter = 0 and shift = 0 as own", "at", "width")


def with_distance(pairs: DataFrame, distance: int) -> DataFrame:
    """pairs(line_a, line_b, ...) with `edits`: their edit distance if at most `distance`, else a larger number.

    Bit k of a word is row column - distance + k of the table. The score
    follows the lowest diagonal of the band; the rows of the last column below
    the pattern's end are taken off it by their vertical differences. A line
    whose score rules out the distance is passed over to its end.
    """
    d, full = distance, (1 << (2 * distance + 1)) - 1
    steps = ", ".join(str(1 << k) for k in range(30, -1, -1))
    room = "least(length(ua), length(ub)) div 4"
    # equal ends, by bisection on whole code points of four bytes
    head = f"aggregate(array({steps}), 0, (n, w) -> if(w <= {room} - n and substring(ua, 4 * n + 1, 4 * w) = substring(ub, 4 * n + 1, 4 * w), n + w, n))"
    tail = f"aggregate(array({steps}), 0, (n, w) -> if(w <= {room} - head - n and substring(ua, length(ua) - 4 * (n + w) + 1, 4 * w) = substring(ub, length(ub) - 4 * (n + w) + 1, 4 * w), n + w, n))"
    chars = "if(length({0}) = 0, cast(array() as array<binary>), transform(sequence(0, length({0}) div 4 - 1), i -> substring({0}, 4 * i + 1, 4)))"
    equal = " | ".join(f"if(try_element_at(p, s.j + {k}) = t, {1 << k}L, 0L)" for k in range(2 * d + 1))
    scan = f"""
      aggregate(t, named_struct('j', 1, 'vp', {full & ~((1 << d) - 1)}L, 'vn', 0L, 'score', {d}),
        (s, t) -> if(s.score > {3 * d}, s,
          transform(transform(array({equal}), eq -> named_struct('eq', eq, 'd0', ((((eq & s.vp) + s.vp) ^ s.vp) | eq | s.vn) & {full}L)), y ->
            named_struct('j', s.j + 1,
              'vp', ((s.vp & y.d0) | ~(shiftright(y.d0, 1) | (s.vn | ~(y.d0 | s.vp)))) & {full}L,
              'vn', (shiftright(y.d0, 1) & (s.vn | ~(y.d0 | s.vp))) & {full}L,
              'score', s.score + if((y.d0 & {1 << (2 * d)}L) <> 0L, 0, 1)))[0]))"""
    below = f"({full >> 1}L & ~(shiftleft(1L, cast(greatest(m - n + {d}, 0) as int)) - 1L))"
    out = pairs.withColumns({"ua": F.encode("line_a", "UTF-32"), "ub": F.encode("line_b", "UTF-32")})
    out = out.withColumn("head", F.expr(head)).withColumn("tail", F.expr(tail))
    for c in ("ua", "ub"):
        out = out.withColumn(c, F.expr(f"substring({c}, 4 * head + 1, length({c}) - 4 * (head + tail))"))
    out = out.withColumns({"m": F.expr("length(ua) div 4"), "n": F.expr("length(ub) div 4"), "p": F.expr(f"concat(array_repeat(cast(null as binary), {d}), {chars.format('ua')})"), "t": F.expr(chars.format("ub"))})
    out = out.withColumn("s", F.when(F.abs(F.col("m") - F.col("n")) <= d, F.expr(scan)))
    edits = f"if(s is null or s.score > {3 * d}, {d + 1}, s.score - bit_count(s.vp & {below}) + bit_count(s.vn & {below}))"
    return out.withColumn("edits", F.expr(edits)).drop("ua", "ub", "head", "tail", "m", "n", "p", "t", "s")


def _lines(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, line_no, line, id, check) of the lines of at least `least` code points."""
    return _named(docs, F.length("line") >= least)


def _named(docs: DataFrame, which: Column) -> DataFrame:
    """(doc_id, line_no, line, id, check) of the lines that meet `which`."""
    out = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).where(which)
    return out.withColumns({"id": F.xxhash64("line"), "check": F.xxhash64(F.lit(7), "line")})


def _meeting(keys: DataFrame) -> DataFrame:
    """The keys that two or more lines have."""
    met = keys.selectExpr("*", "min(id) over (partition by key) as low", "max(id) over (partition by key) as high").where("low <> high")
    return cut(met.drop("low", "high").distinct())


def _letter_counts(line: Column) -> Column:
    """Counts of letters, at most 1023 each; an edit changes them by 2 in all at most."""
    return F.array(*[F.least(F.length(line) - F.length(F.replace(line, F.lit(c), F.lit(""))), F.lit(1023)) for c in LETTERS])


def candidate_pairs(met: DataFrame, texts: DataFrame, distance: int, crowd: int) -> DataFrame:
    """Distinct pairs a < b of line ids that share a key, one's own segment being the other's probe.

    met: the first level's keys; texts(id, line, counts): the lines that have them. Pairs
    whose letter counts rule the distance out are not made.
    """
    counts = texts.select("id", "counts")
    near = " + ".join(f"abs(x[{k}] - y[{k}])" for k in range(len(LETTERS)))
    pairs = []
    for level in range(LEVELS):
        calm = met
        if level < LEVELS - 1:
            crowds = cut(met.groupBy("key").agg(F.countDistinct("id").alias("n")).where(F.col("n") > crowd).select("key"))
            busy = small(crowds, 8)
            calm = met.join(busy, "key", "left_anti")
        calm = cut(calm.join(counts, "id"))
        left, right = calm.where("own").selectExpr("key", "id as a", "counts as x"), calm.selectExpr("key", "id as b", "counts as y")
        found = left.join(right, (left.key == right.key) & F.expr(f"a <> b and coalesce({near} <= {2 * distance}, true)"))
        pairs.append(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        if level == LEVELS - 1 or not crowds.count():
            break
        crowded = met.join(busy, "key", "left_semi").withColumnRenamed("key", "base")
        rest = F.concat(F.substring(F.col("line"), F.lit(1), F.col("at")), F.substring(F.col("line"), F.col("at") + F.col("width") + 1, F.length("line")))
        met = _meeting(segment_keys(crowded.join(texts.select("id", "line"), "id").select("id", "own", "base", rest.alias("line")), distance))
    return cut(reduce(DataFrame.unionByName, pairs).distinct())


def line_links(docs: DataFrame, distance: int = 2, least: int = 32, crowd: int = 256) -> tuple[DataFrame, DataFrame]:
    """(occurrences, links) of docs(doc_id, text) with distinct doc_ids.

    occurrences(doc_id, line_no, id, check): lines of at least `least` code
    points; (id, check) names their text. links(id_a, check_a, id_b, check_b):
    every pair of different texts within `distance` edits, in one direction.
    """
    lines = _lines(docs, least)
    seen = cut(lines.select("doc_id", "line_no", "id", "check"))
    often = small(cut(seen.groupBy("id").count().where(F.col("count") >= OFTEN).select("id")), 8)
    once = lines.join(often, "id", "left_semi").groupBy("id").agg(F.min("line").alias("line"))
    fresh = lines.join(often, "id", "left_anti").select("id", "line").unionByName(once)
    met = _meeting(segment_keys(fresh.select("id", "line", F.lit(True).alias("own"), F.lit(0).cast("long").alias("base")), distance))
    asked = small(cut(met.select("id").distinct()), 8)
    texts = cut(lines.join(asked, "id", "left_semi").groupBy("id", "check").agg(F.min("line").alias("line")))
    # two texts of one id are never ruled out by counts
    by_id = cut(texts.groupBy("id").agg(F.min("line").alias("line"), F.count("*").alias("k")).select("id", "line", F.when(F.col("k") == 1, _letter_counts(F.col("line"))).alias("counts")))
    pairs = candidate_pairs(met, by_id, distance, crowd)
    a, b = (texts.select(F.col("id").alias(x), F.col("check").alias(f"check_{x}"), F.col("line").alias(f"line_{x}")) for x in "ab")
    met = pairs.join(a, "a").join(b, "b").where(F.abs(F.length("line_a") - F.length("line_b")) <= distance)
    met = met.selectExpr("a as id_a", "check_a", "b as id_b", "check_b", "line_a", "line_b")
    same_id = a.join(b.withColumnRenamed("b", "a2"), F.col("a") == F.col("a2")).where("check_a < check_b").selectExpr("a as id_a", "check_a", "a2 as id_b", "check_b", "line_a", "line_b")
    # the checkpoint keeps the filter from being pushed below, where it would repeat the whole comparison
    scored = cut(with_distance(met.unionByName(same_id), distance).drop("line_a", "line_b"))
    return seen, scored.where(F.col("edits") <= distance).drop("edits").distinct()


def repeated_lines(docs: DataFrame, distance: int = 2, least: int = 32, short: bool = False) -> DataFrame:
    """(doc_id, line_no, links) of the lines that line dedup removes, in one row each.

    In the order of (doc_id, line_no), a line goes if its text, or one within
    `distance` edits of it, came before; links counts the other texts within
    reach. Shorter lines than `least` always stay, or with `short` go if they
    have a word and the same line came before.
    """
    seen, links = line_links(docs, distance, least)
    if short:
        word = F.col("line").rlike(r"[^\x20\x09-\x0D]")
        seen = seen.unionByName(cut(_named(docs, (F.length("line") < least) & word).select("doc_id", "line_no", "id", "check")))
    texts = cut(seen.groupBy("id", "check").agg(F.min(F.struct("doc_id", "line_no")).alias("first")))
    both = links.unionByName(links.selectExpr("id_b as id_a", "check_b as check_a", "id_a as id_b", "check_a as check_b"))
    firsts = [texts.select(F.col("id").alias(f"id_{x}"), F.col("check").alias(f"check_{x}"), F.col("first").alias(f"first_{x}")) for x in "ab"]
    linked = both.join(firsts[0], ["id_a", "check_a"]).join(firsts[1], ["id_b", "check_b"])
    linked = linked.groupBy(F.col("id_a").alias("id"), F.col("check_a").alias("check")).agg(F.count("*").alias("links"), F.max(F.col("first_b") < F.col("first_a")).alias("later"))
    judged = texts.join(linked, ["id", "check"], "left")
    where = seen.join(judged, ["id", "check"])
    return where.where((F.struct("doc_id", "line_no") != F.col("first")) | F.coalesce("later", F.lit(False))).select("doc_id", "line_no", F.coalesce("links", F.lit(0)).alias("links"))


def dedup_lines(docs: DataFrame, distance: int = 2, least: int = 32, short: bool = False) -> DataFrame:
    """docs(doc_id, text, ...) with n_lines, n_removed and n_links added and repeated lines taken out of text.

    `short`: lines of less than `least` code points with a word are compared
    too, exactly. Lines are what "\n" parts; a null text stays null with 0 lines, an empty
    one has one empty line. n_links sums, over the removed lines, the other
    texts within reach. Rows with a null doc_id, and all rows of a doc_id that
    several rows have, pass unchanged. A text of which no line is left is empty.
    Columns of docs that are named like the added ones are replaced. An empty
    table gives an empty result.
    """
    added = ["n_lines", "n_removed", "n_links"]
    docs = docs.drop(*added)
    ids = docs.groupBy("doc_id").count()
    several = ids.where("count > 1 or doc_id is null").select("doc_id")
    one = docs if not several.limit(1).count() else docs.join(several, docs.doc_id.eqNullSafe(several.doc_id), "left_anti")
    gone = repeated_lines(one.select("doc_id", F.col("text").cast("string").alias("text")), distance, least, short)
    gone = cut(gone.groupBy(F.col("doc_id").alias("gone_id")).agg(F.array_sort(F.collect_list("line_no")).alias("gone"), F.sum("links").alias("n_links")))
    out = docs.join(small(gone, 96), F.col("doc_id") == F.col("gone_id"), "left")
    parts = F.split("text", "\n", -1)
    lost = F.coalesce(F.size("gone"), F.lit(0))
    kept = F.array_join(F.filter(parts, lambda _, i: ~F.array_contains(F.col("gone"), i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept)
    out = out.withColumns({"n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long"), "n_removed": lost.cast("long"), "n_links": F.coalesce("n_links", F.lit(0)).cast("long")})
    return out.withColumn("text", text).select(*docs.columns, *added)
