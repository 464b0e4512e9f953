"""Removal of byte strings that repeat, by column-wise suffix ordering of document pieces.

A string of `length` bytes repeats if it starts anywhere else in the corpus.
Suffix arrays of whole corpora don't part over machines, so the suffixes that
can decide are found first:

1. Anchors. In each window of `length` bytes the smallest hash of its
   `length` / 2-byte substrings (the leftmost of equals) is the window's
   anchor. Equal windows have the same anchor at the same place, so windows
   need only be compared with others of their anchor. The windows of one
   anchor occurrence overlap; they are one segment. Anchors of a single
   occurrence repeat nothing, those whose segments are all alike repeat
   everything; neither needs bytes.
2. Columns. The distinct segments of the other anchors are parted by anchor
   into collections. In a collection suffixes are ordered from the last column
   to the first: each round inserts one symbol of every segment into the
   collection's Burrows-Wheeler transform at the position that the last-first
   mapping gives, and updates the longest common prefixes beside it. The
   anchor's bytes, alike in all its segments, are one symbol that counts for
   them all. A window whose suffix shares `length` bytes with a neighbour
   repeats. The transform and prefixes of a collection are flat sequential
   arrays, mapped from files of the task once a collection outgrows
   `IN_MEMORY` suffixes.
3. Crowds. Anchors with more than `CROWD` different segments go into no
   collection: 128-bit hashes of their windows are grouped over all tasks, and
   windows whose hash occurs twice repeat.

Documents that equal another wholly are taken out before (they repeat as a
whole) but for one, so that groups of copies never meet.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.text import Texts, mix, powers, slices, small_batches
from gneiss.operators.lineage import cut, small

#: Segments of one collection, whose columns stay in a core's cache; an anchor of more has a collection of its own.
COLLECTION = 1024
#: The windows of anchors with more different segments are compared by their hashes, over all tasks.
CROWD = 20_000
IN_MEMORY = 40_000_000
NONE = np.uint16(0xFFFF)


def window_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` neighbours, from the left."""
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    n = max(len(values) - width + 1, 0)
    return np.minimum(out[:n], out[width - span :][:n])


def segments(texts: Texts, length: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, segment hash, first window, number of windows, anchor's place) of every anchor occurrence, in buffer positions."""
    n, k = len(texts.data), length // 2
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    prefix = texts.prefix_hash()
    _, down = powers(n + 1)
    h = mix((prefix[k:] - prefix[:-k]) * down[: n - k + 1])
    least = window_min((h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64), length - k + 1)
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.zeros(n + 1, np.int64)
    full = texts.lengths >= length
    np.add.at(edge, texts.offsets[:-1][full], 1)
    np.add.at(edge, texts.offsets[1:][full] - length + 1, -1)
    p = np.flatnonzero(np.cumsum(edge[: len(anchor)]) > 0)
    a = anchor[p]
    new = np.ones(len(p), bool)
    new[1:] = (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(p)]]))
    first, a = p[first], a[first]
    seg = texts.span_hash(first, first + count + length - 1, prefix) + mix((a - first).astype(np.uint64))
    return h[a], seg, first, count, a


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low:high] for each pair, low < high, by doubling."""
    out = np.zeros(len(low), values.dtype)
    level = np.log2(np.maximum(high - low, 1)).astype(np.int64)
    table = values
    for k in range(int(level.max(initial=0)) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[low[at]], table[high[at] - (1 << k)])
        table = np.minimum(table[: -(1 << k)], table[1 << k :]) if len(table) > (1 << k) else table
    return out


class Columns:
    """Column-wise construction of a collection's Burrows-Wheeler transform and common prefixes.

    lefts and rights are the bytes beside each segment's anchor, anchors their
    numbers from 0; `k` is the anchor's length.
    """

    def __init__(self, lefts: list[bytes], rights: list[bytes], anchors: np.ndarray, k: int):
        self.left, self.right = (np.array([len(x) for x in y], np.int64) for y in (lefts, rights))
        self.k, n = k, len(lefts)
        size = self.left + self.right + 1
        self.ends = np.cumsum(size)
        self.symbols = np.empty(size.sum(), np.uint16)
        for x, y, a, e, s in zip(lefts, rights, anchors.tolist(), self.ends.tolist(), size.tolist()):
            at = e - s
            self.symbols[at : at + len(x)] = np.frombuffer(x, np.uint8)
            self.symbols[at + len(x)] = 256 + a
            self.symbols[at + len(x) + 1 : e] = np.frombuffer(y, np.uint8)
        self.size = size
        self.bwt, self.lcp, self.who = self._room(n)
        self.bwt[:] = self.symbols[self.ends - 1]
        self.lcp[:] = 0
        self.who[:] = np.arange(n) << 16
        self.fresh = np.arange(n)
        for depth in range(1, int(size.max(initial=0)) + 1):
            self._insert(depth)

    def _room(self, n: int) -> tuple[np.ndarray, ...]:
        kinds = (np.uint16, np.uint16, np.int64)
        if n < IN_MEMORY:
            return tuple(np.empty(n, t) for t in kinds)
        return tuple(np.memmap(tempfile.TemporaryFile(), t, "w+", shape=n) for t in kinds)

    def _insert(self, depth: int) -> None:
        """Inserts the suffix of `depth` symbols of every segment that has one."""
        n, old = len(self.size), self.bwt
        order = np.argsort(old, kind="stable")
        order = order[: len(order) - int((old == NONE).sum())]
        is_fresh = np.zeros(len(old), bool)
        is_fresh[self.fresh] = True
        new = is_fresh[order]
        k = np.flatnonzero(new)
        at = np.flatnonzero(np.concatenate([np.ones(n, bool), ~new]))
        bwt, lcp, who = self._room(n + len(order))
        # what was there keeps its order: the empty suffixes, then each suffix whose first symbol was inserted before
        bwt[at], lcp[at], who[at] = self.bwt, self.lcp, self.who
        owner = self.who[order[k]] >> 16
        where = self.ends[owner] - depth - 1
        bwt[n + k] = np.where(depth < self.size[owner], self.symbols[np.maximum(where, 0)], NONE)
        who[n + k] = (owner << 16) | depth
        # prefixes of the inserted ones and of those after them
        after = k[np.append(k[1:] != k[:-1] + 1, True)[: len(k)]] + 1
        change = np.sort(np.concatenate([k, after]), kind="stable")
        change = change[change < len(order)]
        c = old[order]
        same = (change > 0) & (c[change] == c[change - 1])
        lcp[n + change[~same]] = 0
        inner = change[same]
        step = np.where(c[inner] >= 256, self.k, 1).astype(np.uint16)
        lcp[n + inner] = step + _range_min(self.lcp, order[inner - 1] + 1, order[inner] + 1)
        self.bwt, self.lcp, self.who, self.fresh = bwt, lcp, who, n + k

    def repeated(self, length: int) -> np.ndarray:
        """(segment, window) of every window of `length` bytes that two or more suffixes of the collection begin with."""
        long = self.lcp >= length
        hit = long.copy()
        hit[:-1] |= long[1:]
        owner, depth = self.who[hit] >> 16, self.who[hit] & 0xFFFF
        return np.stack([owner, self.left[owner] - (depth - self.right[owner] - 1)], 1)


def collection_repeats(segs: list[bytes], places: np.ndarray, anchors: np.ndarray, length: int) -> list[np.ndarray]:
    """For each segment the windows that repeat in the collection; places: where the anchor is in it."""
    k = length // 2
    _, number = np.unique(anchors, return_inverse=True)
    columns = Columns([s[:p] for s, p in zip(segs, places)], [s[p + k :] for s, p in zip(segs, places)], number, k)
    pairs = columns.repeated(length)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    ptr = np.searchsorted(pairs[:, 0], np.arange(len(segs) + 1))
    return [np.sort(pairs[a:b, 1]) for a, b in zip(ptr, ptr[1:])]


def _runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of successive numbers."""
    gap = np.flatnonzero(np.diff(at) > 1)
    return at[np.concatenate([[0], gap + 1])], at[np.concatenate([gap, [len(at) - 1]])]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch):
            h = [hashlib.blake2b(texts.data[a:b].tobytes(), digest_size=16).digest() for a, b in zip(texts.offsets, texts.offsets[1:])]
            t = np.frombuffer(b"".join(h), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts.lengths), pa.array(t[:, 0]), pa.array(t[:, 1])], ["doc_id", "n_bytes", "t0", "t1"])


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                anchor, seg, first, count, _ = segments(texts, length)
                text = np.searchsorted(texts.offsets, first, side="right") - 1
                doc = part.column("doc_id").take(pa.array(text))
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(seg.view(np.int64)), doc, pa.array((first - texts.offsets[text]).astype(np.int32)), pa.array(count.astype(np.int32))], ["anchor", "seg", "doc_id", "first", "n"])

    return run


def _fetch(length: int):
    """The bytes of the segments that are asked for of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                asked = part.column("asked")
                n = asked.value_lengths().to_numpy(zero_copy_only=False)
                rows = asked.flatten()
                cols = {c: rows.field(c) for c in ("anchor", "seg", "first", "n", "copies")}
                start = cols["first"].to_numpy() + np.repeat(texts.offsets[:-1], n)
                end = start + cols["n"].to_numpy() + length - 1
                raw = texts.data.tobytes()
                cols["bytes"] = pa.array([raw[a:b] for a, b in zip(start.tolist(), end.tolist())], pa.binary())
                # the place of the anchor: the smallest hash of the segment's middle, as when it was chosen
                place = _places(texts, start, end, length)
                yield pa.RecordBatch.from_arrays([cols["anchor"], cols["seg"], cols["copies"], cols["bytes"], pa.array(place.astype(np.int32))], ["anchor", "seg", "copies", "bytes", "place"])

    return run


def _places(texts: Texts, start: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    _, _, first, _, at = segments(texts, length)
    return at[np.searchsorted(first, start)] - start


def _compare(length: int):
    """Repeated windows of a partition's segments, sorted by anchor, collection by collection."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        windows = collection_repeats(rows.column("bytes").to_pylist(), rows.column("place").to_numpy(), rows.column("anchor").to_numpy(), length)
        out = {c: [] for c in ("anchor", "seg", "low", "high")}
        for anchor, seg, at in zip(rows.column("anchor").to_pylist(), rows.column("seg").to_pylist(), windows):
            if len(at):
                low, high = _runs(at)
                out["anchor"] += [anchor] * len(low)
                out["seg"] += [seg] * len(low)
                out["low"] += low.tolist()
                out["high"] += high.tolist()
        return pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in (("anchor", pa.int64()), ("seg", pa.int64()), ("low", pa.int32()), ("high", pa.int32()))], list(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            for a in range(0, batch.num_rows, COLLECTION):
                held.append(batch.slice(a, COLLECTION))
                rows += held[-1].num_rows
                if rows >= COLLECTION:
                    table = pa.Table.from_batches(held)
                    anchor = table.column("anchor").to_numpy()
                    whole = int(np.flatnonzero(anchor != anchor[-1])[-1]) + 1 if (anchor != anchor[-1]).any() else 0
                    if whole:
                        yield solve(table.slice(0, whole))
                        held = table.slice(whole).to_batches()
                        rows = table.num_rows - whole
        if rows:
            yield solve(pa.Table.from_batches(held))

    return run


def _window_hashes(length: int):
    """(anchor, seg, low, h0, h1) of every window of the segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, s, raw in zip(batch.column("anchor").to_pylist(), batch.column("seg").to_pylist(), batch.column("bytes").to_pylist()):
                n = len(raw) - length + 1
                h = np.frombuffer(b"".join(hashlib.blake2b(raw[k : k + length], digest_size=16).digest() for k in range(n)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, a)), pa.array(np.full(n, s)), pa.array(np.arange(n, dtype=np.int32)), pa.array(h[:, 0]), pa.array(h[:, 1])], ["anchor", "seg", "low", "h0", "h1"])

    return run


def repeated_windows(pieces: DataFrame, length: int, crowd: int) -> DataFrame:
    """(anchor, seg, low, high): ranges of windows of pieces(anchor, seg, bytes, place) that other pieces have too."""
    schema = "anchor long, seg long, low int, high int"
    crowds = small(cut(pieces.groupBy("anchor").count().where(F.col("count") > crowd).select("anchor")), 8)
    calm = pieces.join(crowds, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    windows = pieces.join(crowds, "anchor", "left_semi").mapInArrow(_window_hashes(length), "anchor long, seg long, low int, h0 long, h1 long")
    twice = windows.groupBy("h0", "h1").count().where("count > 1").select("h0", "h1")
    crowded = windows.join(twice, ["h0", "h1"], "left_semi").selectExpr("anchor", "seg", "low", "low as high")
    return calm.mapInArrow(_compare(length), schema).unionByName(crowded)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and touching spans of a document joined; rows are sorted by doc_id and start."""
    for batch in batches:
        if not batch.num_rows:
            continue
        doc, a, b = (batch.column(c).to_numpy() for c in ("doc_id", "a", "b"))
        number = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]])).astype(np.int64) << 40
        reach = np.maximum.accumulate(number + b)
        new = np.ones(len(a), bool)
        new[1:] = number[1:] + a[1:] > reach[:-1]
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:] - 1, [len(a) - 1]])
        yield pa.RecordBatch.from_arrays([pa.array(doc[first]), pa.array(a[first]), pa.array(((reach - number)[last]).astype(np.int64))], ["doc_id", "a", "b"])


def repeated_spans(docs: DataFrame, length: int, crowd: int = CROWD) -> DataFrame:
    """(doc_id, a, b): byte spans that cover what repeats in docs(doc_id, text); every text is distinct from the others."""
    rows = docs.mapInArrow(_anchors(length), "anchor long, seg long, doc_id long, first int, n int")
    met = rows.selectExpr("*", "min(seg) over (partition by anchor) as s0", "max(seg) over (partition by anchor) as s1", "count(1) over (partition by anchor) as times").where("times > 1")
    met = cut(met.selectExpr("anchor", "seg", "doc_id", "first", "n", "s0 = s1 as alike"))
    mixed = met.where("not alike")
    kinds = mixed.groupBy("anchor", "seg").agg(F.min(F.struct("doc_id", "first", "n")).alias("at"), F.count("*").alias("copies"))
    asked = kinds.groupBy(F.col("at.doc_id").alias("doc_id")).agg(F.collect_list(F.struct("anchor", "seg", F.col("at.first").alias("first"), F.col("at.n").alias("n"), "copies")).alias("asked"))
    asked = cut(asked)
    total = asked.agg(F.sum(F.size("asked"))).head()[0] or 0
    pieces = docs.join(F.broadcast(asked) if total * 48 <= 32 << 20 else asked, "doc_id").mapInArrow(_fetch(length), "anchor long, seg long, copies long, bytes binary, place int")
    found = repeated_windows(cut(pieces), length, crowd)
    own = found.join(mixed, ["anchor", "seg"]).selectExpr("doc_id", "cast(first + low as long) as a", f"cast(first + high + {length} as long) as b")
    copied = mixed.join(kinds.where("copies > 1").select("anchor", "seg"), ["anchor", "seg"], "left_semi")
    whole = met.where("alike").unionByName(copied).selectExpr("doc_id", "cast(first as long) as a", f"cast(first + n + {length} - 1 as long) as b")
    spans = own.unionByName(whole)
    return spans.repartition("doc_id").sortWithinPartitions("doc_id", "a").mapInArrow(_merge, "doc_id long, a long, b long")


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch):
            removed, spans, sha, kept = [], [], [], []
            for k, (a, b, cuts, all_) in enumerate(zip(texts.offsets, texts.offsets[1:], part.column("spans").to_pylist(), part.column("all").to_pylist())):
                raw, at, out, runs, last = texts.data[a:b].tobytes(), 0, [], 0, None
                for x, y in [(0, len(raw))] if all_ else sorted((s["a"], s["b"]) for s in cuts or ()):
                    if y <= at and last is not None:
                        continue
                    if last is None or x > at:
                        out.append(raw[at:x])
                        runs += 1
                    at = last = max(at, y)
                out.append(raw[at:])
                rest = b"".join(out)
                removed.append(len(raw) - len(rest))
                spans.append(runs)
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts.lengths), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def suffix_dedup(docs: DataFrame, length: int = 200, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of every document of docs(doc_id, text).

    Every byte goes that lies in a string of `length` bytes which also starts
    elsewhere, in the same document or another; strings are judged on the
    input. A null text is empty. Rows with a null doc_id are left out; where
    rows repeat a doc_id, the smallest of their texts is the document's, and it
    has one row. Texts of fewer bytes than `length` lose nothing. Other columns
    are ignored; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("doc_id is not null")
    if docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        docs = docs.groupBy("doc_id").agg(F.min("text").alias("text"))
    sums = docs.mapInArrow(_sums, "doc_id long, n_bytes long, t0 long, t1 long").where(F.col("n_bytes") >= length)
    sums = cut(sums)
    groups = sums.groupBy("t0", "t1", "n_bytes").agg(F.min("doc_id").alias("rep"), F.count("*").alias("k")).where("k > 1")
    copies = cut(sums.join(groups, ["t0", "t1", "n_bytes"]).select("doc_id", (F.col("doc_id") != F.col("rep")).alias("spare")))
    spare = small(copies.where("spare").select("doc_id"), 8)
    spans = repeated_spans(docs.join(spare, "doc_id", "left_anti"), length, crowd)
    lists = spans.groupBy("doc_id").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    cuts = lists.join(copies.select("doc_id", F.lit(True).alias("all")), "doc_id", "full").select("doc_id", F.when(F.col("all").isNull(), F.col("spans")).alias("spans"), F.coalesce("all", F.lit(False)).alias("all"))
    cuts = cut(cuts)
    total = cuts.agg(F.sum(F.greatest(F.size("spans"), F.lit(0)) + 1)).head()[0] or 0
    joined = docs.join(F.broadcast(cuts) if total * 48 <= 32 << 20 else cuts, "doc_id", "left").withColumn("all", F.coalesce("all", F.lit(False)))
    return joined.mapInArrow(_cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
