"""Benchmark decontamination: BM25 retrieval of test items with block-max pruning, then verification.

The index holds the test items (long ones in pieces of STRIDE words) as BM25
weights of their words, divided by the item's own full score, so that one
threshold fits all. Postings are kept in blocks of BLOCK items with each
block's largest weight. Every passage of every document - windows of two
strides, one stride apart, so that any STRIDE consecutive words lie in one -
is a query, and all items that reach the threshold are retrieved:

* words are split as in WAND into common ones, which together can't lift any
  item to the threshold, and essential ones; only essential words' postings
  are walked;
* a block is scored only if its essential maxima plus its largest common sum
  reach the threshold for the passage;
* scores of those blocks are exact.

An item contaminates if at least `percent` % of the word shingles of its
question (its first half) and of its answer (the rest) occur in the passages
that it, or any piece of it, was retrieved for. Pieces only retrieve: an item
of any length is verified as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.text import Texts, slices, small_batches, texts_of
from gneiss.operators.lineage import cut, small

STRIDE = 64
BLOCK = 4
#: Items in one index; more are searched by further passes.
INDEX_ITEMS = 50_000
K1, B = 1.2, 0.75


class Index:
    """BM25 postings of item pieces, with block maxima."""

    def __init__(self, item_ids: list[int], texts: Texts, shingle: int, threshold: float):
        words = texts.lower().words()
        h = words.hashes()
        g, gptr = words.shingles(shingle)
        self.threshold, self.shingle = threshold, shingle
        self.items, self.question, self.answer, pieces = [], {}, {}, []
        for k, item in enumerate(item_ids):
            a, b = words.ptr[k], words.ptr[k + 1]
            if a == b:
                continue
            grams = g[gptr[k] : gptr[k + 1]]
            middle = (len(grams) + 1) // 2
            self.question[k], self.answer[k] = np.unique(grams[:middle]), np.unique(grams[middle:])
            for c in range(a, b, STRIDE):
                self.items.append(k)
                pieces.append(h[c : min(c + STRIDE, b)])
        self.ids = item_ids
        n = len(pieces)
        self.terms, back = np.unique(np.concatenate(pieces) if pieces else np.zeros(0, np.uint64), return_inverse=True)
        owner = np.repeat(np.arange(n), [len(p) for p in pieces])
        key, tf = np.unique(back * max(n, 1) + owner, return_counts=True)
        term, item = key // max(n, 1), key % max(n, 1)
        length = np.array([len(p) for p in pieces], float)
        df = np.bincount(term, minlength=len(self.terms))
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * length / max(length.mean() if n else 1, 1))
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[item])
        full = np.bincount(item, weight, n)
        weight = weight / full[item]
        self.term_ptr = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.item, self.weight = item, weight
        # common words: by falling frequency, while no item's sum of them reaches the threshold
        order = np.argsort(-df, kind="stable")
        sums = np.zeros(n)
        self.essential = np.ones(len(self.terms), bool)
        for t in order:
            s = slice(self.term_ptr[t], self.term_ptr[t + 1])
            sums[item[s]] += weight[s]
            if sums[item[s]].max() >= 0.9 * threshold:
                sums[item[s]] -= weight[s]
                break
            self.essential[t] = False
        blocks = -(-n // BLOCK)
        self.common_of_block = np.zeros(blocks)
        np.maximum.at(self.common_of_block, np.arange(n) // BLOCK, sums)
        bkey, at = np.unique(term * max(blocks, 1) + item // BLOCK, return_inverse=True)
        top = np.zeros(len(bkey))
        np.maximum.at(top, at, weight)
        self.block_ptr = np.searchsorted(bkey // max(blocks, 1), np.arange(len(self.terms) + 1))
        self.block, self.top = bkey % max(blocks, 1), top
        self.blocks = blocks

    def retrieve(self, texts: Texts) -> Iterator[tuple[int, int, int, float]]:
        """(text number, first word, item piece, score) of every passage and piece that reach the threshold."""
        words = texts.lower().words()
        if not len(words.starts) or not len(self.terms):
            return
        strides = -(-words.counts // STRIDE)
        base = np.concatenate([[0], np.cumsum(strides)])
        h = words.hashes()
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        hit = np.flatnonzero(self.terms[at] == h)
        owner = words.text_of()[hit]
        stride = base[owner] + (hit - words.ptr[owner]) // STRIDE
        pair = np.unique(stride * len(self.terms) + at[hit])
        stride, term = pair // len(self.terms), pair % len(self.terms)
        ess = self.essential[term]
        n = self.block_ptr[term[ess] + 1] - self.block_ptr[term[ess]]
        post = np.repeat(self.block_ptr[term[ess]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        key, back = np.unique(np.repeat(stride[ess], n) * self.blocks + self.block[post], return_inverse=True)
        bound = np.bincount(back, self.top[post], len(key))
        # a window is a stride and the next of its text; the last stride of a longer text is in the window before
        text = np.searchsorted(base, key // self.blocks, side="right") - 1
        number = key // self.blocks - base[text]
        windows, bounds = [], []
        for shift in (0, 1):
            ok = (number - shift >= 0) & ((number - shift < strides[text] - 1) | (strides[text] == 1))
            windows.append((key - shift * self.blocks)[ok])
            bounds.append(bound[ok])
        window, back = np.unique(np.concatenate(windows), return_inverse=True)
        total = np.bincount(back, np.concatenate(bounds), len(window)) + self.common_of_block[window % self.blocks] if len(window) else np.zeros(0)
        window = window[total >= self.threshold - 1e-9]
        for w in np.unique(window // self.blocks):
            a, b = np.searchsorted(stride, [w, w + 2])
            if strides[(t := int(np.searchsorted(base, w, side="right")) - 1)] == 1:
                b = np.searchsorted(stride, w + 1)
            own = np.unique(term[a:b])
            wanted = window[window // self.blocks == w] % self.blocks
            n = self.term_ptr[own + 1] - self.term_ptr[own]
            post = np.repeat(self.term_ptr[own], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            post = post[np.isin(self.item[post] // BLOCK, wanted)]
            met, back = np.unique(self.item[post], return_inverse=True)
            score = np.bincount(back, self.weight[post], len(met))
            for k in np.flatnonzero(score >= self.threshold):
                yield t, int((w - base[t]) * STRIDE), int(met[k]), float(score[k])

    def verified(self, texts: Texts, percent: int) -> Iterator[tuple[int, int, float]]:
        """(text number, item id, score) of the retrieved passages that hold question and answer."""
        found: dict[tuple[int, int], list[tuple[int, float]]] = {}
        for t, first, k, score in self.retrieve(texts):
            found.setdefault((t, self.items[k]), []).append((first, score))
        if not found:
            return
        g, ptr = texts.lower().words().shingles(self.shingle)
        for (t, k), hits in found.items():
            spans = [g[ptr[t] + a : min(ptr[t] + a + 2 * STRIDE - self.shingle + 1, ptr[t + 1])] for a in sorted({a for a, _ in hits})]
            # an item of one piece must be in one passage
            for passages in [spans] if len(self.pieces_of(k)) > 1 else [[x] for x in spans]:
                seen = np.concatenate(passages)
                parts = [x for x in (self.question[k], self.answer[k]) if len(x)]
                if parts and all(100 * np.isin(x, seen).sum() >= percent * len(x) for x in parts):
                    yield t, self.ids[k], max(s for _, s in hits)
                    break

    def pieces_of(self, item: int) -> range:
        """The pieces of the item with this number."""
        return range(*np.searchsorted(self.items, [item, item + 1]).tolist())


def contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, percent: int = 80, shingle: int = 5, index_items: int = INDEX_ITEMS) -> DataFrame:
    """(doc_id, item_id, score) of every document of docs(doc_id, text) and item of benchmark(item_id, text) in it.

    A row of docs gives an item once, with its best passage's score; equal rows
    give equal rows once. Items without words are never found, items of fewer
    words than a shingle only where their words are a whole document. Null ids
    are ids like others; null texts hold nothing. Rows that repeat an item are one.
    The driver holds one index of about `index_items` items at a time; more are
    dealt by hash to further passes over docs.
    """
    small_batches(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, item_id long, score double"
    passes = max(-(-items.count() // index_items), 1)
    found = []
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).orderBy("item_id", "text").toArrow()
        index = Index(part.column("item_id").to_pylist(), texts_of(part.column("text")), shingle, threshold)
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, texts in slices(batch):
                    hits = list(shared.value.verified(texts, percent))
                    ids = rows.column("doc_id").take(pa.array([t for t, _, _ in hits], pa.int64()))
                    yield pa.RecordBatch.from_arrays([ids, pa.array([i for _, i, _ in hits], pa.int64()), pa.array([s for _, _, s in hits], pa.float64())], ["doc_id", "item_id", "score"])

        found.append(rows.mapInArrow(run, schema))
    return reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs whose doc_id contamination() doesn't find, all columns unchanged."""
    gone = cut(contamination(docs, benchmark, **options).select(F.col("doc_id").alias("gone_id")).distinct())
    return docs.join(small(gone, 16), F.col("doc_id").eqNullSafe(F.col("gone_id")), "left_anti")


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, contaminated, n_items and first_item (the smallest item_id) for every distinct doc_id of docs."""
    hits = contamination(docs, benchmark, **options).groupBy(F.col("doc_id").alias("of")).agg(F.count("*").alias("n_items"), F.min("item_id").alias("first_item"))
    out = docs.select("doc_id").distinct().join(hits, F.col("doc_id").eqNullSafe(F.col("of")), "left")
    return out.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), "first_item")
