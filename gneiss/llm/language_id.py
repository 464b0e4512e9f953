"""Language identification by prediction by partial matching on bytes.

Each language has a context tree of orders 0 to 3 over bytes. A byte's
probability is its count in the longest context that the language has seen,
over that context's total plus its number of distinct bytes; a byte new to the
context costs the context's escape probability, which is that number over the
same sum, and is then looked for one order lower; below order 0 all 256 bytes
are alike. Statistics are frozen after training, so a text's code length is
the sum over its bytes, and the shortest code names the language.

Four-byte grams of every training text are counted by task and added up, and
none is dropped. The trees travel as sorted arrays of grams, in parts of
bounded size: a part has all grams of a range of order-2 contexts, so that
each byte is coded by one part alone, and the code lengths of the parts add
up. Small trees are one part; each further part is one more pass over the
texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.llm.text import Texts, slices, small_batches
from gneiss.operators.lineage import cut

#: The byte that texts are taken to follow.
BEFORE = 10
#: Grams of a part, over all languages; a single order-2 context is never divided.
MOST_GRAMS = 4_000_000
#: Order-2 contexts.
KEYS = 1 << 16


def contexts(texts: Texts) -> np.ndarray:
    """For each byte, the three bytes before it as one number, within its text."""
    out = np.zeros(len(texts.data), np.uint32)
    for back in (3, 2, 1):
        prior = np.full(len(texts.data), BEFORE, np.uint32)
        prior[back:] = texts.data[: max(len(texts.data) - back, 0)]
        for k in range(back):
            at = texts.offsets[:-1] + k
            prior[at[at < texts.offsets[1:]]] = BEFORE
        out = (out << np.uint32(8)) | prior
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, list[np.ndarray]] = {}
    for batch in batches:
        for part, texts in slices(batch):
            grams = (contexts(texts).astype(np.int64) << 8) | texts.data
            langs = np.array(part.column("lang").to_pylist(), dtype=object)
            which = np.repeat(np.arange(len(texts)), texts.lengths)
            for lang in set(langs.tolist()):
                g, n = np.unique(grams[(langs == lang)[which]], return_counts=True)
                if lang in seen:
                    g, back = np.unique(np.concatenate([seen[lang][0], g]), return_inverse=True)
                    n = np.bincount(back, np.concatenate([seen[lang][1], n])).astype(np.int64)
                seen[lang] = [g, n]
    for lang, (g, n) in seen.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n)], ["lang", "gram", "n"])


@dataclass
class Grams:
    """Counted grams of each language: those of two bytes here, those of four bytes in a cached frame.

    parts are ranges of order-2 contexts with about equally many grams.
    """

    rows: DataFrame
    pairs: dict[str, tuple[np.ndarray, np.ndarray]]
    parts: list[range]

    @classmethod
    def count(cls, docs: DataFrame, most_grams: int = MOST_GRAMS) -> Grams:
        """Counts over all rows of docs(text, lang) that have both."""
        docs = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
        rows = docs.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).persist()
        pairs = _by_language(rows.groupBy("lang", F.col("gram").bitwiseAND(KEYS - 1).alias("gram")).agg(F.sum("n").alias("n")))
        sizes = rows.groupBy(_key().alias("key")).agg(F.count("*").alias("k")).toPandas()
        before = np.cumsum(np.bincount(sizes.key.to_numpy(np.int64), sizes.k.to_numpy(np.int64), KEYS)) - 1
        starts = np.unique(np.maximum(before, 0).astype(np.int64) // most_grams, return_index=True)[1].tolist()
        return cls(rows, pairs, [range(a, b) for a, b in zip(starts, [*starts[1:], KEYS])])

    def trees(self, part: range) -> tuple[dict, dict, range]:
        """What Trees takes for a part."""
        return _by_language(self.rows.where(_key().between(part.start, part.stop - 1))), self.pairs, part


def _key() -> Column:
    return F.shiftright("gram", 8).bitwiseAND(KEYS - 1)


def _by_language(rows: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Sorted grams and their counts for each language of rows(lang, gram, n)."""
    table = rows.select("lang", "gram", "n").toArrow()
    lang = table.column("lang").combine_chunks().dictionary_encode()
    which, gram, n = lang.indices.to_numpy(zero_copy_only=False), table.column("gram").to_numpy(), table.column("n").to_numpy()
    out = {}
    for name, k in sorted((name, k) for k, name in enumerate(lang.dictionary.to_pylist())):
        own = np.flatnonzero(which == k)
        own = own[np.argsort(gram[own])]
        out[name] = (gram[own].astype(np.uint32), n[own])
    return out


def _summed(grams: np.ndarray, n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the grams' last order + 1 bytes."""
    code, back = np.unique(grams & np.uint32((1 << 8 * (order + 1)) - 1), return_inverse=True)
    return code, np.bincount(back, n, len(code))


def _find(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each x is in the sorted keys, and whether it is."""
    if not len(keys):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return at, keys[at] == x


class Level:
    """One order of a language's tree: log2 probabilities of its grams and escapes of its contexts."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.grams = grams
        self.contexts, back = np.unique(grams >> np.uint32(8), return_inverse=True)
        total, kinds = np.bincount(back, n, len(self.contexts)), np.bincount(back, minlength=len(self.contexts))
        self.log_p = np.log2(n / (total + kinds)[back]).astype(np.float32)
        self.escape = np.log2(kinds / (total + kinds)).astype(np.float32)


class Trees:
    """The trees of all languages, as far as contexts of one part need them."""

    def __init__(self, grams: dict[str, tuple[np.ndarray, np.ndarray]], pairs: dict[str, tuple[np.ndarray, np.ndarray]] | None = None, part: range = range(KEYS)):
        none = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.part = part
        if pairs is None:
            grams = {lang: (g.astype(np.uint32), n) for lang, (g, n) in grams.items()}
            pairs = {lang: _summed(*x, 1) for lang, x in grams.items()}
        self.langs = list(pairs)
        self.levels = []
        for lang in self.langs:
            long, two = grams.get(lang, none), pairs[lang]
            self.levels.append([Level(*long), Level(*_summed(*long, 2)), Level(*two), Level(*_summed(*two, 0))])

    def _log_p(self, levels: list[Level], grams: np.ndarray) -> np.ndarray:
        """Log2 probability of each gram's last byte after the others."""
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        for order, level in zip((3, 2, 1, 0), levels):
            x = grams[left] & np.uint32((1 << 8 * (order + 1)) - 1)
            at, known = _find(level.grams, x)
            out[left[known]] += level.log_p[at[known]]
            left, x = left[~known], x[~known]
            at, known = _find(level.contexts, x >> np.uint32(8))
            out[left[known]] += level.escape[at[known]]
        out[left] -= 8
        return out

    def code_lengths(self, texts: Texts) -> np.ndarray:
        """Bits of each text under each language, over the bytes whose contexts are in the part."""
        out = np.zeros((len(texts), len(self.langs)))
        grams, back = np.unique((contexts(texts) << np.uint32(8)) | texts.data, return_inverse=True)
        key = (grams >> np.uint32(8)) & np.uint32(KEYS - 1)
        here = np.flatnonzero((key >= self.part.start) & (key < self.part.stop))
        full = np.flatnonzero(texts.lengths > 0)
        for k, levels in enumerate(self.levels if len(full) else []):
            bits = np.zeros(len(grams))
            bits[here] = -self._log_p(levels, grams[here])
            out[full, k] = np.add.reduceat(bits[back], texts.offsets[:-1][full])
        return out


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def has_letter(texts: Texts) -> np.ndarray:
    n = np.concatenate([[0], np.cumsum(_ASCII_LETTER[texts.data])])[texts.offsets]
    out = np.diff(n) > 0
    for i in np.flatnonzero(~out & (texts.lengths > 0)):
        out[i] = any(c.isalpha() for c in texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes().decode())
    return out


def identify(docs: DataFrame, grams: Grams) -> DataFrame:
    """docs(doc_id, text) with lang_pred and score, one row for each.

    `und` with score 0 for texts that are null or have no letter, and for all
    if there are no trees; else the language of the shortest code (the first
    by name if two tie) and its share of the summed probabilities. Texts of
    any length are coded whole, repeated rows and ids each by themselves.
    """
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.lit(None).cast("array<double>").alias("bits"))
    for part in grams.parts[:-1]:
        rows = cut(rows.mapInArrow(_adder(rows, grams.trees(part), last=False), f"doc_id {kind}, text string, bits array<double>"))
    return rows.mapInArrow(_adder(rows, grams.trees(grams.parts[-1]), last=True), f"doc_id {kind}, lang_pred string, score double")


def _adder(rows: DataFrame, trees: tuple[dict, dict, range], last: bool):
    """Adds a part's code lengths to each row's bits; the last one compares the sums."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)
    built: list[Trees] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not built:
            built.append(Trees(*shared.value))
        for batch in batches:
            for part, texts in slices(batch):
                bits = built[0].code_lengths(texts)
                before = part.column("bits")
                if before.null_count < len(before):
                    bits += before.flatten().to_numpy().reshape(bits.shape)
                if last:
                    names, score = _verdict(built[0].langs, texts, bits)
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names.tolist(), pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])
                else:
                    ends = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * len(built[0].langs), pa.int32())
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), pa.ListArray.from_arrays(ends, pa.array(bits.ravel()))], ["doc_id", "text", "bits"])

    return run


def _verdict(langs: list[str], texts: Texts, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not langs:
        return np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
    known = has_letter(texts)
    score = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
    return np.where(known, np.array(langs, dtype=object)[bits.argmin(1)], "und"), np.where(known, score, 0.0)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; 0 for null."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def language_id(docs: DataFrame, folds: int = 4, held: int = 2, most_grams: int = MOST_GRAMS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of docs(doc_id, text, lang).

    Trees are learned from rows with text and lang outside of the held fold.
    Null doc_ids are not held out. Other columns are ignored, an empty table
    gives an empty result.
    """
    small_batches(docs.sparkSession)
    grams = Grams.count(docs.where(fold(F.col("doc_id"), folds) != held), most_grams)
    out = identify(docs, grams)
    grams.rows.unpersist()
    return out.select("doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "lang_pred", "score")
