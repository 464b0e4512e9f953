"""Token counts under a unigram vocabulary, without making the tokens.

The vocabulary's pieces are one Aho-Corasick automaton. A text is cut before
each space, as the tokenizer's pre-tokenizer does, and a segment's count comes
from a Viterbi pass that carries the best score and its number of pieces for
each position. Ties go as in the tokenizer: starts from left to right, a later
candidate wins only if it scores strictly more, so of equal scores the longest
last piece stays. A character without a piece of its own costs the lowest
score less 10 and counts as one token for each of its bytes.

Equal segments are counted once by a worker; the cache has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.text import Texts, slices, small_batches, sum_by

MARK = "▁"
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
CACHE = 2_000_000
UNKNOWN_PENALTY = 10.0


def unigram_vocabulary(path: str = TOKENIZER) -> list[tuple[str, float]]:
    """The file's pieces with the log probability of a Zipf law of their ids; special and byte pieces score lowest."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(n)]
    return [(model.id_to_piece(i), -float(np.log(n + 1.0 if special[i] else i + 1.0))) for i in range(n)]


class Counter:
    """Piece counts of segments."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.pieces = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def count(self, segment: str) -> int:
        """Tokens of the best segmentation of one segment."""
        n = len(segment)
        best, count, done = [0.0] * (n + 1), [0] * (n + 1), 0
        reached = [False] * (n + 1)
        reached[0] = True
        single, unknown = self.single, self.unknown
        for end, (length, score) in self.pieces.iter(segment):
            end += 1
            while done < end - 1:  # positions that no piece ends at, or whose pieces are over
                done += 1
                self._unknown(segment, done, best, count, reached)
            start = end - length
            total = score + best[start]
            if not reached[end] or total > best[end]:
                best[end], count[end], reached[end] = total, count[start] + 1, True
        while done < n:
            done += 1
            self._unknown(segment, done, best, count, reached)
        return count[n]

    def _unknown(self, segment: str, end: int, best: list, count: list, reached: list) -> None:
        char = segment[end - 1]
        if char not in self.single:
            total = self.unknown + best[end - 1]
            if not reached[end] or total > best[end]:
                best[end], count[end], reached[end] = total, count[end - 1] + len(char.encode()), True

    def of_texts(self, texts: Texts) -> np.ndarray:
        """Tokens of each text."""
        data, offsets = texts.data, texts.offsets
        if b"\xe2\x96\x81" in data.tobytes():  # the mark itself parts segments like the space
            parts = [data[a:b].tobytes().replace(b"\xe2\x96\x81", b" ") for a, b in zip(offsets, offsets[1:])]
            data, offsets = np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
            texts = Texts(data, offsets)
        space = np.flatnonzero(data == 32)
        full = offsets[:-1][texts.lengths > 0]
        bare = full[data[full] != 32]
        starts = np.concatenate([space + 1, bare])
        first = np.concatenate([space, bare])
        order = np.argsort(first, kind="stable")
        starts, first = starts[order], first[order]
        owner_end = offsets[np.searchsorted(offsets, first, side="right")]
        ends = np.minimum(np.concatenate([first[1:], [len(data)]]), owner_end)
        h, back = np.unique(texts.span_hash(starts, ends), return_inverse=True)
        one = np.zeros(len(h), np.int64)
        one[back] = np.arange(len(back))
        at = np.minimum(np.searchsorted(self.hashes, h), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == h if len(self.hashes) else np.zeros(len(h), bool)
        counts = np.where(known, self.counts[at], 0) if len(self.hashes) else np.zeros(len(h), np.int64)
        fresh = np.flatnonzero(~known)
        raw = data.tobytes()
        for k in fresh:
            i = one[k]
            counts[k] = self.count(MARK + raw[starts[i] : ends[i]].decode())
        if len(self.hashes) + len(fresh) > CACHE:
            self.hashes, self.counts = h, counts
        else:
            merged = np.concatenate([self.hashes, h[fresh]])
            order = np.argsort(merged, kind="stable")
            self.hashes, self.counts = merged[order], np.concatenate([self.counts, counts[fresh]])[order]
        return sum_by(np.searchsorted(first, offsets), counts[back])


def token_counts(docs: DataFrame, vocabulary: list[tuple[str, float]]) -> DataFrame:
    """doc_id, n_chars and n_tokens of every row of docs(doc_id, text).

    Null and empty texts have 0 of both. n_chars are code points. Other columns
    are ignored; repeated rows are counted each; an empty table gives an empty
    result.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            for part, texts in slices(batch):
                chars = sum_by(texts.offsets, ((texts.data & 0xC0) != 0x80).astype(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(chars), pa.array(counter.of_texts(texts))], ["doc_id", "n_chars", "n_tokens"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n_chars long, n_tokens long")
