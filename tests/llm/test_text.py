"""The vectorised tokenizer against plain Python, on any texts."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from gneiss.llm.text import powers, slices, sum_by, texts_of

from .helpers import WORD, lower

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\t\n日 ", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words(texts):
    w = texts_of(pa.array(texts, pa.string())).lower().words()
    got = [w.texts.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)]
    want = [WORD.findall(lower(t or "")) for t in texts]
    assert got == [x for t in want for x in t]
    assert w.counts.tolist() == [len(t) for t in want]


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_shingles_differ_just_as_their_words(texts):
    h, ptr = texts_of(pa.array(texts, pa.string())).lower().words().shingles(3)
    want = []
    for t in texts:
        w = WORD.findall(lower(t or ""))
        want.append([tuple(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [tuple(w)] if w else [])
    assert np.diff(ptr).tolist() == [len(x) for x in want]
    flat = [x for t in want for x in t]
    assert len(set(h.tolist())) == len(set(flat)) == len(set(zip(flat, h.tolist())))


def test_slices_hold_whole_texts():
    batch = pa.RecordBatch.from_pydict({"text": ["abc", None, "defghij", "", "k"], "n": [1, 2, 3, 4, 5]})
    parts = [(p.column("n").to_pylist(), t.data.tobytes()) for p, t in slices(batch, most=4)]
    assert [n for p, _ in parts for n in p] == [1, 2, 3, 4, 5]
    assert b"".join(t for _, t in parts) == b"abcdefghijk"
    assert sum_by(np.array([0, 2, 2, 3]), np.array([1, 2, 5])).tolist() == [3, 0, 5]


def test_hashing_holds_one_number_a_byte():
    """A text's prefix hashes are made in their own array: less than half as much again is held beside it."""
    text = "word 日本 " * 100_000
    texts = texts_of(pa.array([text]))
    want = texts_of(pa.array(["日本"])).words().hashes()
    powers(len(texts.data) + 1)
    tracemalloc.start()
    prefix = texts.prefix_hash()
    assert tracemalloc.get_traced_memory()[1] < 1.5 * prefix.nbytes
    tracemalloc.stop()
    w = texts.words()
    assert (texts.span_hash(w.starts, w.ends, prefix)[1::2] == want).all()
