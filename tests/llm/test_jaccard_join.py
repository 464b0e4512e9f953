"""The Jaccard join against all pairs, its cells and regions."""

from __future__ import annotations

import os
import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from gneiss.llm import jaccard_join as J
from gneiss.llm.text import texts_of

from .helpers import corpus, documents, empty, lower, words


def brute(docs, n, percent):
    sets = {}
    for i, text, *_ in docs:
        w = words(lower(text or ""))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    root, links = {i: i for i in sets}, dict.fromkeys(sets, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i), links[i]) for i, s in sets.items())


@pytest.mark.parametrize(("n", "percent", "region_rows"), [(4, 85, 20_000), (2, 60, 2), (2, 60, 12)])
def test_against_all_pairs(spark, rows, n, percent, region_rows):
    got = J.jaccard_join(documents(spark), n, percent, region_rows)
    assert rows(got) == sorted(brute(corpus(), n, percent), key=repr)


def test_empty_and_repeated_rows(spark, rows):
    assert J.jaccard_join(empty(spark)).count() == 0
    df = spark.createDataFrame([(1, "a b c d e f", None, None, 0), (1, "a b c d e f", None, None, 0), (2, "A B c d e f", None, None, 0), (None, "a b c d e f", None, None, 0)], "doc_id long, text string, lang string, source string, n_chars long")
    assert rows(J.jaccard_join(df, 4, 85)) == [(1, 3, 1, 1), (2, 3, 1, 1)]


def _family(r, size, n, edits):
    base = [f"w{r.randrange(10**6)}" for _ in range(n)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(r.randrange(edits + 1)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_every_link_has_a_cell_in_common():
    r = random.Random(1)
    texts = [t for n in (8, 15, 40, 120, 400) for _ in range(6) for t in _family(r, 6, n, max(1, n // 30))]
    h, ptr = J.distinct_sets(texts_of(pa.array(texts)), 4)
    which, keys = J.cell_keys(h, ptr, 85)
    cells = [set() for _ in texts]
    for i, k in zip(which.tolist(), keys.tolist()):
        cells[i].add(k)
    sets = [frozenset(h[a:b].tolist()) for a, b in zip(ptr, ptr[1:])]
    linked = 0
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] != sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                linked += 1
                assert cells[a] & cells[b]
    assert linked > 20


def test_sketches_keep_links_and_part_strangers():
    r = random.Random(11)
    texts = [t for n in (300, 900, 3000, 9000) for t in (*_family(r, 3, n, n // 60), *_family(r, 1, n, 1), *_family(r, 1, n, 1))]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    (out,) = [pa.Table.from_batches(list(J._sketches(5)(iter([batch]))))]
    size, sketch = out.column("size").to_numpy(), out.column("sketch").to_pylist()
    h, ptr = J.distinct_sets(texts_of(pa.array(texts)), 5)
    sets = [frozenset(h[a:b].tolist()) for a, b in zip(ptr, ptr[1:])]
    parted = 0
    for a in range(len(texts)):
        for b in range(a):
            rows = J.folded([sketch[a], sketch[b]], min(len(sketch[a]), len(sketch[b])))
            may = J.possible(rows, size[[a, b]], np.array([0]), np.array([1]), 80)[0]
            linked = 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
            assert may or not linked
            parted += not may
            assert not may or sets[a] & sets[b]  # strangers are told apart, whatever their size
    assert parted > 100


def test_regions_are_joined_exactly():
    r = random.Random(2)
    texts = [t for _ in range(30) for t in _family(r, 8, 60, 4)]
    h, ptr = J.distinct_sets(texts_of(pa.array(texts)), 4)
    blobs = [h[a:b].tobytes() for a, b in zip(ptr, ptr[1:])]
    sets = [frozenset(np.frombuffer(x, np.uint64).tolist()) for x in blobs]
    copies = np.array([1 + i % 3 for i in range(len(sets))])
    linked, first = J.region_links(J.Sets(blobs), 85, copies, leaf=10)
    want, root = _plain(sets, copies)
    assert linked.tolist() == want and first.tolist() == root
    # dealt in parts of which each two meet
    total, part = np.zeros(len(sets), np.int64), np.arange(len(sets)) % 3
    for x, y in ((0, 0), (1, 1), (2, 2), (0, 1), (0, 2), (1, 2)):
        rows = np.flatnonzero((part == x) | (part == y))
        total[rows] += J.region_links(J.Sets([blobs[i] for i in rows]), 85, copies[rows], side=np.where(x == y, 0, np.where(part[rows] == x, 1, 2)))[0]
    assert total.tolist() == want


def _plain(sets, copies):
    """Link weights and least reachable rows by all pairs."""
    n = len(sets)
    links = [[b for b in range(n) if b != a and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])] for a in range(n)]
    root = list(range(n))
    for a in range(n):
        if root[a] == a:
            queue = [a]
            while queue:
                for b in links[queue.pop()]:
                    if root[b] > a:
                        root[b] = a
                        queue.append(b)
    return [int(sum(copies[b] for b in x)) for x in links], root


def test_spheres_and_chains():
    """One crowd of mutual copies, chains of steps within reach, and strangers: spheres, their distances and blocks."""
    r = random.Random(5)
    texts = _family(r, 150, 90, 1) + _family(r, 60, 40, 3)
    for _ in range(40):  # a chain: each a few edits from the one before
        w = texts[-1].split()
        for _ in range(2):
            w[r.randrange(len(w))] = f"y{r.randrange(10**6)}"
        texts.append(" ".join(w))
    h, ptr = J.distinct_sets(texts_of(pa.array(texts)), 4)
    blobs = [h[a:b].tobytes() for a, b in zip(ptr, ptr[1:])]
    sets = [frozenset(np.frombuffer(x, np.uint64).tolist()) for x in blobs]
    copies = np.ones(len(sets), np.int64)
    linked, first = J.region_links(J.Sets(blobs), 85, copies, leaf=20)
    want, root = _plain(sets, copies)
    assert linked.tolist() == want and first.tolist() == root


def test_a_crowd_of_copies_needs_little_memory():
    """5,000 documents, each one edit from the same text, are 12 million links; no pair of them is kept."""
    code = """
import random, resource, numpy as np, pyarrow as pa
from gneiss.llm import jaccard_join as J
from gneiss.llm.text import texts_of
r = random.Random(1)
base = [f"w{i}" for i in range(300)]
texts = []
for k in range(5000):
    w = list(base)
    w[r.randrange(300)] = f"x{k}"
    texts.append(" ".join(w))
h, ptr = J.distinct_sets(texts_of(pa.array(texts)), 5)
blobs = [h[a:b].tobytes() for a, b in zip(ptr, ptr[1:])]
linked, first = J.region_links(J.Sets(blobs), 80)
assert (linked == 4999).all() and (first == 0).all()
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, env=os.environ | {"OMP_NUM_THREADS": "1", "OPENBLAS_NUM_THREADS": "1"})
    assert int(out.stdout) < 400  # about 100 of them are the imports


def test_cells_over_many_batches():
    r = random.Random(3)
    rows = sorted((k, d, 10, bytes([r.randrange(2) for _ in range(10)] + [0] * (J.SKETCH - 10))) for k in range(6) for d in range(r.randrange(2, 40)))
    table = pa.table(dict(zip(("key", "doc_id", "size", "sketch"), map(list, zip(*rows)))))

    def parts(most, width):
        root = {}
        for b in J._possible_edges(1, most)(iter(table.to_batches(width))):
            for a, c in zip(b.column("first").to_pylist(), b.column("doc_id").to_pylist()):
                root.setdefault(a, set()).add(c)
        return root

    # with a threshold of 1 % all documents of a cell may link: held or not, they are joined
    for most, width in ((10**6, 1000), (10**6, 7), (5, 4)):
        joined = parts(most, width)
        seen, queue = {0}, [0]
        both = {}
        for a, x in joined.items():
            for c in x:
                both.setdefault(a, set()).add(c)
                both.setdefault(c, set()).add(a)
        while queue:
            for n in both.get(queue.pop(), ()):
                if n not in seen:
                    seen.add(n)
                    queue.append(n)
        assert seen == {d for _, d, _, _ in rows}


def test_shared_keys_pass_their_filter(spark, monkeypatch):
    """No shared key is missed, most others are; and the join is the same with the filter as without it."""
    r = np.random.default_rng(5)
    keys = np.unique(r.integers(-(1 << 63), 1 << 63, 6000))
    r.shuffle(keys)
    bits = J.key_filter(spark.createDataFrame([(int(k),) for k in keys[:3000]], "key long").repartition(3), 3000)
    assert J.may_have(bits, keys[:3000]).all() and J.may_have(bits, keys[3000:]).mean() < 0.1
    none = J.key_filter(spark.createDataFrame([], "key long"), 0)
    assert not J.may_have(none, keys).any() and J.may_have(none, keys[:0]).size == 0
    want = sorted(map(tuple, J.jaccard_join(documents(spark)).collect()))
    monkeypatch.setattr(J, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, J.jaccard_join(documents(spark)).collect())) == want


def test_cells_of_the_same_documents_are_dealt_once(spark, monkeypatch):
    """Every set of documents that met has one cell, and no link is lost."""
    met = [(d, key) for key, docs in enumerate([(1, 2), (2, 1), (1, 2, 3), (3, 1, 2), (1, 3), (2, 3), (1, 2, 4), (5, 6), (6, 5), (5, 6)]) for d in docs]
    got = {}
    for d, key in J.distinct_cells(spark.createDataFrame(met, "doc_id long, key long")).collect():
        got.setdefault(key, []).append(d)
    assert {k: sorted(v) for k, v in got.items()} == {0: [1, 2], 2: [1, 2, 3], 4: [1, 3], 5: [2, 3], 6: [1, 2, 4], 7: [5, 6]}
    r = random.Random(8)
    texts = [t for n in (60, 200) for _ in range(10) for t in _family(r, 2, n, 2)]
    dealt = []
    monkeypatch.setattr(J, "small", lambda side, size, *_: (dealt.append(side.count()) if side.columns == ["key"] else None, side)[1])
    rows = J.jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4, 85).collect()
    assert sorted(tuple(x) for x in rows) == brute(list(enumerate(texts)), 4, 85)
    assert dealt[0] > 100 and dealt[1] <= 20  # shared keys, and one for each pair
