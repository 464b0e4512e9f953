"""Operators with exact results: suffix dedup, decontamination, WARC, token counts, mixing."""

from __future__ import annotations

import collections
import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gneiss.llm import decontaminate as B
from gneiss.llm import mixing as M
from gneiss.llm import suffix_dedup as X
from gneiss.llm import token_counts as T
from gneiss.llm import warc as W
from gneiss.llm.text import texts_of

from .helpers import corpus, documents, empty, lower, words


def removed(docs, length):
    raw = {i: (t or "").encode() for i, t in docs}
    c = collections.Counter(x[k : k + length] for x in raw.values() for k in range(len(x) - length + 1))
    out = {}
    for i, x in raw.items():
        mark = [False] * len(x)
        for k in range(len(x) - length + 1):
            if c[x[k : k + length]] > 1:
                mark[k : k + length] = [True] * length
        rest = bytes(b for b, m in zip(x, mark) if not m)
        spans = sum(m and (k == 0 or not mark[k - 1]) for k, m in enumerate(mark))
        out[i] = (len(x), sum(mark), spans, hashlib.sha256(rest).hexdigest())
    return out


@pytest.mark.parametrize(("length", "crowd"), [(200, X.CROWD), (40, X.CROWD), (40, 2)])
def test_repeated_strings(spark, length, crowd):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in X.suffix_dedup(documents(spark), length, crowd).collect()}
    assert got == removed([(i, t) for i, t, *_ in corpus()], length)
    assert sum(x[1] for x in got.values()) > 0


def test_columns_order_suffixes():
    r = random.Random(1)
    lefts, rights = ([bytes(r.choice(b"ab") for _ in range(r.randrange(6))) for _ in range(40)] for _ in range(2))
    anchors = np.array([r.randrange(3) for _ in range(40)])
    c = X.Columns(lefts, rights, anchors, 10)
    seqs = [[*x, 256 + a, *y] for x, y, a in zip(lefts, rights, anchors.tolist())]
    suffixes = [seqs[w >> 16][len(seqs[w >> 16]) - (w & 0xFFFF) :] for w in c.who.tolist()]
    assert suffixes == sorted(suffixes) and len(suffixes) == sum(len(s) + 1 for s in seqs)
    for k in range(1, len(suffixes)):
        n = 0
        for a, b in zip(suffixes[k - 1], suffixes[k]):
            if a != b:
                break
            n += 10 if a >= 256 else 1
        assert c.lcp[k] == n


def test_suffix_edges(spark, rows):
    assert X.suffix_dedup(empty(spark)).count() == 0
    s = "".join(random.Random(2).choice("abcdefgh") for _ in range(199))
    df = spark.createDataFrame([(1, s), (2, s), (3, s + "x"), (4, s + "x"), (4, s + "x"), (None, s + "x"), (5, "é" * 300)], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in X.suffix_dedup(df).collect()}
    assert got == {1: (199, 0, 0), 2: (199, 0, 0), 3: (200, 200, 1), 4: (200, 200, 1), 5: (600, 600, 1)}


def leaks(docs, items, percent=80, n=5):
    out = set()
    for j, item in items:
        w = words(lower(item or ""))
        g = [tuple(w[k : k + n]) for k in range(len(w) - n + 1)] or ([tuple(w)] if w else [])
        m = (len(g) + 1) // 2
        parts = [p for p in (set(g[:m]), set(g[m:])) if p]
        for i, text in docs:
            v = words(lower(text or ""))
            have = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} or ({tuple(v)} if v else set())
            if parts and all(100 * len(p & have) >= percent * len(p) for p in parts):
                out.add((i, j))
    return out


def test_contamination_against_all_passages(spark):
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(j, text(r.randrange(12, 60))) for j in range(40)] + [(40, None), (41, ""), (42, "two words")]
    docs = []
    for i in range(120):
        body = text(r.randrange(20, 500)).split()
        if i % 3 == 0:
            item = r.choice(items[:40])[1].split()
            item[r.randrange(len(item))] = "changed" if i % 2 else item[0]
            at = r.randrange(len(body))
            body[at:at] = [w.upper() for w in item] if i % 4 else item
        docs.append((i, " ".join(body)))
    docs += [(500, None), (501, ""), (502, "two words")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in B.contamination(d, b).collect()}
    assert got == leaks(docs, items) and len(got) > 10
    assert {x.doc_id for x in B.decontaminate(d, b).collect()} == {i for i, _ in docs} - {i for i, _ in got}
    assert B.contamination(empty(spark), b).count() == 0
    assert B.contamination_report(d, b.limit(0)).where("contaminated").count() == 0


def test_long_items_are_verified_whole(spark):
    r = random.Random(18)
    vocabulary = [f"w{i}" for i in range(4000)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(j, text(n)) for j, n in enumerate((5, 9, 63, 64, 65, 67, 120, 129, 200, 260, 700, 2000))]
    docs = []
    for j, item in items:
        w = item.split()
        for part in (w, w[: len(w) // 2], w[len(w) // 2 :], w[: -len(w) // 20], w[: min(64, len(w) // 2)]):
            docs.append((len(docs), " ".join([text(r.randrange(30, 200)), *part, text(r.randrange(30, 200))])))
    docs += [(900, items[8][1]), (900, items[8][1]), (None, items[9][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "2.0 as score")
    b = spark.createDataFrame([*items, items[3]], "item_id long, text string").selectExpr("*", "'x' as doc_id")
    want = leaks(docs, items)
    for index_items in (50_000, 4):
        got = [(x.doc_id, x.item_id) for x in B.contamination(d, b, index_items=index_items).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert len(want) > 15


def test_pruned_retrieval_finds_all_that_reach_the_threshold():
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(120)]
    items = [" ".join(r.choice(vocabulary) for _ in range(r.randrange(5, 40))) for _ in range(70)]
    docs = [" ".join(r.choice(vocabulary) for _ in range(r.randrange(1, 300))) for _ in range(30)] + items[:5]
    index = B.Index(list(range(70)), texts_of(pa.array(items)), 5, 0.5)
    tx = texts_of(pa.array(docs))
    got = {(t, f, k): s for t, f, k, s in index.retrieve(tx)}
    w = tx.lower().words()
    h = w.hashes()
    want = {}
    for t in range(len(docs)):
        own = h[w.ptr[t] : w.ptr[t + 1]]
        strides = -(-len(own) // B.STRIDE)
        for s in range(max(strides - 1, 1)):
            terms = np.flatnonzero(np.isin(index.terms, own[s * B.STRIDE : (s + 2) * B.STRIDE]))
            score = np.zeros(70)
            for x in terms:
                part = slice(index.term_ptr[x], index.term_ptr[x + 1])
                score[index.item[part]] += index.weight[part]
            want |= {(t, s * B.STRIDE, k): score[k] for k in np.flatnonzero(score >= 0.5)}
    assert set(got) == set(want) and got
    assert all(got[k] == pytest.approx(want[k]) for k in got)


@pytest.mark.parametrize("ids", [list(range(400)), [*range(399), 10**12], [-(2**63), *range(398), 2**63 - 1], [7] * 400])
def test_shards_fill_whatever_the_ids(spark, ids):
    df = spark.createDataFrame([(i, 1000) for i in ids] + [(None, 1000)], "page_id long, payload_bytes long").withColumn("cell", F.lit(1))
    got = W.shards(df, 50_000).collect()
    assert sorted(((r.page_id is None, r.page_id or 0) for r in got)) == sorted([(False, i) for i in ids] + [(True, 0)])
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.page_id)
    if len(set(ids)) > 1:
        assert len(by) >= 10 and max(map(len, by.values())) < 80
        spans = sorted((min(x), max(x)) for x in ([i for i in v if i is not None] for v in by.values()) if x)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


PAGES = [(3, "http://a/x", "<p>" + "é" * 80), (1, "http://a/ y", "<p>" + "é" * 80), (2, None, "<b>1"), (5, "u", "<b>1"), (9, "u", None), (None, "u", "<p>" + "é" * 80), (7, "u", "line\r\n\r\nbreak" * 20), (8, "u", "日本" * 3000), (8, "u", "日本" * 3000)]


def test_archives_round_trip(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 as shard", "'x' as file")
    uri = f"file://{tmp_path}/one"
    manifest = W.write_warc(df, uri, roll_bytes=300, shard_bytes=4000)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in W.read_warc(spark, uri).collect()), key=repr)
    first = {}
    for i, _, h in PAGES:
        x = (h or "").encode()
        if i is not None and len(x) >= 100:
            first[x] = min(first.get(x, i), i)
    want = []
    for i, _, h in PAGES:
        x = (h or "").encode()
        again = x in first and first[x] != i
        want.append((i, len(x), hashlib.sha256(x).hexdigest(), "revisit" if again else "response", first[x] if again else None))
    assert got == sorted(want, key=repr)
    files = {r.file: r for r in manifest.collect()}
    assert len(files) > 2
    for name, r in files.items():
        assert hashlib.sha256((tmp_path / "one" / name).read_bytes()).hexdigest() == r.sha256
    again = f"file://{tmp_path}/two"
    W.write_warc(df.repartition(3), again, roll_bytes=300, shard_bytes=4000)
    assert {n: (tmp_path / "two" / n).read_bytes() for n in files} == {n: (tmp_path / "one" / n).read_bytes() for n in files}
    assert not [x for x in os.listdir(tmp_path / "one") if x.startswith("_tmp")]
    # files that the manifest doesn't list are not read
    (tmp_path / "one" / "shard-999999-000000.warc.gz").write_bytes(b"junk")
    assert W.read_warc(spark, uri).count() == len(PAGES)
    W.write_warc(df.limit(0), f"file://{tmp_path}/none")
    assert W.read_warc(spark, f"file://{tmp_path}/none").count() == 0


@pytest.mark.skipif(not os.path.exists(T.TOKENIZER), reason="no tokenizer files here")
def test_token_counts_equal_the_tokenizer(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary = T.unigram_vocabulary()
    exact = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(replacement=T.MARK, prepend_scheme="always", split=True)
    docs = corpus() + [(2000 + k, t, None, None, 0) for k, t in enumerate([" a", "a ", "  x  y ", "▁a b▁", "tab\tx\ny", "<s> </s> <0x41>", "Zürich… straße", "antidisestablishmentarianism", "\u0000́"])]
    got = {r.doc_id: r.n_tokens for r in T.token_counts(documents(spark, docs), vocabulary).collect()}
    assert got == {i: len(exact.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in docs}
    assert T.token_counts(empty(spark), vocabulary).count() == 0


def test_ties_keep_the_longest_last_piece():
    c = T.Counter([("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("▁a", -2.0), ("▁aa", -3.0)])
    assert c.count("▁aa") == 1
    assert T.Counter([("▁", -1.0), ("a", -1.0), ("aa", -2.1)]).count("▁aa") == 3
    assert T.Counter([("▁", -1.0)]).count("▁é") == 3


def mix(docs, weights=(3, 1, 2), percent=150, most=2):
    sizes = collections.Counter()
    for _, text, _, source, _ in docs:
        sizes[source] += len(words(text))
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values()) * percent / 100
    while True:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not over:
            return sizes, target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= over
        if not open_:
            return sizes, target


def test_mixing(spark, rows):
    out = M.mix_sources(documents(spark))
    sizes, target = mix(corpus())
    taken = collections.Counter()
    for r in out.collect():
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert rows(out) == rows(M.mix_sources(documents(spark).repartition(3)))
    assert out.count() == len(corpus()) and M.mix_sources(empty(spark)).count() == 0


def test_mixing_a_full_source_and_ties(spark):
    docs = [(1, "a b", None, "x", 0), (1, "a b", None, "x", 0), (None, None, None, "y", 0), (2, "c " * 50, None, "z", 0), (None, "d e f", None, None, 0)]
    sizes, target = mix(docs)
    taken = collections.Counter()
    for r in M.mix_sources(documents(spark, docs)).collect():
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    assert {s: taken[s] for s in target} == {s: int(t + 1e-9) for s, t in target.items()}
