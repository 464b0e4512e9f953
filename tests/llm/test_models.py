"""Language models: scoring, language identification, quality rules."""

from __future__ import annotations

import collections
import math
import os
import pickle
import random
import tracemalloc
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gneiss.llm import language_id as I
from gneiss.llm import lm_scoring as S
from gneiss.llm import quality_rules as Q
from gneiss.llm.text import texts_of

from .helpers import corpus, documents, empty, lower, words


def test_base_scores_and_counts(spark):
    got = {r.doc_id: r for r in S.lm_scores(documents(spark)).collect()}
    docs = {i: [*words(lower(t or "")), None] for i, t, *_ in corpus()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    c = collections.Counter(x for i, w in docs.items() if not held[i] for x in w)
    n, v = sum(c.values()), len(c)
    assert set(got) == set(docs)
    for i, w in docs.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
        assert r.score < 0
    assert got[906].score == pytest.approx(got[907].score)


def test_scoring_an_empty_table(spark):
    assert S.lm_scores(empty(spark)).count() == 0


def _tables(seed=7):
    r = np.random.default_rng(seed)
    return *(r.integers(0, 9, (S.BEFORE + 1, S.CLASSES)) for _ in range(2)), r.integers(0, S.OTHER + 1, S.CLASSES)


def test_attention_gradients():
    a = S.Attention(*_tables(), seed=3)
    a.w = {k: v.astype(np.float64) for k, v in a.w.items()}
    r = np.random.default_rng(0)
    x, y = r.integers(0, S.CLASSES, (2, S.WINDOW + 1)), r.integers(0, S.CLASSES + 2, (2, S.WINDOW))
    _, g = a._gradients(x, y)
    for name in a.w:
        at = tuple(r.integers(0, n) for n in a.w[name].shape) if name != "e" else (x[0, 1], 1)
        at = (y[y < S.CLASSES][0] // S.MEMBERS, *at[1:]) if name in ("uc", "bc") else at
        keep, step = a.w[name][at], 1e-4
        a.w[name][at] = keep + step
        up = a._gradients(x, y)[0]
        a.w[name][at] = keep - step
        down = a._gradients(x, y)[0]
        a.w[name][at] = keep
        assert g[name][at] == pytest.approx((up - down) / (2 * step), rel=2e-2, abs=1e-5)


def test_windows_score_each_token_once_from_its_past():
    a = S.Attention(*_tables(), seed=5)
    r = np.random.default_rng(1)
    stream, ptr = r.integers(0, S.CLASSES, 250), np.array([0, 1, 1, 40, 250])
    got = a.log_probs(stream, ptr)
    for t in range(4):
        for i in range(ptr[t], ptr[t + 1]):
            at = i - ptr[t]
            low = at // S.STEP * S.STEP - S.CONTEXT  # the window's first place in the text
            x = np.array([S.CLASSES if p <= 0 else 0 if p > at else stream[ptr[t] + p - 1] for p in range(low, low + S.WINDOW)])  # what comes later doesn't matter
            one = a._scores(x[None], np.full((1, S.STEP), stream[i]), np.array([[p < 0 for p in range(low, low + S.WINDOW)]]))
            assert got[i] == pytest.approx(one[0, at - low - S.CONTEXT], abs=1e-4)


def test_scores_agree_with_the_trained_loss():
    a = S.Attention(*_tables(), seed=6)
    r = np.random.default_rng(4)
    stream = r.integers(0, S.CLASSES, S.STEP)  # one text of one window: the loss sees what scoring sees
    windows = S.training_windows(stream, np.array([0, len(stream)]), np.array([0]), 1, S.CLASSES)
    assert windows.shape == (1, S.WINDOW + 2) and (windows[0, :2] == S.CLASSES).all() and (windows[0, 2 + S.STEP :] == S.CLASSES + 1).all()
    a.w["pos"] = np.roll(a.w["pos"], -S.CONTEXT, 0)  # scoring has the context before the text
    loss, _ = a._gradients(windows[:, :-1].astype(np.int64), windows[:, 2:].astype(np.int64))
    a.w["pos"] = np.roll(a.w["pos"], S.CONTEXT, 0)
    assert -a.log_probs(stream, np.array([0, len(stream)])).mean() == pytest.approx(loss, rel=1e-4)


def test_scoring_stays_in_the_cache():
    """Windows are scored so few at a time that all their arrays have some 3 MB, however long the text is."""
    a, stream = S.Attention(*_tables(), seed=6), np.random.default_rng(4).integers(0, S.CLASSES, 60_000)
    a.log_probs(stream[:100], np.array([0, 100]))
    tracemalloc.start()
    got = a.log_probs(stream, np.array([0, len(stream)]))
    held = got.nbytes + 2 * 8 * (len(stream) // S.STEP + 1) + sum(x.nbytes for x in (*a.once["group"], *a.once["member"]))
    assert tracemalloc.get_traced_memory()[1] < held + (4 << 20)
    tracemalloc.stop()


def test_large_logits_and_odd_batches():
    """Sums of exp beyond a float32, and rows that don't fill the parts of products, give the loss and slopes that float64 gives."""
    a, b = (S.Attention(*_tables(), seed=3) for _ in range(2))
    a.w["q"] *= 150
    a.w["ug"] *= 900
    b.w = {k: v.astype(np.float64) for k, v in a.w.items()}
    r = np.random.default_rng(0)
    x, y = r.integers(0, S.CLASSES, (21, S.WINDOW + 1)), r.integers(0, S.CLASSES + 30, (21, S.WINDOW))
    (loss, g), (want, h) = a._gradients(x, y), b._gradients(x, y)
    assert loss == pytest.approx(want, rel=1e-3)
    for name in h:
        assert np.abs(g[name] - h[name]).max() < 0.02 * np.abs(h[name]).max(), name


def test_words_of_many_slices_add_up(monkeypatch):
    monkeypatch.setattr(S, "slices", lambda batch: ((batch.slice(k, 1), texts_of(batch.column("text").slice(k, 1))) for k in range(batch.num_rows)))
    texts = [" ".join(f"W{i * j % 11}" for j in range(i % 6)) for i in range(50)]
    train, bucket = [i % 3 > 0 for i in range(50)], [i % 2 for i in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(train), pa.array(bucket, pa.int32())], ["text", "train", "bucket"])
    got = pa.Table.from_batches(S._bucket_words()(iter([batch]))).to_pylist()
    want = collections.Counter()
    for text, t, b in zip(texts, train, bucket):
        hashes = texts_of(pa.array([text])).lower().words().hashes().view(np.int64).tolist()
        for h in [*hashes, int(S.END_HASH)]:
            want[b, h] += t
    assert len(got) == len(want) and {(r["bucket"], r["hash"]): r["n"] for r in got} == want


def test_training_learns_an_order():
    r = np.random.default_rng(2)
    stream = (np.arange(12000) * 3 + (r.random(12000) < 0.02)) % 50
    windows = np.concatenate([S.training_windows(stream, np.array([0, len(stream)]), np.array([k]), 4, S.CLASSES) for k in range(4)])
    assert len(windows) == -(-12000 // S.WINDOW)
    assert S.Attention(seed=1).train(windows, 150) < 1.5 < math.log(50)


def test_every_window_is_learned_from(spark, monkeypatch):
    """However large the fold is said to be, and in however many partitions, each of its windows is in one round."""
    with open(S.TOKENIZER, "rb") as f:
        subwords = S.Subwords(f.read())
    texts = [" ".join(f"w{i} to{k}" for k in range(i % 7 * 30)) for i in range(40)]
    counts, want = np.zeros(subwords.end + 1), 0
    for text in texts:
        words_ = texts_of(pa.array([text])).words()
        ids, _ = S.token_stream(words_, words_.hashes(), subwords)
        np.add.at(counts, ids, 1_000_000)
        want += -(-len(ids) // S.WINDOW)
    rows = spark.createDataFrame([(t, True) for t in texts] + [(t + " x", False) for t in texts], "text string, train boolean").repartition(3)
    seen, mean = [], S._mean_weights
    monkeypatch.setattr(S, "_mean_weights", lambda parts: (seen.append(sum(n for _, n in parts)), mean(parts))[1])
    S.fit(rows, counts, spark.sparkContext.broadcast(subwords.model.serialized_model_proto()))
    assert len(seen) == S.ROUNDS and sum(seen) == want
    weights = [(pickle.dumps({"a1": np.full(1, x, np.float32)}), n) for x, n in ((1.0, 1), (4.0, 2))]
    assert mean(weights)["a1"] == pytest.approx(3) and mean(weights[::-1])["a1"] == pytest.approx(3)


def test_a_shard_begins_where_the_others_did():
    """Shards that one worker trains after one another get the same broadcast value; none goes on from another's weights."""
    rows = np.random.default_rng(3).integers(0, 50, (40, S.WINDOW + 2)).astype(np.uint16)
    batch = pa.RecordBatch.from_arrays([pa.array([5]), pa.array([rows.tobytes()], pa.binary())], ["key", "windows"])
    attention, classes = (types.SimpleNamespace(value=x) for x in (S.Attention(*_tables(), seed=8), np.arange(50)))
    before = {k: v.copy() for k, v in attention.value.w.items()}
    first, second = (next(S._train_shard(attention, classes, 0)(iter([batch]))).column("weights")[0].as_py() for _ in range(2))
    assert first == second
    assert all((attention.value.w[k] == v).all() for k, v in before.items()) and (pickle.loads(first)["uc"] != before["uc"]).any()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="the driver's tables are not here")
def test_model_base_and_mixture(spark):
    """On held-out texts the attention model alone is better than the base, and the mixture better than both."""
    got = S.lm_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").toPandas()
    base, model, score = (got[c].sum() / got.n_tokens.sum() for c in ("base_score", "model_score", "score"))
    print(f"log10 a token: base {base:.3f}, model {model:.3f}, mixture {score:.3f}")
    assert base < model < score - 0.1
    assert (got.score >= got.model_score + math.log10(S.SHARE) * got.n_tokens - 1e-6).all()


def test_code_lengths_follow_the_escape_rule():
    texts = ["abcabd", "xyzxyz"]
    grams = {}
    for k, t in enumerate(texts):
        tx = texts_of(pa.array([t]))
        g, n = np.unique((I.contexts(tx).astype(np.int64) << 8) | tx.data, return_counts=True)
        grams[f"l{k}"] = (g, n)
    trees = I.Trees(grams)

    def bits(train, text):
        counts = collections.defaultdict(collections.Counter)
        s = "\n\n\n" + train
        for i in range(3, len(s)):
            for o in range(4):
                counts[s[i - o : i]][s[i]] += 1
        total, s = 0.0, "\n\n\n" + text
        for i in range(3, len(s)):
            p = 1.0
            for o in (3, 2, 1, 0):
                c = counts.get(s[i - o : i])
                if not c:
                    continue
                size = sum(c.values()) + len(c)
                if s[i] in c:
                    p *= c[s[i]] / size
                    break
                p *= len(c) / size
            else:
                p /= 256
            total -= math.log2(p)
        return total

    tests = ["abca", "xyab", "q", "", "xyzx abc"]
    got = trees.code_lengths(texts_of(pa.array(tests)))
    for i, t in enumerate(tests):
        for k in range(2):
            assert got[i, k] == pytest.approx(bits(texts[k], t), rel=1e-5)


def test_languages_held_out(spark):
    r = random.Random(3)
    parts = {"aa": ["ka", "to", "mi", "shi"], "bb": ["schl", "ung", "der", "ein"]}
    docs = [(i, " ".join("".join(r.choice(parts[lang]) for _ in range(3)) for _ in range(30)), lang, None, 0) for i in range(80) for lang in [("aa", "bb")[i % 2]]]
    docs += [(1000, None, "aa", None, 0), (1001, "123 !?", "aa", None, 0), (1002, "", None, None, 0), (1003, "мир", None, None, 0)]
    got = {x.doc_id: x for x in I.language_id(documents(spark, docs)).collect()}
    assert len(got) == 84
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1003].lang_pred in ("aa", "bb")
    held = [i for i in range(80) if got[i].held_out]
    assert held and all(zlib.crc32(str(i).encode()) % 4 == 2 for i in held)
    assert all(got[i].lang_pred == docs[i][2] for i in held)
    assert all(0 <= x.score <= 1 for x in got.values())
    assert I.language_id(empty(spark)).count() == 0
    assert {x.lang_pred for x in I.language_id(documents(spark, [(1, "abc", None, None, 3)])).collect()} == {"und"}


def test_parts_of_the_trees_add_up(spark):
    """Trees in many parts give what one part gives, for repeated rows and a text of over 1 MB too."""
    docs = documents(spark)
    docs = docs.union(docs.where("doc_id in (3, 8)")).union(docs.where("doc_id = 1").withColumn("doc_id", F.lit(5000).cast("long")).withColumn("text", F.expr("repeat(text, 20000)")))
    assert docs.where("length(text) > 1100000").count() == 1
    seen = I.Grams.count(docs, 300)
    assert len(seen.parts) > 2 and [k for p in seen.parts for k in p] == list(range(I.KEYS))
    many, one = (I.language_id(docs, most_grams=n).orderBy("doc_id", "score").collect() for n in (300, 1 << 20))
    assert len(one) == docs.count() and [x[:3] for x in one] == [x[:3] for x in many]
    assert [x.score for x in many] == pytest.approx([x.score for x in one], rel=1e-6)


def test_rule_counts(spark):
    got = {x.doc_id: x for x in Q.quality_rules(documents(spark)).collect()}
    for i, text, *_ in corpus():
        text = text or ""
        w = words(text)
        c = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        twice = set()
        for k in range(len(w) - 7):
            if c[tuple(w[k : k + 8])] > 1:
                twice |= set(range(k, k + 8))
        lines = [x for x in text.split("\n") if words(x)]
        want = (len(w), sum(map(len, w)), sum(text.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(twice))
        x = got[i]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want
        assert x.base_failed == (len(w) < 20 or 100 * len(twice) > 30 * len(w))
        assert not (x.kept and x.base_failed)
    assert Q.quality_rules(empty(spark)).count() == 0


def test_kneser_ney_is_a_distribution():
    r = np.random.default_rng(4)
    table = np.zeros(Q.CLASSES * Q.CLASSES, np.int64)
    grams = (r.zipf(1.5, 20_000) % 40) * Q.CLASSES + 1 + r.zipf(1.5, 20_000) % (Q.CLASSES - 1)
    np.add.at(table, grams, 1)
    model = Q.KneserNey.fit(table)
    for left in (1, 2, 3, 39):
        row = np.exp2(model.log_prob(np.arange(1, Q.CLASSES) + left * Q.CLASSES))
        assert row.sum() == pytest.approx(1, abs=1e-3)
    assert model.log_prob(np.array([1 * Q.CLASSES + 2]))[0] > model.log_prob(np.array([1 * Q.CLASSES + 2000]))[0]


def test_odd_text_leaves_the_band(spark):
    r = random.Random(6)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(40)]
    docs = [(i, " ".join(r.choice(vocabulary) for _ in range(120)), "en", None, 0) for i in range(120)]
    docs.append((999, " ".join("".join(r.choice("qrstuvwxyz0123456789") for _ in range(9)) for _ in range(120)), "en", None, 0))
    got = {x.doc_id: x.kept for x in Q.quality_rules(documents(spark, docs)).collect()}
    assert [i for i, k in got.items() if not k] == [999]
    kept = Q.keep_quality(documents(spark, docs))
    assert kept.count() == 120 and kept.columns == documents(spark, []).columns


def test_junk_leaves_the_band_and_copies_stay(spark):
    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdefghijkl") for _ in range(r.randrange(3, 8))) for _ in range(400)]
    pick = lambda n: r.choices(vocabulary, [1 / (k + 50) for k in range(400)], k=n)
    good = [" ".join(pick(150)) for _ in range(200)]
    lists = [" | ".join(pick(80)) for _ in range(8)]
    symbols = [" ".join(w + r.choice(["###", "&&&", "%%%"]) for w in pick(150)) for _ in range(8)]
    texts = good + good[:5] * 4 + lists + symbols
    got = {x.doc_id: x for x in Q.quality_rules(documents(spark, [(i, t, "en", None, len(t)) for i, t in enumerate(texts)])).collect()}
    assert not any(x.base_failed for x in got.values())
    assert [i for i in range(len(texts)) if not got[i].kept] == list(range(220, 236))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="the driver's tables are not here")
def test_labelled_junk_goes(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.quality_rules(docs).where("not base_failed").join(labels, "doc_id").select("quality", "kept").collect()
    kept = {q: [x.kept for x in rows if x.quality == q] for q in (0, 1)}
    assert len(kept[0]) > 10 and sum(kept[0]) <= 0.1 * len(kept[0])
    assert len(kept[1]) > 100 and sum(kept[1]) >= 0.99 * len(kept[1])
