"""Line links against all pairs, and what dedup takes out."""

from __future__ import annotations

import itertools
import random

import pytest

from gneiss.llm import line_dedup as L

from .helpers import documents, empty, words


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mutated(r, s, k):
    s = list(s)
    for _ in range(k):
        p = r.randrange(len(s) + 1)
        s[p : p + r.randrange(2)] = r.choice(["", "a", "é", "😀"])
    return "".join(s)


def test_banded_distance(spark):
    r = random.Random(4)
    pairs = [(a := "".join(r.choice("abé😀") for _ in range(r.randrange(25))), mutated(r, a, r.randrange(5))) for _ in range(400)]
    df = spark.createDataFrame(pairs, "line_a string, line_b string")
    for d in (1, 2):
        for x in L.with_distance(df, d).collect():
            assert min(x.edits, d + 1) == min(edits(x.line_a, x.line_b), d + 1)


@pytest.mark.parametrize("crowd", [4, 256])
def test_links_against_all_pairs(spark, crowd):
    r = random.Random(5)
    base = ["".join(r.choice("abc ") for _ in range(r.randrange(16, 40))) for _ in range(30)]
    docs = [(i, "\n".join(mutated(r, r.choice(base), r.randrange(4)) for _ in range(r.randrange(5)))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    _, links = L.line_links(df, 2, 12, crowd)
    texts = {x.id: x.line for x in L._lines(df, 12).select("id", "line").distinct().collect()}
    want = {frozenset(p) for p in itertools.combinations(sorted(set(texts.values())), 2) if edits(*p) <= 2}
    got = [frozenset((texts[x.id_a], texts[x.id_b])) for x in links.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def brute(docs, least=32, short=False):
    """The rule itself: a line goes if it, or one within two edits, came before; short lines with a word only if asked for, exactly."""
    seen, brief, out = [], set(), {}
    for i, text in sorted(docs, key=lambda x: x[0]):
        kept, gone = [], 0
        for line in (text or "").split("\n"):
            if len(line) >= least and any(abs(len(line) - len(s)) <= 2 and edits(line, s) <= 2 for s in seen):
                gone += 1
            elif short and len(line) < least and line in brief:
                gone += 1
            else:
                kept.append(line)
            if len(line) < least and words(line):
                brief.add(line)
            if len(line) >= least and line not in seen:
                seen.append(line)
        out[i] = (gone, None if text is None else "\n".join(kept))
    return out


def test_what_goes(spark):
    a, b = "The quick brown fox jumps over the lazy dog today.", "The quick brown fox jumps over the lazy dogs today"
    docs = [(1, f"{a}\nshort\nshort"), (2, f"new line of its own, long enough to count\n{b}"), (3, a), (4, None), (5, ""), (6, f"{b}\n{b}\n")]
    got = {x.doc_id: (x.n_removed, x.text) for x in L.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs)
    assert got[1] == (0, docs[0][1]) and got[3] == (1, "")


def test_awkward_rows(spark):
    assert L.dedup_lines(empty(spark)).count() == 0
    df = documents(spark)
    out = L.dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_removed", "n_links"]
    want = brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert {r.doc_id: (r.n_removed, r.text) for r in out.collect()} == want
    line = "a line that is long enough to be looked at by the operator"
    twice = spark.createDataFrame([(1, line), (1, line), (None, line), (2, line)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in L.dedup_lines(twice).collect()) == [(0, line), (1, line), (1, line), (2, line)]


def test_short_repeats_go_exactly(spark):
    long = "a line that is long enough to be looked at by the operator"
    docs = [(1, "All rights reserved.\n\nAll rights reserved.\n \n \nx"), (2, f"All rights reserved\nx\n{long}\n日本語。"), (3, f"{long}s\n日本語。\nAll rights reserved."), (4, None), (5, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.text) for r in L.dedup_lines(df, short=True).collect()}
    assert got == {1: (1, "All rights reserved.\n\n \n \nx"), 2: (1, f"All rights reserved\n{long}\n日本語。"), 3: (3, ""), 4: (0, None), 5: (1, "")}


def test_query_compares_short_lines(spark, tmp_path):
    from gneiss.llm.queries import op9_line_dedup

    df = documents(spark, [(1, "Short line.\nown words", None, None, 21), (2, "Short line.\nother words", None, None, 23)])
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.n_removed for r in op9_line_dedup(spark, str(tmp_path)).collect()} == {1: 0, 2: 1}
