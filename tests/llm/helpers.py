"""Small frames with the awkward rows that every operator meets."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORD.findall(text or "")


def corpus(n=60, seed=7):
    """Documents of a small vocabulary: near copies, exact copies, repeated lines, long and short texts, nulls."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgé") for _ in range(r.randrange(2, 7))) for _ in range(80)]
    lines = [" ".join(r.choice(vocabulary) for _ in range(r.randrange(6, 14))).capitalize() + "." for _ in range(40)]
    docs = []
    for i in range(n):
        if i % 5 == 4:  # a near copy of an earlier text
            w = docs[r.randrange(i)][1].split(" ")
            for _ in range(r.randrange(0, 3)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            text = " ".join(w)
        else:
            text = "\n".join(r.choice(lines) if r.random() < 0.4 else " ".join(r.choice(vocabulary) for _ in range(9)) for _ in range(r.randrange(1, 9)))
        docs.append((i, text))
    docs += [(900, None), (901, ""), (902, " \t\n "), (903, "one"), (904, "two words"), (905, "x" * 3000), (906, docs[3][1]), (907, docs[3][1]), (908, "日本語 テキスト 😀 " * 20), (909, " ".join(vocabulary) + " " + " ".join(r.choice(vocabulary) for _ in range(3000)))]
    return [(i, t, None if i % 11 == 5 else ("en", "fr")[i % 2], None if i % 13 == 2 else f"s{i % 3}", None if t is None else len(t)) for i, t in docs]


def documents(spark, rows=None):
    """The corpus with columns whose names clash with those that operators use."""
    df = spark.createDataFrame(corpus() if rows is None else rows, SCHEMA)
    return df.selectExpr("*", "1 as key", "'x' as region", "2 as bucket", "3 as id", "4 as a", "5 as b", "true as kept", "6 as spans", "7 as hash")


def empty(spark):
    return documents(spark, [])
