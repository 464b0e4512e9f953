"""Similarity of texts by longest common subsequences, and the name rules built on it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from gneiss.functions.fixed import LEGAL_TOKENS


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel: a zero bit of the row marks a step."""
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        met = row & at.get(y, 0)
        row = (row + met | row - met) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the common subsequence over both lengths; two empty texts are alike."""
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def sorted_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def set_ratio(a: str, b: str) -> float:
    """The best ratio of the common tokens and each side's with its own added; 1 if one side has all tokens of the other."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = x & y
    if both and (x <= y or y <= x):
        return 1.0
    common, left, right = (" ".join(sorted(s)) for s in (both, x - y, y - x))
    one, two = (f"{common} {s}".strip() for s in (left, right))
    return max([ratio(one, two)] + [ratio(common, s) for s in (one, two) if both])


@pandas_udf(DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else sorted_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


@pandas_udf(DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else set_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def _tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, " "), lambda w: w != ""))


def name_similarity(a: Column, b: Column, is_org: Column) -> Column:
    """Similarity of two comparable names.

    People: sorted tokens; organisations: the mean of sorted and set ratios.
    Different numbers cap it at 0.89. Differences of legal forms and articles
    alone, or of a few short fragments, raise an organisation's to 0.96, of
    initials alone a person's.
    """
    plain = token_sort_ratio(a, b)
    base = F.when(is_org, 0.5 * plain + 0.5 * token_set_ratio(a, b)).otherwise(plain)
    x, y = _tokens(a), _tokens(b)
    numbers = [F.array_sort(F.filter(t, lambda w: w.rlike("^[0-9]+$"))) for t in (x, y)]
    apart = F.array_union(F.array_except(x, y), F.array_except(y, x))
    rest = F.array_except(apart, F.array(*[F.lit(t) for t in LEGAL_TOKENS]))
    letters = F.aggregate(rest, F.lit(0), lambda n, w: n + F.length(w))
    fragments = (F.size(rest) <= 3) & F.forall(rest, lambda w: F.length(w) <= 2) & (letters <= 4)
    initials = F.forall(apart, lambda w: F.length(w) == 1)
    raised = (F.size(apart) > 0) & F.when(is_org, fragments).otherwise(initials)
    return F.when(numbers[0] != numbers[1], F.least(base, F.lit(0.89))).when(raised, F.greatest(base, F.lit(0.96))).otherwise(base)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres on a sphere of radius 6371 km."""
    dy, dx = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = F.pow(F.sin(dy / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dx / 2), 2)
    return 2 * 6_371_000.0 * F.asin(F.sqrt(h))
