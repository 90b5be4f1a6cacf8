"""Similarity of two texts, from 0 to 1. Two empty texts are alike (1); a null text gives null."""

from __future__ import annotations

import difflib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from corploom.functions.segment import word_count


def length_ratio(a: Column, b: Column, unit: str = "word") -> Column:
    """Shorter through longer length, in words or characters; null if both are 0."""
    m, n = (word_count(a), word_count(b)) if unit == "word" else (F.length(a), F.length(b))
    return F.when(m.isNotNull() & n.isNotNull(), F.least(m, n) / F.nullif(F.greatest(m, n), F.lit(0)))


def length_similarity(a: Column, b: Column, unit: str = "char") -> Column:
    """As the ratio, but 1 if both are empty."""
    return F.when((a == "") & (b == ""), 1.0).otherwise(F.coalesce(length_ratio(a, b, unit), F.when(a.isNotNull() & b.isNotNull(), 1.0)))


def levenshtein(a: Column, b: Column) -> Column:
    """1 less the edit distance through the longer length, inside the JVM."""
    return F.when((a == "") & (b == ""), 1.0).otherwise(1 - F.levenshtein(a, b) / F.nullif(F.greatest(F.length(a), F.length(b)), F.lit(0)))


def _characters(a: Column, b: Column, how: Callable[[Column, Column, Column], Column]) -> Column:
    """From the sizes of both character multisets and of their intersection."""
    chars = F.array_distinct(F.split(a, ""))
    count = lambda t, c: F.length(t) - F.length(F.replace(t, c, F.lit("")))
    both = F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0), lambda s, c: s + F.least(count(a, c), count(b, c)).cast("int"))
    return F.when((a == "") & (b == ""), 1.0).when((a == "") | (b == ""), 0.0).otherwise(how(both, F.length(a), F.length(b)))


def jaccard(a: Column, b: Column) -> Column:
    """Over character multisets."""
    return _characters(a, b, lambda n, x, y: n / (x + y - n))


def dice(a: Column, b: Column) -> Column:
    """Sørensen and Dice, over character multisets."""
    return _characters(a, b, lambda n, x, y: 2 * n / (x + y))


def cosine(a: Column, b: Column) -> Column:
    """Multiset intersection through the geometric mean of the lengths."""
    return _characters(a, b, lambda n, x, y: n / F.sqrt(x.cast("double") * y))


def _damerau(a: str, b: str) -> float:
    """Optimal string alignment distance: adjacent exchanges count once."""
    before, now = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, now = before, now, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            now.append(d)
    return 1 - now[-1] / max(len(a), len(b))


def _jaro(a: str, b: str) -> float:
    window = max(0, max(len(a), len(b)) // 2 - 1)
    taken, first = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - window), min(len(b), i + window + 1)):
            if not taken[j] and b[j] == x:
                taken[j] = True
                first.append(x)
                break
    if not first:
        return 0.0
    n = len(first)
    moved = sum(x != y for x, y in zip(first, (y for y, t in zip(b, taken) if t))) // 2
    return (n / len(a) + n / len(b) + (n - moved) / n) / 3


def _jaro_winkler(a: str, b: str) -> float:
    s = _jaro(a, b)
    same = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return s + 0.1 * same * (1 - s) if s > 0.7 else s


def _ratcliff(a: str, b: str) -> float:
    return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


def _pairwise(f: Callable[[str, str], float]):
    def batch(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else 1.0 if x == y else 0.0 if not x or not y else f(x, y) for x, y in zip(a, b)], dtype="float64")

    return batch


def _udf(f: Callable[[str, str], float], a: Column, b: Column) -> Column:
    plain = _pairwise(f)

    def batch(x: pd.Series, y: pd.Series) -> pd.Series:
        return plain(x, y)

    return F.pandas_udf(batch, T.DoubleType())(a, b)


METRICS: dict[str, Callable[[Column, Column], Column]] = {
    "levenshtein": levenshtein, "jaccard": jaccard, "sorensen_dice": dice, "cosine": cosine,
    "damerau": lambda a, b: _udf(_damerau, a, b), "jaro": lambda a, b: _udf(_jaro, a, b), "jaro_winkler": lambda a, b: _udf(_jaro_winkler, a, b), "ratcliff_obershelp": lambda a, b: _udf(_ratcliff, a, b),
}


def similarity(a: Column, b: Column, metric: str = "levenshtein") -> Column:
    return METRICS[metric](a, b)
