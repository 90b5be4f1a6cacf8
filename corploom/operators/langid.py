"""Language identification: naive Bayes over character n-grams, trained here."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corploom.functions.normalize import cat_tags
from corploom.functions.segment import chinese_system

#: n-grams a language keeps (a bound of the model), and labelled rows that the fit reads (a documented bound).
GRAMS, FIT_ROWS = 5_000, 20_000


def char_grams(text: str, most: int = 3) -> list[str]:
    t = f" {' '.join(text.lower().split())} "
    return [t[i : i + n] for n in range(1, most + 1) for i in range(len(t) - n + 1)]


class LanguageModel:
    """Log probabilities of the frequent n-grams of each language, with one for all others."""

    def __init__(self, counts: dict[str, Counter]) -> None:
        self.tables, self.rest = {}, {}
        vocabulary = len({g for c in counts.values() for g, _ in c.most_common(GRAMS)}) or 1
        for lang, c in counts.items():
            top = dict(c.most_common(GRAMS))
            total = sum(top.values()) + 0.5 * vocabulary
            self.tables[lang] = {g: math.log((n + 0.5) / total) for g, n in top.items()}
            self.rest[lang] = math.log(0.5 / total)

    def scores(self, text: str, langs: tuple[str, ...] | None = None) -> list[tuple[float, str]]:
        grams = Counter(char_grams(text))
        out = []
        for lang, table in self.tables.items():
            if langs is None or lang in langs:
                rest = self.rest[lang]
                out.append((sum(n * table.get(g, rest) for g, n in grams.items()), lang))
        return sorted(out, key=lambda x: (-x[0], x[1]))


def fit(texts: DataFrame, text_col: str, lang_col: str, rows: int = FIT_ROWS) -> LanguageModel:
    """The n-grams of a bounded sample (by hash of the text) of labelled texts; null and blank ones are left out."""
    from corploom.operators.skew import hash_sample

    known = texts.select(F.col(text_col).alias("t"), F.lower(F.trim(lang_col)).alias("l")).where("t IS NOT NULL AND l IS NOT NULL AND trim(t) <> ''")
    counts: dict[str, Counter] = {}
    for r in hash_sample(known.withColumn("k", F.xxhash64("t")), "k", rows).toLocalIterator():
        counts.setdefault(r["l"], Counter()).update(char_grams(r["t"]))
    return LanguageModel(counts)


def detector(spark, model: LanguageModel, langs: tuple[str, ...] | None = None):
    """A Column function: the most probable language of a text; null for null and blank texts."""
    shared = spark.sparkContext.broadcast(model)

    def run(texts: pd.Series) -> pd.Series:
        def one(t):
            got = shared.value.scores(t, langs) if t and t.strip() else []
            return got[0][1] if got else None

        return texts.map(one)

    return F.pandas_udf(run, T.StringType())


def top_languages(spark, model: LanguageModel, n: int = 3):
    """A Column function: the n most probable languages, best first."""
    shared = spark.sparkContext.broadcast(model)

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [x for _, x in shared.value.scores(t)[:n]] if t and t.strip() else [])

    return F.pandas_udf(run, T.ArrayType(T.StringType()))


def refine_chinese(lang: Column, text: Column) -> Column:
    """zh as zhs or zht, if the text's characters tell."""
    return F.when(lang == "zh", F.coalesce(chinese_system(text), F.lit("zhs"))).otherwise(lang)


def of_language(texts: DataFrame, text_col: str, lang: str, detect) -> DataFrame:
    """Rows whose text, without translation-tool tags, is detected as ``lang``; null and blank texts are of none."""
    return texts.where(detect(cat_tags(F.col(text_col))) == lang)
