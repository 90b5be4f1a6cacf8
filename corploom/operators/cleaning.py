"""Segment cleaning: filters, routing and the whole pipeline. Every step is narrow; only deduplication shuffles."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from corploom.functions import segment as S
from corploom.functions.normalize import cat_tags, humanize_by_language, humanize_table, trim_unicode
from corploom.operators.relational import keep_first


def clean_segments(texts: DataFrame, id_col: str, text_col: str, lang: str = "eng", least: int = 8, most: int = 100) -> DataFrame:
    """(id, pos, text): humanized sentences with the word length and shape of a segment, in order of the text."""
    plain = humanize_table(texts.select(id_col, text_col), text_col, lang)
    out = plain.select(F.col(id_col), F.posexplode(S.split_sentences(F.col(text_col), lang)).alias("pos", "text"))
    return out.where(S.has_word_length(F.col("text"), least, most) & S.is_sentence(F.col("text"), lang))


def clean_by_language(texts: DataFrame, id_col: str, text_col: str, lang_col: str, langs: Sequence[str], least: int = 8, most: int = 100) -> DataFrame:
    """(id, lang, pos, text): as clean_segments, each row by the rules of its language (ISO 639-3), in one pass over the table.

    Rows of other or null languages lose mark-up only, and are split and judged as Latin texts.
    """
    is_lang = [(F.col(lang_col) == lang, lang) for lang in langs]

    def by_language(rule: Callable[[str], Column]) -> Column:
        return functools.reduce(lambda c, x: F.when(x[0], rule(x[1])).otherwise(c), reversed(is_lang), rule(""))

    plain = humanize_by_language(texts.select(id_col, lang_col, text_col), text_col, is_lang)
    out = plain.select(id_col, lang_col, F.posexplode(by_language(lambda lang: S.split_sentences(F.col(text_col), lang))).alias("pos", "text"))
    return out.where(S.has_word_length(F.col("text"), least, most) & by_language(lambda lang: S.is_sentence(F.col("text"), lang)))


def without_tags(lines: DataFrame, text_col: str, order: str) -> DataFrame:
    """Lines without translation-tool tags, the first of each."""
    return keep_first(lines.withColumn(text_col, cat_tags(F.col(text_col))), [text_col], [order])


def drop_single_tokens(lines: DataFrame, text_col: str, order: str) -> DataFrame:
    """The first of each line, if it has more than one word."""
    return keep_first(lines.where(S.word_count(F.col(text_col)) > 1), [text_col], [order])


def route_by_language(pairs: DataFrame, lang: Column, noise: str = "en") -> tuple[DataFrame, DataFrame]:
    """(clean, noise) pairs by the detected language of the target; an unknown language is clean."""
    is_noise = F.coalesce(lang == noise, F.lit(False))
    return pairs.where(~is_noise), pairs.where(is_noise)


def untranslated(source: DataFrame, target: DataFrame, key: str, src: str, tgt: str) -> DataFrame:
    """(key, src, tgt, translated): source lines with their target lines; blank, null or missing targets are untranslated."""
    joined = source.select(key, src).join(target.select(key, tgt), key, "left")
    return joined.withColumn("translated", trim_unicode(F.coalesce(F.col(tgt), F.lit(""))) != "")


def same_as_memory(machine: DataFrame, memory: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, memory_text, same): machine output against the memory's target, blanks at the ends aside."""
    return machine.select(key, text).join(memory.select(key, F.col(text).alias("memory_text")), key).withColumn("same", F.coalesce(trim_unicode(F.col(text)) == trim_unicode(F.col("memory_text")), F.lit(False)))


def by_year(df: DataFrame, date_col: str, year: str) -> DataFrame:
    """Rows whose date begins with the year; all rows for 'all'."""
    return df.where((F.lit(year) == "all") | (F.split(F.col(date_col), "-")[0] == year))


def batches(lines: DataFrame, key: str, size: int) -> DataFrame:
    """Column ``batch``: lines in batches of ``size`` by their number."""
    return lines.withColumn("batch", F.floor(F.col(key) / size).cast("long"))


def translate(lines: DataFrame, text_col: str, translator, out_col: str = "translation") -> DataFrame:
    """A pluggable translator of lists of texts, called once an Arrow batch. A batch that fails gives null for its rows only."""
    import pandas as pd

    names = [f.name for f in lines.schema.fields]
    schema = T.StructType([*lines.schema.fields, T.StructField(out_col, T.StringType())])

    def run(parts):
        for pdf in parts:
            try:
                got = list(translator([None if x is None else str(x) for x in pdf[text_col]]))
                if len(got) != len(pdf):
                    got = [None] * len(pdf)
            except Exception:  # noqa: BLE001 - a service's failure must not end the job
                got = [None] * len(pdf)
            yield pdf[names].assign(**{out_col: pd.Series(got, index=pdf.index, dtype="object")})

    return lines.mapInPandas(run, schema)
