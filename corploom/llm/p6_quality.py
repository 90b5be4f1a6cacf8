"""Problem 6: per-document text quality statistics, and texts that are no natural prose.

Five statistics of every text are built-in expressions (word count, mean word length, symbol ratio, share of lines that end
in punctuation, share of words that are among the ``COMMON`` most frequent ones of the language over all texts); five more
measure cells, items, broken characters, code and heaped or repeated words. The ten are ranked exactly within their
language, over its different texts, so that copies can't hide themselves: the different values, counted before any shuffle,
are range-partitioned by (statistic, language, value) and sorted; sums by partition give the offsets, and each partition adds
up its own counts. So no partition needs to hold a language or a hot value.

The outlier score of a text is the sum of -ln of its ten empirical tail probabilities, each in its abnormal direction; with
every language go ``PRIOR_TEXTS`` plain texts, which decide only where it has hardly any. A text is no prose if the share of
its lines (characters, words) that are of a kind, times the outlier score, is ``LEAST_SCORE`` or more: half a list among
outstanding lines counts as much as a whole one among common ones. Broken characters count whole from ``BROKEN_WHOLE`` on.

Null and blank texts, and rows with a null id, have no row among the found; their statistics are null (count 0). A null language is a language of its
own. Repeated rows are treated each; tied values share their rank. Empty tables give empty results.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corploom.operators.skew import hot_key_join
from corploom.session import cut, spread, table

COMMON = 30
#: Different values of a range partition, and rows of a counted table that may be broadcast.
ROWS_A_PARTITION, SMALL_ROWS = 500_000, 100_000
#: Plain texts that go with every language, the score from which a text is no prose, and the share of broken characters that counts whole.
PRIOR_TEXTS, LEAST_SCORE, BROKEN_WHOLE = 50, 3.0, 0.06
WORDS = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]|[\p{L}\p{M}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}]]+"
ENDS = r"[.!?…。！？؟।．\"”»’)\]」』]\s*$"
#: Statistic -> whether high values are the abnormal ones.
DIRECTIONS = {"word_count": False, "mean_word_length": True, "symbol_ratio": True, "line_end_share": False, "common_share": False, "cells": True, "items": True, "broken": True, "code": True, "heap": True}
#: Of these a plain text has none.
KINDS = ("cells", "items", "broken", "code", "heap")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0))


def small(df: DataFrame) -> DataFrame:
    """A written frame, marked for broadcast if it was counted and is small."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def common_words(texts: DataFrame) -> DataFrame:
    """(key, common array<string>): the most frequent words of each language, over all texts."""
    counts = texts.select(F.coalesce("lang", F.lit("")).alias("key"), F.explode(words_of(F.col("texts"))).alias("word")).groupBy("key", "word").count()
    # ties are broken by the word, so that the list is the same every time
    top = counts.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("count"), "word"))).where(F.col("r") <= COMMON)
    return top.groupBy("key").agg(F.array_sort(F.collect_list("word")).alias("common"))


def statistics(texts: DataFrame) -> DataFrame:
    """(text_id, lang, texts, word_count, mean_word_length, symbol_ratio, line_end_share, common_share)."""
    words = words_of(F.col("texts"))
    n = F.size("words")
    lines = F.filter(F.split("texts", "\n"), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " ")) != "")
    visible = F.length(F.regexp_replace("texts", r"(?U)\s+", ""))
    symbols = F.length(F.regexp_replace("texts", r"(?U)[\p{L}\p{M}\p{N}\s]+", ""))
    known = texts.withColumn("key", F.coalesce("lang", F.lit(""))).join(small(cut(common_words(texts))), "key", "left")
    return (
        known.select("text_id", "lang", "texts", F.coalesce("common", F.array().cast("array<string>")).alias("common"), words.alias("words"), lines.alias("lines"))
        .select(
            "text_id", "lang", "texts", F.greatest(n, F.lit(0)).alias("word_count"),
            F.when(n > 0, F.aggregate("words", F.lit(0), lambda s, w: s + F.length(w)) / n).alias("mean_word_length"),
            F.when(visible > 0, symbols / visible).alias("symbol_ratio"),
            F.when(F.size("lines") > 0, F.size(F.filter("lines", lambda x: x.rlike(ENDS))) / F.size("lines")).alias("line_end_share"),
            F.when(n > 0, F.size(F.filter("words", lambda w: F.array_contains("common", w))) / n).alias("common_share"),
        )
    )


_MARKER = re.compile(r"^\s*(?:([-–—])|[*•→·>+‣▪◦]|\(?\d{1,4}\s?[.)]|\(?[a-zA-Z]\)|[a-z]\.|[ivx]+[.)]|\d{1,3} [-–])\s+")
_LEADER = re.compile(r"\S\s*(?:\.{4,}|…{2,}|_{4,}|(?:\. ){4,})\s*\d*\s*$")
_END = re.compile(r"[.!?…。！？؟।．|][\"”»’)\]」』]*$")
_BAD = re.compile("[�□¤\x80-\x9f]|[ÃÂÐÑØÙàáâãäåæçèéï][\x80-\xbf]|\\w¿\\w|\\w\\?\\w")
_CODE = re.compile(r"[{}]\s*$|\{\w+:|^\s*</?\w+|^\s*&#?\w+;|function\s*\(|0x[0-9a-f]{4,}|^\d{4}-\d\d-\d\d[T ]\d|^[A-Za-z0-9+/]{24,}={0,2}$|==|\w+\(\w*\)|^\s*(?:import|def|var|let|const|return|SELECT)\b")
_CELL = re.compile(r"\t| ?\| ?|;| {2,}")
_VALUE = re.compile(r"^\s*(?:[\d.,/%:\-  ]+|n/?a|)\s*$", re.I)
_PERIOD = re.compile(r"^\W*(.{1,60}?)(?:\s*[,/;.]?\s*\1){4,}", re.S)
_MARKS_ON = re.compile("[\u0300-\u036f\u0900-\u0903\u093a-\u094f\u0951-\u0957\u0962\u0963\u0e31\u0e34-\u0e3a\u0e47-\u0e4e\u064b-\u065f\u0670]")
_FUNCTION = set("the of and to in a is was for on with as by at that it le la les de du des et à un une l d que qui en dans pour der die das und den dem hat ein eine im am für el los las y que se por con un una в и на не что с по".split())


def cells_of(line: str) -> int:
    """Number of cells of a row of a table; 0 if the line is none."""
    s = line.rstrip("\r")
    for sep in ("\t", "|", ";"):
        if sep == "|" and re.search(r"[\u0900-\u097f]\s?\|(?!\s.*\|\s*$)", s) and not s.startswith("|"):
            continue  # a danda
        if s.count(sep) >= (1 if sep == "\t" else 2):
            parts = s.strip(" |").split(sep)
            if len(parts) > 1 and sum(len(p.split()) <= 5 for p in parts) >= 0.8 * len(parts):
                return len(parts)
    parts = s.split(",")
    if len(parts) > 2 and s.count(", ") <= 0.2 * len(parts) and all(len(p.split()) <= 4 for p in parts):
        return len(parts)
    parts = re.split(r" {2,}", s.strip())
    if len(parts) > 1 and all(len(p.split()) <= 5 for p in parts):
        return len(parts)
    if re.search(r"[^\W\d]\d{2}/\d{2}/\d{4}|[^\W\d]\d+\.\d\d(?:\s|$)", s) and len(s.split()) <= 8:
        return 2
    return 0


def shape(text: str) -> tuple[float, float, float, float, float]:
    """(cells, items, broken, code, heap): shares from 0 to 1."""
    lines = [x for x in text.split("\n") if x.strip()]
    if not lines:
        return 0.0, 0.0, 0.0, 0.0, 0.0
    n = len(lines)
    visible = sum(not c.isspace() for c in text)
    row = [cells_of(x) for x in lines]
    cells = sum(k > 0 for k in row) / n if n > 1 or max(row) >= 4 else 0.0
    if cells:
        # a table's rows mostly hold values: numbers, dates or nothing
        parts = [p for x, k in zip(lines, row) if k for p in re.split(r"\t|\||;|,(?! )| {2,}", x.strip())[1:]]
        cells *= min(1.0, 2.5 * sum(bool(_VALUE.match(p.strip('"'))) for p in parts) / max(len(parts), 1))
    broken = len(_BAD.findall(text)) / visible
    items = 0
    ended = sum(bool(_END.search(x.strip())) for x in lines)
    loose = n >= 4 and ended <= 0.35 * n
    for x in lines:
        s = x.strip()
        m = _MARKER.match(x)
        rest = s[m.end() - (len(x) - len(x.lstrip())) :] if m else s
        words = len(rest.split())
        thai = any("฀" <= c <= "๿" for c in rest[:8])
        short = len(rest) <= 26 if thai else words <= 10
        if _LEADER.search(s):
            items += 1
        elif m and not (m.group(1) and words >= 6 and (_END.search(s) or m.group(1) == "—")) and not (thai and not short):
            items += 1
        elif loose and short and not s.endswith(",") and (len(s) <= 90):
            items += 1
    if loose and not any(_MARKER.match(x) or _LEADER.search(x) for x in lines):
        # unmarked lines: a wrapped text has lines of several words that go on in lower case
        open_lines = [(a.strip(), b.strip()) for a, b in zip(lines, lines[1:]) if not _END.search(a.strip())]
        flow = sum(b[:1].islower() or b[:1].isdigit() or a.lower().rsplit(None, 1)[-1] in _FUNCTION for a, b in open_lines)
        uncased = sum(c.islower() or c.isupper() for c in text) < 0.3 * sum(c.isalpha() for c in text)
        if open_lines and (uncased or flow >= 0.4 * len(open_lines)) and np.median([len(x.split()) for x in lines]) >= 5:
            items = 0
    plain = _MARKS_ON.sub("", text)
    symbols = sum(not c.isalnum() and not c.isspace() and ord(c) < 0x2000 and c not in ".,'\"-«»()" for c in plain)
    digits_and_symbols = symbols / visible
    code = sum(bool(_CODE.search(x.strip())) for x in lines) / n
    letters = sum(c.isalpha() for c in plain)
    if digits_and_symbols > 0.33 and letters < 0.55 * visible:
        code = max(code, 1.0)
    tokens = re.findall(r"[^\W\d_]+", text.lower())
    heap = 0.0
    if _PERIOD.match(text) and len(_PERIOD.match(text).group(0)) > 0.6 * len(text.strip()):
        heap = 1.0
    elif len(tokens) >= 10:
        known = sum(t in _FUNCTION for t in tokens) / len(tokens)
        ends = len(re.findall(r"[.!?।。؟]", text))
        latin = sum("a" <= t[0] <= "z" or t[0] in "éàçâêîôûèù" or "а" <= t[0] <= "я" for t in tokens)
        if ends <= len(tokens) / 40 and latin > 0.8 * len(tokens) and len(tokens) / n >= 7:
            apart = sum(w in ("l", "d") for w in tokens)
            heap = 1.0 if known - apart / len(tokens) < 0.06 else 0.0
    if not heap:
        whole = [p.strip() for p in re.split(r"[.!?।。！？؟\n]+", text) if len(p.strip()) > 8]
        if len(whole) >= 4 and len(set(whole)) <= 0.34 * len(whole) and not items > 0.5 * n:
            heap = 1.0
    return cells, items / n, min(1.0, broken), code, heap


def exact_tails(values: DataFrame, directions: dict[str, bool] = DIRECTIONS, rows_a_partition: int = ROWS_A_PARTITION, prior: int = PRIOR_TEXTS) -> DataFrame:
    """(stat, lang, value, n, tail) of (stat, lang, value, n), n texts having each different value: the share of the language's texts, and of ``prior`` plain ones, that are at least as abnormal."""
    keys = ["stat", "lang", "value"]
    parts = max(4, -(-values.count() // rows_a_partition))
    # written before it is read twice, so that the partitions are the same ones
    ranged = cut(values.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("pid", F.spark_partition_id()))
    by_pid = Window.partitionBy("stat", "lang")
    sums = ranged.groupBy("stat", "lang", "pid").agg(F.sum("n").alias("here"))
    offsets = small(cut(sums.select("stat", "lang", "pid", F.sum("here").over(by_pid).alias("whole"), (F.sum("here").over(by_pid.orderBy("pid")) - F.col("here")).alias("before"))))

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, total = None, 0
        for pdf in batches:
            n = pdf["n"].to_numpy()
            run = np.cumsum(n)
            groups = list(zip(pdf["stat"], pdf["lang"]))
            for k, g in enumerate(groups):
                if g != now:
                    now, total = g, -(run[k] - n[k])
                run[k] += total
            # the next batch goes on from here
            total = run[-1] if len(run) else total
            yield pdf.assign(upto=run)

    ranked = ranged.mapInPandas(add_up, "stat string, lang string, value double, n long, pid int, upto long").join(offsets, ["stat", "lang", "pid"])
    upto = F.col("before") + F.col("upto")
    least, high = F.col("whole") - upto + F.col("n"), F.col("stat").isin([s for s, up in directions.items() if up])
    plain = F.when(F.col("stat").isin(*KINDS) & (F.col("value") > 0), 0).otherwise(prior)
    return ranked.select(*keys, "n", ((F.when(high, least).otherwise(upto) + plain) / (F.col("whole") + prior)).alias("tail"))


def measured(texts: DataFrame) -> DataFrame:
    """Every text that is neither null nor blank, with all statistics."""
    base = statistics(texts.select("text_id", "lang", "texts").where(F.col("text_id").isNotNull() & F.col("texts").rlike(r"(?U)\S")))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            more = pd.DataFrame([shape(t) for t in pdf["texts"]], columns=["cells", "items", "broken", "code", "heap"], dtype="float64")
            yield pd.concat([pdf.drop(columns="texts").reset_index(drop=True), more], axis=1)

    return base.withColumn("text", F.md5("texts")).mapInPandas(add, "text_id long, lang string, word_count int, mean_word_length double, symbol_ratio double, line_end_share double, common_share double, text string, cells double, items double, broken double, code double, heap double")


def stats_of(rows: DataFrame) -> DataFrame:
    """(lang, text, stat, value) of every text, ten rows each."""
    stats = F.array(*[F.struct(F.lit(s).alias("stat"), F.coalesce(F.col(s), F.lit(0)).cast("double").alias("value")) for s in DIRECTIONS])
    return rows.select("lang", "text", F.explode(stats).alias("x")).select("lang", "text", "x.stat", "x.value")


def scored(texts: DataFrame) -> DataFrame:
    """(text_id, lang, the shares of KINDS, outlier) of the texts that have some share of a kind: the others are prose whatever their score."""
    rows = cut(measured(texts).withColumn("lang", F.coalesce("lang", F.lit(""))))
    # each different text of a language once, with the number of its copies
    once = cut(rows.groupBy("lang", "text").agg(F.count(F.lit(1)).alias("copies"), *[F.first(s).alias(s) for s in DIRECTIONS]))
    some = functools.reduce(Column.__or__, [F.col(k) > 0 for k in KINDS])
    tails = cut(exact_tails(stats_of(once).groupBy("stat", "lang", "value").agg(F.count(F.lit(1)).alias("n"))))
    of_some = hot_key_join(stats_of(once.where(some)), tails, ["stat", "lang", "value"], "n", len(DIRECTIONS) * once.count())
    outliers = of_some.groupBy("lang", "text").agg(F.sum(-F.log("tail")).alias("outlier")).join(once.select("lang", "text", "copies"), ["lang", "text"])
    return hot_key_join(rows.where(some).select("text_id", "lang", "text", *KINDS), cut(outliers), ["lang", "text"], "copies", rows.count()).drop("text", "copies")


def no_prose(texts: DataFrame) -> DataFrame:
    """(text_id, kind, outlier) of the texts that are no natural prose."""
    enough = lambda share: share * F.col("outlier") >= LEAST_SCORE
    # first broken characters, then code, rows of cells, heaps and items
    kind = (
        F.when(enough(F.least(F.col("broken") / BROKEN_WHOLE, F.lit(1.0))), "junk")
        .when(enough(F.col("code")), "junk")
        .when(enough(F.col("cells")), "table")
        .when(enough(F.col("heap")), "junk")
        .when(enough(F.col("items")), "list")
    )
    return scored(texts).select("text_id", kind.alias("kind"), "outlier").where("kind IS NOT NULL")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return no_prose(spread(table(spark, sf_dir, "html_text_process").select("text_id", "lang", "texts"), "text_id")).select("text_id", "kind")


def p6_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five statistics of every text, rounded; nulls where undefined."""
    s = statistics(table(spark, sf_dir, "html_text_process").select("text_id", "lang", F.coalesce("texts", F.lit("")).alias("texts")))
    return s.select("text_id", "word_count", *[F.round(c, 6).alias(c) for c in ("mean_word_length", "symbol_ratio", "line_end_share", "common_share")])


QUERIES = {"p6_found": p6_found, "p6_stats": p6_stats}
# Chinese and Japanese characters are set apart by blanks first, as RE2 has no intersection of classes
_WS = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SQL = {
    "p6_stats": rf"""WITH t AS (SELECT text_id, coalesce(lang, '') AS lang, coalesce(texts, '') AS x FROM html_text_process),
w AS (SELECT text_id, lang, x, regexp_extract_all(regexp_replace(lower(x), '([\p{{Han}}\p{{Hiragana}}\p{{Katakana}}])', ' \1 ', 'g'), '[\p{{L}}\p{{M}}\p{{N}}]+') AS words,
  list_filter(string_split(x, chr(10)), lambda l: trim(regexp_replace(l, '{_WS}+', ' ', 'g')) <> '') AS lines FROM t),
c AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(words) AS word FROM w) GROUP BY 1, 2),
k AS (SELECT lang, list(word) AS common FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r FROM c) WHERE r <= {COMMON} GROUP BY lang)
SELECT text_id, CAST(len(words) AS INTEGER) AS word_count,
  round(CASE WHEN len(words) > 0 THEN list_sum(list_transform(words, lambda v: length(v))) / len(words) END, 6) AS mean_word_length,
  round(CASE WHEN length(regexp_replace(x, '{_WS}+', '', 'g')) > 0 THEN length(regexp_replace(regexp_replace(x, '{_WS}+', '', 'g'), '[\p{{L}}\p{{M}}\p{{N}}]+', '', 'g')) / length(regexp_replace(x, '{_WS}+', '', 'g')) END, 6) AS symbol_ratio,
  round(CASE WHEN len(lines) > 0 THEN len(list_filter(lines, lambda l: regexp_matches(l, '[.!?…。！？؟।．"”»’)\]」』]\s*$'))) / len(lines) END, 6) AS line_end_share,
  round(CASE WHEN len(words) > 0 THEN len(list_filter(words, lambda v: list_contains(common, v))) / len(words) END, 6) AS common_share
FROM w LEFT JOIN k USING (lang)"""
}
