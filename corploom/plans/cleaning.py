"""Queries: normalization, segmentation, filters, entities."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from corploom.functions import entities as E, normalize as N, segment as S
from corploom.operators import cleaning as C
from corploom.operators.relational import keep_first
from corploom.session import spread, table

T = F.col


def _language(column: str) -> F.Column:
    """The three-letter code of a language column in whatever spelling; null if unknown."""
    known = F.lower(F.trim(column))
    return F.coalesce(E.map_code(T(column)), F.when(known.isin([r[0] for r in E.LANGUAGES]), known))


def clean_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: humanized sentences of the documents with 8 to 100 words and a sentence's shape, each once, counted by language."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", _language("lang").alias("lang")), "doc_id")
    first = keep_first(C.clean_by_language(docs, "doc_id", "text", "lang", PIPELINE_LANGUAGES), ["text"], ["doc_id", "pos"])
    return first.groupBy("lang").agg(F.count(F.lit(1)).alias("segments"), F.sum(F.length("text")).cast("long").alias("characters"))


PIPELINE_LANGUAGES = ("eng", "fra", "ara", "jpn", "zht")


def segment_word_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translation-memory sources with 8 to 100 words."""
    df = table(spark, sf_dir, "tm_fileparser").select("tm_id", F.trim(F.regexp_replace("srctexts", r"\s+", " ")).alias("t"))
    return df.withColumn("words", S.word_count(T("t"))).where(S.has_word_length(T("t"))).select("tm_id", "words")


def segment_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that end like a sentence; blank and null ones don't."""
    df = table(spark, sf_dir, "tm_fileparser").select("tm_id", F.trim(F.regexp_replace("srctexts", r"\s+", " ")).alias("t"))
    return df.where(S.is_sentence(T("t"), "eng")).select("tm_id")


def sentence_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of the portable rule with its place and length."""
    return table(spark, sf_dir, "html_text_process").select("text_id", F.posexplode(S.sentences_simple(T("texts"))).alias("pos", "s")).select("text_id", "pos", F.length("s").alias("length"))


def paragraph_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of all texts line by line, by the rule of Latin texts."""
    df = table(spark, sf_dir, "html_text_process")
    return df.select("text_id", F.posexplode(S.sentences_by_line(T("texts"), "eng")).alias("pos", "sentence"))


def split_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of the Japanese, Chinese and Arabic rules (the fallback tokenizer), of all texts."""
    df = table(spark, sf_dir, "html_text_process")
    return df.select("text_id", F.explode(F.create_map(*[x for lang in ("jpn", "ara") for x in (F.lit(lang), S.split_sentences(T("texts"), lang))])).alias("rule", "sentences"))


def sentence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of sentences of every text, and what its gaps hold together; no row for a text that couldn't be rebuilt."""
    df = table(spark, sf_dir, "html_text_process").where("texts IS NOT NULL").withColumn("p", S.sentences(T("texts")))
    df = df.withColumn("g", S.gaps(T("texts"), T("p"))).where(S.rebuild(T("p"), T("g")) == T("texts"))
    inner = F.array_join(F.transform("p", lambda x: F.regexp_replace(x, r"(?U)\S+", "")), "")
    return df.select("text_id", F.size("p").alias("sentences"), F.array_join("g", "").alias("gap"), inner.alias("inside"))


def subsentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "segments").select("query_id", F.posexplode(S.subsentences(T("src_text"))).alias("pos", "part"))


def segments_humanized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Humanizer, split and filters over all sources of the memory, by the English rules."""
    return C.clean_segments(table(spark, sf_dir, "tm_fileparser"), "tm_id", "srctexts", "eng")


def _normalizer(column, name: str, text: str = "srctexts"):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, "tm_fileparser").select("tm_id", column(T(text)).alias("out"))

    query.__name__ = query.__qualname__ = name
    query.__doc__ = (column.__doc__ or "").strip() or None
    return query


NORMALIZERS = {
    "norm_percent": (N.percentages, "tgttexts"), "norm_percent_english": (N.percentages_english, "tgttexts"), "norm_percent_french": (N.percentages_french, "tgttexts"), "norm_dollar": (N.dollar_spaces, "srctexts"),
    "norm_spaces_latin": (N.word_spaces_latin, "srctexts"), "norm_capitals_english": (N.capitals_english, "srctexts"), "norm_punctuation_latin": (N.punctuation_latin, "srctexts"), "norm_punctuation_french": (N.punctuation_french, "tgttexts"),
    "norm_punctuation_arabic": (N.punctuation_arabic, "srctexts"), "norm_punctuation_chinese": (N.punctuation_chinese, "srctexts"), "norm_punctuation_japanese": (N.punctuation_japanese, "srctexts"), "norm_spaces_chinese": (N.word_spaces_chinese, "srctexts"),
    "norm_quotes_latin": (N.quotes_latin, "srctexts"), "norm_quotes_french": (N.quotes_french, "tgttexts"), "norm_quotes_chinese": (N.quotes_chinese, "srctexts"), "norm_quotes_japanese": (N.quotes_japanese, "srctexts"), "norm_brackets_latin": (N.brackets_latin, "srctexts"),
    "norm_brackets_chinese": (N.brackets_chinese, "srctexts"), "norm_brackets_japanese": (N.brackets_japanese, "srctexts"), "norm_contractions_english": (N.contractions_english, "srctexts"), "norm_contractions_french": (N.contractions_french, "tgttexts"),
    "norm_quotes_english": (N.quotes_english, "tgttexts"), "norm_guillemets": (N.quotes_to_guillemets, "tgttexts"), "norm_apostrophe_french": (N.apostrophe_french, "tgttexts"), "norm_alphabet_french": (N.alphabet_french, "tgttexts"),
    "norm_repair": (N.repair, "srctexts"), "norm_html": (N.clean_html, "srctexts"), "norm_tags": (N.cat_tags, "srctexts"),
}


def norm_humanize_eng(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.humanize_table(table(spark, sf_dir, "tm_fileparser").select("tm_id", "srctexts"), "srctexts", "eng", out="out").select("tm_id", "out")


def norm_humanize_fra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the English side, which decides the numbers."""
    return N.humanize_table(table(spark, sf_dir, "tm_fileparser").select("tm_id", "srctexts", "tgttexts"), "tgttexts", "fra", "srctexts", "out").select("tm_id", "out")


def norm_numbers_french(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "tm_fileparser").select("tm_id", N.numbers_french(T("tgttexts"), T("srctexts")).alias("out"))


def norm_tag_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.without_tags(table(spark, sf_dir, "tm_fileparser").select("tm_id", "srctexts").where("srctexts IS NOT NULL"), "srctexts", "tm_id")


def tokens_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "segments").select("query_id", S.words(T("src_text"), "eng").alias("tokens"))


def tokens_detokenized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "segments").select("query_id", S.detokenize(S.words(T("src_text"), "eng"), "eng").alias("text"))


def tokens_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "segments").select("query_id", S.search_tokens(T("src_text")).alias("tokens"))


def tokens_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "segments").select("query_id", S.simple_tokens(T("src_text")).alias("tokens"))


def tokens_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "segments").select("query_id", S.query_tokens(T("src_text")).alias("tokens"))


def tokens_subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy pieces over a vocabulary counted from the segments' words (bounded: the most frequent ones)."""
    segs = table(spark, sf_dir, "segments")
    words = segs.select(F.explode(S.query_tokens(T("src_text"))).alias("w"))
    pieces = words.select(F.concat(F.lit("▁"), "w").alias("p")).unionByName(words.select(F.explode(F.split("w", "")).alias("p"))).groupBy("p").count().orderBy(F.desc("count"), "p").limit(32_000).collect()
    return segs.select("query_id", S.subword_encode([(r[0], r[1]) for r in pieces], 5)(F.lower("src_text")).alias("pieces"))


def script_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many texts begin with a character of each script."""
    return table(spark, sf_dir, "html_text_process").select(S.script_name(F.trim("texts")).alias("script")).groupBy("script").agg(F.count(F.lit(1)).alias("n"))


def text_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "html_text_process")
    return df.select("text_id", *[S.has_text_characters(T("texts"), lang).alias(lang) for lang in ("eng", "zhs", "jpn", "ara", "hin", "tha", "rus")])


def chinese_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "html_text_process")
    return df.select("text_id", S.is_chinese(T("texts")).alias("chinese"), S.is_japanese(T("texts")).alias("japanese"), S.chinese_system(T("texts")).alias("system"), S.convert_chinese(T("texts"), "zht").alias("converted"))


def entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of entities of every kind in every segment."""
    return table(spark, sf_dir, "segments").select("query_id", *[E.count(T("src_text"), n).alias(n) for n in E.PATTERNS])


def entity_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entities themselves, of the kinds that another engine finds by the same pattern."""
    return table(spark, sf_dir, "segments").select("query_id", *[E.extract(T("src_text"), n).alias(n) for n in E.SIMPLE])


def canonical_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "segments").select("query_id", E.is_canonical(T("src_text")).alias("canonical"))


def language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by the three-letter code of their language column."""
    df = table(spark, sf_dir, "documents").select(F.coalesce(E.map_code(T("lang")), F.when(F.lower(F.trim("lang")).isin([r[0] for r in E.LANGUAGES]), F.lower(F.trim("lang")))).alias("iso3"))
    return df.groupBy("iso3").agg(F.count(F.lit(1)).alias("n"))


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "segments").select("query_id", E.plain_scripts(E.strip_bad_characters(T("src_text"))).alias("out"))


_WS = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x0b]"
_WS_NO_NBSP = _WS.replace(r"\x{a0}", "")


def _inner(left: str, right: str, pad: str = "") -> str:
    """RE2 form of trimming inside a pair of marks."""
    a, b = "\\" + left if left in "()" else left, "\\" + right if right in "()" else right
    no, ws = f"[^{left}{right}]", _WS
    return rf"'{a}{ws}*([^{left}{right}{ws[1:-1]}](?:{no}*[^{left}{right}{ws[1:-1]}])?){ws}*{b}', '{left}{pad}\1{pad}{right}', 'g'"


_FLAT = r"trim(regexp_replace(srctexts, '[\s\x0b]+', ' ', 'g'), ' ')"
QUERIES = {f.__name__: f for f in (clean_pipeline, segment_word_len, segment_shape, sentence_explode, paragraph_sentences, split_by_language, sentence_gaps, subsentences, segments_humanized, norm_humanize_eng, norm_humanize_fra, norm_numbers_french, norm_tag_dedup, tokens_words, tokens_detokenized, tokens_search, tokens_simple, tokens_query, tokens_subword, script_names, text_characters, chinese_predicates, entity_counts, entity_lists, canonical_text, language_codes, symbols)}
QUERIES |= {name: _normalizer(f, name, text) for name, (f, text) in NORMALIZERS.items()}
SQL = {
    "sentence_explode": r"SELECT text_id, CAST(generate_subscripts(regexp_extract_all(texts, '[^.!?\n]+[.!?]*'), 1) - 1 AS INTEGER) AS pos, CAST(length(unnest(regexp_extract_all(texts, '[^.!?\n]+[.!?]*'))) AS INTEGER) AS length FROM html_text_process",
    "norm_capitals_english": "SELECT tm_id, " + functools.reduce(lambda s, n: f"regexp_replace({s}, '\\b{n}\\b', '{n.capitalize()}', 'g')", N.NAMES, "srctexts") + " AS out FROM tm_fileparser",
    "segment_word_len": f"WITH t AS (SELECT tm_id, {_FLAT} AS t FROM tm_fileparser), u AS (SELECT tm_id, trim(regexp_replace(t, '{_WS}+', ' ', 'g')) AS t FROM t) SELECT tm_id, CAST(len(string_split(t, ' ')) AS INTEGER) AS words FROM u WHERE t <> '' AND len(string_split(t, ' ')) BETWEEN 8 AND 100",
    "segment_shape": f"WITH t AS (SELECT tm_id, {_FLAT} AS t FROM tm_fileparser) SELECT tm_id FROM t WHERE t <> '' AND (right(t, 1) IN (';', '.', '!', '?', ')', ']', '}}', '\"', '”') OR regexp_matches(t, '.[\\p{{L}}\\p{{N}}\\p{{M}}]$'))",
    "norm_spaces_latin": f"SELECT tm_id, regexp_replace(regexp_replace(srctexts, '{_WS_NO_NBSP}+', ' ', 'g'), '^{_WS}+|{_WS}+$', '', 'g') AS out FROM tm_fileparser",
    "norm_quotes_french": f"SELECT tm_id, regexp_replace(tgttexts, {_inner('«', '»', N.NBSP)}) AS out FROM tm_fileparser",
    "norm_brackets_latin": f"SELECT tm_id, regexp_replace(srctexts, {_inner('(', ')')}) AS out FROM tm_fileparser",
    "norm_tags": f"SELECT tm_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(srctexts, '\\{{\\w{{1,2}}>|<\\w{{1,2}}\\}}', ' ', 'g'), '{_WS}+', ' ', 'g'), '^{_WS}+|{_WS}+$', '', 'g'), '\\{{\\d{{1,2}}\\}}', '', 'g') AS out FROM tm_fileparser",
    "symbols": "SELECT query_id, translate(src_text, '⁰¹²³⁴⁵⁶⁷⁸⁹⁽⁾₀₁₂₃₄₅₆₇₈₉₍₎', '0123456789()0123456789()') AS out FROM segments",
    "norm_quotes_english": "SELECT tm_id, regexp_replace(tgttexts, '[«»]', '\"', 'g') AS out FROM tm_fileparser",
    "language_codes": "WITH m(iso2, iso3) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in E.code_mapping("iso2", "iso3").items()) + ") SELECT coalesce(m.iso3, l.iso3) AS iso3, count(*) AS n FROM documents d LEFT JOIN m ON m.iso2 = lower(trim(d.lang)) LEFT JOIN (SELECT DISTINCT iso3 FROM (SELECT iso3 FROM m UNION ALL SELECT 'zhs')) l ON l.iso3 = lower(trim(d.lang)) GROUP BY 1",
    "tokens_query": r"SELECT query_id, list_filter(string_split_regex(lower(src_text), '[\s\p{Z}]+'), lambda x: x <> '') AS tokens FROM segments",
}
