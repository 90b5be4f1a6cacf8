"""Queries: deduplication, set operations, updates, sampling, joins, translators, matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corploom.functions import matcher as M, numbers as U, similarity as Y
from corploom.operators import cleaning as C, relational as R
from corploom.session import table


def merge_dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memory sources, then search segments; the first of each text."""
    a = table(spark, sf_dir, "tm_fileparser").select(F.col("tm_id").alias("id"), F.col("srctexts").alias("text"))
    b = table(spark, sf_dir, "segments").select(F.col("query_id").alias("id"), F.col("src_text").alias("text"))
    return R.merge_keep_first([a, b], ["text"], ["id"])


def ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.keep_first(table(spark, sf_dir, "segments").select("query_id", "src_text"), ["src_text"], ["query_id"])


def dedup_best_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-scored record of each source text."""
    df = table(spark, sf_dir, "tm_fileparser").select("tm_id", "srctexts", F.coalesce("score", F.lit(-1.0)).alias("score"))
    return R.keep_first(df, ["srctexts"], [-F.col("score"), "tm_id"])


def single_token_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "tm_fileparser").select("tm_id", F.trim(F.regexp_replace("srctexts", r"\s+", " ")).alias("t")).where("t IS NOT NULL")
    return C.drop_single_tokens(df, "t", "tm_id")


def untranslated_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "tm_fileparser")
    return C.untranslated(df, df, "tm_id", "srctexts", "tgttexts").select("tm_id", "translated")


def language_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pages of each side of the routing by the language column."""
    df = table(spark, sf_dir, "general_crawler")
    clean, noise = C.route_by_language(df, F.lower("tgt_lang"), "eng")
    return clean.groupBy("website_id").agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("clean")).unionByName(noise.groupBy("website_id").agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("noise")))


def machine_against_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "tm_fileparser")
    keyed = lambda kind: df.where(F.col("mt_origin") == kind).groupBy("srctexts").agg(F.min("tgttexts").alias("t"))
    return C.same_as_memory(keyed("mt"), keyed("tm"), "srctexts", "t").select("srctexts", "same")


def year_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.by_year(table(spark, sf_dir, "website").select("website_id", F.date_format("last_update", "yyyy-MM-dd").alias("d")), "d", "2022")


def line_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.batches(table(spark, sf_dir, "tm_fileparser").select("tm_id", "line_no"), "line_no", 20)


def batch_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hook with a stand-in translator; null texts stay null."""
    return C.translate(table(spark, sf_dir, "segments").select("query_id", "src_text"), "src_text", lambda xs: [None if x is None else x.upper() for x in xs])


def staleness_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.staleness(table(spark, sf_dir, "website").select("website_id", "last_update", "size"), "last_update", "size", F.lit("2023-01-01").cast("date"), 180).select("website_id", "action")


def anti_join_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "general_crawler")
    return R.left_over(df.where("fetched_at >= '2022-01-01'").select("crawl_id", "src_url"), df.where("fetched_at < '2022-01-01'").select("src_url"), ["src_url"])


def set_difference_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "segments")
    return R.group_difference(s.where("quality >= 0.5 OR quality IS NULL"), s.where("quality < 0.5"), "website_id", "src_text")


def group_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.missing_groups(table(spark, sf_dir, "website").select("ycc_id"), table(spark, sf_dir, "source_file").select("ycc_id"), "ycc_id")


def keyed_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Website owners and sizes updated by those of their domain's files (the largest)."""
    new = table(spark, sf_dir, "source_file").where("ycc_id IS NOT NULL").groupBy("ycc_id").agg(F.max("size").alias("size"), F.max("owner").alias("owner"))
    base = table(spark, sf_dir, "website").select("website_id", "ycc_id", "owner", "size")
    return R.update_by_key(base, new, ["ycc_id"], {"size": 0, "owner": ""})


def count_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.add_counts(table(spark, sf_dir, "website").select("website_id", "size"), table(spark, sf_dir, "segments"), "website_id", "size")


def group_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.group_items(table(spark, sf_dir, "ycc_domains"), "domain", "ycc", "codes").select("domain", F.array_join("codes", ",").alias("codes"))


def section_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of sections in the texts: a heading line ends without a mark; the section goes on to a blank line."""
    lines = table(spark, sf_dir, "html_text_process").where("stage = 'segment'").select("text_id", F.posexplode(F.split("texts", "\n")).alias("line_no", "line"))
    return R.section_runs(lines, "line_no", F.col("line").rlike(r"^[A-Z][^.!?]*$"), "line", ["text_id"], 0).select("text_id", "line_no", "section")


def sheet_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, f = table(spark, sf_dir, "website").select(F.col("owner").alias("company")), table(spark, sf_dir, "source_file").select(F.col("owner").alias("company"))
    return R.union_sheets({"web": w, "file": f})


def sample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampling operator: exactly 100 documents."""
    return R.exact_sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 100, "7")


def parallel_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "tm_fileparser")
    a, b = df.select("file_id", "line_no", F.col("srctexts").alias("a")), df.where("tgttexts IS NOT NULL").select("file_id", "line_no", F.col("tgttexts").alias("b"))
    return R.zip_rows(a, b, "file_id", "line_no")


def segment_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "tm_fileparser").select((F.col("tm_id") - 1).alias("line_no"), F.col("srctexts").alias("src"), F.col("tgttexts").alias("tgt"))
    return R.segment_records(lines, "eng", "fra", "file")


def search_metadata_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.with_metadata(table(spark, sf_dir, "segments"), table(spark, sf_dir, "website"), table(spark, sf_dir, "ycc_domains"))


def search_file_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.with_metadata(table(spark, sf_dir, "segments"), table(spark, sf_dir, "source_file"), table(spark, sf_dir, "ycc_domains"), "file_id")


def classifier_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source language column against the one of the target's opposite."""
    df = table(spark, sf_dir, "tm_fileparser").select("src_lang", F.when(F.col("tgt_lang") == "fra", "eng").otherwise("fra").alias("guess"))
    m = R.metrics(df, "src_lang", "guess")
    return m.select("label", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "tm_fileparser").select("tm_id", F.col("srctexts").alias("a"), F.col("tgttexts").alias("b"))


def length_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _pairs(spark, sf_dir).withColumns({c: F.trim(F.regexp_replace(c, r"(?U)\s+", " ")) for c in "ab"})
    return df.select("tm_id", F.round(Y.length_ratio(F.col("a"), F.col("b")), 9).alias("words"), F.round(Y.length_ratio(F.col("a"), F.col("b"), "char"), 9).alias("chars"), F.round(Y.length_similarity(F.col("a"), F.col("b")), 9).alias("alike"))


def similarity_builtin(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return _pairs(spark, sf_dir).select("tm_id", *[F.round(Y.similarity(a, b, m), 6).alias(m) for m in ("levenshtein", "jaccard", "sorensen_dice", "cosine")])


def similarity_levenshtein(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("tm_id", F.round(Y.levenshtein(F.col("a"), F.col("b")), 6).alias("s"))


def similarity_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The multiset measures."""
    a, b = F.col("a"), F.col("b")
    return _pairs(spark, sf_dir).select("tm_id", *[F.round(Y.similarity(a, b, m), 6).alias(m) for m in ("jaccard", "sorensen_dice", "cosine")])


def similarity_jaro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("tm_id", *[F.round(Y.similarity(F.col("a"), F.col("b"), m), 6).alias(m) for m in ("jaro", "jaro_winkler")])


def similarity_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return _pairs(spark, sf_dir).select("tm_id", *[F.round(Y.similarity(a, b, m), 6).alias(m) for m in ("damerau", "ratcliff_obershelp")])


def match_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of the memory in the form of their sources, in both directions."""
    df = table(spark, sf_dir, "tm_fileparser").select("tm_id", "src_lang", "tgt_lang", "srctexts", "tgttexts")
    ways = [M.match_forms(df.where((F.lower("src_lang") == a) & (F.lower("tgt_lang") == b)), "srctexts", "tgttexts", ref=a, tgt=b).select("tm_id", "out") for a, b in (("eng", "fra"), ("fra", "eng"))]
    return ways[0].unionByName(ways[1])


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.format_number("o_totalprice", 2).alias("n"), F.date_format("o_orderdate", "MMMM d, yyyy").alias("d"))


def translate_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers(spark, sf_dir).select("o_orderkey", U.number(F.col("n"), "eng", "fra").alias("out"))


def translate_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers(spark, sf_dir).select("o_orderkey", U.percent(F.concat("n", F.lit("%")), "eng", "fra").alias("out"))


def translate_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers(spark, sf_dir).select("o_orderkey", U.currency(F.concat(F.lit("$"), "n"), "eng", "fra").alias("out"))


def translate_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers(spark, sf_dir).select("o_orderkey", U.date(F.col("d"), "eng", "fra").alias("out"))


def translate_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [(r"^On ([A-Z]\w+ \d+, \d+), (.*)$", "$2 ($1)"), (r"^According to ([^,]+), (.*)$", "$2 [$1]")]
    return table(spark, sf_dir, "segments").select("query_id", U.template(F.col("src_text"), rules).alias("out"))


def translate_assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = [lambda c: U.currency(c, "eng", "fra"), lambda c: U.template(c, [("^(.*)$", "[$1]")])]
    return _numbers(spark, sf_dir).select("o_orderkey", U.assemble(F.concat(F.lit("$"), "n"), steps).alias("out"))


_META = "SELECT s.query_id, s.src_text, s.tgt_text, s.quality, s.{k}, m.uri, m.owner{x}, y.ycc, y.domain FROM segments s JOIN {t} m USING ({k}) JOIN ycc_domains y USING (ycc_id)"
_FR = "replace(replace(format('{:,.2f}', o_totalprice), ',', chr(160)), '.', ',')"
QUERIES = {f.__name__: f for f in (merge_dedup_keep_first, ordered_distinct, dedup_best_score, single_token_drop, untranslated_split, language_routing, machine_against_memory, year_filter, line_batches, batch_translate, staleness_action, anti_join_incremental, set_difference_by_group, group_check, keyed_update, count_update, group_collect, section_runs, sheet_union, sample_exact, parallel_zip, segment_records, search_metadata_join, search_file_join, classifier_metrics, length_ratio, similarity_builtin, similarity_levenshtein, similarity_sets, similarity_jaro, similarity_python, match_form, translate_number, translate_percent, translate_currency, translate_date, translate_template, translate_assembled)}
SQL = {
    "merge_dedup_keep_first": "WITH u AS (SELECT tm_id AS id, srctexts AS text, 0 AS part FROM tm_fileparser UNION ALL SELECT query_id, src_text, 1 FROM segments) SELECT id, text, part FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY part, id) AS r FROM u) WHERE r = 1",
    "ordered_distinct": "SELECT query_id, src_text FROM (SELECT *, row_number() OVER (PARTITION BY src_text ORDER BY query_id) AS r FROM segments) WHERE r = 1",
    "dedup_best_score": "SELECT tm_id, srctexts, score FROM (SELECT tm_id, srctexts, coalesce(score, -1.0) AS score, row_number() OVER (PARTITION BY srctexts ORDER BY coalesce(score, -1.0) DESC, tm_id) AS r FROM tm_fileparser) WHERE r = 1",
    "single_token_drop": "WITH t AS (SELECT tm_id, trim(regexp_replace(srctexts, '[\\s\\x0b]+', ' ', 'g'), ' ') AS t FROM tm_fileparser WHERE srctexts IS NOT NULL) SELECT min(tm_id) AS tm_id, t FROM t WHERE regexp_matches(t, '[^\\s\\p{Z}][\\s\\p{Z}]+[^\\s\\p{Z}]') GROUP BY t",
    "untranslated_split": "SELECT tm_id, regexp_matches(coalesce(tgttexts, ''), '[^\\s\\p{Z}\\x0b]') AS translated FROM tm_fileparser",
    "language_routing": "SELECT website_id, count(*) AS n, CASE WHEN lower(tgt_lang) = 'eng' THEN 'noise' ELSE 'clean' END AS side FROM general_crawler GROUP BY 1, 3",
    "year_filter": "SELECT website_id, strftime(last_update, '%Y-%m-%d') AS d FROM website WHERE year(last_update) = 2022",
    "line_batches": "SELECT tm_id, line_no, CAST(line_no // 20 AS BIGINT) AS batch FROM tm_fileparser",
    "batch_translate": "SELECT query_id, src_text, upper(src_text) AS translation FROM segments",
    "staleness_action": "SELECT website_id, CASE WHEN coalesce(size, 0) = 0 THEN 'skip' WHEN last_update IS NULL OR date_diff('day', CAST(last_update AS DATE), DATE '2023-01-01') >= 180 THEN 'recrawl' ELSE 'count' END AS action FROM website",
    "anti_join_incremental": "SELECT crawl_id, src_url FROM general_crawler a WHERE fetched_at >= TIMESTAMP '2022-01-01' AND NOT EXISTS (SELECT 1 FROM general_crawler b WHERE b.fetched_at < TIMESTAMP '2022-01-01' AND b.src_url = a.src_url)",
    "set_difference_by_group": "SELECT website_id, src_text FROM segments WHERE quality >= 0.5 OR quality IS NULL EXCEPT SELECT website_id, src_text FROM segments WHERE quality < 0.5",
    "group_check": "SELECT ycc_id, a IS NOT NULL AS in_a, b IS NOT NULL AS in_b FROM (SELECT DISTINCT ycc_id, 1 AS a FROM website) FULL JOIN (SELECT DISTINCT ycc_id, 1 AS b FROM source_file) USING (ycc_id) WHERE a IS NULL OR b IS NULL",
    "keyed_update": "WITH n AS (SELECT ycc_id, max(size) AS size, max(owner) AS owner FROM source_file WHERE ycc_id IS NOT NULL GROUP BY 1) SELECT w.website_id, w.ycc_id, coalesce(n.owner, w.owner, '') AS owner, coalesce(n.size, w.size, 0) AS size FROM website w LEFT JOIN n USING (ycc_id)",
    "count_update": "SELECT w.website_id, coalesce(w.size, 0) + coalesce(n.n, 0) AS size FROM website w LEFT JOIN (SELECT website_id, count(*) AS n FROM segments GROUP BY 1) n USING (website_id)",
    "group_collect": "SELECT domain, string_agg(ycc, ',' ORDER BY ycc) AS codes FROM ycc_domains GROUP BY domain",
    "sheet_union": r"SELECT DISTINCT regexp_replace(owner, '^\s*(.+?)\.+\s*$', '\1') AS company, k AS \"Industry\" FROM (SELECT owner, 'web' AS k FROM website UNION ALL SELECT owner, 'file' FROM source_file)".replace('\\"', '"'),
    "sample_exact": "SELECT doc_id FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 100",
    "parallel_zip": "SELECT a.file_id, a.line_no, a.srctexts AS a, b.tgttexts AS b FROM tm_fileparser a JOIN (SELECT * FROM tm_fileparser WHERE tgttexts IS NOT NULL) b USING (file_id, line_no)",
    "machine_against_memory": "WITH k AS (SELECT srctexts, mt_origin AS o, min(tgttexts) AS t FROM tm_fileparser GROUP BY 1, 2) SELECT a.srctexts, coalesce(trim(a.t) = trim(b.t), false) AS same FROM k a JOIN k b ON a.srctexts = b.srctexts AND a.o = 'mt' AND b.o = 'tm'",
    "segment_records": "SELECT tm_id AS query_id, 'eng' AS src_lang, 'fra' AS tgt_lang, srctexts AS src_text, tgttexts AS tgt_text, CAST(NULL AS DOUBLE) AS quality, 'file' AS type, CAST(NULL AS BIGINT) AS website_id, CAST(NULL AS BIGINT) AS file_id, CAST(NULL AS VARCHAR) AS note FROM tm_fileparser",
    "search_metadata_join": _META.format(k="website_id", t="website", x=""),
    "search_file_join": _META.format(k="file_id", t="source_file", x=", m.format"),
    "classifier_metrics": """WITH d AS (SELECT src_lang AS t, CASE WHEN tgt_lang = 'fra' THEN 'eng' ELSE 'fra' END AS p FROM tm_fileparser WHERE src_lang IS NOT NULL), l AS (SELECT t AS label FROM d UNION SELECT p FROM d),
c AS (SELECT label, (SELECT count(*) FROM d WHERE t = label AND p = label) AS tp, (SELECT count(*) FROM d WHERE t = label) AS s, (SELECT count(*) FROM d WHERE p = label) AS g FROM l)
SELECT label, s AS support, round(CASE WHEN g > 0 THEN tp / g ELSE 0.0 END, 6) AS precision, round(CASE WHEN s > 0 THEN tp / s ELSE 0.0 END, 6) AS recall, round(CASE WHEN s + g > 0 THEN 2 * tp / (s + g) ELSE 0.0 END, 6) AS f1, round((SELECT count(*) FILTER (t = p) / count(*) FROM d), 6) AS accuracy FROM c""",
    "length_ratio": r"""WITH x AS (SELECT tm_id, trim(regexp_replace(srctexts, '[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'), ' ') AS a, trim(regexp_replace(tgttexts, '[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'), ' ') AS b FROM tm_fileparser),
n AS (SELECT *, CASE WHEN a = '' THEN 0 ELSE len(string_split(a, ' ')) END AS m, CASE WHEN b = '' THEN 0 ELSE len(string_split(b, ' ')) END AS n FROM x)
SELECT tm_id, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN round(least(m, n) / nullif(greatest(m, n), 0), 9) END AS words, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN round(least(length(a), length(b)) / nullif(greatest(length(a), length(b)), 0), 9) END AS chars, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN round(coalesce(least(length(a), length(b)) / nullif(greatest(length(a), length(b)), 0), 1.0), 9) END AS alike FROM n""",
    "similarity_sets": """WITH x AS (SELECT tm_id, srctexts AS a, tgttexts AS b, length(srctexts) AS m, length(tgttexts) AS n, coalesce(list_sum(list_transform(list_distinct(string_split(srctexts, '')), lambda c: least(length(srctexts) - length(replace(srctexts, c, '')), length(tgttexts) - length(replace(tgttexts, c, ''))))), 0) AS k FROM tm_fileparser)
SELECT tm_id, CASE WHEN a = '' AND b = '' THEN 1.0 WHEN a = '' OR b = '' THEN 0.0 WHEN b IS NOT NULL THEN round(k / (m + n - k), 6) END AS jaccard, CASE WHEN a = '' AND b = '' THEN 1.0 WHEN a = '' OR b = '' THEN 0.0 WHEN b IS NOT NULL THEN round(2 * k / (m + n), 6) END AS sorensen_dice, CASE WHEN a = '' AND b = '' THEN 1.0 WHEN a = '' OR b = '' THEN 0.0 WHEN b IS NOT NULL THEN round(k / sqrt(m::DOUBLE * n), 6) END AS cosine FROM x""",
    "translate_number": f"SELECT o_orderkey, {_FR} AS out FROM orders",
    "translate_percent": f"SELECT o_orderkey, {_FR} || chr(160) || '%' AS out FROM orders",
    "translate_currency": f"SELECT o_orderkey, {_FR} || chr(160) || '$' AS out FROM orders",
    "translate_date": "SELECT o_orderkey, day(o_orderdate) || ' ' || ['" + "','".join(U.MONTHS["fra"]) + "'][month(o_orderdate)] || ' ' || year(o_orderdate) AS out FROM orders",
    "translate_template": r"SELECT query_id, CASE WHEN regexp_matches(src_text, '^On ([A-Z]\w+ \d+, \d+), (.*)$') THEN regexp_replace(src_text, '^On ([A-Z]\w+ \d+, \d+), (.*)$', '\2 (\1)') WHEN regexp_matches(src_text, '^According to ([^,]+), (.*)$') THEN regexp_replace(src_text, '^According to ([^,]+), (.*)$', '\2 [\1]') END AS out FROM segments",
    "translate_assembled": f"SELECT o_orderkey, '[' || {_FR} || chr(160) || '$]' AS out FROM orders",
}
