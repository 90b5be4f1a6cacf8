"""Queries: BM25, vectors, nearest neighbours, matching, crawl graph, alignment, terms, language identification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corploom.operators import align as A, crawl as W, langid as L, relational as R, search as Q
from corploom.session import cut, table

STOP = "the of and to in a is that it was for on with as by at this from are be have has will would could not than which said but who when after or an its".split()


def _words(column: str) -> F.Column:
    """Portable tokens: lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(column), F.lit("[a-z0-9]+"), F.lit(0))


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "segments").select("query_id", F.coalesce(_words("src_text"), F.array().cast("array<string>")).alias("tokens"))


def _queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stated query set of searches: every row whose id is divisible by 50."""
    return _docs(spark, sf_dir).where("query_id % 50 = 0").select(F.col("query_id").alias("q"), F.col("tokens").alias("asked"))


def bm25_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return Q.idf_table(Q.term_counts(docs, "query_id", "tokens"), docs.count()).select("term", "df", F.round("idf", 6).alias("idf"))


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = Q.bm25_topk(_docs(spark, sf_dir), _queries(spark, sf_dir), "query_id", "tokens", "q", "asked", 5)
    return top.select("q", "query_id", F.round("score", 6).alias("score"), "rank")


def count_cosine_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.best_match(_docs(spark, sf_dir), _queries(spark, sf_dir), "query_id", "tokens", "q", "asked").select("q", "query_id", F.round("score", 6).alias("score"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding")


def knn_cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vectors(spark, sf_dir)
    out = Q.knn(v, v.where("vec_id % 50 = 0").select(F.col("vec_id").alias("q"), F.col("embedding").alias("v")), "vec_id", "embedding", "q", "v", 5)
    return out.select("q", "vec_id", F.round("similarity", 5).alias("similarity"), "rank")


def knn_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall of the approximate search against the exact one, over all queries."""
    v = _vectors(spark, sf_dir)
    asked = v.where("vec_id % 50 = 0").select(F.col("vec_id").alias("q"), F.col("embedding").alias("v"))
    exact = Q.knn(v, asked, "vec_id", "embedding", "q", "v", 5).select("q", "vec_id")
    near = Q.knn_approximate(v, asked, "vec_id", "embedding", "q", "v", 5).select("q", "vec_id", F.lit(1).alias("hit"))
    return exact.join(near, ["q", "vec_id"], "left").agg(F.round(F.avg(F.coalesce("hit", F.lit(0))), 4).alias("recall"))


def vector_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vectors(spark, sf_dir).withColumn("embedding", F.when(F.col("vec_id") % 7 == 0, F.slice("embedding", 1, 3)).otherwise(F.col("embedding")))
    return Q.repair_vectors(v, "embedding", 64).select("vec_id", F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.abs(x)), 3).alias("total"))


def embedding_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained word vectors, BM25-weighted document vectors, nearest neighbours of the queries, with their metadata as JSON."""
    docs = _docs(spark, sf_dir)
    words = Q.train_vectors(docs, "tokens", dim=24, epochs=1, least=3)
    vectors = Q.document_vectors(docs, "query_id", "tokens", words, 24)
    asked = Q.document_vectors(_queries(spark, sf_dir), "q", "asked", words, 24, weighted=False).withColumnRenamed("vector", "v")
    near = Q.knn(vectors.select((F.col("query_id") - 1).alias("id"), "vector"), asked, "id", "vector", "q", "v", 3)
    meta = R.with_metadata(table(spark, sf_dir, "segments"), table(spark, sf_dir, "website"), table(spark, sf_dir, "ycc_domains"))
    return Q.assemble(near, meta, "q", "id")


def advanced_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = R.with_metadata(table(spark, sf_dir, "segments"), table(spark, sf_dir, "website"), table(spark, sf_dir, "ycc_domains"))
    near = table(spark, sf_dir, "segments").where("query_id % 50 = 0").select(F.col("query_id").alias("q"), (F.col("query_id") - 1).alias("id"), F.lit(1).alias("rank"))
    return Q.assemble(near, meta, "q", "id", ("src_text", "domain"))


# ---- crawl --------------------------------------------------------------------------------------------------------------


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as mark-up: a heading, the address of the other side, and two relative links."""
    rows = table(spark, sf_dir, "general_crawler").where("src_url IS NOT NULL").select("crawl_id", F.regexp_replace(F.trim("src_url"), r"[?#].*$", "").alias("url"), F.coalesce("tgt_url", F.lit("#")).alias("other"), F.coalesce("src_content", F.lit("")).alias("text"))
    html = F.concat(F.lit('<html><head><style>x{}</style></head><body><a class="l" href="'), "other", F.lit('">Français</a><div id="content">'), F.regexp_replace(F.regexp_replace("text", "[<>&]", ""), "\n", "<br>"), F.lit("</div><a href='/en/page-"), (F.col("crawl_id") % 40).cast("string"), F.lit("'>next</a><a href=\"/en/page-"), ((F.col("crawl_id") * 7) % 40).cast("string"), F.lit(".pdf#top\">pdf</a></body></html>"))
    return rows.where("url LIKE 'http%'").select("crawl_id", "url", html.alias("html"))


def anchor_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.edges(_pages(spark, sf_dir))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.wanted_links(W.edges(_pages(spark, sf_dir)), "dst_url", "https://", query=True)


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "general_crawler").where("src_url LIKE 'http%'").select("crawl_id", F.trim("src_url").alias("u"))
    return p.select("crawl_id", W.host_of(F.col("u")).alias("host"), W.last_segment(F.col("u")).alias("last"), W.language_of(F.col("u")).alias("lang"), W.file_name(F.col("crawl_id"), F.col("u"), "eng").alias("file"))


def bfs_reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of the sites' link graph within six steps of the first website's pages."""
    links = W.edges(_pages(spark, sf_dir))
    seeds = table(spark, sf_dir, "general_crawler").where("website_id = 3 AND src_url IS NOT NULL").select(F.regexp_replace(F.trim("src_url"), r"[?#].*$", "").alias("url"))
    return W.breadth_first(links, seeds, 6)


def pair_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "general_crawler")
    urls = g.select(F.col("src_url").alias("url")).unionByName(g.select(F.col("tgt_url").alias("url"))).where("url IS NOT NULL").select(F.regexp_replace(F.regexp_replace(F.lower(F.trim("url")), r"^https?://(www\.)?[^/]*", ""), r"[?#].*$|/$", "").alias("url"))
    return W.pair_by_rule(urls, "url", "/en/", "/fr/")


def pair_by_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.pair_by_anchor(_pages(spark, sf_dir), "url", "html", "Français")


def visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.page_text(_pages(spark, sf_dir)).select("url", F.array_sort("lines").alias("lines"))


def document_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third each of the pages as they are, without their content division, and with a viewer in it."""
    html = F.when(F.col("crawl_id") % 3 == 1, F.replace("html", F.lit('id="content"'), F.lit('id="x"'))).when(F.col("crawl_id") % 3 == 2, F.replace("html", F.lit('id="content">'), F.lit('id="content"><i class="pdf-viewer"></i>'))).otherwise(F.col("html"))
    return _pages(spark, sf_dir).select("crawl_id", W.document_type(html).alias("type"))


# ---- alignment and terms ------------------------------------------------------------------------------------------------


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_no, src, tgt): English and French sides of all search segments, whichever is the source."""
    s, t = F.lower(F.trim("src_lang")), F.lower(F.trim("tgt_lang"))
    rows = table(spark, sf_dir, "segments").where(((s == "eng") & (t == "fra")) | ((s == "fra") & (t == "eng")))
    return rows.select(F.col("query_id").alias("line_no"), F.when(s == "eng", F.col("src_text")).otherwise(F.col("tgt_text")).alias("src"), F.when(s == "eng", F.col("tgt_text")).otherwise(F.col("src_text")).alias("tgt"))


def _bitext(spark: SparkSession, sf_dir: str) -> DataFrame:
    # written once: the alignment reads it several times
    return cut(A.preprocess(_pairs(spark, sf_dir), "line_no", "src", "tgt", "eng", "fra"))


def term_preprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs that the term pipeline aligns, with their humanized tokens."""
    return A.preprocess(_pairs(spark, sf_dir), "line_no", "src", "tgt", "eng", "fra")


def word_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.both_ways(_bitext(spark, sf_dir)).select("line_no", A.format_links(F.col("links")).alias("links"))


def term_combo_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ComboBasic scores of all candidates of the segments' portable tokens."""
    return A.term_candidates(_docs(spark, sf_dir), "tokens", STOP).select("term", "words", "freq", F.round("score", 6).alias("score"))


def term_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best source terms carried to the target side, the best score of each source."""
    return A.extract_terms(_pairs(spark, sf_dir), "line_no", "src", "tgt", "eng", "fra", STOP).select("source", "target", F.round("score", 6).alias("score"))


def find_word_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of two terms among the tokens of every segment."""
    docs = _docs(spark, sf_dir)
    return docs.select("query_id", A.occurrences(F.col("tokens"), "of the").alias("pair"), A.occurrences(F.col("tokens"), "the").alias("one"))


def symmetrized_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sets of links made of the parts' keys: their intersection is kept, and nothing is added that neither has."""
    n, k = F.col("p_partkey"), F.col("p_size")
    link = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    f = F.array(*[link(F.lit(i), (n * (i + 3) + i) % 5) for i in range(5)])
    b = F.array(*[link((k * (j + 2) + j) % 5, F.lit(j)) for j in range(5)])
    return table(spark, sf_dir, "part").select("p_partkey", A.format_links(F.array_intersect(A.symmetrize(f, b), F.array_intersect(f, b))).alias("kept"), F.size(F.array_except(A.symmetrize(f, b), F.array_union(f, b))).alias("beyond"))


def language_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memory sources that are detected as English; the detector is fitted on the cleaning table."""
    known = table(spark, sf_dir, "html_text_process").where("stage = 'segment'")
    return L.of_language(table(spark, sf_dir, "tm_fileparser").select("tm_id", "srctexts"), "srctexts", "eng", L.detector(spark, L.fit(known, "texts", "lang"))).select("tm_id")


def page_fetch_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.fetched(table(spark, sf_dir, "general_crawler")).select("crawl_id")


def term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequencies of one-word candidates."""
    return A.term_candidates(_docs(spark, sf_dir), "tokens", STOP, 1, 1).select("term", "freq")


def language_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detected language of every text of the cleaning table, with the stated one."""
    df = table(spark, sf_dir, "html_text_process")
    detect = L.detector(spark, L.fit(df.where("stage = 'segment'"), "texts", "lang"))
    return df.select("text_id", "lang", detect(F.col("texts")).alias("detected"))


def language_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = R.metrics(language_detection(spark, sf_dir), "lang", "detected")
    return m.select("label", "support", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


_D = "d AS (SELECT query_id, regexp_extract_all(lower(src_text), '[a-z0-9]+') AS t FROM segments), tf AS (SELECT query_id, w AS term, count(*) AS tf FROM (SELECT query_id, unnest(t) AS w FROM d) GROUP BY 1, 2)"
_IDF = "n AS (SELECT count(*) AS n, sum(len(t)) / count(*) AS avg FROM d), r AS (SELECT term, count(*) AS df, ln((n - count(*) + 0.5) / (count(*) + 0.5)) AS raw FROM tf, n GROUP BY term, n), idf AS (SELECT term, df, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM r) ELSE raw END AS idf FROM r)"
_P = "p AS (SELECT crawl_id, regexp_replace(trim(src_url), '[?#].*$', '') AS url, coalesce(tgt_url, '#') AS other FROM general_crawler WHERE src_url IS NOT NULL AND regexp_replace(trim(src_url), '[?#].*$', '') LIKE 'http%'), h AS (SELECT *, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1)) AS host, regexp_replace(trim(other), '#.*$', '') AS bare FROM p)"
_E = _P + ", e AS (SELECT url AS src_url, CASE WHEN bare LIKE 'http://%' OR bare LIKE 'https://%' THEN bare WHEN regexp_matches(bare, '^[A-Za-z][A-Za-z0-9_+.-]*:') THEN NULL WHEN bare LIKE '/%' THEN host || bare WHEN bare <> '' THEN regexp_replace(url, '([^/:])/[^/]*$', '\\1/') || bare END AS dst_url FROM h UNION SELECT url, host || '/en/page-' || (crawl_id % 40) FROM h UNION SELECT url, host || '/en/page-' || ((crawl_id * 7) % 40) || '.pdf' FROM h), edges AS (SELECT DISTINCT * FROM e WHERE dst_url IS NOT NULL)"
QUERIES = {f.__name__: f for f in (bm25_stats, bm25_topk, count_cosine_best_match, knn_cosine_topk, knn_recall, vector_repair, embedding_search, advanced_projection, anchor_edges, url_filter, url_parts, bfs_reachability, pair_by_rule, pair_by_anchor, visible_text, document_type, term_preprocess, word_alignment, term_combo_basic, term_pairs, find_word_index, symmetrized_links, language_filter, page_fetch_filter, term_counts, language_detection, language_metrics)}
SQL = {
    "bm25_stats": f"WITH {_D}, {_IDF} SELECT term, df, round(idf, 6) AS idf FROM idf",
    "bm25_topk": f"""WITH {_D}, {_IDF}, w AS (SELECT tf.query_id, tf.term, idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(t) / avg)) AS w FROM tf JOIN idf USING (term) JOIN d USING (query_id), n),
q AS (SELECT DISTINCT query_id AS q, unnest(t) AS term FROM d WHERE query_id % 50 = 0), s AS (SELECT q, query_id, round(sum(w), 6) AS score FROM q JOIN w USING (term) GROUP BY 1, 2)
SELECT q, query_id, round(score, 6) AS score, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, query_id) AS r FROM s) WHERE r <= 5""",
    "count_cosine_best_match": f"""WITH {_D}, l AS (SELECT query_id, sqrt(sum(tf * tf)) AS l FROM tf GROUP BY 1), s AS (SELECT a.query_id AS q, b.query_id, round(sum(a.tf * b.tf) / (x.l * y.l), 9) AS s FROM tf a JOIN tf b USING (term) JOIN l x ON x.query_id = a.query_id JOIN l y ON y.query_id = b.query_id WHERE a.query_id % 50 = 0 GROUP BY a.query_id, b.query_id, x.l, y.l),
b AS (SELECT q, query_id, s, row_number() OVER (PARTITION BY q ORDER BY s DESC, query_id) AS r FROM s)
SELECT d.query_id AS q, coalesce(b.query_id, (SELECT min(query_id) FROM d)) AS query_id, round(coalesce(s, 0.0), 6) AS score FROM d LEFT JOIN b ON b.q = d.query_id AND r = 1 WHERE d.query_id % 50 = 0""",
    "knn_cosine_topk": """WITH s AS (SELECT a.vec_id AS q, b.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS s FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0)
SELECT q, vec_id, round(s, 5) AS similarity, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, vec_id) AS r FROM s) WHERE r <= 5""",
    "advanced_projection": "SELECT s.query_id AS q, 1 AS rank, s.query_id, '{' || '\"src_text\":' || CAST(to_json(s.src_text) AS VARCHAR) || ',\"domain\":' || CAST(to_json(y.domain) AS VARCHAR) || '}' AS result FROM segments s JOIN website m USING (website_id) JOIN ycc_domains y USING (ycc_id) WHERE s.query_id % 50 = 0",
    "anchor_edges": f"WITH {_E} SELECT * FROM edges",
    "bfs_reachability": f"""WITH RECURSIVE {_E}, seeds AS (SELECT DISTINCT regexp_replace(trim(src_url), '[?#].*$', '') AS url FROM general_crawler WHERE website_id = 3 AND src_url IS NOT NULL),
w(url, depth) AS (SELECT url, 0 FROM seeds UNION SELECT dst_url, depth + 1 FROM w JOIN edges ON src_url = url WHERE depth < 6) SELECT url, CAST(min(depth) AS INTEGER) AS depth FROM w GROUP BY url""",
    "url_filter": f"WITH {_E}, u AS (SELECT *, regexp_replace(dst_url, '[?#].*$', '') AS u FROM edges WHERE dst_url LIKE 'https://%'), l AS (SELECT src_url, dst_url, lower(regexp_extract(CASE WHEN split_part(u, '/', -1) <> '' THEN split_part(u, '/', -1) ELSE split_part(u, '/', -2) END, '\\.(\\w+)$', 1)) AS x FROM u) SELECT src_url, dst_url, x = 'pdf' AS is_pdf FROM l WHERE x NOT IN ({', '.join(repr(x) for x in W.UNWANTED)})",
    "url_parts": r"""WITH p AS (SELECT crawl_id, trim(src_url) AS u FROM general_crawler WHERE src_url LIKE 'http%'), b AS (SELECT *, regexp_replace(u, '[?#].*$', '') AS b FROM p),
l AS (SELECT *, CASE WHEN split_part(b, '/', -1) <> '' THEN split_part(b, '/', -1) ELSE split_part(b, '/', -2) END AS last FROM b)
SELECT crawl_id, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9_+.-]*://[^/?#]+)', 1)) AS host, last, nullif(split_part(u, '/', 4), '') AS lang, CASE WHEN length(CAST(crawl_id AS VARCHAR)) >= 6 THEN CAST(crawl_id AS VARCHAR) ELSE lpad(CAST(crawl_id AS VARCHAR), 6, '0') END || '_' || substr(regexp_replace(last, '\.\w+$', ''), 1, 80) || '_ENG.html' AS file FROM l""",
    "pair_by_anchor": f"WITH {_E}, f AS (SELECT url AS source, CASE WHEN bare LIKE 'http://%' OR bare LIKE 'https://%' THEN bare WHEN regexp_matches(bare, '^[A-Za-z][A-Za-z0-9_+.-]*:') THEN NULL WHEN bare LIKE '/%' THEN host || bare WHEN bare <> '' THEN regexp_replace(url, '([^/:])/[^/]*$', '\\1/') || bare END AS target FROM h) SELECT min(source) AS source, target FROM f WHERE target IS NOT NULL GROUP BY target",
    "pair_by_rule": r"WITH u AS (SELECT DISTINCT regexp_replace(regexp_replace(lower(trim(url)), '^https?://(www\.)?[^/]*', ''), '[?#].*$|/$', '') AS url FROM (SELECT src_url AS url FROM general_crawler UNION ALL SELECT tgt_url FROM general_crawler) WHERE url IS NOT NULL) SELECT min(a.url) AS source, b.url AS target FROM u a JOIN u b ON a.url LIKE '/en/%' AND b.url = '/fr/' || substr(a.url, 5) GROUP BY b.url",
    "term_counts": f"WITH {_D} SELECT term, sum(tf)::BIGINT AS freq FROM tf WHERE regexp_matches(term, '^[a-z]+$') AND term NOT IN (" + ", ".join(f"'{w}'" for w in STOP) + ") GROUP BY term",
}
