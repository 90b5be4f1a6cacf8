"""Problem 1: lines repeated across one site's documents.

Method: for every line key (its letters, lower case) and site, the share of the site's pages that hold the line is compared
with the share outside the site by a log-likelihood ratio (G2, one-sided). Outside pages of sites that themselves repeat the
line are no background (there it is in excess too), so the outside count holds single, coincidental occurrences only. The
G2 values of all (site, line) pairs with two pages or more go through Benjamini-Hochberg; the threshold is found on a
histogram of G2 with a fixed number of bins, whatever the size of the corpus. Significant lines are joined back to the
pages (hot lines by a bounded broadcast, all others by a shuffle) and removed; the rest is reassembled by position.

The six pages are the definition of a recurring line here, so they are checked after the test, and the background is chosen
so that the test doesn't contradict them where a line is one site's own; a line that stands once on many pages of many sites
is no excess on any of them, however many of one site's pages hold it.

Nulls: a row with a null url belongs to no site, one with null content has no lines; neither has found lines, and both keep
their content as it is. Lines without letters are never found. Repeated rows count as pages if their ids differ.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corploom.operators.skew import hot_key_join
from corploom.session import cut, table

#: Pages of one site from which a recurring line counts, and the false-discovery rate of the test before it.
MIN_PAGES = 6
FDR = 0.05
#: A site with fewer pages can't show a repetition, so its pages are no background. Prior of the background: so many pages
#: on which so many coincidental occurrences were seen (it decides only where the corpus outside a site is tiny).
PRIOR_PAGES, PRIOR_SEEN = 100.0, 0.1
#: A site with fewer pages is never joined by a broadcast.
LEAST_HOT_PAGES = 1_000
#: G2 histogram: bins of 0.01 up to 2000 (a p-value far under any threshold); fixed size.
BIN, BINS = 0.01, 200_000


def site_of(url: Column) -> Column:
    """Host of a url: no letter case, scheme, user, leading www., port or surrounding blanks; null without a host."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(url, r"(?U)^[\s\p{Z}]+|[\s\p{Z}]+$", "")), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_extract(bare, r"^(?:[^/?#@]*@)?([^/?#:]*)", 1)
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r"\.$", "")
    return F.when(host != "", host)


def lines_in_letters(text: Column) -> Column:
    """The letters of every line of a text in order, lower case: one pass over the text, the lines keep their numbers."""
    return F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\n]+", ""), "\n")


def key_of(letters: Column) -> Column:
    """16 bytes that stand for the letters of a line."""
    return F.unhex(F.md5(letters))


def page_lines(pages: DataFrame, id_col: str, url_col: str, text_col: str) -> DataFrame:
    """(id, site, line_no, key) of every line with letters of a page of some site."""
    return (
        pages.select(F.col(id_col).alias("page"), site_of(F.col(url_col)).alias("site"), F.posexplode(lines_in_letters(F.col(text_col))).alias("line_no", "letters"))
        .where("site IS NOT NULL AND letters <> ''")
        .select("page", "site", "line_no", key_of(F.col("letters")).alias("key"))
    )


def site_line_counts(pages: DataFrame, id_col: str, url_col: str, text_col: str) -> DataFrame:
    """(site, key, pages): the number of the site's pages that hold the line, each page once."""
    lines = F.array_distinct(lines_in_letters(F.col(text_col)))
    per_page = pages.select(site_of(F.col(url_col)).alias("site"), F.explode(lines).alias("letters")).where("site IS NOT NULL AND letters <> ''")
    return per_page.select("site", key_of(F.col("letters")).alias("key")).groupBy("site", "key").agg(F.count(F.lit(1)).alias("pages"))


def g2(k1: Column, n1: Column, k2: Column, n2: Column) -> Column:
    """Dunning's log-likelihood ratio of two binomial shares; 0 where the first share isn't the larger one."""

    def ll(k: Column, n: Column, p: Column) -> Column:
        return F.when(k > 0, k * F.log(p)).otherwise(F.lit(0.0)) + F.when(n > k, (n - k) * F.log1p(-p)).otherwise(F.lit(0.0))

    p1, p2, p = k1 / n1, F.coalesce(k2 / F.nullif(n2, F.lit(0)), F.lit(0.0)), (k1 + k2) / (n1 + n2)
    value = 2 * (ll(k1, n1, p1) + ll(k2, n2, p2) - ll(k1, n1, p) - ll(k2, n2, p))
    return F.when(p1 > p2, F.greatest(value, F.lit(0.0))).otherwise(F.lit(0.0))


def fdr_threshold(hist: list[tuple[int, int]], rate: float) -> float:
    """Benjamini-Hochberg over binned G2 values (one-sided, one degree of freedom): the least G2 that is significant."""
    total, seen, best = sum(n for _, n in hist), 0, math.inf
    for b, n in sorted(hist, reverse=True):
        seen += n
        if math.erfc(math.sqrt(b * BIN / 2)) / 2 <= rate * seen / total:
            best = b * BIN
    return best


def excess_lines(pages: DataFrame, id_col: str = "crawl_id", url_col: str = "src_url", text_col: str = "src_content", rate: float = FDR, min_pages: int = MIN_PAGES) -> tuple[DataFrame, int]:
    """(site, key, pages, g2) of the lines in significant excess on at least ``min_pages`` pages; and the sum of pages."""
    counts = site_line_counts(pages, id_col, url_col, text_col)
    sites = cut(pages.select(site_of(F.col(url_col)).alias("site")).where("site IS NOT NULL").groupBy("site").agg(F.count(F.lit(1)).alias("site_pages")))
    total, outside = sites.agg(F.coalesce(F.sum("site_pages"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("site_pages") >= min_pages, F.col("site_pages"))), F.lit(0))).first()
    # big sites, of which no more than a bounded number exist, are joined by a broadcast
    counts = cut(hot_key_join(counts, sites, ["site"], "site_pages", total, least=LEAST_HOT_PAGES))
    # of a line found on one page only of every site, there's nothing to test; its key's single occurrences are background
    single = F.when((F.col("pages") == 1) & (F.col("site_pages") >= min_pages), 1).otherwise(0)
    repeated = F.when(F.col("pages") > 1, 1).otherwise(0)
    by_key = counts.groupBy("key").agg(F.sum(single).alias("singles"), F.sum(repeated).alias("sites")).where("sites > 0")
    tested = hot_key_join(counts.where("pages > 1"), by_key, ["key"], "sites", counts.where("pages > 1").count())
    k1, n1 = F.col("pages").cast("double"), F.col("site_pages").cast("double")
    n2 = F.greatest(F.lit(float(outside)) - F.when(F.col("site_pages") >= min_pages, n1).otherwise(0.0), F.lit(0.0))
    k2 = F.least(F.col("singles").cast("double"), n2)
    scored = cut(tested.select("site", "key", "pages", g2(k1, n1, k2 + PRIOR_SEEN, n2 + PRIOR_PAGES).alias("g2")))
    hist = scored.groupBy(F.least(F.floor(F.col("g2") / BIN), F.lit(BINS)).cast("int").alias("bin")).count().collect()  # at most BINS + 1 rows
    threshold = fdr_threshold([(r["bin"], r["count"]) for r in hist], rate)
    excess = scored.where((F.col("g2") >= threshold) & (F.col("pages") >= min_pages))
    return excess, excess.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0]


def found_lines(pages: DataFrame, id_col: str = "crawl_id", url_col: str = "src_url", text_col: str = "src_content", rate: float = FDR, min_pages: int = MIN_PAGES) -> DataFrame:
    """(id, line_no int) of every occurrence of a line in significant excess on its site."""
    excess, total = excess_lines(pages, id_col, url_col, text_col, rate, min_pages)
    rows = page_lines(pages, id_col, url_col, text_col)
    return hot_key_join(rows, excess, ["site", "key"], "pages", total).select(F.col("page").alias(id_col), F.col("line_no").cast("int").alias("line_no"))


def without_lines(pages: DataFrame, found: DataFrame, id_col: str = "crawl_id", text_col: str = "src_content") -> DataFrame:
    """(id, text) of every page, without the found lines, the others in their order."""
    gone = found.groupBy(id_col).agg(F.collect_list("line_no").alias("gone"))
    lines = F.split(text_col, "\n")
    # the anti-join of each page's places with the found ones, by hash within the row; what is left is put together by place
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce("gone", F.array().cast("array<int>")))
    return pages.select(id_col, text_col).join(gone, id_col, "left").select(id_col, F.when(F.col(text_col).isNotNull(), F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")).alias(text_col))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found_lines(table(spark, sf_dir, "general_crawler"))


def p1_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "general_crawler")
    return without_lines(pages, found_lines(pages))


_LINES = r"""
lines AS (
  SELECT crawl_id, src_content, unnest(str_split(src_content, chr(10))) AS line, unnest(range(len(str_split(src_content, chr(10))))) AS line_no,
         regexp_replace(regexp_replace(regexp_extract(regexp_replace(lower(trim(src_url)), '^[a-z][a-z0-9+.-]*://', ''), '^([^/?#:]*)', 1), '^www\.', ''), '\.$', '') AS site
  FROM general_crawler WHERE src_url IS NOT NULL AND src_content IS NOT NULL),
keyed AS (SELECT *, regexp_replace(lower(line), '[^\p{L}]+', '', 'g') AS k FROM lines),
often AS (SELECT site, k FROM keyed WHERE k <> '' AND site <> '' GROUP BY site, k HAVING count(DISTINCT crawl_id) >= 6),
found AS (SELECT crawl_id, CAST(line_no AS INTEGER) AS line_no FROM keyed JOIN often USING (site, k))
"""
QUERIES = {"p1_found": p1_found, "p1_clean": p1_clean}
SQL = {
    "p1_found": f"WITH {_LINES} SELECT crawl_id, line_no FROM found",
    "p1_clean": f"""WITH {_LINES}, gone AS (SELECT crawl_id, list(line_no) AS g FROM found GROUP BY crawl_id),
numbered AS (SELECT crawl_id, src_content, g, str_split(src_content, chr(10)) AS l FROM general_crawler LEFT JOIN gone USING (crawl_id))
SELECT crawl_id, CASE WHEN src_content IS NULL THEN NULL ELSE coalesce(array_to_string([l[i + 1] FOR i IN range(len(l)) IF NOT list_contains(coalesce(g, []), CAST(i AS INTEGER))], chr(10)), '') END AS src_content FROM numbered""",
}
