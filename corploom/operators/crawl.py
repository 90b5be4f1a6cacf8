"""Link graphs and page text of crawled pages, as tables; nothing here touches the network."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corploom.functions.normalize import visible_text
from corploom.operators.relational import keep_first
from corploom.session import cut

ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"'<>]*)["']"""
# Endings that are no pages.
UNWANTED = ("jpg", "jpeg", "png", "gif", "zip", "doc", "docx", "xls", "xlsx", "ppt", "pptx", "mp3", "mp4", "css", "js", "ico")


def host_of(url: Column) -> Column:
    """Scheme and host, lower case."""
    return F.lower(F.regexp_extract(F.trim(url), r"^([A-Za-z][\w+.-]*://[^/?#]+)", 1))


def absolute(base: Column, link: Column) -> Column:
    """A link of a page as an absolute url without its fragment; null for other schemes and empty links."""
    bare = F.regexp_replace(F.trim(link), "#.*$", "")
    directory = F.regexp_replace(F.regexp_replace(base, "[?#].*$", ""), r"(?<=[^/:])/[^/]*$", "/")
    joined = F.when(bare.rlike(r"^https?://"), bare).when(bare.rlike(r"^[A-Za-z][\w+.-]*:"), F.lit(None)).when(bare.rlike("^//"), F.concat(F.regexp_extract(base, r"^([A-Za-z]+:)", 1), bare))
    joined = joined.when(bare.rlike("^/"), F.concat(host_of(base), bare)).when(bare.rlike(r"^\?"), F.concat(F.regexp_replace(base, "[?#].*$", ""), bare)).when(bare != "", F.concat(directory, bare))
    # one step up a time; paths go up a few levels at most
    out = joined
    for _ in range(4):
        out = F.regexp_replace(F.regexp_replace(out, r"(?<!:)/\./", "/"), r"(?<![:/])/[^/]+/\.\./", "/")
    return out


def edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src_url, dst_url): every anchor of every page, absolute, each once."""
    links = pages.select(F.col(url).alias("src_url"), F.explode(F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(1))).alias("link"))
    return links.select("src_url", absolute(F.col("src_url"), F.col("link")).alias("dst_url")).where("dst_url IS NOT NULL").distinct()


def last_segment(url: Column) -> Column:
    """The last part of a path, or the one before it if that is empty."""
    parts = F.split(F.regexp_replace(url, "[?#].*$", ""), "/")
    return F.when(F.element_at(parts, -1) != "", F.element_at(parts, -1)).otherwise(F.try_element_at(parts, F.lit(-2)))


def wanted_links(links: DataFrame, url: str, head: str, other_head: str | None = None, query: bool = False) -> DataFrame:
    """Links inside the head (and not the other language's), no unwanted endings, no query unless allowed; column ``is_pdf``."""
    u = F.col(url)
    ending = F.lower(F.regexp_extract(last_segment(u), r"\.(\w+)$", 1))
    keep = F.startswith(u, F.lit(head)) & ~ending.isin(list(UNWANTED))
    if other_head:
        keep = keep & ~F.startswith(u, F.lit(other_head))
    if not query:
        keep = keep & ~F.contains(u, F.lit("?"))
    return links.where(keep).withColumn("is_pdf", ending == "pdf")


def breadth_first(links: DataFrame, seeds: DataFrame, most: int = 50) -> DataFrame:
    """(url, depth): urls reached from the seeds (url) by links (src_url, dst_url), with their least depth, in at most ``most`` steps.

    Each step joins the frontier with the links, drops what was visited and is cut by a checkpoint; it ends when nothing is new.
    """
    reached = cut(seeds.select("url").where("url IS NOT NULL").distinct().withColumn("depth", F.lit(0)))
    frontier = reached
    for step in range(1, most + 1):
        new = links.join(frontier.select(F.col("url").alias("src_url")), "src_url", "left_semi").select(F.col("dst_url").alias("url")).where("url IS NOT NULL").distinct().join(reached.select("url"), "url", "left_anti")
        frontier = cut(new.withColumn("depth", F.lit(step)))
        if frontier.isEmpty():
            break
        reached = cut(reached.unionByName(frontier))
    return reached


def pair_by_rule(pages: DataFrame, url: str, source_head: str, target_head: str) -> DataFrame:
    """(source, target): pages whose address with the other head is a page as well; the first source of each target."""
    own = pages.select(F.col(url).alias("source")).where(F.startswith(F.col(url), F.lit(source_head)))
    pairs = own.select("source", F.concat(F.lit(target_head), F.substring("source", F.lit(len(source_head) + 1), F.length("source"))).alias("target"))
    return keep_first(pairs.join(pages.select(F.col(url).alias("target")).distinct(), "target", "left_semi").select("source", "target"), ["target"], ["source"])


def pair_by_anchor(pages: DataFrame, url: str, html: str, label: str) -> DataFrame:
    """(source, target): the first anchor of a page with the label (a language's name) as its text; the first source of each target."""
    found = F.regexp_extract(F.col(html), ANCHOR + r"[^>]*>\s*" + label + r"\s*</a>", 1)
    pairs = pages.select(F.col(url).alias("source"), absolute(F.col(url), F.when(found != "", found)).alias("target")).where("target IS NOT NULL")
    return keep_first(pairs, ["target"], ["source"])


def first_of_target(pairs: DataFrame) -> DataFrame:
    """Pairs without those whose target was saved before."""
    return keep_first(pairs, ["target"], ["source"])


def page_text(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, lines): visible pieces of text, each once."""
    return pages.select(url, visible_text(F.col(html)).alias("lines"))


def document_type(html: Column) -> Column:
    """none without a content division, pdf with a viewer, else word."""
    return F.when(~html.rlike(r"(?is)<div\b[^>]*\b(?:id|class)\s*=\s*[\"'][^\"']*content"), "none").when(html.rlike(r"(?i)pdf-viewer"), "pdf").otherwise("word")


def language_of(url: Column, segment: int = 3) -> Column:
    """The language part of an address, null if there is none."""
    return F.nullif(F.try_element_at(F.split(url, "/"), F.lit(segment + 1)), F.lit(""))


def file_name(number: Column, url: Column, lang: str, ending: str = ".html", stem: int = 80) -> Column:
    """Six digits (more, if the number has more), the last part of the address cut to ``stem`` characters, language and ending."""
    n = number.cast("string")
    return F.concat(F.when(F.length(n) >= 6, n).otherwise(F.lpad(n, 6, "0")), F.lit("_"), F.substring(F.regexp_replace(last_segment(url), r"\.\w+$", ""), 1, stem), F.lit(f"_{lang.upper()}{ending}"))


def fetched(pages: DataFrame, status: str = "http_status", asked: str | None = None, final: str | None = None) -> DataFrame:
    """Pages that were fetched well (status 200) and, where both addresses are known, without a redirect. A null status is none."""
    ok = F.col(status) == 200
    if asked and final:
        ok &= F.col(asked) == F.col(final)
    return pages.where(ok)
