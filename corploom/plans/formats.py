"""Queries: texts through the sinks and sources and back. Files go to the shared folder of the checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from corploom.session import ensure_checkpoint_dir, table
from corploom.sources import memory as M, sheets as X, text as T


def _scratch(spark: SparkSession, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def tmx_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, tgt) of all records with text on both sides, written as TMX and read again."""
    path = _scratch(spark, "tmx")
    M.write_tmx(table(spark, sf_dir, "tm_fileparser"), path, "en", "fr", "srctexts", "tgttexts")
    return M.read_tmx(spark, path).select("src", "tgt")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "csv")
    T.write_csv(table(spark, sf_dir, "segments").select("query_id", "src_text", "tgt_text"), path)
    return T.read_csv(spark, path).select(F.col("query_id").cast("long").alias("query_id"), "src_text", "tgt_text")


def lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(text, n): lines of the segments, written as text files and counted; nulls are empty lines."""
    path = _scratch(spark, "lines")
    T.write_lines(table(spark, sf_dir, "segments").select("query_id", F.regexp_replace("tgt_text", r"[\r\n]+", " ").alias("text")), path)
    return T.read_large_lines(spark, path).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


def language_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lang, lines): lines routed to a folder of their language, read again."""
    path = _scratch(spark, "langs")
    T.write_by_language(table(spark, sf_dir, "segments").select(F.regexp_replace("src_text", r"[\r\n]+", " ").alias("t"), F.lower(F.trim("src_lang")).alias("l")), path, "t", "l")
    return spark.read.text(path).groupBy("lang").agg(F.count(F.lit(1)).alias("lines"))


def aligner_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "aligner")
    T.write_aligner_input(table(spark, sf_dir, "segments").where("tgt_text IS NOT NULL").select(*[F.regexp_replace(c, r"[\r\n]+", " ").alias(c) for c in ("src_text", "tgt_text")]), path, "src_text", "tgt_text")
    return spark.read.text(path)


def partitioned_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(format, n): two appends to a table with partitions."""
    path, df = _scratch(spark, "append"), table(spark, sf_dir, "source_file").select("file_id", F.coalesce(F.lower("format"), F.lit("-")).alias("format"))
    T.append(df, path, "format")
    T.append(df, path, "format")
    return spark.read.parquet(path).groupBy("format").agg(F.count(F.lit(1)).alias("n"))


def _local(spark: SparkSession, name: str) -> str:
    """A file for the driver's own writers, in the shared folder."""
    return _scratch(spark, name).removeprefix("file:") + ".xlsx"


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memory records with two sides that aren't blank, flat and escaped."""
    flat = lambda c: F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    safe = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    return table(spark, sf_dir, "tm_fileparser").select("tm_id", "score", "mt_origin", safe(flat("srctexts")).alias("s"), safe(flat("tgttexts")).alias("t")).where("s <> '' AND t <> ''")


def _documents(lines: DataFrame, path: str, root: str) -> str:
    """A folder of XML documents of one root element, one a task."""

    def whole(parts):
        import pandas as pd

        yield pd.DataFrame({"value": [f'<?xml version="1.0" encoding="UTF-8"?><{root}>']})
        yield from parts
        yield pd.DataFrame({"value": [f"</{root}>"]})

    lines.mapInPandas(whole, "value string").write.text(path)
    return path


def _xliff(spark: SparkSession, sf_dir: str, target: str) -> str:
    """A folder of translation units in an XLIFF dialect."""
    attribute = lambda name, c: F.coalesce(F.concat(F.lit(f' {name}="'), F.col(c).cast("string"), F.lit('"')), F.lit(""))
    unit = F.concat(F.lit("<trans-unit"), attribute("id", "tm_id"), attribute("trans-origin", "mt_origin"), attribute("gross-score", "score"), F.lit("><source>"), "s", F.lit("</source><target>"), F.expr(target), F.lit("</target></trans-unit>"))
    return _documents(_units(spark, sf_dir).select(unit.alias("value")), _scratch(spark, "xliff"), "xliff")


def mxliff_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.read_mxliff(spark, _xliff(spark, sf_dir, "t")).select("src", "tgt", "mt_origin", "score")


def mxliff_origin_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of two origins with their number and mean score."""
    units = M.by_origin(M.read_mxliff(spark, _xliff(spark, sf_dir, "t")), ["mt", "tm"])
    return units.groupBy("mt_origin").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("score"))


def mxliff_source_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.mxliff_sources(spark, _xliff(spark, sf_dir, "t")).select("src")


def sdlxliff_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.read_sdlxliff(spark, _xliff(spark, sf_dir, "concat('<mrk mid=\"1\">', t, '</mrk><mrk mid=\"2\">more</mrk>')")).select("src", "tgt")


def xml_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simple XML; every seventh target is empty and leaves its unit out."""
    lines = _units(spark, sf_dir).select(F.concat(F.lit("<seg><src>"), "s", F.lit("</src><tgt>"), F.when(F.col("tm_id") % 7 == 0, F.lit("")).otherwise(F.col("t")), F.lit("</tgt></seg>")).alias("value"))
    return M.read_memory(spark, _documents(lines, _scratch(spark, "xml"), "memory"), "xml").select("src", "tgt")


def memory_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "memory")
    T.append(table(spark, sf_dir, "tm_fileparser").select(F.col("tm_id").alias("unit"), F.col("srctexts").alias("src"), F.col("tgttexts").alias("tgt")), path)
    return M.read_memory(spark, path, "parquet")


def _one_file(spark: SparkSession, sf_dir: str, column: str) -> str:
    """One text file of a column of the (fixed, small) table of domains."""
    path = _scratch(spark, column)
    T.write_lines(table(spark, sf_dir, "ycc_domains").coalesce(1), path, column, "ycc_id")
    return path


def two_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(unit, src, tgt): two files line by line."""
    return M.read_memory(spark, [_one_file(spark, sf_dir, c) for c in ("ycc", "domain")], "2txt").select("unit", "src", "tgt")


def whole_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.read_whole(spark, _one_file(spark, sf_dir, "domain")).select("text")


def stripped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "blank")
    table(spark, sf_dir, "ycc_domains").coalesce(1).orderBy("ycc_id").select(F.concat(F.lit("  "), F.coalesce("domain", F.lit("")), F.lit(" ")).alias("value")).write.text(path)
    return T.read_lines(spark, path, strip=True).select("line_no", "text")


def _book(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _local(spark, "book")
    X.write_xlsx({"site": table(spark, sf_dir, "website").orderBy("website_id").select("website_id", "owner", "size"), "code": table(spark, sf_dir, "ycc_domains").orderBy("ycc_id").select("ycc", "domain")}, path)
    return X.read_xlsx(spark, path)


def excel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the first sheet below its names, numbers as text."""
    return X.rows(_book(spark, sf_dir), "site", first=1, end=2)


def excel_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.columns(_book(spark, sf_dir), "code", first=0, start=1, end=36).select("col", "values")


def excel_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.cell(_book(spark, sf_dir), "code", 0, 1)


def excel_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A memory as a workbook of two columns."""
    path = _local(spark, "pairs")
    X.write_xlsx({"one": table(spark, sf_dir, "ycc_domains").orderBy("ycc_id").select("ycc", "domain")}, path)
    return M.read_memory(spark, path, "excel").select("unit", "src", "tgt")


def mxliff_to_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All units of the memory in a workbook, read again."""
    path = _local(spark, "units")
    M.mxliff_to_xlsx(spark, _xliff(spark, sf_dir, "t"), path)
    return M.read_memory(spark, path, "excel").where("unit > 0").select("src", "tgt")


def table_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows inserted twice into a catalog table: with their key, and without."""
    name = f"corploom_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (website_id BIGINT, owner STRING, note STRING) USING parquet LOCATION '{_scratch(spark, name)}'")
    rows = table(spark, sf_dir, "website").select("website_id", "owner")
    T.insert(rows, name)
    T.insert(rows, name, "website_id")
    return spark.table(name)


_FLAT = r"trim(regexp_replace({c}, '[\s\x0b\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g'), ' ')"
_SIDES = f"SELECT * FROM (SELECT *, {_FLAT.format(c='srctexts')} AS s, {_FLAT.format(c='tgttexts')} AS t FROM tm_fileparser) WHERE s <> '' AND t <> ''"
QUERIES = {f.__name__: f for f in (tmx_roundtrip, csv_roundtrip, lines_roundtrip, language_folders, aligner_input, partitioned_append, mxliff_roundtrip, mxliff_origin_filter, mxliff_source_only, sdlxliff_roundtrip, xml_roundtrip, memory_parquet, two_text_files, whole_file, stripped_lines, excel_rows, excel_columns, excel_cell, excel_pairs, mxliff_to_sheet, table_insert)}
SQL = {
    "tmx_roundtrip": f"SELECT {_FLAT.format(c='srctexts')} AS src, {_FLAT.format(c='tgttexts')} AS tgt FROM tm_fileparser WHERE srctexts IS NOT NULL AND tgttexts IS NOT NULL",
    "csv_roundtrip": r"SELECT query_id, regexp_replace(src_text, '\r', '', 'g') AS src_text, regexp_replace(tgt_text, '\r', '', 'g') AS tgt_text FROM segments",
    "lines_roundtrip": r"SELECT trim(regexp_replace(coalesce(tgt_text, ''), '[\r\n]+', ' ', 'g'), ' ') AS text, count(*) AS n FROM segments GROUP BY 1",
    "language_folders": "SELECT lower(trim(src_lang)) AS lang, count(*) AS lines FROM segments GROUP BY 1",
    "aligner_input": r"SELECT trim(regexp_replace(src_text, '[\r\n]+', ' ', 'g'), ' ') || ' ||| ' || trim(regexp_replace(tgt_text, '[\r\n]+', ' ', 'g'), ' ') AS value FROM segments WHERE tgt_text IS NOT NULL",
    "partitioned_append": "SELECT coalesce(lower(format), '-') AS format, 2 * count(*) AS n FROM source_file GROUP BY 1",
    "mxliff_roundtrip": f"SELECT s AS src, t AS tgt, mt_origin, score FROM ({_SIDES})",
    "mxliff_origin_filter": f"SELECT mt_origin, count(*) AS n, round(avg(score), 6) AS score FROM ({_SIDES}) WHERE mt_origin IN ('mt', 'tm') GROUP BY 1",
    "mxliff_source_only": f"SELECT s AS src FROM ({_SIDES})",
    "sdlxliff_roundtrip": f"SELECT s AS src, t AS tgt FROM ({_SIDES})",
    "xml_roundtrip": f"SELECT s AS src, t AS tgt FROM ({_SIDES}) WHERE tm_id % 7 <> 0",
    "memory_parquet": "SELECT tm_id AS unit, srctexts AS src, tgttexts AS tgt FROM tm_fileparser",
    "two_text_files": "SELECT row_number() OVER (ORDER BY ycc_id) - 1 AS unit, trim(ycc) AS src, trim(domain) AS tgt FROM ycc_domains",
    "whole_file": "SELECT string_agg(trim(coalesce(domain, '')) || chr(10), '' ORDER BY ycc_id) AS text FROM ycc_domains",
    "stripped_lines": "SELECT row_number() OVER (ORDER BY ycc_id) - 1 AS line_no, trim(coalesce(domain, '')) AS text FROM ycc_domains",
    "excel_rows": "SELECT CAST(row_number() OVER (ORDER BY website_id) AS INTEGER) AS row, [CAST(website_id AS VARCHAR), owner, CAST(size AS VARCHAR)] AS values FROM website",
    "excel_columns": "SELECT CAST(0 AS INTEGER) AS col, list(ycc ORDER BY ycc_id) AS values FROM ycc_domains UNION ALL SELECT 1, list(domain ORDER BY ycc_id) FROM ycc_domains",
    "excel_cell": "SELECT 'domain' AS value",
    "excel_pairs": "SELECT 0 AS unit, 'ycc' AS src, 'domain' AS tgt UNION ALL SELECT row_number() OVER (ORDER BY ycc_id), trim(coalesce(ycc, '')), trim(coalesce(domain, '')) FROM ycc_domains",
    "mxliff_to_sheet": f"SELECT s AS src, t AS tgt FROM ({_SIDES})",
    "table_insert": "SELECT website_id, owner, CAST(NULL AS VARCHAR) AS note FROM website UNION ALL SELECT NULL, owner, NULL FROM website",
}
