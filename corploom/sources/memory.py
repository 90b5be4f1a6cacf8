"""Translation memories: TMX, XLIFF dialects, simple XML, workbooks, pairs of text files and Parquet.

All readers give (file, unit, src, tgt), texts with white space collapsed and trimmed. ``unit`` orders the units of a file as
far as the format's reader keeps the order of its splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corploom.sources.sheets import read_pairs, write_xlsx
from corploom.sources.text import read_parallel

_TEXT = "STRUCT<_VALUE: STRING>"


def _clean(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def _xml(spark: SparkSession, paths, tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).option("attributePrefix", "_").option("ignoreNamespace", "true").option("ignoreSurroundingSpaces", "true").schema(schema).load(paths).withColumn("file", F.col("_metadata.file_path")).withColumn("unit", F.monotonically_increasing_id())


def read_tmx(spark: SparkSession, paths, skip_first: bool = False) -> DataFrame:
    """Units with exactly two segments; ``skip_first`` drops the first unit of each file (aligned file names)."""
    df = _xml(spark, paths, "tu", "tuv ARRAY<STRUCT<_lang: STRING, seg: STRING>>").where(F.size("tuv") == 2)
    if skip_first:
        first = df.groupBy("file").agg(F.min("unit").alias("first"))
        df = df.join(F.broadcast(first) if first.count() <= 10_000 else first, "file").where("unit <> first").drop("first")
    seg = lambda i: _clean(F.col("tuv")[i]["seg"])
    return df.select("file", "unit", F.lower(F.col("tuv")[0]["_lang"]).alias("src_lang"), F.lower(F.col("tuv")[1]["_lang"]).alias("tgt_lang"), seg(0).alias("src"), seg(1).alias("tgt")).where("src IS NOT NULL AND tgt IS NOT NULL")


def _required(c: Column, what: str) -> Column:
    return F.when(c.isNull() | (c == ""), F.raise_error(F.lit(f"a unit has no {what}")).cast("string")).otherwise(c)


def read_mxliff(spark: SparkSession, paths) -> DataFrame:
    """Units with source and target; a missing or empty one raises. With the origin of machine output and the memory's score."""
    df = _xml(spark, paths, "trans-unit", "_id STRING, `_trans-origin` STRING, `_gross-score` DOUBLE, source STRING, target STRING")
    return df.select("file", "unit", _required(_clean(F.col("source")), "source").alias("src"), _required(_clean(F.col("target")), "target").alias("tgt"), F.col("_trans-origin").alias("mt_origin"), F.col("_gross-score").alias("score"))


def mxliff_sources(spark: SparkSession, paths) -> DataFrame:
    """(file, unit, src) of all units, null sources included."""
    return _xml(spark, paths, "trans-unit", "source STRING").select("file", "unit", _clean(F.col("source")).alias("src"))


def by_origin(units: DataFrame, origins: list[str] | None = None) -> DataFrame:
    """All units, or those of the given origins (equality)."""
    return units if origins is None else units.where(F.col("mt_origin").isin(list(origins)))


def read_sdlxliff(spark: SparkSession, paths) -> DataFrame:
    """As above; the target is its first marked piece."""
    df = _xml(spark, paths, "trans-unit", "_id STRING, source STRING, target STRUCT<mrk: ARRAY<STRUCT<_mid: STRING, _VALUE: STRING>>>")
    return df.select("file", "unit", _required(_clean(F.col("source")), "source").alias("src"), _required(_clean(F.get("target.mrk", F.lit(0))["_VALUE"]), "target").alias("tgt"))


def read_simple_xml(spark: SparkSession, paths) -> DataFrame:
    """``seg`` elements with ``src`` and ``tgt``; empty ones are left out."""
    df = _xml(spark, paths, "seg", "src STRING, tgt STRING")
    return df.select("file", "unit", _clean(F.col("src")).alias("src"), _clean(F.col("tgt")).alias("tgt")).where("coalesce(src, '') <> '' AND coalesce(tgt, '') <> ''")


def read_memory(spark: SparkSession, path, kind: str, **options) -> DataFrame:
    """(unit, src, tgt) of any supported kind: tmx, mxliff, sdlxliff, xml, excel, 2txt (two paths), parquet."""
    if kind == "2txt":
        if len(path) != 2:
            raise ValueError("2txt takes two paths")
        return read_parallel(spark, *path).withColumnRenamed("line_no", "unit")
    if kind == "excel":
        if not str(path).lower().endswith(".xlsx"):
            raise ValueError("not a workbook")
        return read_pairs(spark, path).withColumnRenamed("line_no", "unit")
    if kind == "parquet":
        return spark.read.parquet(path).select(F.col("unit") if "unit" in spark.read.parquet(path).columns else F.monotonically_increasing_id().alias("unit"), "src", "tgt")
    readers = {"tmx": read_tmx, "mxliff": read_mxliff, "sdlxliff": read_sdlxliff, "xml": read_simple_xml}
    if kind not in readers:
        raise ValueError(f"unknown kind {kind}")
    return readers[kind](spark, path, **options).select("unit", "src", "tgt")


def write_tmx(pairs: DataFrame, path: str, src_lang: str, tgt_lang: str, src: str = "src", tgt: str = "tgt") -> None:
    """A folder of complete TMX documents, one a task; rows with a null side are left out."""
    from collections.abc import Iterator
    from xml.sax.saxutils import escape, quoteattr

    import pandas as pd

    a, b = quoteattr(src_lang), quoteattr(tgt_lang)

    def document(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": [f'<?xml version="1.0" encoding="UTF-8"?><tmx version="1.4"><header creationtool="corploom" creationtoolversion="1" segtype="sentence" o-tmf="none" adminlang="en" srclang={a} datatype="plaintext"/><body>']})
        for pdf in parts:
            # line ends inside a segment would end a line of the file
            flat = pdf.map(lambda x: escape(" ".join(x.splitlines())))
            yield pd.DataFrame({"value": [f"<tu><tuv xml:lang={a}><seg>{x}</seg></tuv><tuv xml:lang={b}><seg>{y}</seg></tuv></tu>" for x, y in zip(flat["src"], flat["tgt"])]})
        yield pd.DataFrame({"value": ["</body></tmx>"]})

    whole = pairs.select(F.col(src).alias("src"), F.col(tgt).alias("tgt")).where("src IS NOT NULL AND tgt IS NOT NULL")
    whole.mapInPandas(document, "value string").write.mode("overwrite").text(path)


def mxliff_to_xlsx(spark: SparkSession, paths, out: str, origins: list[str] | None = None) -> None:
    """A workbook of the source and target of all units (or those of the given origins), in the order of the file."""
    write_xlsx({"Sheet1": by_origin(read_mxliff(spark, paths), origins).orderBy("file", "unit").select(F.col("src").alias("source"), F.col("tgt").alias("target"))}, out)
