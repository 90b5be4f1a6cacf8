"""Text and CSV in and out. Lines keep their number; a carriage return before a line end belongs to it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_whole(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, text): one row a file."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def read_lines(spark: SparkSession, paths: str | Sequence[str], strip: bool = False) -> DataFrame:
    """(file, line_no, text) with numbers from 0. An empty file has no lines; a final line end makes no line of its own.

    Files are read whole to number their lines; for files beyond an executor's memory use ``read_large_lines``.
    """
    whole = read_whole(spark, paths)
    lines = F.split(F.regexp_replace(F.regexp_replace("text", "\r\n?", "\n"), r"\n\z", ""), "\n")
    out = whole.where("text <> ''").select("file", F.posexplode(lines).alias("line_no", "text"))
    return out.select("file", F.col("line_no").cast("long").alias("line_no"), F.trim("text").alias("text") if strip else F.col("text"))


def read_large_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, block, row, text): splittable; the order within a file is (block, row), block being the start of the split."""
    raw = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("text"))
    return raw.withColumn("row", F.monotonically_increasing_id()).select("file", "block", "row", "text")


def read_csv(spark: SparkSession, paths: str | Sequence[str], header: bool = True, sep: str = ",", schema: str | None = None) -> DataFrame:
    """Columns as text unless a schema is given; quoted fields may hold line ends; carriage returns in fields are dropped."""
    df = spark.read.csv(paths, header=header, sep=sep, schema=schema, multiLine=True, escape='"')
    return df.select(*[F.regexp_replace(c, "\r", "").alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def read_parallel(spark: SparkSession, source: str, target: str) -> DataFrame:
    """(line_no, src, tgt) of two files. Raises at run time if one is longer."""
    a = read_lines(spark, source).select("line_no", F.col("text").alias("src"))
    b = read_lines(spark, target).select("line_no", F.col("text").alias("tgt"))
    both = a.join(b, "line_no", "full")
    uneven = F.raise_error(F.concat(F.lit("the files differ in length at line "), F.col("line_no").cast("string"))).cast("string")
    return both.select("line_no", F.when(F.col("src").isNull() | F.col("tgt").isNull(), uneven).otherwise(F.col("src")).alias("src"), "tgt")


def write_lines(df: DataFrame, path: str, text: str = "text", order: str | None = None, mode: str = "append") -> None:
    """One stripped line a row, in order if one is given; null rows are empty lines."""
    out = df.orderBy(order) if order else df
    out.select(F.trim(F.coalesce(F.col(text), F.lit(""))).alias("value")).write.mode(mode).text(path)


def write_by_language(df: DataFrame, path: str, text: str, lang: str, mode: str = "append") -> None:
    """Lines in a folder of their language."""
    df.select(F.trim(text).alias("value"), F.col(lang).alias("lang")).write.mode(mode).partitionBy("lang").text(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=header, escape='"')


def write_aligner_input(pairs: DataFrame, path: str, src: str, tgt: str) -> None:
    """``source ||| target`` a line."""
    pairs.select(F.concat_ws(" ||| ", F.trim(src), F.trim(tgt)).alias("value")).write.mode("overwrite").text(path)


def append(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Rows added to a Parquet table, by partitions if asked."""
    w = df.write.mode("append")
    (w.partitionBy(partition) if partition else w).parquet(path)


def insert(df: DataFrame, name: str, primary_key: str | None = None) -> None:
    """Rows added to a catalog table; without a primary key column, it is left to the table (null)."""
    target = df.sparkSession.table(name)
    cols = [F.lit(None).cast(f.dataType).alias(f.name) if f.name not in df.columns or f.name == primary_key else F.col(f.name) for f in target.schema.fields]
    df.select(*cols).write.insertInto(name)
