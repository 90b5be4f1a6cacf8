"""Structured Streaming: cleaning, deduplication within a watermark, and windowed counts of arriving segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corploom.functions import segment as S
from corploom.functions.normalize import cat_tags


def segment_stream(spark: SparkSession, path: str, schema: str, files_a_trigger: int = 100) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(path)


def clean_stream(stream: DataFrame, text: str, time: str, lateness: str = "1 day") -> DataFrame:
    """Segments without tags, with the word length and shape of one, each text once within the watermark.

    Rows later than the watermark are dropped by the state store; null texts are dropped here.
    """
    t = cat_tags(F.col(text))
    kept = stream.withColumn(text, t).where(S.has_word_length(F.col(text)) & S.is_sentence(F.col(text)))
    return kept.withWatermark(time, lateness).dropDuplicatesWithinWatermark([text])


def windowed_counts(stream: DataFrame, time: str, key: str, window: str = "1 hour", lateness: str = "2 hours") -> DataFrame:
    """(window_start, key, n): rows of each key in each window; a window is final when the watermark passes its end."""
    return stream.withWatermark(time, lateness).groupBy(F.window(time, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), key, "n")
