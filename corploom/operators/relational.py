"""Deduplication, set operations, sampling, keyed updates and joins, each with an explicit order.

Line order is data here: operators that keep the first of several rows take the columns that define the order. Null keys are
keys like others in deduplication and never match in joins. Extra columns are kept where rows are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key by the order; ties are the caller's to break.

    A row number limited to 1: each task keeps one row a key before the shuffle, however hot the key, and sorts and shuffles
    by 16 bytes in place of a text key.
    """
    text = len(keys) == 1 and df.schema[keys[0]].dataType == T.StringType()
    by = [F.unhex(F.md5(F.col(keys[0])))] if text else [F.col(k) for k in keys]
    w = Window.partitionBy(*by).orderBy(*[F.col(o).asc() if isinstance(o, str) else o for o in order])
    return df.withColumn("_first", F.row_number().over(w)).where(F.col("_first") == 1).drop("_first")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return keep_first(df, keys, [(F.col(o) if isinstance(o, str) else o).desc() for o in order])


def merge_keep_first(frames: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Union of the frames in their order, then the first row of each key; the frame's number is the column ``part``."""
    whole = None
    for i, df in enumerate(frames):
        one = df.withColumn("part", F.lit(i))
        whole = one if whole is None else whole.unionByName(one)
    return keep_first(whole, keys, ["part", *order])


def left_over(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key isn't known yet; duplicates stay. A null key is never known."""
    return df.join(known.select(*keys), list(keys), "left_anti")


def group_difference(new: DataFrame, old: DataFrame, group: str, item: str) -> DataFrame:
    """(group, item) pairs of the new frame that the old one lacks, each once."""
    return new.select(group, item).subtract(old.select(group, item))


def missing_groups(a: DataFrame, b: DataFrame, group: str) -> DataFrame:
    """(group, in_a, in_b) of the groups that only one side has: empty if the sets agree."""
    left, right = a.select(group).distinct().withColumn("in_a", F.lit(True)), b.select(group).distinct().withColumn("in_b", F.lit(True))
    return left.join(right, group, "full").where(F.col("in_a").isNull() | F.col("in_b").isNull()).select(group, F.coalesce("in_a", F.lit(False)).alias("in_a"), F.coalesce("in_b", F.lit(False)).alias("in_b"))


def update_by_key(base: DataFrame, new: DataFrame, keys: Sequence[str], defaults: dict | None = None) -> DataFrame:
    """Base rows with the new values that aren't null; keys that only the new frame has are ignored. One new row a key."""
    changed = [c for c in new.columns if c not in keys and c in base.columns]
    joined = base.fillna(defaults or {}).join(new.select(*keys, *[F.col(c).alias(f"new_{c}") for c in changed]), list(keys), "left")
    return joined.select(*[F.coalesce(f"new_{c}", c).alias(c) if c in changed else F.col(c) for c in base.columns])


def add_counts(base: DataFrame, events: DataFrame, key: str, into: str) -> DataFrame:
    """Base rows with the number of their events added to a column (null counts as 0)."""
    n = events.groupBy(key).agg(F.count(F.lit(1)).alias("n_events"))
    return base.join(n, key, "left").withColumn(into, F.coalesce(into, F.lit(0)) + F.coalesce("n_events", F.lit(0))).drop("n_events").select(*base.columns)


def group_items(df: DataFrame, group: str, item: str, out: str = "items") -> DataFrame:
    """(group, items): the sorted items of each group, nulls left out."""
    return df.groupBy(group).agg(F.array_sort(F.collect_list(item)).alias(out))


def section_runs(df: DataFrame, order: str, is_header: Column, text: str, partition: Sequence[str] = (), skip: int = 1) -> DataFrame:
    """Rows of sections: from ``skip`` rows after a header to the next blank row; with the header's text as ``section``.

    Partitions bound the windows; without one the frame must be one sheet.
    """
    w = Window.partitionBy(*partition).orderBy(order)
    blank = F.trim(F.coalesce(F.col(text), F.lit(""))) == ""
    marked = df.withColumn("section", F.last(F.when(is_header, F.col(text)), True).over(w)).withColumn("_at", F.last(F.when(is_header, F.row_number().over(w)), True).over(w)).withColumn("_row", F.row_number().over(w))
    ended = marked.withColumn("_end", F.sum(F.when(blank & (F.col("_row") > F.col("_at") + skip), 1).otherwise(0)).over(Window.partitionBy(*partition, "section", "_at").orderBy(order)))
    return ended.where((F.col("_row") > F.col("_at") + skip) & (F.col("_end") == 0)).drop("_at", "_row", "_end")


def exact_sample(df: DataFrame, key: str, n: int, seed: str = "0") -> DataFrame:
    """Exactly n rows (all, if there are fewer), the same ones for a seed: the smallest hashes of the key."""
    return df.orderBy(F.md5(F.concat(F.lit(seed), F.lit(":"), F.col(key).cast("string"))), key).limit(n)


def zip_rows(a: DataFrame, b: DataFrame, session: str, row: str) -> DataFrame:
    """Rows of both frames with the same session and number; the shorter one decides."""
    return a.join(b, [session, row])


def segment_records(lines: DataFrame, src_lang: str, tgt_lang: str, kind: str, website_id: int | None = None, file_id: int | None = None) -> DataFrame:
    """Lines (line_no, src, tgt) as rows of the segments table; query_id is line_no + 1."""
    return lines.select(
        (F.col("line_no") + 1).cast("long").alias("query_id"), F.lit(src_lang).alias("src_lang"), F.lit(tgt_lang).alias("tgt_lang"), F.col("src").alias("src_text"), F.col("tgt").alias("tgt_text"),
        F.lit(None).cast("double").alias("quality"), F.lit(kind).alias("type"), F.lit(website_id).cast("long").alias("website_id"), F.lit(file_id).cast("long").alias("file_id"), F.lit(None).cast("string").alias("note"),
    )


def union_sheets(sheets: dict[str, DataFrame], label: str = "Industry", name: str = "company") -> DataFrame:
    """All sheets with their names as a column; trailing periods of a name are dropped; distinct rows."""
    whole = None
    for sheet, df in sheets.items():
        one = df.withColumn(label, F.lit(sheet)).withColumn(name, F.regexp_replace(name, r"(?U)^\s*(.+?)\.+\s*$", "$1"))
        whole = one if whole is None else whole.unionByName(one)
    return whole.distinct()


def with_metadata(segments: DataFrame, source: DataFrame, domains: DataFrame, key: str = "website_id") -> DataFrame:
    """Segments with the source (website or file) and its domain. Rows without one are left out.

    The sources are joined with their domains first: both are far smaller than the segments.
    """
    extra = [c for c in ("format",) if c in source.columns]
    meta = source.select(key, "uri", "owner", *extra, "ycc_id").join(domains.select("ycc_id", "ycc", "domain"), "ycc_id").drop("ycc_id")
    return segments.select("query_id", "src_text", "tgt_text", "quality", key).join(meta, key)


def staleness(df: DataFrame, last: str, size: str, today: Column, days: int, skip_empty: bool = True) -> DataFrame:
    """Column ``action``: skip (size 0, if asked), recrawl (unknown or at least ``days`` old), or count."""
    empty = (F.coalesce(size, F.lit(0)) == 0) & F.lit(skip_empty)
    old = F.col(last).isNull() | (F.datediff(today, F.col(last)) >= days)
    return df.withColumn("action", F.when(empty, "skip").when(old, "recrawl").otherwise("count"))


def metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(label, precision, recall, f1, support, accuracy) of each label of either column; rows with a null truth don't count."""
    known = df.where(F.col(truth).isNotNull())
    pairs = known.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).count()
    hits = pairs.where("t = p").select(F.col("t").alias("label"), F.col("count").alias("tp"))
    support = pairs.groupBy(F.col("t").alias("label")).agg(F.sum("count").alias("support"))
    guessed = pairs.where("p IS NOT NULL").groupBy(F.col("p").alias("label")).agg(F.sum("count").alias("guessed"))
    whole = pairs.agg(F.sum("count").alias("n"), F.sum(F.when(F.col("t") == F.col("p"), F.col("count")).otherwise(0)).alias("right")).withColumn("one", F.lit(1))
    tp, s, g = F.coalesce("tp", F.lit(0)), F.coalesce("support", F.lit(0)), F.coalesce("guessed", F.lit(0))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    rows = support.join(guessed, "label", "full").join(hits, "label", "left").withColumn("one", F.lit(1)).join(whole, "one")
    return rows.select("label", ratio(tp, g).alias("precision"), ratio(tp, s).alias("recall"), ratio(2 * tp, s + g).alias("f1"), s.alias("support"), ratio(F.col("right"), F.col("n")).alias("accuracy"))
