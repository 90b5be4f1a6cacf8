"""Problem 4: duplicates hidden by formatting differences.

Every record gets canonical bytes: both texts without letter case, white space, punctuation and symbols (but a mark directly
between two digits counts), the smaller one first. Then recursive radix partitioning on these bytes:

1. each map task counts its own copies in a trie (terminal counters: copies and smallest id) and hands on one partial
   record per distinct key, so that a group with a third of all rows is a few partial records;
2. buckets are prefixes of the canonical bytes. A bucket with more partial records than fit is split by further bytes, and
   its parts again, until each fits or its keys end, whatever the number of records and the length of the keys;
3. buckets are shuffled, sorted within their partition, and streamed through one trie per bucket.

Copies are found by joining the records with the groups of two or more (hot groups by a bounded broadcast).

A record with a null id, a null side or a side without letter or digit belongs to no group. Repeated ids count as copies of their own.
An empty table gives empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corploom.operators.skew import hot_key_join
from corploom.session import cut, table

#: A map task's trie is emptied downstream when it holds this many distinct keys (memory bound; no effect on results).
TRIE_KEYS = 20_000
#: Partial records that a bucket may hold before it is split by further bytes, and oversized prefixes that may be broadcast.
BUCKET_ROWS, SMALL_PREFIXES = 50_000, 1_000_000
FIRST_BYTES = 2


def canonical_side(text: Column) -> Column:
    """Canonical form of one text: case folded, white space, punctuation and symbols dropped, but for a mark directly between two digits."""
    # case folding beyond lower case: the sharp s and the final sigma
    folded = F.translate(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), "ς", "σ")
    # letters and digits, the bulk of a text, fail at the first test
    return F.regexp_replace(folded, r"(?=[^\p{L}\p{N}\p{M}])(?:[^\p{L}\p{N}\p{M}\p{P}\p{S}]+|(?<!\p{Nd})[\p{P}\p{S}]|[\p{P}\p{S}](?!\p{Nd}))", "")


def canonical_keys(src: Column, tgt: Column) -> Column:
    """Canonical bytes of a record, the same for exchanged sides, as an array of one; empty if a side has no letter or digit.

    Each side is computed once: lambdas bind it, and the caller's explode keeps the optimizer from repeating it.
    """
    sides = F.array_sort(F.transform(F.array(src, tgt), canonical_side))
    return F.filter(F.transform(F.array(sides), lambda p: F.when(F.forall(p, lambda x: F.coalesce(x.rlike(r"[\p{L}\p{N}]"), F.lit(False))), F.encode(F.concat(p[0], F.lit("\n"), p[1]), "UTF-8"))), lambda k: k.isNotNull())


class Trie:
    """Path-compressed trie over bytes; a terminal holds [copies, smallest id]."""

    __slots__ = ("root", "size")

    def __init__(self) -> None:
        self.root: list = [b"", None, {}]  # label, terminal, children by first byte
        self.size = 0

    def add(self, key: bytes, copies: int, smallest: int) -> None:
        node, rest = self.root, key
        while True:
            if not rest:
                if node[1] is None:
                    node[1], self.size = [copies, smallest], self.size + 1
                else:
                    node[1][0] += copies
                    node[1][1] = min(node[1][1], smallest)
                return
            child = node[2].get(rest[0])
            if child is None:
                node[2][rest[0]] = [rest, [copies, smallest], {}]
                self.size += 1
                return
            label = child[0]
            if rest.startswith(label):
                node, rest = child, rest[len(label):]
                continue
            n, most = 1, min(len(label), len(rest))
            while n < most and label[n] == rest[n]:
                n += 1
            node[2][rest[0]] = node = [label[:n], None, {label[n]: child}]
            child[0] = label[n:]
            rest = rest[n:]

    def items(self) -> Iterator[tuple[bytes, int, int]]:
        stack = [(b"", self.root)]
        while stack:
            prefix, (label, terminal, children) = stack.pop()
            whole = prefix + label
            if terminal is not None:
                yield whole, terminal[0], terminal[1]
            stack.extend((whole, c) for c in children.values())


def _frame(trie: Trie, least: int = 1) -> pd.DataFrame:
    rows = [x for x in trie.items() if x[1] >= least]
    return pd.DataFrame({"key": [x[0] for x in rows], "copies": [x[1] for x in rows], "keep_id": [x[2] for x in rows]}).astype({"copies": "int64", "keep_id": "int64"})


def _map_tries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    trie = Trie()
    for pdf in batches:
        for key, i in zip(pdf["key"], pdf["id"]):
            trie.add(bytes(key), 1, i)
            if trie.size >= TRIE_KEYS:
                yield _frame(trie)
                trie = Trie()
    yield _frame(trie)


def _bucket_tries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows arrive sorted by bucket; each bucket has a trie of its own."""
    trie, now, done = Trie(), None, []
    for pdf in batches:
        for bucket, key, copies, keep in zip(pdf["bucket"], pdf["key"], pdf["copies"], pdf["keep_id"]):
            bucket = bytes(bucket)
            if bucket != now:
                if trie.size:
                    done.append(_frame(trie))
                trie, now = Trie(), bucket
            trie.add(bytes(key), copies, keep)
        if done:
            yield pd.concat(done)
            done = []
    yield _frame(trie) if trie.size else pd.DataFrame({"key": [], "copies": pd.Series([], dtype="int64"), "keep_id": pd.Series([], dtype="int64")})


def bucketed(partial: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``partial`` with its bucket: the shortest prefix of the key, of FIRST_BYTES times a power of two, with no more than ``bucket_rows`` partial records, or the whole key.

    Of each level only the oversized prefixes are kept, at most one for ``bucket_rows`` records; rows get their level by
    joins with them, broadcasts where they were counted and are few.
    """
    levels, depth, rest = [], FIRST_BYTES, partial
    while True:
        prefix = F.substring("key", 1, depth)
        over = cut(rest.where(F.octet_length("key") > depth).groupBy(prefix.alias(f"p{depth}")).count().where(F.col("count") > bucket_rows).select(f"p{depth}", F.lit(True).alias(f"over{depth}")))
        n = over.count()
        if not n:
            break
        levels.append((depth, F.broadcast(over) if n <= SMALL_PREFIXES else over))
        rest = partial.withColumn(f"p{depth}", prefix).join(levels[-1][1], f"p{depth}", "left_semi").drop(f"p{depth}")
        depth *= 2
    out, bucket = partial, F.substring("key", 1, depth)
    for d, over in levels:
        out = out.withColumn(f"p{d}", F.substring("key", 1, d)).join(over, f"p{d}", "left")
    for d, _ in reversed(levels):
        bucket = F.when(F.col(f"over{d}"), bucket).otherwise(F.substring("key", 1, d))
    return out.select(*partial.columns, bucket.alias("bucket"))


def canonical_records(records: DataFrame, id_col: str, src_col: str, tgt_col: str) -> DataFrame:
    return records.select(F.col(id_col).cast("long").alias("id"), F.explode(canonical_keys(F.col(src_col), F.col(tgt_col))).alias("key")).where("id IS NOT NULL")


def copy_groups(records: DataFrame, id_col: str = "tm_id", src_col: str = "srctexts", tgt_col: str = "tgttexts", bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """(key, copies, keep_id): one row per distinct record; and an upper bound of the number of records."""
    schema = "key binary, copies long, keep_id long"
    partial = cut(canonical_records(records, id_col, src_col, tgt_col).mapInPandas(_map_tries, schema))
    merged = cut(bucketed(partial, bucket_rows).repartition("bucket").sortWithinPartitions("bucket").mapInPandas(_bucket_tries, schema))
    rows = merged.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    return merged, rows


def found_copies(records: DataFrame, id_col: str = "tm_id", src_col: str = "srctexts", tgt_col: str = "tgttexts", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(keep_id, copy_id): every record of a group but its first, with the first. Of records with equal ids, one is the first."""
    groups, rows = copy_groups(records, id_col, src_col, tgt_col, bucket_rows)
    # 16 bytes stand for the canonical ones, so that no text is shuffled
    digest = F.unhex(F.md5("key")).alias("digest")
    pairs = hot_key_join(canonical_records(records, id_col, src_col, tgt_col).select("id", digest), groups.where("copies > 1").select(digest, "copies", "keep_id"), ["digest"], "copies", rows)
    return pairs.where("id <> keep_id").select("keep_id", F.col("id").alias("copy_id"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found_copies(table(spark, sf_dir, "tm_fileparser"))


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(keep_id, copies): one row per distinct record with the number of its copies."""
    return copy_groups(table(spark, sf_dir, "tm_fileparser"))[0].select("keep_id", "copies")


_SIDE = r"regexp_replace(regexp_replace(regexp_replace(translate(replace(lower(regexp_replace({c}, '[\s\p{{Z}}\p{{C}}]+', ' ', 'g')), 'ß', 'ss'), 'ς', 'σ'), '(\p{{Nd}})([\p{{P}}\p{{S}}])(\p{{Nd}})', '\1' || chr(57344) || '\2' || chr(57345) || '\3', 'g'), '(\p{{Nd}})([\p{{P}}\p{{S}}])(\p{{Nd}})', '\1' || chr(57344) || '\2' || chr(57345) || '\3', 'g'), '(' || chr(57344) || '[^' || chr(57345) || ']' || chr(57345) || ')|[\p{{P}}\p{{S}} ]', '\1', 'g')"
_KEYED = f"""sides AS (SELECT tm_id, {_SIDE.format(c="srctexts")} AS a, {_SIDE.format(c="tgttexts")} AS b FROM tm_fileparser WHERE srctexts IS NOT NULL AND tgttexts IS NOT NULL),
keyed AS (SELECT tm_id, least(a, b) || chr(10) || greatest(a, b) AS k FROM sides WHERE regexp_matches(a, '[\\p{{L}}\\p{{N}}]') AND regexp_matches(b, '[\\p{{L}}\\p{{N}}]')),
grouped AS (SELECT k, min(tm_id) AS keep_id, count(*) AS copies FROM keyed GROUP BY k)"""
QUERIES = {"p4_found": p4_found, "p4_groups": p4_groups}
SQL = {
    "p4_found": f"WITH {_KEYED} SELECT keep_id, tm_id AS copy_id FROM keyed JOIN grouped USING (k) WHERE tm_id <> keep_id",
    "p4_groups": f"WITH {_KEYED} SELECT keep_id, copies FROM grouped",
}
