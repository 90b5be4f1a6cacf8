"""Problem 8: evaluation passages inside the corpus.

Prefix-filtered set join of word shingles, whatever the number of items:

1. Words are letters-or-digits runs, lower case. One pass over the corpus joins the shingles of five words of all documents
   with those of all items; the hits (document, place, shingle) are written. Their document frequencies order the shingles.
2. A run of half an item, h words, with c changed ones still holds one of any c + 1 shingles that don't overlap. So of every
   half-item window the c + 1 rarest such shingles are its necessary prefix, where c is an eighth of h (``CHANGED_IN``), but
   never more than the h // 5 - 1 that leave one shingle whole.
3. The hits are joined with the prefix tokens: (document, item, diagonal). Length and positional bounds: the diagonal must
   leave room for half the item on both sides of the hit. Only the documents of such a candidate are read again; of each the
   item-sized window around its diagonal is verified word by word. A run is extended over single changed words; it counts if
   the words that match are half the item's or more and at most one in ``CHANGED_IN`` of its words is changed.

An item of under ten words has a half of under five: its shingles are as long as that half, and must be found unchanged.
As a passage has to hold the item's own words, a translation never counts, and the passage is in the item's language.

Joins are broadcasts only if the other side was counted and is small (``SMALL_ROWS``, ``SMALL_WORDS``); else they are
shuffles, of which adaptive execution splits the skewed parts. Items with the same words are one until the end.

Null and empty texts and items hold nothing; rows with a null id are left out. Rows with one id are one document, or one
item. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corploom.session import cut, spread, table

SHINGLE = 5
#: A run may hold one changed word in so many.
CHANGED_IN = 8
LEAST_SHARE = 0.5
#: A side of at most so many rows (and words in all) is broadcast.
SMALL_ROWS, SMALL_WORDS = 500_000, 2_000_000
_HIDDEN = "­​-‏⁠﻿"
#: Lower-case Latin letters with marks, as letter and mark apart, and composed: from Unicode's canonical decomposition.
_APART = [(d, c) for c in map(chr, range(0xE0, 0x180)) if c.islower() and (d := unicodedata.normalize("NFD", c)) != c]


def words_of(text: Column) -> Column:
    """Words of a text; marks are composed with their letters and hidden characters dropped where there are any."""
    low = F.lower(text)
    plain = F.regexp_replace(low, f"[{_HIDDEN}]", "")
    for apart, composed in _APART:
        plain = F.replace(plain, F.lit(apart), F.lit(composed))
    return F.regexp_extract_all(F.when(low.rlike(rf"[{_HIDDEN}]|\p{{M}}"), plain).otherwise(low), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))


def codes_of(words: Column, size: int = SHINGLE) -> Column:
    """The code of the shingle at every place of an array of words; each word is hashed once."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    # an array of one, so that the lambda binds the hashes
    code = lambda h: F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - size, F.lit(0))), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(size)]))
    return F.when(F.size(words) >= size, F.transform(F.array(hashes), code)[0]).otherwise(F.array().cast("array<long>"))


def half_of(n: int) -> int:
    """Words that are half of ``n`` or more."""
    return -int(-n * LEAST_SHARE // 1)


def prefix_places(df: list[int]) -> list[int]:
    """Places of the necessary prefix tokens of an item, from the document frequencies of its shingles of five words."""
    n = len(df) + SHINGLE - 1
    half = half_of(n)
    picks = max(0, min(half // CHANGED_IN, half // SHINGLE - 1)) + 1
    keep: set[int] = set()
    # the rarest: of shingles as rare as each other those of the earlier place, so that windows agree
    order = np.argsort(np.argsort(np.array(df), kind="stable")).astype(float) ** 2
    span = half - SHINGLE + 1
    for a in range(n - half + 1):
        # a token that an earlier window needs is joined anyway
        cost = [0.0 if p in keep else order[p] for p in range(a, a + span)]
        # the cheapest set of shingles that don't overlap: best[k][i] among the first i places
        best = np.full((picks + 1, span + 1), np.inf)
        best[0] = 0.0
        for k in range(1, picks + 1):
            for i in range(1, span + 1):
                best[k, i] = min(best[k, i - 1], best[k - 1, max(0, i - SHINGLE)] + cost[i - 1] if k == 1 or i > SHINGLE else np.inf)
        k, i = picks, span
        while k:
            if best[k, i] == best[k, i - 1]:
                i -= 1
            else:
                keep.add(a + i - 1)
                k, i = k - 1, max(0, i - SHINGLE)
    return sorted(keep)


#: Ways to pass over a changed word: (words of the item, words of the document); a written word may be two or three of letters.
_SKIPS = [(1, 1), (2, 2), (1, 2), (2, 1), (1, 0), (0, 1), (3, 1), (1, 3)]


def blocks(item: list[str], doc: list[str], i: int, d: int, step: int) -> list[tuple[int, int]]:
    """(matched, changed before them) of the run from item[i] == doc[d], block by block, in one direction."""
    n, m, out, now, changed = len(item), len(doc), [], 1, 0
    while True:
        a, b = i + step, d + step
        if 0 <= a < n and 0 <= b < m and item[a] == doc[b]:
            i, d, now = a, b, now + 1
            continue
        out.append((now, changed))
        for x, y in _SKIPS:
            a, b = i + step * (x + 1), d + step * (y + 1)
            if 0 <= a < n and 0 <= b < m and item[a] == doc[b] and (not (0 <= a + step < n) or (0 <= b + step < m and item[a + step] == doc[b + step])):
                i, d, now, changed = a, b, 1, max(x, y)
                break
        else:
            return out


def longest_run(item: list[str], doc: list[str], i: int, d: int) -> int:
    """The most words of the item that match in one run through item[i] == doc[d] with at most one changed word in CHANGED_IN."""
    left, right = blocks(item, doc, i, d, -1), blocks(item, doc, i, d, 1)
    best, ml, cl = 0, -1, 0
    for more, changed in left:
        ml, cl = ml + more, cl + changed
        mr, cr = 0, 0
        for more_r, changed_r in right:
            mr, cr = mr + more_r, cr + changed_r
            if (cl + cr) * CHANGED_IN <= ml + mr + cl + cr:
                best = max(best, ml + mr)
    return best


def holds(item: list[str], window: list[str]) -> bool:
    """Whether a window holds half of the item or more in one run."""
    n, size = len(item), min(SHINGLE, half_of(len(item)))
    where: dict[tuple, list[int]] = {}
    for p in range(n - size + 1):
        where.setdefault(tuple(item[p : p + size]), []).append(p)
    done: set[tuple[int, int]] = set()
    for d in range(len(window) - size + 1):
        for p in where.get(tuple(window[d : d + size]), ()):
            # the shingle before on the same diagonal belongs to the same run
            if (p - 1, d - 1) not in done and longest_run(item, window, p, d) >= LEAST_SHARE * n:
                return True
            done.add((p, d))
    return False


def small(df: DataFrame, words: str | None = None) -> DataFrame:
    """A written frame, marked for broadcast if it was counted and is small."""
    rows, n = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(words)) if words else F.lit(0), F.lit(0))).first()
    return F.broadcast(df) if rows <= SMALL_ROWS and n <= SMALL_WORDS else df


def union(parts: Iterable[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def find_leaks(docs: DataFrame, evals: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id): documents that hold at least half of an item in one run."""
    named = evals.select(F.col(item_id).cast("long").alias("item_id"), words_of(F.col(item_text)).alias("item")).where("item_id IS NOT NULL AND size(item) > 0")
    named = cut(named.withColumn("class", F.md5(F.concat_ws(" ", "item"))))
    half = F.ceil(F.size("item") * LEAST_SHARE).cast("int")
    items = cut(named.groupBy("class").agg(F.first("item").alias("item")).withColumn("k", F.least(F.lit(SHINGLE), half)))
    # shingles of under five words are made only if some item is that short
    sizes = [r[0] for r in items.select("k").distinct().orderBy("k").collect()] or [SHINGLE]
    grams = union(items.where(F.col("k") == k).select("class", "k", F.size("item").alias("n"), F.posexplode(codes_of(F.col("item"), k)).alias("p", "code")) for k in sizes)
    known = small(cut(grams.select("k", "code").distinct()))
    corpus = docs.select(F.col(doc_id).cast("long").alias("doc_id"), words_of(F.col(text)).alias("words")).where("doc_id IS NOT NULL")
    shingles = union(corpus.select("doc_id", F.size("words").alias("m"), F.lit(k).alias("k"), F.posexplode(codes_of(F.col("words"), k)).alias("d", "code")) for k in sizes)
    hits = cut(shingles.join(known, ["k", "code"], "left_semi"))

    # document frequencies, then each item's prefix
    df = hits.groupBy("k", "code").agg(F.countDistinct("doc_id").alias("df"))
    ranked = grams.join(df, ["k", "code"]).select("class", "k", "n", "p", "code", "df")
    every = grams.join(df, ["k", "code"], "left").groupBy("class", "k").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", F.coalesce("df", F.lit(0)).alias("df")))), lambda x: x["df"]).alias("df"))

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            # all shingles of a short item: each may be the only one of a half
            rows = [(c, p) for c, k, x in zip(pdf["class"], pdf["k"], pdf["df"]) for p in (prefix_places([int(v) for v in x]) if k == SHINGLE else range(len(x)))]
            yield pd.DataFrame({"class": pd.Series([r[0] for r in rows], dtype="object"), "p": pd.Series([r[1] for r in rows], dtype="int32")})

    prefix = small(cut(ranked.join(every.mapInPandas(choose, "class string, p int"), ["class", "p"])).select("class", "k", "n", "p", "code"))

    # candidates by diagonal, with room for half the item
    room = F.least(F.col("n") - F.col("p"), F.col("m") - F.col("d")) + F.least("p", "d")
    near = hits.join(prefix, ["k", "code"]).where(room >= F.col("n") * LEAST_SHARE)
    near = small(cut(near.select("doc_id", "class", (F.col("d") - F.col("p")).alias("o"), "n").distinct()))
    slack = F.floor(F.col("n") / CHANGED_IN).cast("int") + 2
    begin = F.greatest(F.col("o") - slack, F.lit(0))
    windows = corpus.join(near, "doc_id").select("doc_id", "class", F.slice("words", begin + 1, F.col("o") + F.col("n") + slack - begin).alias("window"))
    pairs = windows.join(small(items, "item").select("class", "item"), "class")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = [holds(i.tolist(), w.tolist()) for i, w in zip(pdf["item"], pdf["window"])]
            yield pdf.loc[ok, ["doc_id", "class"]]

    found = pairs.select("doc_id", "class", "item", "window").mapInPandas(verify, "doc_id long, class string").distinct()
    return found.join(small(named.select("item_id", "class")), "class").select("doc_id", "item_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id"), table(spark, sf_dir, "eval_items"))


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, docs): how many documents hold each item; items that leaked nowhere have 0."""
    n = p8_found(spark, sf_dir).groupBy("item_id").agg(F.count(F.lit(1)).alias("docs"))
    return table(spark, sf_dir, "eval_items").select("item_id").join(n, "item_id", "left").select("item_id", F.coalesce("docs", F.lit(0)).alias("docs"))


QUERIES = {"p8_found": p8_found, "p8_items": p8_items}
SQL: dict[str, str] = {}
