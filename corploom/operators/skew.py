"""A join that no hot key can overload."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: At most this many keys are treated as hot, so the broadcast side has a proven bound whatever the data.
MAX_HOT_KEYS = 10_000
#: A key with fewer rows than this is never hot.
LEAST_HOT_ROWS = 10_000


def hot_limit(total_rows: int, max_hot: int = MAX_HOT_KEYS, least: int = LEAST_HOT_ROWS) -> int:
    """Rows from which a key is hot. No more than ``max_hot`` keys can have ``total_rows / max_hot`` rows each."""
    return max(least, -(-total_rows // max_hot))


def hot_key_join(rows: DataFrame, groups: DataFrame, keys: list[str], count: str, total_rows: int, max_hot: int = MAX_HOT_KEYS, least: int = LEAST_HOT_ROWS) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` (one row per key, ``count`` = rows of that key in ``rows``).

    Keys with at least ``hot_limit`` rows are joined by a broadcast of at most ``max_hot`` group rows, so their rows stay
    where they are; all others are joined by a shuffle in which no key has more rows than the limit. Nothing is dropped:
    the two branches partition the groups. Null keys match nothing. Empty inputs give an empty result.
    """
    limit = hot_limit(total_rows, max_hot, least)
    if total_rows < limit:
        return rows.join(groups, keys)
    hot = groups.where(F.col(count) >= limit)
    cold = groups.where(F.col(count) < limit)
    return rows.join(F.broadcast(hot), keys).unionByName(rows.join(cold, keys))


def hash_sample(df: DataFrame, id_col: str, n: int) -> DataFrame:
    """About ``n`` rows, chosen by the hash of their id: the same rows every time, without sorting or collecting the rest.

    All rows if there are no more than ``n``. Rows with the same id are taken or left together.
    """
    total = df.count()
    if total <= n:
        return df
    slots = 1 << 30
    return df.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(slots)) < int(slots * n / total))
