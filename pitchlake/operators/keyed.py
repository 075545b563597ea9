"""Set logic on keys: replace, upsert, differences, selections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pitchlake.session import cut_lineage

# Sets of up to this many keys (some 50 MB in memory) are sent to all executors.
BROADCAST_KEYS = 1_000_000


def settled(keys: DataFrame) -> DataFrame:
    """A set of keys, computed once, counted, and marked for broadcast if it is small.

    Without the count Spark would plan a shuffle of the large side, whatever the
    set turns out to hold. Larger sets are joined by that shuffle.
    """
    stored = cut_lineage(keys.distinct())
    return F.broadcast(stored) if stored.count() <= BROADCAST_KEYS else stored


def without(df: DataFrame, excluded: DataFrame, keys: list[str], settle: bool = False) -> DataFrame:
    """Rows whose key is not in ``excluded``. ``settle`` is for a large ``df`` and (mostly) few keys."""
    chosen = excluded.select(*keys)
    return df.join(settled(chosen) if settle else chosen.distinct(), keys, "left_anti")


def only(df: DataFrame, selected: DataFrame, keys: list[str], settle: bool = False) -> DataFrame:
    """Rows whose key is in ``selected``."""
    chosen = selected.select(*keys)
    return df.join(settled(chosen) if settle else chosen.distinct(), keys, "left_semi")


def replace_by_key(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of ``incoming``, and those of ``current`` whose key is not in it."""
    return without(current, incoming, keys, settle=True).unionByName(incoming.select(*current.columns))


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Insert new keys and overwrite all other columns of known ones.

    ``incoming`` has one row per key, which the grain check ensures.
    """
    return without(current, incoming, keys).unionByName(incoming.select(*current.columns))


def key_counts(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key on both sides (``n_left``, ``n_right``), in one pass over each."""
    def side(df: DataFrame, is_left: int) -> DataFrame:
        return df.select(*keys, F.lit(is_left).alias("l"), F.lit(1 - is_left).alias("r"))

    return side(left, 1).unionByName(side(right, 0)).groupBy(*keys).agg(
        F.sum("l").alias("n_left"), F.sum("r").alias("n_right")
    )
