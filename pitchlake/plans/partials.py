"""Gold as mergeable state: sums by match, team and slot, from which both facts are put together.

A commit adds the sums of its matches, at most some twenty-five rows per team and match; they can be added up in any order and
grouping. Reading merges the current ones. So events are scanned once, when they arrive, for both facts, and facts of any set of
matches, or of any earlier state, never need them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pitchlake.functions import intervals
from pitchlake.plans import gold

#: A part's key. Events outside the two halves have no slot; they count for the team fact only.
KEYS = [*gold.INTERVAL_KEYS, *gold.TEXTS]
SUMS = [*gold.COUNTED, "positive_xt", "negative_xt", "net_xt", "successful_moves"]


def partial_facts(silver: DataFrame, *also: str) -> DataFrame:
    """Parts of the given events; added up in the map tasks, whatever the size of a match. ``also`` splits them further."""
    period, minute = F.col("period"), F.col("minute")
    halves, stoppage = period.isin(1, 2), intervals.is_stoppage(period, minute)
    start = intervals.interval_start(intervals.period_minute(period, minute), stoppage)
    timed = silver.where("team_id IS NOT NULL").withColumns({
        "period": F.when(halves, period), "interval_start": F.when(halves, start), "is_stoppage_time": F.when(halves, stoppage)})
    return timed.groupBy(*also, *KEYS).agg(*[F.expr(e) for e in [
        *gold.COUNTS, *gold.THREAT, "count_if(is_successful_move) AS successful_moves", "max(source_version) AS source_version"]])


def merged(parts: DataFrame) -> DataFrame:
    """One part per key."""
    return parts.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS], F.max("source_version").alias("source_version"))


def team_facts(parts: DataFrame) -> DataFrame:
    """``gold.fact_gold_team`` of the events behind the parts."""
    return gold.teams_from(parts)


def interval_facts(parts: DataFrame) -> DataFrame:
    """``gold.fact_gold_intervals`` of the events behind the parts."""
    return gold.intervals_from(parts.where("period IS NOT NULL").withColumn("xg", F.coalesce("xg", F.lit(0.0))))
