"""Gold facts: team x match, and team x match x five-minute interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pitchlake import fixed_values as fv
from pitchlake.functions import intervals

TEAM_KEYS = ["match_id", "team_id"]
INTERVAL_KEYS = ["match_id", "team_id", "period", "interval_start", "is_stoppage_time"]

# Text attributes of a team in a match. max() over text would make Spark sort
# all events before the map-side combine, so they are grouped on first and
# reduced to their maximum on the few remaining rows.
TEXTS = ["team_name", "file_hash", "xt_model_version"]


COUNTED = ["shots", "goals", "xg", "attempted_passes", "completed_passes", "progressive_passes", "carries"]
COUNTS = [f"{how} AS {name}" for name, how in zip(COUNTED, [
    "count_if(is_shot)", f"count_if(is_shot AND outcome = '{fv.GOAL}')", "sum(coalesce(shot_xg, 0D)) FILTER (WHERE is_shot)",
    "count_if(is_pass)", "count_if(is_completed_pass)", "count_if(is_progressive_pass)", "count_if(is_carry)"])]


def fact_gold_team(silver: DataFrame) -> DataFrame:
    """One row per team and match. All periods count; xg is NULL without shots."""
    texts = ["team_name", "file_hash"]
    return teams_from(
        silver.where("team_id IS NOT NULL").groupBy(*TEAM_KEYS, *texts)
        .agg(*[F.expr(e) for e in [*COUNTS, "max(source_version) AS source_version"]]))


def teams_from(parts: DataFrame) -> DataFrame:
    """The team fact from counted parts of each team and match."""
    texts = ["team_name", "file_hash"]
    counted = parts.groupBy(*TEAM_KEYS).agg(
        *[F.expr(f"sum({name}) AS {name}") for name in COUNTED],
        *[F.expr(f"max({name}) AS {name}") for name in ["source_version", *texts]],
    )
    return counted.selectExpr(
        *TEAM_KEYS, "team_name", *COUNTED,
        "CASE WHEN attempted_passes > 0 THEN 100D * completed_passes / attempted_passes END AS pass_completion_pct",
        "source_version", "file_hash", f"'{fv.METRIC_VERSION}' AS metric_version",
    )


# Threat gained, lost and net over successful moves; zero if there were none.
THREAT = [
    "coalesce(sum(xt_added) FILTER (WHERE is_successful_move AND xt_added > 0), 0D) AS positive_xt",
    "coalesce(sum(xt_added) FILTER (WHERE is_successful_move AND xt_added < 0), 0D) AS negative_xt",
    "coalesce(sum(xt_added) FILTER (WHERE is_successful_move), 0D) AS net_xt",
]


def team_match_xt(silver: DataFrame) -> DataFrame:
    """Threat created, given away and net, per team and match (all periods)."""
    return silver.where("team_id IS NOT NULL").groupBy(*TEAM_KEYS).agg(*[F.expr(e) for e in THREAT])


def assign_intervals(silver: DataFrame) -> DataFrame:
    """Regular-time events with their five-minute interval."""
    period, minute = F.col("period"), F.col("minute")
    timed = silver.where(F.col("team_id").isNotNull() & period.isin(1, 2)).select(
        "*", intervals.period_minute(period, minute).alias("period_minute"),
        intervals.is_stoppage(period, minute).alias("is_stoppage_time"),
    )
    return timed.withColumn(
        "interval_start", intervals.interval_start(F.col("period_minute"), F.col("is_stoppage_time"))
    )


MEASURES = ["positive_xt", "negative_xt", "net_xt", "successful_moves", "shots", "xg"]


def interval_aggregates(silver: DataFrame, *grouped_on: str) -> DataFrame:
    """Measures per interval that has events, optionally split by further columns."""
    return assign_intervals(silver).groupBy(*INTERVAL_KEYS, *grouped_on).agg(
        *[F.expr(e) for e in THREAT],
        F.expr("count_if(is_successful_move) AS successful_moves"),
        F.expr("count_if(is_shot) AS shots"),
        F.expr("coalesce(sum(coalesce(shot_xg, 0D)) FILTER (WHERE is_shot), 0D) AS xg"),
        F.expr("max(source_version) AS source_version"),
    )


def _slots() -> Column:
    """The 20 (period, interval) slots of a match as an array literal."""
    starts = F.sequence(F.lit(0), F.lit(fv.STOPPAGE_SLOT), F.lit(fv.INTERVAL_MINUTES))
    return F.flatten(F.array(*[
        F.transform(starts, lambda s: F.struct(
            F.lit(period).alias("period"), s.alias("interval_start"),
            (s == fv.STOPPAGE_SLOT).alias("is_stoppage_time"),
        ))
        for period in (1, 2)
    ]))


def _label() -> Column:
    return intervals.interval_label(F.col("period"), F.col("interval_start"), F.col("is_stoppage_time"))


def interval_spine(silver: DataFrame) -> DataFrame:
    """Every team of a match with all 20 slots, whether or not anything happened."""
    attributes = [*TEXTS, "source_version"]
    teams = (
        silver.where(F.col("team_id").isNotNull() & F.col("period").isin(1, 2))
        .groupBy(*TEAM_KEYS, *TEXTS).agg(F.max("source_version").alias("source_version"))
        .groupBy(*TEAM_KEYS).agg(*[F.max(name).alias(name) for name in attributes])
    )
    return teams.select(*TEAM_KEYS, *attributes, F.inline(_slots())).select(
        *TEAM_KEYS, "team_name", "period", "interval_start", "is_stoppage_time",
        _label().alias("interval_label"), "source_version", "file_hash", "xt_model_version",
        F.lit(fv.METRIC_VERSION).alias("metric_version"),
    )


def fact_gold_intervals(silver: DataFrame) -> DataFrame:
    """20 rows per team and match, zero where nothing happened.

    Events are scanned once and reduced to a few rows per slot. These are
    moved by team, summed to at most 20 slots, kept in a small map, and laid
    out over the full spine; no join and no second shuffle by slot is needed.
    """
    return intervals_from(interval_aggregates(silver, *TEXTS))


def intervals_from(parts: DataFrame) -> DataFrame:
    """The interval fact from measured parts of each slot that has events."""
    attributes = [*TEXTS, "source_version"]
    slot = F.struct("period", "interval_start", "is_stoppage_time")
    on_spine = F.array_contains(_slots(), slot)
    slots = (
        parts.repartition(*TEAM_KEYS)
        .groupBy(*INTERVAL_KEYS).agg(
            *[F.sum(name).alias(name) for name in MEASURES], *[F.max(name).alias(name) for name in attributes]
        )
    )
    teams = slots.groupBy(*TEAM_KEYS).agg(
        *[F.max(name).alias(name) for name in attributes],
        F.map_from_entries(F.collect_list(F.when(on_spine, F.struct(slot, F.struct(*MEASURES)))))
        .alias("by_slot"),
    )
    dense = teams.select(*TEAM_KEYS, *attributes, "by_slot", F.explode(_slots()).alias("slot")).select(
        *TEAM_KEYS, *attributes, "slot.*", F.try_element_at("by_slot", "slot").alias("m")
    )

    def measure(name: str) -> Column:
        zero = F.lit(0) if name in ("successful_moves", "shots") else F.lit(0.0)
        return F.coalesce(f"m.{name}", zero).alias(name)

    return dense.select(
        *TEAM_KEYS, "team_name", "period", "interval_start", "is_stoppage_time",
        _label().alias("interval_label"), *[measure(name) for name in MEASURES],
        "source_version", "file_hash", "xt_model_version",
        F.lit(fv.METRIC_VERSION).alias("metric_version"),
    )
