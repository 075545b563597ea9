"""Datasets behind the match reports, for all matches at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pitchlake import fixed_values as fv
from pitchlake.functions.intervals import match_minute
from pitchlake.operators.checks import all_of, row_rules, rows_per_match
from pitchlake.operators.ordered import running_totals

# event_index numbers the events of a match from 1, so this bounds a block.
TIMELINE_BLOCK = 10_000


def _text(value: Column, decimals: int, suffix: str) -> Column:
    # Through decimal: the digits shown are those of the decimal value, rounded half up.
    shown = F.round(F.round(value, 6).cast("decimal(24,6)"), decimals)
    return F.concat(shown.cast(f"decimal(24,{decimals})").cast("string"), F.lit(suffix))


def match_summary(fact_gold_team: DataFrame) -> DataFrame:
    """Six metrics for both teams of a match, in alphabetical team order.

    A match with one team has no second values. One with more than two shows its first
    and its last team; ``teams`` tells, and ``input_violations`` lists all such matches.
    """
    columns = [column for _, column, _, _ in fv.SUMMARY_METRICS]
    team = F.struct("team_name", *[F.col(c).cast("double").alias(c) for c in columns])
    pairs = fact_gold_team.groupBy("match_id").agg(
        F.min(team).alias("a"), F.max(team).alias("last"), F.count("*").alias("teams")
    ).withColumn("b", F.when(F.col("teams") > 1, F.col("last")))
    lines = F.array(*[
        F.struct(
            F.lit(order).alias("metric_order"), F.lit(label).alias("metric"),
            F.col(f"a.{column}").alias("value_a"), F.col(f"b.{column}").alias("value_b"),
            _text(F.col(f"a.{column}"), decimals, suffix).alias("text_a"),
            _text(F.col(f"b.{column}"), decimals, suffix).alias("text_b"),
        )
        for order, (label, column, decimals, suffix) in enumerate(fv.SUMMARY_METRICS, start=1)
    ])
    return pairs.select(
        "match_id", F.col("a.team_name").alias("team_a"), F.col("b.team_name").alias("team_b"),
        F.col("teams").cast("int").alias("teams"), F.inline(lines),
    )


def _is_goal() -> Column:
    return F.col("outcome").eqNullSafe(fv.GOAL)


def _marker(xg: Column, size: tuple[float, float]) -> Column:
    factor, offset = size
    return xg * factor + offset


def shot_map_points(silver: DataFrame) -> DataFrame:
    xg = F.coalesce("shot_xg", F.lit(fv.SHOT_MAP_DEFAULT_XG))
    return silver.where(F.col("is_shot") & F.col("team_name").isNotNull()).select(
        "match_id", "event_id", "team_name", "player_name", "start_x", "start_y", "shot_xg",
        _is_goal().alias("is_goal"), _marker(xg, fv.SHOT_MAP_MARKER).alias("marker_size"),
    )


def shot_map_totals(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("is_shot") & F.col("team_name").isNotNull()).groupBy("match_id", "team_name").agg(
        F.count("*").alias("shots"), F.count_if(_is_goal()).alias("goals"),
        F.sum(F.coalesce("shot_xg", F.lit(0.0))).alias("total_xg"),
    )


def xg_timeline(silver: DataFrame) -> DataFrame:
    """Cumulative xG per team along the match, starting from a point at zero.

    Shots of a match are summed in blocks of ``event_index``, so that even a
    match of any length is spread over tasks.
    """
    shots = silver.where(F.col("is_shot") & F.col("team_name").isNotNull()).select(
        "match_id", "team_name", "event_index", "event_id",
        match_minute(F.col("minute"), F.col("second")).alias("match_minute"),
        F.coalesce("shot_xg", F.lit(0.0)).alias("shot_xg"), _is_goal().alias("is_goal"),
    )
    summed = running_totals(
        shots, ["match_id", "team_name"], ["event_index", "event_id"],
        {"cumulative_xg": F.col("shot_xg"), "nth": F.lit(1)},
        block=F.floor(F.col("event_index") / TIMELINE_BLOCK),
    )
    goal, miss = fv.TIMELINE_GOAL_MARKER, fv.TIMELINE_MISS_MARKER
    marker = F.when(F.col("is_goal"), _marker(F.col("shot_xg"), goal)).otherwise(_marker(F.col("shot_xg"), miss))
    columns = ["event_index", "match_minute", "shot_xg", "cumulative_xg", "is_goal", "marker_size"]
    zero = F.lit(0.0)
    start = F.struct(*[
        value.alias(name)
        for name, value in zip(columns, [F.lit(0), zero, zero, zero, F.lit(False), F.lit(None).cast("double")])
    ])
    point = F.struct(*columns)
    return summed.withColumn("marker_size", marker).select(
        "match_id", "team_name",
        F.inline(F.when(F.col("nth") == 1, F.array(start, point)).otherwise(F.array(point))),
    )


def _display_order(label: Column) -> Column:
    entries = [part for n, name in enumerate(fv.INTERVAL_ORDER) for part in (F.lit(name), F.lit(n))]
    return F.try_element_at(F.create_map(*entries), label)


def xt_momentum(fact_gold_intervals: DataFrame) -> DataFrame:
    """Positive threat per interval in display order; the second team is negated.

    Teams are ranked by name within their match, however many there are; a window over the
    some 40 rows of a match needs one scan and no join.
    """
    rank = F.dense_rank().over(Window.partitionBy("match_id").orderBy("team_name"))
    ranked = fact_gold_intervals.where(F.col("team_name").isNotNull()).select(
        "match_id", "team_name", rank.alias("team_rank"), "interval_label",
        _display_order(F.col("interval_label")).alias("display_order"), "positive_xt",
    )
    return ranked.select(
        "*", F.when(F.col("team_rank") == 2, F.lit(0.0) - F.col("positive_xt")).otherwise(F.col("positive_xt"))
        .alias("shown_xt"),
    )


def input_violations(
    fact_gold_team: DataFrame, fact_gold_intervals: DataFrame, silver: DataFrame
) -> DataFrame:
    """What makes a match unfit for reports."""
    per_team = fact_gold_intervals.groupBy("match_id", "team_id").agg(
        F.count_if(_display_order(F.col("interval_label")).isNotNull()).alias("known")
    )
    shots = silver.groupBy("match_id").agg(F.count_if("is_shot").alias("shots"))
    return all_of(
        rows_per_match(fact_gold_team, 2, "not_two_teams"),
        row_rules(fact_gold_intervals, {
            "unknown_interval_label": _display_order(F.col("interval_label")).isNull(),
            "missing_positive_xt": F.col("positive_xt").isNull(),
        }),
        row_rules(per_team, {"missing_intervals": F.col("known") < len(fv.INTERVAL_ORDER)}),
        row_rules(shots, {"no_shots": F.col("shots") == 0}),
    )


# Column-pruned, match-filtered reads for a single report.
REPORT_COLUMNS = {
    "gold_team": [
        "match_id", "team_name", "goals", "shots", "xg", "pass_completion_pct", "progressive_passes", "carries",
    ],
    "gold_intervals": ["match_id", "team_name", "interval_label", "positive_xt"],
    "silver": [
        "match_id", "event_index", "minute", "second", "team_name", "start_x", "start_y", "outcome",
        "shot_xg", "is_shot",
    ],
}


def report_input(dataset: DataFrame, kind: str, match_id: int) -> DataFrame:
    return dataset.where(F.col("match_id") == match_id).select(*REPORT_COLUMNS[kind])
