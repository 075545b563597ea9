"""Profiles of Bronze and Silver, and leaderboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pitchlake import fixed_values as fv


def bronze_profile(bronze: DataFrame) -> DataFrame:
    """Rows per event type (NULL left out) and per team (NULL kept), in one scan."""
    facets = F.array(
        F.struct(F.lit("event_type").alias("facet"), F.col("event_type_name").alias("name")),
        F.struct(F.lit("team").alias("facet"), F.col("team_name").alias("name")),
    )
    return (
        bronze.select(F.inline(facets)).groupBy("facet", "name").agg(F.count("*").alias("n"))
        .where((F.col("facet") == "team") | F.col("name").isNotNull())
    )


def bronze_sample(bronze: DataFrame, rows: int = 20) -> DataFrame:
    """The first events, as a look at the data."""
    return bronze.select(
        "match_id", "event_index", "minute", "second", "team_name", "player_name", "event_type_name",
        "location_x_raw", "location_y_raw",
    ).orderBy("match_id", "event_index").limit(rows)


def top_moves(silver: DataFrame, rows: int = 20) -> DataFrame:
    """Moves that added most threat."""
    return silver.where("is_successful_move").select(
        "match_id", "event_index", "minute", "team_name", "player_name", "event_type",
        "start_x", "start_y", "end_x", "end_y", "xt_start", "xt_end", "xt_added",
    ).orderBy(F.col("xt_added").desc_nulls_last(), "match_id", "event_index").limit(rows)


def player_xt_leaders(silver: DataFrame, rows: int = 15) -> DataFrame:
    """Players by threat added."""
    summed = silver.where(F.col("is_successful_move") & F.col("player_name").isNotNull()).groupBy(
        "player_name"
    ).agg(F.sum("xt_added").alias("xt_added"))
    return summed.orderBy(F.col("xt_added").desc_nulls_last(), "player_name").limit(rows)


def player_progressive_leaders(silver: DataFrame, rows: int = 10) -> DataFrame:
    counted = silver.where(F.col("is_progressive_pass") & F.col("player_name").isNotNull()).groupBy(
        "player_name"
    ).agg(F.count("*").alias("progressive_passes"))
    return counted.orderBy(F.col("progressive_passes").desc(), "player_name").limit(rows)


def team_progressive(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("is_progressive_pass") & F.col("team_name").isNotNull()).groupBy(
        "team_name"
    ).agg(F.count("*").alias("progressive_passes"))


def shot_x_profile(silver: DataFrame) -> DataFrame:
    """Where shots are taken, per team and period."""
    return silver.where(F.col("is_shot") & F.col("team_name").isNotNull()).groupBy("team_name", "period").agg(
        F.count("event_id").alias("shots"), F.avg("start_x").alias("avg_shot_x"),
        F.min("start_x").alias("min_shot_x"), F.max("start_x").alias("max_shot_x"),
    )


def orientation(silver: DataFrame) -> DataFrame:
    """Median shot position per match, team and period; low ones may be mirrored.

    Shots are first counted per position. Positions come in tenths of a
    provider unit, so a median is taken over at most 1,201 of them.
    """
    positions = silver.where(F.col("is_shot") & F.col("team_name").isNotNull()).groupBy(
        "match_id", "team_name", "period", "start_x"
    ).agg(F.count("*").alias("n"))
    return positions.groupBy("match_id", "team_name", "period").agg(
        F.expr("percentile(start_x, 0.5, n)").alias("median_start_x")
    ).select("*", (F.col("median_start_x") < fv.ORIENTATION_MIN_X).alias("suspicious"))
