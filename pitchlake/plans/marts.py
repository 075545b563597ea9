"""Marts over the team fact and the match dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

TEAM_MATCH_COLUMNS = [
    "match_id", "team_id", "team_name", "goals", "shots", "xg",
    "attempted_passes", "completed_passes", "progressive_passes", "carries",
]
MATCH_COLUMNS = [
    "match_date", "season_name", "home_team_id", "home_team_name", "away_team_id", "away_team_name",
]


def fact_team_match(fact_gold_team: DataFrame) -> DataFrame:
    return fact_gold_team.select(*TEAM_MATCH_COLUMNS)


def team_match_enriched(fact: DataFrame, dim_match: DataFrame) -> DataFrame:
    """Team fact with match attributes, venue and opponent.

    Two rows meet one row per match, so no key is hot. There is no broadcast
    hint: the dimension grows with the matches, and Spark broadcasts it while
    it is below its threshold.
    """
    at_home = F.coalesce(F.col("team_id") == F.col("home_team_id"), F.lit(False))
    return fact.join(dim_match.select("match_id", *MATCH_COLUMNS), "match_id").select(
        *fact.columns, *MATCH_COLUMNS,
        F.when(at_home, "Home").otherwise("Away").alias("venue"),
        F.when(at_home, F.col("away_team_name")).otherwise(F.col("home_team_name")).alias("opponent"),
    )


def _scope(enriched: DataFrame, team_name: str | None, season_name: str | None) -> DataFrame:
    if team_name is not None:
        enriched = enriched.where(F.col("team_name") == team_name)
    if season_name is not None:
        enriched = enriched.where(F.col("season_name") == season_name)
    return enriched


def team_season_summary(
    enriched: DataFrame, team_name: str | None = None, season_name: str | None = None
) -> DataFrame:
    """Season totals, for one team and season or for all of them."""
    return _scope(enriched, team_name, season_name).groupBy("team_name", "season_name").agg(
        F.count("*").alias("matches"), F.sum("goals").alias("goals"), F.sum("shots").alias("shots"),
        F.sum("xg").alias("xg"), F.sum("progressive_passes").alias("progressive_passes"),
    )


def match_by_match(
    enriched: DataFrame, team_name: str | None = None, season_name: str | None = None
) -> DataFrame:
    """One row per match in date order."""
    return _scope(enriched, team_name, season_name).select(
        "team_name", "season_name", "match_date", "opponent", "venue", "goals", "xg"
    ).orderBy(
        F.col("team_name").asc_nulls_last(), F.col("season_name").asc_nulls_last(),
        F.col("match_date").asc_nulls_last(),
    )


def team_home_away_summary(
    enriched: DataFrame, team_name: str | None = None, season_name: str | None = None
) -> DataFrame:
    """Totals and averages at home and away."""
    return _scope(enriched, team_name, season_name).groupBy("team_name", "season_name", "venue").agg(
        F.count("*").alias("matches"), F.sum("goals").alias("goals"), F.sum("xg").alias("xg"),
        F.avg("goals").alias("goals_per_match"), F.avg("xg").alias("xg_per_match"),
    ).orderBy(
        F.col("team_name").asc_nulls_last(), F.col("season_name").asc_nulls_last(),
        F.col("venue").asc_nulls_last(),
    )
