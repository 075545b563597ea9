"""Match lists and the match dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchlake import schemas


#: Fields of a match without which the dimension can't be built.
REQUIRED = ["match_id", "match_date", "competition", "season", "home_team", "away_team"]


def read_match_list(spark: SparkSession, path: str) -> DataFrame:
    """A landed JSON array of nested matches; it must not be empty."""
    matches = spark.read.option("multiLine", True).schema(schemas.MATCH).json(path)
    if matches.isEmpty():
        raise ValueError(f"No matches were found in {path}.")
    # With a given schema a field that is nowhere in the file would silently be NULL.
    given = spark.read.option("multiLine", True).json(path)
    require_columns(given, REQUIRED, path)
    return matches


def to_dim_match(matches: DataFrame) -> DataFrame:
    """Flatten nested matches into the 14-column dimension."""
    def cell(path: str, name: str) -> Column:
        return F.col(path).alias(name)

    return matches.select(
        "match_id",
        F.to_date("match_date").alias("match_date"),
        cell("kick_off", "kickoff_time"),
        "competition.competition_id", "competition.competition_name",
        "season.season_id", "season.season_name",
        "match_week",
        "home_team.home_team_id", "home_team.home_team_name",
        "away_team.away_team_id", "away_team.away_team_name",
        cell("stadium.name", "stadium"),
        cell("referee.name", "referee"),
    )


def require_columns(df: DataFrame, required: list[str], what: str) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")
    return df
