"""Incremental work: artifact registration, work discovery, selective rebuilds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchlake import fixed_values as fv, schemas
from pitchlake.functions.text import artifact_key, trim_to_null
from pitchlake.operators.keyed import only, settled, without
from pitchlake.operators.ordered import latest, running_totals
from pitchlake.plans import gold


# -- registration ---------------------------------------------------------------

def new_artifacts(arrivals: DataFrame, manifest: DataFrame) -> DataFrame:
    """First arrival of every (match, hash) that the manifest does not know.

    ``arrivals`` has match_id, file_hash and a sortable ``arrival``, no content.
    Copies are dropped inside the map tasks, so many copies of one file are no
    hot key.
    """
    # Copies may arrive at the same instant: the path decides, so that a repeated task picks the same one.
    order = [F.col(c).asc() for c in ("arrival", "raw_uri") if c in arrivals.columns]
    first = latest(arrivals, ["match_id", "file_hash"], *order)
    return without(first, manifest, ["match_id", "file_hash"])


def register_artifacts(
    arrivals: DataFrame, manifest: DataFrame, provider: str, ingested_at: Column,
    source_url: Column | None = None, raw_uri: Column | None = None,
) -> DataFrame:
    """Manifest rows for new artifacts; versions go on from those of the match.

    ``arrivals`` is used several times. If it is computed from file contents,
    cut its lineage first, so that these are read and hashed once.
    """
    # Only the history of the arriving matches counts, and it is small.
    manifest = only(manifest, arrivals, ["match_id"], settle=True)
    fresh = running_totals(
        new_artifacts(arrivals, manifest), ["match_id"], ["arrival", "file_hash"], {"nth": F.lit(1)}
    )
    known = manifest.groupBy("match_id").agg(F.count("*").alias("known"))
    key = artifact_key("raw", F.col("match_id"), F.col("file_hash"), "json")
    return fresh.join(known, "match_id", "left").select(
        # Derived from the content, so that a repeated run gives the same id.
        F.sha2(F.concat_ws("|", F.col("match_id").cast("string"), "file_hash"), 256).alias("ingestion_id"),
        "match_id", F.lit(provider).alias("provider"),
        (F.coalesce("known", F.lit(0)) + F.col("nth")).cast("int").alias("source_version"),
        (source_url if source_url is not None else F.lit(None).cast("string")).alias("source_url"),
        "file_hash", F.lit(None).cast("string").alias("raw_path"),
        (raw_uri if raw_uri is not None else key).alias("raw_uri"),
        ingested_at.alias("ingested_at"),
    )


# -- work discovery and rebuilds ----------------------------------------------------

def new_matches(dim_match: DataFrame, ingested: DataFrame) -> DataFrame:
    return without(dim_match, ingested, ["match_id"])


def discover_new_matches(dim_match: DataFrame, ingested: DataFrame, limit: int = fv.DISCOVERY_LIMIT) -> DataFrame:
    """The next matches to process, oldest first."""
    return new_matches(dim_match, ingested).orderBy(
        F.col("match_date").asc_nulls_last(), "match_id"
    ).limit(limit)


def bulk_scope(
    dim_match: DataFrame, ingested: DataFrame, competition_id: int, season_id: int | None = None,
    team_name: str | None = None,
) -> DataFrame:
    """New matches of a competition, season and (optionally) team, by date."""
    scope = dim_match.where(F.col("competition_id") == competition_id)
    if season_id is not None:
        scope = scope.where(F.col("season_id") == season_id)
    team = trim_to_null(F.lit(team_name).cast("string"))
    scope = scope.where(
        team.isNull() | (F.col("home_team_name") == team) | (F.col("away_team_name") == team)
    )
    return new_matches(scope, ingested).orderBy(F.col("match_date").asc_nulls_last(), "match_id")


def require_scope(scope: DataFrame) -> DataFrame:
    if scope.isEmpty():
        raise ValueError("No matches were found for the given scope.")
    return scope


def new_matches_by_team(dim_match: DataFrame, ingested: DataFrame) -> DataFrame:
    """``bulk_scope`` for every team at once."""
    fresh = new_matches(dim_match, ingested)
    return fresh.select(
        "match_id", "match_date", "season_name",
        F.explode(F.array("home_team_name", "away_team_name")).alias("team_name"),
    )


def rebuild_gold_team(current: DataFrame, silver: DataFrame, matches: DataFrame) -> DataFrame:
    """Team fact with the given matches computed anew from Silver."""
    listed = settled(matches.select("match_id"))
    rebuilt = gold.fact_gold_team(silver.join(listed, "match_id", "left_semi"))
    return current.join(listed, "match_id", "left_anti").unionByName(rebuilt)


def backfill(silver: DataFrame, matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both Gold facts for a list of matches, in one job instead of one per match."""
    selected = only(silver, matches, ["match_id"], settle=True)
    return gold.fact_gold_team(selected), gold.fact_gold_intervals(selected)


def match_ids(spark: SparkSession, ids: list[int]) -> DataFrame:
    if not ids:
        raise ValueError("match_ids must not be empty.")
    return spark.createDataFrame([(int(i),) for i in ids], "match_id long")


def lineage_edges(job: str, inputs: DataFrame, output: str, run_id: str | Column) -> DataFrame:
    """One edge per input dataset; ``inputs`` has a column ``dataset``."""
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    return inputs.select(
        F.lit(job).alias("job"), F.col("dataset").alias("input_dataset"),
        F.lit(output).alias("output_dataset"), run.alias("run_id"),
    ).select(*schemas.LINEAGE_EDGE.fieldNames())
