"""Named queries over the test tables; one per operator.

Every query reads its whole tables. Queries on quality rules first damage some
rows (by event number), so that there is something to find.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pitchlake import fixed_values as fv, schemas
from pitchlake.functions import xt
from pitchlake.functions.text import artifact_key
from pitchlake.operators import checks
from pitchlake.operators.keyed import replace_by_key, upsert
from pitchlake.plans import (
    bronze, commits, gold, incremental, marts, observability, partials, profiles, quality, reports, silver,
)
from pitchlake.plans.volume_state import VolumeMonitor
from pitchlake.session import checkpoint_dir, cut_lineage
from pitchlake.sources import driver_tables as tables, raw
from pitchlake.sources.matches import to_dim_match

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _match_no() -> Column:
    return F.col("match_id") - 1000


def _event_no() -> Column:
    return _match_no() * 1000 + F.col("event_index") - 1


def _interval_no() -> Column:
    return _match_no() * 40 + F.col("team_id") + F.col("period") * 100 + F.col("interval_start")


def _two_sided() -> Column:
    """Leaves every fourth match with part of its teams, so that reports meet such matches."""
    return (_match_no() % 4 != 3) | (F.col("team_id") < 11)


def _late_season() -> Column:
    return _match_no() % 10 >= 5



def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round doubles, so that the order of additions has no say in comparisons."""
    return df.select(*[
        (F.round(f.name, digits) + 0.0).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


# -- base datasets ---------------------------------------------------------------

def _events(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.to_events(tables.raw_artifacts(spark, sf))


def _bronze(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.to_bronze(tables.raw_artifacts(spark, sf))


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver.to_silver(_events(spark, sf))


def _dim(spark: SparkSession, sf: str) -> DataFrame:
    return to_dim_match(tables.match_list(spark, sf))


def _team(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fact_gold_team(_silver(spark, sf))


def _intervals(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fact_gold_intervals(_silver(spark, sf))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return marts.team_match_enriched(_team(spark, sf), _dim(spark, sf))


def _document_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Documents registered in two batches: first the English ones, then all."""
    hashed = raw.fingerprints(tables.document_artifacts(spark, sf))
    # Every text is read and hashed once; all further steps work on the few columns kept here.
    arrivals = cut_lineage(hashed.select("match_id", "file_hash", "arrival", "lang"))
    ingested_at = F.date_format(
        F.timestamp_add("SECOND", F.col("arrival"), F.lit("2024-01-01").cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss"
    )
    empty = spark.createDataFrame([], schemas.MANIFEST)
    first = incremental.register_artifacts(
        arrivals.where("lang = 'en'"), empty, tables.PROVIDER, ingested_at
    )
    second = incremental.register_artifacts(arrivals, first, tables.PROVIDER, ingested_at)
    return first.unionByName(second)


# -- sources ---------------------------------------------------------------------

@query
def raw_json_scan(spark: SparkSession, sf: str) -> DataFrame:
    texts = raw.event_texts(tables.raw_artifacts(spark, sf))

    def at(path: str) -> Column:
        return F.get_json_object("event_payload_json", path)

    return texts.select(
        "match_id", at("$.id").alias("event_id"), at("$.index").cast("int").alias("event_index"),
        at("$.type.name").alias("event_type"), at("$.team.name").alias("team_name"),
        at("$.location[0]").cast("double").alias("location_x_raw"),
        at("$.location[1]").cast("double").alias("location_y_raw"),
        at("$.pass.outcome.name").alias("pass_outcome"),
        at("$.shot.statsbomb_xg").cast("double").alias("shot_xg"),
    )


@query
def artifact_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    hashed = raw.fingerprints(tables.document_artifacts(spark, sf))
    return hashed.select("arrival", "match_id", "file_hash", "short_hash", "raw_key", "bronze_key")


@query
def manifest_register(spark: SparkSession, sf: str) -> DataFrame:
    return _document_manifest(spark, sf).select(
        "ingestion_id", "match_id", "provider", "source_version", "file_hash", "raw_uri", "ingested_at"
    )


@query
def ingestion_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return observability.ingestion_freshness(_document_manifest(spark, sf))


@query
def dim_match(spark: SparkSession, sf: str) -> DataFrame:
    return _dim(spark, sf)


@query
def stg_dim_match(spark: SparkSession, sf: str) -> DataFrame:
    _dim(spark, sf).createOrReplaceTempView("dim_match")
    return spark.table("dim_match").select(*schemas.DIM_MATCH.fieldNames())


@query
def dim_match_upsert(spark: SparkSession, sf: str) -> DataFrame:
    dim = _dim(spark, sf)
    incoming = dim.where((_match_no() % 4).isin(1, 2)).withColumn("referee", F.lit("Revised")).withColumn(
        "match_week", F.col("match_week") + 1
    )
    return upsert(dim.where(_match_no() % 4 != 1), incoming, ["match_id"])


@query
def lineage_edges(spark: SparkSession, sf: str) -> DataFrame:
    run = F.concat(F.lit("run-"), F.col("match_id").cast("string"))
    manifest = tables.match_manifest(spark, sf)
    keys = manifest.select("match_id", artifact_key(
        "bronze", F.col("match_id"), F.col("file_hash"), "parquet").alias("dataset"))
    loaded = manifest.select("match_id", F.lit("silver_events").alias("dataset"))
    return incremental.lineage_edges("build_silver", keys, "silver_events", run).unionByName(
        incremental.lineage_edges("load_serving", loaded, "serving.src_silver_events", run)
    )


# -- Bronze and Silver -------------------------------------------------------------

@query
def bronze_events(spark: SparkSession, sf: str) -> DataFrame:
    # The payload text itself is covered by raw_json_scan.
    return _bronze(spark, sf).drop("event_payload_json")


@query
def bronze_with_lineage(spark: SparkSession, sf: str) -> DataFrame:
    artifacts = tables.raw_artifacts(spark, sf).select("match_id", "file_hash", "content")
    joined = bronze.with_lineage(artifacts, tables.match_manifest(spark, sf))
    return bronze.to_bronze(joined).select("event_id", *raw.LINEAGE_COLUMNS)


@query
def bronze_related_json(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze(spark, sf).select("match_id", "event_id", "related_events_json")


@query
def bronze_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.bronze_profile(_events(spark, sf))


@query
def bronze_sample(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.bronze_sample(_events(spark, sf))


@query
def silver_events(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_silver(spark, sf))


@query
def silver_from_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """The same from stored Bronze rows, whose payload text is parsed again."""
    return rounded(silver.to_silver(_bronze(spark, sf)))


@query
def silver_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(silver.coordinates(_events(spark, sf)).select(
        "match_id", "event_id", "start_x", "start_y", "end_x", "end_y"))


@query
def silver_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return silver.coordinates(_events(spark, sf)).select(
        "match_id", "event_id", "event_type", "outcome", "shot_xg")


@query
def silver_flags(spark: SparkSession, sf: str) -> DataFrame:
    return silver.flags(silver.coordinates(_events(spark, sf))).select(
        "match_id", "event_id", "is_pass", "is_carry", "is_shot", "is_completed_pass", "is_progressive_pass",
        "is_successful_move")


@query
def silver_progression(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(silver.flags(silver.coordinates(_events(spark, sf))).select(
        "match_id", "event_id", "progress_toward_goal_m", "progress_ratio"))


@query
def xt_cells(spark: SparkSession, sf: str) -> DataFrame:
    located = silver.coordinates(_events(spark, sf))
    return located.select(
        "match_id", "event_id",
        xt.grid_col(F.col("start_x")).alias("start_col"), xt.grid_row(F.col("start_y")).alias("start_row"),
        xt.grid_col(F.col("end_x")).alias("end_col"), xt.grid_row(F.col("end_y")).alias("end_row"),
    )


@query
def xt_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Every located event against two model versions, by joins with the long grid."""
    flipped = [list(reversed(row)) for row in fv.XT_GRID]
    grids = xt.grid_frame(spark, fv.XT_GRID).unionByName(xt.grid_frame(spark, flipped, "reversed"))
    located = silver.coordinates(_events(spark, sf)).select(
        "match_id", "event_id", "start_x", "start_y", "end_x", "end_y")
    rated = xt.rate_moves_by_join(located, grids, [fv.XT_MODEL_VERSION, "reversed"])
    return rounded(rated.select("match_id", "event_id", "model_version", "xt_start", "xt_end", "xt_added"))


@query
def xt_rated_moves(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_silver(spark, sf).where("is_successful_move").select(
        "match_id", "event_id", "xt_start", "xt_end", "xt_added", "xt_model_version"))


@query
def xt_grid_long(spark: SparkSession, sf: str) -> DataFrame:
    """The grid in long form, with the number of moves that start in each cell."""
    moves = _silver(spark, sf).where("is_successful_move").select(
        xt.grid_row(F.col("start_y")).alias("row"), xt.grid_col(F.col("start_x")).alias("col"))
    # Cells are clamped to the grid: 96 rows at most, so they can be broadcast.
    starts = moves.where("row IS NOT NULL AND col IS NOT NULL").groupBy("row", "col").agg(
        F.count("*").alias("moves"))
    grid = xt.grid_frame(spark, fv.XT_GRID)
    return grid.join(F.broadcast(starts), ["row", "col"], "left").select(
        "model_version", "row", "col", "value", F.coalesce("moves", F.lit(0)).cast("long").alias("moves"))


# -- Gold -----------------------------------------------------------------------

@query
def fact_gold_team(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_team(spark, sf))


@query
def team_match_xt(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(gold.team_match_xt(_silver(spark, sf)))


@query
def interval_assign(spark: SparkSession, sf: str) -> DataFrame:
    return gold.assign_intervals(_silver(spark, sf)).select(
        "match_id", "event_id", "period", "minute", "period_minute", "is_stoppage_time", "interval_start")


@query
def interval_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(gold.interval_aggregates(_silver(spark, sf)).drop("source_version"))


@query
def interval_spine(spark: SparkSession, sf: str) -> DataFrame:
    return gold.interval_spine(_silver(spark, sf))


@query
def interval_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _intervals(spark, sf).groupBy("period", "interval_start", "is_stoppage_time", "interval_label").agg(
        F.count("*").alias("rows"), F.sum("successful_moves").alias("successful_moves"))


@query
def fact_gold_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_intervals(spark, sf))


@query
def fact_team_match(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(marts.fact_team_match(_team(spark, sf)))


@query
def team_match_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_enriched(spark, sf))


@query
def team_season_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(marts.team_season_summary(_enriched(spark, sf)), 6)


@query
def match_by_match(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(marts.match_by_match(_enriched(spark, sf)))


@query
def team_home_away_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(marts.team_home_away_summary(_enriched(spark, sf)), 6)


# -- profiles and reports -----------------------------------------------------------

@query
def top_xt_moves(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profiles.top_moves(_silver(spark, sf)))


@query
def player_xt_leaders(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profiles.player_xt_leaders(_silver(spark, sf)), 8)


@query
def player_progressive_leaders(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.player_progressive_leaders(_silver(spark, sf))


@query
def team_progressive(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.team_progressive(_silver(spark, sf))


@query
def shot_x_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profiles.shot_x_profile(_silver(spark, sf)))


@query
def orientation_check(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profiles.orientation(_silver(spark, sf)))


@query
def match_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.match_summary(_team(spark, sf).where(_two_sided())))


@query
def shot_map_points(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.shot_map_points(_silver(spark, sf)))


@query
def shot_map_totals(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.shot_map_totals(_silver(spark, sf)))


@query
def xg_timeline(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.xg_timeline(_silver(spark, sf)))


@query
def xt_momentum(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.xt_momentum(_intervals(spark, sf).where(_two_sided())))


@query
def dq_report_inputs(spark: SparkSession, sf: str) -> DataFrame:
    team = _team(spark, sf).where((_match_no() % 4 != 3) | (F.col("team_id") < 11))
    label = F.when(_interval_no() % 17 == 0, F.lit("?")).otherwise(F.col("interval_label"))
    intervals = _intervals(spark, sf).where(_interval_no() % 23 != 0).withColumn("interval_label", label)
    events = _silver(spark, sf).withColumn("is_shot", F.col("is_shot") & (_match_no() % 5 != 2))
    return reports.input_violations(team, intervals, events)


# -- quality -----------------------------------------------------------------------

def _damaged(events: DataFrame) -> DataFrame:
    def when(by: int, column: str, value: Column) -> Column:
        return F.when(_event_no() % by == 0, value).otherwise(F.col(column)).alias(column)

    changed = {
        "event_id": F.when(_event_no() % 887 == 0, F.lit(None)).when(_event_no() % 409 == 0, F.lit("repeated"))
        .otherwise(F.col("event_id")).alias("event_id"),
        "event_type": when(997, "event_type", F.lit(None)),
        "start_x": when(501, "start_x", F.col("start_x") + 130),
        "start_y": when(701, "start_y", F.col("start_y") - 100),
        "shot_xg": when(401, "shot_xg", F.coalesce("shot_xg", F.lit(0.0)) + 1.5),
        "is_completed_pass": when(601, "is_completed_pass", F.lit(True)),
        "is_progressive_pass": when(307, "is_progressive_pass", F.lit(True)),
        "xt_added": when(211, "xt_added", F.lit(None)),
    }
    return events.select(*[changed.get(c, F.col(c)) for c in events.columns])


@query
def dq_silver(spark: SparkSession, sf: str) -> DataFrame:
    return quality.silver_violations(_damaged(_silver(spark, sf)))


@query
def quarantine_matches(spark: SparkSession, sf: str) -> DataFrame:
    events = _silver(spark, sf).withColumn(
        "start_x", F.when(_event_no() % 4001 == 17, F.lit(-1.0)).otherwise(F.col("start_x"))
    ).withColumn("shot_xg", F.when(_event_no() % 3001 == 29, F.lit(2.0)).otherwise(F.col("shot_xg")))
    return quality.match_status(events, quality.silver_violations(events))


@query
def published_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Silver rows per match after quarantine, and registered matches without any row."""
    events = _silver(spark, sf).where(_match_no() % 9 != 4).withColumn(
        "start_x", F.when(_event_no() % 4001 == 17, F.lit(-1.0)).otherwise(F.col("start_x")))
    broken = checks.all_of(
        quality.silver_violations(events), quality.empty_batches(tables.match_manifest(spark, sf), events))
    kept = quality.quarantine(events, broken).groupBy("match_id").agg(F.count("*").alias("n"))
    return kept.select("match_id", F.lit("published").alias("rule"), "n").unionByName(broken)


@query
def reconcile_bronze_silver(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf)
    stored = silver.to_silver(events).where(_event_no() % 501 != 0).withColumn(
        "event_id", F.when(_event_no() % 3503 == 0, F.concat(F.lit("x"), "event_id")).otherwise(F.col("event_id")))
    return quality.reconcile_bronze_silver(events, stored)


@query
def reconcile_gold_team(spark: SparkSession, sf: str) -> DataFrame:
    events = _silver(spark, sf)
    claimed = gold.fact_gold_team(events).where((_match_no() + F.col("team_id")) % 9 != 0).withColumn(
        "shots", F.when(F.col("team_id") % 5 == 0, F.col("shots") + 1).otherwise(F.col("shots"))
    ).withColumn("xg", F.when(F.col("team_id") % 7 == 0, F.lit(None)).otherwise(F.col("xg")))
    return rounded(quality.reconcile_gold_team(claimed, events))


@query
def fact_dim_references(spark: SparkSession, sf: str) -> DataFrame:
    return quality.fact_dim_references(
        _team(spark, sf).where(_match_no() % 7 != 3), _dim(spark, sf).where(_match_no() % 5 != 2))


@query
def dq_relationships(spark: SparkSession, sf: str) -> DataFrame:
    return checks.relationships(_team(spark, sf), _dim(spark, sf).where(_match_no() % 5 != 2), "team_in_dim_match")


@query
def dq_dim_match(spark: SparkSession, sf: str) -> DataFrame:
    dim = _dim(spark, sf)
    damaged = dim.unionByName(dim.where(_match_no() % 3 == 0)).withColumn(
        "match_id", F.when(_match_no() % 7 == 5, F.lit(None)).otherwise(F.col("match_id")))
    return quality.dim_match_violations(damaged)


@query
def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    team, intervals = _team(spark, sf), _intervals(spark, sf)
    damaged = team.withColumn("team_name", F.when(F.col("team_id") % 4 == 0, F.lit(None)).otherwise(F.col("team_name")))
    enriched = marts.team_match_enriched(damaged, _dim(spark, sf))
    gold_rules = quality.gold_not_null(
        team.withColumn("team_id", F.when(F.col("team_id") % 6 == 0, F.lit(None)).otherwise(F.col("team_id"))),
        intervals, enriched)
    return gold_rules.unionByName(
        quality.serving_not_null(_damaged(_silver(spark, sf)), _dim(spark, sf)))


@query
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    team, intervals = _team(spark, sf), _intervals(spark, sf)
    return quality.gold_unique(
        team.unionByName(team.where(_match_no() % 3 == 0)), intervals.unionByName(intervals.where(_interval_no() % 19 == 0)))


@query
def dq_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    venue = F.when(F.col("team_id") % 4 == 0, F.lit("Neutral")).otherwise(F.col("venue"))
    return checks.accepted_values(_enriched(spark, sf).withColumn("venue", venue), "venue", ["Home", "Away"])


@query
def dq_accepted_range(spark: SparkSession, sf: str) -> DataFrame:
    team = _team(spark, sf).withColumn("shots", F.col("shots") - 95).withColumn(
        "xg", F.col("xg") - 45).withColumn("pass_completion_pct", F.col("pass_completion_pct") + 1)
    intervals = _intervals(spark, sf).withColumn("positive_xt", F.col("positive_xt") - 0.05).withColumn(
        "negative_xt", F.col("negative_xt") + 0.1)
    return quality.gold_ranges(team, intervals)


@query
def dq_gold_invariants(spark: SparkSession, sf: str) -> DataFrame:
    team = _team(spark, sf).withColumn("goals", F.col("goals") * 8).withColumn(
        "completed_passes", F.col("completed_passes") + 5).withColumn(
        "progressive_passes", F.col("progressive_passes") * 2 + 10)
    return quality.gold_team_invariants(team)


@query
def dq_two_teams(spark: SparkSession, sf: str) -> DataFrame:
    return checks.rows_per_match(_team(spark, sf).where((_match_no() + F.col("team_id")) % 5 != 0), 2, "not_two_teams")


@query
def dq_forty_rows(spark: SparkSession, sf: str) -> DataFrame:
    return checks.rows_per_match(_intervals(spark, sf).where(_interval_no() % 23 != 0), 40, "not_forty_intervals")


@query
def dq_interval_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    return quality.interval_boundaries(_intervals(spark, sf).withColumn(
        "interval_start", F.col("interval_start") + F.when(_interval_no() % 23 == 0, 1).otherwise(0)))


@query
def dq_net_xt(spark: SparkSession, sf: str) -> DataFrame:
    return quality.net_xt(_intervals(spark, sf).withColumn(
        "net_xt", F.col("net_xt") + F.when(_interval_no() % 23 == 0, 1e-6).otherwise(0.0)))


# -- incremental work -----------------------------------------------------------------

def _revised(events: DataFrame, matches: Column, dropped_type: str, version: int) -> DataFrame:
    return events.where(matches & (F.col("event_type") != dropped_type)).withColumn(
        "source_version", F.lit(version))


def _commits(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Three commits: all matches, the late season, every third (half of it held back)."""
    events = _silver(spark, sf)
    every_third = _match_no() % 3 == 0
    data = events.withColumn("commit_seq", F.lit(1)).unionByName(
        _revised(events, _late_season(), "Pressure", 2).withColumn("commit_seq", F.lit(2))
    ).unionByName(_revised(events, every_third, "Ball Receipt*", 3).withColumn("commit_seq", F.lit(3)))
    versions = F.array(
        F.struct(F.lit(1).alias("commit_seq"), F.lit(True).alias("published")),
        F.when(_late_season(), F.struct(F.lit(2).alias("commit_seq"), F.lit(True).alias("published"))),
        F.when(every_third, F.struct(F.lit(3).alias("commit_seq"), (_match_no() % 2 != 0).alias("published"))),
    )
    listed = tables.match_manifest(spark, sf).select("match_id", F.explode(versions).alias("c"))
    return data, listed.where("c IS NOT NULL").select("match_id", "c.*")


def _state(spark: SparkSession, sf: str, as_of: int | None) -> DataFrame:
    data, match_commits = _commits(spark, sf)
    return rounded(commits.pinned(data, match_commits, as_of).select(
        "match_id", "commit_seq", "source_version", "event_id", "start_x", "xt_added"))


@query
def silver_commit_replace(spark: SparkSession, sf: str) -> DataFrame:
    return _state(spark, sf, None)


@query
def silver_pinned_read(spark: SparkSession, sf: str) -> DataFrame:
    return _state(spark, sf, 2)


@query
def serving_replace(spark: SparkSession, sf: str) -> DataFrame:
    events = _silver(spark, sf)
    served = replace_by_key(events, _revised(events, _late_season(), "Pressure", 2), ["match_id"])
    return rounded(served.select("match_id", "event_id", "source_version", "event_type", "start_x"))


@query
def gold_incremental(spark: SparkSession, sf: str) -> DataFrame:
    events = _silver(spark, sf)
    revised = _revised(events, _late_season(), "Carry", 2)
    touched = tables.match_manifest(spark, sf).where(_late_season()).select("match_id")
    return rounded(incremental.rebuild_gold_team(gold.fact_gold_team(events), revised, touched))


def _current_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Sums of the three commits, of which the current ones are read."""
    data, match_commits = _commits(spark, sf)
    return commits.pinned(partials.partial_facts(data, "commit_seq"), match_commits)


@query
def gold_parts_team(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(partials.team_facts(_current_parts(spark, sf)))


@query
def gold_parts_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(partials.interval_facts(_current_parts(spark, sf)).select(*gold.INTERVAL_KEYS, "interval_label", *gold.MEASURES, "source_version"))


@query
def gold_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Interval facts of all matches of a season."""
    matches = _dim(spark, sf).where("season_name = '2024/2025'").select("match_id")
    _, intervals = incremental.backfill(_silver(spark, sf), matches)
    return rounded(intervals.select(*gold.INTERVAL_KEYS, "interval_label", *gold.MEASURES))


@query
def new_matches(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.new_matches(_dim(spark, sf), tables.ingested_matches(spark, sf)).select(
        "match_id", "match_date")


@query
def discover_new_matches(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.discover_new_matches(_dim(spark, sf), tables.ingested_matches(spark, sf)).select(
        "match_id", "match_date")


@query
def bulk_scope(spark: SparkSession, sf: str) -> DataFrame:
    scope = incremental.bulk_scope(
        _dim(spark, sf), tables.ingested_matches(spark, sf), competition_id=2, season_id=281, team_name="  ")
    return scope.select("match_id", "match_date", "home_team_name", "away_team_name")


@query
def bulk_scope_by_team(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.new_matches_by_team(_dim(spark, sf), tables.ingested_matches(spark, sf))


# -- run metadata -----------------------------------------------------------------------

@query
def stage_health(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(observability.stage_health(tables.stage_runs(spark, sf)), 6)


@query
def stage_volume_history(spark: SparkSession, sf: str) -> DataFrame:
    return observability.stage_volume_history(tables.stage_runs(spark, sf))


@query
def silver_volume_monitor(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(observability.silver_volume_monitor(tables.stage_runs(spark, sf)))


@query
def silver_volume_appended(spark: SparkSession, sf: str) -> DataFrame:
    """The monitor after three appends, of which the second brings late runs."""
    runs = tables.stage_runs(spark, sf)
    monitor = VolumeMonitor(spark, f"{checkpoint_dir(spark)}/volume-{uuid.uuid4().hex}")
    batch = F.when(F.pmod(F.xxhash64("stage_run_id"), F.lit(50)) == 0, 1).when(
        F.pmod(F.xxhash64(F.lit(1), "completed_at"), F.lit(2)) == 0, 0).otherwise(2)
    for n in range(3):
        monitor.append(runs.where(batch == n), f"append-{n}")
    return rounded(monitor.read().withColumn("completed_at", F.col("completed_at").cast(runs.schema["completed_at"].dataType)))


@query
def silver_volume_health(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(observability.silver_volume_health(tables.stage_runs(spark, sf)))


@query
def recent_stage_health(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(observability.recent_stage_health(tables.stage_runs(spark, sf)))


@query
def alert_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return observability.alert_candidates(tables.stage_runs(spark, sf))


@query
def current_health(spark: SparkSession, sf: str) -> DataFrame:
    return observability.current_health(tables.stage_runs(spark, sf))


@query
def retry_summary(spark: SparkSession, sf: str) -> DataFrame:
    return observability.retry_summary(tables.task_events(spark, sf))


@query
def run_durations(spark: SparkSession, sf: str) -> DataFrame:
    runs = tables.stage_runs(spark, sf).select("stage_run_id", "started_at", "completed_at")
    return rounded(observability.run_durations(runs))


@query
def run_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(observability.run_outcomes(tables.pipeline_stage_records(spark, sf)))


@query
def stage_row_flow(spark: SparkSession, sf: str) -> DataFrame:
    return observability.stage_row_flow(tables.pipeline_stage_records(spark, sf))


@query
def run_stage_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return observability.run_stage_matrix(tables.pipeline_stage_records(spark, sf))
