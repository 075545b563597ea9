"""Bronze to Silver: canonical events in metres, with progression and threat."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pitchlake import fixed_values as fv, schemas
from pitchlake.functions import pitch, xt


def coordinates(bronze: DataFrame) -> DataFrame:
    """Event identity with outcome, xG and start / end points in metres."""
    if "detail" not in bronze.columns:
        bronze = bronze.withColumn("detail", F.from_json("event_payload_json", schemas.EVENT_DETAIL))
    kind = "event_type_name"
    located = bronze.withColumn("end_raw", F.expr(f"""
        CASE {kind} WHEN '{fv.PASS}' THEN detail.pass.end_location
                    WHEN '{fv.CARRY}' THEN detail.carry.end_location
                    WHEN '{fv.SHOT}' THEN detail.shot.end_location END
    """))

    def end(axis: int) -> str:
        return f"CASE WHEN size(end_raw) >= 2 THEN get(end_raw, {axis}) END"

    return located.selectExpr(
        "match_id", "event_id", "event_index", "period", "minute", "second",
        f"{kind} AS event_type", "team_id", "team_name", "player_id", "player_name",
        "possession AS possession_id",
        f"{pitch.metres_x('location_x_raw')} AS start_x", f"{pitch.metres_y('location_y_raw')} AS start_y",
        f"{pitch.metres_x(end(0))} AS end_x", f"{pitch.metres_y(end(1))} AS end_y",
        f"""CASE {kind} WHEN '{fv.PASS}' THEN detail.pass.outcome.name
                        WHEN '{fv.SHOT}' THEN detail.shot.outcome.name END AS outcome""",
        f"CASE WHEN {kind} = '{fv.SHOT}' THEN detail.shot.statsbomb_xg END AS shot_xg",
        "source_version", "file_hash",
    )


def flags(events: DataFrame) -> DataFrame:
    """Add type flags, progression and the successful-move gate."""
    typed = events.selectExpr(
        "*",
        f"coalesce(event_type = '{fv.PASS}', false) AS is_pass",
        f"coalesce(event_type = '{fv.CARRY}', false) AS is_carry",
        f"coalesce(event_type = '{fv.SHOT}', false) AS is_shot",
        f"coalesce(event_type = '{fv.PASS}', false) AND outcome IS NULL AS is_completed_pass",
        f"{pitch.goal_distance('start_x', 'start_y')} AS d_start",
        f"{pitch.goal_distance('end_x', 'end_y')} AS d_end",
    )
    ratio = pitch.progress_ratio("d_start", "d_end")
    return typed.selectExpr(
        *[c for c in typed.columns if c not in ("d_start", "d_end")],
        f"{pitch.distance_gained('d_start', 'd_end')} AS progress_toward_goal_m",
        f"{ratio} AS progress_ratio",
        f"{pitch.is_progressive('is_completed_pass', ratio)} AS is_progressive_pass",
        "is_completed_pass OR is_carry AS is_successful_move",
    )


def threat(events: DataFrame, grid: list[list[float]], model_version: str) -> DataFrame:
    """Add threat before, after and gained, for successful moves only."""
    valued = events.select(
        "*",
        xt.grid_value(grid, F.col("start_x"), F.col("start_y")).alias("v_start"),
        xt.grid_value(grid, F.col("end_x"), F.col("end_y")).alias("v_end"),
    )
    rated = "is_successful_move AND v_start IS NOT NULL AND v_end IS NOT NULL"
    return valued.selectExpr(
        *events.columns,
        f"CASE WHEN {rated} THEN v_start END AS xt_start",
        f"CASE WHEN {rated} THEN v_end END AS xt_end",
        f"CASE WHEN {rated} THEN v_end - v_start END AS xt_added",
        f"'{model_version}' AS xt_model_version",
    )


def to_silver(
    bronze: DataFrame, grid: list[list[float]] = fv.XT_GRID, model_version: str = fv.XT_MODEL_VERSION
) -> DataFrame:
    """Bronze (or parsed events with ``detail``) to the 32 Silver columns."""
    events = threat(flags(coordinates(bronze)), grid, model_version)
    return events.select(*schemas.SILVER.fieldNames())
