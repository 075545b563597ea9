"""Schemas of all datasets. Missing JSON keys become NULL."""

from __future__ import annotations

from pyspark.sql import types as T

_L, _I, _D, _S, _B, _TS = (
    T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.TimestampType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_NAMED = _struct(("id", _L), ("name", _S))
_POINT = T.ArrayType(_D)

# Provider objects: names are the provider's JSON keys.
PASS_DETAIL = _struct(("end_location", _POINT), ("outcome", _NAMED))
CARRY_DETAIL = _struct(("end_location", _POINT))
SHOT_DETAIL = _struct(("end_location", _POINT), ("outcome", _NAMED), ("statsbomb_xg", _D))

# Part of the event payload that Silver needs beside the Bronze columns.
EVENT_DETAIL = _struct(("pass", PASS_DETAIL), ("carry", CARRY_DETAIL), ("shot", SHOT_DETAIL))

EVENT = _struct(
    ("id", _S), ("index", _I), ("period", _I), ("timestamp", _S), ("minute", _I), ("second", _I),
    ("type", _NAMED), ("possession", _I), ("possession_team", _NAMED), ("play_pattern", _NAMED),
    ("team", _NAMED), ("player", _NAMED), ("position", _NAMED),
    ("location", _POINT), ("duration", _D),
    ("under_pressure", _B), ("off_camera", _B), ("out", _B),
    ("related_events", T.ArrayType(_S)),
    ("pass", PASS_DETAIL), ("carry", CARRY_DETAIL), ("shot", SHOT_DETAIL),
)

# The part of an event that Silver is made of.
EVENT_CORE = T.StructType([f for f in EVENT.fields if f.name in {
    "id", "index", "period", "minute", "second", "type", "possession", "team", "player", "location",
    "pass", "carry", "shot",
}])

MATCH = _struct(
    ("match_id", _L), ("match_date", _S), ("kick_off", _S), ("match_week", _I),
    ("competition", _struct(("competition_id", _I), ("competition_name", _S))),
    ("season", _struct(("season_id", _I), ("season_name", _S))),
    ("home_team", _struct(("home_team_id", _L), ("home_team_name", _S))),
    ("away_team", _struct(("away_team_id", _L), ("away_team_name", _S))),
    ("stadium", _struct(("name", _S))),
    ("referee", _struct(("name", _S))),
)

LINEAGE = _struct(
    ("match_id", _L), ("provider", _S), ("source_version", _I), ("file_hash", _S),
    ("ingestion_id", _S), ("ingested_at", _S),
)

BRONZE = T.StructType(LINEAGE.fields + _struct(
    ("event_id", _S), ("event_index", _I),
    ("period", _I), ("timestamp", _S), ("minute", _I), ("second", _I),
    ("event_type_id", _L), ("event_type_name", _S),
    ("team_id", _L), ("team_name", _S),
    ("player_id", _L), ("player_name", _S),
    ("position_id", _L), ("position_name", _S),
    ("possession", _I), ("possession_team_id", _L), ("possession_team_name", _S),
    ("play_pattern_id", _L), ("play_pattern_name", _S),
    ("location_x_raw", _D), ("location_y_raw", _D),
    ("duration", _D), ("under_pressure", _B), ("off_camera", _B), ("out", _B),
    ("related_events_json", _S), ("event_payload_json", _S),
).fields)

SILVER = _struct(
    ("match_id", _L), ("event_id", _S), ("event_index", _I),
    ("period", _I), ("minute", _I), ("second", _I), ("event_type", _S),
    ("team_id", _L), ("team_name", _S), ("player_id", _L), ("player_name", _S),
    ("possession_id", _I),
    ("start_x", _D), ("start_y", _D), ("end_x", _D), ("end_y", _D),
    ("outcome", _S), ("shot_xg", _D),
    ("is_pass", _B), ("is_carry", _B), ("is_shot", _B),
    ("is_completed_pass", _B), ("is_progressive_pass", _B),
    ("progress_ratio", _D), ("progress_toward_goal_m", _D),
    ("is_successful_move", _B),
    ("xt_start", _D), ("xt_end", _D), ("xt_added", _D), ("xt_model_version", _S),
    ("source_version", _I), ("file_hash", _S),
)

DIM_MATCH = _struct(
    ("match_id", _L), ("match_date", T.DateType()), ("kickoff_time", _S),
    ("competition_id", _I), ("competition_name", _S), ("season_id", _I), ("season_name", _S),
    ("match_week", _I),
    ("home_team_id", _L), ("home_team_name", _S), ("away_team_id", _L), ("away_team_name", _S),
    ("stadium", _S), ("referee", _S),
)

MANIFEST = _struct(
    ("ingestion_id", _S), ("match_id", _L), ("provider", _S), ("source_version", _I),
    ("source_url", _S), ("file_hash", _S), ("raw_path", _S), ("raw_uri", _S), ("ingested_at", _S),
)

STAGE_RUN = _struct(
    ("stage_run_id", _S), ("airflow_run_id", _S), ("dag_id", _S), ("task_id", _S),
    ("try_number", _I), ("match_id", _L), ("stage", _S), ("status", _S),
    ("started_at", _TS), ("completed_at", _TS), ("duration_seconds", _D),
    ("rows_in", _L), ("rows_out", _L), ("error_type", _S), ("error_message", _S),
)

TASK_EVENT = _struct(
    ("event_type", _S), ("occurred_at", _TS), ("dag_id", _S), ("task_id", _S),
    ("airflow_run_id", _S), ("match_id", _L), ("try_number", _I),
    ("exception_type", _S), ("error_message", _S),
)

PIPELINE_RUN = _struct(
    ("run_id", _S), ("match_id", _L), ("started_at", _TS), ("status", _S), ("completed_at", _TS),
    ("failed_stage", _S), ("error_type", _S), ("error_message", _S), ("duration_seconds", _D),
)

LINEAGE_EDGE = _struct(
    ("job", _S), ("input_dataset", _S), ("output_dataset", _S), ("run_id", _S),
)

# Type families of the Silver contract.
FAMILIES = {
    T.LongType: "integer", T.IntegerType: "integer", T.ShortType: "integer", T.ByteType: "integer",
    T.DoubleType: "numeric", T.FloatType: "numeric", T.DecimalType: "numeric",
    T.StringType: "string", T.BooleanType: "boolean",
}
