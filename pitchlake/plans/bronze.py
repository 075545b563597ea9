"""Raw events to Bronze: one row per event, 33 columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from pitchlake import schemas
from pitchlake.functions.text import json_list
from pitchlake.sources import raw


# Up to this many manifest rows (some 300 bytes each) are sent to all executors.
BROADCAST_ARTIFACTS = 200_000


def with_lineage(
    artifacts: DataFrame, manifest: DataFrame, keys: tuple[str, ...] = ("match_id", "file_hash"),
    manifest_rows: int | None = None,
) -> DataFrame:
    """Attach the manifest record to each artifact.

    Joined before the events are exploded: one row per file on both sides, so a
    large match is no hot key. With a counted, small manifest the file contents
    are not shuffled; otherwise Spark decides by its own size estimate.
    """
    lineage = manifest.select(*dict.fromkeys([*raw.LINEAGE_COLUMNS, *keys]))
    if manifest_rows is not None and manifest_rows <= BROADCAST_ARTIFACTS:
        lineage = F.broadcast(lineage)
    return artifacts.join(lineage, list(keys))


# Bronze column <- path in the event.
PATHS = {
    "event_id": "id", "event_index": "index",
    "period": "period", "timestamp": "timestamp", "minute": "minute", "second": "second",
    "event_type_id": "type.id", "event_type_name": "type.name",
    "team_id": "team.id", "team_name": "team.name",
    "player_id": "player.id", "player_name": "player.name",
    "position_id": "position.id", "position_name": "position.name",
    "possession": "possession",
    "possession_team_id": "possession_team.id", "possession_team_name": "possession_team.name",
    "play_pattern_id": "play_pattern.id", "play_pattern_name": "play_pattern.name",
    "duration": "duration", "under_pressure": "under_pressure", "off_camera": "off_camera", "out": "out",
}


def _flat(paths: dict[str, str]) -> list[Column]:
    return [
        *[F.expr(f"event.{path} AS {name}") for name, path in paths.items()],
        F.expr("get(event.location, 0) AS location_x_raw"),
        F.expr("get(event.location, 1) AS location_y_raw"),
    ]


def _group(match_id: Column) -> Column:
    return F.pmod(F.xxhash64(match_id), F.lit(64)).cast("int")


def repeated_ids(artifacts: DataFrame, seen: Observation) -> DataFrame:
    """``artifacts``, of which ``seen`` notes in passing whether one holds an event id twice.

    All events of a file are in one row, so this needs no shuffle. The note is a mask with a bit per group of matches.
    """
    ids = F.from_json("content", "array<struct<id string>>")["id"]
    twice = F.size(F.array_distinct(ids)) < F.size(ids)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _group(F.col("match_id")))
    return artifacts.observe(seen, F.bit_or(F.when(twice, bit).otherwise(F.lit(0).cast("long"))).alias("mask"))


def matches_with_repeats(matches: DataFrame, seen: Observation) -> DataFrame:
    """The matches (``match_id``) whose files may hold an event id twice; a few others may be among them."""
    mask = F.lit(seen.get["mask"] or 0).cast("long")
    return matches.where(F.call_function("shiftrightunsigned", mask, _group(F.col("match_id"))).bitwiseAND(1) == 1)


def to_bronze(artifacts: DataFrame) -> DataFrame:
    """Artifacts with lineage columns and ``content`` to the Bronze table."""
    parsed = raw.events_with_payload(artifacts.select(*raw.LINEAGE_COLUMNS, "content"))
    related = json_list("event.related_events").alias("related_events_json")
    flat = parsed.select(*raw.LINEAGE_COLUMNS, *_flat(PATHS), related, "event_payload_json")
    return flat.select(*schemas.BRONZE.fieldNames())


def to_events(artifacts: DataFrame) -> DataFrame:
    """The Bronze columns behind Silver, plus the parsed ``detail``, without stored payload.

    For jobs that go from raw files to Silver in one pass: each file is parsed
    once, only for the fields needed, and Silver does not parse the payload again.
    """
    parsed = raw.events(artifacts.select(*raw.LINEAGE_COLUMNS, "content"))
    core = set(schemas.EVENT_CORE.fieldNames())
    paths = {name: path for name, path in PATHS.items() if path.split(".")[0] in core}
    detail = F.expr("struct(event.pass, event.carry, event.shot) AS detail")
    return parsed.select(*raw.LINEAGE_COLUMNS, *_flat(paths), detail)
