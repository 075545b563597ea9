"""Raw artifacts: one JSON file per match, holding one array of event objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pitchlake import schemas
from pitchlake.functions.text import artifact_key, fingerprint

LINEAGE_COLUMNS = schemas.LINEAGE.fieldNames()


def read_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """Landed files below ``path``: (match_id, file_hash, raw_uri, arrived_at, content).

    ``match_id`` is taken from a ``match_id=M`` folder; it is NULL for files elsewhere. A file
    is the unit of delivery (one match), so it is read as one row and hashed as a whole.
    """
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    return describe_artifacts(files)


#: Paths that one run takes from a landing folder, at most; the driver holds that many.
FILES_PER_RUN = 100_000


def read_new_artifacts(
    spark: SparkSession, path: str, seen: DataFrame, first: DataFrame | None = None, most: int = FILES_PER_RUN
) -> DataFrame | None:
    """Up to ``most`` landed files whose ``raw_uri`` is not in ``seen``, or None. No other file is opened.

    The folder is listed without contents, and the paths are handed to the reader, as Spark's own listing hands them to it. Those in
    ``first`` come first, then those that are first in the alphabet.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).load(path)
    fresh = listed.select(F.col("path").alias("raw_uri")).join(seen.select("raw_uri").distinct(), "raw_uri", "left_anti")
    order = [F.col("raw_uri")]
    if first is not None:
        known = first.select("raw_uri").distinct().withColumn("known", F.lit(0))
        fresh, order = fresh.join(known, "raw_uri", "left"), [F.col("known").asc_nulls_last(), *order]
    paths = [r["raw_uri"] for r in fresh.orderBy(*order).limit(most).collect()]
    return describe_artifacts(spark.read.text(paths, wholetext=True)) if paths else None


def describe_artifacts(files: DataFrame) -> DataFrame:
    """Shared by the batch and the streaming reader of landed files."""
    uri = F.col("_metadata.file_path")
    return files.select(
        F.regexp_extract(uri, r"match_id=(\d+)", 1).try_cast("long").alias("match_id"),
        fingerprint(F.col("value")).alias("file_hash"),
        uri.alias("raw_uri"),
        F.col("_metadata.file_modification_time").alias("arrived_at"),
        F.col("value").alias("content"),
    )


def fingerprints(artifacts: DataFrame, content: str = "content") -> DataFrame:
    """Hash and storage keys of each artifact; the content itself is dropped."""
    kept = [c for c in artifacts.columns if c not in (content, "file_hash")]
    hashed = artifacts.select(*kept, fingerprint(F.col(content)).alias("file_hash"))
    match_id, file_hash = F.col("match_id"), F.col("file_hash")
    return hashed.select(
        *kept, "file_hash", F.substring("file_hash", 1, 12).alias("short_hash"),
        artifact_key("raw", match_id, file_hash, "json").alias("raw_key"),
        artifact_key("bronze", match_id, file_hash, "parquet").alias("bronze_key"),
    )


def event_texts(artifacts: DataFrame, content: str = "content") -> DataFrame:
    """One row per event with its JSON text (field order kept)."""
    kept = [c for c in artifacts.columns if c != content]
    elements = F.from_json(F.col(content), T.ArrayType(T.StringType()))
    return artifacts.select(*kept, F.explode(elements).alias("event_payload_json"))


def events_with_payload(artifacts: DataFrame, content: str = "content") -> DataFrame:
    """Parsed events next to their JSON text, for Bronze."""
    return event_texts(artifacts, content).withColumn(
        "event", F.from_json("event_payload_json", schemas.EVENT)
    )


def events(artifacts: DataFrame, content: str = "content", schema: T.StructType = schemas.EVENT_CORE) -> DataFrame:
    """Parsed events only: the content is parsed once, straight into structs of the fields asked for."""
    kept = [c for c in artifacts.columns if c != content]
    parsed = F.from_json(F.col(content), T.ArrayType(schema))
    return artifacts.select(*kept, F.explode(parsed).alias("event"))


def unreadable(artifacts: DataFrame, content: str = "content") -> DataFrame:
    """Artifacts that are not a JSON array of objects, as quality violations."""
    parsed = F.from_json(F.col(content), T.ArrayType(T.StringType()))
    return (
        artifacts.where(parsed.isNull() | (F.size(parsed) == 0))
        .groupBy("match_id").agg(F.count("*").alias("n"))
        .select("match_id", F.lit("artifact_unreadable").alias("rule"), "n")
    )


def latest_file(spark: SparkSession, folder: str, pattern: str) -> str:
    """Path of the most recently modified file in ``folder``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    newest = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).first()["path"]
    if newest is None:
        raise FileNotFoundError(f"No files matching {pattern} in {folder}")
    return newest
