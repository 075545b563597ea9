"""Manifest and run-metadata logs: JSON lines, append only."""

from __future__ import annotations

from collections.abc import Iterable
from contextlib import contextmanager
from datetime import datetime, timezone
from typing import Any
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pitchlake import fixed_values as fv, schemas


def read_log(
    spark: SparkSession, path: str, schema: T.StructType, require_exists: bool = False
) -> DataFrame:
    """JSON lines with a fixed schema; a log not written yet is empty."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if require_exists:
            raise FileNotFoundError(f"{path} does not exist yet.") from error
        return spark.createDataFrame([], schema)


def append_log(df: DataFrame, path: str, schema: T.StructType) -> None:
    df.select(*schema.fieldNames()).write.mode("append").json(path)


def append_records(
    spark: SparkSession, records: Iterable[dict[str, Any]], path: str, schema: T.StructType
) -> None:
    """Append a few records made by the calling job (one per stage or task)."""
    rows = [tuple(record.get(name) for name in schema.fieldNames()) for record in records]
    append_log(spark.createDataFrame(rows, schema), path, schema)


def read_manifest(spark: SparkSession, path: str, require_exists: bool = False) -> DataFrame:
    return read_log(spark, path, schemas.MANIFEST, require_exists)


def ingested_match_ids(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("match_id").isNotNull()).select("match_id").distinct()


def register_health_views(spark: SparkSession, stage_runs: str, events: str, manifest: str) -> None:
    """Temporary views over the three logs."""
    read_log(spark, stage_runs, schemas.STAGE_RUN).createOrReplaceTempView("airflow_pipeline_stage_runs")
    read_log(spark, events, schemas.TASK_EVENT).createOrReplaceTempView("airflow_events")
    read_manifest(spark, manifest).createOrReplaceTempView("ingestion_manifest")


def task_event(event_type: str, error: BaseException | None = None, **fields: Any) -> dict[str, Any]:
    """A TASK_RETRY, TASK_FAILED or DAG_FAILED record."""
    if event_type not in (fv.TASK_RETRY, fv.TASK_FAILED, fv.DAG_FAILED):
        raise ValueError(f"Unknown event type: {event_type}")
    return {
        "event_type": event_type,
        "occurred_at": datetime.now(timezone.utc),
        "exception_type": type(error).__name__ if error else None,
        "error_message": str(error) if error else None,
        **fields,
    }


@contextmanager
def observe_stage(spark: SparkSession, path: str, stage: str, **fields: Any):
    """Record one stage attempt; set ``rows_in`` and ``rows_out`` on the yielded dict."""
    started = datetime.now(timezone.utc)
    metrics: dict[str, Any] = {"rows_in": None, "rows_out": None}
    outcome: dict[str, Any] = {"status": fv.SUCCEEDED}
    try:
        yield metrics
    except Exception as error:
        outcome = {
            "status": fv.FAILED, "error_type": type(error).__name__, "error_message": str(error),
        }
        raise
    finally:
        completed = datetime.now(timezone.utc)
        record = {
            "stage_run_id": str(uuid4()), "stage": stage, "started_at": started,
            "completed_at": completed, "duration_seconds": (completed - started).total_seconds(),
            **fields, **metrics, **outcome,
        }
        append_records(spark, [record], path, schemas.STAGE_RUN)
