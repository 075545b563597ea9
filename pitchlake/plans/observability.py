"""Health views over run metadata."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from pitchlake import fixed_values as fv
from pitchlake.operators.ordered import latest, rolling

RUN_ORDER = ["completed_at", "stage_run_id"]


def stage_health(stage_runs: DataFrame) -> DataFrame:
    succeeded = F.col("status") == fv.SUCCEEDED
    return stage_runs.groupBy("stage").agg(
        F.count("*").alias("attempts"),
        F.count_if(succeeded).alias("successful_attempts"),
        F.count_if(F.col("status") == fv.FAILED).alias("failed_attempts"),
        F.avg(F.when(succeeded, F.col("duration_seconds"))).alias("avg_duration_seconds"),
        F.max(F.when(succeeded, F.col("duration_seconds"))).alias("max_duration_seconds"),
        F.avg(F.when(succeeded, F.col("rows_out"))).alias("avg_rows_out"),
    ).orderBy("stage")


def volumes(stage_runs: DataFrame, stage: str | None) -> DataFrame:
    kept = stage_runs.where((F.col("status") == fv.SUCCEEDED) & F.col("rows_out").isNotNull())
    return kept if stage is None else kept.where(F.col("stage") == stage)


def stage_volume_history(stage_runs: DataFrame, stage: str | None = None) -> DataFrame:
    """Volumes of successful attempts, of one stage or of all."""
    return volumes(stage_runs, stage).select(
        "match_id", "stage", "completed_at", "rows_in", "rows_out"
    ).orderBy(F.col("completed_at").asc_nulls_last(), "match_id", "stage")


def _baseline_rows(frame) -> Column:
    # percentile() accepts a frame; median() does not.
    return F.percentile("rows_out", F.lit(0.5)).over(frame)


def _baseline_sample(frame) -> Column:
    return F.count("*").over(frame)


#: The ten runs before a run: their median and their number.
BASELINE = {"baseline_rows": _baseline_rows, "baseline_sample": _baseline_sample}


def volume_status(runs: DataFrame) -> DataFrame:
    ratio = F.col("deviation_ratio")
    status = (
        F.when(F.col("baseline_sample") < fv.BASELINE_RUNS, "INSUFFICIENT_HISTORY")
        .when(ratio > fv.HIGH_VOLUME_RATIO, "HIGH_VOLUME")
        .when(ratio < fv.LOW_VOLUME_RATIO, "LOW_VOLUME")
        .otherwise("NORMAL")
    )
    return runs.withColumn(
        "deviation_ratio", F.col("rows_out") / F.nullif(F.col("baseline_rows"), F.lit(0.0))
    ).select(
        "match_id", "completed_at", "rows_out", "baseline_rows", "deviation_ratio",
        status.alias("volume_status"),
    )


def silver_volume_monitor(stage_runs: DataFrame) -> DataFrame:
    """Each Silver run against the median of the ten runs before it."""
    runs = volumes(stage_runs, "SILVER").select("match_id", *RUN_ORDER, "rows_out")
    return volume_status(rolling(runs, RUN_ORDER, fv.BASELINE_RUNS, BASELINE))


def _volume_health(monitor: DataFrame) -> DataFrame:
    status = F.col("volume_status")
    health = (
        F.when(status.isin("HIGH_VOLUME", "LOW_VOLUME"), "WARNING")
        .when(status == "INSUFFICIENT_HISTORY", "INFO").otherwise("HEALTHY")
    )
    return monitor.withColumn("health_status", health)


def silver_volume_health(stage_runs: DataFrame) -> DataFrame:
    return _volume_health(silver_volume_monitor(stage_runs))


def newest_volume_health(stage_runs: DataFrame) -> DataFrame:
    """Health of the newest Silver run only: a top-11 instead of the full history."""
    newest = [F.col(c).desc_nulls_last() for c in RUN_ORDER]
    runs = volumes(stage_runs, "SILVER").select("match_id", *RUN_ORDER, "rows_out")
    recent = runs.orderBy(*newest).limit(fv.BASELINE_RUNS + 1)
    frame = Window.orderBy(*RUN_ORDER).rowsBetween(-fv.BASELINE_RUNS, -1)
    measured = recent.select(
        "*", _baseline_rows(frame).alias("baseline_rows"), _baseline_sample(frame).alias("baseline_sample")
    ).orderBy(*newest).limit(1)
    return _volume_health(volume_status(measured))


def recent_stage_health(stage_runs: DataFrame) -> DataFrame:
    """The newest attempt of each stage."""
    newest = latest(
        stage_runs, ["stage"], F.col("completed_at").desc_nulls_last(), F.col("stage_run_id").desc()
    )
    health = (
        F.when(F.col("status") == fv.FAILED, "CRITICAL")
        .when((F.col("status") == fv.SUCCEEDED) & (F.col("try_number") > 1), "WARNING")
        .otherwise("HEALTHY")
    )
    return newest.select(
        "stage", "match_id", "airflow_run_id", "task_id", "try_number", "status", "started_at",
        "completed_at", "duration_seconds", "rows_in", "rows_out", health.alias("health_status"),
    )


def alert_candidates(stage_runs: DataFrame) -> DataFrame:
    """Stages that are critical now, and all volume warnings so far."""
    critical = recent_stage_health(stage_runs).where("health_status = 'CRITICAL'").select(
        F.col("stage").alias("component"), "match_id", F.col("completed_at").alias("occurred_at"),
        "health_status", F.col("status").alias("reason"),
    )
    volume = silver_volume_health(stage_runs).where("health_status = 'WARNING'").select(
        F.lit("SILVER_VOLUME").alias("component"), "match_id", F.col("completed_at").alias("occurred_at"),
        "health_status", F.col("volume_status").alias("reason"),
    )
    return critical.unionByName(volume)


def current_health(stage_runs: DataFrame) -> DataFrame:
    """One row: the worst signal of all stages and of the newest volume."""
    signals = recent_stage_health(stage_runs).select("health_status").unionByName(
        newest_volume_health(stage_runs).select("health_status")
    )
    status = F.col("health_status")
    severity = F.when(status == "CRITICAL", 3).when(status == "WARNING", 2).when(status == "INFO", 1).otherwise(0)
    worst = F.col("worst")
    return signals.select(severity.alias("severity")).agg(
        F.max("severity").alias("worst"),
        F.count_if(F.col("severity") == 3).alias("critical_signals"),
        F.count_if(F.col("severity") == 2).alias("warning_signals"),
        F.count_if(F.col("severity") == 1).alias("info_signals"),
    ).select(
        F.when(worst == 3, "CRITICAL").when(worst == 2, "WARNING").when(worst == 1, "INFO")
        .otherwise("HEALTHY").alias("overall_health"),
        "critical_signals", "warning_signals", "info_signals",
    )


def retry_summary(task_events: DataFrame) -> DataFrame:
    return task_events.where(F.col("event_type") == fv.TASK_RETRY).groupBy(
        "airflow_run_id", "task_id", "match_id"
    ).agg(
        F.count("*").alias("retry_counts"), F.min("occurred_at").alias("first_retry_at"),
        F.max("occurred_at").alias("last_retry_at"),
    )


def ingestion_freshness(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.max("ingested_at").alias("latest_ingested_at"))


def _seconds(start: str, end: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)) / F.lit(1e6)


def run_durations(runs: DataFrame) -> DataFrame:
    """Add the duration; NULL while a run has not started or ended."""
    return runs.withColumn("duration_seconds", _seconds("started_at", "completed_at"))


#: Statuses of an attempt, by their digit in a packed one; the first stands for a missing status.
ATTEMPT_STATUSES = [None, fv.SUCCEEDED, fv.FAILED]
#: Shifts any timestamp's microseconds to at most 18 digits that are not negative.
_EPOCH = 10**17


def _digits(time: str) -> Column:
    return F.coalesce(F.unix_micros(F.col(time).cast("timestamp")) + F.lit(_EPOCH), F.lit(0)).cast("decimal(38,0)")


def _packed(status: str = "status") -> Column:
    """Start, end and status of an attempt as one decimal number, in that order.

    Its maximum is the last attempt. A number is reduced by hash inside the map tasks; a maximum by struct or text would make Spark
    sort all records first.
    """
    code = F.when(F.col(status).isNull(), 0)
    for n, name in enumerate(ATTEMPT_STATUSES[1:], 1):
        code = code.when(F.col(status) == name, n)
    code = code.otherwise(F.raise_error(F.concat(F.lit("unknown status: "), F.col(status))))
    number = _digits("started_at") * F.lit(Decimal(10**19))
    return (number.cast("decimal(38,0)") + (_digits("completed_at") * 10 + code).cast("decimal(20,0)")).cast("decimal(38,0)")


def _unpacked(packed: Column) -> Column:
    """Struct of ``status``, ``started_at`` and ``completed_at``; NULL where nothing was packed."""
    base = F.lit(Decimal(10**19))
    rest = (packed % base).cast("decimal(19,0)")

    def time(digits: Column) -> Column:
        return F.when(digits > 0, F.timestamp_micros(digits.cast("long") - F.lit(_EPOCH)))

    names = F.array(*[F.lit(s).cast("string") for s in ATTEMPT_STATUSES])
    return F.when(packed.isNotNull(), F.struct(
        F.get(names, (rest % 10).cast("int")).alias("status"),
        time(F.call_function("div", packed, base)).alias("started_at"), time(F.call_function("div", rest, F.lit(10))).alias("completed_at")))


def run_outcomes(stage_records: DataFrame) -> DataFrame:
    """One row per run: status, failed stage, error and duration.

    A stage counts by its last attempt. Of several failed stages the one that ended last is
    reported, with its own error. A run has some ten records; they meet once, and are ordered there.
    """
    run = ["run_id", "match_id"]
    whole = Window.partitionBy(*run)
    records = stage_records.repartition(*run).select(
        *run, "stage", "status", "started_at", "completed_at", "error_type", "error_message",
        F.min("started_at").over(whole).alias("first_started_at"), F.max("completed_at").over(whole).alias("last_completed_at"))
    stages = latest(records, [*run, "stage"], F.col("started_at").desc_nulls_last(), F.col("completed_at").desc_nulls_last())
    failed = F.coalesce(F.col("status") == fv.FAILED, F.lit(False))
    runs = latest(stages.withColumn("_failed", failed), run,
                  F.col("_failed").desc(), F.col("completed_at").desc_nulls_last(), F.col("stage").desc())
    return run_durations(runs.select(
        *run, F.col("first_started_at").alias("started_at"), F.when(F.col("_failed"), fv.FAILED).otherwise(fv.SUCCEEDED).alias("status"),
        F.col("last_completed_at").alias("completed_at"),
        *[F.when(F.col("_failed"), F.col(c)).alias(name) for c, name in (
            ("stage", "failed_stage"), ("error_type", "error_type"), ("error_message", "error_message"))]))


def stage_row_flow(stage_records: DataFrame) -> DataFrame:
    """Add ``rows_in``: what the upstream stage of the same run gave out.

    A run has some ten records, so a window over them needs one scan and no join.
    """
    run = Window.partitionBy("run_id")
    given = F.lit(None).cast("long")
    for stage, upstream in fv.UPSTREAM_STAGE.items():
        of_upstream = F.max(F.when(F.col("stage") == upstream, F.col("rows_out"))).over(run)
        given = F.when(F.col("stage") == stage, of_upstream).otherwise(given)
    return stage_records.select("run_id", "match_id", "stage", "status", given.alias("rows_in"), "rows_out")


def run_stage_matrix(stage_records: DataFrame) -> DataFrame:
    """All stages of every run, one row each: the last attempt, or NOT_RUN without a record."""
    attempts = stage_records.withColumn("_packed", _packed())
    runs = attempts.groupBy("run_id", "match_id").agg(*[
        F.max(F.when(F.col("stage") == stage, F.col("_packed"))).alias(stage) for stage in fv.STAGES])
    rows = F.array(*[
        F.struct(F.lit(n).alias("stage_order"), F.lit(stage).alias("stage"), F.col(stage).alias("packed"))
        for n, stage in enumerate(fv.STAGES, 1)
    ])
    last = runs.select("run_id", "match_id", F.inline(rows)).withColumn("last", _unpacked(F.col("packed")))
    return last.select(
        "run_id", "match_id", "stage_order", "stage", F.coalesce("last.status", F.lit(fv.NOT_RUN)).alias("status"),
        *[F.col(f"last.{c}").cast(stage_records.schema[c].dataType).alias(c) for c in ("started_at", "completed_at")],
    )
