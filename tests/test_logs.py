from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pitchlake import fixed_values as fv, schemas
from pitchlake.plans import observability
from pitchlake.sources import logs, matches as match_source, raw, tables


def test_absent_log_is_empty_or_an_error(spark, tmp_path):
    path = str(tmp_path / "none")
    assert logs.read_manifest(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        logs.read_manifest(spark, path, require_exists=True)


def test_blank_lines_are_skipped_and_ids_are_distinct(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.json").write_text('{"match_id": 1}\n\n{"match_id": 1}\n{"match_id": 2}\n')
    manifest = logs.read_manifest(spark, str(tmp_path / "m"))
    assert manifest.count() == 3 and manifest.columns == schemas.MANIFEST.fieldNames()
    assert {r["match_id"] for r in logs.ingested_match_ids(manifest).collect()} == {1, 2}


def test_stage_attempts_are_recorded(spark, tmp_path):
    path = str(tmp_path / "runs")
    with logs.observe_stage(spark, path, "BRONZE", match_id=5, try_number=1) as seen:
        seen["rows_out"] = 18
    with pytest.raises(KeyError):
        with logs.observe_stage(spark, path, "SILVER", match_id=5, try_number=2) as seen:
            seen["rows_in"] = 18
            raise KeyError("event_id")
    rows = {r["stage"]: r for r in logs.read_log(spark, path, schemas.STAGE_RUN).collect()}
    assert (rows["BRONZE"]["status"], rows["BRONZE"]["rows_out"], rows["BRONZE"]["error_type"]) == ("SUCCEEDED", 18, None)
    assert (rows["SILVER"]["status"], rows["SILVER"]["rows_in"], rows["SILVER"]["error_type"]) == ("FAILED", 18, "KeyError")
    assert rows["SILVER"]["completed_at"] >= rows["SILVER"]["started_at"]


def test_task_events(spark, tmp_path):
    path = str(tmp_path / "events")
    records = [
        logs.task_event(fv.TASK_RETRY, ValueError("x"), task_id="silver", airflow_run_id="r", match_id=1, try_number=n)
        for n in (1, 2)
    ] + [logs.task_event(fv.DAG_FAILED, dag_id="d", airflow_run_id="r", match_id=1)]
    logs.append_records(spark, records, path, schemas.TASK_EVENT)
    summary = observability.retry_summary(logs.read_log(spark, path, schemas.TASK_EVENT)).collect()
    assert [(r["airflow_run_id"], r["task_id"], r["match_id"], r["retry_counts"]) for r in summary] == [("r", "silver", 1, 2)]
    with pytest.raises(ValueError):
        logs.task_event("OTHER")


def runs(spark, rows):
    """stage, status, try_number, minutes, rows_out"""
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    data = []
    for n, (stage, status, attempt, minutes, rows_out) in enumerate(rows):
        values = dict.fromkeys(schemas.STAGE_RUN.fieldNames())
        values.update(stage_run_id=f"{n:03d}", match_id=n, stage=stage, status=status, try_number=attempt,
                      completed_at=start + timedelta(minutes=minutes), duration_seconds=1.0, rows_out=rows_out)
        data.append(tuple(values.values()))
    return spark.createDataFrame(data, schemas.STAGE_RUN)


def test_no_runs_is_healthy(spark):
    row = observability.current_health(runs(spark, [])).first()
    assert tuple(row) == ("HEALTHY", 0, 0, 0)


def test_health_signals(spark):
    silver = [("SILVER", "SUCCEEDED", 1, n, 100) for n in range(10)]
    sick = silver + [("SILVER", "SUCCEEDED", 1, 10, 160), ("BRONZE", "FAILED", 1, 5, None), ("BRONZE", "SUCCEEDED", 2, 6, 1)]
    df = runs(spark, sick)
    monitor = observability.silver_volume_monitor(df).orderBy("completed_at").collect()
    assert [r["volume_status"] for r in monitor] == ["INSUFFICIENT_HISTORY"] * 10 + ["HIGH_VOLUME"]
    assert monitor[0]["baseline_rows"] is None and monitor[10]["deviation_ratio"] == pytest.approx(1.6)
    newest = observability.newest_volume_health(df).collect()
    full = observability.silver_volume_health(df).orderBy(F.col("completed_at").desc()).limit(1).collect()
    assert newest == full
    assert {(r["stage"], r["health_status"]) for r in observability.recent_stage_health(df).collect()} == {
        ("SILVER", "HEALTHY"), ("BRONZE", "WARNING")}
    assert [(r["component"], r["reason"]) for r in observability.alert_candidates(df).collect()] == [
        ("SILVER_VOLUME", "HIGH_VOLUME")]
    assert tuple(observability.current_health(df).first()) == ("WARNING", 0, 2, 0)


def test_zero_baseline_is_normal(spark):
    df = runs(spark, [("SILVER", "SUCCEEDED", 1, n, 0) for n in range(11)])
    last = observability.silver_volume_monitor(df).orderBy(F.col("completed_at").desc()).first()
    assert (last["deviation_ratio"], last["volume_status"]) == (None, "NORMAL")


def test_stage_volume_history_of_one_stage(spark):
    df = runs(spark, [("SILVER", "SUCCEEDED", 1, 1, 5), ("BRONZE", "SUCCEEDED", 1, 2, 6), ("SILVER", "FAILED", 1, 3, 7)])
    assert [r["rows_out"] for r in observability.stage_volume_history(df).collect()] == [5, 6]
    assert [r["rows_out"] for r in observability.stage_volume_history(df, "SILVER").collect()] == [5]


def test_views_and_serving_tables(spark, tmp_path):
    logs.register_health_views(spark, *[str(tmp_path / n) for n in "abc"])
    assert spark.table("airflow_pipeline_stage_runs").count() == 0
    data = spark.createDataFrame([(1, "a"), (2, "b")], "match_id long, name string")
    path = str(tmp_path / "served")
    assert tables.replace_matches(data, path) == 2
    assert tables.replace_matches(data.where("match_id = 2").withColumn("name", F.lit("c")), path) == 1
    tables.register_serving_views(spark, fact_team_match=path)
    found = spark.sql("SELECT name FROM fact_team_match WHERE match_id = :m", args={"m": 2}).collect()
    assert [r["name"] for r in found] == ["c"]
    assert spark.table("fact_team_match").count() == 2


def test_match_list(spark, tmp_path):
    (tmp_path / "m.json").write_text(
        '[{"match_id": 1, "match_date": "2024-04-23", "kick_off": "20:00:00.000", "match_week": 3,'
        ' "competition": {"competition_id": 2, "competition_name": "L"}, "season": {"season_id": 4, "season_name": "S"},'
        ' "home_team": {"home_team_id": 1, "home_team_name": "A"},'
        ' "away_team": {"away_team_id": 2, "away_team_name": "B"}, "stadium": {"name": "X"}}]')
    dim = match_source.to_dim_match(match_source.read_match_list(spark, str(tmp_path / "m.json")))
    assert dim.columns == schemas.DIM_MATCH.fieldNames()
    row = dim.first()
    assert (row["match_id"], str(row["match_date"]), row["stadium"], row["referee"]) == (1, "2024-04-23", "X", None)
    (tmp_path / "part.json").write_text('[{"match_id": 1, "match_date": "2024-04-23", "home_team": {"home_team_id": 1}}]')
    with pytest.raises(ValueError, match="away_team.*competition.*season"):
        match_source.read_match_list(spark, str(tmp_path / "part.json"))
    (tmp_path / "empty.json").write_text("[]")
    with pytest.raises(ValueError, match="No matches"):
        match_source.read_match_list(spark, str(tmp_path / "empty.json"))
    with pytest.raises(ValueError, match="season_id"):
        match_source.require_columns(dim.drop("season_id"), ["season_id"], "match list")


def test_latest_file(spark, tmp_path):
    import os
    for n, name in enumerate(["a.parquet", "b.parquet", "c.txt"]):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (1_700_000_000 + 60 * (n % 2), 1_700_000_000 + 60 * (n % 2)))
    assert raw.latest_file(spark, str(tmp_path), "*.parquet").endswith("b.parquet")
    with pytest.raises(FileNotFoundError):
        raw.latest_file(spark, str(tmp_path), "*.json")


def test_run_outcomes_are_kept_as_pipeline_runs(spark, tmp_path):
    """One failed and one complete run; later stages of the failed one were not run."""
    from pitchlake.operators.ordered import latest
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [("ok", 1, stage, "SUCCEEDED", at + timedelta(minutes=n), at + timedelta(minutes=n, seconds=30), 10 + n, None, None)
            for n, stage in enumerate(fv.STAGES)]
    rows += [("bad", 2, "INGEST", "SUCCEEDED", at, at + timedelta(seconds=5), 7, None, None),
             ("bad", 2, "BRONZE", "FAILED", at, at + timedelta(seconds=9), None, "ValueError", "broken")]
    records = spark.createDataFrame(rows, "run_id string, match_id long, stage string, status string, started_at timestamp,"
                                    " completed_at timestamp, rows_out long, error_type string, error_message string")
    path = str(tmp_path / "runs")
    logs.append_log(observability.run_outcomes(records), path, schemas.PIPELINE_RUN)
    runs = {r["run_id"]: r for r in logs.read_log(spark, path, schemas.PIPELINE_RUN).collect()}
    assert (runs["bad"]["status"], runs["bad"]["failed_stage"], runs["bad"]["error_message"]) == ("FAILED", "BRONZE", "broken")
    assert (runs["ok"]["status"], runs["ok"]["failed_stage"], runs["ok"]["duration_seconds"]) == ("SUCCEEDED", None, 330.0)
    matrix = {(r["run_id"], r["stage"]): r["status"] for r in observability.run_stage_matrix(records).collect()}
    assert len(matrix) == 12 and matrix["bad", "BRONZE"] == "FAILED" and matrix["bad", "SILVER"] == "NOT_RUN"
    flow = {(r["run_id"], r["stage"]): r["rows_in"] for r in observability.stage_row_flow(records).collect()}
    assert flow["ok", "GOLD_TEAM"] == flow["ok", "GOLD_INTERVAL"] == 12 and flow["ok", "INGEST"] is None
    assert flow["bad", "BRONZE"] == 7 and flow["ok", "REPORTS"] is None
    assert latest(records, ["run_id"], F.col("started_at").desc()).count() == 2


def test_retried_and_repeatedly_failing_stages(spark):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)

    def row(run, stage, status, start, error=None, message=None, rows=None):
        begun = at + timedelta(minutes=start)
        return (run, 1, stage, status, begun, begun + timedelta(seconds=20), rows, error, message)

    records = spark.createDataFrame([
        row("mended", "BRONZE", "FAILED", 0, "ValueError", "once"), row("mended", "BRONZE", "SUCCEEDED", 1, rows=5),
        row("mended", "SILVER", "SUCCEEDED", 2, rows=4),
        row("broken", "SILVER", "FAILED", 0, "ValueError", "a silver"), row("broken", "GOLD_TEAM", "FAILED", 1, "KeyError", "z gold"),
    ], "run_id string, match_id long, stage string, status string, started_at timestamp, completed_at timestamp,"
       " rows_out long, error_type string, error_message string")
    runs = {r["run_id"]: r for r in observability.run_outcomes(records).collect()}
    assert (runs["mended"]["status"], runs["mended"]["failed_stage"], runs["mended"]["duration_seconds"]) == ("SUCCEEDED", None, 140.0)
    broken = runs["broken"]
    assert (broken["failed_stage"], broken["error_type"], broken["error_message"]) == ("GOLD_TEAM", "KeyError", "z gold")
    matrix = observability.run_stage_matrix(records).collect()
    assert len(matrix) == 12 == len({(r["run_id"], r["stage"]) for r in matrix})
    assert {(r["stage"], r["status"]) for r in matrix if r["run_id"] == "mended" and r["status"] != "NOT_RUN"} == {
        ("BRONZE", "SUCCEEDED"), ("SILVER", "SUCCEEDED")}
    flow = [(r["run_id"], r["stage"], r["rows_in"]) for r in observability.stage_row_flow(records).collect()]
    assert len(flow) == 5 and ("mended", "SILVER", 5) in flow
