import json

import pytest
from pyspark.sql import functions as F

from pitchlake import fixed_values as fv, schemas
from pitchlake.plans import bronze, gold, quality, reports, silver
from pitchlake.sources import raw
from tests import matches


@pytest.fixture(scope="module")
def bronze_df(spark, tmp_path_factory):
    folder = matches.land(tmp_path_factory.mktemp("landing"))
    artifacts = raw.read_artifacts(spark, folder)
    lineage = artifacts.select(
        "match_id", F.lit("test_provider").alias("provider"), F.lit(1).alias("source_version"), "file_hash",
        F.lit("test-1").alias("ingestion_id"), F.lit("2026-08-09T00:00:00+00:00").alias("ingested_at"),
    )
    return bronze.to_bronze(bronze.with_lineage(artifacts, lineage)).cache()


@pytest.fixture(scope="module")
def mock(bronze_df):
    return silver.to_silver(bronze_df, matches.MOCK_GRID).cache()


def test_bronze_has_its_columns_and_keeps_payload(bronze_df):
    assert bronze_df.columns == schemas.BRONZE.fieldNames()
    assert [f.dataType for f in bronze_df.schema] == [f.dataType for f in schemas.BRONZE]
    rows = {r["event_index"]: r for r in bronze_df.collect()}
    assert len(rows) == 17
    assert json.loads(rows[13]["event_payload_json"]) == matches.event(matches.EVENTS[12])
    assert rows[13]["player_name"] == "Tomás Vidal"
    assert rows[1]["player_id"] is None and rows[1]["location_x_raw"] is None
    assert rows[2]["related_events_json"] == '["event-1", "event-3"]'
    assert rows[12]["related_events_json"] == "null"
    assert rows[16]["timestamp"] == "00:91:05.000"


GOLDEN = {  # index: gain, ratio, progressive, columns of the grid from and to (the middle line is in row 4)
    2: (19.25, 19.25 / 68.25, True, (4, 6)),
    4: (7.0, 1 / 7, False, (6, 7)),
    5: (21.0, 0.25, False, None),
    6: (13.15, 13.15 / 14, False, None),
    8: (-7.0, -0.125, False, (5, 4)),
    9: (21.0, 0.5, True, (7, 9)),
    12: (21.0, 1 / 3, True, (4, 7)),
    13: (10.5, 1.0, False, None),
    14: (-5.25, -0.1875, False, (8, 8)),
    15: (17.6, 17.6 / 21, False, None),
    16: (21.0, 3 / 7, True, (6, 8)),
}


@pytest.mark.parametrize("grid", ["mock", "real"])
def test_silver_golden(bronze_df, mock, grid):
    df = mock if grid == "mock" else silver.to_silver(bronze_df)
    assert df.columns == schemas.SILVER.fieldNames() and quality.contract_errors(df.schema) == []
    rows = {r["event_index"]: r for r in df.collect()}
    assert len(rows) == 17 and len({r["event_id"] for r in rows.values()}) == 17
    assert sum(r["is_progressive_pass"] for r in rows.values()) == 4
    values = (matches.MOCK_GRID if grid == "mock" else fv.XT_GRID)[4]
    for index, row in rows.items():
        gain, ratio, progressive, move = GOLDEN.get(index, (None, None, False, None))
        assert row["progress_toward_goal_m"] == (gain if gain is None else pytest.approx(gain, abs=1e-6))
        assert row["progress_ratio"] == (ratio if ratio is None else pytest.approx(ratio, abs=1e-6))
        assert row["is_progressive_pass"] == progressive
        expected = None if move is None else values[move[1]] - values[move[0]]
        assert row["xt_added"] == (expected if expected is None else pytest.approx(expected, abs=1e-9))
    assert (rows[2]["start_x"], rows[2]["start_y"]) == (36.75, 34.0)
    assert rows[6]["end_y"] == pytest.approx(34.85)


def test_one_pass_and_two_step_silver_agree(spark, bronze_df, mock, tmp_path):
    artifacts = raw.read_artifacts(spark, matches.land(tmp_path)).select(
        *[bronze_lineage(c) for c in raw.LINEAGE_COLUMNS], "content")
    direct = silver.to_silver(bronze.to_events(artifacts), matches.MOCK_GRID)
    assert direct.exceptAll(mock).count() == 0 and mock.exceptAll(direct).count() == 0


def bronze_lineage(column):
    constants = {
        "provider": F.lit("test_provider"), "source_version": F.lit(1), "ingestion_id": F.lit("test-1"),
        "ingested_at": F.lit("2026-08-09T00:00:00+00:00"),
    }
    return constants.get(column, F.col(column)).alias(column)


def test_no_violations_and_reconciled(bronze_df, mock):
    assert quality.silver_violations(mock).collect() == []
    assert [r["reconciled"] for r in quality.reconcile_bronze_silver(bronze_df, mock).collect()] == [True]


def test_team_golden(mock):
    rows = {r["team_name"]: r for r in gold.fact_gold_team(mock).collect()}
    n, k = rows["Northgate"], rows["Lakeside"]
    assert (n["shots"], n["goals"], n["attempted_passes"], n["completed_passes"]) == (2, 0, 3, 3)
    assert (n["progressive_passes"], n["carries"], n["pass_completion_pct"]) == (3, 1, 100.0)
    assert n["xg"] == pytest.approx(0.2)
    assert (k["shots"], k["goals"], k["xg"], k["attempted_passes"], k["completed_passes"]) == (1, 1, 0.4, 3, 2)
    assert (k["progressive_passes"], k["carries"]) == (1, 1)
    assert k["pass_completion_pct"] == pytest.approx(200 / 3)


def test_interval_golden(mock):
    check_intervals(mock, {
        ("Northgate", 1, "0-5"): (0.03, 0, 2, 0, 0),
        ("Northgate", 1, "20-25"): (0, 0, 0, 1, 0.15),
        ("Northgate", 1, "45+"): (0.02, 0, 1, 0, 0),
        ("Northgate", 2, "80-85"): (0, 0, 0, 1, 0.05),
        ("Northgate", 2, "90+"): (0.02, 0, 1, 0, 0),
        ("Lakeside", 1, "30-35"): (0, -0.01, 1, 0, 0),
        ("Lakeside", 2, "50-55"): (0.03, 0, 1, 0, 0),
        ("Lakeside", 2, "55-60"): (0, 0, 0, 1, 0.4),
        ("Lakeside", 2, "70-75"): (0, 0, 1, 0, 0),
    })


def check_intervals(silver_df, expected):
    rows = gold.fact_gold_intervals(silver_df).collect()
    assert len(rows) == 40
    labels = {t: [r["interval_label"] for r in rows if r["team_name"] == t] for t in {r["team_name"] for r in rows}}
    assert all(sorted(found) == sorted(fv.INTERVAL_ORDER) for found in labels.values())
    for r in rows:
        wanted = expected.get((r["team_name"], r["period"], r["interval_label"]), (0, 0, 0, 0, 0))
        got = (r["positive_xt"], r["negative_xt"], r["successful_moves"], r["shots"], r["xg"])
        assert got == pytest.approx(wanted, abs=1e-9), r
        assert r["net_xt"] == pytest.approx(wanted[0] + wanted[1], abs=1e-9)


def test_served_match_golden(spark):
    events = matches.served(spark, schemas.SILVER)
    team = {r["team_name"]: r for r in gold.fact_gold_team(events).collect()}
    f, m = team["Foundry"], team["Meadow"]
    assert (f["shots"], f["goals"], f["attempted_passes"], f["completed_passes"]) == (3, 1, 3, 2)
    assert (f["progressive_passes"], f["carries"]) == (1, 2)
    assert f["pass_completion_pct"] == pytest.approx(200 / 3) and f["xg"] == pytest.approx(0.6)
    assert (m["shots"], m["goals"], m["xg"], m["attempted_passes"], m["completed_passes"]) == (0, 0, None, 3, 2)
    assert (m["progressive_passes"], m["carries"]) == (1, 2)
    check_intervals(events, {
        ("Foundry", 1, "0-5"): (0.05, 0, 1, 0, 0),
        ("Foundry", 1, "5-10"): (0, -0.03, 1, 0, 0),
        ("Foundry", 1, "10-15"): (0.02, 0, 1, 0, 0),
        ("Foundry", 1, "25-30"): (0, 0, 0, 1, 0.42),
        ("Foundry", 1, "45+"): (0.01, 0, 1, 0, 0),
        ("Foundry", 2, "60-65"): (0, 0, 0, 1, 0.07),
        ("Foundry", 2, "70-75"): (0, 0, 0, 1, 0.11),
        ("Meadow", 1, "0-5"): (0.03, 0, 1, 0, 0),
        ("Meadow", 1, "10-15"): (0.04, 0, 1, 0, 0),
        ("Meadow", 2, "80-85"): (0.06, 0, 1, 0, 0),
        ("Meadow", 2, "90+"): (0, -0.02, 1, 0, 0),
    })


def test_teams_with_varying_names_stay_one_row(spark):
    """Group-first-then-max must not split a team whose name changed within a match."""
    events = matches.served(spark, schemas.SILVER).withColumn(
        "team_name", F.when((F.col("team_id") == 21) & (F.col("event_index") == 2), "Foundry FC")
        .otherwise(F.col("team_name")))
    team = gold.fact_gold_team(events).where("team_id = 21").collect()
    assert len(team) == 1 and team[0]["team_name"] == "Foundry FC" and team[0]["attempted_passes"] == 3
    intervals = gold.fact_gold_intervals(events).where("team_id = 21").collect()
    assert len(intervals) == 20 and sum(r["successful_moves"] for r in intervals) == 4


def test_slots_off_the_spine_are_left_out_but_the_team_is_kept(spark):
    events = matches.served(spark, schemas.SILVER).withColumn(
        "minute", F.when(F.col("period") == 2, 10).otherwise(F.col("minute")))
    rows = gold.fact_gold_intervals(events).collect()
    assert len(rows) == 40 and all(0 <= r["interval_start"] <= 45 for r in rows)
    assert sum(r["shots"] for r in rows) == 1


def test_xg_timeline_golden(mock):
    rows = reports.xg_timeline(mock).where("team_name = 'Northgate'").orderBy("event_index").collect()
    got = [(r["match_minute"], r["cumulative_xg"]) for r in rows]
    wanted = [(0, 0), (21 + 5 / 60, 0.15), (80.5, 0.2)]
    assert len(got) == len(wanted)
    for point, golden in zip(got, wanted):
        assert point == pytest.approx(golden)


def test_shot_map(mock):
    points = {r["event_id"]: r for r in reports.shot_map_points(mock).collect()}
    assert points["event-13"]["is_goal"] and points["event-13"]["marker_size"] == pytest.approx(540)
    assert not points["event-6"]["is_goal"]
    totals = {r["team_name"]: (r["shots"], r["goals"], r["total_xg"]) for r in reports.shot_map_totals(mock).collect()}
    assert totals == {"Northgate": (2, 0, pytest.approx(0.2)), "Lakeside": (1, 1, pytest.approx(0.4))}


def test_match_summary_and_momentum(mock):
    lines = {r["metric"]: r for r in reports.match_summary(gold.fact_gold_team(mock)).collect()}
    assert len(lines) == 6 and all(r["teams"] == 2 for r in lines.values())
    assert (lines["xG"]["team_a"], lines["xG"]["text_a"], lines["xG"]["text_b"]) == ("Lakeside", "0.40", "0.20")
    assert (lines["Pass completion"]["text_a"], lines["Pass completion"]["text_b"]) == ("66.7%", "100.0%")
    assert (lines["Goals"]["text_a"], lines["Goals"]["text_b"]) == ("1", "0")
    bars = reports.xt_momentum(gold.fact_gold_intervals(mock)).collect()
    assert len(bars) == 40
    shown = {(r["team_rank"], r["interval_label"]): r["shown_xt"] for r in bars}
    assert shown[(2, "0-5")] == pytest.approx(-0.03) and shown[(1, "50-55")] == pytest.approx(0.03)
    assert {r["display_order"] for r in bars} == set(range(20))


def test_reports_of_matches_without_two_teams(spark, mock):
    team, intervals = gold.fact_gold_team(mock), gold.fact_gold_intervals(mock)
    one = reports.match_summary(team.where("team_name = 'Northgate'")).collect()
    assert len(one) == 6 and all((r["team_a"], r["team_b"], r["value_b"], r["teams"]) == ("Northgate", None, None, 1) for r in one)
    bars = reports.xt_momentum(intervals.where("team_name = 'Northgate'")).collect()
    assert len(bars) == 20 and {r["team_rank"] for r in bars} == {1}
    third = lambda df: df.unionByName(df.where("team_name = 'Northgate'").withColumns(
        {"team_id": F.lit(13).cast("long"), "team_name": F.lit("Middling")}))
    three = reports.match_summary(third(team)).collect()
    assert len(three) == 6 and all((r["team_a"], r["team_b"], r["teams"]) == ("Lakeside", "Northgate", 3) for r in three)
    ranks = {(r["team_name"], r["team_rank"]) for r in reports.xt_momentum(third(intervals)).collect()}
    assert ranks == {("Lakeside", 1), ("Middling", 2), ("Northgate", 3)}


def test_report_inputs_of_a_one_sided_match(mock):
    team = gold.fact_gold_team(mock).where("team_name = 'Northgate'")
    intervals = gold.fact_gold_intervals(mock).where("interval_label <> '0-5'")
    found = {r["rule"]: r["n"] for r in reports.input_violations(team, intervals, mock.where("NOT is_shot")).collect()}
    assert found == {"not_two_teams": 1, "missing_intervals": 2, "no_shots": 1}


def test_orientation_flags_mirrored_shots(mock):
    from pitchlake.plans.profiles import orientation
    mirrored = mock.withColumn("start_x", F.lit(105.0) - F.col("start_x"))
    assert not any(r["suspicious"] for r in orientation(mock).collect())
    assert all(r["suspicious"] for r in orientation(mirrored).collect())
