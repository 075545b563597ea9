"""The kept volume monitor against the full computation."""

import random
from datetime import datetime, timedelta

import pytest

from pitchlake import fixed_values as fv
from pitchlake.plans import observability
from pitchlake.plans.volume_state import VolumeMonitor

SCHEMA = "match_id long, stage string, status string, completed_at timestamp, stage_run_id string, rows_out long"


def run(n, rows=None, minute=None, stage="SILVER", status=fv.SUCCEEDED):
    at = datetime(2024, 1, 1) + timedelta(minutes=n if minute is None else minute)
    return (n % 7, stage, status, at, f"run-{n:04d}", 1000 + (n * 37) % 400 if rows is None else rows)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def monitor(spark, tmp_path):
    return VolumeMonitor(spark, str(tmp_path / "volume"))


def test_appends_read_ten_runs_besides_their_own(spark, monitor):
    rows = [run(n) for n in range(60)]
    read = []
    for first in range(0, 60, 15):
        counts = monitor.append(frame(spark, rows[first : first + 15]), f"a{first}")
        assert counts["added"] == 15 and counts["again"] == 0
        read.append(counts["read"])
        assert plain(monitor.read()) == plain(observability.silver_volume_monitor(frame(spark, rows[: first + 15])))
    assert read == [0, fv.BASELINE_RUNS, fv.BASELINE_RUNS, fv.BASELINE_RUNS]
    assert monitor.append(frame(spark, rows[:3]), "a0") == {"added": 0, "read": 0, "again": 0}


def test_late_runs_change_their_neighbours_only(spark, monitor):
    rows = [run(n, minute=2 * n) for n in range(120)]
    monitor.append(frame(spark, rows), "start")
    late = [run(500, 9000, minute=81), run(501, 5, minute=85), run(502, minute=400)]
    counts = monitor.append(frame(spark, late), "late")
    # two runs between the late ones and ten behind; ten before; the halo for the one that is not late
    assert counts == {"added": 3, "read": 10 + 2 + 10 + 10, "again": 12}
    assert plain(monitor.read()) == plain(observability.silver_volume_monitor(frame(spark, rows + late)))
    again = [run(503, 4000, minute=239), run(504, minute=0, rows=3)]
    monitor.append(frame(spark, again), "more")
    assert plain(monitor.read()) == plain(observability.silver_volume_monitor(frame(spark, rows + late + again)))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival(spark, monitor, seed):
    rng = random.Random(seed)
    rows = [run(n, rng.randrange(100, 3000), minute=rng.randrange(40)) for n in range(60)]
    rng.shuffle(rows)
    cuts = sorted(rng.sample(range(1, 60), 3))
    for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, 60])):
        monitor.append(frame(spark, rows[a:b]), f"b{n}")
    assert plain(monitor.read()) == plain(observability.silver_volume_monitor(frame(spark, rows)))


def test_other_stages_failures_and_nothing(spark, monitor):
    assert monitor.read().collect() == []
    skipped = [run(1, stage="BRONZE"), run(2, status=fv.FAILED), (1, "SILVER", fv.SUCCEEDED, datetime(2024, 1, 1), "x", None)]
    assert monitor.append(frame(spark, skipped), "none")["added"] == 0 and monitor.read().collect() == []
    untimed = (1, "SILVER", fv.SUCCEEDED, None, "early", 50)
    monitor.append(frame(spark, [run(n) for n in range(12)]), "some")
    monitor.append(frame(spark, [untimed]), "untimed")
    assert plain(monitor.read()) == plain(observability.silver_volume_monitor(frame(spark, [*[run(n) for n in range(12)], untimed])))
