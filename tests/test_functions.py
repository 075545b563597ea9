import random

import pytest
from pyspark.sql import functions as F

from pitchlake import fixed_values as fv
from pitchlake.functions import intervals, pitch, text, xt
from tests.matches import MOCK_GRID


def test_cells_of_corners_and_random_points(spark):
    rng = random.Random(3)
    points = [(0.0, 0.0), (105.0, 68.0), (-3.0, 90.0), (1e300, -1e300)]
    points += [(rng.uniform(-5, 110), rng.uniform(-5, 75)) for _ in range(500)]
    df = spark.createDataFrame(points, "x double, y double")
    for r in df.select("x", "y", xt.grid_col(F.col("x")).alias("c"), xt.grid_row(F.col("y")).alias("r")).collect():
        assert r["c"] == min(max(int(r["x"] / 105 * 12), 0), 11)
        assert r["r"] == min(max(int(r["y"] / 68 * 8), 0), 7)


def test_threat_of_a_forward_move(spark):
    df = spark.createDataFrame([(10.0, 10.0, 100.0, 60.0), (10.0, 10.0, None, 60.0)], "a double, b double, c double, d double")
    start, end = xt.grid_value(MOCK_GRID, F.col("a"), F.col("b")), xt.grid_value(MOCK_GRID, F.col("c"), F.col("d"))
    rows = df.select((end - start).alias("added")).collect()
    assert rows[0]["added"] == pytest.approx(0.10) and rows[1]["added"] is None


@pytest.mark.parametrize("grid, message", [
    (MOCK_GRID[:7], "row count"), ([row[:11] for row in MOCK_GRID], "column count"),
])
def test_grid_shape_is_checked(spark, tmp_path, grid, message):
    import json
    with pytest.raises(ValueError, match=message):
        xt.check_grid(grid)
    (tmp_path / "grid.json").write_text(json.dumps(grid))
    with pytest.raises(ValueError, match=message):
        xt.read_grid(spark, str(tmp_path / "grid.json"))


def test_grid_file_round_trip(spark, tmp_path):
    import json
    (tmp_path / "grid.json").write_text(json.dumps(fv.XT_GRID, indent=1))
    long = xt.read_grid(spark, str(tmp_path / "grid.json"))
    assert long.count() == 96
    assert xt.grid_from_frame(long) == fv.XT_GRID
    assert max(v for row in fv.XT_GRID for v in row) == 0.25745362


@pytest.mark.parametrize("start, end, completed, sign, progressive", [
    ((30.0, 50.0), (70.0, 50.0), True, 1, True),
    ((70.0, 34.0), (50.0, 34.0), True, -1, False),
    ((30.0, 50.0), (70.0, 50.0), False, 1, False),
    ((105.0, 34.0), (70.0, 34.0), True, None, False),
    ((None, 34.0), (70.0, 34.0), True, None, False),
])
def test_progression(spark, start, end, completed, sign, progressive):
    df = spark.createDataFrame(
        [(*start, *end, completed)], "x double, y double, x2 double, y2 double, done boolean"
    ).selectExpr("done", f"{pitch.goal_distance('x', 'y')} AS s", f"{pitch.goal_distance('x2', 'y2')} AS t")
    ratio = pitch.progress_ratio("s", "t")
    row = df.selectExpr(
        f"{pitch.distance_gained('s', 't')} AS gain", f"{ratio} AS ratio",
        f"{pitch.is_progressive('done', ratio)} AS progressive",
    ).first()
    assert row["progressive"] == progressive
    if sign is None:
        assert row["gain"] is None and row["ratio"] is None
    else:
        assert row["gain"] * sign > 0 and row["ratio"] * sign > 0


def test_every_minute_falls_into_its_interval(spark):
    df = spark.range(0, 130).selectExpr("int(id) AS minute", "explode(array(1, 2)) AS period")
    minute, period = F.col("minute"), F.col("period")
    stoppage = intervals.is_stoppage(period, minute)
    start = intervals.interval_start(intervals.period_minute(period, minute), stoppage)
    rows = df.select("minute", "period", start.alias("start"), stoppage.alias("stoppage"),
                     intervals.interval_label(period, start, stoppage).alias("label")).collect()
    for r in rows:
        m, p = r["minute"], r["period"]
        late = m >= (45 if p == 1 else 90)
        inner = m if p == 1 else m - 45
        assert r["stoppage"] == late
        assert r["start"] == (45 if late else int(inner / 5) * 5)
        if late:
            assert r["label"] == ("45+" if p == 1 else "90+")
        elif inner >= 0:
            low = r["start"] + (0 if p == 1 else 45)
            assert r["label"] == f"{low}-{low + 5}" and low <= m < low + 5 and r["label"] in fv.INTERVAL_ORDER


def test_json_list_matches_python(spark):
    import json
    lists = [["a", "b"], [], None, ['q"uote', "[x]", "]", "[", "é", "back\\slash"], [None, "x"]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, v array<string>")
    got = {r["i"]: r["t"] for r in df.select("i", text.json_list("v").alias("t")).collect()}
    assert got == {i: json.dumps(v, ensure_ascii=False) for i, v in enumerate(lists)}


def test_trim_to_null(spark):
    df = spark.createDataFrame([(" Team 1 ",), ("   ",), (None,)], "t string")
    assert [r[0] for r in df.select(text.trim_to_null(F.col("t"))).collect()] == ["Team 1", None, None]


def test_only_one_complete_grid_is_taken(spark):
    cells = [("v", r, c, 0.5) for r in range(8) for c in range(12)]

    def frame(rows):
        return spark.createDataFrame(rows, xt.GRID_SCHEMA)

    assert xt.grid_from_frame(frame(cells)) == [[0.5] * 12] * 8
    other = [("w", *cell[1:]) for cell in cells]
    for rows in (cells[1:], cells + [("v", 8, 0, 0.5)], cells + other, cells[1:] + cells[1:2], cells[1:] + [("v", 0, 0, None)]):
        with pytest.raises(ValueError, match="96 cells"):
            xt.grid_from_frame(frame(rows))
