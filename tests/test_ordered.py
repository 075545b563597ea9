"""Ordered operators against brute force, with a third of all rows under one key."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from pitchlake.operators.ordered import latest, numbered, rolling, running_totals


pytestmark = pytest.mark.usefixtures("many_blocks")


def skewed(spark, n=900, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        rows.append((key, rng.randrange(10_000), f"id{i:05d}", rng.choice([None, rng.randrange(100)])))
    return rows, spark.createDataFrame(rows, "key string, at int, id string, value int").repartition(7)


def cumulative(rows):
    totals, expected = {}, {}
    for key, _, ident, value in sorted(rows, key=lambda r: (r[1], r[2])):
        running, seen = totals.get(key, (0, False))
        totals[key] = (running + (value or 0), seen or value is not None)
        expected[ident] = totals[key][0] if totals[key][1] else None
    return expected


@pytest.mark.parametrize("by_range", [True, False])
def test_running_totals(spark, by_range):
    rows, df = skewed(spark)
    block = None if by_range else F.floor(F.col("at") / 500)
    out = running_totals(df, ["key"], ["at", "id"], {"total": F.col("value")}, block=block)
    assert out.columns == [*df.columns, "total"]
    got = {r["id"]: r["total"] for r in out.collect()}
    assert got == cumulative(rows)


def test_range_blocks_split_a_hot_key(spark):
    from pitchlake.operators.ordered import range_blocks
    _, df = skewed(spark)
    sizes = range_blocks(df, ["key", "at", "id"]).groupBy("_block").count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 450


def test_numbered(spark):
    rows, df = skewed(spark)
    got = {r["id"]: r["position"] for r in numbered(df, ["at", "id"]).collect()}
    assert got == {r[2]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])), 1)}


@pytest.mark.parametrize("chunk", [10, 64, 50_000])
def test_rolling_median_and_count(spark, chunk):
    rows, _ = skewed(spark)
    filled = [(k, at, i, v or 0) for k, at, i, v in rows]
    df = spark.createDataFrame(filled, "key string, at int, id string, value int")
    out = rolling(df, ["at", "id"], 10, {
        "middle": lambda w: F.percentile("value", F.lit(0.5)).over(w), "n": lambda w: F.count("*").over(w),
    }, chunk=chunk)
    ordered = sorted(filled, key=lambda r: (r[1], r[2]))
    expected = {}
    for n, row in enumerate(ordered):
        before = [r[3] for r in ordered[max(0, n - 10):n]]
        expected[row[2]] = (statistics.median(before) if before else None, len(before))
    assert {r["id"]: (r["middle"], r["n"]) for r in out.collect()} == expected


def test_latest_limits_groups_before_the_shuffle(spark):
    rows, df = skewed(spark)
    out = latest(df, ["key"], F.col("at").desc(), F.col("id").desc())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")
    best = {}
    for key, at, ident, _ in rows:
        best[key] = max(best.get(key, (-1, "")), (at, ident))
    assert {r["key"]: (r["at"], r["id"]) for r in out.collect()} == best


def test_timeline_of_a_match_longer_than_a_block(spark):
    """One match holds most shots and spans several blocks of event_index."""
    from pitchlake.plans.reports import TIMELINE_BLOCK, xg_timeline
    n = 4 * TIMELINE_BLOCK
    shots = spark.range(1, n + 1).where("id % 7 = 0 OR id < 20").selectExpr(
        "if(id < 20, 2L, 1L) AS match_id", "if(id % 2 = 0, 'A', 'B') AS team_name", "int(id) AS event_index",
        "string(id) AS event_id", "int(id % 90) AS minute", "0 AS second", "true AS is_shot",
        "(id * 29 % 1000) / 1000D AS shot_xg", "if(id % 5 = 0, 'Goal', 'Saved') AS outcome").repartition(5)
    totals, starts = {}, 0
    rows = xg_timeline(shots).orderBy("match_id", "team_name", "event_index").collect()
    for r in rows:
        group = (r["match_id"], r["team_name"])
        if r["event_index"] == 0:
            starts += 1
            totals[group] = 0.0
        totals[group] += r["shot_xg"]
        assert r["cumulative_xg"] == pytest.approx(totals[group], abs=1e-6)
    assert starts == 4 and len(rows) == shots.count() + 4


def test_checkpoint_folder_is_that_of_the_session(monkeypatch):
    from pitchlake import session

    class Context:
        master, folder = "yarn", None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Spark:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Spark)
    Spark.conf = {"spark.checkpoint.dir": "hdfs:///shared"}
    assert session.checkpoint_dir(Spark) == "hdfs:///shared" == Spark.sparkContext.folder


def test_merged_blocks_give_the_same(spark):
    rows, df = skewed(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    out = running_totals(df, ["key"], ["at", "id"], {"total": F.col("value")})
    assert {r["id"]: r["total"] for r in out.collect()} == cumulative(rows)
