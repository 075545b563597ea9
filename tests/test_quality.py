"""Each rule fires on exactly the row that breaks it."""

import pytest
from pyspark.sql import functions as F

from pitchlake import schemas
from pitchlake.operators import checks
from pitchlake.plans import gold, marts, quality
from tests import matches


@pytest.fixture(scope="module")
def good(spark):
    first = matches.served(spark, schemas.SILVER, 1)
    return first.unionByName(matches.served(spark, schemas.SILVER, 2)).cache()


MUTATIONS = {  # rule: event of match 2, column, new value
    "event_id_missing": (1, "event_id", None),
    "event_id_duplicated": (2, "event_id", "e1"),
    "event_type_missing": (1, "event_type", None),
    "start_x_out_of_range": (1, "start_x", 105.1),
    "start_y_out_of_range": (1, "start_y", -0.1),
    "shot_xg_out_of_range": (5, "shot_xg", 1.01),
    "completed_not_pass": (6, "is_completed_pass", True),
    "progressive_not_completed": (3, "is_progressive_pass", True),
    "progressive_below_threshold": (1, "progress_ratio", 0.24),
    "move_without_xt": (1, "xt_end", None),
}


@pytest.mark.parametrize("rule", list(MUTATIONS))
def test_one_broken_row_breaks_one_rule(good, rule):
    index, column, value = MUTATIONS[rule]
    here = (F.col("match_id") == 2) & (F.col("event_index") == index)
    broken = good.withColumn(column, F.when(here, F.lit(value)).otherwise(F.col(column)))
    found = quality.silver_violations(broken).collect()
    expected = {(2, rule, 1)}
    if rule == "progressive_not_completed":
        # That row also has a ratio below the threshold.
        expected.add((2, "progressive_below_threshold", 1))
    assert {tuple(r) for r in found} == expected
    kept = quality.quarantine(broken, quality.silver_violations(broken)).select("match_id").distinct().collect()
    assert [r["match_id"] for r in kept] == [1]


def test_bounds_and_nulls_pass(good):
    edge = good.withColumn("start_x", F.when(F.col("event_index") == 1, 0.0).when(
        F.col("event_index") == 2, 105.0).otherwise(F.lit(None)))
    assert quality.silver_violations(edge).collect() == []


def test_contract():
    from pyspark.sql import types as T
    assert quality.contract_errors(schemas.SILVER) == []
    changed = T.StructType(
        [f for f in schemas.SILVER.fields if f.name not in ("team_id", "minute")]
        + [T.StructField("minute", T.StringType()), T.StructField("extra", T.StringType())])
    assert quality.contract_errors(changed) == ["minute: expected integer, got string", "missing column: team_id"]
    assert quality.unexpected_columns(changed) == ["extra"]


@pytest.mark.parametrize("fact, dim, expected", [
    ([1, 2, None], [1, 2], set()),
    ([1], [1, 2], {(2, "missing_from_fact")}),
    ([1, 99], [1], {(99, "unknown_in_fact")}),
])
def test_fact_dim_references(spark, fact, dim, expected):
    def ids(values):
        return spark.createDataFrame([(v,) for v in values], "match_id long")
    assert {tuple(r) for r in quality.fact_dim_references(ids(fact), ids(dim)).collect()} == expected


def test_reconciliation_sees_both_sides(good):
    stored = good.where("NOT (match_id = 2 AND event_index = 1)").unionByName(
        good.where("match_id = 2 AND event_index = 2").withColumn("event_id", F.lit("new")))
    rows = {r["match_id"]: r for r in quality.reconcile_bronze_silver(good, stored).collect()}
    assert rows[1]["reconciled"] and not rows[2]["reconciled"]
    assert (rows[2]["bronze_rows"], rows[2]["silver_rows"]) == (13, 13)
    assert (rows[2]["missing_ids"], rows[2]["unexpected_ids"]) == (1, 1)
    bad = quality.reconciliation_violations(quality.reconcile_bronze_silver(good, stored)).collect()
    assert [(r["match_id"], r["n"]) for r in bad] == [(2, 2)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prints_shuffle_sums_and_no_ids(good):
    exchanges = [line for line in plan(quality.set_prints(good, good)).splitlines() if "Exchange" in line]
    assert len(exchanges) == 1 and "hashpartitioning(match_id" in exchanges[0] and "event_id" not in exchanges[0]
    agreeing, ids = quality.compared_matches(good, good)
    assert ids is None and all(r["reconciled"] for r in agreeing.collect()) and agreeing.count() == 2


def test_prints_do_not_depend_on_order_but_on_number(spark):
    def ids(*values, match_id=1):
        return spark.createDataFrame([(match_id, v) for v in values], "match_id long, event_id string")

    def same(left, right):
        return [r["same"] for r in quality.set_prints(left, right).collect()] == [True]

    assert same(ids("a", "b", None), ids(None, "b", "a")) and same(ids("a", "a", "b"), ids("b", "a", "a"))
    # what exclusive ors alone, or sets alone, would not see
    assert not same(ids("a", "a", "b"), ids("b", "c", "c")) and not same(ids("a", "a", "b"), ids("a", "b", "b"))
    assert not same(ids("a"), ids("a", "a", "a")) and not same(ids("a"), ids(None)) and not same(ids("a"), ids("a", match_id=2))


def test_levels_give_the_rows_of_the_exact_comparison(good, spark):
    stored = good.where("NOT (match_id = 2 AND event_index < 3)").unionByName(good.where("match_id = 2 AND event_index = 5"))
    extra = good.limit(3).withColumn("match_id", F.lit(None).cast("long"))
    both = good.unionByName(extra), stored.unionByName(extra.withColumn("event_id", F.concat("event_id", F.lit("x"))))
    expected = quality.reconciled_ids(quality.compared_ids(*both))
    found = quality.reconcile_bronze_silver(*both)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.select(found.columns).collect())) and found.count() == 3
    suspects = spark.createDataFrame([(1,)], "match_id long")
    _, ids = quality.compared_matches(good, good, suspects)
    assert {r["match_id"] for r in ids.collect()} == {1}


def test_gold_reconciles_with_silver_and_gaps_show(good):
    team = gold.fact_gold_team(good)
    assert quality.reconcile_gold_team(team, good).collect() == []
    assert quality.reconcile_gold_team(team.where("team_id = 21"), good).count() == 2
    off = team.withColumn("xg", F.col("xg") + F.when(F.col("match_id") == 1, 1e-5).otherwise(1e-7))
    assert {r["match_id"] for r in quality.reconcile_gold_team(off, good).collect()} == {1}


def test_gold_rules_hold_on_good_data(spark, good):
    team, intervals = gold.fact_gold_team(good), gold.fact_gold_intervals(good)
    dim = spark.createDataFrame([
        (m, None, None, 2, "League", 281, "2023/2024", 1, 21, "Foundry", 22, "Meadow", None, None) for m in (1, 2)
    ], schemas.DIM_MATCH).withColumn("match_date", F.lit("2024-04-23").cast("date"))
    enriched = marts.team_match_enriched(team, dim)
    assert {(r["team_name"], r["venue"], r["opponent"]) for r in enriched.collect()} == {
        ("Foundry", "Home", "Meadow"), ("Meadow", "Away", "Foundry")}
    for found in (
        quality.gold_team_invariants(team), quality.interval_boundaries(intervals), quality.net_xt(intervals),
        quality.gold_ranges(team, intervals), quality.gold_not_null(team, intervals, enriched),
        quality.gold_unique(team, intervals), checks.rows_per_match(team, 2, "x"),
        checks.rows_per_match(intervals, 40, "x"), checks.relationships(team, dim, "x"),
        checks.accepted_values(enriched, "venue", ["Home", "Away"]),
    ):
        assert found.collect() == []
    summary = marts.team_season_summary(enriched, "Foundry", "2023/2024").collect()
    assert [(r["matches"], r["goals"], r["shots"]) for r in summary] == [(2, 2, 6)]
    assert marts.match_by_match(enriched, "Foundry", "none").count() == 0
    venue = marts.team_home_away_summary(enriched, "Meadow", "2023/2024").collect()
    assert [(r["venue"], r["matches"], r["goals_per_match"]) for r in venue] == [("Away", 2, 0.0)]


def test_dim_match_must_be_present_and_unambiguous(spark):
    dim = spark.createDataFrame([], schemas.DIM_MATCH)
    with pytest.raises(ValueError, match="empty"):
        quality.require_dim_match(dim)
    with pytest.raises(ValueError, match="missing columns"):
        quality.require_dim_match(dim.drop("referee"))
    row = (1, None, None, 2, "L", 1, "S", 1, 1, "A", 2, "B", None, None)
    with pytest.raises(ValueError, match="duplicated"):
        quality.require_dim_match(spark.createDataFrame([row, row], schemas.DIM_MATCH))
    assert quality.require_dim_match(spark.createDataFrame([row], schemas.DIM_MATCH)).count() == 1
