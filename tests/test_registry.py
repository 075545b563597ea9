"""Every registered query against its SQL on the smallest tables, and the shape of some plans."""

import re
from collections import Counter

import pytest

import __spark_entry__ as entry_point
from pitchlake import registry, registry_sql, schemas
from pitchlake.plans import quality, reports, silver
from pitchlake.sources import driver_tables as tables
from tests import matches

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}
QUERIES, ORACLE = registry.QUERIES, registry_sql.ORACLE


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    kinds = {c[0]: str(c[1]) for c in result.description}
    assert {n: TYPES[t] for n, t in df.dtypes} == kinds
    names = sorted(columns)
    positions = [columns.index(n) for n in names]
    expected = Counter(tuple(repr(row[p]) for p in positions) for row in result.fetchall())
    assert Counter(tuple(repr(row[n]) for n in names) for row in df.collect()) == expected


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "fact_gold_team", "fact_gold_intervals", "interval_spine", "team_match_enriched", "silver_pinned_read",
    "dq_silver", "reconcile_bronze_silver", "xg_timeline", "xt_momentum", "discover_new_matches", "xt_lookup",
    "gold_incremental", "run_stage_matrix", "stage_row_flow", "match_summary", "orientation_check",
])
def test_no_cross_join_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|MapInPandas", text)


@pytest.mark.parametrize("name", ["fact_gold_team", "fact_gold_intervals"])
def test_events_are_read_once_and_combined_by_hash(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert text.count("FileScan") == 1
    # Two shuffles of reduced rows; one more spreads the small test table over the cores.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 3
    # The map-side combine of the events, last in the text, needs no sort.
    assert re.findall(r"(\w+Aggregate)\(", text)[-1] == "HashAggregate"


@pytest.fixture
def no_spread(monkeypatch):
    """Large tables are not spread over the cores after the scan; plans are judged without that."""
    monkeypatch.setattr(tables, "_spread", lambda df, key: df)


def test_momentum_reads_once(spark, sf_dir, no_spread):
    text = plan(QUERIES["xt_momentum"](spark, sf_dir))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_timeline_shares_one_exchange(spark, sf_dir, no_spread):
    df = QUERIES["xg_timeline"](spark, sf_dir)
    df.collect()
    text = plan(df)
    final = text[:text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text
    assert final.count("FileScan") == 1


@pytest.mark.parametrize("name", ["run_stage_matrix", "stage_row_flow", "run_outcomes"])
def test_run_views_read_once(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_row_rules_shuffle_one_row_per_match(spark, sf_dir):
    text = plan(quality.silver_violations(registry._silver(spark, sf_dir)))
    assert set(re.findall(r"(\w+Aggregate)\(", text)) == {"HashAggregate"}


def test_silver_is_one_stage(spark, sf_dir):
    text = plan(silver.to_silver(registry._events(spark, sf_dir)))
    assert len(re.findall("Exchange", text)) == 1 and text.count("from_json") == 1


def test_report_read_is_pruned_and_pushed_down(spark, tmp_path):
    path = str(tmp_path / "silver")
    matches.served(spark, schemas.SILVER).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    text = plan(reports.report_input(spark.read.parquet(path), "silver", 2002))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [IsNotNull(match_id), EqualTo(match_id,2002)]" in text
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == set(reports.REPORT_COLUMNS["silver"])
    assert reports.report_input(spark.read.parquet(path), "silver", 2002).count() == 13


def test_adapter_makes_no_cross_match_arrays(spark, sf_dir):
    rows = tables.raw_artifacts(spark, sf_dir)
    assert rows.count() == tables.table(spark, sf_dir, "events").count()


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() == 2 and df.columns[0] == "match_id"
