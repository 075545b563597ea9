"""The serving copy's swap, and SQL with bound parameters."""

import threading

import pytest

from pitchlake import registry
from pitchlake.plans import marts
from pitchlake.plans.serving import STATEMENTS, ServingCopy, ask


def rows(spark, version, *ids):
    return spark.createDataFrame([(i, version, k) for i in ids for k in range(3)], "match_id long, version int, k int")


def versions(df):
    return {(r["match_id"], r["version"]) for r in df.distinct().collect()}


def test_readers_see_one_state(spark, tmp_path):
    """A reader that began before a replacement goes on with the old state; at no time is there a mixture."""
    copy = ServingCopy(spark, str(tmp_path / "copy"))
    assert copy.replace_matches(rows(spark, 1, 1, 2)) == 6
    copy.register("served")
    before = copy.read()
    seen, stop = [], threading.Event()

    def watch():
        while not stop.is_set():
            seen.append(frozenset(versions(copy.read())))

    watcher = threading.Thread(target=watch)
    watcher.start()
    assert copy.replace_matches(rows(spark, 2, 1, 2)) == 6
    stop.set()
    watcher.join()
    assert set(seen) <= {frozenset({(1, 1), (2, 1)}), frozenset({(1, 2), (2, 2)})}
    assert versions(before) == versions(spark.table("served")) == {(1, 1), (2, 1)}
    copy.register("served")
    assert versions(spark.table("served")) == {(1, 2), (2, 2)}
    one = spark.createDataFrame([(2,)], "match_id long")
    assert versions(copy.read(one)) == {(2, 2)}
    copy.tidy(grace_seconds=0)
    assert versions(copy.read()) == {(1, 2), (2, 2)}


def test_writers_of_one_match_all_get_through(spark, tmp_path):
    copy = ServingCopy(spark, str(tmp_path / "copy"))
    copy.replace_matches(rows(spark, 0, 1, 2))
    threads = [threading.Thread(target=copy.replace_matches, args=(rows(spark, v, 1),)) for v in (1, 2, 3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    found = versions(copy.read())
    assert copy.store.last() == 4 and len(found) == 2 and (2, 0) in found and found - {(2, 0)} <= {(1, v) for v in (1, 2, 3)}


@pytest.mark.parametrize("name", STATEMENTS)
def test_bound_parameters(spark, sf_dir, name):
    enriched = registry._enriched(spark, sf_dir)
    enriched.createOrReplaceTempView("team_match_enriched")
    make = getattr(marts, name)
    some = enriched.where("team_name IS NOT NULL").select("team_name", "season_name").first()
    for team, season in ((None, None), (some[0], None), (some[0], some[1]), ("x' OR '1' = '1", None)):
        expected, found = make(enriched, team, season), ask(spark, name, team, season)
        assert sorted(map(str, found.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
    assert ask(spark, name, "x' OR '1' = '1").count() == 0 and ask(spark, name).count() > 0
