import random

import pytest
from pyspark.sql import functions as F

from pitchlake import schemas
from pitchlake.operators.keyed import upsert
from pitchlake.plans import gold, incremental
from pitchlake.plans.commits import CommitStore
from tests import matches



def register(arrivals, manifest):
    return incremental.register_artifacts(arrivals, manifest, "test", F.lit("2024-01-01T00:00:00"))


def as_versions(df):
    return {(r["match_id"], r["file_hash"]): r["source_version"] for r in df.collect()}


@pytest.mark.usefixtures("many_blocks")
def test_versions_follow_first_arrivals_also_for_a_hot_match(spark):
    rng = random.Random(5)
    rows = []
    for n in range(600):
        match = 1 if n % 3 == 0 else rng.randrange(2, 9)
        rows.append((match, f"h{rng.randrange(60)}", n))
    early, late = rows[:250], rows[200:]
    empty = spark.createDataFrame([], schemas.MANIFEST)
    columns = "match_id long, file_hash string, arrival long"
    first = register(spark.createDataFrame(early, columns).repartition(5), empty)
    both = first.unionByName(register(spark.createDataFrame(late, columns).repartition(5), first))

    expected, counts = {}, {}
    for match, content, _ in rows:
        if (match, content) not in expected:
            counts[match] = counts.get(match, 0) + 1
            expected[(match, content)] = counts[match]
    assert as_versions(both) == expected
    again = register(spark.createDataFrame(rows, columns), both)
    assert again.count() == 0
    ids = [r["ingestion_id"] for r in both.select("ingestion_id").collect()]
    assert len(set(ids)) == len(expected)


def test_upsert_inserts_and_overwrites(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "match_id long, referee string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "match_id long, referee string")
    assert {tuple(r) for r in upsert(old, new, ["match_id"]).collect()} == {(1, "a"), (2, "B"), (3, "c")}


@pytest.fixture
def store(spark, tmp_path):
    return CommitStore(spark, str(tmp_path / "silver"))


def events(spark, *ids, version=1):
    frames = [matches.served(spark, schemas.SILVER, i).withColumn("source_version", F.lit(version)) for i in ids]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def state(store, as_of=None):
    return {(r["match_id"], r["source_version"]): r["count"]
            for r in store.read(as_of).groupBy("match_id", "source_version").count().collect()}


def test_commits_replace_matches_and_pins_stay(spark, store):
    assert store.commit(events(spark, 1, 2), "a") == 1
    assert state(store) == {(1, 1): 13, (2, 1): 13}
    revised = events(spark, 2, 3, version=2).where("event_index > 3")
    assert store.commit(revised, "b") == 2
    assert state(store) == {(1, 1): 13, (2, 2): 10, (3, 2): 10}
    assert state(store, as_of=1) == {(1, 1): 13, (2, 1): 13}
    # The same key again: same commit, same state.
    assert store.commit(revised, "b") == 2
    assert state(store) == {(1, 1): 13, (2, 2): 10, (3, 2): 10}
    assert store.commits().count() == 2


def test_a_published_key_changes_nothing(spark, store):
    store.commit(events(spark, 1), "a")
    store.commit(events(spark, 1, version=2), "b")
    before = (state(store), state(store, as_of=1), store.commits().collect())
    assert store.commit(events(spark, 1, 2, version=7), "a") == 1
    assert (state(store), state(store, as_of=1), store.commits().collect()) == before


def test_reads_only_the_folders_of_visible_commits(spark, store):
    store.commit(events(spark, 1), "a")
    store.commit(events(spark, 2), "b")
    first, second = ({f.rsplit("/", 2)[1] for f in store.read(as_of=n).inputFiles()} for n in (1, 2))
    assert len(first) == 1 and len(second) == 2 and first < second


def test_unpublished_data_is_not_seen(spark, store):
    store.commit(events(spark, 1), "a")
    # As left behind by a commit that failed after writing its data.
    events(spark, 1, version=9).write.parquet(f"{store.path}/data/part=left-behind")
    assert state(store) == {(1, 1): 13}
    assert store.commit(events(spark, 1, version=2), "b") == 2
    assert state(store) == {(1, 2): 13}


def test_held_back_match_keeps_its_former_version(spark, store):
    store.commit(events(spark, 1, 2), "a")

    def check(written):
        return written.where("match_id = 2").select("match_id").distinct()

    store.commit(events(spark, 1, 2, 3, version=2), "b", check=check)
    assert state(store) == {(1, 2): 13, (2, 1): 13, (3, 2): 13}


def dim(spark):
    rows = [(i, None, None, 2, "League", 281, "S", 1, i, f"Home {i}", 9, "Away", None, None) for i in range(1, 9)]
    return spark.createDataFrame(rows, schemas.DIM_MATCH).withColumn(
        "match_date", F.date_sub(F.lit("2024-02-01").cast("date"), F.col("match_id").cast("int")))


def test_discovery_and_scope(spark):
    ingested = spark.createDataFrame([(8,), (3,)], "match_id long")
    found = incremental.discover_new_matches(dim(spark), ingested).collect()
    assert [r["match_id"] for r in found] == [7, 6, 5, 4, 2]
    scope = incremental.bulk_scope(dim(spark), ingested, 2, 281, " Home 4 ")
    assert [r["match_id"] for r in scope.collect()] == [4]
    assert incremental.bulk_scope(dim(spark), ingested, 2, 281, "Away").count() == 6
    assert incremental.bulk_scope(dim(spark), ingested, 2, 281, "  ").count() == 6
    with pytest.raises(ValueError, match="No matches"):
        incremental.require_scope(incremental.bulk_scope(dim(spark), ingested, 2, 281, "Nobody"))


def test_rebuild_changes_only_touched_matches_and_leaves_no_stale_team(spark):
    old = gold.fact_gold_team(events(spark, 1, 2))
    revised = events(spark, 1, 2, version=2).where("NOT (match_id = 2 AND team_id = 22)")
    out = incremental.rebuild_gold_team(old, revised, incremental.match_ids(spark, [2]))
    assert {(r["match_id"], r["team_id"], r["source_version"]) for r in out.collect()} == {
        (1, 21, 1), (1, 22, 1), (2, 21, 2)}


def test_backfill_list(spark):
    team, intervals = incremental.backfill(events(spark, 1, 2, 3), incremental.match_ids(spark, [1, 3]))
    assert (team.count(), intervals.count()) == (4, 80)
    with pytest.raises(ValueError, match="empty"):
        incremental.match_ids(spark, [])


def test_large_key_sets_take_the_other_way(spark, store, monkeypatch):
    from pitchlake.operators import keyed
    monkeypatch.setattr(keyed, "BROADCAST_KEYS", 0)
    store.commit(events(spark, 1, 2), "a")
    store.commit(events(spark, 2, 3, version=2).where("event_index > 3"), "b")
    assert state(store) == {(1, 1): 13, (2, 2): 10, (3, 2): 10}
    assert state(store, as_of=1) == {(1, 1): 13, (2, 1): 13}
