"""Several writers, compaction, expiry and reads by match of the commit store."""

import threading

import pytest
from pyspark.sql import functions as F

from pitchlake.plans import commits
from pitchlake.plans.commits import CommitConflict, CommitStore
from pitchlake.sources import claims


@pytest.fixture
def store(spark, tmp_path):
    return CommitStore(spark, str(tmp_path / "store"))


def rows(spark, version, *ids, n=3):
    """``n`` rows per match, that tell who wrote them."""
    return spark.createDataFrame([(i, version, k) for i in ids for k in range(n)], "match_id long, source_version int, k int")


def state(store, as_of=None, **options):
    return {(r["match_id"], r["source_version"]): r["count"]
            for r in store.read(as_of, **options).groupBy("match_id", "source_version").count().collect()}


def together(*jobs):
    """Run jobs in threads of their own that start at once; their results or errors."""
    barrier, found = threading.Barrier(len(jobs)), [None] * len(jobs)

    def run(k):
        barrier.wait()
        try:
            found[k] = jobs[k]()
        except Exception as error:  # the test looks at it
            found[k] = error

    threads = [threading.Thread(target=run, args=(k,)) for k in range(len(jobs))]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    return found


def test_a_name_is_claimed_once(spark, tmp_path):
    won = together(*[lambda k=k: claims.claim(spark, str(tmp_path / "log"), "7.json", f"by {k}") for k in range(8)])
    assert sorted(won) == [False] * 7 + [True]
    assert (tmp_path / "log" / "7.json").read_text() == f"by {won.index(True)}"
    assert list(claims.names(spark, str(tmp_path / "log"))) == ["7.json"]
    assert claims.names(spark, str(tmp_path / "nothing")) == {}


def test_disjoint_writers_both_count(spark, store):
    store.commit(rows(spark, 1, 1, 2), "start")
    found = together(*[lambda k=k: store.commit(rows(spark, 2, 10 + k), f"w{k}", based_on=1) for k in range(4)])
    assert sorted(found) == [2, 3, 4, 5]
    assert state(store) == {(1, 1): 3, (2, 1): 3, **{(10 + k, 2): 3 for k in range(4)}}
    assert {r["commit_key"] for r in store.commits().collect()} == {"start", "w0", "w1", "w2", "w3"}


def test_overlapping_writers_one_is_refused(spark, store):
    store.commit(rows(spark, 1, 1, 2, 3), "start")
    found = together(lambda: store.commit(rows(spark, 2, 1, 2), "x", based_on=1), lambda: store.commit(rows(spark, 3, 2, 3), "y", based_on=1))
    refused = [e for e in found if isinstance(e, CommitConflict)]
    assert len(refused) == 1 and refused[0].matches == [2] and 2 in found
    winner = found.index(2)
    expected = [{(1, 2): 3, (2, 2): 3, (3, 1): 3}, {(1, 1): 3, (2, 3): 3, (3, 3): 3}][winner]
    assert state(store) == expected and state(store, 1) == {(i, 1): 3 for i in (1, 2, 3)}
    # the refused one starts again from what is there now
    assert store.commit(rows(spark, 4, 2), "xy"[1 - winner]) == 3
    assert state(store)[(2, 4)] == 3


def test_the_same_key_twice_at_once_counts_once(spark, store):
    found = together(lambda: store.commit(rows(spark, 1, 1), "same"), lambda: store.commit(rows(spark, 1, 1), "same"))
    assert found == [1, 1] and state(store) == {(1, 1): 3} and store.commits().count() == 1


def test_a_commit_based_on_an_old_state_is_refused(spark, store):
    store.commit(rows(spark, 1, 1), "a")
    store.commit(rows(spark, 2, 1), "b")
    with pytest.raises(CommitConflict, match=r"\[1\]"):
        store.commit(rows(spark, 3, 1), "late", based_on=1)
    assert state(store) == {(1, 2): 3} and store.last() == 2


def history(spark, store):
    store.commit(rows(spark, 1, *range(1, 9)), "k1")
    store.commit(rows(spark, 2, 2, 3), "k2", check=lambda w: w.where("match_id = 3").select("match_id"))  # 3 is held back
    store.commit(rows(spark, 3, 4, n=5), "k3", matches=spark.createDataFrame([(4,), (5,)], "match_id long"))  # 5 goes
    store.commit(rows(spark, 4, 20), "k4")
    return [state(store, n) for n in range(1, 5)]


@pytest.mark.parametrize("small_rows", [1, 10_000])
def test_compaction_changes_no_state(spark, store, small_rows):
    states = history(spark, store)
    assert store.compact(small_rows=small_rows, live_share=0.7) == 4
    assert [state(store, n) for n in range(1, 5)] == states and state(store) == states[-1]
    folders = {f.rsplit("/", 2)[1] for f in store.read().inputFiles()}
    assert len(folders) == (1 if small_rows > 1 else 3)  # 15 of 24 and 3 of 6 rows are current in the first two
    assert store.published("k2") == 2 and store.commit(rows(spark, 9, 2), "k2") == 2
    assert store.compact() == 4  # nothing new
    store.commit(rows(spark, 5, 1, 20), "k5")
    after = {**states[-1], (1, 5): 3, (20, 5): 3}
    del after[(1, 1)], after[(20, 4)]
    assert state(store) == after and state(store, 4) == states[-1]
    store.compact(small_rows=small_rows)
    assert state(store) == after and [state(store, n) for n in range(1, 5)] == states
    assert store.commits().count() == 5


def test_reads_of_many_commits_list_few_folders(spark, store):
    for k in range(1, 25):
        store.commit(rows(spark, k, k, 100), f"k{k}")
        if k % 6 == 0:
            store.compact(small_rows=1000)
    assert state(store) == {**{(k, k): 3 for k in range(1, 25)}, (100, 24): 3}
    store.commit(rows(spark, 25, 25), "k25")
    assert len({f.rsplit("/", 2)[1] for f in store.read().inputFiles()}) == 2
    assert state(store, 17) == {**{(k, k): 3 for k in range(1, 18)}, (100, 17): 3}


def test_expiry_keeps_what_is_asked_for(spark, store, tmp_path):
    states = history(spark, store)
    store.compact(small_rows=10_000)
    store.commit(rows(spark, 5, 1), "k5")
    rows(spark, 9, 1).write.parquet(f"{store.path}/data/part=left-behind")
    last = state(store)
    assert store.expire(keep_from=3) == []  # no base before it, nothing can go, and the folder left behind is young
    removed = store.expire(keep_from=4)
    assert {r.split("/")[0] for r in removed} == {"data", "files", "matches"} and "data/part=left-behind" not in removed
    assert len(list((tmp_path / "store" / "data").iterdir())) == 3
    assert (state(store), state(store, 5), state(store, 4)) == (last, last, states[-1])
    with pytest.raises(ValueError, match="older than what is kept"):
        store.read(3)
    assert store.commits().count() == 5 and store.published("k1") == 1
    assert "data/part=left-behind" in store.expire(keep_from=4, grace_seconds=0)
    assert store.commit(rows(spark, 6, 2), "k6") == 6 and state(store)[(2, 6)] == 3


def test_a_writer_and_a_compaction_at_once(spark, store):
    history(spark, store)
    found = together(lambda: store.commit(rows(spark, 5, 1), "k5"), lambda: store.compact(small_rows=10_000), lambda: store.compact(small_rows=10_000))
    assert found[0] == 5 and set(found[1:]) <= {4, 5}
    assert state(store) == {(1, 5): 3, (2, 2): 3, (3, 1): 3, (4, 3): 5, (6, 1): 3, (7, 1): 3, (8, 1): 3, (20, 4): 3}


def test_reads_by_match_open_few_files(spark, store):
    many = spark.range(1, 401).select(F.col("id").alias("match_id"), F.lit(1).alias("source_version"), F.explode(F.array(*map(F.lit, range(4)))).alias("k"))
    store.commit(many.repartitionByRange(40, "match_id"), "a")
    store.commit(rows(spark, 2, 7, 300).coalesce(1), "b")
    one = spark.createDataFrame([(7,)], "match_id long")
    found = store.read(matches=one)
    assert len(found.inputFiles()) == 1 and state(store, matches=one) == {(7, 2): 3}
    assert state(store, 1, matches=one) == {(7, 1): 4} and len(store.read(1, matches=one).inputFiles()) == 1
    store.compact(small_rows=100_000, file_rows=50)
    assert len(store.read(matches=one).inputFiles()) == 1 and state(store, matches=one) == {(7, 2): 3}
    assert len(store.read().inputFiles()) > 20
    none = spark.createDataFrame([(9999,)], "match_id long")
    assert store.read(matches=none).collect() == [] and store.read(matches=none).columns == store.read().columns


def test_very_many_files_are_read_as_folders(spark, store, monkeypatch):
    store.commit(rows(spark, 1, *range(20)).repartitionByRange(10, "match_id"), "a")
    monkeypatch.setattr(commits, "FILES", 2)
    wanted = spark.createDataFrame([(i,) for i in range(0, 20, 2)], "match_id long")
    assert state(store, matches=wanted) == {(i, 1): 3 for i in range(0, 20, 2)}


def test_empty_store_and_empty_commit(spark, store):
    assert store.last() == 0 and store.published("x") is None and store.commits().collect() == []
    with pytest.raises(ValueError, match="no commit"):
        store.read()
    assert store.commit(rows(spark, 1, 1).limit(0), "empty") == 1
    assert store.read().collect() == [] and store.compact() == 1 and store.read().collect() == []


def test_a_match_of_many_rows_spans_files(spark, store):
    hot = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).cast("long").alias("match_id"),
                                   F.lit(1).alias("source_version"), F.col("id").alias("k"))
    store.commit(hot.where("match_id = 5"), "a")
    store.commit(hot.where("match_id <> 5"), "b")
    store.compact(file_rows=200)
    held = store.read().where("match_id = 5").select(F.input_file_name()).distinct().count()
    assert held > 3 and store.read().count() == 4000
