import random

import pytest
from tests.llm.cases import awkward, empty, texts, with_clashes
from tests.llm.test_words import plain

from pitchlake.llm import jaccard_join, registry
from pitchlake.llm.components import components


def brute(docs, k, percent):
    """Smallest id of each component, and set sizes, by comparing every pair."""
    sets = {}
    for i, t in docs.items():
        w = plain(t)
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(docs)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in docs}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_whole_table_against_all_pairs(spark, sf_dir):
    assert result(registry.op9_jaccard_join(spark, sf_dir)) == brute(texts(sf_dir), 4, 85)


def varied(seed, groups, size, vocabulary=400):
    """Groups of near copies of very different lengths, with shared passages and frequent words between them."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    docs = {}
    for g in range(groups):
        base = [f"w{int(rng.paretovariate(0.6)) % vocabulary}" for _ in range(rng.choice([1, 2, 3, 5, 8, 12, 20, 60, 150, 460]))]
        if g % 3 == 0:
            base += passage
        for _ in range(rng.randint(1, size)):
            words = list(base)
            for _ in range(rng.randint(0, 1 + len(words) // 40)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            docs[len(docs)] = " ".join(words)
    return docs


@pytest.mark.parametrize("seed,k,percent,frequent", [(1, 4, 85, 64), (2, 5, 80, 3), (3, 1, 70, 4), (4, 2, 85, 2)])
def test_against_all_pairs(spark, monkeypatch, seed, k, percent, frequent):
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "PER_BUCKET", 200)
    monkeypatch.setattr(jaccard_join, "GATHER", 500)
    docs = varied(seed, 25, 12)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    assert result(jaccard_join.similar_groups(df, k=k, percent=percent)) == brute(docs, k, percent)


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(147)]
    docs = {}
    for i in range(300):
        words = list(base)
        for _ in range(rng.randint(0, 8)):
            words[rng.randrange(147)] = f"x{rng.randrange(10**6)}"
        docs[i] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert result(jaccard_join.similar_groups(df, k=4, percent=85)) == brute(docs, 4, 85)


def test_entries_share_one_when_sets_link():
    rng = random.Random(7)
    import numpy as np

    for _ in range(300):
        percent = rng.choice([80, 85, 90])
        n = rng.choice([3, 8, 9, 30, 200, 345, 399, 400, 405, 470])
        x = np.unique(np.array([rng.getrandbits(62) for _ in range(n)], dtype=np.uint64))
        lost = rng.randint(0, jaccard_join.most_missing(len(x), percent))
        y = np.array(sorted(rng.sample(x.tolist(), len(x) - lost)), dtype=np.uint64)
        frequent = rng.random()
        df = {t: jaccard_join.FREQUENT if rng.random() < frequent else 2 for t in x.tolist()}
        made = [jaccard_join.index_entries(len(s), len(s), np.zeros(0, dtype=np.uint64), s, np.array([df[t] for t in s.tolist()]), percent)[0]
                for s in (x, y)]
        if 100 * len(y) >= percent * len(x):
            assert set(made[0].tolist()) & set(made[1].tolist())


def test_awkward_rows(spark):
    docs = with_clashes(awkward(spark), "key", "fp", "n", "entry", "comp", "tokens", "component_id")
    rows = jaccard_join.similar_groups(docs).collect()
    assert len(rows) == 12
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert by_id[1] == [(0, 1)] and by_id[2] == [(0, 2)] and by_id[3] == [(0, 3)] and by_id[4] == [(1, 4)]
    assert by_id[5] == [(1, 5), (1, 5)] and by_id[9] == [(1, 8)] and by_id[7] == [(1, 7)]
    kept = jaccard_join.keep_one_of_each(docs).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert all(r["comp"] == "extra" for r in kept)
    assert jaccard_join.similar_groups(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        jaccard_join.similar_groups(docs, percent=40)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, 101: 100}
    assert components(links.limit(0)).collect() == []


def near_copies(n):
    """One text of 380 words, each copy with words of its own in four places: close to each other, mostly too far to link."""
    rng = random.Random(n)
    base = [f"w{i}" for i in range(380)]
    docs = {}
    for d in range(n):
        words = list(base)
        for place in rng.sample(range(0, 380, 5), 10):
            words[place] = f"x{d}y{place}"
        docs[d] = " ".join(words)
    return docs


def test_pairs_of_a_group_meet_once(spark, monkeypatch):
    """Near misses share hundreds of entries; the last join makes few more rows than there are pairs, and no link is lost."""
    made = {}
    real = jaccard_join.stored

    def counted(df, name):
        out = real(df, name)
        made.setdefault(name, []).append(out)
        return out

    monkeypatch.setattr(jaccard_join, "stored", counted)
    rows = {}
    for n in (80, 160):
        docs = near_copies(n)
        made.clear()
        found = result(jaccard_join.similar_groups(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), k=4, percent=85))
        assert found == brute(docs, 4, 85)
        if "open" not in made:
            continue
        member = made["open"][-1]
        columns = [c for c in member.columns if c != "entry"]
        left, right = (member.select("entry", *[member[c].alias(f"{side}{c}") for c in columns]) for side in ("x_", "y_"))
        pairs = left.join(right, "entry").where("x_fp < y_fp and x_comp <> y_comp")
        every = pairs.count()
        rows[n] = pairs.where(jaccard_join._meet_here("x_", "y_")).count(), pairs.select("x_fp", "y_fp").distinct().count(), every
        assert pairs.where(jaccard_join._meet_here("x_", "y_")).select("x_fp", "y_fp").distinct().count() == rows[n][1]
    assert rows and all(here <= 1.5 * pairs and every > 50 * pairs for here, pairs, every in rows.values())


def test_pairs_of_large_sets_meet_once(spark, monkeypatch):
    """Large sets index single tokens: near misses of a group share many, and meet in one of them."""
    opened, real = [], jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df, name: opened.append((name, real(df, name))) or opened[-1][1])
    rng = random.Random(9)
    base, docs = [f"w{i}" for i in range(900)], {}
    for d in range(80):
        words = list(base)
        for place in rng.sample(range(0, 900, 5), 24):
            words[place] = f"x{d}y{place}"
        docs[d] = " ".join(words)
    found = result(jaccard_join.similar_groups(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), k=4, percent=85))
    assert found == brute(docs, 4, 85)
    member = [df for name, df in opened if name == "open"][-1]
    columns = [c for c in member.columns if c != "entry"]
    left, right = (member.select("entry", *[member[c].alias(f"{side}{c}") for c in columns]) for side in ("x_", "y_"))
    every = left.join(right, "entry").where("x_fp < y_fp and x_comp <> y_comp")
    here, pairs = every.where(jaccard_join._meet_here("x_", "y_")), every.select("x_fp", "y_fp").distinct().count()
    assert here.select("x_fp", "y_fp").distinct().count() == pairs > 1000
    assert here.count() <= 1.1 * pairs and every.count() > 20 * pairs
