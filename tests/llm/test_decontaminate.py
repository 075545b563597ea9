import random

import numpy as np
from tests.llm.cases import awkward, empty, texts, with_clashes

from pitchlake.llm import decontaminate, registry

ITEMS = "item_id long, text string"


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = (np.array([rng.randrange(6) for _ in range(rng.randint(1, 40))], dtype=np.uint64) for _ in range(2))
        assert decontaminate.common_subsequence(a, b) == longest_common(a.tolist(), b.tolist())


def test_whole_table_finds_every_verbatim_item(spark, sf_dir, duck):
    found = {(r["doc_id"], r["item_id"]) for r in registry.op3_decontamination(spark, sf_dir).collect()}
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    verbatim = {(d, i) for d, t in texts(sf_dir).items() for i, x in items if x in t}
    assert verbatim and verbatim <= found
    # nothing else than what shares most of an item's words in order
    plain = lambda t: "".join(c if c.isalnum() or ord(c) > 127 else " " for c in t).lower().split()
    text = dict(items)
    for d, i in found - verbatim:
        w = plain(text[i])
        assert longest_common(w, plain(texts(sf_dir)[d])) >= 0.5 * len(w)


def world(spark, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, f"{text(14)}? {text(6)}.") for i in range(30)]
    docs = {i: text(200) for i in range(60)}
    return rng, items, docs


def test_paraphrases_need_the_answer(spark):
    rng, items, docs = world(spark)
    question, answer = items[4][1].split("? ")
    some = [w for k, w in enumerate(question.split()) if k % 5 != 0]
    docs[100] = docs[1] + " " + items[3][1] + " " + docs[2]
    docs[101] = docs[3] + " " + " filler ".join([" ".join(some), answer]) + " " + docs[4]
    docs[102] = docs[5] + " " + " ".join(some) + " " + docs[6]  # the question's words, but no answer
    docs[103] = "short " + items[7][1].upper()
    found = decontaminate.find_leaks(
        spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(items, ITEMS))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(100, 3), (101, 4), (103, 7)}


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rng, items, docs = world(spark)
    for i in range(30):
        docs[200 + i] = docs[i] + " " + items[i][1]
    df, bench = spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    expected = {(200 + i, i) for i in range(30)}
    for size in (500, 7):
        monkeypatch.setattr(decontaminate, "ITEMS", size)
        assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(df, bench).collect()} == expected


def test_items_in_a_third_of_the_rows(spark):
    rng, items, docs = world(spark)
    foreign = lambda n: " ".join(f"x{rng.randrange(5000)}" for _ in range(n))
    leaky = f"{foreign(100)} {items[3][1]} {foreign(100)}"
    expected = set()
    for i in range(30):
        docs[100 + i] = f"{foreign(40)} {items[i][1]} {foreign(40)}"
        expected.add((100 + i, i))
    for i in range(90):  # copies, and one item in as many different documents
        docs[200 + i], docs[300 + i] = leaky, f"{foreign(60)} {items[5][1]} {foreign(60)}"
        expected |= {(200 + i, 3), (300 + i, 5)}
    found = decontaminate.find_leaks(
        spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(items, ITEMS))
    found = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert not expected - found, f"{len(expected - found)} of {len(expected)} lost"
    assert found == expected


def test_short_items_in_a_table_of_30_gb(spark, monkeypatch):
    rng, items, docs = world(spark)
    foreign = lambda n: " ".join(f"x{rng.randrange(5000)}" for _ in range(n))
    items = [(i, t if i % 2 else " ".join(t.split()[8:])) for i, t in items]  # of 20 and of 12 words
    expected = set()
    for i, t in items:
        question, answer = t.split("? ")
        words = question.split()
        words[1::4] = [f"y{k}" for k in range(len(words[1::4]))]
        for k in range(4):  # at different places in their passages
            docs[1000 + 10 * i + k] = f"{foreign(50 + 7 * k)} {t} {foreign(80)}"
            docs[1005 + 10 * i + k] = f"{foreign(50 + 7 * k)} {' '.join(words)} {answer} {foreign(80)}"
            expected |= {(1000 + 10 * i + k, i), (1005 + 10 * i + k, i)}
    counted = decontaminate._document_frequencies

    def many(documents, *rest):
        df, n = counted(documents, *rest)
        return df * (15_000_000 // n), 15_000_000

    monkeypatch.setattr(decontaminate, "_document_frequencies", many)
    found = decontaminate.find_leaks(
        spark.createDataFrame(list(docs.items()), "doc_id long, text string"), spark.createDataFrame(items, ITEMS))
    found = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert not expected - found, f"{len(expected - found)} of {len(expected)} lost"
    assert found == expected


def test_awkward_rows(spark):
    items = spark.createDataFrame(
        [(0, None), (1, ""), (2, "two words"), (3, "the same row twice"), (4, "the same row twice"), (5, "long " * 30)], ITEMS)
    docs = with_clashes(awkward(spark), "item_id", "cosine", "term", "n", "part")
    found = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect())
    assert found == [(5, 3), (5, 4), (7, 5)]
    assert decontaminate.find_leaks(empty(spark), items).collect() == []
    assert decontaminate.find_leaks(docs, items.limit(0)).collect() == []


def test_frequencies_count_every_document(spark, monkeypatch):
    rng, items, docs = world(spark)
    word = items[0][1].split()[0]
    for i in range(60):
        docs[100 + i] = docs[i]  # copies count once
        docs[200 + i] = f"x{i} y{i} {word} z{i}"
    docs |= {300: f"u1 u2 u3 {items[3][1]} u4", 301: None, 302: "", 303: "?."}  # an item's words beside each other don't count
    monkeypatch.setattr(decontaminate, "SAMPLE", 10, raising=False)
    counted, found = decontaminate._document_frequencies, []

    def recorded(*args):
        found.append(counted(*args))
        return found[-1]

    monkeypatch.setattr(decontaminate, "_document_frequencies", recorded)
    decontaminate.find_leaks(
        spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3), spark.createDataFrame(items, ITEMS)).collect()
    plain = lambda t: t.replace("?", " ").replace(".", " ").split()
    pairs = {p for _, t in items for p in zip(plain(t), plain(t)[1:])}
    once = []
    for t in {t for t in docs.values() if t and plain(t)}:
        shared = [p in pairs for p in zip(plain(t), plain(t)[1:])]
        once.append({w for w, a, b in zip(plain(t), [False, *shared], [*shared, False]) if not a and not b})
    terms = {w for _, t in items for w in plain(t)}
    assert len(once) == 121 and found[0][1] == 121
    assert sorted(found[0][0].tolist()) == sorted(sum(w in o for o in once) for w in terms)
