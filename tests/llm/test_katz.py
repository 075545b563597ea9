import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from tests.llm.cases import awkward, empty, texts, with_clashes
from tests.llm.test_words import plain

from pyspark.sql import functions as F

from pitchlake.llm import katz, registry


def brute(docs, held):
    """Scores by dictionaries, one token after the other; also the model for a test of its sums."""
    words = {i: [*plain(t), "</s>"] for i, t in docs.items()}
    one, two = Counter(), defaultdict(Counter)
    for i, w in words.items():
        if not held[i]:
            one.update(w)
            for a, b in zip(["<s>", *w], w):
                two[a][b] += 1
    tokens, types = sum(one.values()), len(one)
    count = lambda values: np.array([sum(v == r for v in values) for r in range(7)], dtype=float)
    d1, d2 = katz.discounts(count(list(one.values()))), katz.discounts(count([c for s in two.values() for c in s.values()]))
    d = lambda table, c: table[c] if c <= 5 else 1.0
    left = 1 - sum(d(d1, c) * c for c in one.values()) / max(1, tokens)
    scale, unknown = (1.0, left) if tokens and left > 1e-12 else (tokens / (tokens + 1), 1 / (tokens + 1))
    p1 = lambda w: d(d1, one[w]) * one[w] / tokens * scale if one[w] else unknown

    def p2(v, w):
        seen = two.get(v)
        if not seen:
            return p1(w)
        total, given = sum(seen.values()), sum(d(d2, c) * c for c in seen.values())
        size = total if given < total else total + 1
        if seen[w]:
            return d(d2, seen[w]) * seen[w] / size
        return (1 - given / size) / (1 - sum(p1(x) for x in seen if seen[x])) * p1(w)

    out = {}
    for i, w in words.items():
        out[i] = (len(w), sum(x in one for x in w), tokens, sum(math.log10((one[x] + 1) / (tokens + types + 1)) for x in w),
                  sum(math.log10(p2(a, b)) for a, b in zip(["<s>", *w], w)))
    return out, (one, two, p1, p2, unknown)


def same(found, expected):
    assert set(found) == set(expected)
    for i, r in found.items():
        e = expected[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == e[:3]
        assert math.isclose(r["base_score"], e[3], rel_tol=1e-9) and math.isclose(r["score"], e[4], rel_tol=1e-9)


def test_whole_table_against_dictionaries(spark, sf_dir):
    docs = texts(sf_dir)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    found = {r["doc_id"]: r for r in registry.op4_katz_backoff(spark, sf_dir).collect()}
    expected, _ = brute(docs, held)
    same(found, expected)
    assert all(r["held_out"] == held[i] for i, r in found.items())
    unseen = [i for i in docs if held[i]]
    assert sum(found[i]["score"] for i in unseen) > sum(found[i]["base_score"] for i in unseen)


def test_several_chunks_and_buckets(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 3_000)
    monkeypatch.setattr(katz, "PER_WORD_BUCKET", 9_000)
    monkeypatch.setattr(katz, "PER_PAIR_BUCKET", 4_000)
    docs = dict(list(texts(sf_dir).items())[:60])
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r for r in katz.score(df, F.col("doc_id") % 5 == 1).collect()}
    same(found, brute(docs, {i: i % 5 == 1 for i in docs})[0])


def test_distributions_sum_to_one():
    docs = {i: t for i, t in enumerate(["a b a c", "a b b", "c a b a", "a b", "d d d d d d d d e"])}
    _, (one, two, p1, p2, unknown) = brute(docs, {i: False for i in docs})
    assert math.isclose(sum(p1(w) for w in one) + unknown, 1)
    for v in [*two, "nothing"]:
        assert math.isclose(sum(p2(v, w) for w in one) + p2(v, "unknown"), 1)


def test_discounts_by_formula():
    n = np.array([0, 1000, 300, 140, 80, 50, 35], dtype=float)
    d = katz.discounts(n)
    tail = 6 * 35 / 1000
    assert np.allclose(d[1:], [((r + 1) * n[r + 1] / n[r] / r - tail) / (1 - tail) for r in range(1, 6)])
    assert np.allclose(katz.discounts(np.zeros(7))[1:], [1 - 0.5 / r for r in range(1, 6)])


def test_awkward_rows(spark):
    docs = with_clashes(awkward(spark), "key", "held", "chunk", "codes", "docs", "score")
    rows = katz.score(docs, F.coalesce(F.col("doc_id") == 4, F.lit(False))).collect()
    assert len(rows) == 12
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["n_tokens"] == by_id[2]["n_tokens"] == by_id[3]["n_tokens"] == 1
    assert by_id[1]["score"] == by_id[2]["score"] == by_id[3]["score"]
    assert by_id[4]["held_out"] and by_id[4]["n_known"] == 1 and by_id[7]["n_tokens"] == 40_001
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    nothing = katz.score(docs, F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in nothing)
    assert katz.score(empty(spark), F.lit(False)).collect() == []
