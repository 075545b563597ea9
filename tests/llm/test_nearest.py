import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake.llm import nearest, registry

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k=5):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], dtype=float)
    out = {}
    for q in queries:
        scores = nearest.cosines(vectors, vectors[list(ids).index(q)])
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), scores[i]) for i in order]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(found, expected):
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in e}) for q, e in expected.items())
    return hits / sum(map(len, expected.values()))


def test_whole_table(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    expected = brute(rows, [i for i, _ in rows if i % 50 == 0])
    found = result(registry.op5_nearest_neighbours(spark, sf_dir))
    assert set(found) == set(expected) and recall(found, expected) >= 0.9
    exact = {(q, i): s for q, e in expected.items() for i, s in e}
    assert all(math.isclose(s, exact[q, i], rel_tol=1e-12) for q, f in found.items() for i, s in f if (q, i) in exact)


def test_many_cells_and_blocks(spark, monkeypatch):
    for name, value in (("BLOCK", 100), ("LEAF", 8), ("QUERIES", 10), ("SAMPLE", 400)):
        monkeypatch.setattr(nearest, name, value)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 24))
    vectors = centres[rng.integers(0, 20, 1500)] + 0.4 * rng.standard_normal((1500, 24))
    vectors[200:700] = vectors[200]  # a third of all rows are one vector
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    found, expected = result(nearest.nearest(df, F.col("vec_id") % 25 == 0)), brute(rows, range(0, 1500, 25))
    assert set(found) == set(expected) and recall(found, expected) >= 0.9
    for q in range(200, 700, 25):  # ties go to the smallest ids
        assert [i for i, _ in found[q]] == [i for i in range(200, 206) if i != q][:5]


def test_chi_square():
    assert nearest.chi_square_cdf(np.array([0.0]))[0] == 0
    assert nearest.chi_square_cdf(np.array([15.507]))[0] == pytest.approx(0.95, abs=1e-4)


def test_awkward_rows(spark):
    rows = [
        (None, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (1, [2.0, 0.0], 0), (2, [0.0, 0.0], 0), (3, None, 0), (4, [1.0, None], 0),
        (5, [float("nan"), 1.0], 0), (6, [float("inf"), 1.0], 0), (7, [0.0, 1.0], 0), (8, [1.0, 0.0, 0.0], 0), (9, [], 0), (1, [2.0, 0.0], 0),
        (50, [0.0, 0.0], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cell", F.lit("x")).withColumn("id", F.lit("x")).withColumn("bound", F.lit("x"))
    found = result(nearest.nearest(df, F.col("vec_id") % 50 == 0))
    assert {q: [i for i, _ in f] for q, f in found.items()} == {0: [1, 1, 7]}
    assert found[0][0][1] == 1.0 and found[0][2][1] == 0.0
    assert nearest.nearest(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    alone = df.where("vec_id = 0 and label = 0").limit(1)
    assert nearest.nearest(alone, F.lit(True)).collect() == []
