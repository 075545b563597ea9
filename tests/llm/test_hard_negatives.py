import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake.llm import hard_negatives as hn
from pitchlake.llm import registry
from tests.llm import cases

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=10, low=30, high=90, every=100):
    """By every inner product; ``rows``: (id, components, label) that take part."""
    rows = [(i, [int(np.floor(256 * float(x))) for x in v], label) for i, v, label in rows]
    out, seen = [], set()
    for anchor, q, label in rows:
        if anchor % every or anchor in seen:
            continue
        seen.add(anchor)
        scored = [(-sum(a * b for a, b in zip(q, v)), i, other) for i, v, other in rows if i != anchor]
        for s, p in sorted((s, i) for s, i, other in scored if other == label)[:positives]:
            inside = sorted((t, i) for t, i, other in scored if other != label and low * -s <= 100 * -t <= high * -s)
            out += [(anchor, p, rank + 1, i, -s, -t) for rank, (t, i) in enumerate(inside[:negatives])]
    return sorted(out)


def random_rows(n, dim=6, seed=1, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    return [(i, (centres[i % 4] + spread * rng.normal(size=dim)).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(n)]


def found(spark, rows, schema=SCHEMA, every=100, **options):
    df = spark.createDataFrame(rows, schema) if isinstance(rows, list) else rows
    return sorted(map(tuple, hn.hard_negatives(df, F.col("vec_id") % every == 0, **options).collect()))


@pytest.fixture
def small(monkeypatch):
    """Several tiles, blocks and leaves on little data."""
    for name, value in (("SAMPLE", 120), ("TILES", 20), ("BLOCK", 60), ("LEAF", 8), ("LEAVES", 2)):
        monkeypatch.setattr(hn, name, value)


def test_equals_all_pairs(spark, small):
    rows = random_rows(900)
    assert found(spark, rows, every=50) == brute(rows, every=50)


def test_other_windows_and_numbers(spark, small):
    rows = random_rows(400, dim=3, seed=2)
    assert found(spark, rows, every=40, positives=2, negatives=3, low_percent=-20, high_percent=50) == brute(rows, 2, 3, -20, 50, every=40)


def test_hot_vector_and_ties(spark, small):
    """A third of all rows are one vector: their tile is dealt to several blocks, ties go by the smaller id."""
    rows = [(i, [0.5, 0.25, -0.125] if i % 3 == 0 else v, label) for i, v, label in random_rows(600, dim=3, seed=3)]
    assert found(spark, rows, every=60) == brute(rows, every=60)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = random_rows(250, dim=4, seed=4)
    bad = [(None, [1.0, 0.0, 0.0, 0.0], 1), (300, None, 1), (400, [1.0, 0.0, 0.0, 0.0], None), (500, [1.0, None, 0.0, 0.0], 1), (600, [nan, 0.0, 0.0, 0.0], 1),
           (700, [0.0, -inf, 0.0, 0.0], 1), (800, [1.0, 2.0], 1), (900, [], 1)]
    zero = [(1000, [0.0, -0.0, 0.0, 0.0], 0)]  # takes part, with the score 0 everywhere
    assert found(spark, good + bad + zero, every=50) == brute(good + zero, every=50)


def test_empty_tables_and_clashing_names(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, None, 1), (1, [], 1)]) == []
    assert found(spark, [(0, [1.0], 1)]) == []  # no other row
    assert found(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [-1.0], 0)]) == []  # nothing in the window
    rows = random_rows(200, dim=3, seed=5)
    clashing = cases.with_clashes(spark.createDataFrame(rows, SCHEMA), "id", "v", "tile", "block", "kind", "score", "asks", "low")
    assert found(spark, clashing, every=50) == brute(rows, every=50)


def test_repeated_ids(spark):
    """Every row of a repeated id is a candidate; as an anchor the smallest of its rows counts once."""
    rows = random_rows(120, dim=3, seed=6)
    rows += [(7, rows[7][1], rows[7][2]), (0, rows[0][1], rows[0][2]), (9, [0.5, 0.5, 0.5], 2)]
    expected = brute(rows)
    assert found(spark, rows) == expected and expected


def test_negative_scores_have_no_window(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [-0.5, 0.0], 0), (3, [0.0, 1.0], 1), (4, [0.0, 0.5], 0)]
    assert found(spark, rows) == brute(rows) == [(0, 3, 1, 4, 0, 0)]


def test_large_components_stay_exact(spark, small):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.integers(1, 2**22, size=3) / 256 * 255], int(i % 3)) for i in range(150)]
    assert found(spark, rows, "vec_id long, embedding array<double>, label int", scale=2**8) == brute(rows)


def test_boxes_hold_every_product():
    rng = np.random.default_rng(8)
    points, queries = np.floor(rng.normal(size=(500, 5)) * 100), np.floor(rng.normal(size=(20, 5)) * 100)
    order = hn.packed_order(points, hn.widest(points), 16)
    assert sorted(order) == list(range(500))
    block = hn.Block(np.arange(500), np.zeros(500, int), points)
    least, largest = hn.intervals(queries, block.low, block.high)
    products = queries @ block.points.T
    for leaf, start in enumerate(range(0, 500, hn.LEAF)):
        mine = products[:, start : start + hn.LEAF]
        assert (mine.min(axis=1) >= least[:, leaf]).all() and (mine.max(axis=1) <= largest[:, leaf]).all()


def test_boxes_are_left_out():
    """With clusters far apart, most leaves are not scored."""
    rng = np.random.default_rng(9)
    points = np.floor(256 * (rng.normal(size=(40, 1, 3)) * 20 + rng.normal(size=(40, 64, 3))).reshape(-1, 3))
    block, scored = hn.Block(np.arange(len(points)), np.zeros(len(points), int), points), []
    real, query = hn.inner_products, points[5]
    hn.inner_products = lambda p, q, e: (scored.append(len(p)), real(p, q, e))[1]
    try:
        least, largest = hn.intervals(query[None], block.low, block.high)
        block.search(query, 5, 0, True, [(-hn.FAR, hn.FAR, -hn.FAR)], 5, least[0], largest[0], True)
    finally:
        hn.inner_products = real
    assert 0 < sum(scored) < len(points) / 3


def test_query_and_sql(spark, duck):
    rows = registry.op11_hard_negatives(spark, "/root/testdata/sf0.001").collect()
    expected = duck.execute(registry.ORACLE["op11_hard_negatives"])
    names = [c[0] for c in expected.description]
    assert sorted(tuple(r[c] for c in names) for r in rows) == sorted(expected.fetchall())
