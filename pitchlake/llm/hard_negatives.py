"""Hard negatives of labelled vectors by exact inner-product search in an STR-packed R-tree.

Sort-tile-recursive packing cuts the points along their widest coordinates. The upper level's tiles are cut on a bounded sample; every
point is put into its tile, large tiles are dealt to blocks that fit a task, and each block is packed into leaves. A minimum
bounding box gives an interval of a coordinate's product with the query's, and their sum an interval of the inner product. A box is
left out if its interval misses every score window of the query or ends strictly below the k-th score found so far. The search
starts from scores of the sample, visits the tiles that they leave open, and takes the leaves of a block best first.

Boxes only ever rule out what can't be an answer, so results are exact. Queries go to the blocks they must visit, one after the other
past the one block that a task holds; points are never copied. A block's size, the number of tiles and the sample are bounded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.storage import stored

#: Sampled rows that the upper tiles and first bounds come from; tiles at most; rows of a block; rows of a leaf; leaves scored at once.
SAMPLE, TILES, BLOCK, LEAF, LEAVES = 8_192, 1_024, 8_192, 64, 8
#: Coordinates that are cut one after the other.
LEVELS = 3
#: Below this bound, sums of products of whole numbers are exact in double precision.
EXACT = 2.0**53
FAR = 2**62


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Packed vectors as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), dim)


def _fits(points: np.ndarray, queries: np.ndarray) -> bool:
    largest = [float(np.abs(x).max()) if x.size else 0.0 for x in (points, queries)]
    return largest[0] * largest[1] * points.shape[1] < EXACT


def inner_products(points: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    """Whole numbers; beyond double precision with Python's, which fail where 64 bits do not hold them."""
    if exact:
        return (points @ query).astype(np.int64)
    q = [int(x) for x in query]
    return np.array([sum(int(x) * y for x, y in zip(row, q)) for row in points], dtype=np.int64)


def widest(points: np.ndarray, levels: int = LEVELS) -> list[int]:
    """The coordinates of the largest spread."""
    return np.argsort(-points.std(axis=0), kind="stable")[:levels].tolist()


def packed_order(points: np.ndarray, dims: list[int], leaf: int) -> np.ndarray:
    """Sort-tile-recursive order: runs of ``leaf`` rows in it are the leaves."""

    def tile(rows: np.ndarray, dims: list[int]) -> list[np.ndarray]:
        rows = rows[np.argsort(points[rows, dims[0]], kind="stable")]
        leaves = math.ceil(len(rows) / leaf)
        if len(dims) == 1 or leaves <= 1:
            return [rows]
        slab = leaf * math.ceil(leaves / math.ceil(leaves ** (1 / len(dims))))
        return [part for at in range(0, len(rows), slab) for part in tile(rows[at : at + slab], dims[1:])]

    return np.concatenate(tile(np.arange(len(points)), dims)) if len(points) else np.zeros(0, dtype=int)


class Tiles:
    """Upper tiles: along each of the widest coordinates, cut points within the tile of the coordinates before."""

    def __init__(self, sample: np.ndarray, number: int):
        self.dims = widest(sample, min(LEVELS, math.ceil(math.log2(number)))) if number > 1 and len(sample) else []
        self.slabs = math.ceil(number ** (1 / len(self.dims)) - 1e-9) if self.dims else 1
        self.slabs -= self.slabs ** len(self.dims) > TILES
        self.cuts: list[np.ndarray] = []
        for level, dim in enumerate(self.dims):
            tile = self._numbers(sample, level)
            self.cuts.append(np.array([
                np.quantile(mine, np.arange(1, self.slabs) / self.slabs, method="lower") if len(mine := sample[tile == t, dim]) else
                np.zeros(self.slabs - 1) for t in range(self.slabs**level)]))

    def _numbers(self, points: np.ndarray, levels: int) -> np.ndarray:
        tile = np.zeros(len(points), dtype=np.int64)
        for dim, cuts in zip(self.dims[:levels], self.cuts):
            tile = tile * self.slabs + (points[:, dim, None] > cuts[tile]).sum(axis=1)
        return tile

    def place(self, points: np.ndarray) -> np.ndarray:
        return self._numbers(points, len(self.dims))


def intervals(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) inner product of each query with any point of each box."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    least, largest = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    # a rounded sum may not shut out a point: widen by more than its error where whole numbers are not exact
    size = np.maximum(np.abs(low), np.abs(high))
    slack = np.abs(queries) @ size.T
    slack = np.where(slack < EXACT, 0.0, slack * 1e-9)
    return least - slack, largest + slack


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class Block:
    """One block's R-tree: packed points and the boxes of their leaves."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray):
        order = packed_order(points, widest(points), LEAF)
        self.ids, self.labels, self.points = ids[order], labels[order], points[order]
        starts = np.arange(0, len(ids), LEAF)
        self.low = np.minimum.reduceat(self.points, starts, axis=0)
        self.high = np.maximum.reduceat(self.points, starts, axis=0)

    def search(
        self, query: np.ndarray, own: int, label: int, same: bool, windows: list[tuple[int, int, int]], k: int,
        least: np.ndarray, largest: np.ndarray, exact: bool,
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of the k best rows of each window (low, high, floor), out of rows of the same or of another label.

        Scores below a window's floor are known not to be wanted. ``least``, ``largest``: the intervals of the leaves.
        """
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
        floors = [max(low, floor) for low, _, floor in windows]
        queue = np.argsort(-largest, kind="stable")
        for at in range(0, len(queue), LEAVES):
            leaves = queue[at : at + LEAVES]
            open_ = [w for w in range(len(windows)) if largest[leaves[0]] >= floors[w]]
            if not open_:
                break
            wanted = np.zeros(len(leaves), dtype=bool)
            for w in open_:
                wanted |= (largest[leaves] >= floors[w]) & (least[leaves] <= windows[w][1])
            rows = (leaves[wanted, None] * LEAF + np.arange(LEAF)).ravel()
            rows = rows[rows < len(self.ids)]
            rows = rows[((self.labels[rows] == label) == same) & (self.ids[rows] != own)]
            if not len(rows):
                continue
            scores = inner_products(self.points[rows], query, exact)
            for w in open_:
                inside = (scores >= floors[w]) & (scores <= windows[w][1])
                if inside.any():
                    found[w] = _best(np.append(found[w][0], self.ids[rows[inside]]), np.append(found[w][1], scores[inside]), k)
                    if len(found[w][0]) == k:
                        floors[w] = max(floors[w], int(found[w][1][-1]))
        return found


FOUND = "query_id long, slot int, vec_id long, score long"
VISIT = "tile int, block int, kind int, id long, label long, v binary, low array<long>, high array<long>, floor array<long>"


class RTree:
    """The packed points as a written table (``tile``, ``block``, ``id``, ``label``, ``v``), and its upper boxes."""

    def __init__(self, points: DataFrame, dim: int, count: int):
        """``points``: id, label, v (packed), all of ``dim`` coordinates; ``count`` rows."""
        share = min(1.0, 1.1 * SAMPLE / max(1, count))
        chosen = F.pmod(F.xxhash64("id", "v"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))
        sample = points.where(chosen).limit(SAMPLE).toArrow().combine_chunks()
        column = lambda name: sample.column(name).combine_chunks() if len(sample) else pa.array([], pa.binary() if name == "v" else pa.int64())
        self.dim = dim
        self.sample = (column("id").to_numpy(), column("label").to_numpy(), _matrix(column("v"), dim))
        tiles = Tiles(self.sample[2], min(TILES, math.ceil(count / BLOCK)))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                tile = tiles.place(_matrix(batch.column(2), dim))
                yield pa.RecordBatch.from_arrays([pa.array(tile, pa.int32()), *batch.columns], names=["tile", "id", "label", "v"])

        placed = stored(points.select("id", "label", "v").mapInArrow(place, "tile int, id long, label long, v binary"), "tiles")
        sizes = placed.groupBy("tile").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))  # at most TILES rows
        self.sizes = F.broadcast(stored(sizes, "tile-sizes"))
        block = F.pmod(F.xxhash64(F.lit(9), "id", F.monotonically_increasing_id()), "blocks").cast("int")
        self.points = stored(placed.join(self.sizes, "tile").select("tile", block.alias("block"), "id", "label", "v"), "rtree")
        self.boxes = self._boxes(placed)

    def _boxes(self, placed: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tile numbers, least, largest coordinates): merged in each task, then by tile. At most TILES rows reach the driver."""
        dim = self.dim

        def merged(parts: dict[int, np.ndarray], tile: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
            for t in np.unique(tile):
                mine = tile == t
                new = np.stack((low[mine].min(axis=0), high[mine].max(axis=0)))
                old = parts.get(int(t), new)
                parts[int(t)] = np.stack((np.minimum(old[0], new[0]), np.maximum(old[1], new[1])))

        def rows(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(parts), pa.int32()), *(pa.array([p[side].tobytes() for p in parts.values()], pa.binary()) for side in (0, 1))],
                names=["tile", "low", "high"])

        def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts: dict[int, np.ndarray] = {}
            for batch in batches:
                points = _matrix(batch.column(1), dim)
                merged(parts, batch.column(0).to_numpy(), points, points)
            yield rows(parts)

        def of_tile(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts: dict[int, np.ndarray] = {}
            for batch in group:
                merged(parts, batch.column(0).to_numpy(), _matrix(batch.column(1), dim), _matrix(batch.column(2), dim))
            yield rows(parts)

        schema = "tile int, low binary, high binary"
        partial = placed.select("tile", "v").mapInArrow(in_task, schema)
        boxes = partial.repartition("tile").sortWithinPartitions("tile").mapInArrow(of_tile, schema).collect()
        boxes.sort(key=lambda r: r["tile"])
        side = lambda name: np.frombuffer(b"".join(r[name] for r in boxes), np.float64).reshape(len(boxes), dim)
        return np.array([r["tile"] for r in boxes], dtype=np.int64), side("low"), side("high")

    def best(self, queries: DataFrame, same: bool, k: int) -> DataFrame:
        """(``query_id``, ``slot``, ``rank``, ``vec_id``, ``score``): the k best rows of each window of each query.

        ``queries``: id, label, v, and arrays low and high, of equal length, with the windows; a slot is a place in them. Rows are of
        the query's label (``same``) or of another, and not of its id; equal scores go by the smaller id.
        """
        dim, sample, (numbers, low, high) = self.dim, self.sample, self.boxes

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q = _matrix(batch.column(2), dim)
                exact = _fits(sample[2], q)
                least, largest = intervals(q, low, high)
                take, tiles, floors = [], [], []
                lows, highs = batch.column(3).to_pylist(), batch.column(4).to_pylist()
                for row, (own, label) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                    mine = ((sample[1] == label) == same) & (sample[0] != own)
                    scores = inner_products(sample[2][mine], q[row], exact)
                    floor, visited = [], np.zeros(len(numbers), dtype=bool)
                    for a, b in zip(lows[row], highs[row]):
                        inside = scores[(scores >= a) & (scores <= b)]
                        floor.append(int(np.partition(inside, len(inside) - k)[len(inside) - k]) if len(inside) >= k else -FAR)
                        if a <= b:
                            visited |= (largest[row] >= max(a, floor[-1])) & (least[row] <= b)
                    chosen = numbers[visited].tolist()
                    take += [row] * len(chosen)
                    tiles += chosen
                    floors += [floor] * len(chosen)
                kept = batch.take(pa.array(take, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tiles, pa.int32()), *kept.columns, pa.array(floors, pa.list_(pa.int64()))],
                    names=["tile", "id", "label", "v", "low", "high", "floor"])

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Batches in order of tile, block and kind: a block's points (0), then its queries (1)."""
            at, parts, block = None, [], None
            for batch in batches:
                tile, number, kind = (batch.column(c).to_numpy() for c in range(3))
                edges = np.flatnonzero((np.diff(tile) != 0) | (np.diff(number) != 0) | (np.diff(kind) != 0)) + 1
                for start, stop in zip([0, *edges.tolist()], [*edges.tolist(), len(tile)]):
                    if start == stop:
                        continue
                    if at != (tile[start], number[start]):
                        at, parts, block = (tile[start], number[start]), [], None
                    rows = batch.slice(start, stop - start)
                    if kind[start] == 0:
                        parts.append((rows.column(3).to_numpy(), rows.column(4).to_numpy(), _matrix(rows.column(5), dim)))
                        continue
                    if block is None:
                        block, parts = Block(*(np.concatenate(x) for x in zip(*parts))), []
                    q = _matrix(rows.column(5), dim)
                    exact = _fits(block.points, q)
                    least, largest = intervals(q, block.low, block.high)
                    out: list[tuple] = []
                    for row, (own, label, *windows) in enumerate(zip(*(rows.column(c).to_pylist() for c in (3, 4, 6, 7, 8)))):
                        best = block.search(q[row], own, label, same, list(zip(*windows)), k, least[row], largest[row], exact)
                        out += [(own, slot, i, s) for slot, (ids, scores) in enumerate(best) for i, s in zip(ids.tolist(), scores.tolist())]
                    columns = list(zip(*out)) or [()] * 4
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                        names=["query_id", "slot", "vec_id", "score"])

        asked = queries.select("id", "label", "v", "low", "high").mapInArrow(
            route, "tile int, id long, label long, v binary, low array<long>, high array<long>, floor array<long>")
        asked = asked.join(self.sizes, "tile").select(
            "tile", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("kind"), "id", "label", "v",
            "low", "high", "floor")
        none = F.lit(None).cast("array<long>")
        points = self.points.select(
            "tile", "block", F.lit(0).alias("kind"), "id", "label", "v", none.alias("low"), none.alias("high"), none.alias("floor"))
        both = points.unionByName(asked).repartition("tile", "block").sortWithinPartitions("tile", "block", "kind")
        place = F.row_number().over(Window.partitionBy("query_id", "slot").orderBy(F.desc("score"), "vec_id"))
        found = both.mapInArrow(visit, FOUND).withColumn("rank", place).where(F.col("rank") <= k)
        return found.select("query_id", "slot", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _share(score: Column, percent: int, up: bool) -> Column:
    """``percent`` of a whole number, rounded down or up, without leaving whole numbers or 64 bits on the way."""
    rest = F.pmod(score, F.lit(100))
    whole = F.call_function("div", score - rest, F.lit(100)) * percent
    part = rest * percent
    over = F.pmod(part, F.lit(100))
    part = F.call_function("div", part - over, F.lit(100))
    return whole + part + (F.when(over > 0, 1).otherwise(0) if up else F.lit(0))


def _unusable(vector: Column) -> Column:
    """Whether a component is null, not a number or infinite."""
    return F.exists(vector, lambda x: x.isNull() | F.coalesce(F.isnan(x), F.lit(True)) | (F.abs(x) == F.lit(float("inf"))))


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 10, low_percent: int = 30, high_percent: int = 90, scale: int = 256,
) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``), exact.

    A score is the inner product of two vectors whose components became floor(scale * x). An anchor's positives are the first rows of
    its label, by score and then by smaller id; its negatives for a positive are the first rows of other labels whose
    score is within the two percentages of the positive's. Rows take no part without an id or a label, with a null vector, with a null or
    non-finite component, or with another length than most vectors have. An anchor's id is no candidate for it; an id that repeats
    gives each of its rows, and a repeated anchor one answer, for the smallest of its rows (label, then components in bytes). No rows, no
    second label or no score in a window give no rows. Scores beyond 64 bits are an error. Other columns may have any names.
    """
    spark = vectors.sparkSession
    value = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), value.alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks")).where("id is not null and label is not null and v is not null")
    rows = rows.where(~_unusable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not sizes or sizes[0]["dim"] == 0:
        return spark.createDataFrame([], RESULT)
    dim, count = sizes[0]["dim"], sizes[0]["count"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), dim)
            scaled = np.floor(scale * values) + 0.0  # no negative zeros
            packed = pa.array([row.tobytes() for row in scaled], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed, batch.column(3)], names=["id", "label", "v", "asks"])

    points = stored(rows.where(F.size("v") == dim).mapInArrow(pack, "id long, label long, v binary, asks boolean"), "points")
    anchors = points.where("asks").groupBy("id").agg(F.min(F.struct("label", "v")).alias("a")).select("id", "a.label", "a.v")
    anchors = stored(anchors, "anchors")
    tree = RTree(points, dim, count)

    whole = anchors.withColumn("low", F.array(F.lit(-FAR))).withColumn("high", F.array(F.lit(FAR)))
    first = stored(tree.best(whole, True, positives).select("query_id", "rank", "vec_id", "score"), "positives")
    score = F.col("score")
    windows = first.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct(
        "rank", _share(score, low_percent, True).alias("low"), _share(score, high_percent, False).alias("high")))).alias("w"))
    asked = anchors.join(windows, anchors["id"] == windows["query_id"]).select(
        "id", "label", "v", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    found = tree.best(asked, False, negatives).select(
        F.col("query_id").alias("anchor_id"), (F.col("slot") + 1).alias("at"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    first = first.select(
        F.col("query_id").alias("anchor_id"), F.col("rank").alias("at"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(first, ["anchor_id", "at"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
