"""Best-fit packing of token sequences, bulk-synchronous.

Documents are tokenised once into pieces of at most ``capacity`` tokens; the pieces, without their tokens, are written as a
table. Lengths are whole numbers up to the capacity, so the range sort of pieces and gaps is a counting sort: each
piece gets its rank among the pieces of its length in a distributed numbering, and a sorted run of equal pieces or equal
gaps is one line (size, first rank, count).

Each round sweeps over the sorted runs of pieces and gaps: a gap takes its predecessor, the longest unplaced piece that
fits, and a piece thereby its successor, the smallest gap that holds it. Where more pieces than gaps meet, or the reverse,
ranks decide: the n-th piece goes to the n-th gap. Then the gaps are updated, and the next round begins. When no gap
takes a piece any more, the largest pieces left open as many sequences as the rest needs at least.

The sweep sees at most one run per length and gap, whatever the number of documents: its state is bounded by the capacity,
not by the data. What grows with the data (tokens, ranks, placement of each piece) is done by Spark.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.storage import stored

#: Numbering groups for each length, which bound the rows that one task numbers.
GROUPS = 64
END_ID = 2
#: Special tokens of ``byte_bpe_50k``, which its tokenizer finds in texts by default.
SPECIAL = {"<|endoftext|>": 50256}


def load_encoding(ranks_path: str, pattern: str, special: dict[str, int] | None = None):
    """A byte-level BPE by its ranks, with the ids of ``special`` tokens. Strings of any other special tokens are ordinary text."""
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special or {})


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of n tokens: full ones, but for the first, which takes the remainder."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((start, capacity) for start in range(first, n, capacity))]


def tokenise(documents: DataFrame, ranks_path: str, pattern: str, capacity: int, text: str = "text", special: dict[str, int] | None = None) -> DataFrame:
    """One row per piece: the other columns of the document, ``piece``, ``start``, ``length``, ``ids_crc32``, ``_group``."""
    made = ("piece", "start", "length", "ids_crc32", "sequence_id", "offset", "_group")
    others = [c for c in documents.columns if c != text and c not in made]
    schema = documents.select(*[F.col(f"`{c}`") for c in others]).schema
    out = schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    out = out.add("_group", "integer")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, turn = load_encoding(ranks_path, pattern, special), 0
        for batch in batches:
            rows, piece, starts, lengths, crcs = [], [], [], [], []
            for row, value in enumerate(batch.column(batch.num_columns - 1)):
                ids = np.array([*encoding.encode(value.as_py() or "", allowed_special="all"), END_ID], dtype="<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append(row)
                    piece.append(k)
                    starts.append(start)
                    lengths.append(length)
                    crcs.append(zlib.crc32(ids[start : start + length].tobytes()))
            kept = batch.select(range(batch.num_columns - 1)).take(pa.array(rows, pa.int64()))
            group = (turn + np.arange(len(rows))) % GROUPS
            turn += len(rows)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(piece, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.array(crcs, pa.int64()), pa.array(group, pa.int32())],
                names=[*kept.schema.names, "piece", "start", "length", "ids_crc32", "_group"],
            )

    return documents.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`")).mapInArrow(pieces, out)


def sweeps(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, offset) that place ``counts[length]`` pieces of each length."""
    left, rank, runs, opened = dict(counts), defaultdict(int), [], 0
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def put(length: int, n: int, sequence: int, offset: int) -> None:
        runs.append((length, rank[length], n, sequence, offset))
        rank[length] += n
        left[length] -= n
        if offset + length < capacity:
            gaps[capacity - offset - length].append((sequence, n))

    def open_sequences(length: int, n: int) -> None:
        nonlocal opened
        put(length, n, opened, 0)
        opened += n

    for length in sorted(counts, reverse=True):
        if 2 * length > capacity and left[length]:  # no two of these share a sequence
            open_sequences(length, left[length])
    while any(left.values()):
        before, waiting, taken = len(runs), [], gaps
        gaps = defaultdict(list)
        for size in range(1, capacity + 1):
            if left.get(size):
                waiting.append([size, left[size]])
            for sequence, n in taken.get(size, ()):
                while n and waiting:
                    length, there = waiting[-1]
                    m = min(n, there)
                    put(length, m, sequence, capacity - size)
                    sequence, n = sequence + m, n - m
                    waiting[-1][1] -= m
                    if not waiting[-1][1]:
                        waiting.pop()
                if n:
                    gaps[size].append((sequence, n))
        if len(runs) == before:
            need = -(-sum(length * n for length, n in left.items()) // capacity)
            for length in sorted((x for x in left if left[x]), reverse=True):
                n = min(need, left[length])
                if n:
                    open_sequences(length, n)
                    need -= n
    return runs


def best_fit_pack(
    documents: DataFrame, ranks_path: str, pattern: str, capacity: int = 1024, text: str = "text",
    special: dict[str, int] | None = None,
) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``; the other columns of the documents are kept.

    A null or empty text is one piece that holds the end token only. Repeated rows are packed each for itself. An empty
    table gives an empty table. Input columns called like the columns made here are replaced.
    """
    spark = documents.sparkSession
    pieces = tokenise(documents, ranks_path, pattern, capacity, text, special)
    own = ["piece", "start", "length", "ids_crc32", "_group"]
    others = [c for c in pieces.columns if c not in own]
    # the document's own columns stay in a struct, where their names can't clash
    pieces = pieces.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("doc"), *own)
    pieces = stored(pieces, "pieces")
    counts = pieces.groupBy("length", "_group").count()
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # at most capacity rows
    runs = pd.DataFrame(sweeps(lengths, capacity), columns=["length", "first", "n", "sequence", "offset"], dtype="int64")
    schema = "length long, first long, n long, sequence long, offset long"
    runs = spark.createDataFrame(runs, schema) if len(runs) else spark.createDataFrame([], schema)
    earlier = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "_group", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    tie = [F.col("doc.doc_id")] if "doc_id" in others else []
    number = F.row_number().over(Window.partitionBy("length", "_group").orderBy(*tie, "piece")) - 1
    ranked = pieces.withColumn("number", number).join(
        F.broadcast(before), ["length", "_group"]).withColumn("rank", F.col("number") + F.col("before"))
    here = (ranked["length"] == runs["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n"))
    return ranked.join(F.broadcast(runs), here).select(
        *[F.col(f"doc.`{c}`").alias(c) for c in others], "piece", "start", ranked["length"], "ids_crc32",
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset",
    )
