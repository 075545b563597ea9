"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass one scatters the records uniformly, by seeded hashes, into buckets small enough for one task's memory. Pass two
shuffles each bucket (Spark's ``shuffle`` is a Fisher-Yates permutation) and writes it. A record's slot is its place in its
bucket plus the records in the earlier buckets of its shard.

The law of the shards is ``key``: a record's shard follows from its key and the number of shards alone, by the highest of one
seeded hash per shard. One more shard therefore only takes records from the others, and moves none between them. Buckets
inside a shard also hash the record's position in the input, so a key that is repeated often doesn't fill one bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.storage import stored

#: Up to this many buckets (20 bytes each) the table of bucket offsets is broadcast; beyond, Spark chooses the join.
BROADCAST_BUCKETS = 50_000


def record_size(text: Column) -> Column:
    """Bytes of the UTF-8 text, none for null, plus one for its separator."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def rendezvous(key: Column, shards: int, seed: int) -> Column:
    """The shard with the highest seeded hash of the key; the lowest number wins a tie. A null key is a key like others."""
    weights = F.array(*[F.xxhash64(F.lit(seed), F.lit(s), key) for s in range(shards)])
    return (F.array_position(weights, F.array_max(weights)) - 1).cast("int")


def shuffle_into_shards(
    records: DataFrame, key: str, text: str, shards: int = 8, seed: int = 17, bucket_bytes: int = 8 << 20
) -> DataFrame:
    """All records with ``shard``, ``slot`` (gapless from 0 in each shard) and ``grown_shard`` (with one more shard).

    Every input column is kept; the result is a written table, in shuffled order within each bucket. Null keys and texts
    are allowed, an empty table gives an empty table, and repeated rows each get a slot of their own. Columns of the
    input that are called ``shard``, ``slot`` or ``grown_shard`` are replaced.
    """
    if shards < 1 or bucket_bytes < 1:
        raise ValueError("shards and bucket_bytes must be positive")
    payload = [c for c in records.columns if c not in ("shard", "slot", "grown_shard")]
    total = records.agg(F.sum(record_size(F.col(text)))).first()[0] or 0
    buckets = max(1, math.ceil(total / shards / bucket_bytes))
    # pass one: scatter
    scattered = records.select(
        F.struct(*[F.col(f"`{c}`") for c in payload]).alias("record"),
        rendezvous(F.col(key), shards, seed).alias("shard"),
        rendezvous(F.col(key), shards + 1, seed).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key), F.monotonically_increasing_id()), F.lit(buckets)).alias("bucket"),
    )
    scattered = scattered.repartition(max(1, min(shards * buckets, 20_000)), "shard", "bucket")
    # pass two: Fisher-Yates within each bucket
    shuffled = scattered.groupBy("shard", "bucket").agg(
        F.shuffle(F.collect_list(F.struct("grown_shard", "record")), seed).alias("pile")
    )
    written = stored(
        shuffled.select("shard", "bucket", F.posexplode("pile").alias("place", "item")).select(
            "shard", "bucket", "place", "item.grown_shard", "item.record"
        ),
        "shards",
    )
    by_bucket = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written.groupBy("shard", "bucket").count().select(
        "shard", "bucket", F.coalesce(F.sum("count").over(by_bucket), F.lit(0)).alias("before")
    )
    if shards * buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    return written.join(offsets, ["shard", "bucket"]).select(
        *[F.col(f"record.`{c}`").alias(c) for c in payload],
        "shard", (F.col("before") + F.col("place")).alias("slot"), "grown_shard",
    )
