import zlib

import pytest
from tests.llm.cases import awkward, documents, empty, with_clashes

from pitchlake.llm import registry, sharding


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_whole_table(spark, sf_dir):
    found = rows(registry.op6_sharding(spark, sf_dir))
    source = {r["doc_id"]: r["text"] for r in documents(spark, sf_dir).collect()}
    assert sorted(r["doc_id"] for r in found) == sorted(source)
    for r in found:
        data = (source[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 1, zlib.crc32(data), "key")
        assert r["grown_shard"] in (r["shard"], 8)
    for shard in range(8):
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    moved = sum(r["grown_shard"] == 8 for r in found) / len(found)
    assert 0.05 < moved < 0.2


def test_order_is_shuffled_and_follows_the_seed(spark, sf_dir):
    docs = documents(spark, sf_dir).coalesce(1)
    order = lambda seed: [r["doc_id"] for r in sharding.shuffle_into_shards(
        docs, "doc_id", "text", shards=1, seed=seed, bucket_bytes=1 << 30).orderBy("slot").collect()]
    first = order(1)
    assert first != sorted(first) and sorted(first) == sorted(order(2)) and first != order(2)


def test_small_buckets_join_to_gapless_shards(spark, sf_dir):
    found = rows(sharding.shuffle_into_shards(documents(spark, sf_dir), "doc_id", "text", shards=3, bucket_bytes=20_000))
    for shard in range(3):
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_key_decides_alone(spark, sf_dir):
    docs = documents(spark, sf_dir)
    a = {r["doc_id"]: r["shard"] for r in rows(sharding.shuffle_into_shards(docs, "doc_id", "text"))}
    part = docs.where("doc_id % 3 = 0")
    assert all(a[r["doc_id"]] == r["shard"] for r in rows(sharding.shuffle_into_shards(part, "doc_id", "text")))


def test_awkward_rows(spark):
    docs = with_clashes(awkward(spark), "bucket", "place", "before", "slot", "record", "pile", "item")
    found = rows(sharding.shuffle_into_shards(docs, "doc_id", "text", shards=2, bucket_bytes=64))
    assert len(found) == 12 and all(r["bucket"] == "extra" and isinstance(r["slot"], int) for r in found)
    for shard in range(2):
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert rows(sharding.shuffle_into_shards(empty(spark), "doc_id", "text")) == []
    with pytest.raises(ValueError):
        sharding.shuffle_into_shards(docs, "doc_id", "text", shards=0)
