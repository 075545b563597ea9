import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.cases import AWKWARD, awkward, documents, empty, with_clashes
from tokenizers import Tokenizer

from pitchlake.llm import packing, registry

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def check(found, capacity=1024):
    bins = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_whole_table_against_the_tokenizer(spark, sf_dir):
    found = registry.op2_best_fit_packing(spark, sf_dir).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    by_doc = {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r)
    docs = {r["doc_id"]: r["text"] for r in documents(spark, sf_dir).collect()}
    assert set(by_doc) == set(docs)
    for doc_id, pieces in by_doc.items():
        ids = np.array([*tokenizer.encode(docs[doc_id], add_special_tokens=False).ids, 2], dtype="<u4")
        pieces.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        at = 0
        for r in pieces:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and all(r["length"] == 1024 for r in pieces[1:])
        assert len(pieces) == -(-len(ids) // 1024)
    total = sum(r["length"] for r in found)
    assert check(found) <= 1.01 * total / 1024 + 1


def test_special_strings_are_ordinary_text(spark):
    docs = spark.createDataFrame([(1, "a<|endoftext|>b")], "doc_id long, text string")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ids = [*tokenizer.encode("a<|endoftext|>b", add_special_tokens=False).ids, 2]
    row = packing.best_fit_pack(docs, RANKS, PATTERN).first()
    assert row["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), min_size=1, max_size=20))
def test_sweeps_place_every_piece_once(counts):
    runs = packing.sweeps(counts, 32)
    placed, room = {}, {}
    for length, first, n, sequence, offset in runs:
        for i in range(n):
            assert (length, first + i) not in placed
            placed[length, first + i] = sequence + i
            assert room.get(sequence + i, 0) == offset
            room[sequence + i] = offset + length
    assert set(placed) == {(x, i) for x, n in counts.items() for i in range(n)}
    assert max(room.values()) <= 32
    # any-fit packings leave at most one sequence half empty, so they need less than twice the least
    assert len(room) <= 2 * -(-sum(x * n for x, n in counts.items()) // 32)


def test_cut():
    assert packing.cut(5, 8) == [(0, 5)] and packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(20, 8) == [(0, 4), (4, 8), (12, 8)] and packing.cut(16, 8) == [(0, 8), (8, 8)]


def test_awkward_rows(spark):
    docs = with_clashes(awkward(spark), "rank", "number", "before", "first", "sequence", "offset", "n", "length")
    found = packing.best_fit_pack(docs, RANKS, PATTERN).collect()
    check(found)
    assert sum(r["piece"] == 0 for r in found) == len(AWKWARD)
    assert all(r["rank"] == "extra" for r in found)
    assert [r["length"] for r in found if r["doc_id"] in (1, 2)] == [1, 1]
    assert json.loads(json.dumps(len({(r["doc_id"], r["piece"]) for r in found if r["doc_id"] == 7}))) > 10
    assert packing.best_fit_pack(empty(spark), RANKS, PATTERN).collect() == []


def test_unknown_vocabulary():
    with pytest.raises(FileNotFoundError):
        packing.load_encoding("/nowhere", PATTERN)


def test_the_query_agrees_with_the_default_tokenizer(spark, tmp_path):
    texts = ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> <|endoftext|>\n", "<|endoftext |> <|im_start|> plain", "x" * 3000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {(r["doc_id"], r["piece"]): r for r in registry.op2_best_fit_packing(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        assert found[i, 0]["ids_crc32"] == zlib.crc32(ids[: found[i, 0]["length"]].tobytes())
        assert sum(r["length"] for (d, _), r in found.items() if d == i) == len(ids)
