import uuid

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitchlake.llm import registry, token_counts
from tests.llm import cases

JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def cache(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def brute(text, encoder=tokenizers.Tokenizer.from_file(JSON)):
    return len(encoder.encode(text or "", add_special_tokens=False).ids)


def stored_rows(spark, cache):
    return spark.read.parquet(cache)


def test_query_counts_every_document(spark, sf_dir):
    texts = cases.texts(sf_dir)
    rows = {r["doc_id"]: r for r in registry.op12_token_counts(spark, sf_dir).collect()}
    assert rows.keys() == texts.keys()
    for key, text in texts.items():
        n = brute(text)
        assert (rows[key]["n_bytes"], rows[key]["n_tokens"], rows[key]["over_limit"]) == (len((text or "").encode()), n, n > 1024)


def test_awkward_rows(spark, cache):
    extra = [(30, "a<|endoftext|>b", "en", "s", 15), (31, "é\U0001f600\u0000z", "en", "s", 4), (32, "x y  z\n\n" * 30_000, "en", "s", 1)]
    docs = cases.awkward(spark).unionByName(spark.createDataFrame(extra, cases.DOCUMENTS))
    rows = token_counts.count_tokens(docs, JSON, cache, keep=["doc_id", "text"]).collect()
    assert len(rows) == len(cases.AWKWARD) + len(extra)
    for r in rows:
        assert (r["n_tokens"], r["n_bytes"]) == (brute(r["text"]), len((r["text"] or "").encode()))
    # copies and nulls share one stored count
    assert stored_rows(spark, cache).count() == len({r["text"] or "" for r in rows})


def test_only_distinct_misses_are_encoded(spark, cache, monkeypatch):
    docs = cases.awkward(spark)
    first = token_counts.count_tokens(docs, JSON, cache).collect()
    known = stored_rows(spark, cache).count()
    asked = []
    real = token_counts.encode_misses
    monkeypatch.setattr(token_counts, "encode_misses", lambda t, m, k: (asked.append(m.count()), real(t, m, k))[1])
    again = token_counts.count_tokens(docs, JSON, cache).collect()
    assert sorted(map(str, again)) == sorted(map(str, first)) and asked == []
    more = docs.unionByName(spark.createDataFrame([(40, "new text", "en", "s", 8), (41, "new text", "en", "s", 8)], cases.DOCUMENTS))
    assert token_counts.count_tokens(more, JSON, cache).count() == len(first) + 2
    assert asked == [1] and stored_rows(spark, cache).count() == known + 1


@pytest.mark.parametrize("most", [0, 100_000])
def test_both_ways_to_the_texts(spark, cache, monkeypatch, most, sf_dir):
    monkeypatch.setattr(token_counts, "BROADCAST_MISSES", most)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    half = docs.where("doc_id % 2 = 0")
    token_counts.count_tokens(half, JSON, cache).collect()
    rows = token_counts.count_tokens(docs, JSON, cache).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {k: brute(t) for k, t in cases.texts(sf_dir).items()}
    assert stored_rows(spark, cache).groupBy("digest").count().where("count > 1").isEmpty()


def test_hot_text(spark, cache):
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text").otherwise(
        F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    rows = token_counts.count_tokens(docs, JSON, cache)
    assert rows.count() == 9000 and rows.where("doc_id % 3 = 0").select("n_tokens").distinct().count() == 1


def test_versions_have_counts_of_their_own(spark, cache):
    docs = cases.awkward(spark)
    model = public_tokenizers.path("piece_bpe_32k.model")
    token_counts.count_tokens(docs, JSON, cache).collect()
    rows = token_counts.count_tokens(docs, model, cache, keep=["text"], limit=3).collect()
    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    for r in rows:
        n = len(pieces.encode(r["text"] or ""))
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 3)
    assert stored_rows(spark, cache).select("tokenizer").distinct().count() == 2
    with pytest.raises(ValueError, match="sentencepiece"):
        token_counts.Tokenizer("vocabulary.txt")


def test_empty_table_and_clashing_names(spark, cache):
    assert token_counts.count_tokens(cases.empty(spark), JSON, cache).collect() == []
    docs = cases.with_clashes(cases.awkward(spark), "digest", "share", "kept", "n_tokens", "n_bytes")
    rows = token_counts.count_tokens(docs, JSON, cache, keep=["doc_id", "digest", "kept"])
    assert rows.columns == ["doc_id", "digest", "kept", "n_bytes", "n_tokens", "over_limit"] and rows.count() == len(cases.AWKWARD)
    with pytest.raises(ValueError, match="names of the result"):
        token_counts.count_tokens(docs, JSON, cache, keep=["n_tokens"])


def test_two_writers_of_one_digest(spark, cache):
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    token_counts.count_tokens(docs, JSON, cache).collect()
    part = f"{cache}/tokenizer={token_counts.Tokenizer(JSON).version()}"
    spark.createDataFrame(spark.read.parquet(part).collect(), token_counts.CACHE).write.mode("append").parquet(part)
    assert token_counts.count_tokens(docs, JSON, cache).count() == 1


def _counter():
    return token_counts.Tokenizer(JSON).counter()


def test_words_are_counted_as_the_library_counts_texts(sf_dir):
    odd = ["", " ", "  a  b \n\n c", "don't we'll I'm 'S '", "x\u00a0y\u2003z \u3000 w", "caf\u00e9 na\u0308ive \u0661\u0662\u00b2", "a<|endoftext|>b", "\x1c\x1d a\x85b",
           "\u4e2d\u6587 \U0001f600", "\t\tdef f(x):\r\n    return x+1;;;", "\u200b\u200d\ufeff", "a" * 50_000, " " * 50_000, "1234567 89"]
    count = _counter()
    for texts in (odd, [t or "" for t in cases.texts(sf_dir).values()]):
        assert count(texts) == [brute(t) for t in texts]


COUNT = _counter()


@given(st.lists(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x3100), st.sampled_from(" \n\t'sdab1<|>"))), max_size=5))
@settings(max_examples=300, deadline=None)
def test_any_text_is_counted_as_the_library_counts_it(texts):
    assert COUNT(texts) == [brute(t) for t in texts]


def test_other_tokenizers_count_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = tokenizers.Tokenizer.from_file(path)
    texts = ["Two Words", "", "a<|endoftext|>b  c"]
    assert token_counts.Tokenizer(path).counter()(texts) == [len(encoder.encode(t, add_special_tokens=False).ids) for t in texts]


def test_few_words_are_kept(monkeypatch):
    monkeypatch.setattr(token_counts.WordCounts, "MOST", 3)
    texts = [f"word{i} and more{i} of it" for i in range(50)]
    assert _counter()(texts) == [brute(t) for t in texts]
