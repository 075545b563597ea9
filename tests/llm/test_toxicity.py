import zlib

from pyspark.sql import functions as F
from tests.llm.cases import awkward, empty, with_clashes

from pitchlake.llm import registry, toxicity

LABELS = "doc_id long, quality int, toxic int"


def area(pairs):
    """Share of (toxic, clean) pairs in the right order."""
    yes, no = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in yes for b in no) / (len(yes) * len(no))


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = registry.op1_toxicity(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    assert area([(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]) > 0.7


def learnable(spark):
    bad = ["awful", "vileword", "nastyman"]
    docs = [(i, f"common text number {'abcdefgh'[i % 8]} with words {'you are ' + bad[i % 3] if i % 4 == 0 else 'you are kind'} and more", "en", "s", 0)
            for i in range(400)]
    frame = spark.createDataFrame([(i, t.replace("number", f"n{i}"), *r) for i, t, *r in docs], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], LABELS)
    return frame, labels


def test_learns_words_and_ignores_labels_that_are_held_out(spark):
    docs, labels = learnable(spark)
    learn = F.col("doc_id") % 5 != 1
    first = {r["doc_id"]: r["score"] for r in toxicity.score(docs, labels, learn).collect()}
    assert all((first[i] >= 0.3) == (i % 4 == 0) for i in range(400))
    turned = labels.withColumn("toxic", F.when(learn, F.col("toxic")).otherwise(1 - F.col("toxic")))
    assert {r["doc_id"]: r["score"] for r in toxicity.score(docs, turned, learn).collect()} == first


def test_features():
    lexicon = toxicity.Lexicon({"idiot": 1.5}, {"moro": 1.2, "wea": 0.6})
    value = dict(zip(toxicity.FEATURES, toxicity.features("You IDIOT! m0rons, weak 1d1ot", lexicon, lexicon.heads)))
    assert len(value) == len(toxicity.FEATURES)
    assert value["word_density"] == 1 / 5 and value["second_person_near"] == 1 / 5 and value["hidden_words"] == 2 / 5
    assert value["exclamations"] > 0 and value["capitals"] > 0.1 and value["shouted_words"] == 1 / 5
    assert toxicity.features(None, lexicon, lexicon.heads)[0] == toxicity.features("", lexicon, lexicon.heads)[0] == 0
    assert toxicity.features(None, lexicon, lexicon.heads) == toxicity.features(" ", lexicon, lexicon.heads)


def test_awkward_rows(spark):
    docs, labels = learnable(spark)
    odd = with_clashes(docs.unionByName(awkward(spark)), "features", "raw", "rawPrediction", "probability", "prediction", "label", "fold", "values")
    more = labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, 1, None), (5, 0, 0), (5, 1, 1)], LABELS))
    rows = toxicity.score(odd, more, F.lit(True)).collect()
    assert len(rows) == 412 and all(0 <= r["score"] <= 1 and r["label"] == "extra" for r in rows)
    blank = {r["score"] for r in rows if r["doc_id"] in (1, 2) and not r["text"]}
    assert len(blank) == 1
    assert toxicity.score(empty(spark), labels, F.lit(True)).collect() == []
    none = toxicity.score(awkward(spark), labels.limit(0), F.lit(True)).collect()
    assert len(none) == 12 and {r["score"] for r in none} == {0.0}
