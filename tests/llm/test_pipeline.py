import corpus_pipeline
from tests.llm.cases import awkward, texts

from pitchlake.llm import decontaminate, jaccard_join, line_templates


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.count() == len(after) and set(after) <= set(before) and len(after) > 0.5 * len(before)
        # line dedup changes texts and drops only documents of nothing else; the others drop documents and change no text
        if name == "line_dedup":
            assert any(after[i] != before[i] for i in after) and all(len(after[i] or "") <= len(before[i] or "") for i in after)
        else:
            assert set(after) < set(before) and all(after[i] == before[i] for i in after)
        before = after
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    learned = [d for d in labels if d in before]
    assert sum(labels[d] for d in learned) < 0.4 * sum(labels.values())
    assert line_templates.drop_recurring_lines(docs).where("n_dropped > 2").count() < 10
    groups = jaccard_join.similar_groups(docs, k=5, percent=80)
    assert groups.where("doc_id <> component_id").count() == 0
    assert decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).count() == 0
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(before)
    assert set(texts(sf_dir)) > set(before)


def test_awkward_rows(spark, tmp_path):
    awkward(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two three four")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in found.collect()} == {None, 1, 2, 3, 4, 5, 6, 7, 8}
