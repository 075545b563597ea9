import corpus_pipeline
import duckdb
from tests.llm.cases import AWKWARD, awkward, empty, with_clashes

from pitchlake.llm import line_templates, registry


def result(df):
    return {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in df.collect()}


def own(i):
    return f"{' '.join(f'own{chr(97 + i % 26)}{chr(97 + k)}{chr(97 + i // 26)}' for k in range(12))} text of document"


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_against_sql(spark, duck, sf_dir):
    found = result(registry.op10_line_dedup(spark, sf_dir))
    expected = {r[0]: (r[3], r[1], r[2]) for r in duck.execute(registry.ORACLE["op10_line_dedup"]).fetchall()}
    assert found == expected
    assert sum(n for _, _, n in found.values()) > 0


def test_variable_fields_share_a_template(spark):
    texts = [f"{own(i)}\nPosted on 2024-01-{i:02d} by user{i}@mail.org\n\nsecond {own(i)}" for i in range(12)]
    found = result(line_templates.drop_recurring_lines(frame(spark, texts)))
    assert all(found[i] == (f"{own(i)}\n\nsecond {own(i)}", 4, 1) for i in range(12))


def test_variable_fields(spark):
    tokens = ["Plain", "a1", "1a", "7", "@", "x@y", "http://Host/a", "://", ":/", "a:b", "\u00a0x\u00a09", "caf\u00c9", "<*>", ":://", "a\u20281"]
    lines = [" ".join(tokens[i:] + tokens[:i]) for i in range(len(tokens))]
    expected = [" ".join("<*>" if "://" in t or any(c in "0123456789@" for c in t) else t.lower() for t in line.split(" ")) for line in lines]
    df = frame(spark, lines)
    assert [r[0] for r in df.orderBy("doc_id").select(line_templates._generalised(df["text"])).collect()] == expected


def test_the_middle_of_long_lines_is_variable(spark):
    line = "this site uses small files to remember what {} chose on earlier visits to it"
    texts = [f"{own(i)}\n{line.format('reader' + chr(97 + i))}" for i in range(10)]
    assert all(t == own(i) for i, (t, _, _) in result(line_templates.drop_recurring_lines(frame(spark, texts))).items())


def test_rare_lines_and_copied_documents_stay(spark):
    few = [f"{own(i)}\nonly in nine documents of this table" for i in range(9)]
    copies = [f"{own(99)}\nfirst line of a copied text\nsecond line of it"] * 30
    found = result(line_templates.drop_recurring_lines(frame(spark, few + copies)))
    assert all(n == 0 for _, _, n in found.values())


def test_awkward_rows(spark):
    docs = with_clashes(awkward(spark), "line", "line_no", "template", "gone", "salt", "n_tokens", "n_lines", "doc_key")
    found = line_templates.drop_recurring_lines(docs, min_docs=2).collect()
    assert len(found) == len(AWKWARD)
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[1][0]["text"] is None and by_id[1][0]["n_lines"] == 0
    assert by_id[2][0]["text"] == "" and by_id[2][0]["n_lines"] == 1
    assert by_id[3][0]["text"] == " \n\t " and by_id[3][0]["n_dropped"] == 0
    assert all(r["gone"] == "extra" for r in found)
    assert line_templates.drop_recurring_lines(empty(spark)).collect() == []


def test_many_lines(spark):
    text = "\n".join(["keep this line of one document"] + ["drop me"] * 20_000)
    docs = frame(spark, [text] + [f"{own(i)}\n{own(i + 30)} more\ndrop me" for i in range(20)])
    # most of the long document recurs, but nothing beside the line itself
    found = result(line_templates.drop_recurring_lines(docs))
    assert found[0] == ("keep this line of one document", 20_001, 20_000)


def test_copies_have_one_vote(spark):
    def texts(n):
        copies = [[f"{own(500 + g)}\nsecond line of group {chr(97 + g)}\nread our terms before you go on"] * 7 for g in range(n)]
        return sum(copies, [])

    few, many = (result(line_templates.drop_recurring_lines(frame(spark, texts(n)))) for n in (9, 10))
    assert all(n == 0 for _, _, n in few.values()) and all(n == 1 and "terms" not in t for t, _, n in many.values())


def test_passages_against_sql(spark, tmp_path):
    passage = " ".join(f"pass{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(55))
    line = "subscribe to our letter for more of this"
    texts = [f"{own(i)}\n{line}\n{own(i + 300)} more" for i in range(12)] + [f"{own(i)}\n{passage}\n{own(i + 300)} more" for i in (20, 21)]
    texts += [f"{own(700)}\nfirst line of a copied text\nlast line of a copied text\n{line}"] * 30 + ["", None, " \n\n", line, f"{passage} 7", f"{passage} 8"]
    docs = frame(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = result(registry.op10_line_dedup(spark, str(tmp_path)))
    with duckdb.connect() as own_tables:
        own_tables.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        expected = {r[0]: (r[3], r[1], r[2]) for r in own_tables.execute(registry.ORACLE["op10_line_dedup"]).fetchall()}
    assert found == expected
    assert all(found[i][2] == 1 for i in (*range(14), 14, 43))


def test_a_large_copy_group_does_not_rescue_boilerplate(spark, tmp_path):
    line = "subscribe to our letter for more of this"
    unrelated = [f"{own(i)}\n{line}\n{own(i + 300)} more" for i in range(40)]
    copies = [f"{own(700)}\nfirst line of a copied text\nsecond line of it\n{line}"] * 80
    near = [f"{own(800)}\nthird line of another text\nfourth line of it\nchanged{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(30)]
    texts = unrelated + copies + near
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, str(tmp_path)).collect()}
    assert all(line not in t for t in found.values())
    assert found == {i: "\n".join(x for x in t.split("\n") if x != line) for i, t in enumerate(texts)}


def test_passages_of_two_documents_go(spark, tmp_path):
    passage, numbers = " ".join(f"pass{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(55)), " ".join(map(str, range(60)))
    texts = [f"{own(i)}\n{line}\n{own(i + 300)} more" for i, line in enumerate([passage, passage, numbers, numbers + "9", "a short line"])]
    texts += [texts[-1].replace("document", "record"), *["\n".join(f"{own(900 + k)} {passage}x" for k in range(3))] * 5]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, str(tmp_path)).collect()}
    assert found == {i: t.replace(f"\n{passage}\n", "\n") for i, t in enumerate(texts)}


def test_long_lines_that_agree_at_their_ends_only_stay(spark, tmp_path):
    def line(i):
        return " ".join(["the same opening of eight words is here", *(f"mid{chr(97 + i)}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(50)), "and the same end"])

    same = f"{line(25)} 17"
    texts = [f"{own(i)}\n{line(i)}\n{own(i + 300)} more" for i in range(12)] + [f"{own(i)}\n{same}{i}\n{own(i + 300)} more" for i in range(20, 22)]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, str(tmp_path)).collect()}
    assert all(found[i] == texts[i] for i in range(12)) and all(found[i] == texts[i].replace(f"\n{same}{i + 8}", "") for i in (12, 13))
