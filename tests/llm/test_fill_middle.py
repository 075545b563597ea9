import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from pitchlake.llm import fill_middle as fim
from pitchlake.llm import registry
from tests.llm import cases


def brute(key, text, percent=100, spm_percent=50, seed="7"):
    """By slices of the string: n, form, counts, output."""
    text = text or ""
    lines = text.split("\n")
    lines = [line + "\n" for line in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
    n = len(lines)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(s in text for s in fim.SENTINELS) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm_percent:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def check(docs, **options):
    made = fim.fill_in_middle(docs, keep=["doc_id", "text"], with_output=True, **options)
    rows = made.collect()
    for r in rows:
        n, form, prefix, middle, output = brute(r["doc_id"], r["text"], **options)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == (n, form, prefix, middle, output)
        assert r["output_sha256"] == sha(output)
        buffers = ((r["text"] or "").encode(), "".join(fim.SENTINELS).encode())
        assert b"".join(buffers[p["buffer"]][p["start"] : p["start"] + p["length"]] for p in r["pieces"]).decode() == output
    for r in fim.restore(made, keep=["doc_id", "text"]).collect():
        assert r["restored"] == (r["text"] or "") and r["restored_sha256"] == sha(r["text"])
    return rows


def test_equals_slices_of_the_whole_table(spark, sf_dir):
    rows = check(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert {r["form"] for r in rows} >= {"psm", "spm"}


def test_awkward_rows(spark):
    extra = [(20, "\n\n\n", "en", "s", 3), (21, "no end\n", "en", "s", 7), (22, "é\nü\n\U0001f600 last", "en", "s", 8),
             (23, "a <S> inside\nb", "en", "s", 14), (24, "<\nP>\n<S\n>", "en", "s", 9), (25, "line\n" * 60_000, "en", "s", 1), (26, "\r\n\r", "en", "s", 3)]
    docs = cases.awkward(spark).unionByName(spark.createDataFrame(extra, cases.DOCUMENTS))
    rows = check(docs)
    assert len(rows) == len(cases.AWKWARD) + len(extra)
    assert {r["doc_id"] for r in rows if r["form"] == "plain"} == {1, 2, 23}
    twice = [r for r in rows if r["doc_id"] == 5]
    assert twice[0] == twice[1]


def test_shares_of_forms(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert {r["form"] for r in check(docs, percent=0)} == {"plain"}
    assert "psm" not in {r["form"] for r in check(docs, spm_percent=100)}
    forms = [r["form"] for r in check(docs, percent=50, seed="other")]
    assert 0.3 < forms.count("plain") / len(forms) < 0.7


def test_empty_table_and_clashing_names(spark):
    assert fim.fill_in_middle(cases.empty(spark)).collect() == []
    docs = cases.with_clashes(cases.awkward(spark), "n", "form", "pieces", "kept", "h1", "output")
    assert fim.fill_in_middle(docs, keep=["doc_id", "kept", "h1"]).columns[:3] == ["doc_id", "kept", "h1"]
    assert fim.fill_in_middle(docs).count() == len(cases.AWKWARD)
    with pytest.raises(ValueError, match="names of the result"):
        fim.fill_in_middle(docs, keep=["doc_id", "form"])


def test_sentinels():
    with pytest.raises(ValueError, match="sentinels"):
        fim.checked(("aa", "ab", "c"))
    with pytest.raises(ValueError, match="sentinels"):
        fim.checked(("<P>", "<P>", "<M>"))
    assert fim.checked(("<|p|>", "<|s|>", "<|m|>"))


def test_cutting_splits_and_the_inverse_restores():
    marks = fim.checked(fim.SENTINELS)
    data = "one\ntwo\nthree".encode()
    for form, order in fim.ARRANGEMENTS.items():
        for first in range(len(data) + 1):
            for second in range(first, len(data) + 1):
                table = fim.transform(data, first, second, form, marks)
                assert fim.invert(table.joined(), form, marks).joined() == data
                assert table.restored(order).joined() == data + b"".join(marks)


def test_query_and_sql(spark, sf_dir, duck):
    rows = registry.op13_fill_in_middle(spark, sf_dir)
    expected = duck.execute(registry.ORACLE["op13_fill_in_middle"])
    names = [c[0] for c in expected.description]
    assert sorted(names) == sorted(rows.columns)
    assert sorted(map(tuple, rows.select(*names).collect())) == sorted(expected.fetchall())
    texts = dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall())
    assert rows.where(F.col("form") == "plain").count() == sum(brute(k, t)[1] == "plain" for k, t in texts.items())
    assert all(r["restored_sha256"] == sha(texts[r["doc_id"]]) for r in rows.collect())
