import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.cases import awkward, empty, texts, with_clashes

from pitchlake.llm import personal_data, registry

FORMS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    found = []
    for kind, form in enumerate(FORMS):
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            checks = [int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(digits[::-1])]
            fits = (True, all(int(p) <= 255 for p in m.group().split(".")) if kind == 1 else True,
                    12 <= len(digits) <= 19 and sum(checks) % 10 == 0, 9 <= len(digits) <= 15)[kind]
            if fits:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_whole_table(spark, sf_dir):
    docs = texts(sf_dir)
    found = registry.op8_personal_data(spark, sf_dir).collect()
    assert {r["doc_id"] for r in found} == set(docs)
    for r in found:
        spans = brute(docs[r["doc_id"]])
        line = ",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in personal_data.KINDS] == [sum(s[1] == i for s in spans) for i in range(4)]
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a@.-+0123459 ()é_%", max_size=60))
def test_base_spans_are_those_of_the_forms(text):
    assert personal_data.base_spans(text) == brute(text)


def test_long_runs_take_no_square_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "+1" + "(" * 300_000, "1." * 150_000, "a@" * 100_000):
        personal_data.base_spans(text)


def test_contexts_find_what_no_form_describes(spark):
    rows = [(i, f"please write to customer mailbox user{i}@mail.org when needed") for i in range(30)]
    rows += [(100, "please write to customer mailbox jo.doe77(at)mail.org when needed"), (101, "build number 20240117 is out")]
    rows += [(200 + i, f"build number {i}@host.example.org is out") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in personal_data.personal_data(df).collect()}
    start = rows[30][1].index("jo.doe77")
    assert [tuple(s) for s in found[100]["added"]] == [(start, 0, start + len("jo.doe77(at)mail.org"))]
    assert all(not r["added"] for i, r in found.items() if i != 100)


def test_unsure_contexts_find_nothing(spark):
    rows = [(i, f"see entry number user{i}@mail.org") for i in range(10)] + [(50 + i, f"see entry number {i}12345678") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(not r["added"] for r in personal_data.personal_data(df).collect())


def test_awkward_rows(spark):
    docs = with_clashes(awkward(spark), "pattern", "instance", "kind", "start", "end", "base", "_row2")
    rows = personal_data.personal_data(docs).collect()
    assert len(rows) == 12 and all(r["base"] == [] and r["added"] == [] and r["kind"] == "extra" for r in rows)
    assert personal_data.personal_data(empty(spark)).collect() == []
