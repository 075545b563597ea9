import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pitchlake.llm import words as W

TEXT = st.text(alphabet="aAbÉ \t\n\x0b.,0 ", max_size=40)


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8), st.sampled_from([4, 1 << 20]))
def test_words_are_those_of_the_pattern(texts, chunk):
    before = W.CHUNK
    W.CHUNK = chunk
    try:
        hashes, counts = W.word_hashes(pa.array(texts, pa.string()))
    finally:
        W.CHUNK = before
    expected = [plain(t) for t in texts]
    assert counts.tolist() == [len(w) for w in expected]
    name = {}
    for h, w in zip(hashes.tolist(), [w for ws in expected for w in ws]):
        assert name.setdefault(h, w) == w
    assert len(set(name.values())) == len(name)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, max_size=6), st.integers(1, 4))
def test_shingles_are_windows_or_the_whole(texts, k):
    made, number = W.shingles(*W.word_hashes(pa.array(texts, pa.string())), k)
    expected = []
    for text in texts:
        w = plain(text)
        expected.append([tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)] if w else [])
    assert number.tolist() == [len(x) for x in expected]
    name = {}
    for h, s in zip(made.tolist(), [s for x in expected for s in x]):
        assert name.setdefault(h, s) == s
    assert len(set(name.values())) == len(name)


def test_slices_and_long_words():
    array = pa.array(["x y", None, "zz " * 3, "q" * 3_000_000]).slice(1)
    hashes, counts = W.word_hashes(array)
    assert counts.tolist() == [0, 3, 1] and len(set(hashes.tolist())) == 2


def test_signs_separate_words():
    assert W.word_hashes(pa.array(["a,b|c.d e_f É!"]), W.SIGNS)[1].tolist() == [7]
    with pytest.raises(IndexError):
        W.word_hashes(pa.array(["a"]), W.SIGNS)[0][1]
