"""Benchmark decontamination by latent semantic retrieval.

Documents are cut into overlapping passages. A passage's TF-IDF vector has the terms of the benchmark (frequent ones have no
weight, unless an item has few others); all its other words count in its length. Frequencies are taken over documents that
are no copies, outside of what they share with items, so neither copies nor leaks make a term frequent. A distributed randomised
SVD of all passages and items (single-pass Nystrom: one sketch of the Gram matrix, summed over all tasks) gives the latent
space, in which the items, however rarely they leaked, weigh as much as all passages together. A passage is a candidate if it
holds enough of an item in that space, whatever else it holds; it leaks if the longest common subsequence with the item is
long, or, for paraphrases, of middle length while the item's answer (its last sentence) is there as well.

The benchmark is a stated set of queries. It is processed in blocks of items, which bounds every model. The documents' words are
hashed once and stored as numbers of the benchmark's words, which all steps read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.storage import stored
from pitchlake.llm.words import ROWS, SIGNS, shingles, word_hashes

#: Words of a passage, and from one passage to the next.
WIDTH, STEP = 48, 24
#: Items of one block.
ITEMS = 500
#: Directions of the sketch beyond the number of items.
OVERSAMPLE = 16
#: Terms in more than this share of the documents have no weight.
FREQUENT = 0.1
#: Least share of an item's words that have a weight.
WEIGHTED = 0.5
#: Least share of an item (its squared length in the latent space) in a candidate.
SHARE = 0.25
#: Share of an item's words in common order from which on a passage leaks: by itself, or with the answer.
VERBATIM, PARAPHRASE, ANSWER = 0.75, 0.5, 0.6
#: A passage is projected if its terms could give an item this part of the least share; the latent space is not exact.
BOUND = 0.8
#: The stretch compared with an item is so many times as long as the item.
STRETCH = 1.4


@dataclass
class Block:
    """A block of items: word numbers of each, its answers, and the model over the sorted vocabulary ``terms``."""

    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    terms: np.ndarray
    place: np.ndarray  # of every word number among the terms, -1 for others
    weights: np.ndarray | None = None
    other: float = 0.0  # weight of words outside the vocabulary
    latent: np.ndarray | None = None  # terms x directions
    items: np.ndarray | None = None  # items x directions, of length one
    least: np.ndarray | None = None  # what a candidate's vector has along each of these, at least
    most: np.ndarray | None = None  # each term's contribution to that, at most


def _answer(text: str) -> str:
    """The last sentence, or the last quarter of the words if there is one sentence only."""
    words = text.split()
    ends = [i for i, w in enumerate(words[:-1]) if w[-1:] in ".!?:\n"]
    last = words[ends[-1] + 1 :] if ends else []
    return " ".join(last if len(last) >= 3 else words[-max(3, len(words) // 4) :])


def blocks(benchmark: list[tuple[int, str | None]]) -> tuple[np.ndarray, Iterator[Block]]:
    """The sorted hashes of all items' words, and the blocks. A word's number is its place there, from 1; 0 is any other word."""
    items = [(i, t) for i, t in benchmark if t is not None]

    def split(texts: list[str]) -> list[np.ndarray]:
        hashes, counts = word_hashes(pa.array(texts, pa.string()), SIGNS)
        return np.split(hashes, np.cumsum(counts)[:-1])

    words, answers = split([t for _, t in items]), split([_answer(t) for _, t in items])
    vocabulary = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *(x for w, a in zip(words, answers) if len(w) >= 3 for x in (w, a))]))

    def made() -> Iterator[Block]:
        for first in range(0, len(items), ITEMS):
            kept = [k for k in range(first, min(first + ITEMS, len(items))) if len(words[k]) >= 3]
            if kept:
                chosen, last = ([np.searchsorted(vocabulary, x[k]) + 1 for k in kept] for x in (words, answers))
                terms = np.unique(np.concatenate(chosen))
                place = np.full(len(vocabulary) + 1, -1, dtype=np.int64)
                place[terms] = np.arange(len(terms))
                yield Block([items[k][0] for k in kept], chosen, last, terms, place)

    return vocabulary, made()


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, len(batch), ROWS):
            yield batch.slice(first, ROWS)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Runs of ``values``, as many as ``counts`` tells, as binary."""
    ends = np.concatenate(([0], np.cumsum(counts))) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(values)]).cast(pa.binary())


def _flat(lists: pa.Array, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(values, number of each) of binary runs."""
    if not len(lists):
        return np.zeros(0, dtype=dtype), np.zeros(0, dtype=np.int64)
    lists = lists.cast(pa.large_binary())
    ends = np.frombuffer(lists.buffers()[1], np.int64)[lists.offset : lists.offset + len(lists) + 1] // dtype.itemsize
    data = lists.buffers()[2]
    values = np.frombuffer(data, dtype)[ends[0] : ends[-1]] if data is not None and ends[-1] > ends[0] else np.zeros(0, dtype=dtype)
    return values, np.diff(ends)


def word_numbers(documents: DataFrame, key: str, text: str, vocabulary: np.ndarray) -> DataFrame:
    """(``key``, ``print``, ``words``): each document's fingerprint, null without words, and the numbers of its words in order.

    The fingerprint is the least three-word shingle, which near copies mostly share.
    """
    dtype = np.min_scalar_type(len(vocabulary))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            hashes, counts = word_hashes(batch.column(1), SIGNS)
            at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
            numbers = np.where(vocabulary[at] == hashes, at + 1, 0).astype(dtype)
            made, number = shingles(hashes, counts, 3)
            held = np.flatnonzero(number)
            prints = np.zeros(len(batch), dtype=np.uint64)
            if len(held):
                prints[held] = np.minimum.reduceat(made, (np.cumsum(number) - number)[held])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64), mask=number == 0), _lists(numbers, counts)], names=["key", "print", "words"])

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(scan, f"key {kind}, print long, words binary")


def _document_frequencies(documents: DataFrame, dtype: np.dtype, block: Block) -> tuple[np.ndarray, int]:
    """How many documents hold each term, and their number: over all documents (of word numbers), in which copies count once.

    Of documents with one fingerprint one counts. A word that stands beside the same word as in an item is not counted, as it
    may be leaked.
    """
    n = len(block.terms)
    leaked = np.unique(np.concatenate([block.place[w[:-1]] * n + block.place[w[1:]] for w in block.words]))
    wire = np.min_scalar_type(n).newbyteorder(">")  # as bytes in the order of the numbers

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            numbers, counts = _flat(batch.column(1), dtype)
            place = block.place[numbers]
            known = np.flatnonzero(place >= 0)
            term, owner = place[known], np.repeat(np.arange(len(counts)), counts)[known]
            pairs = term[:-1] * n + term[1:]
            beside = (known[1:] == known[:-1] + 1) & (owner[1:] == owner[:-1])
            shared = beside & (leaked[np.minimum(np.searchsorted(leaked, pairs), len(leaked) - 1)] == pairs)
            free = ~(np.append(shared, False) | np.append(False, shared)) if len(known) else np.zeros(0, dtype=bool)
            found = np.unique(owner[free] * n + term[free])
            number = np.bincount(found // n, minlength=len(counts))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists((found % n).astype(wire), number)], names=["print", "terms"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(n, dtype=np.int64), 0
        for batch in batches:
            found += np.bincount(_flat(batch.column(0), wire)[0], minlength=n)
            rows += len(batch)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *some], pa.int32()), pa.array([rows, *found[some]], pa.int64())], names=["term", "n"])

    once = documents.where("print is not null").select("print", "words").mapInArrow(held, "print long, terms binary")
    once = once.groupBy("print").agg(F.max("terms").alias("terms")).select("terms")
    counted = once.mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(counted.column(0).to_pylist(), counted.column(1).to_pylist()))
    return np.array([found.get(i, 0) for i in range(n)]), found.get(-1, 0)


def passages(numbers: np.ndarray, counts: np.ndarray, block: Block) -> tuple:
    """Sparse rows of all passages that hold a weighted term.

    Returns the first word of each text; per passage its text, first word and the length of its vector, to which its other
    words contribute; per entry its passage, term, weight.
    """
    first = np.concatenate(([0], np.cumsum(counts)))
    number = np.where(counts > WIDTH, -(-(counts - WIDTH) // STEP) + 1, (counts > 0).astype(np.int64))
    base = np.concatenate(([0], np.cumsum(number)))
    at = block.place[numbers]
    known = np.flatnonzero(at >= 0)
    owner = np.repeat(np.arange(len(counts)), counts)[known]
    local = known - first[owner]
    # word t lies in the passages from (t - WIDTH) // STEP + 1 to t // STEP that exist
    rows, terms = [], []
    for back in range(-(-WIDTH // STEP)):
        passage = local // STEP - back
        inside = (passage >= 0) & (passage < number[owner]) & (local - passage * STEP < WIDTH)
        rows.append((base[owner] + passage)[inside])
        terms.append(at[known][inside])
    rows, terms = np.concatenate(rows), np.concatenate(terms)
    text_of = np.repeat(np.arange(len(counts)), number)
    start = (np.arange(len(text_of)) - base[text_of]) * STEP
    length = np.minimum(counts[text_of] - start, WIDTH)
    others = length - np.bincount(rows, minlength=len(text_of))
    key, tf = np.unique(rows * len(block.terms) + terms, return_counts=True)
    row, term = key // len(block.terms), key % len(block.terms)
    weight = (1 + np.log(tf)) * block.weights[term]
    weighted = weight > 0
    row, term, weight = row[weighted], term[weighted], weight[weighted]
    squared = np.bincount(row, weight * weight, minlength=len(text_of)) + others * block.other**2
    return first, text_of, start, np.sqrt(squared), row, term, weight


def _dense(row: np.ndarray, term: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passages, terms, weights of each pair of them) of a slice of entries: a small matrix, to be multiplied as a whole."""
    passage, i = np.unique(row, return_inverse=True)
    terms, j = np.unique(term, return_inverse=True)
    dense = np.zeros((len(passage), len(terms)), dtype=np.float32)
    dense[i, j] = weight
    return passage, terms, dense


def _slices(row: np.ndarray, entries: int = 2_000) -> Iterator[slice]:
    """Runs of whole passages with about so many entries."""
    at = 0
    while at < len(row):
        stop = len(row) if at + entries >= len(row) else int(np.searchsorted(row, row[at + entries], "left"))
        stop = stop if stop > at else int(np.searchsorted(row, row[at], "right"))
        yield slice(at, stop)
        at = stop


def _gram_sketch(documents: DataFrame, dtype: np.dtype, block: Block, omega: np.ndarray) -> tuple[np.ndarray, float]:
    """The passages' Gram matrix times ``omega``, and its trace, summed over all tasks by Spark."""
    n, r = omega.shape
    rows_of_part = 128

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, trace = np.zeros((n, r), dtype=np.float32), 0.0
        for batch in _small(batches):
            *_, length, row, term, weight = passages(*_flat(batch.column(0), dtype), block)
            weight = weight / length[row]
            trace += float((weight * weight).sum())
            for part in _slices(row):
                _, terms, dense = _dense(row[part], term[part], weight[part])
                total[terms] += dense.T @ (dense @ omega[terms])
        parts = range(0, n, rows_of_part)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*range(len(parts)), -1], pa.int32()),
             pa.array([*(total[i : i + rows_of_part].tobytes() for i in parts), np.array([trace], dtype=np.float32).tobytes()], pa.binary())],
            names=["part", "values"])

    def add(group: pa.Table) -> pa.Table:
        values = sum(np.frombuffer(v.as_py(), np.float32).astype(np.float64) for v in group.column("values"))
        return pa.table({"part": group.column("part").slice(0, 1), "values": pa.array([values.tobytes()], pa.binary())})

    summed = documents.select("words").mapInArrow(sketch, "part int, values binary").groupBy("part").applyInArrow(
        add, "part int, values binary").toArrow()  # terms x directions numbers
    by_part = {p: np.frombuffer(v, np.float64) for p, v in zip(summed.column(0).to_pylist(), summed.column(1).to_pylist())}
    trace = float(by_part.pop(-1, np.zeros(1))[0])
    made = np.concatenate([by_part[p] for p in sorted(by_part)]).reshape(n, r) if by_part else np.zeros((n, r))
    return made, trace


def fit(documents: DataFrame, dtype: np.dtype, block: Block, seed: int = 11) -> None:
    """Term weights over all documents (of word numbers), then the latent space over all passages and items."""
    df, n = _document_frequencies(documents, dtype, block)
    idf = np.log((1 + n) / (1 + df)) + 1e-9
    floor = -math.log(FREQUENT)
    # within a factor of two, so that no few words decide about an item, and alike at every size of the table
    weights = np.where(df > FREQUENT * max(n, 1), 0.0, np.clip(idf, floor, 2 * floor))
    item_words = [block.place[w] for w in block.words]
    low = weights == 0
    for words in item_words:  # an item of frequent terms is found by its rarest ones
        terms, tf = np.unique(words, return_counts=True)
        order = np.argsort(df[terms] * low[terms], kind="stable")
        lifted = terms[order[np.cumsum(tf[order]) - tf[order] < WEIGHTED * len(words)]]
        weights[lifted] = np.maximum(weights[lifted], floor)
    block.weights, block.other = weights, float(weights[weights > 0].mean())
    items = np.zeros((len(block.words), len(block.terms)), dtype=np.float32)
    for k, words in enumerate(item_words):
        terms, tf = np.unique(words, return_counts=True)
        items[k, terms] = (1 + np.log(tf)) * weights[terms]
    size = np.sqrt((items * items).sum(axis=1))
    items /= size[:, None]
    r = min(len(block.terms), len(items) + OVERSAMPLE)
    omega = np.random.default_rng(seed).standard_normal((len(block.terms), r)).astype(np.float32)
    gram, trace = _gram_sketch(documents, dtype, block, omega)
    # the items weigh as much as all passages together
    gram = gram + max(1.0, trace / len(items)) * (items.T.astype(np.float64) @ (items @ omega))
    shift = 1e-7 * np.linalg.norm(gram)
    gram = gram + shift * omega
    core = omega.T @ gram
    core = (core + core.T) / 2
    values, vectors = np.linalg.eigh(core)
    good = values > 1e-10 * values.max()
    left, _, _ = np.linalg.svd(gram @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    block.latent = left.astype(np.float32)
    latent = items @ block.latent
    kept = np.maximum(np.sqrt((latent * latent).sum(axis=1)), 1e-9)
    block.items = latent / kept[:, None]
    # a passage may hold a part of a longer item only
    part = np.minimum(1.0, (WIDTH - STEP / 2) / np.array([len(w) for w in block.words]))
    block.least = SHARE * part * size * kept
    # the item's share in the space itself, without the part that the sketch leaves out
    block.most = (items / (SHARE * part * size)[:, None]).max(axis=0)


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a bit of a long number per word of ``a``."""
    masks: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b.tolist():
        m = masks.get(w, 0)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - bin(row).count("1")


def _around(item: np.ndarray, words: np.ndarray, start: int) -> tuple[int, int, int]:
    """(words of a stretch, first and last word of where they begin and end) around the passage at word ``start``."""
    length = max(3, int(len(item) * STRETCH))
    return length, max(0, start - length), min(len(words), start + WIDTH + length)


def may_leak(item: np.ndarray, words: np.ndarray, start: int) -> bool:
    """Whether enough of the item's words are near the passage in any order, without which they are not in common order either."""
    length, low, high = _around(item, words, start)
    return np.isin(item, words[low : high + length]).sum() >= PARAPHRASE * len(item)


def verify(item: np.ndarray, answer: np.ndarray, words: np.ndarray, start: int) -> tuple[float, float]:
    """(share of the item, share of its answer) in the best stretch around the passage at word ``start``."""
    length, low, high = _around(item, words, start)
    best, best_at = 0, low
    for at in range(low, max(low + 1, high - length // 2), max(1, len(item) // 6)):
        found = common_subsequence(item, words[at : at + length])
        if found > best:
            best, best_at = found, at
    stretch = words[best_at : best_at + length + len(answer)]
    return best / len(item), common_subsequence(answer, stretch) / max(1, len(answer))


def find_leaks(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and item that leaked into it: ``key``, ``item_id``, ``cosine``, ``lcs``, ``answer``, ``start`` (word).

    Null and empty texts leak nothing, items of fewer than three words or without a text are not looked for, and equal items
    are each reported. Repeated documents give one row for each item and text; a null key is reported as null.
    """
    spark = documents.sparkSession
    kind = documents.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, item_id long, cosine double, lcs double, answer double, start long"
    queries = [(r["item_id"], r["text"]) for r in benchmark.select("item_id", "text").orderBy("item_id", "text").collect()]
    vocabulary, parts = blocks(queries)
    if not len(vocabulary):
        return spark.createDataFrame([], schema)
    numbered, dtype = stored(word_numbers(documents, key, text, vocabulary), "words"), np.min_scalar_type(len(vocabulary))
    found = None
    for block in parts:
        fit(numbered, dtype, block)

        def search(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            for batch in _small(batches):
                numbers, counts = _flat(batch.column(1), dtype)
                first, text_of, start, size, row, term, weight = passages(numbers, counts, block)
                # no item has a larger share in a passage than its terms can give
                enough = np.bincount(row, weight * block.most[term], minlength=len(text_of))[row] >= BOUND
                row, term, weight = row[enough], term[enough], weight[enough]
                best: dict[tuple[int, int], tuple] = {}
                for part in _slices(row):
                    passage, terms, dense = _dense(row[part], term[part], weight[part])
                    along = dense @ block.latent[terms] @ block.items.T
                    for i, k in zip(*np.nonzero(along >= block.least)):
                        doc, at = int(text_of[passage[i]]), int(start[passage[i]])
                        words = numbers[first[doc] : first[doc + 1]]
                        if not may_leak(block.words[k], words, at):
                            continue
                        lcs, answer = verify(block.words[k], block.answers[k], words, at)
                        if lcs >= VERBATIM or (lcs >= PARAPHRASE and answer >= ANSWER):
                            hit = (lcs, answer, float(along[i, k] / size[passage[i]]), -at)
                            best[doc, int(k)] = max(hit, best.get((doc, int(k)), hit))
                pairs = sorted(best)
                values = [best[p] for p in pairs]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([d for d, _ in pairs], pa.int64())), pa.array([block.ids[k] for _, k in pairs], pa.int64()),
                     pa.array([v[2] for v in values], pa.float64()), pa.array([v[0] for v in values], pa.float64()),
                     pa.array([v[1] for v in values], pa.float64()), pa.array([-v[3] for v in values], pa.int64())],
                    names=[key, "item_id", "cosine", "lcs", "answer", "start"])

        rows = numbered.select("key", "words").mapInArrow(search, schema)
        found = rows if found is None else found.unionByName(rows)
    return found.dropDuplicates([key, "item_id", "start"])
