"""A Katz backoff model of words, with Good-Turing discounts and exactly normalised backoff weights.

Texts are cut into chunks of whole documents and coded once by the chunk's own vocabulary. What a chunk must know of the whole
corpus it asks for in packed rows, one per chunk and bucket of the key space: each different word or word pair of a chunk is
sent once, with its count in the chunk's training documents (so a frequent one is added up before it is shuffled). One task
per bucket adds the counts of all chunks and answers every chunk in the order of its question. The answers are the model's
tables: level 1 has the words' counts, partitioned by word, level 2 the pairs' counts and their contexts' sums,
partitioned by context. Scoring evaluates the recursion for every token from them:

    P(w | v) = d(c(v, w)) c(v, w) / c(v)   if the pair was seen in training,
               a(v) P(w)                   if only v was seen (as a context),
               P(w)                        else,

with a(v) = (1 - sum of the seen P(w | v)) / (1 - sum of P(w) over the same w). P(w) is the discounted share of the word;
the mass taken from the seen words is that of one unknown word, so each distribution sums to one over the known words and it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.storage import shared_folder, stored
from pitchlake.llm.words import mix, word_hashes

#: Tokens of a chunk, at least, unless its task ends.
CHUNK_TOKENS = 2_000_000
#: Tokens of the corpus for each bucket of words, and of pairs.
PER_WORD_BUCKET, PER_PAIR_BUCKET = 4_000_000, 1_500_000
#: Counts above this are not discounted.
DISCOUNTED = 5
#: The hash of the end token; real words never get it but by a collision of 64 bits.
END = np.uint64(0x5BF0363521EA2F1D)


def discounts(n: np.ndarray) -> np.ndarray:
    """d(r) for r = 0 to DISCOUNTED by Katz's formula; ``n[r]``: how many events were seen r times, r up to DISCOUNTED + 1.

    Where the counts of counts are too sparse for it to lie strictly between 0 and 1, half an event is taken off.
    """
    d = np.ones(DISCOUNTED + 1)
    k = DISCOUNTED
    tail = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(1, k + 1):
        value = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) if n[r] and tail < 1 else 0.0
        d[r] = value if 0 < value < 1 else 1 - 0.5 / r
    return d


class Unigrams:
    """P(w) by the count of w in training."""

    def __init__(self, counts_of_counts: np.ndarray, tokens: int, types: int):
        self.tokens, self.types = tokens, types
        self.d = discounts(counts_of_counts)
        r = np.arange(DISCOUNTED + 2)
        left = ((1 - self.d) * r[:-1] * counts_of_counts[:-1]).sum() / max(1, tokens)
        # all words frequent: one more event is the unknown word's
        self.scale = 1.0 if left > 0 else tokens / (tokens + 1)
        self.unknown = left if left > 0 else 1 / (tokens + 1)

    def p(self, count: np.ndarray) -> np.ndarray:
        count = count.astype(np.float64)
        d = self.d[np.minimum(count, DISCOUNTED).astype(int)]
        seen = np.where(count > DISCOUNTED, 1.0, d) * count / max(1, self.tokens) * self.scale
        return np.where(count > 0, seen, self.unknown)


def pair_probability(c: np.ndarray, context: np.ndarray, p_word: np.ndarray, d: np.ndarray) -> np.ndarray:
    """P(w | v). ``context``: for each pair, v's sum of P(w) over seen w, its pairs seen 1..DISCOUNTED times, and the rest's count."""
    lower, by_count, rest = context[:, 0], context[:, 1 : DISCOUNTED + 1], context[:, DISCOUNTED + 1]
    r = np.arange(1, DISCOUNTED + 1)
    total = by_count @ r + rest
    given = by_count @ (r * d[1:]) + rest
    # no pair of this context was seen rarely: one more event is the unseen words'
    size = np.where(given < total, total, total + 1)
    share = np.where(c > DISCOUNTED, 1.0, d[np.minimum(c, DISCOUNTED).astype(int)])
    with np.errstate(divide="ignore", invalid="ignore"):
        seen = share * c / size
        backed = (1 - given / size) / (1 - lower) * p_word
    return np.where(total == 0, p_word, np.where(c > 0, seen, backed))


def _pack(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def _unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype)


def _chunks(documents: DataFrame, key: str, text: str, held_out: Column) -> DataFrame:
    """One row per chunk: ``vocabulary`` (sorted hashes) with ``counts`` in training, ``codes`` of all tokens, ``docs``."""
    kind = documents.schema[key].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, turn, ids, held, sizes, hashes, tokens = TaskContext.get().partitionId(), 0, [], [], [], [], 0

        def made() -> pa.RecordBatch:
            all_sizes, all_held = np.concatenate(sizes), np.concatenate(held)
            vocabulary, codes = np.unique(np.concatenate(hashes), return_inverse=True)
            train = np.repeat(~all_held, all_sizes)
            counts = np.bincount(codes[train], minlength=len(vocabulary)).astype(np.uint32)
            docs = pa.StructArray.from_arrays(
                [pa.concat_arrays(ids), pa.array(all_held), pa.array(all_sizes)], names=["key", "held", "n"])
            docs = pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 24 | turn], pa.int64()), pa.array([len(codes)], pa.int64()), pa.array([vocabulary.tobytes()], pa.binary()),
                 pa.array([_pack(counts)], pa.binary()), pa.array([_pack(codes.astype(np.uint32))], pa.binary()), docs],
                names=["chunk", "tokens", "vocabulary", "counts", "codes", "docs"])

        for batch in batches:
            # batches are cut, as one may hold many chunks' tokens
            for first in range(0, len(batch), 2000):
                rows = batch.slice(first, 2000)
                words, counts = word_hashes(rows.column(2))
                ends = np.cumsum(counts)
                hashes.append(np.insert(words, ends, END))
                sizes.append(counts + 1)
                ids.append(rows.column(0))
                held.append(rows.column(1).to_numpy(zero_copy_only=False).astype(bool))
                tokens += len(hashes[-1])
                if tokens >= CHUNK_TOKENS:
                    yield made()
                    ids, held, sizes, hashes, tokens, turn = [], [], [], [], 0, turn + 1
        if tokens:
            yield made()

    rows = documents.select(F.col(key).alias("key"), held_out.alias("held"), F.col(text).alias("text"))
    return rows.mapInArrow(read, (
        "chunk long, tokens long, vocabulary binary, counts binary, codes binary, "
        f"docs array<struct<key: {kind}, held: boolean, n: long>>"))


def _by_chunk(chunks: DataFrame) -> DataFrame:
    """The written table of chunks, bucketed by chunk: joining answers to it moves the answers only."""
    spark = chunks.sparkSession
    name = f"pitchlake_chunks_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks.write.option("path", f"{shared_folder(spark)}/{name}").option("compression", "zstd").bucketBy(parts, "chunk").saveAsTable(name)
    return spark.table(name)


ANSWER = "chunk long, level int, bucket int, a binary, b binary"


def _answer(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.table({n: pa.array(v, t) for n, t, v in zip(("chunk", "level", "bucket", "a", "b"), kinds, list(zip(*rows)) or [()] * 5)})


def _counts_of_counts(c: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(c, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[: DISCOUNTED + 2]


def _word_level(chunks: DataFrame, buckets: int) -> DataFrame:
    """Answers of level 1: for each word of a chunk its count (``a``) and its number in its bucket (``b``)."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, vocabulary, counts in zip(*(c.to_pylist() for c in batch.columns)):
                words, counts = np.frombuffer(vocabulary, np.uint64), _unpack(counts, np.uint32)
                ends = np.searchsorted(words, _borders(buckets))
                parts = [(b, *x) for b, x in enumerate(zip(np.concatenate(([0], ends)), np.append(ends, len(words)))) if x[0] < x[1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _, _ in parts], pa.int32()), pa.array([chunk] * len(parts), pa.int64()),
                     pa.array([words[i:j].tobytes() for _, i, j in parts], pa.binary()),
                     pa.array([counts[i:j].tobytes() for _, i, j in parts], pa.binary())], names=["bucket", "chunk", "words", "counts"])

    def add(group: pa.Table) -> pa.Table:
        words = [np.frombuffer(w, np.uint64) for w in group.column("words").to_pylist()]
        counts = [np.frombuffer(c, np.uint32) for c in group.column("counts").to_pylist()]
        types, place = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(place, np.concatenate(counts), minlength=len(types)).astype(np.int64)
        bucket = group.column("bucket")[0].as_py()
        rows, at = [], 0
        for chunk, w in zip(group.column("chunk").to_pylist(), words):
            mine = place[at : at + len(w)]
            rows.append((chunk, 1, bucket, _pack(total[mine]), _pack(mine.astype(np.uint32))))
            at += len(w)
        sums = np.concatenate(([total.sum(), (total > 0).sum(), len(types)], _counts_of_counts(total)))
        return _answer([*rows, (-1, 1, bucket, sums.astype(np.int64).tobytes(), b"")])

    asked = chunks.select("chunk", "vocabulary", "counts").mapInArrow(ask, "bucket int, chunk long, words binary, counts binary")
    return asked.groupBy("bucket").applyInArrow(add, ANSWER)


def _borders(buckets: int) -> np.ndarray:
    """The hashes at which the second and later buckets begin."""
    return np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=np.uint64)


def _sums(answers: DataFrame) -> np.ndarray:
    """The totals that the buckets of a level report, added up by Spark."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.frombuffer(a, np.int64) for a in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.arange(len(v)) for v in values]).astype(np.int32) if values else [], pa.int32()),
                 pa.array(np.concatenate(values) if values else [], pa.int64())], names=["i", "v"])

    rows = answers.where("chunk < 0").select("a").mapInArrow(unpack, "i int, v long").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(DISCOUNTED + 5, dtype=np.int64)
    for r in rows:
        out[r["i"]] = r["v"]
    return out


class _Coded:
    """A chunk with the answers of level 1: the number and the count of each token's word, and its different pairs."""

    def __init__(self, codes: bytes, sizes: np.ndarray, held: np.ndarray, answers: list[dict], word_buckets: int, pair_buckets: int):
        level = sorted((x for x in answers if x["level"] == 1), key=lambda x: x["bucket"])
        counts = np.concatenate([_unpack(x["a"], np.int64) for x in level])
        # 0 is the start of a text
        numbers = np.concatenate([_unpack(x["b"], np.uint32).astype(np.uint64) * np.uint64(word_buckets) + np.uint64(x["bucket"] + 1) for x in level])
        if numbers.max() >= 1 << 32:
            raise ValueError("more than 2**32 - 2 different words")
        codes = _unpack(codes, np.uint32)
        self.count = counts[codes]
        word = numbers[codes]
        before = np.concatenate((np.zeros(1, dtype=np.uint64), word[:-1]))
        starts = np.cumsum(sizes) - sizes
        before[starts] = 0
        self.starts = starts
        pairs, first, self.pair = np.unique(before << np.uint64(32) | word, return_index=True, return_inverse=True)
        train = np.repeat(~held, sizes)
        seen = np.bincount(self.pair[train], minlength=len(pairs)).astype(np.uint32)
        bucket = (mix(pairs >> np.uint64(32)) % np.uint64(pair_buckets)).astype(np.int64)
        # questions and answers are ordered by bucket, then by pair
        self.order = np.argsort(bucket, kind="stable")
        self.pairs, self.seen, self.words = pairs[self.order], seen[self.order], self.count[first][self.order]
        self.bucket = bucket[self.order]


def _pair_level(chunks: DataFrame, words: DataFrame, unigrams: Unigrams, word_buckets: int, pair_buckets: int) -> DataFrame:
    """Answers of level 2: each pair's count (``a``) and the sums of each different context (``b``)."""

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        answers, rows = right.to_pylist(), []
        for row in left.to_pylist():
            sizes, held = (np.array([d[n] for d in row["docs"]], dtype=t) for n, t in (("n", np.int64), ("held", bool)))
            coded = _Coded(row["codes"], sizes, held, answers, word_buckets, pair_buckets)
            ends = np.flatnonzero(np.diff(coded.bucket)) + 1
            for i, j in zip(np.concatenate(([0], ends)), np.append(ends, len(coded.bucket))):
                rows.append((int(coded.bucket[i]), row["chunk"], (coded.pairs[i:j] >> np.uint64(32)).astype(np.uint32).tobytes(),
                             coded.pairs[i:j].astype(np.uint32).tobytes(), _pack(coded.seen[i:j]), _pack(coded.words[i:j].astype(np.uint32))))
        names = ("bucket", "chunk", "contexts", "words", "seen", "counts")
        kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
        columns = list(zip(*rows)) or [()] * 6
        # contexts come in runs, which compress well
        columns[2] = [zstandard.compress(c, 1) for c in columns[2]]
        return pa.table({n: pa.array(v, t) for n, t, v in zip(names, kinds, columns)})

    def add(group: pa.Table) -> pa.Table:
        columns = {n: group.column(n).to_pylist() for n in group.column_names}
        pairs = [_unpack(v, np.uint32).astype(np.uint64) << np.uint64(32) | np.frombuffer(w, np.uint32) for v, w in zip(columns["contexts"], columns["words"])]
        seen = np.concatenate([_unpack(x, np.uint32) for x in columns["seen"]])
        types, first, place = np.unique(np.concatenate(pairs), return_index=True, return_inverse=True)
        count = np.bincount(place, seen, minlength=len(types)).astype(np.int64)
        p_word = unigrams.p(np.concatenate([_unpack(x, np.uint32) for x in columns["counts"]])[first])
        contexts, of = np.unique(types >> np.uint64(32), return_inverse=True)
        sums = np.zeros((len(contexts), DISCOUNTED + 2))
        sums[:, 0] = np.bincount(of, p_word * (count > 0), minlength=len(contexts))
        for r in range(1, DISCOUNTED + 1):
            sums[:, r] = np.bincount(of, count == r, minlength=len(contexts))
        sums[:, -1] = np.bincount(of, count * (count > DISCOUNTED), minlength=len(contexts))
        bucket, rows, at = columns["bucket"][0], [], 0
        for chunk, mine in zip(columns["chunk"], pairs):
            here = place[at : at + len(mine)]
            at += len(mine)
            different = np.searchsorted(contexts, np.unique(mine >> np.uint64(32)))
            rows.append((chunk, 2, bucket, _pack(count[here].astype(np.uint32)), _pack(
                np.concatenate((sums[different, 0].view(np.uint64), sums[different, 1:].astype(np.uint64).T.ravel())))))
        totals = np.concatenate(([0, 0, 0], _counts_of_counts(count)))
        return _answer([*rows, (-1, 2, bucket, totals.astype(np.int64).tobytes(), b"")])

    asked = chunks.select("chunk", "codes", "docs").groupBy("chunk").cogroup(words.where("chunk >= 0").groupBy("chunk")).applyInArrow(
        ask, "bucket int, chunk long, contexts binary, words binary, seen binary, counts binary")
    return asked.groupBy("bucket").applyInArrow(add, ANSWER)


def score(documents: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``) of every document.

    Trained on the rows where ``held_out`` is false. A null, empty or blank text is the end token alone. Repeated rows count
    and are scored each for itself. Without training rows every token is unknown. An empty table gives an empty table.
    """
    kind = documents.schema[key].dataType.simpleString()
    chunks = _by_chunk(_chunks(documents, key, text, held_out))
    tokens = chunks.agg(F.sum("tokens")).first()[0] or 0
    word_buckets, pair_buckets = max(1, tokens // PER_WORD_BUCKET), max(1, tokens // PER_PAIR_BUCKET)
    words = stored(_word_level(chunks, word_buckets), "words")
    total = _sums(words)
    unigrams = Unigrams(total[3 : DISCOUNTED + 5], int(total[0]), int(total[1]))
    pairs = stored(_pair_level(chunks, words, unigrams, word_buckets, pair_buckets), "pairs")
    d = discounts(_sums(pairs)[3 : DISCOUNTED + 5])

    def evaluate(left: pa.Table, right: pa.Table) -> pa.Table:
        answers, out = right.to_pylist(), []
        for row in left.to_pylist():
            sizes, held = (np.array([x[n] for x in row["docs"]], dtype=t) for n, t in (("n", np.int64), ("held", bool)))
            coded = _Coded(row["codes"], sizes, held, answers, word_buckets, pair_buckets)
            level = sorted((x for x in answers if x["level"] == 2), key=lambda x: x["bucket"])
            p, at = np.empty(len(coded.pairs)), 0
            for x in level:  # one bucket of contexts after the other
                here = slice(at, at := int(np.searchsorted(coded.bucket, x["bucket"], "right")))
                values = _unpack(x["b"], np.uint64)
                m = len(values) // (DISCOUNTED + 2)
                sums = np.column_stack((values[:m].view(np.float64), values[m:].reshape(DISCOUNTED + 1, m).T.astype(np.float64)))
                _, of = np.unique(coded.pairs[here] >> np.uint64(32), return_inverse=True)
                count = _unpack(x["a"], np.uint32).astype(np.int64)
                p[coded.order[here]] = pair_probability(count, sums[of], unigrams.p(coded.words[here]), d)
            base = np.log10((coded.count + 1) / (unigrams.tokens + unigrams.types + 1))
            out.append((np.add.reduceat(np.log10(p)[coded.pair], coded.starts), np.add.reduceat(base, coded.starts),
                        np.add.reduceat((coded.count > 0).astype(np.int64), coded.starts), sizes, held))
        merged = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0)] * 5
        keys = left.column("docs").combine_chunks().flatten().field("key")
        return pa.table({
            key: keys, "held_out": pa.array(merged[4], pa.bool_()), "n_tokens": pa.array(merged[3], pa.int64()),
            "n_known": pa.array(merged[2], pa.int64()), "train_tokens": pa.array(np.full(len(merged[0]), unigrams.tokens), pa.int64()),
            "base_score": pa.array(merged[1], pa.float64()), "score": pa.array(merged[0], pa.float64())})

    answers = words.unionByName(pairs).where("chunk >= 0")
    return chunks.select("chunk", "codes", "docs").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        evaluate, f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
