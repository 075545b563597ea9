"""Token counts of whole texts through a digest cache.

The cache is a Parquet table of (content digest, number of tokens), one part per tokenizer version. A run digests its texts, joins the
digests to the stored counts, encodes each distinct text that is missing once, and appends those counts. A second run over the same
or copied texts encodes nothing.

Texts are moved only where they are missing: equal ones are combined inside the map tasks first, so that a text of very many copies
costs one row per task, and the rest goes to its digest. Digests that many documents share are joined by broadcast; a bound on
their number follows from their share of all rows.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.storage import stored

CACHE = "digest binary, n_tokens long"
#: A digest with at least this share of the rows is joined by broadcast; so there are at most as many of them.
HOT = 1000
#: Missing digests up to this number are broadcast to the texts (32 bytes each); beyond, texts are combined by digest first.
BROADCAST_MISSES = 100_000
#: Characters handed to the tokenizer at once.
ENCODE = 1 << 18


class Tokenizer:
    """A tokenizer file as bytes, so that executors need no copy of it: tokenizers for ``.json``, sentencepiece for ``.model``."""

    def __init__(self, path: str):
        if not path.endswith((".json", ".model")):
            raise ValueError(f"{path}: a .json file of tokenizers or a .model file of sentencepiece is needed")
        self.kind, self.data = path.rsplit(".", 1)[1], Path(path).read_bytes()

    def version(self) -> str:
        """Digest of whatever decides about counts: library, its version, the file, and how it is called."""
        import sentencepiece
        import tokenizers

        library = f"tokenizers {tokenizers.__version__}" if self.kind == "json" else f"sentencepiece {sentencepiece.__version__}"
        return hashlib.sha256(f"{library}; whole texts, no added tokens; ".encode() + self.data).hexdigest()

    def counter(self):
        """A function from texts to their numbers of tokens, to be made once in a task."""
        if self.kind == "model":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=self.data)
            return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1, add_bos=False, add_eos=False)]
        import tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # no threads beside Spark's
        encoder = tokenizers.Tokenizer.from_buffer(self.data)
        encoder.no_padding()
        encoder.no_truncation()

        def whole(texts: list[str]) -> list[int]:
            # the fast call leaves out the places of tokens in the text, not tokens
            return [len(found) for found in encoder.encode_batch_fast(texts, add_special_tokens=False)]

        by_word = WordCounts.of(json.loads(self.data), encoder)
        if by_word is None:
            return whole
        return lambda texts: [by_word(text) if by_word.knows(text) else whole([text])[0] for text in texts]


# How a byte-level BPE cuts a text into words, which are encoded each for itself.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class WordCounts:
    """Counts of a byte-level BPE's words, each encoded by the library once in a task.

    Cutting into words depends on the classes of characters. Those below ``CHECKED`` are compared with the library's own
    cutting; a text with any other character, or with the string of an added token, is left to the library as a whole.
    """

    CHECKED, MOST = 0x3000, 500_000

    @classmethod
    def of(cls, described: dict, encoder) -> WordCounts | None:
        """None for a tokenizer that works in another way, or that is told to treat added tokens in a special way."""
        model, cutter, after = described["model"], described["pre_tokenizer"] or {}, described["post_processor"]
        byte_level = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space", True)
        plain = model.get("type") == "BPE" and not model.get("dropout") and not described["normalizer"] and not after
        flags = ("single_word", "lstrip", "rstrip", "normalized")
        if not (byte_level and plain) or any(t[f] for t in described["added_tokens"] for f in flags):
            return None
        return cls(encoder, [t["content"] for t in described["added_tokens"]])

    def __init__(self, encoder, added: list[str]):
        import regex

        self.encoder, self.words, self.counts = encoder, regex.compile(WORD_PATTERN), {}
        known = [c for c in map(chr, range(self.CHECKED)) if self._cut_alike(c)]
        other = [f"[^{''.join(map(regex.escape, known))}]", *map(regex.escape, added)]
        self.other = regex.compile("|".join(other))

    def _cut_alike(self, character: str) -> bool:
        text = f"a{character}1{character} {character}{character}!{character}\n{character}"
        found = [text[a:b] for _, (a, b) in self.encoder.pre_tokenizer.pre_tokenize_str(text)]
        return found == self.words.findall(text)

    def knows(self, text: str) -> bool:
        return not self.other.search(text)

    def __call__(self, text: str) -> int:
        counts, words = self.counts, self.words.findall(text)
        try:
            return sum(map(counts.__getitem__, words))
        except KeyError:
            if len(counts) > self.MOST:
                counts.clear()
            new = list(set(words).difference(counts))
            encoded = self.encoder.encode_batch_fast(new, add_special_tokens=False)
            counts.update(zip(new, map(len, encoded)))
            return sum(map(counts.__getitem__, words))


def content(text: Column) -> Column:
    """The normal form that is digested: null is the empty text. Nothing else is equated, as a byte-level tokenizer tells all else apart."""
    return F.coalesce(text, F.lit(""))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(content(text), 256))


def cached_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(``digest``, ``n_tokens``) stored for a tokenizer version; one row per digest, also if two writers appended it."""
    try:
        rows = spark.read.schema(CACHE).parquet(f"{cache}/tokenizer={version}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], CACHE)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def encode_misses(texts: DataFrame, missing: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(``digest``, ``n_tokens``) of the missing digests; each distinct text (``digest``, ``text``) is encoded once."""
    spark = texts.sparkSession
    shipped = spark.sparkContext.broadcast(tokenizer)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shipped.value.counter()
        for batch in batches:
            numbers, held, size = [], [], 0
            for value in batch.column(1):
                held.append(value.as_py())
                size += len(held[-1])
                if size >= ENCODE:
                    numbers += count(held)
                    held, size = [], 0
            numbers += count(held) if held else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(numbers, pa.int64())], names=["digest", "n_tokens"])

    few = missing.count() <= BROADCAST_MISSES
    if few:
        texts = texts.join(F.broadcast(missing), "digest", "left_semi")
    distinct = texts.groupBy("digest").agg(F.first("text").alias("text"))
    if not few:
        distinct = distinct.join(missing, "digest", "left_semi")
    return distinct.select("digest", "text").mapInArrow(encode, CACHE)


def count_tokens(
    documents: DataFrame, tokenizer_path: str, cache: str, text: str = "text", keep: Sequence[str] = ("doc_id",), limit: int = 1024,
) -> DataFrame:
    """The kept columns, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every row.

    Whole texts are counted, whatever their length; null counts as empty, which has no tokens. Null and repeated keys and repeated
    rows stay rows of their own, copies share one stored count. An empty table gives no rows and leaves the cache alone. Columns that
    are not kept may have any names; kept ones may not have those of the result. ``cache`` is a folder that all executors
    reach; several runs may append to it at a time, and a failed run's appends are not seen.
    """
    made = ["n_bytes", "n_tokens", "over_limit"]
    if clash := set(keep) & set(made):
        raise ValueError(f"kept columns have names of the result: {sorted(clash)}")
    spark, tokenizer = documents.sparkSession, Tokenizer(tokenizer_path)
    version = tokenizer.version()
    body = F.col(f"`{text}`")
    rows = stored(documents.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), digest(body).alias("digest"),
        F.octet_length(content(body)).cast("long").alias("n_bytes")), "digests")
    shares = stored(rows.groupBy("digest").agg(F.count("*").alias("share")), "shares")
    missing = stored(shares.select("digest").join(cached_counts(spark, cache, version), "digest", "left_anti"), "missing")
    if not missing.isEmpty():
        texts = documents.select(digest(body).alias("digest"), content(body).alias("text"))
        encode_misses(texts, missing, tokenizer).write.mode("append").parquet(f"{cache}/tokenizer={version}")
    counts = stored(shares.join(cached_counts(spark, cache, version), "digest"), "counts")
    total = counts.agg(F.sum("share")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("share") * HOT >= total).select("digest", "n_tokens"))
    rest = counts.where(F.col("share") * HOT < total).select("digest", "n_tokens")
    named = rows.join(hot, "digest").unionByName(rows.join(hot, "digest", "left_anti").join(rest, "digest"))
    return named.select(
        *[F.col("kept").getField(c).alias(c) for c in keep], "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
