"""Exact Jaccard self-join of documents on word n-grams, by prefixes with token combinations.

A token is the hash of an n-gram. All tokens have one global order: first those whose hash falls into the low part, by
frequency class (unique, rare by document frequency, frequent), then the others by hash. So frequencies need counting
for the low part only. Small documents have an order and index of their own, in which every token counts as low;
those near the border are in both. A document with n tokens can miss at most ``t`` of them in a partner that it links with
(t = n minus the least overlap). Its prefix is extended along the order until what it yields exceeds t: a rare token, and a
token outside the low part, yields 1 and is indexed by itself; c frequent ones yield c - 1 and are indexed by all their pairs,
because a partner that misses fewer than that shares a pair. Two documents that link then share an index entry. Documents
whose prefix consists of unique tokens have no partner. Very small and very large documents index frequent tokens singly;
near the borders both ways are used, so that partners on either side meet.

Documents of one index entry are first compared with one of them only, in two rounds, at first with the one that has the
fewest tokens of its own (of copies with changes, that is the original); links put them into components.
Then every pair of one entry that still lies in different components is compared, and in one entry only, if the first tokens or
the first single entries of both tell which of the many that similar sets share comes first. A pair is dropped before that only if its
sizes, its unique tokens (which it can't share), or the parities of its tokens in 256 classes prove that it can't link: sets
differ in at least as many tokens as their parities differ in classes. All comparisons are exact, on whole sets. No link between components is lost, and a
large group of copies costs a number of comparisons in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.components import components
from pitchlake.llm.storage import gathered, stored
from pitchlake.llm.words import ROWS, mix, shingles, word_hashes

#: A token is frequent from this document frequency on.
FREQUENT = 64
#: Tokens below this hash are ordered by frequency; of documents with at most so many tokens, all are.
LOW = np.uint64(int(0.4 * 2**64))
SMALL = 160
#: Documents of so many tokens index pairs of frequent tokens; smaller and larger ones index them singly.
PAIRS_FROM, PAIRS_TO = 8, 400
#: Tokens that a task gathers before it sends them, and aims at for one group that counts them.
GATHER, PER_BUCKET = 1 << 18, 1 << 19
#: Tokens in pairs, and entries that are single tokens, of a set, that tell in which of their shared entries two sets are compared.
HEAD, SINGLES = 12, 24
#: Up to so many ids (8 bytes each) of documents to compare are broadcast to the scan of the texts; beyond, Spark shuffles.
BROADCAST_IDS = 1_000_000


def most_missing(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100


def _sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    for first in range(0, len(texts), ROWS):
        made, number = shingles(*word_hashes(texts.slice(first, ROWS)), k)
        at = 0
        for n in number:
            yield np.unique(made[at : at + n])
            at += n


def _fingerprint(tokens: np.ndarray) -> int:
    return int((mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)).astype(np.int64))


#: Tells the tokens and owners of the small documents' index from the others.
_SMALL_INDEX = 0x3C6EF372FE94F82B
PARITIES = ["p0", "p1", "p2", "p3"]


def _parities(tokens: np.ndarray) -> np.ndarray:
    """Four numbers: for each of 256 classes, whether an odd number of tokens is in it."""
    odd = np.bincount((tokens & np.uint64(255)).astype(np.int64), minlength=256).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def token_sets(documents: DataFrame, key: str, text: str, k: int, percent: int) -> DataFrame:
    """One row per document: ``key``, ``n`` tokens, fingerprint ``fp`` of the set, its parities, and its tokens in the
    index of small documents (``small``) and in the other: ``low`` ones, and the ``high`` ones it may need."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, fp, parities, small, low, high = [], [], [], [], [], []
            for tokens in _sets(batch.column(1), k):
                lows = int(np.searchsorted(tokens, LOW)) if len(tokens) * 100 > SMALL * percent else 0
                more = max(0, most_missing(len(tokens), percent) + 1 - max(0, lows - 1)) if lows else 0
                n.append(len(tokens))
                fp.append(_fingerprint(tokens))
                parities.append(_parities(tokens))
                small.append(mix(tokens ^ np.uint64(_SMALL_INDEX)).tobytes() if len(tokens) <= SMALL else b"")
                low.append(tokens[:lows].tobytes())
                high.append(tokens[lows : lows + more].tobytes())
            parities = np.array(parities, dtype=np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(fp, pa.int64()), *(pa.array(p) for p in parities.T.copy()),
                 *(pa.array(x, pa.binary()) for x in (small, low, high))], names=["key", "n", "fp", *PARITIES, "small", "low", "high"])

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        scan, f"key {kind}, n long, fp long, p0 long, p1 long, p2 long, p3 long, small binary, low binary, high binary")


def repeated_tokens(sets: DataFrame, buckets: int) -> DataFrame:
    """(``owner``, ``token``, ``df``) of the tokens that several different sets hold; ``df`` stops at ``FREQUENT``.

    The owner is the set's fingerprint, in the index of small documents another number made from it. Tokens that ``FREQUENT``
    sets of one task share are known to be frequent there: they need no counting, only their mark is counted elsewhere, and they
    are dealt out by owner. So a token of most documents is never gathered in one place.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
            by = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[by], np.arange(buckets + 1))
            for b in range(buckets):
                if ends[b] < ends[b + 1]:
                    yield (b, *(c[by[ends[b] : ends[b + 1]]].tobytes() for c in columns))

        def packed(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            tokens = np.concatenate([t for t, _ in parts])
            owners = np.concatenate([o for _, o in parts])
            order = np.lexsort((owners, tokens))
            tokens, owners = tokens[order], owners[order]
            new = np.ones(len(tokens), dtype=bool)
            new[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
            tokens, owners = tokens[new], owners[new]
            first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
            size = np.diff(np.append(first, len(tokens)))
            hot = np.repeat(size >= FREQUENT, size)
            sent = ~hot
            sent[first] = True  # of a hot token one owner goes as its mark
            weight = np.where(hot, FREQUENT, 1)[sent].astype(np.uint8)
            by_owner = np.argsort(owners[sent], kind="stable")  # repeated owners compress well
            t, o, weight = tokens[sent][by_owner], owners[sent][by_owner], weight[by_owner]
            known_t, known_o = tokens[hot], owners[hot]
            out = [*rows((mix(t) % np.uint64(buckets)).astype(np.int64), t, o, weight),
                   *rows((mix(known_o.view(np.uint64)) % np.uint64(buckets)).astype(np.int64), known_t, known_o,
                         np.zeros(len(known_t), dtype=np.uint8))]
            columns = list(zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                names=["bucket", "tokens", "owners", "weights"])

        parts, held = [], 0
        for batch in batches:
            for fp, small, low in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                for owner, data in ((fp ^ _SMALL_INDEX, small), (fp, low)):
                    tokens = np.frombuffer(data.as_py(), np.uint64)
                    if len(tokens):
                        parts.append((tokens, np.full(len(tokens), owner, dtype=np.int64)))
                        held += len(tokens)
                if held >= GATHER:
                    yield packed(parts)
                    parts, held = [], 0
        if held:
            yield packed(parts)

    def count(group: pa.Table) -> pa.Table:
        tokens = np.frombuffer(b"".join(group.column("tokens").to_pylist()), np.uint64)
        owners = np.frombuffer(b"".join(group.column("owners").to_pylist()), np.int64)
        weights = np.frombuffer(b"".join(group.column("weights").to_pylist()), np.uint8)
        known = weights == 0
        known_tokens, known_owners = tokens[known], owners[known]
        tokens, owners, weights = tokens[~known], owners[~known], weights[~known].astype(np.int64)
        if len(tokens):
            order = np.lexsort((owners, tokens))
            tokens, owners, weights = tokens[order], owners[order], weights[order]
            new = np.ones(len(tokens), dtype=bool)
            new[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
            first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
            marked = np.maximum.reduceat(weights, first) > 1
            df = np.where(marked, FREQUENT, np.minimum(np.add.reduceat(new.astype(np.int64), first), FREQUENT))
            df = np.repeat(df, np.diff(np.append(first, len(tokens))))
            kept = new & (df > 1)
            tokens, owners, df = tokens[kept], owners[kept], df[kept]
        else:
            df = np.zeros(0, dtype=np.int64)
        return pa.table({
            "owner": np.concatenate((owners, known_owners)), "token": np.concatenate((tokens, known_tokens)).view(np.int64),
            "df": np.concatenate((df, np.full(len(known_tokens), FREQUENT))).astype(np.int32)})

    sent = sets.where("n > 0").select("fp", "small", "low").mapInArrow(gather, "bucket long, tokens binary, owners binary, weights binary")
    return sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(count, "owner long, token long, df int")


def index_entries(
    n: int, n_low: int, high: np.ndarray, tokens: np.ndarray, df: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a document's index entries; the lesser and the greater token of those that are pairs, 0 for others.

    ``tokens``, ``df``: its low tokens that other documents hold as well.
    """
    need, none = most_missing(n, percent) + 1 - (n_low - len(tokens)), np.zeros(0, dtype=np.uint64)
    if need <= 0:
        return none, none, none
    order = np.lexsort((tokens, df))
    tokens, df = tokens[order], df[order]
    rare = int(np.searchsorted(df, FREQUENT))
    singles = [tokens[: min(rare, need)]]
    need -= len(singles[0])
    frequent, pairs, a, b = tokens[rare:], none, none, none
    if need > 0:
        if PAIRS_FROM <= n <= PAIRS_TO:
            chosen = frequent[: need + 1]
            both = list(combinations(np.sort(chosen.view(np.int64)).view(np.uint64).tolist(), 2))
            if both:
                a, b = np.array(both, dtype=np.uint64).T
                pairs = mix(a * np.uint64(0xC2B2AE3D27D4EB4F) + b)
            singles.append(high[: max(0, need - max(0, len(chosen) - 1))])
        if n < -(-100 * PAIRS_FROM // percent) or n * 100 > PAIRS_TO * percent:
            chosen = frequent[:need]
            singles += [chosen, high[: max(0, need - len(chosen))]]
    single = mix(np.concatenate(singles) ^ np.uint64(1))
    entry, first = np.unique(np.concatenate([single, pairs]), return_index=True)
    return entry, *(np.concatenate([np.zeros(len(single), dtype=np.uint64), x])[first] for x in (a, b))


def entries(sets: DataFrame, repeated: DataFrame, percent: int) -> DataFrame:
    """(``entry``, ``t``, ``u``, ``fp``, ``n``, ``common``, parities) of every different set that may have a partner; at most
    ``common`` of its tokens are in any other set. ``t`` and ``u`` are the tokens of an entry that is a pair, else 0."""
    fixed = ["fp", "n", "common", *PARITIES]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for n, n_low, high, seen in zip(*(batch.column(c).to_pylist() for c in ("n", "n_low", "high", "seen"))):
                tokens = np.array([x["token"] for x in seen or ()], dtype=np.int64).view(np.uint64)
                df = np.array([x["df"] for x in seen or ()], dtype=np.int32)
                found.append([x.view(np.int64) for x in index_entries(n, n_low, np.frombuffer(high, np.uint64), tokens, df, percent)])
            if found:
                rows = batch.select(fixed).take(pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found])))
                made = [pa.array(np.concatenate(x)) for x in zip(*found)]
                yield pa.RecordBatch.from_arrays([*made, *rows.columns], names=["entry", "t", "u", *fixed])

    first = [F.first(c).alias(c) for c in PARITIES]
    nodes = sets.where("n > 0").groupBy("fp", "n").agg(
        *first, F.min(F.octet_length("small") / 8).cast("long").alias("n_small"),
        F.min(F.octet_length("low") / 8).cast("long").alias("n_low"), F.first("high").alias("high"))
    nodes = nodes.select("fp", "n", *PARITIES, F.inline(F.array(
        F.struct(F.col("fp").bitwiseXOR(F.lit(_SMALL_INDEX)).alias("owner"), F.col("n_small").alias("n_low"), F.lit(b"").alias("high")),
        F.struct(F.col("fp").alias("owner"), "n_low", "high")))).where("n_low > 0")
    seen = repeated.groupBy("owner").agg(F.collect_set(F.struct("token", "df")).alias("seen"))
    need = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1
    unique = F.col("n_low") - F.coalesce(F.size("seen"), F.lit(0))
    kinds = "".join(f", {p} long" for p in PARITIES)
    nodes = nodes.join(seen, "owner", "left").where(unique < need).withColumn("common", F.col("n") - unique)
    return nodes.select(*fixed, "n_low", "high", "seen").mapInArrow(build, f"entry long, t long, u long, fp long, n long, common long{kinds}")


def _may_link(a: str, b: str, percent: int) -> Column:
    """Neither sizes, common tokens nor parities of two sets (columns with a prefix) rule out a link."""
    x, y = F.col(f"{a}n"), F.col(f"{b}n")
    shared = F.least(f"{a}common", f"{b}common")
    differing = sum(F.bit_count(F.col(f"{a}{p}").bitwiseXOR(F.col(f"{b}{p}"))) for p in PARITIES)
    sizes = F.least(x, y) * 100 >= F.greatest(x, y) * percent
    return sizes & (shared * (100 + percent) >= (x + y) * percent) & ((x + y - differing) * (100 + percent) >= (x + y) * (2 * percent))


def with_heads(member: DataFrame) -> DataFrame:
    """``member`` with ``head``: the first ``HEAD`` tokens of the set's entries that are pairs, ascending, and ``singles``: its
    first ``SINGLES`` other entries, ascending. Both are empty if there are none."""
    # a set of PAIRS_TO tokens has some sixty in its pairs at most
    pair = F.col("u") != 0
    heads = member.groupBy("fp").agg(
        F.collect_set(F.when(pair, F.col("t"))).alias("ts"), F.collect_set(F.when(pair, F.col("u"))).alias("us"),
        F.collect_set(F.when(~pair, F.col("entry"))).alias("es"))
    heads = heads.select(
        "fp", F.slice(F.sort_array(F.array_union("ts", "us")), 1, HEAD).alias("head"), F.slice(F.sort_array("es"), 1, SINGLES).alias("singles"))
    return member.join(heads, "fp")


def _meet_here(a: str, b: str) -> Column:
    """Whether two sets (columns with a prefix) are to be compared in this entry, out of all that they share.

    If their heads share two tokens, both sets have the pair of the first two as an entry, and meet in that one only. Else they
    meet in the first of the single entries that both have among their first, or in each if there is none.
    """
    common, singles = F.array_intersect(f"{a}head", f"{b}head"), F.array_intersect(f"{a}singles", f"{b}singles")
    pair = (F.col(f"{a}t") == F.get(common, F.lit(0))) & (F.col(f"{a}u") == F.get(common, F.lit(1)))
    first = F.coalesce(F.col("entry") == F.get(singles, F.lit(0)), F.lit(True))
    return F.when(F.size(common) < 2, first).otherwise(pair)


def _linked(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose whole sets are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                kept.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    left = tokens.select(F.col("fp").alias("a"), F.col("tokens").alias("x"))
    right = tokens.select(F.col("fp").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def _whole_sets(documents: DataFrame, key: str, text: str, k: int, chosen: DataFrame) -> DataFrame:
    """(``fp``, ``tokens``) of the sets in ``chosen`` (``fp``, ``key``: one document that has it)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch.column(0), k))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_fingerprint(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["fp", "tokens"])

    ids = stored(chosen.select("key").distinct(), "ids")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).join(ids, "key", "left_semi")
    made = texts.select("text").mapInArrow(scan, "fp long, tokens binary")
    # a repeated id may bring in other texts as well
    return made.join(chosen.select("fp"), "fp", "left_semi").groupBy("fp").agg(F.first("tokens").alias("tokens"))


def similar_groups(documents: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(``key``, ``n_shingles``, ``component_id``): the smallest key of all documents reachable by links.

    Two documents link when 100 * shared >= percent * united n-grams. Documents of fewer than k words have their whole
    sequence as one n-gram; a null, empty or blank text has none and links with nothing, not even with its like. A null key
    is no candidate for ``component_id``, unless the component has no other. Repeated rows give repeated rows.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and at most 100")
    sets = stored(token_sets(documents, key, text, k, percent), "sets")
    total = sets.agg(F.sum((F.octet_length("small") + F.octet_length("low")) / 8)).first()[0] or 0
    repeated = repeated_tokens(sets, max(1, int(total / PER_BUCKET)))
    found = stored(entries(sets, repeated, percent), "entries")
    shared = found.groupBy("entry").agg(F.min("fp").alias("c"), F.max("fp").alias("d")).where("c <> d").select("entry")
    index = stored(found.join(shared, "entry").select("entry", "t", "u", "fp", "n", "common", *PARITIES), "index")
    owner = sets.groupBy("fp", "n").agg(F.min("key").alias("key"))
    tokens = stored(_whole_sets(documents, key, text, k, owner.join(index.select("fp", "n").distinct(), ["fp", "n"])), "tokens")

    spark = documents.sparkSession
    tested = spark.createDataFrame([], "a long, b long")
    roots = spark.createDataFrame([], "node long, root long")
    fixed = ["fp", "n", "common", *PARITIES]
    for turn in range(3):
        member = index.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("root", "fp"))
        if turn < 2:
            order = F.struct(F.col("n") - F.col("common") if turn == 0 else F.lit(0), F.xxhash64(F.lit(turn), "fp"))
            hub = member.groupBy("entry").agg(
                F.min(F.struct(order.alias("o"), *fixed, "comp")).alias("hub"), F.min("comp").alias("c"), F.max("comp").alias("d")
            ).where("c <> d").select("entry", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in (*fixed, "comp")])
            pairs = member.join(hub, "entry").where((F.col("comp") != F.col("hub_comp")) & _may_link("", "hub_", percent))
            pairs = pairs.select(F.least("fp", "hub_fp").alias("a"), F.greatest("fp", "hub_fp").alias("b"))
        else:
            open_ = member.groupBy("entry").agg(F.min("comp").alias("c"), F.max("comp").alias("d")).where("c <> d").select("entry")
            columns = ["t", "u", *fixed, "comp", "head", "singles"]
            member = stored(with_heads(member.join(open_, "entry").select("entry", *columns[:-2])).select("entry", *columns), "open")
            left, right = (member.select("entry", *[F.col(c).alias(f"{side}{c}") for c in columns]) for side in ("x_", "y_"))
            pairs = left.join(right, "entry").where(
                (F.col("x_fp") < F.col("y_fp")) & (F.col("x_comp") != F.col("y_comp")) & _may_link("x_", "y_", percent) & _meet_here("x_", "y_"))
            pairs = pairs.select(F.col("x_fp").alias("a"), F.col("y_fp").alias("b"))
        pairs = stored(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        links = stored(_linked(pairs, tokens, percent), "links")
        tested = tested.unionByName(pairs)
        if not links.isEmpty():  # what is connected so far is a forest of stars already
            roots = components(links.unionByName(roots.toDF("a", "b")))
    owner = owner.where("n > 0").join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("root", "fp"))
    smallest = owner.groupBy("comp").agg(F.min("key").alias("component_id"))
    named = owner.join(smallest, "comp").select("fp", "n", "component_id")
    out = sets.select("key", "n", "fp").join(named, ["fp", "n"], "left")
    return out.select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"))


def keep_one_of_each(documents: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The documents whose key is the smallest of their component; of a repeated key one row stays.

    Documents without a key stay. The documents themselves are moved only if keys repeat, or if very many are dropped.
    """
    groups = similar_groups(documents, key, text, k, percent).where(F.col(key).isNotNull())
    keys = stored(groups.groupBy(key).agg(
        F.max(F.col(key) == F.col("component_id")).alias("first"), F.count("*").alias("rows")), "groups")
    kept = documents.join(gathered(keys.where("NOT first").select(key), "dropped"), key, "left_anti").select(*documents.columns)
    if keys.where("rows > 1").isEmpty():
        return kept
    known = F.col(key).isNotNull()
    return kept.where(known).dropDuplicates([key]).unionByName(kept.where(~known))
