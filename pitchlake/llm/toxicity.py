"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is not fixed: words and word beginnings are taken from labelled training rows, where their share of toxic texts
is higher than chance explains (a Chernoff bound against the number of terms, as a ratio: from 1 on a term is in the strong
lexicon, from a half on its weak evidence is added up). Features of a training row use the
lexicon of the other folds, so that the trees see it as they will see new texts. Trees are fitted on all folds but the
first, the calibration on the first. Scoring reads every whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.storage import stored

#: At most so many labelled rows are used to learn from, those with the smallest hashes of their id.
TRAIN_ROWS = 40_000
FOLDS = 4
#: Word beginnings of these lengths are candidates for the lexicon, beside whole words.
STEMS = range(3, 9)
#: Words between a second-person word and a lexicon word that still count as near.
NEAR = 5
#: Least evidence of a term, as a share of what the strong lexicon asks for.
WEAK = 0.5
FEATURES = (
    "word_density", "word_count", "stem_density", "stem_count", "evidence", "evidence_density", "second_person_near", "second_person_rate",
    "capitals", "shouted_words", "exclamations", "punctuation", "obfuscated", "hidden_words", "length",
)
#: Second-person words of the languages served.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer tú ti usted ustedes vosotros".split())
_LEET = str.maketrans("013457@$!", "oieastasi")
_WORD = re.compile(r"\w+")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_MARKED = re.compile(r"\w*[\d@$!*#%&_]+\w[\w@$!*#%&]*|\w+[*#$%&@]{2,}")


@dataclass(frozen=True)
class Lexicon:
    """Evidence by term."""

    words: dict
    stems: dict

    @property
    def heads(self) -> frozenset:
        return frozenset(s[: STEMS[0]] for s in self.stems)

    def stems_of(self, word: str) -> dict:
        return {word[:n]: self.stems[word[:n]] for n in STEMS if len(word) >= n and word[:n] in self.stems}

    def strong(self, word: str) -> bool:
        return max([self.words.get(word, 0), *self.stems_of(word).values()]) >= 1


def features(text: str | None, lexicon: Lexicon, heads: frozenset) -> list[float]:
    """The dense features of one whole text; those of a null or empty text are zeros."""
    text = text or ""
    words = _WORD.findall(text.lower())
    n = max(1, len(words))
    known = lexicon.words
    hits, stems, evidence, weak = [], [], {}, 0
    for i, w in enumerate(words):
        if w in known or w[:3] in heads:
            found = lexicon.stems_of(w)
            if found:
                evidence.update(found)
                if max(found.values()) >= 1:
                    stems.append(i)
            if w in known:
                evidence["w" + w] = known[w]
                if known[w] >= 1:
                    hits.append(i)
            weak += bool(found) or w in known
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near, toxic = 0, sorted({*hits, *stems})
    if toxic and you:
        at = np.searchsorted(you, toxic)
        spots = np.array([-10**9, *you, 10**9])
        near = int((np.minimum(np.abs(spots[at] - toxic), np.abs(spots[at + 1] - toxic)) <= NEAR).sum())
    marked = _MARKED.findall(text) if any(c in text for c in "0123456789@$!*#%&_") else []
    hidden = sum(lexicon.strong(re.sub(r"\W|_", "", m.lower().translate(_LEET))) for m in marked)
    chars = max(1, len(text))
    capitals = len(_CAPITAL.findall(text)) / chars
    shouted = sum(len(w) > 2 and w.isupper() for w in text.split()) if capitals > 0.1 else 0
    total = sum(math.sqrt(v) for v in evidence.values())
    return [
        len(hits) / n, math.log1p(len(hits)), len(stems) / n, math.log1p(len(stems)), total / math.log(20 + n), weak / n,
        near / n, len(you) / n, capitals, shouted / n, (text.count("!") + text.count("?")) / chars,
        (text.count(".") + text.count(",") + text.count(";")) / chars, len(marked) / n, hidden / n, math.log1p(len(words)),
    ]


def _terms(text: str | None) -> set[str]:
    words = set(_WORD.findall((text or "").lower()))
    return {f"w{w}" for w in words} | {f"s{w[:n]}" for w in words for n in STEMS if len(w) >= n}


def _training_rows(documents: DataFrame, labels: DataFrame, learn: Column, rows: int) -> DataFrame:
    """Labelled rows to learn from (``key``, ``text``, ``label``, ``fold``), one of each text."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    known = known.where(learn).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # the broadcast is bounded by it
    picked = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    one = picked.groupBy(F.xxhash64("text").alias("key")).agg(
        F.first("text").alias("text"), F.max("label").cast("double").alias("label"))
    return one.withColumn("fold", F.pmod("key", F.lit(FOLDS)).cast("int"))


def _lexicons(rows: DataFrame) -> list[Lexicon]:
    """The lexicon without each fold, then the one of all folds."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[int, int], Counter] = {}
        for batch in batches:
            for text, label, fold in zip(batch["text"], batch["label"], batch["fold"]):
                seen.setdefault((fold, int(label)), Counter()).update(_terms(text))
        for (fold, label), counts in seen.items():
            yield pd.DataFrame({"term": list(counts), "fold": fold, "label": label, "n": list(counts.values())})

    n = F.sum("n")
    counted = rows.mapInPandas(count, "term string, fold int, label int, n long").groupBy("term").agg(
        *[F.coalesce(F.sum(F.when((F.col("fold") == f) & (F.col("label") == y), F.col("n"))), F.lit(0)).alias(f"n{f}{y}")
          for f in range(FOLDS) for y in (0, 1)], n.alias("n"))
    pos = sum(F.col(f"n{f}1") for f in range(FOLDS))
    sizes = {(r["fold"], int(r["label"])): r["count"] for r in rows.groupBy("fold", "label").count().collect()}
    # a lexicon's terms are frequent in toxic texts; training rows, and so these, are bounded
    likely = counted.where((pos >= 3) & (pos * 5 >= F.col("n") * 2)).toPandas()
    terms = max(2, counted.where("n >= 3").count())
    out = []
    for without in [*range(FOLDS), None]:
        folds = [f for f in range(FOLDS) if f != without]
        yes, no = (sum(likely[f"n{f}{y}"] for f in folds).to_numpy(float) if len(likely) else np.zeros(0) for y in (1, 0))
        toxic, clean = (sum(sizes.get((f, y), 0) for f in folds) for y in (1, 0))
        base = min(0.99, max(1e-3, toxic / max(1, toxic + clean)))
        total = np.maximum(yes + no, 1)
        p = np.clip(yes / total, 1e-9, 1 - 1e-9)
        gain = total * (p * np.log(p / base) + (1 - p) * np.log((1 - p) / (1 - base)))
        ratio = np.where(p > base + 0.35 * (1 - base), gain / math.log(terms), 0.0)
        chosen = [(t, float(x)) for t, x in zip(likely["term"], ratio) if x >= WEAK]
        out.append(Lexicon({t[1:]: x for t, x in chosen if t[0] == "w"}, {t[1:]: x for t, x in chosen if t[0] == "s"}))
    return out


def _featured(rows: DataFrame, lexicons: list[Lexicon], kept: list[str], fold: bool) -> DataFrame:
    """``kept`` columns and ``features``, by the lexicon of all rows, or by the one without the row's fold."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heads = [lexicon.heads for lexicon in lexicons]
        for batch in batches:
            which = batch["fold"] if fold else [FOLDS] * len(batch)
            out = batch[kept].copy()
            out["values"] = [features(t, lexicons[f], heads[f]) for t, f in zip(batch["text"], which)]
            yield out

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema.fields)
    made = rows.mapInPandas(make, f"{fields}, values array<double>")
    return made.withColumn("features", array_to_vector("values")).drop("values")


def score(documents: DataFrame, labels: DataFrame, learn: Column, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """All columns and the ``score`` of every document; ``learn`` says of a ``doc_id`` whether its label may be used.

    Null and empty texts get the score of a text without words. Repeated rows get repeated scores. Without labels, or with
    labels of one kind only, every score is the share of toxic labels (0 without any). Other columns play no part; one
    called ``score`` is replaced.
    """
    documents = documents.drop("score")
    rows = stored(_training_rows(documents, labels, learn, train_rows), "training")
    kinds = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(kinds) < 2 or min(kinds.values()) < 2 * FOLDS:
        share = kinds.get(1.0, 0) / max(1, sum(kinds.values()))
        return documents.withColumn("score", F.lit(float(share)))
    lexicons = _lexicons(rows)
    training = stored(_featured(rows, lexicons, ["label", "fold"], True), "features")
    trees = GBTClassifier(maxIter=24, maxDepth=3, stepSize=0.3, subsamplingRate=0.8, seed=5).fit(training.where("fold <> 0"))

    def raw(df: DataFrame) -> DataFrame:
        return trees.transform(df).withColumn("raw", vector_to_array("probability")[1])

    held = raw(training.where("fold = 0"))
    if held.agg(F.countDistinct("label")).first()[0] < 2:
        held = raw(training)
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(held)
    names = [f"_{i}" for i in range(len(documents.columns))]  # no clash with the models' columns
    text = names[documents.columns.index("text")]
    plain = documents.toDF(*names).withColumn("text", F.col(text)).drop(text)
    made = _featured(plain, lexicons, plain.columns, False)
    scored = calibration.transform(raw(made))
    # the isotonic steps tie many scores; the trees' own order within a step is kept
    ordered = F.col("calibrated") * 0.98 + F.col("raw") * 0.02
    back = [F.col("text" if n == text else n).alias(c) for n, c in zip(names, documents.columns)]
    return scored.select(*back, ordered.alias("score"))
