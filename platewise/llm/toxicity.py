"""Toxicity scores from a weighted lexicon, learned from labels and matched by Aho-Corasick.

Texts are folded first (``fold``): lower case, homoglyphs of other scripts to Latin letters, digits and symbols that stand for
letters to these letters, everything between words to one space. Terms are whole words and beginnings of words. Their weights
are log odds of the documents that hold them, from at most ``MAX_LABELLED`` labelled rows; terms that are frequent enough in toxic
documents and rare in others form the lexicon, at most ``MAX_TERMS`` of them. Phrases of a term and a word beside it that occur
in clean documents rather than in toxic ones are exceptions: a term inside an exception phrase does not count.

All terms and phrases form one automaton; a text is read once, whole. A word counts with the greatest weight of the terms
that match it; a repeated word adds with the logarithm of its number. The sum of weights and its density per word (the normalisation by length) go into a logistic function, whose three
numbers are fitted on labelled rows that were not used for the lexicon. The sample is drawn for each label by itself, so its rows are
weighted by how many labelled rows each stands for: scores and the threshold mean the same whatever part of the labels was drawn.

Nulls: a null text is an empty one, it scores like any text without matches; rows without a label, id or label row are not learned
from, but scored. Repeated rows score alike. Without toxic or without clean rows to learn from, every score is the share of toxic
ones (one half of either without any). An empty table gives an empty result; input columns are kept and never overwritten.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import short_batches, stored

MAX_LABELLED, MAX_TERMS = 20_000, 3_000
LEAST_WEIGHT = 1.5
THRESHOLD = 0.7
# Letters of other scripts that look like Latin ones, and what digits and symbols stand for.
HOMOGLYPHS = dict(zip(
    "\u0430\u0435\u043e\u0440\u0441\u0443\u0445\u0456\u0458\u0455\u0501\u043a\u043c\u0442\u0432\u043d\u0461\u03b1\u03b5\u03b9\u03bf\u03c1\u03c4\u03bd\u03ba\u03c5\u03c7\u0131\u0261",
    "aeopcyxijsdkmtbhwaeioptvkuxig",
))
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SYMBOLS = {"@": "a", "$": "s", "!": "i", "|": "l", "+": "t"}
#: Phrases in which a term is no insult.
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "pond scum")

_FOLDED = {ord(a): b for a, b in (HOMOGLYPHS | DIGITS).items()}
_WORDS = re.compile(r"[^\W_]+")
_SYMBOLS = re.compile(r"[@$!|+]+(?=[^\W_])")
_HIDDEN = re.compile("[\u200b-\u200d\u2060\ufeff\u00ad\u0300-\u036f]")


def fold(text: str | None) -> str:
    """Folded words between single spaces, one at each end; a single space if there are none."""
    if not text:
        return " "
    low = _HIDDEN.sub("", text.lower()).translate(_FOLDED)
    if _SYMBOLS.search(low):
        low = _SYMBOLS.sub(lambda m: "".join(SYMBOLS[c] for c in m[0]), low)
    words = _WORDS.findall(low)
    return f" {' '.join(words)} " if words else " "


def terms_of(folded: str) -> set[str]:
    """What may become a term: whole words as ``' word '``, and beginnings of 4 to 8 letters as ``' begi'``."""
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in range(4, 9) if len(w) > n}


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of terms, exception phrases, and the logistic function of sum and density."""

    terms: dict
    exceptions: tuple[str, ...]
    coefficients: tuple[float, float, float]

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            found.add_word(term, (len(term), weight, None))
        for phrase in self.exceptions:
            key = f" {phrase} "
            _, weight, _ = found.get(key, (0, None, None))
            found.add_word(key, (len(key), weight, len(key)))
        found.make_automaton()
        return found

    def total(self, automaton, folded: str) -> float:
        """Sum over different words of the greatest weight that matches, more for repeated ones, exception phrases left out."""
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        if not len(automaton):
            return 0.0
        for end, (size, weight, phrase) in automaton.iter(folded):
            begin = end - size + 1
            if phrase:
                spared.append((begin, end))
            elif weight > best.get(begin, 0.0):
                best[begin] = weight
        for a, b in spared:
            for begin in [x for x in best if a <= x < b]:
                del best[begin]
        words: dict[str, tuple[int, float]] = {}
        for begin, weight in best.items():
            word = folded[begin + 1:folded.index(" ", begin + 1)]
            words[word] = (words.get(word, (0, 0.0))[0] + 1, weight)
        return sum(weight * (1 + math.log(n)) for n, weight in words.values())

    def features(self, automaton, text: str | None) -> tuple[float, float]:
        folded = fold(text)
        total = self.total(automaton, folded)
        return math.log1p(total), 100.0 * total / (folded.count(" ") - 1 + 50)

    def score(self, text: Column) -> Column:
        """Column of scores in 0 .. 1 of whole texts."""
        a, b, c = self.coefficients

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            automaton = self.automaton()
            for texts in batches:
                found = []
                for text in texts:
                    x, y = self.features(automaton, text)
                    found.append(1 / (1 + math.exp(-max(-500.0, min(500.0, a + b * x + c * y)))))
                yield pd.Series(found, dtype="float64")

        return scored(text)


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = MAX_LABELLED) -> DataFrame:
    """Rows (half, toxic, text, stands_for): labelled documents, at most half of the bound for each label, chosen by a hash of the id.

    ``stands_for`` is the number of usable labels of that kind in the whole table for each one that was drawn.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).alias("toxic")).filter(F.col("id").isNotNull() & F.col("toxic").isin(0, 1)).distinct()
    there = {int(r["toxic"]): r["count"] for r in known.groupBy("toxic").count().collect()}
    stands_for = {k: max(1.0, there.get(k, 0) / (rows // 2)) for k in (0, 1)}
    order = [F.xxhash64("id", F.lit(5)), "id"]
    chosen = known.filter("toxic = 1").orderBy(*order).limit(rows // 2).unionByName(known.filter("toxic = 0").orderBy(*order).limit(rows // 2))
    joined = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).join(F.broadcast(stored(chosen, "toxicity-labels")), F.col("doc") == F.col("id"))
    weight = F.when(F.col("toxic") == 1, stands_for[1]).otherwise(stands_for[0])
    return joined.select((F.pmod(F.xxhash64("id", F.lit(9)), F.lit(2)) == 0).alias("half"), "toxic", "text", weight.alias("stands_for"))


def _counted(rows: DataFrame, keys) -> DataFrame:
    """Rows (term, toxic, clean): documents of each label that hold a key; ``keys`` gives the keys of a folded text."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (Counter(), Counter())
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[toxic].update(keys(fold(text)))
            every = list(found[0] | found[1])
            yield pa.RecordBatch.from_arrays([
                pa.array(every, pa.string()), pa.array([found[1][t] for t in every], pa.int64()), pa.array([found[0][t] for t in every], pa.int64()),
            ], names=["term", "toxic", "clean"])

    counted = rows.select(F.col("toxic").cast("int"), "text").mapInArrow(count, "term string, toxic bigint, clean bigint")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def train(sample: DataFrame) -> ToxicityModel:
    """Learn lexicon, exceptions and logistic function from a stored sample (half, toxic, text, stands_for)."""
    short_batches(sample.sparkSession)
    counted = sample.groupBy("half", "toxic").agg(F.count(F.lit(1)).alias("n"), F.first("stands_for").alias("each")).collect()
    sizes = {(r["half"], r["toxic"]): r["n"] for r in counted}
    positive, negative = sizes.get((True, 1), 0), sizes.get((True, 0), 0)
    everything = sum(r["n"] * r["each"] for r in counted)
    share = sum(r["n"] * r["each"] for r in counted if r["toxic"]) / everything if counted else 0.5
    prior = ToxicityModel({}, (), (math.log((share + 1e-3) / (1 - share + 1e-3)), 0.0, 0.0))
    if not positive or not negative or not sizes.get((False, 1)) or not sizes.get((False, 0)):
        return prior
    first = sample.filter("half")
    odds = F.log((F.col("toxic") + 0.5) / (positive + 1)) - F.log((F.col("clean") + 2.0) / (negative + 1))
    rare = max(3, positive // 80)
    found = _counted(first, terms_of).withColumn("weight", odds).filter((F.col("toxic") >= rare) & (F.col("weight") >= LEAST_WEIGHT))
    terms = {r["term"]: r["weight"] for r in found.orderBy(F.col("weight").desc(), "term").limit(MAX_TERMS).collect()}
    words = {t.strip() for t in terms if t.endswith(" ")}

    def phrases(folded: str) -> set[str]:
        every = folded.split()
        return {f"{a} {b}" for a, b in zip(every, every[1:]) if a in words or b in words}

    spared = _counted(first, phrases).withColumn("weight", odds).filter((F.col("clean") >= 3) & (F.col("weight") < 0))
    learned = [r["term"] for r in spared.orderBy(F.col("clean").desc(), "term").limit(MAX_TERMS).collect()]
    model = ToxicityModel(terms, tuple(sorted({*learned, *EXCEPTIONS})), (0.0, 0.0, 0.0))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            values = np.array([model.features(automaton, t) for t in batch.column(1).to_pylist()]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values[:, 0]), pa.array(values[:, 1]), batch.column(2)], names=["toxic", "x", "y", "stands_for"])

    rows = sample.filter("not half").select(F.col("toxic").cast("int"), "text", "stands_for").mapInArrow(features, "toxic int, x double, y double, stands_for double")
    points = np.array([tuple(r) for r in rows.collect()], float)  # at most MAX_LABELLED rows of four numbers
    order = np.lexsort(points.T)
    return ToxicityModel(model.terms, model.exceptions, fit_logistic(points[order, 1:3], points[order, 0], points[order, 3]))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-2, steps: int = 50) -> tuple[float, float, float]:
    """Logistic regression of weighted rows with an intercept by Newton steps; columns are scaled to unit spread, the penalty leaves out the intercept."""
    spread = np.maximum(np.sqrt(np.average((x - np.average(x, 0, weight)) ** 2, 0, weight)), 1e-9)
    a = np.column_stack([np.ones(len(x)), x / spread])
    ridge = np.diag([0.0] + [penalty * 1.0] * x.shape[1])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a.T * (weight * (p * (1 - p) + 1e-9))) @ a + ridge, a.T @ (weight * (y - p)) - ridge @ w)
        w += step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), *(float(v) for v in w[1:] / spread)


def held_out(doc_id: Column) -> Column:
    """True for rows whose labels are not learned from: the crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train_on(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = MAX_LABELLED) -> ToxicityModel:
    """The model learned from the labelled rows of ``docs`` that are not held out, at most ``rows`` of them."""
    usable = labels.filter(~held_out(F.col(doc_id)))
    return train(stored(labelled_sample(docs, usable, doc_id, text, label, rows), "toxicity-sample"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold."""
    short_batches(docs.sparkSession)
    return docs.filter(model.score(F.col(text)) < threshold)
