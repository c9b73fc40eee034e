"""Quality rules whose thresholds adapt to each language and source.

Two steps, both DataFrame functions only. ``measure`` counts what the rules look at, one pass over each whole text
and no shuffle. ``judge`` drops what fails the base rules, summarises every metric of the rest in quantile sketches,
one per (language, source), and joins the fences read off the sketches back to the documents.

The sketch is a histogram over buckets whose limits grow by ``GAMMA``: a quantile is off by at most half a bucket, 1 % of
its value. Sketches are rows (group, metric, bucket, count), so merging is adding up counts: exact, in any order, and done
before the shuffle by partial aggregation. A group of less than ``min_group`` documents uses the merged sketch of its
language, or of the whole table if its language is small too.

A metric is out of bounds above ``upper quartile + reach * spread`` (and for two-sided metrics below ``lower quartile -
reach * spread``), where the spread is the distance of the quartiles, at least the metric's ``least`` spread: the share of
junk may differ between groups, and nothing is rejected for being in a tail as such.

Nulls: a null text has no words and fails the base rules; null languages and sources are groups of their own. Repeated
rows are judged alike. An empty table stays empty. Columns of the input that carry the names used here are left alone:
results go to one struct column with a free name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.llm.common import WORD, free_name, let, stored
from platewise.session import has_at_most

GAMMA = 1.02
WINDOW_WORDS = 5


@dataclass(frozen=True)
class Metric:
    """A ratio of two counted fields, the least spread of its fences, and whether low values are out of bounds too."""

    name: str
    numerator: str
    denominator: str
    least: float
    two_sided: bool = False

    def value(self, counts: Column) -> Column:
        low = counts[self.denominator]
        return F.when(low > 0, counts[self.numerator].cast("double") / low).otherwise(F.lit(0.0))


METRICS = (
    Metric("symbol_share", "n_symbols", "word_chars", 0.02),
    Metric("duplicate_line_share", "n_dup_lines", "n_lines", 0.1),
    Metric("repeated_word_share", "n_repeat_words", "n_words", 0.07),
    Metric("mean_word_length", "word_chars", "n_words", 0.8, two_sided=True),
    Metric("shout_share", "n_shouts", "n_words", 0.05),
)


def _window_hashes(words: Column) -> Column:
    starts = F.slice(words, F.lit(1), F.size(words) - (WINDOW_WORDS - 1))
    return F.transform(starts, lambda w, i: F.xxhash64(w, *(words[i + k] for k in range(1, WINDOW_WORDS))))


def _covered(hashes: Column) -> Column:
    """Words lying in a window whose hash occurs twice: start positions of such windows, overlaps counted once."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated_starts(pairs: Column) -> Column:
        def start(pair: Column, k: Column) -> Column:
            same = F.coalesce(F.get(pairs, k - 1)["h"] == pair["h"], F.lit(False))
            return F.when(same | F.coalesce(F.get(pairs, k + 1)["h"] == pair["h"], F.lit(False)), pair["i"])

        return F.sort_array(F.filter(F.transform(pairs, start), lambda i: i.isNotNull()))

    def total(starts: Column) -> Column:
        widths = F.transform(starts, lambda s, k: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW_WORDS))))
        return F.aggregate(widths, F.lit(0).cast("long"), lambda a, w: a + w)

    return let(let(ordered, repeated_starts), total)


def repeat_words(words: Column) -> Column:
    """Words inside five-word windows that occur at least twice in an array of words, each word counted once."""
    def counted(w: Column) -> Column:
        long_enough = F.size(w) > WINDOW_WORDS
        return F.when(long_enough, let(_window_hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h))))

    return F.coalesce(let(words, counted), F.lit(0)).cast("long")


def duplicate_lines(text: Column) -> tuple[Column, Column]:
    """Lines that hold a word, and how many of them equal an earlier one, as columns of counts."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    both = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("all"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("again")))
    return both["all"], both["again"]


def counts(text: Column) -> Column:
    """Struct of everything that the rules count in one text."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: F.length(w) > 0)
    lines, again = duplicate_lines(text)

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: (F.length(x) > 1) & (F.right(x, F.lit(1)) == "!"))).cast("long").alias("n_shouts"),
        )

    return let(words, lambda w: let(of_words(w), lambda c: F.struct(
        c["n_words"].alias("n_words"), c["word_chars"].alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("n_lines"), again.alias("n_dup_lines"),
        c["n_repeat_words"].alias("n_repeat_words"), c["n_shouts"].alias("n_shouts"),
        ((c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])).alias("base_failed"),
    )))


def measure(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one more column, a struct of counts, and that column's name."""
    name = free_name(docs.columns, "quality")
    return docs.withColumn(name, counts(F.col(text))), name


def _bucket(value: Column) -> Column:
    """Bucket of a value in the sketch; zero has one of its own."""
    return F.when(value > 0, F.ceil(F.log(value) / F.lit(math.log(GAMMA)))).cast("long")


def _middle(bucket: Column) -> Column:
    return F.coalesce(2 * F.pow(F.lit(GAMMA), bucket) / (GAMMA + 1), F.lit(0.0))


def sketches(measured: DataFrame, column: str, by: tuple[str, ...], metrics: tuple[Metric, ...] = METRICS) -> DataFrame:
    """Sketch rows (g, metric, bucket, n) of what passes the base rules, ``g`` a struct of the group columns."""
    values = F.array(*(F.struct(F.lit(k).alias("metric"), _bucket(m.value(F.col(column))).alias("bucket")) for k, m in enumerate(metrics)))
    rows = measured.filter(~F.col(f"`{column}`.base_failed")).select(
        F.struct(*(F.col(c).alias(f"g{i}") for i, c in enumerate(by))).alias("g"), F.explode(values).alias("v"))
    return rows.groupBy("g", "v.metric", "v.bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(rows: DataFrame, kept: int) -> DataFrame:
    """Sketches of coarser groups: only the first ``kept`` group columns are told apart."""
    g = F.struct(*(F.col(f"g.g{i}").alias(f"g{i}") for i in range(kept))) if kept else F.struct(F.lit(0).alias("all"))
    return rows.groupBy(g.alias("g"), "metric", "bucket").agg(F.sum("n").alias("n"))


def fences(rows: DataFrame, metrics: tuple[Metric, ...] = METRICS, reach: float = 3.0) -> DataFrame:
    """Per group: documents ``n`` and an array of (low, high) limits, one per metric in order."""
    ordered = Window.partitionBy("g", "metric").orderBy(F.col("bucket").asc_nulls_first())
    whole = Window.partitionBy("g", "metric")
    ranked = rows.withColumn("upto", F.sum("n").over(ordered)).withColumn("all", F.sum("n").over(whole))
    quartile = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("all"), _middle(F.col("bucket"))))
    quartiles = ranked.groupBy("g", "metric").agg(F.first("all").alias("n"), quartile(1).alias("q1"), quartile(3).alias("q3"))
    least = F.element_at(F.array(*(F.lit(m.least) for m in metrics)), F.col("metric") + 1)
    lower = F.element_at(F.array(*(F.lit(m.two_sided) for m in metrics)), F.col("metric") + 1)
    spread = F.greatest(F.col("q3") - F.col("q1"), least) * reach
    limit = F.struct("metric", F.when(lower, F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high"))
    return quartiles.groupBy("g").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(limit)).alias("limits"))


def judge(
    measured: DataFrame, column: str, by: tuple[str, ...] = ("lang", "source"), metrics: tuple[Metric, ...] = METRICS,
    reach: float = 3.0, min_group: int = 200, max_broadcast_groups: int = 100_000,
) -> tuple[DataFrame, str]:
    """``measured`` with a boolean column, true for documents to keep, and that column's name.

    ``measured`` is read twice, so pass a stored table. The fences have one row per group; they are broadcast if there are
    at most ``max_broadcast_groups``, each below 1 kB, and joined by a shuffle otherwise.
    """
    own = stored(sketches(measured, column, by, metrics), "quality-sketches")
    limits = None
    group = F.struct(*(F.col(f"`{c}`").alias(f"g{i}") for i, c in enumerate(by)))
    for kept in range(len(by), -1, -1):
        level = fences(own if kept == len(by) else merged(own, kept), metrics, reach)
        if kept == len(by):
            limits = level.select("g", "n", "limits")
        else:
            coarse = level.select(F.col("g").alias("c"), F.col("n").alias("cn"), F.col("limits").alias("climits"))
            key = F.struct(*(F.col(f"g.g{i}").alias(f"g{i}") for i in range(kept))) if kept else F.struct(F.lit(0).alias("all"))
            small = F.col("n") < min_group
            limits = limits.withColumn("k", key).join(coarse, F.col("k").eqNullSafe(F.col("c")), "left").select(
                "g", F.when(small, F.col("cn")).otherwise(F.col("n")).alias("n"), F.when(small, F.col("climits")).otherwise(F.col("limits")).alias("limits"))
    g, found = free_name(measured.columns, "group"), free_name(measured.columns, "limits")
    limits = stored(limits.select(F.col("g").alias(g), F.col("limits").alias(found)), "quality-fences")
    if has_at_most(limits, max_broadcast_groups):
        limits = F.broadcast(limits)
    inside = F.lit(True)
    for k, m in enumerate(metrics):
        value, limit = m.value(F.col(column)), F.col(found)[k]
        inside = inside & (value <= limit["high"]) & ((value >= limit["low"]) if m.two_sided else F.lit(True))
    kept = free_name(measured.columns, "kept")
    own_group = free_name(measured.columns, "own_group")
    groups = measured.withColumn(own_group, group)
    joined = groups.join(limits, groups[own_group].eqNullSafe(limits[g]), "left")
    verdict = ~F.col(f"`{column}`.base_failed") & F.coalesce(inside, F.lit(False))
    return joined.select(*(F.col(f"`{c}`") for c in measured.columns), verdict.alias(kept)), kept


def keep_good(docs: DataFrame, text: str = "text", by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    measured, column = measure(docs, text)
    judged, kept = judge(stored(measured, "quality-measured"), column, by)
    return judged.filter(F.col(kept)).select(*(F.col(f"`{c}`") for c in docs.columns))
