"""Read-pair stages: trimming, survivors, subsampling and read quality statistics.

One row is one pair, so mates never drift apart. Algorithms and thresholds are this library's own
contract (see each function); they follow the stage parameters, not another program's output.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise import reference_values as ref
from platewise.functions import sequence as sq
from platewise.session import broadcast_if_small, checkpointed, short_batches

SAMPLE_KEY = ["run_id", "sample_id"]
SEED_LENGTH = 16
#: Qualities that one task's Python worker gets at once; their bytes are bounded by ``short_batches``.
ROWS_AT_ONCE = 500


def union_lanes(lanes: list[DataFrame]) -> DataFrame:
    """All lanes of all samples as one read set."""
    return reduce(DataFrame.unionByName, lanes)


def _trim_mate(reads: DataFrame, seq: str, qual: str, p: dict, seeds: dict[int, list[str]]) -> DataFrame:
    """Steps in order: low-quality start, low-quality end, sliding window, minimum length, adapter."""
    lead = sq.leading_low(F.col(qual), p["leading"])
    step = reads.withColumn("_lead", lead)
    step = step.withColumn(
        "_len", F.greatest(F.length(qual) - F.col("_lead") - sq.trailing_low(F.col(qual), p["trailing"]), F.lit(0))
    )
    scores = F.substr(qual, F.col("_lead") + 1, F.col("_len"))
    step = step.withColumn("_keep", sq.window_cut(scores, p["window"], p["required"]))
    step = step.withColumn("_keep", F.when(F.col("_keep") < p["min_length"], 0).otherwise(F.col("_keep")))
    step = step.withColumn(seq, F.substr(seq, F.col("_lead") + 1, F.col("_keep")))
    step = step.withColumn(qual, F.substr(qual, F.col("_lead") + 1, F.col("_keep")))
    if seeds:
        step = step.withColumn("_adapter", F.array_min(F.array(*(sq.adapter_start(F.col(seq), own, m) for m, own in seeds.items()))))
        keep = F.coalesce("_adapter", F.length(seq))
        step = step.withColumn(qual, F.substr(qual, F.lit(1), keep)).withColumn(seq, F.substr(seq, F.lit(1), keep))
        step = step.drop("_adapter")
    return step.drop("_lead", "_len", "_keep")


def trim_reads(
    reads: DataFrame,
    adapters: Sequence[str] = (),
    leading: int = ref.LEADING_QUALITY,
    trailing: int = ref.TRAILING_QUALITY,
    window: int = ref.WINDOW_SIZE,
    required: int = ref.WINDOW_QUALITY,
    min_length: int = ref.MIN_LENGTH,
    mismatches: int = ref.SEED_MISMATCHES,
    seed_length: int = SEED_LENGTH,
) -> DataFrame:
    """Trim both mates; a mate that does not survive becomes ''.

    The window step keeps the bases before the start of the first failing window. The adapter step comes
    last, as listed by the stage: a read is cut where the first ``seed_length`` bases of an adapter match with
    at most ``mismatches`` differences; a shorter adapter must match as a whole, with a share of the differences
    in proportion to its length. The length limit is not applied again afterwards. Adapters are a short list
    of sequences; an empty one is an error.
    """
    short_batches(reads.sparkSession, ROWS_AT_ONCE)
    p = dict(
        leading=leading, trailing=trailing, window=window, required=required,
        min_length=min_length, mismatches=mismatches,
    )
    seeds: dict[int, list[str]] = {}
    for seed in sorted({a[:seed_length] for a in adapters}):
        if not seed:
            raise ValueError("an adapter may not be empty")
        seeds.setdefault(mismatches * len(seed) // seed_length, []).append(seed)
    out = _trim_mate(reads, "seq1", "qual1", p, seeds)
    return _trim_mate(out, "seq2", "qual2", p, seeds).withColumn(
        "survivor", split_survivors(F.length("seq1"), F.length("seq2"))
    )


def split_survivors(kept1: Column, kept2: Column) -> Column:
    """Class of a pair by what is left of its mates."""
    return (
        F.when((kept1 > 0) & (kept2 > 0), "paired")
        .when(kept1 > 0, "unpaired_r1")
        .when(kept2 > 0, "unpaired_r2")
        .otherwise("dropped")
    )


def trim_survival(trimmed: DataFrame) -> DataFrame:
    """Pairs by survivor class per sample, and the share of pairs that stayed paired."""
    classes = ["paired", "unpaired_r1", "unpaired_r2", "dropped"]
    return (
        trimmed.groupBy(*SAMPLE_KEY)
        .agg(F.count("*").alias("pairs"), *[F.count_if(F.col("survivor") == c).alias(c) for c in classes])
        .withColumn("surviving_pct", F.col("paired") / F.col("pairs") * 100)
    )


def pair_count(reads: DataFrame) -> DataFrame:
    return reads.groupBy(*SAMPLE_KEY).agg(F.count("*").alias("pairs"))


def subsample_pairs(
    reads: DataFrame,
    n: int = ref.SUBSAMPLE_PAIRS,
    min_pairs: int = ref.SUBSAMPLE_MIN_PAIRS,
    seed: int = ref.SUBSAMPLE_SEED,
    keys: list[str] | None = None,
    id_columns: list[str] | None = None,
    bits: int = 12,
) -> DataFrame:
    """Samples with more than ``min_pairs`` rows keep exactly ``n``; all others keep every row.

    Kept are the first ``n`` rows in the order of md5(seed, id), so the choice depends on nothing but
    the ids, which must be unique within a sample. No sample is sorted: a histogram of the leading hash
    digits tells in which bin row ``n`` falls, a second one over that bin's rows narrows it to a
    sub-bin, and only that sub-bin (one row in 4096 * 4096) is ranked. The result is a filter on the
    original rows against one small cut row per sample; wide rows are never shuffled for it.
    """
    keys = keys or SAMPLE_KEY
    id_columns = id_columns or ["lane", "read_id"]
    digits = bits // 4
    identity = F.concat_ws(":", F.lit(str(seed)), *id_columns)
    hashed = F.md5(identity.cast("binary"))

    def bin_of(level: int) -> Column:
        return F.substr("_hash", F.lit(level * digits + 1), F.lit(digits))

    def cut_bin(histogram: DataFrame, wanted: Column) -> DataFrame:
        """The bin that holds the wanted row and how many of its rows are still needed."""
        up_to = Window.partitionBy(*keys).orderBy("_bin")
        return (
            histogram.withColumn("_upto", F.sum("_rows").over(up_to))
            .where((F.col("_upto") >= wanted) & (F.col("_upto") - F.col("_rows") < wanted))
            .withColumn("_need", wanted - (F.col("_upto") - F.col("_rows")))
        )

    narrow = reads.select(*keys, identity.alias("_id"), hashed.alias("_hash"))
    histogram = narrow.groupBy(*keys, bin_of(0).alias("_bin")).agg(F.count("*").alias("_rows"))
    total = F.sum("_rows").over(Window.partitionBy(*keys))
    large = histogram.withColumn("_total", total).where(F.col("_total") > min_pairs)
    first = broadcast_if_small(cut_bin(large, F.lit(n)).select(*keys, "_bin", "_need"))

    # rows of the one bin per large sample that holds row n; stored, the rest of the search is small
    inside = checkpointed(
        narrow.withColumn("_bin", bin_of(0)).join(first, keys + ["_bin"]).drop("_bin")
    )
    sub_histogram = inside.groupBy(*keys, "_need", bin_of(1).alias("_bin")).agg(F.count("*").alias("_rows"))
    second = cut_bin(sub_histogram.withColumnRenamed("_need", "_wanted"), F.col("_wanted"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_hash", "_id"))
    last = (
        inside.drop("_need")
        .withColumn("_bin", bin_of(1))
        .join(second.select(*keys, "_bin", "_need"), keys + ["_bin"])
        .withColumn("_rank", rank)
        .where(F.col("_rank") == F.col("_need"))
        .select(*keys, F.struct("_hash", "_id").alias("_last"))
    )
    cuts = broadcast_if_small(last)
    return (
        reads.join(cuts, keys, "left")
        .where(F.col("_last").isNull() | (F.struct(hashed.alias("_hash"), identity.alias("_id")) <= F.col("_last")))
        .select(*reads.columns)
    )




def read_stats(reads: DataFrame) -> DataFrame:
    """Per sample and mate: sequences, GC percentage over all bases, mean length. Empty mates count not."""
    def sums(n: int) -> list[Column]:
        seq = F.when(F.length(f"seq{n}") > 0, F.col(f"seq{n}"))
        return [
            F.count(seq).alias(f"n{n}"),
            F.sum(F.length(seq)).alias(f"bases{n}"),
            F.sum(sq.gc_count(seq)).alias(f"gc{n}"),
        ]

    wide = reads.groupBy(*SAMPLE_KEY).agg(*sums(1), *sums(2))
    mates = F.explode(
        F.array(*[
            F.struct(
                F.lit(f"R{n}").alias("mate"), F.col(f"n{n}").alias("total_sequences"),
                F.col(f"bases{n}").alias("bases"), F.col(f"gc{n}").alias("gc_bases"),
            )
            for n in (1, 2)
        ])
    )
    return wide.select(*SAMPLE_KEY, mates.alias("m")).select(
        *SAMPLE_KEY, "m.*",
    ).withColumn("percent_gc", F.try_divide(F.col("gc_bases") * 100, F.col("bases"))).withColumn(
        "avg_sequence_length", F.try_divide(F.col("bases"), F.col("total_sequences"))
    )


def length_histogram(reads: DataFrame) -> DataFrame:
    """Reads per sample, mate and length."""
    both = F.explode(
        F.array(*[
            F.struct(F.lit(f"R{n}").alias("mate"), F.length(f"seq{n}").alias("read_length")) for n in (1, 2)
        ])
    )
    return (
        reads.select(*SAMPLE_KEY, both.alias("m"))
        .groupBy(*SAMPLE_KEY, "m.mate", "m.read_length")
        .agg(F.count("*").alias("n_reads"))
    )


def duplicate_reads(reads: DataFrame) -> DataFrame:
    """Per sample and mate: reads, distinct sequences and the percentage that repeats another read.

    Sequences travel as SHA-256 digests; the counts of one sequence are combined before the shuffle, so
    a sequence that makes up most of a sample is no hot key.
    """
    both = F.explode(
        F.array(*[
            F.struct(F.lit(f"R{n}").alias("mate"), F.unhex(F.sha2(F.col(f"seq{n}").cast("binary"), 256)).alias("digest"))
            for n in (1, 2)
        ])
    )
    per_sequence = (
        reads.select(*SAMPLE_KEY, both.alias("m"))
        .groupBy(*SAMPLE_KEY, "m.mate", "m.digest")
        .agg(F.count("*").alias("copies"))
    )
    return (
        per_sequence.groupBy(*SAMPLE_KEY, "mate")
        .agg(F.sum("copies").alias("n_reads"), F.count("*").alias("n_distinct"))
        .withColumn("duplicate_pct", (F.col("n_reads") - F.col("n_distinct")) * 100 / F.col("n_reads"))
    )


def position_counts(reads: DataFrame, bin_width: int = 1) -> DataFrame:
    """Bases per sample, mate, position, base class (A, C, G, T, N for others) and quality score.

    Positions are 0-based; with ``bin_width`` they are grouped under the first position of their bin,
    as long reads are. This is the only step over single bases. Each task counts its rows with numpy, a
    bounded number of bases at a time, so only counts (positions x classes x scores per sample) leave it.
    """
    schema = "run_id string, sample_id string, mate string, cells array<bigint>, counts array<bigint>"

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in sq.slices(batch[["seq1", "seq2"]].map(lambda s: len(s or "")).sum(axis=1)):
                rows = batch.iloc[part]
                groups = rows.groupby(SAMPLE_KEY, sort=False).ngroup().to_numpy()
                keys = dict(zip(groups.tolist(), rows[SAMPLE_KEY].itertuples(index=False, name=None)))
                for n in (1, 2):
                    found = sq.count_cells(rows[f"seq{n}"], rows[f"qual{n}"], groups, bin_width)
                    out = [(*keys[group], f"R{n}", cells, counts) for group, cells, counts in found]
                    yield pd.DataFrame(out, columns=["run_id", "sample_id", "mate", "cells", "counts"])

    columns = reads.select(*SAMPLE_KEY, "seq1", "qual1", "seq2", "qual2")
    cell = F.col("cell")
    return (
        columns.mapInPandas(count, schema)
        .select(*SAMPLE_KEY, "mate", F.explode(F.arrays_zip("cells", "counts")).alias("x"))
        .groupBy(*SAMPLE_KEY, "mate", F.col("x.cells").alias("cell"))
        .agg(F.sum("x.counts").alias("n"))
        .select(
            *SAMPLE_KEY, "mate", sq.cell_position(cell, bin_width).alias("pos"), sq.cell_base(cell).alias("base"),
            sq.cell_quality(cell).alias("quality"), "n",
        )
    )


def position_profile(counts: DataFrame) -> DataFrame:
    """Per position: depth, mean and quartile quality, base percentages, from :func:`position_counts`.

    Quartiles are exact: the smallest score whose cumulative count reaches the quarter. The window runs
    over the distinct scores of one position, a few dozen rows.
    """
    key = [*SAMPLE_KEY, "mate", "pos"]
    per_score = counts.groupBy(*key, "quality").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col("base") == b, F.col("n")).otherwise(0)).alias(f"n_{b}") for b in "ACGTN"],
    )
    group = Window.partitionBy(*key)
    ranked = per_score.withColumn("upto", F.sum("n").over(group.orderBy("quality"))).withColumn(
        "depth", F.sum("n").over(group)
    )

    def quartile(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("depth") * share, F.col("quality")))

    return ranked.groupBy(*key).agg(
        F.max("depth").alias("depth"),
        (F.sum(F.col("quality") * F.col("n")) / F.max("depth")).alias("mean_quality"),
        quartile(0.25).alias("q1_quality"), quartile(0.5).alias("median_quality"),
        quartile(0.75).alias("q3_quality"),
        *[(F.sum(f"n_{b}") * 100 / F.max("depth")).alias(f"pct_{b}") for b in "ACGTN"],
    )


def module_status(profile: DataFrame, warn_below: float = 25.0, fail_below: float = 20.0) -> DataFrame:
    """pass / warn / fail of ``per_base_sequence_quality`` per sample and mate, by the lowest median."""
    lowest = F.min("median_quality")
    return profile.groupBy(*SAMPLE_KEY, "mate").agg(
        F.lit("per_base_sequence_quality").alias("module"),
        F.when(lowest < fail_below, "fail").when(lowest < warn_below, "warn").otherwise("pass").alias("status"),
    )


def metric_matrix(metrics: DataFrame, names: list[str], keys: list[str] | None = None) -> DataFrame:
    """Long (key, metric, value) rows as one row per key and one column per named metric."""
    keys = keys or SAMPLE_KEY
    return metrics.groupBy(*keys).pivot("metric", names).agg(F.max("value"))
