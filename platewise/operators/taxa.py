"""Classification reports: ranks, ordered picks, renames and genome sizes.

Report order is data: ``line_no`` and ``pos`` decide what comes first, never the percentage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise import reference_values as ref
from platewise.functions.numeric import default_missing
from platewise.functions.text import clean_name, decode_rank

SAMPLE_KEY = ["run_id", "sample_id"]


def _report_order(order: str) -> list[Column]:
    if order == "report":
        return [F.col("line_no")]
    if order == "percent":
        return [F.col("percentage").try_cast("double").desc_nulls_last(), F.col("line_no")]
    raise ValueError("order must be 'report' or 'percent'")


def filter_ranks(lines: DataFrame) -> DataFrame:
    """Lines whose rank code is exactly G, S or U."""
    return lines.where(F.col("rank_code").isin(*ref.RANK_NAMES))


def top_hits(lines: DataFrame, order: str = "report") -> DataFrame:
    """First three genera, first three species and first unclassified line of each report.

    The row-number bound is a literal, so Spark cuts every map task to three rows per group before
    the shuffle and no report is ever gathered whole.
    """
    kept = filter_ranks(lines)
    w = Window.partitionBy(*SAMPLE_KEY, "rank_code").orderBy(*_report_order(order))
    block = F.when(F.col("rank_code") == "G", 0).when(F.col("rank_code") == "S", 1).otherwise(2)
    return (
        kept.withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= ref.HITS_PER_RANK)
        .where((F.col("rank_code") != "U") | (F.col("rn") <= ref.UNCLASSIFIED_HITS))
        .select(
            *SAMPLE_KEY,
            (block * ref.HITS_PER_RANK + F.col("rn")).alias("hit_ord"),
            F.col("percentage").alias("Percentage"),
            F.col("count_clade").alias("Count_Clade"),
            F.col("count_taxon").alias("Count_Taxon"),
            decode_rank(F.col("rank_code")).alias("TaxRank"),
            F.col("taxid").alias("TaxID"),
            clean_name(F.col("name")).alias("Organism"),
        )
    )


def top_species(lines: DataFrame, order: str = "report") -> DataFrame:
    """Name and taxid of each report's first species line; reports without one have no row."""
    species = lines.where(F.col("rank_code") == "S")
    if order == "report":
        position = F.col("line_no")
    else:
        _report_order(order)
        percent = F.col("percentage").try_cast("double")
        position = F.struct(percent.isNull(), -percent, F.col("line_no"))
    first = F.min_by(F.struct(clean_name(F.col("name")).alias("name"), F.col("taxid")), position)
    return species.groupBy(*SAMPLE_KEY).agg(first.alias("top")).select(
        *SAMPLE_KEY, F.col("top.name").alias("species"), F.col("top.taxid").alias("taxid")
    )


def first_or_last_wins(rows: DataFrame, key: str, value: str, keep: str, order: str = "line_no") -> DataFrame:
    """One row per key, taken from its first or its last line. Rows with a ``path`` are ordered by it first."""
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    at = F.struct("path", order) if "path" in rows.columns else F.col(order)
    return rows.groupBy(key).agg(pick(value, at).alias(value))


def apply_rename(calls: DataFrame, lookup: DataFrame, column: str = "species") -> DataFrame:
    """The listed new name in place of ``column``, else the name itself; ``lookup`` has one row per old name."""
    renamed = lookup.select(F.col("old_name").alias(column), F.col("new_name").alias("_renamed"))
    return calls.join(renamed, column, "left").withColumn(column, F.coalesce("_renamed", column)).drop("_renamed")


def species_rename(calls: DataFrame, renames: DataFrame, column: str = "species") -> DataFrame:
    """Replace listed names; the taxid stays. The last of duplicate entries counts."""
    return apply_rename(calls, first_or_last_wins(renames, "old_name", "new_name", "last"), column)


def genome_size_lookup(calls: DataFrame, sizes: DataFrame, column: str = "species") -> DataFrame:
    """Expected genome size by exact name, 'NA' if unlisted. The first of duplicate entries counts."""
    lookup = first_or_last_wins(sizes, "species", "genome_size", "first").select(
        F.col("species").alias(column), F.col("genome_size").alias("_size")
    )
    return (
        calls.join(lookup, column, "left")
        .withColumn("expected_genome_size", default_missing(F.col("_size"), ref.MISSING_CALL))
        .drop("_size")
    )


def first_second_taxa(hits: DataFrame) -> DataFrame:
    """Per metric key: first and second genus and species and the first unclassified percentage.

    A key whose hit list is empty arrives as one row with a null ``pos`` and keeps its row here, so
    that its presence can win in :func:`first_present_key`.
    """
    key = ["run_id", "metric_key"]
    w = Window.partitionBy(*key, "rank_code").orderBy("pos")
    picked = (
        hits.select(
            *key, "pos", "percent", "classif",
            F.when(F.col("rank_code").isin(*ref.RANK_NAMES), F.col("rank_code")).alias("rank_code"),
        )
        .withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= 2)
    )

    def pick(rank: str, rn: int, column: str) -> Column:
        return F.max(F.when((F.col("rank_code") == rank) & (F.col("rn") == rn), F.col(column)))

    return picked.groupBy(*key).agg(
        pick("G", 1, "classif").alias("genus_1"), pick("G", 1, "percent").alias("genus_1_pct"),
        pick("G", 2, "classif").alias("genus_2"), pick("G", 2, "percent").alias("genus_2_pct"),
        pick("S", 1, "classif").alias("species_1"), pick("S", 1, "percent").alias("species_1_pct"),
        pick("S", 2, "classif").alias("species_2"), pick("S", 2, "percent").alias("species_2_pct"),
        pick("U", 1, "percent").alias("unclassified_pct"),
    )


def first_present_key(per_key: DataFrame) -> DataFrame:
    """One row per (run, base id): of ``<id>.kraken``, ``<id>``, ``<id>_processed`` the first present.

    Each key says which base ids it may serve, so the choice is one aggregation without a join.
    """
    key = F.col("metric_key")
    values = [c for c in per_key.columns if c not in ("run_id", "metric_key")]
    options = []
    for priority, suffix in enumerate(ref.HIT_KEY_SUFFIXES):
        base = F.substr(key, F.lit(1), F.length(key) - len(suffix))
        option = F.struct(F.lit(priority).alias("priority"), base.alias("base_id"))
        options.append(F.when(key.endswith(suffix), option))
    served = F.explode(F.filter(F.array(*options), lambda o: o.isNotNull()))
    row = F.struct(*values)
    return (
        per_key.withColumn("_served", served)
        .groupBy("run_id", F.col("_served.base_id").alias("base_id"))
        .agg(F.min_by(row, F.col("_served.priority")).alias("_row"))
        .select("run_id", "base_id", "_row.*")
    )


def union_species(parts: list[DataFrame], samples: DataFrame) -> DataFrame:
    """All species calls of the sheet's samples; leftovers of other samples are not taken along."""
    calls = reduce(DataFrame.unionByName, parts)
    return calls.join(samples.select(*SAMPLE_KEY).distinct(), SAMPLE_KEY, "left_semi")
