"""The QC summary: one row per sheet row, all sides reduced to one row per key before they are joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise import reference_values as ref
from platewise.functions.numeric import default_missing, paired_total, round_binary_half_even
from platewise.functions.text import base_sample_id
from platewise.operators.taxa import first_present_key, first_second_taxa


def fastqc_fails(status: DataFrame) -> DataFrame:
    """Failing modules over both mates per (run, base id), sorted and joined by '; '.

    The set holds module names only, so it stays as small as the list of modules.
    """
    key = F.regexp_extract("metric_key", r"(?s)^(.*)_processed_R[12]$", 1)
    failing = status.where(
        (F.col("status") == "fail")
        & (F.col("module") != ref.IGNORED_MODULE)
        & F.col("metric_key").rlike(r"_processed_R[12]$")
    )
    modules = F.array_sort(F.collect_set("module"))
    return failing.groupBy("run_id", key.alias("base_id")).agg(
        F.array_join(modules, "; ").alias("fastqc_fails")
    )


def _one_per_key(df: DataFrame, key: str) -> DataFrame:
    values = [c for c in df.columns if c not in ("run_id", key)]
    return (
        df.groupBy("run_id", key)
        .agg(F.max(F.struct(*values)).alias("_row"))
        .select("run_id", key, "_row.*")
    )


def unique_calls(calls: DataFrame) -> DataFrame:
    """Species calls with one row per sample; a duplicate id is an error that names the sample."""
    message = F.concat(
        F.lit("duplicate species call for sample "), F.col("run_id"), F.lit("/"), F.col("sample_id")
    )
    grouped = calls.groupBy("run_id", "sample_id").agg(
        F.count("*").alias("_n"),
        F.max(F.struct("top_species", "taxid", "expected_genome_size")).alias("_call"),
    )
    checked = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return grouped.select("run_id", "sample_id", "_call.*", checked.alias("matched"))


def assemble_qc(
    samples: DataFrame,
    fastqc_general: DataFrame,
    trim_stats: DataFrame,
    kraken_hits: DataFrame,
    fastqc_status: DataFrame,
) -> DataFrame:
    """Sheet left-joined with its metrics: exactly one output row per sheet row, unrounded."""
    sheet = (
        samples.withColumn("metric_key", F.concat("sample_id", F.lit(ref.MATE_SUFFIXES[0])))
        .withColumn("base_id", base_sample_id(F.col("metric_key")))
    )
    general = _one_per_key(fastqc_general, "metric_key")
    trim = _one_per_key(trim_stats, "metric_key").withColumnRenamed("metric_key", "base_id")
    taxa = first_present_key(first_second_taxa(kraken_hits))
    return (
        sheet.join(trim, ["run_id", "base_id"], "left")
        .join(taxa, ["run_id", "base_id"], "left")
        .join(fastqc_fails(fastqc_status), ["run_id", "base_id"], "left")
        .join(general, ["run_id", "metric_key"], "left")
    )


def override_merge(metrics: DataFrame, calls: DataFrame) -> DataFrame:
    """Overlay the species call: where a sample has one, all its columns replace the metric's.

    The match decides, not the value: a matched 'Unknown' or null replaces the metric species too.
    """
    def overlay(call: str, otherwise: Column) -> Column:
        return F.when(F.col("matched"), F.col(call)).otherwise(otherwise)

    return (
        metrics.join(unique_calls(calls), ["run_id", "sample_id"], "left")
        .withColumn("top_species", overlay("top_species", default_missing(F.col("species_1"), ref.MISSING_TAXON)))
        .withColumn("taxid", overlay("taxid", F.lit(ref.MISSING_CALL)))
        .withColumn("expected_genome_size", overlay("expected_genome_size", F.lit(ref.MISSING_CALL)))
        .drop("matched")
    )


def round_metrics(merged: DataFrame) -> DataFrame:
    """Defaults, rounding and the 17 output columns, after ``run_id`` and ``sample_ord``."""
    def rounded(column: str, digits: int) -> Column:
        return round_binary_half_even(f"coalesce({column}, 0D)", digits)

    def taxon(column: str) -> Column:
        return default_missing(F.col(column), ref.MISSING_TAXON)

    return merged.select(
        "run_id",
        "sample_ord",
        F.col("base_id").alias("Sample_ID"),
        default_missing(paired_total(F.col("total_sequences")), 0).alias("Total_Trimmed_Reads"),
        rounded("percent_gc", 1).alias("GC_PCT"),
        rounded("avg_sequence_length", 1).alias("Avg_Sequence_Length"),
        rounded("surviving_pct", 2).alias("Passing_Trim_PCT"),
        rounded("unclassified_pct", 1).alias("Unclassified_PCT"),
        taxon("genus_1").alias("Top_Genus"),
        rounded("genus_1_pct", 2).alias("Top_Genus_PCT"),
        taxon("genus_2").alias("Second_Genus"),
        rounded("genus_2_pct", 2).alias("Second_Genus_PCT"),
        F.col("top_species").alias("Top_Species"),
        rounded("species_1_pct", 2).alias("Top_Species_PCT"),
        taxon("species_2").alias("Second_Species"),
        rounded("species_2_pct", 2).alias("Second_Species_PCT"),
        default_missing(F.col("fastqc_fails"), "").alias("FASTQC_fails"),
        F.col("taxid").alias("TaxID"),
        F.col("expected_genome_size").alias("Expected_Genome_Size"),
    )
