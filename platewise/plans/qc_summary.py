"""The QC summary of many runs: the flagship job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from platewise.operators.summary import assemble_qc, round_metrics, override_merge
from platewise.sources.multiqc import read_multiqc_json
from platewise.sources.text import read_samples


def qc_summary(
    samples: DataFrame, fastqc_general: DataFrame, trim_stats: DataFrame, kraken_hits: DataFrame,
    fastqc_status: DataFrame, calls: DataFrame,
) -> DataFrame:
    """One row per sheet row: ``run_id, sample_ord`` and the 17 summary columns."""
    metrics = assemble_qc(samples, fastqc_general, trim_stats, kraken_hits, fastqc_status)
    return round_metrics(override_merge(metrics, calls))


def qc_summary_from_files(
    spark: SparkSession, sheets: str | list[str], metrics_json: str | list[str], calls: DataFrame
) -> DataFrame:
    """The same from sample sheets and metrics reports on disk."""
    return qc_summary(read_samples(spark, sheets), **read_multiqc_json(spark, metrics_json), calls=calls)
