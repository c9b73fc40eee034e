"""The metrics report: one JSON object per file, one or more files per run; four sections are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise import reference_values as ref
from platewise.session import checkpointed
from platewise.sources.text import file_path


def parse_metrics(docs: DataFrame) -> dict[str, DataFrame]:
    """The tables ``fastqc_general``, ``kraken_hits``, ``trim_stats`` and ``fastqc_status``.

    ``docs`` has ``run_id`` and the JSON text in ``value``. Every document is parsed once, to a variant that is stored; the tables take their
    sections from it. A missing section is an error when its table is read; text that is no JSON is an error at once.
    """
    spark = docs.sparkSession
    doc = checkpointed(docs.select("run_id", F.parse_json("value").alias("doc")))

    def section(path: str) -> Column:
        value = F.try_variant_get("doc", path, "variant")
        missing = F.raise_error(f"required section missing in metrics report: {path.split('.')[-1].split('[')[0]}").cast("variant")
        return F.when(value.isNull() | F.is_variant_null(value), missing).otherwise(value)

    def entries(path: str) -> DataFrame:
        """One row per key of a section: ``metric_key`` and its value ``m``."""
        found = doc.select("run_id", section(path).alias("section")).lateralJoin(spark.tvf.variant_explode(F.col("section").outer()))
        return found.select("run_id", F.col("key").alias("metric_key"), F.col("value").alias("m"))

    def field(column: str, name: str, kind: str) -> Column:
        return F.try_variant_get(column, f"$.{name}", kind).alias(name)

    def number(name: str) -> Column:
        return F.try_variant_get("m", f"$.{name}", "string").try_cast("double").alias(name)

    general = entries(f"$.report_general_stats_data[{ref.GENERAL_STATS_INDEX}]")
    raw = "$.report_saved_raw_data."
    hits = entries(raw + "multiqc_kraken").lateralJoin(spark.tvf.variant_explode_outer(F.col("m").outer()))
    modules = entries(raw + "multiqc_fastqc").lateralJoin(spark.tvf.variant_explode(F.col("m").outer()))
    return {
        "fastqc_general": general.select("run_id", "metric_key", number("total_sequences"), number("percent_gc"), number("avg_sequence_length")),
        "kraken_hits": hits.select(
            "run_id", "metric_key", "pos", field("value", "rank_code", "string"), field("value", "percent", "double"), field("value", "classif", "string")),
        "trim_stats": entries(raw + "multiqc_trimmomatic").select("run_id", "metric_key", field("m", "surviving_pct", "double")),
        "fastqc_status": modules.select("run_id", "metric_key", F.col("key").alias("module"), F.try_variant_get("value", "$", "string").alias("status")),
    }


def read_multiqc_json(
    spark: SparkSession, path: str | list[str], run_pattern: str = r"([^/]+)/[^/]+/[^/]+/[^/]+$"
) -> dict[str, DataFrame]:
    """Metrics reports, JSON files of one or more per run, as the tables of :func:`parse_metrics`.

    A file is one JSON object and parsed whole, so a task needs memory for the files it reads, however many a run has.
    """
    docs = spark.read.text(path, wholetext=True).select(
        F.regexp_extract(file_path(), run_pattern, 1).alias("run_id"), "value"
    )
    return parse_metrics(docs)
