"""Run accounting: what is still to do, what may start, and what the tools consumed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.operators import accounting as acc
from platewise.session import bucketed
from platewise.sources.sinks import resource_rows


def work_plan(
    samples: DataFrame, tools: DataFrame, tool_deps: DataFrame, runs: DataFrame, artifacts: DataFrame,
    allowed: DataFrame,
) -> dict[str, DataFrame]:
    """The manifest, its pending and existing part, missing inputs and the readiness of each stage.

    The manifest is compared with the artifacts once, as a presence index that the parts read; artifacts are kept by path for both comparisons.
    """
    there = bucketed(artifacts.select("path").distinct(), "path")
    index = acc.presence_index(acc.expected_manifest(samples, tools, runs), there)
    return {
        "manifest": index.drop("present"),
        "pending": index.where(~F.col("present")).drop("present"),
        "existing": index.where("present").drop("present"),
        "missing_inputs": acc.required_inputs(samples, tools, runs, there),
        "readiness": acc.stage_readiness(tool_deps, tools, runs, index, None, allowed),
    }


def resource_log(task_runs: DataFrame, hosts: DataFrame, tools: DataFrame, timestamp: str) -> DataFrame:
    """Resource log rows of all runs: usage per tool and what the host could take."""
    return resource_rows(acc.capacity_plan(acc.resource_usage(task_runs), hosts), tools, timestamp)
