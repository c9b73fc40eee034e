"""Run accounting: expected and present outputs, task outcomes, resource use, capacity and versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise import reference_values as ref
from platewise.functions.numeric import round_binary_half_even
from platewise.functions.text import (
    base_name, expand_entries, expand_template, has_wildcard, parent_dir, parse_skip_list,
)
from platewise.operators.globs import glob_match
from platewise.session import broadcast_if_small, bucketed, checkpointed

STATUSES = ["skipped", "skipped_missing_input", "completed", "allowed_failure", "failed"]


def allowed_failures(runs: DataFrame, configured: str, skip_list: str) -> DataFrame:
    """Samples allowed to fail, from a configured array column and a comma-list column per run."""
    both = F.array_union(F.coalesce(configured, F.array().cast("array<string>")), parse_skip_list(F.col(skip_list)))
    ids = F.explode(F.array_distinct(F.filter(F.transform(both, lambda s: F.btrim(s)), lambda s: s != "")))
    return runs.select("run_id", ids.alias("sample_id")).distinct()


def is_allowed_failure(rows: DataFrame, allowed: DataFrame) -> DataFrame:
    """Add the flag ``allowed``: the row's sample may fail in its run."""
    flagged = allowed.select("run_id", "sample_id").distinct().withColumn("_allowed", F.lit(True))
    return (
        rows.join(flagged, ["run_id", "sample_id"], "left")
        .withColumn("allowed", F.coalesce("_allowed", F.lit(False)))
        .drop("_allowed")
    )


def _tool_array(tools: DataFrame, *columns: str) -> Column:
    """The tool definitions as one array value (a configuration, a few entries), ordered."""
    values = F.map_entries("tool_values") if "tool_values" in tools.columns else F.array().cast(_VALUES)
    rows = tools.withColumn("tool_values", F.coalesce(values, F.array().cast(_VALUES)))
    return rows.agg(F.sort_array(F.collect_list(F.struct("tool_ord", "tool", "execution_mode", *columns, "tool_values"))).alias("tools")).scalar()


_VALUES = "array<struct<key:string,value:string>>"


def _settings(runs: DataFrame) -> DataFrame:
    """``runs`` with ``settings`` as entries, none where the runs have no settings."""
    values = F.map_entries("settings") if "settings" in runs.columns else F.array().cast(_VALUES)
    return runs.withColumn("settings", F.coalesce(values, F.array().cast(_VALUES)))


def _of_run(samples: DataFrame, runs: DataFrame) -> DataFrame:
    """``samples`` with what their run says. Runs are counted and few: the samples of a run are not gathered for it."""
    return samples.select("run_id", "sample_ord", "sample_id").join(broadcast_if_small(_settings(runs)), "run_id")


def _path(pattern: Column, extra: dict[str, Column] | None = None) -> Column:
    """The pattern with all its names replaced, in one pass of three steps, so that a value may hold names of a later step.

    First the values of the tool, then the settings of the run, each in the order of their names, then the names that every path knows;
    those are never taken from the values or settings.
    """
    values = {
        "runid": F.col("run_id"), "rundir": F.col("rundir"), "script_dir": F.col("script_dir"),
        "input_dir": F.col("input_dir"), "tool": F.col("tool"), **(extra or {}),
    }
    known = F.array(*[F.lit(name) for name in values])
    for entries in (F.col("tool_values"), F.col("settings")):
        pattern = expand_entries(pattern, F.filter(entries, lambda e: ~F.array_contains(known, e["key"])))
    return expand_template(pattern, values)


def expected_manifest(samples: DataFrame, tools: DataFrame, runs: DataFrame) -> DataFrame:
    """Every output the tools should leave: one row per sample and per-sample output, one per batch output.

    The tool definitions enter as one array that each row explodes, so the size is samples times tools
    without a join; run settings come by run id, broadcast if the runs are few. ``runs`` may have a map ``settings`` and ``tools`` a map ``tool_values`` of names
    that paths can use.
    """
    out = ["run_id", "tool_ord", "tool", "execution_mode", "sample_ord", "sample_id", "path"]
    per_sample = tools.where(F.col("sample_output_pattern").isNotNull())
    batch = tools.where(F.col("output_pattern").isNotNull())
    sample_rows = (
        _of_run(samples, runs).withColumn("t", F.explode(_tool_array(per_sample, "sample_output_pattern")))
        .select("*", "t.*")
        .withColumn("path", _path(F.col("sample_output_pattern"), {"sample_id": F.col("sample_id")}))
    )
    batch_rows = (
        _settings(runs).withColumn("t", F.explode(_tool_array(batch, "output_pattern")))
        .select(*_settings(runs).columns, "t.*")
        .withColumn("path", _path(F.col("output_pattern")))
        .withColumn("sample_ord", F.lit(None).cast("bigint"))
        .withColumn("sample_id", F.lit(None).cast("string"))
    )
    return sample_rows.select(*out).unionByName(batch_rows.select(*out))


def with_presence(manifest: DataFrame, artifacts: DataFrame) -> DataFrame:
    """``manifest`` with the flag ``present``: an artifact has the row's path, or fits it if it is a glob.

    One left join with the distinct paths that are there, artifacts and matched globs together: each side is shuffled once, by path.
    """
    globs = manifest.where(has_wildcard(F.col("path"))).select(F.col("path").alias("pattern"))
    there = artifacts.select("path").unionByName(glob_match(globs, artifacts).select(F.col("pattern").alias("path"))).distinct()
    flagged = manifest.join(there.withColumn("_there", F.lit(True)), "path", "left")
    return flagged.select(*(F.col(f"`{c}`") for c in manifest.columns), F.coalesce("_there", F.lit(False)).alias("present"))


def presence_index(manifest: DataFrame, artifacts: DataFrame) -> DataFrame:
    """:func:`with_presence`, kept as a table bucketed by path: whatever is joined with it by path later shuffles only its own side, or nothing if it is bucketed alike."""
    return bucketed(with_presence(manifest, artifacts), "path")


def pending_outputs(manifest: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Manifest rows whose output does not exist: the work still to do."""
    return with_presence(manifest, artifacts).where(~F.col("present")).drop("present")


def existing_outputs(manifest: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Manifest rows whose output exists: the work that can be skipped."""
    return with_presence(manifest, artifacts).where("present").drop("present")


def required_inputs(samples: DataFrame, tools: DataFrame, runs: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Missing inputs: one row per (run, tool, sample) and required path, or glob, that no artifact fits."""
    needing = tools.where(F.size(F.coalesce("required", F.array().cast("array<string>"))) > 0)
    rows = (
        _of_run(samples, runs).withColumn("t", F.explode(_tool_array(needing, "required")))
        .select("*", "t.*")
        .withColumn("pattern", F.explode("required"))
        .withColumn("path", _path(F.col("pattern"), {"sample_id": F.col("sample_id")}))
        .where((F.col("execution_mode") != "batch") | F.col("pattern").contains("{sample_id}"))
    )
    batch = (
        _settings(runs).withColumn("t", F.explode(_tool_array(needing.where("execution_mode = 'batch'"), "required")))
        .select(*_settings(runs).columns, "t.*")
        .withColumn("pattern", F.explode("required"))
        .where(~F.col("pattern").contains("{sample_id}"))
        .withColumn("path", _path(F.col("pattern")))
        .withColumn("sample_ord", F.lit(None).cast("bigint"))
        .withColumn("sample_id", F.lit(None).cast("string"))
    )
    out = ["run_id", "tool", "sample_ord", "sample_id", "path"]
    wanted = rows.select(*out).unionByName(batch.select(*out))
    return pending_outputs(wanted, artifacts)


def missing_preview(
    rows: DataFrame, keys: list[str], n: int = ref.STAGE_PREVIEW, ellipsis: bool = True,
    order: str = "sample_ord", label: str = "sample_id", example: str | None = None,
) -> DataFrame:
    """Per key: how many rows, and the first ``n`` labels in sheet order, with '...' if there are more.

    Only the first ``n`` rows of a key are ever brought together; the count is a plain aggregation.
    ``rows`` are read twice, so pass a stored table if they are costly.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("missing_count"))
    w = Window.partitionBy(*keys).orderBy(order, label)
    extra = [example] if example else []
    first = (
        rows.select(*keys, order, label, *extra)
        .withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= n)
        .groupBy(*keys)
        .agg(
            F.array_sort(F.collect_list(F.struct("rn", label))).alias("_first"),
            *([F.min_by(example, "rn").alias("example_path")] if example else []),
        )
    )
    names = F.array_join(F.transform("_first", lambda x: x[label]), ", ")
    dots = F.when(F.lit(ellipsis) & (F.col("missing_count") > n), "...").otherwise("")
    return counts.join(first, keys).select(
        *keys, "missing_count", F.concat(names, dots).alias("preview"),
        *(["example_path"] if example else []),
    )


def stage_readiness(
    tool_deps: DataFrame, tools: DataFrame, runs: DataFrame, manifest: DataFrame,
    artifacts: DataFrame | None, allowed: DataFrame,
) -> DataFrame:
    """Per (run, tool) with dependencies: may it start, and what is missing.

    ``manifest`` may be a presence index already; artifacts are not looked at then.

    A dependency on an unknown tool is ignored; one that declares no output counts as satisfied;
    samples that may fail do not hold a stage up. Tools without dependencies have no row.
    """
    # stored: it is counted, previewed and searched for batch outputs
    flagged = manifest if "present" in manifest.columns else with_presence(manifest, artifacts)
    missing = checkpointed(flagged.where(~F.col("present")).drop("present"))
    of_samples = missing.where(F.col("sample_id").isNotNull()).join(
        allowed.select("run_id", "sample_id").distinct(), ["run_id", "sample_id"], "left_anti"
    )
    sample_detail = missing_preview(
        of_samples, ["run_id", "tool"], n=ref.DEPENDENCY_PREVIEW, example="path"
    ).select(
        "run_id", F.col("tool").alias("dep_tool"), F.col("missing_count").alias("missing_samples"),
        F.format_string(
            "%s outputs missing for %d samples: %s (expected path: %s)",
            "tool", "missing_count", "preview", "example_path",
        ).alias("sample_text"),
    )
    output_detail = missing.where(F.col("sample_id").isNull()).select(
        "run_id", F.col("tool").alias("dep_tool"),
        F.concat(F.col("tool"), F.lit(" final output missing: "), F.col("path")).alias("output_text"),
    )
    edges = tool_deps.join(
        tools.select(F.col("tool").alias("dep_tool")).distinct(), "dep_tool", "left_semi"
    ).select("dep_ord", "tool", "dep_tool")
    edge_array = edges.agg(F.sort_array(F.collect_list(F.struct("tool", "dep_ord", "dep_tool")))).scalar()
    detail = (
        runs.select("run_id", F.explode(edge_array).alias("e"))
        .select("run_id", "e.*")
        .join(sample_detail, ["run_id", "dep_tool"], "left")
        .join(output_detail, ["run_id", "dep_tool"], "left")
    )
    # at most two texts per dependency of one tool
    texts = F.flatten(
        F.transform(
            F.array_sort(F.collect_list(F.struct("dep_ord", "sample_text", "output_text"))),
            lambda d: F.array_compact(F.array(d["sample_text"], d["output_text"])),
        )
    )
    return detail.groupBy("run_id", "tool").agg(
        F.coalesce(F.sum("missing_samples"), F.lit(0)).cast("bigint").alias("missing_samples"),
        F.count("output_text").alias("missing_outputs"),
        F.array_join(texts, "\n").alias("details"),
    ).withColumn("ready", (F.col("missing_samples") == 0) & (F.col("missing_outputs") == 0))


def is_empty_or_header_only(lines: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Artifacts with the flag ``header_only``: at most one line, empty files included.

    ``lines`` has one row per text line with its ``path``.
    """
    counts = lines.groupBy("path").agg(F.count("*").alias("n_lines"))
    return artifacts.join(counts, "path", "left").select(
        "path",
        F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"),
        (F.coalesce("n_lines", F.lit(0)) <= 1).alias("header_only"),
    )


def classify_status(
    output_exists: Column, forced: Column, input_missing: Column, exit_code: Column, allowed: Column,
    raised: Column | None = None,
) -> Column:
    """Outcome of one task. An exception is a failure even for a sample that may fail."""
    raised = F.lit(False) if raised is None else raised
    return (
        F.when(output_exists & ~forced, "skipped")
        .when(input_missing, "skipped_missing_input")
        .when(raised, "failed")
        .when(exit_code == 0, "completed")
        .when(allowed, "allowed_failure")
        .otherwise("failed")
    )


def _exact_sum(value: Column) -> Column:
    """Sum of doubles that does not depend on the order they arrive in."""
    return F.sum(value.cast("decimal(28,12)")).cast("double")


def resource_usage(task_runs: DataFrame) -> DataFrame:
    """Per (run, tool): tasks measured, mean and peak memory and cores, and the stage's runtime.

    Measured are completed tasks with memory above zero. The runtime spans all tasks of the stage, from
    the first start (``ts`` minus runtime) to the last end (``ts``).
    """
    memory = F.col("max_rss_kb") / 1024 / 1024
    cores = F.when(F.col("wall_s") > 0, (F.col("user_s") + F.col("sys_s")) / F.col("wall_s")).otherwise(0.0)
    counted = (F.col("status") == "completed") & (F.col("max_rss_kb") > 0)
    end = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    span = F.max(end) - F.min(end - F.coalesce("runtime_s", F.lit(0.0)))
    return (
        task_runs.groupBy("run_id", "tool", "execution_mode")
        .agg(
            F.count_if(counted).alias("n_ran"),
            # null, not an error, where nothing was measured
            F.try_divide(_exact_sum(F.when(counted, memory)), F.count_if(counted)).alias("mean_memory_gb"),
            F.max(F.when(counted, memory)).alias("max_memory_gb"),
            F.try_divide(_exact_sum(F.when(counted, cores)), F.count_if(counted)).alias("mean_cpu_cores"),
            F.max(F.when(counted, cores)).alias("max_cpu_cores"),
            span.alias("runtime_seconds"),
        )
        .where(F.col("n_ran") > 0)
    )


def capacity_plan(usage: DataFrame, hosts: DataFrame, utilisation: float = ref.UTILISATION_TARGET) -> DataFrame:
    """How many tasks fit a host: limits, suggestion, bottleneck and the share of the host used.

    All null where memory or logical cores are unknown or a peak is not above zero. The suggestion can
    be 0 when one task needs more than the target share.
    """
    memory, cores = F.col("memory_gb"), F.col("logical_cores")
    max_memory, max_cores = F.col("max_memory_gb"), F.col("max_cpu_cores")
    known = memory.isNotNull() & cores.isNotNull() & (max_memory > 0) & (max_cores > 0)

    def fits(available: Column, need: Column) -> Column:
        return F.when(known, (available / need).cast("bigint"))

    def share(need: str, available: str) -> Column:
        return F.when(known, round_binary_half_even(f"suggested_threads * {need} / {available} * 100", 1))

    return (
        usage.join(hosts.select("run_id", "logical_cores", "memory_gb"), "run_id", "left")
        .withColumn("memory_t_recommended", fits(memory * utilisation, max_memory))
        .withColumn("memory_t_limit", fits(memory, max_memory))
        .withColumn("cpu_t_recommended", fits(cores * utilisation, max_cores))
        .withColumn("cpu_t_limit", fits(cores, max_cores))
        .withColumn("suggested_threads", F.when(known, F.least("memory_t_recommended", "cpu_t_recommended")))
        .withColumn(
            "bottleneck",
            F.when(known & (F.col("memory_t_recommended") < F.col("cpu_t_recommended")), "memory")
            .when(known, "cpu"),
        )
        .withColumn("mem_total_percent", share("max_memory_gb", "memory_gb"))
        .withColumn("cpu_total_percent", share("max_cpu_cores", "logical_cores"))
        .drop("logical_cores", "memory_gb")
    )


def run_totals(task_runs: DataFrame) -> DataFrame:
    """Per (run, tool): tasks by outcome and the summed runtime."""
    return task_runs.groupBy("run_id", "tool").agg(
        *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in STATUSES],
        _exact_sum(F.col("runtime_s")).alias("runtime_s"),
    )


def sub_tool_versions(tools: DataFrame, captured: DataFrame) -> DataFrame:
    """Version rows of the tools and of their sub-tools (``tool``, ``sub_tool``) for the log.

    ``captured`` has the main tools' ``run_id, ts, tool, version, path, database``.
    """
    main = captured.withColumn("sub_tool", F.lit(None).cast("string"))
    subs = (
        captured.select("run_id", "ts", "tool")
        .join(tools.select("tool", F.explode("sub_tools").alias("s")), "tool")
        .select(
            "run_id", "ts", "tool", F.col("s.name").alias("sub_tool"), F.col("s.version").alias("version"),
            F.col("s.path").alias("path"), F.col("s.database").alias("database"),
        )
    )
    out = ["run_id", "ts", "tool", "sub_tool", "version", "path", "database"]
    rows = main.select(*out).unionByName(subs)
    return rows.withColumn("database", F.coalesce("database", F.lit(ref.NO_DATABASE)))


def latest_versions(versions: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """The newest log row per (run, tool, sub-tool)."""
    newest = F.max_by(F.struct("ts", "version", "path", "database"), F.struct("ts", *(tie_break or ["version"])))
    return (
        versions.groupBy("run_id", "tool", "sub_tool")
        .agg(newest.alias("_row"))
        .select("run_id", "tool", "sub_tool", "_row.*")
    )
