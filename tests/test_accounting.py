import datetime as dt
import fnmatch

import pytest
from pyspark.sql import functions as F

from platewise import schemas
from platewise.operators import accounting as acc
from platewise.plans.run_accounting import resource_log, work_plan
from platewise.sources.sinks import append_resource_usage, append_versions, versions_as_text


@pytest.fixture
def lab(spark):
    tools = [
        (1, "trim", "per_sample", 2, "{rundir}/t/{sample_id}.fq", None, ["{input_dir}/{sample_id}.raw"], None),
        (2, "qc", "per_sample", 2, "{rundir}/q/{sample_id}*_fastqc.html", "{rundir}/q/all.tsv", None, []),
        (3, "report", "batch", None, None, "{rundir}/report.html", ["{rundir}/q/all.tsv"], None),
        (4, "silent", "batch", None, None, None, None, None),
    ]
    paths = ["/d/r1/t/S1.fq", "/d/r1/t/S10.fq", "/d/r1/q/S10_1_fastqc.html", "/d/r1/q/sub/S2_fastqc.html", "/i/r1/S1.raw",
             "/d/r2/t/A.fq", "/d/r2/q/A_fastqc.html", "/d/r2/q/all.tsv"]
    return dict(
        samples=spark.createDataFrame([("r1", 0, "S1"), ("r1", 1, "S10"), ("r1", 2, "S2"), ("r2", 0, "A")], schemas.SAMPLES),
        tools=spark.createDataFrame(tools, schemas.TOOLS),
        tool_deps=spark.createDataFrame(
            [(1, "qc", "trim"), (2, "report", "qc"), (3, "report", "unknown"), (4, "report", "silent")], schemas.TOOL_DEPS
        ),
        runs=spark.createDataFrame([("r1", "/d/r1", "/i/r1", "/s"), ("r2", "/d/r2", "/i/r2", "/s")], schemas.RUNS),
        artifacts=spark.createDataFrame([(p, 1) for p in paths], schemas.ARTIFACTS),
        allowed=spark.createDataFrame([("r1", "S2")], schemas.ALLOWED_FAILURES),
    )


def test_work_plan(lab, rows):
    plan = work_plan(**lab)
    assert plan["manifest"].count() == 4 * 2 + 2 * 2
    assert set(rows(plan["pending"], "run_id", "tool", "sample_id")) == {
        ("r1", "qc", "S2"), ("r1", "qc", None), ("r1", "report", None), ("r1", "trim", "S2"), ("r2", "report", None)
    }
    # S1's pattern also finds S10's file: a prefix, as the pattern says
    assert ("r1", "qc", "S1") in rows(plan["existing"], "run_id", "tool", "sample_id")
    both = plan["pending"].unionByName(plan["existing"])
    assert both.exceptAll(plan["manifest"]).isEmpty() and plan["manifest"].exceptAll(both).isEmpty()
    assert set(rows(plan["missing_inputs"], "run_id", "tool", "sample_id", "path")) == {
        ("r1", "trim", "S10", "/i/r1/S10.raw"), ("r1", "trim", "S2", "/i/r1/S2.raw"), ("r2", "trim", "A", "/i/r2/A.raw"),
        ("r1", "report", None, "/d/r1/q/all.tsv"),
    }
    ready = {(r.run_id, r.tool): r for r in plan["readiness"].collect()}
    assert ready["r1", "qc"].ready and ready["r2", "qc"].ready and ready["r2", "report"].ready
    assert not ready["r1", "report"].ready and ready["r1", "report"].missing_samples == 0
    assert ready["r1", "report"].details == "qc final output missing: /d/r1/q/all.tsv"


def test_readiness_counts_samples_that_may_not_fail(spark, lab):
    lab["allowed"] = spark.createDataFrame([], schemas.ALLOWED_FAILURES)
    ready = {(r.run_id, r.tool): r for r in work_plan(**lab)["readiness"].collect()}
    assert ready["r1", "qc"].details == "trim outputs missing for 1 samples: S2 (expected path: /d/r1/t/S2.fq)"
    assert (ready["r1", "report"].missing_samples, ready["r1", "report"].missing_outputs) == (1, 1)


def test_glob_match_in_one_crowded_folder(spark, rows):
    files = [(f"/x/S{i}_L{i % 3}.html", 1) for i in range(300)] + [("/y/S1_L1.html", 1), ("/x/deep/S5.html", 1)]
    patterns = ["/x/S1_*.html", "/x/S1*", "/x/*_L9.html", "/x/S?_L1.*", "/x/S[0-2]_L?.html", "/x/S999*", "/x/*/S5.html", "/z/*", "/y/*"]
    got = acc.glob_match(
        spark.createDataFrame([(p,) for p in patterns], "pattern string"), spark.createDataFrame(files, schemas.ARTIFACTS)
    )
    assert set(rows(got, "pattern")) == {("/x/S1_*.html",), ("/x/S1*",), ("/x/S?_L1.*",), ("/x/S[0-2]_L?.html",), ("/y/*",)}


def test_glob_match_on_pieces_between_wildcards(spark, rows):
    names = [f"{'xyz'[i % 3]}_S{i}_{'ab'[i % 2]}.out" for i in range(400)] + ["a]b", "[x.t", "aXbXa"]
    globs = [f"*_S{i}_*.out" for i in range(390, 410)] + ["*_S7_?.out", "?_S8*b*", "*[0-3]_a*t", "*S1*S1*", "a]?", "[x*", "*X*X*", "*a*a", "**", "?", "*aXbXaX*"]
    patterns = spark.createDataFrame([(f"/d/{g}",) for g in globs], "pattern string")
    got = acc.glob_match(patterns, spark.createDataFrame([(f"/d/{n}", 1) for n in names], schemas.ARTIFACTS))
    # an unclosed bracket is a literal for both
    assert set(rows(got)) == {(f"/d/{g}",) for g in globs if any(fnmatch.fnmatchcase(n, g) for n in names)}


@pytest.mark.parametrize("n,ellipsis,expected", [(3, True, "c, a, b..."), (3, False, "c, a, b"), (9, True, "c, a, b, e, d")])
def test_missing_preview(spark, n, ellipsis, expected):
    data = [("k", order, name) for order, name in enumerate("cabed")]
    df = spark.createDataFrame(data, "key string, sample_ord bigint, sample_id string").repartition(3)
    row = acc.missing_preview(df, ["key"], n=n, ellipsis=ellipsis).first()
    assert (row.missing_count, row.preview) == (5, expected)


def test_allowed_failures(spark, rows):
    runs = spark.createDataFrame(
        [("r1", ["X", " "], "NEG, a,,b"), ("r2", None, None), ("r3", ["a"], "a")], "run_id string, conf array<string>, skip string"
    )
    assert rows(acc.allowed_failures(runs, "conf", "skip")) == [("r1", "NEG"), ("r1", "X"), ("r1", "a"), ("r1", "b"), ("r3", "a")]


def test_status_order(spark):
    cases = [
        # exists, forced, missing, exit, allowed, raised
        (True, False, True, 1, False, True, "skipped"), (True, True, True, 1, False, True, "skipped_missing_input"),
        (False, False, False, 0, False, True, "failed"), (False, False, False, None, True, True, "failed"),
        (False, False, False, 0, True, False, "completed"), (False, False, False, 1, True, False, "allowed_failure"),
        (False, False, False, 1, False, False, "failed"),
    ]
    df = spark.createDataFrame(cases, "a boolean, b boolean, c boolean, d int, e boolean, f boolean, expected string")
    got = df.select("expected", acc.classify_status(*[F.col(c) for c in "abcdef"]).alias("got")).collect()
    assert all(r.got == r.expected for r in got)


def _tasks(spark):
    t0 = dt.datetime(2025, 1, 15, 14, 23, 10)

    def task(sample, seconds, status, kb, user, sys, wall, runtime):
        return ("r1", "fastqc", "per_sample", sample, t0 + dt.timedelta(seconds=seconds), "x", status, 0, runtime, kb, user, sys, wall)

    return spark.createDataFrame([
        task("failed_ctrl", 18, "completed", 1048576.0, 12.5, 2.5, 10.0, 18.0), task("S2", 30, "completed", 524288.0, 5.0, 0.0, 10.0, 29.0),
        task("S3", 31, "completed", 0.0, 5.0, 0.0, 10.0, 1.0), task("S4", 5, "failed", 9e9, 5.0, 0.0, 0.1, 1.0),
        task("S5", 5, "skipped", 9e9, 5.0, 0.0, 0.1, None), task("S6", 5, "allowed_failure", 9e9, 5.0, 0.0, 0.1, 1.0),
        ("r1", "idle", "per_sample", "S1", t0, "x", "failed", 1, 1.0, 5.0, 1.0, 1.0, 1.0),
    ], schemas.TASK_RUNS)


def test_resource_usage_and_totals(spark):
    (row,) = acc.resource_usage(_tasks(spark)).collect()
    assert (row.tool, row.n_ran, row.mean_memory_gb, row.max_memory_gb, row.mean_cpu_cores, row.max_cpu_cores) == (
        "fastqc", 2, 0.75, 1.0, 1.0, 1.5
    )
    assert row.runtime_seconds == 31.0
    totals = {r.tool: r for r in acc.run_totals(_tasks(spark)).collect()}["fastqc"]
    assert (totals.n_completed, totals.n_failed, totals.n_skipped, totals.n_allowed_failure, totals.runtime_s) == (3, 1, 1, 1, 50.0)


@pytest.mark.parametrize("cores,memory,max_memory,max_cores,expected", [
    (192, 1007.4, 0.103, 9.8, (15, "cpu", 15, 19)), (192, 1007.4, 0.63, 1.13, (135, "cpu", 135, 169)),
    (8, 16.0, 4.0, 1.0, (3, "memory", 6, 8)), (2, 100.0, 1.0, 4.0, (0, "cpu", 0, 0)),
    (None, 16.0, 4.0, 1.0, (None, None, None, None)), (8, None, 4.0, 1.0, (None, None, None, None)),
    (8, 16.0, 4.0, 0.0, (None, None, None, None)),
])
def test_capacity(spark, cores, memory, max_memory, max_cores, expected):
    usage = spark.createDataFrame([("r", "t", max_memory, max_cores)], "run_id string, tool string, max_memory_gb double, max_cpu_cores double")
    hosts = spark.createDataFrame([("r", cores, 4, memory)], schemas.HOSTS)
    row = acc.capacity_plan(usage, hosts).first()
    assert (row.suggested_threads, row.bottleneck, row.cpu_t_recommended, row.cpu_t_limit) == expected
    if expected[0]:
        assert row.mem_total_percent == round(expected[0] * max_memory / memory * 100, 1)
        assert row.cpu_total_percent == round(expected[0] * max_cores / cores * 100, 1)


def test_resource_log_appends(spark, tmp_path):
    hosts = spark.createDataFrame([("r1", None, None, 16.0)], schemas.HOSTS)
    tools = spark.createDataFrame([(1, "fastqc", "per_sample", 20, None, None, None, None)], schemas.TOOLS)
    rows = resource_log(_tasks(spark), hosts, tools, "2025-01-15 14:23:45")
    assert rows.columns == ["run_id", *schemas.RESOURCE_USAGE.names]
    for _ in range(2):
        append_resource_usage(rows, f"{tmp_path}/log")
    got = spark.read.parquet(f"{tmp_path}/log").collect()
    assert len(got) == 2 and got[0].parallel == 20 and got[0].suggested_threads is None and got[0].bottleneck is None


def test_versions(spark, tmp_path, rows):
    t = dt.datetime(2025, 1, 15, 14, 23, 10)
    tools = spark.createDataFrame(
        [(1, "trim", None, None, None, None, None, [("gzip", "1.13", "/bin/gzip", None)]), (2, "qc", None, None, None, None, None, None)],
        schemas.TOOLS,
    )

    def captured(when, version):
        return spark.createDataFrame(
            [("r1", when, tool, version, f"/bin/{tool}", None) for tool in ("trim", "qc")],
            "run_id string, ts timestamp, tool string, version string, path string, database string",
        )

    for when, version in ((t, "1"), (t + dt.timedelta(hours=1), "2")):
        append_versions(acc.sub_tool_versions(tools, captured(when, version)), f"{tmp_path}/versions")
    log = spark.read.schema(schemas.VERSIONS).parquet(f"{tmp_path}/versions")
    assert rows(versions_as_text(log), "timestamp", "tool", "version", "database")[:3] == [
        ("2025-01-15 14:23:10", "qc", "1", "none"), ("2025-01-15 14:23:10", "trim", "1", "none"),
        ("2025-01-15 14:23:10", "trim:gzip", "1.13", "none"),
    ]
    newest = {(r.tool, r.sub_tool): r.version for r in acc.latest_versions(log).collect()}
    assert newest == {("trim", None): "2", ("qc", None): "2", ("trim", "gzip"): "1.13"}


def test_samples_are_not_gathered_by_run(spark):
    """The settings of counted, few runs come to the samples, whatever the size estimates say."""
    samples = spark.range(1000).selectExpr("concat('r', id % 2) AS run_id", "id AS sample_ord", "CAST(id AS STRING) AS sample_id")
    tools = spark.createDataFrame([(1, "trim", "per_sample", 2, "{rundir}/{sample_id}.fq", None, ["{input_dir}/{sample_id}.raw"], None)], schemas.TOOLS)
    runs = spark.createDataFrame([(r, "/run", "/in", "/scripts") for r in ("r0", "r1")], "run_id string, rundir string, input_dir string, script_dir string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        manifest = acc.expected_manifest(samples, tools, runs)
        plan = manifest._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert manifest.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
