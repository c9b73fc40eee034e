"""q07 to q17, q26 to q28, q31 to q33, q35, q43, q45: run accounting, logs, hooks and streaming."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.catalog import query
from platewise.catalog import standins as st
from platewise.functions.numeric import round_binary_half_even
from platewise.functions.text import base_name, expand_template, format_runtime, parent_dir
from platewise.operators import accounting as acc
from platewise.operators import hooks
from platewise.operators.reads import metric_matrix
from platewise.session import checkpointed, shared_path, spread_if_few
from platewise.sources.text import parse_resource_reports, read_status_log
from platewise.streaming.progress import read_progress, stream_progress, write_progress


def _manifest(spark, sf_dir):
    return acc.expected_manifest(st.samples(spark, sf_dir), st.tools(spark), st.runs(spark, sf_dir))


@query("q07_pending", f"WITH {st.MANIFEST} SELECT * FROM pending")
def q07(spark, sf_dir):
    return acc.pending_outputs(_manifest(spark, sf_dir), st.artifacts(spark, sf_dir))


@query("q08_existing", f"WITH {st.MANIFEST} SELECT * FROM present")
def q08(spark, sf_dir):
    return acc.existing_outputs(_manifest(spark, sf_dir), st.artifacts(spark, sf_dir))


@query("q07b_manifest", f"WITH {st.MANIFEST} SELECT * FROM manifest")
def q07b(spark, sf_dir):
    return _manifest(spark, sf_dir)


@query("q49_template_values", f"""WITH {st.MANIFEST}
SELECT m.run_id, tool, sample_id, CASE WHEN path IS NOT NULL AND sample_id IS NULL AND tool = 'report' THEN '/data/' || m.run_id || '/report.html'
  WHEN sample_id IS NULL THEN '/data/' || m.run_id || '/F/summary.tsv'
  ELSE '/data/' || m.run_id || '/out/' || tool || '/' || sample_id || '.v' || right(m.run_id, 1) || '.x' END AS path
FROM manifest m""")
def q49(spark, sf_dir):
    text = "map<string,string>"
    values = F.create_map(F.lit("sample_output_dir"), F.lit("{rundir}/{folder}/{tool}"), F.lit("tool"), F.lit("not used"))
    tools = st.tools(spark).withColumn("tool_values", F.when(F.col("sample_output_pattern").isNotNull(), values).cast(text)).withColumn(
        "sample_output_pattern", F.when(F.col("sample_output_pattern").isNotNull(), F.lit("{sample_output_dir}/{sample_id}.v{version}.x"))
    )
    settings = F.create_map(F.lit("folder"), F.lit("out"), F.lit("version"), F.right("run_id", F.lit(1)))
    runs = st.runs(spark, sf_dir).withColumn("settings", settings.cast(text))
    return acc.expected_manifest(st.samples(spark, sf_dir), tools, runs).select("run_id", "tool", "sample_id", "path")


@query("q09_glob_match", r"""WITH files AS (
  SELECT regexp_extract(url, '(?s)^(.*)/[^/]*$', 1) AS dir, regexp_extract(url, '[^/]*$') AS name FROM pages),
patterns AS (
  SELECT dir, substr(name, 1, 1) || '*' AS name FROM files
  UNION SELECT dir, '*' || right(name, 1) FROM files UNION SELECT dir, '??' FROM files
  UNION SELECT dir, substr(name, 1, 1) || '*[0-4]' FROM files
  UNION SELECT dir, '*' || substr(name, 2, 3) || '?*' FROM files UNION SELECT dir, '*a?*' || substr(name, 3, 2) || '*' FROM files)
SELECT dir || '/' || name AS pattern FROM patterns p
WHERE EXISTS (SELECT 1 FROM files f WHERE f.dir = p.dir AND f.name GLOB p.name)""")
def q09(spark, sf_dir):
    url = F.col("url")
    name, parent = base_name(url), parent_dir(url)
    first, last = F.substr(name, F.lit(1), F.lit(1)), F.right(name, F.lit(1))
    globs = F.array(
        F.concat(first, F.lit("*")), F.concat(F.lit("*"), last), F.lit("??"), F.concat(first, F.lit("*[0-4]")),
        F.concat(F.lit("*"), F.substr(name, F.lit(2), F.lit(3)), F.lit("?*")), F.concat(F.lit("*a?*"), F.substr(name, F.lit(3), F.lit(2)), F.lit("*")),
    )
    pages = st.load(spark, sf_dir, "pages")
    patterns = pages.select(parent.alias("dir"), F.explode(globs).alias("name")).select(
        F.concat("dir", F.lit("/"), "name").alias("pattern")
    )
    return acc.glob_match(patterns, pages.select(url.alias("path")))


@query("q10_stage_readiness", f"""WITH {st.MANIFEST},
blocking AS (
  SELECT p.* FROM pending p WHERE p.sample_id IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM customer c WHERE c.c_custkey = p.sample_ord AND c.c_acctbal < 0)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run_id, tool ORDER BY sample_ord) AS rn FROM blocking),
per_tool AS (
  SELECT run_id, tool, count(*) AS n, string_agg(sample_id, ', ' ORDER BY rn) FILTER (rn <= 3) AS names, arg_min(path, rn) AS example
  FROM ranked GROUP BY ALL),
edges AS (SELECT * FROM (VALUES (1, 'O', 'F'), (2, 'P', 'F'), (3, 'P', 'O'), (5, 'report', 'P'), (6, 'report', 'report')) e(ord, tool, dep)),
detail AS (
  SELECT r.run_id, e.tool, e.ord, s.n,
    s.tool || ' outputs missing for ' || s.n || ' samples: ' || s.names || CASE WHEN s.n > 3 THEN '...' ELSE '' END
      || ' (expected path: ' || s.example || ')' AS sample_text,
    b.tool || ' final output missing: ' || b.path AS output_text
  FROM runs r CROSS JOIN edges e LEFT JOIN per_tool s ON s.run_id = r.run_id AND s.tool = e.dep
  LEFT JOIN pending b ON b.run_id = r.run_id AND b.tool = e.dep AND b.sample_id IS NULL)
SELECT run_id, tool, CAST(coalesce(sum(n), 0) AS BIGINT) AS missing_samples, count(output_text) AS missing_outputs,
  coalesce(string_agg(concat_ws(chr(10), sample_text, output_text), chr(10) ORDER BY ord)
    FILTER (sample_text IS NOT NULL OR output_text IS NOT NULL), '') AS details,
  coalesce(sum(n), 0) = 0 AND count(output_text) = 0 AS ready
FROM detail GROUP BY run_id, tool""")
def q10(spark, sf_dir):
    return acc.stage_readiness(
        st.tool_deps(spark), st.tools(spark), st.runs(spark, sf_dir), _manifest(spark, sf_dir),
        st.artifacts(spark, sf_dir), st.allowed(spark, sf_dir),
    )


@query("q11_missing_preview", f"""WITH {st.MANIFEST},
ranked AS (SELECT *, row_number() OVER (PARTITION BY run_id, tool ORDER BY sample_ord) AS rn FROM pending WHERE sample_id IS NOT NULL)
SELECT run_id, tool, count(*) AS missing_count,
  string_agg(sample_id, ', ' ORDER BY rn) FILTER (rn <= 5) || CASE WHEN count(*) > 5 THEN '...' ELSE '' END AS preview
FROM ranked GROUP BY ALL""")
def q11(spark, sf_dir):
    pending = checkpointed(q07(spark, sf_dir).where(F.col("sample_id").isNotNull()))
    return acc.missing_preview(pending, ["run_id", "tool"])


@query("q43_required_inputs", f"""WITH {st.MANIFEST}
SELECT run_id, 'F' AS tool, sample_ord, sample_id, '/in/' || run_id || '/' || sample_id || '.in' AS path FROM samples
UNION ALL
SELECT run_id, t.tool, sample_ord, sample_id, '/data/' || run_id || '/F/' || sample_id || '.out'
FROM samples, (VALUES ('O'), ('P')) t(tool)
WHERE '/data/' || run_id || '/F/' || sample_id || '.out' NOT IN (SELECT path FROM artifacts)
UNION ALL
SELECT run_id, 'report', NULL, NULL, '/data/' || run_id || '/F/summary.tsv' FROM runs
WHERE '/data/' || run_id || '/F/summary.tsv' NOT IN (SELECT path FROM artifacts)""")
def q43(spark, sf_dir):
    return acc.required_inputs(
        st.samples(spark, sf_dir), st.tools(spark), st.runs(spark, sf_dir), st.artifacts(spark, sf_dir)
    )


USAGE_SQL = f"""{st.TASK_RUNS},
usage AS (
  SELECT run_id, tool, 'per_sample' AS execution_mode,
    count(*) FILTER (status = 'completed' AND value > 0) AS n_ran,
    CAST(sum(CAST(value AS DECIMAL(28,12))) FILTER (status = 'completed' AND value > 0) AS DOUBLE)
      / nullif(count(*) FILTER (status = 'completed' AND value > 0), 0) AS mean_memory_gb,
    max(value) FILTER (status = 'completed' AND value > 0) AS max_memory_gb,
    CAST(sum(CAST((value + 0.5) / (k + 1) AS DECIMAL(28,12))) FILTER (status = 'completed' AND value > 0) AS DOUBLE)
      / nullif(count(*) FILTER (status = 'completed' AND value > 0), 0) AS mean_cpu_cores,
    max((value + 0.5) / (k + 1)) FILTER (status = 'completed' AND value > 0) AS max_cpu_cores,
    max(epoch_us(ts) / 1e6) - min(epoch_us(ts) / 1e6 - runtime_s) AS runtime_seconds
  FROM task_runs GROUP BY ALL HAVING count(*) FILTER (status = 'completed' AND value > 0) > 0)"""


def _r(column: str, digits: int) -> str:
    return f"CAST(printf('%.{digits}f', {column}) AS DOUBLE) AS {column}"


ROUNDED = ", ".join(
    [_r("mean_memory_gb", 3), _r("max_memory_gb", 3), _r("mean_cpu_cores", 1), _r("max_cpu_cores", 1), _r("runtime_seconds", 1)]
)
DIGITS = {"mean_memory_gb": 3, "max_memory_gb": 3, "mean_cpu_cores": 1, "max_cpu_cores": 1, "runtime_seconds": 1}


def _rounded(df):
    return df.withColumns({c: round_binary_half_even(c, n) for c, n in DIGITS.items()})


@query("q12_resource_usage", f"WITH {USAGE_SQL} SELECT run_id, tool, execution_mode, n_ran, {ROUNDED} FROM usage")
def q12(spark, sf_dir):
    return _rounded(acc.resource_usage(st.task_runs(spark, sf_dir)))


@query("q13_capacity_plan", f"""WITH {USAGE_SQL},
hosts AS (SELECT 'run' || n_nationkey AS run_id, CASE n_nationkey WHEN 7 THEN NULL ELSE 64 * (n_nationkey + 1) END AS cores,
    512.0 * (n_nationkey + 1) AS memory FROM nation),
fit AS (
  SELECT u.*, CAST(trunc(memory * 0.8::DOUBLE / max_memory_gb) AS BIGINT) AS mr, CAST(trunc(memory / max_memory_gb) AS BIGINT) AS ml,
    CAST(trunc(cores * 0.8::DOUBLE / max_cpu_cores) AS BIGINT) AS cr, CAST(trunc(cores / max_cpu_cores) AS BIGINT) AS cl,
    cores, CAST(memory AS DOUBLE) AS memory, cores IS NOT NULL AND memory IS NOT NULL AS known
  FROM usage u LEFT JOIN hosts h ON h.run_id = u.run_id)
SELECT run_id, tool, execution_mode, n_ran, {ROUNDED},
  CASE WHEN known THEN mr END AS memory_t_recommended, CASE WHEN known THEN ml END AS memory_t_limit,
  CASE WHEN known THEN cr END AS cpu_t_recommended, CASE WHEN known THEN cl END AS cpu_t_limit,
  CASE WHEN known THEN least(mr, cr) END AS suggested_threads,
  CASE WHEN known AND mr < cr THEN 'memory' WHEN known THEN 'cpu' END AS bottleneck,
  CASE WHEN known THEN CAST(printf('%.1f', least(mr, cr) * max_memory_gb / memory * 100) AS DOUBLE) END AS mem_total_percent,
  CASE WHEN known THEN CAST(printf('%.1f', least(mr, cr) * max_cpu_cores / cores * 100) AS DOUBLE) END AS cpu_total_percent
FROM fit""")
def q13(spark, sf_dir):
    nation = st.load(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    hosts = nation.select(
        F.concat(F.lit("run"), key.cast("string")).alias("run_id"),
        F.when(key != 7, 64 * (key + 1)).alias("logical_cores"), F.lit(None).cast("int").alias("cpu_cores"),
        (F.lit(512.0) * (key + 1)).alias("memory_gb"),
    )
    return _rounded(acc.capacity_plan(acc.resource_usage(st.task_runs(spark, sf_dir)), hosts))


RUNTIME_TEXT = """CASE WHEN s < 60 THEN printf('%.1f', s) || ' seconds'
  WHEN s < 3600 THEN CAST(floor(s / 60) AS BIGINT) || 'm ' || printf('%.1f', s % 60) || 's'
  ELSE CAST(floor(s / 3600) AS BIGINT) || 'h ' || CAST(floor((s % 3600) / 60) AS BIGINT) || 'm ' || printf('%.1f', s % 60) || 's' END"""


@query("q14_runtime_text", f"""SELECT o_orderkey, {RUNTIME_TEXT} AS runtime, {RUNTIME_TEXT.replace('s <', 'z <').replace("', s", "', z").replace('(s', '(z')} AS short_runtime
FROM (SELECT o_orderkey, o_totalprice / 10 AS s, o_totalprice / 7000 AS z FROM orders)""")
def q14(spark, sf_dir):
    return st.load(spark, sf_dir, "orders").select(
        "o_orderkey", format_runtime("o_totalprice / 10").alias("runtime"),
        format_runtime("o_totalprice / 7000").alias("short_runtime"),
    )


@query("q15_task_status", f"WITH {st.TASK_RUNS} SELECT event_id, run_id, tool, sample_id, status FROM task_runs")
def q15(spark, sf_dir):
    return st.task_runs(spark, sf_dir).select("event_id", "run_id", "tool", "sample_id", "status")


@query("q16_run_totals", f"""WITH {st.TASK_RUNS}
SELECT run_id, tool, {", ".join(f"count(*) FILTER (status = '{s}') AS n_{s}" for s in acc.STATUSES)}, sum(runtime_s) AS runtime_s
FROM task_runs GROUP BY run_id, tool""")
def q16(spark, sf_dir):
    return acc.run_totals(st.task_runs(spark, sf_dir))


@query("q17_template_paths", """SELECT doc_id, replace(replace(replace(replace('{rundir}/{lang}/{source}/{sample_id}.{unknown}.txt',
  '{rundir}', '/data/' || (doc_id % 8)), '{lang}', lang), '{source}', source), '{sample_id}', CAST(doc_id AS VARCHAR)) AS path
FROM documents""")
def q17(spark, sf_dir):
    values = {
        "rundir": F.concat(F.lit("/data/"), (F.col("doc_id") % 8).cast("string")), "lang": F.col("lang"),
        "source": F.col("source"), "sample_id": F.col("doc_id"),
    }
    template = F.lit("{rundir}/{lang}/{source}/{sample_id}.{unknown}.txt")
    return st.load(spark, sf_dir, "documents").select("doc_id", expand_template(template, values).alias("path"))


@query("q17b_skip_list", """SELECT DISTINCT 'c' || c_custkey AS run_id, unnest([c_mktsegment, c_name, 'NEG']) AS sample_id FROM customer""")
def q17b(spark, sf_dir):
    runs = st.load(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("run_id"),
        F.array("c_mktsegment", F.lit(" ")).alias("configured"),
        F.concat(F.lit("NEG, "), "c_name", F.lit(" ,, "), "c_mktsegment").alias("skip"),
    )
    return acc.allowed_failures(runs, "configured", "skip")


@query("q26_header_only", """WITH lines AS (SELECT 'conv' || conv_id AS path, count(*) AS n FROM conversations GROUP BY 1),
files AS (SELECT path FROM lines UNION SELECT 'conv' || doc_id FROM labels)
SELECT f.path, coalesce(n, 0) AS n_lines, coalesce(n, 0) <= 1 AS header_only FROM files f LEFT JOIN lines l ON l.path = f.path""")
def q26(spark, sf_dir):
    def path(key):
        return F.concat(F.lit("conv"), F.col(key).cast("string")).alias("path")

    lines = st.load(spark, sf_dir, "conversations").select(path("conv_id"))
    files = lines.unionByName(st.load(spark, sf_dir, "labels").select(path("doc_id"))).distinct()
    return acc.is_empty_or_header_only(lines, files)


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("q27_metric_matrix", f"""SELECT 'run' || (user_id % 8) AS run_id, CAST(user_id AS VARCHAR) AS sample_id,
  {", ".join(f"max(value) FILTER (event_type = '{t}') AS {t}" for t in EVENT_TYPES)} FROM events GROUP BY user_id""")
def q27(spark, sf_dir):
    metrics = st.load(spark, sf_dir, "events").select(
        st.run_of("user_id").alias("run_id"), F.col("user_id").cast("string").alias("sample_id"),
        F.col("event_type").alias("metric"), "value",
    )
    return metric_matrix(metrics, EVENT_TYPES)


@query("q28_latest_versions", f"""SELECT run_id, tool, sub_tool, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, version, path, database FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, tool, sub_tool ORDER BY ts DESC, event_id DESC) AS rn FROM (
    SELECT event_id, 'run' || (user_id % 8) AS run_id, event_type AS tool, CASE WHEN {st.EVENT_K} % 2 = 0 THEN 'k' END AS sub_tool, ts,
      'v' || event_id AS version, '/bin/' || event_type AS path, 'none' AS database FROM events)) WHERE rn = 1""")
def q28(spark, sf_dir):
    log = st.load(spark, sf_dir, "events").select(
        "event_id", st.run_of("user_id").alias("run_id"), F.col("event_type").alias("tool"),
        F.when(st.event_k() % 2 == 0, "k").alias("sub_tool"), "ts",
        F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("version"),
        F.concat(F.lit("/bin/"), "event_type").alias("path"), F.lit("none").alias("database"),
    )
    newest = acc.latest_versions(log, tie_break=["event_id"])
    return newest.withColumn("timestamp", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).drop("ts")


@query("q31_elapsed_parse", f"""WITH e AS (
  SELECT event_id, value, (event_id % 3 * 60 + {st.EVENT_K}) * 60 + CAST(printf('%.2f', value % 60) AS DOUBLE) AS wall_s FROM events)
SELECT event_id, wall_s, value * 1000 AS max_rss_kb, value * 1000 / 1024 / 1024 AS peak_memory_gb, value AS user_s,
  0.25::DOUBLE AS sys_s, CASE WHEN wall_s > 0 THEN (value + 0.25::DOUBLE) / wall_s ELSE 0.0 END AS cpu_cores FROM e""")
def q31(spark, sf_dir):
    k, value, hours = st.event_k(), F.col("value"), F.col("event_id") % 3
    seconds = F.format_string("%05.2f", round_binary_half_even("value % 60", 2))
    clock = F.when(
        hours > 0, F.concat(hours.cast("string"), F.lit(":"), F.lpad(k.cast("string"), 2, "0"), F.lit(":"), seconds)
    ).otherwise(F.concat(k.cast("string"), F.lit(":"), seconds))
    report = F.array(
        F.concat(F.lit("\tUser time (seconds): "), value.cast("string")),
        F.lit("\tSystem time (seconds): 0.25"),
        F.concat(F.lit("\tElapsed (wall clock) time (h:mm:ss or m:ss): "), clock),
        F.concat(F.lit("\tMaximum resident set size (kbytes): "), (value * 1000).cast("string")),
        F.lit("\tExit status: 0"),
    )
    lines = st.load(spark, sf_dir, "events").select("event_id", F.explode(report).alias("value"))
    return parse_resource_reports(lines, ["event_id"])


@query("q32_status_log_parse", f"""WITH e AS (
  SELECT event_id, 'run' || (user_id % 8) AS run_id, 2 * (row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) - 1) AS line_no, CASE event_id % 4 WHEN 0 THEN 'failed_' ELSE 's' END || user_id AS sample_id, event_id % 7 AS form, {st.EVENT_K} AS k, value FROM events)
SELECT run_id, line_no, sample_id,
  ['skipped', 'missing_input', 'allowed_failure', 'failed', 'exception', 'completed', 'starting'][form + 1] AS event,
  ['skipped', 'skipped_missing_input', 'allowed_failure', 'failed', 'failed', 'completed', 'starting'][form + 1] AS status,
  CASE form WHEN 0 THEN '/out/' || event_id WHEN 1 THEN '/in/' || event_id WHEN 2 THEN CAST(k AS VARCHAR) WHEN 3 THEN CAST(k AS VARCHAR)
    WHEN 4 THEN 'boom: no (exit)' WHEN 5 THEN k || 'm ' || printf('%.1f', value % 60) || 's' ELSE 'Starting' END AS detail,
  CASE WHEN form IN (2, 3) THEN k WHEN form = 5 THEN 0 END AS exit_code,
  CASE WHEN form = 5 THEN k * 60 + CAST(printf('%.1f', value % 60) AS DOUBLE) END AS runtime_s
FROM e""")
def q32(spark, sf_dir):
    form, k, event = F.col("event_id") % 7, st.event_k().cast("string"), F.col("event_id").cast("string")
    sample = F.concat(F.when(F.col("event_id") % 4 == 0, "failed_").otherwise("s"), F.col("user_id").cast("string"))
    seconds = F.format_string("%.1f", round_binary_half_even("value % 60", 1))
    messages = [
        F.concat(F.lit("✅ "), sample, F.lit(" skipped (output exists: /out/"), event, F.lit(")")),
        F.concat(sample, F.lit(": ERROR: missing input file /in/"), event),
        F.concat(sample, F.lit(": Allowed failure (exit code "), k, F.lit(")")),
        F.concat(sample, F.lit(": Failed with exit code "), k),
        F.concat(sample, F.lit(": Failed - boom: no (exit)")),
        F.concat(sample, F.lit(": Completed (runtime: "), k, F.lit("m "), seconds, F.lit("s)")),
        F.concat(sample, F.lit(": Starting")),
    ]
    line = F.get(F.array(*messages), form)
    noise = F.concat(F.lit("=== Running "), "event_type")
    # one log per run, in the order of the events
    path = shared_path(spark, "logs")
    lines = st.load(spark, sf_dir, "events").select(st.run_of("user_id").alias("run_id"), "event_id", F.posexplode(F.array(line, noise)).alias("at", "value"))
    logs = lines.repartition("run_id").sortWithinPartitions("run_id", "event_id", "at").select("run_id", "value")
    logs.write.partitionBy("run_id").text(path)
    return read_status_log(spark, f"{path}/*/*.txt", run_pattern="run_id=([^/]+)/")


def _user_partial(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    cents = (rows["value"] * 100).round().astype("int64")
    return pd.DataFrame({
        "run_id": [key[0]], "sample_id": [key[1]], "n": [len(rows)], "cents": [int(cents.sum())],
        "top_value": [float(rows["value"].max())],
    })


@query("q33_per_sample_hook", """SELECT 'run' || (user_id % 8) AS run_id, CAST(user_id AS VARCHAR) AS sample_id, count(*) AS n,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, max(value) AS top_value FROM events GROUP BY user_id""")
def q33(spark, sf_dir):
    events = spread_if_few(st.load(spark, sf_dir, "events").select("user_id", "value"), "user_id")
    rows = events.select(
        st.run_of("user_id").alias("run_id"), F.col("user_id").cast("string").alias("sample_id"), "value"
    )
    return hooks.per_sample(
        rows, _user_partial, "run_id string, sample_id string, n bigint, cents bigint, top_value double",
        lambda parts: parts.groupBy("run_id", "sample_id").agg(
            F.sum("n").alias("n"), F.sum("cents").alias("cents"), F.max("top_value").alias("top_value")
        ),
    )


def _user_median(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The middle of a sample's values, which come sorted, and the first and last event of the sample."""
    cents, first, last = np.empty(0, np.int64), None, None
    for rows in parts:
        cents = np.append(cents, (rows["value"] * 100).round().astype("int64"))
        first, last = rows["event_id"].iloc[0] if first is None else first, rows["event_id"].iloc[-1]
    twice = int(cents[(len(cents) - 1) // 2] + cents[len(cents) // 2])
    yield pd.DataFrame({"run_id": [key[0]], "sample_id": [key[1]], "n": [len(cents)], "twice_median": [twice], "least_event": [first], "most_event": [last]})


@query("q33c_sample_median", """WITH e AS (
  SELECT 'run' || (user_id % 8) AS run_id, CAST(user_id AS VARCHAR) AS sample_id, event_id, CAST(round(value * 100) AS BIGINT) AS cents, value FROM events),
r AS (
  SELECT *, row_number() OVER (PARTITION BY run_id, sample_id ORDER BY value, event_id) AS k, count(*) OVER (PARTITION BY run_id, sample_id) AS n FROM e)
SELECT run_id, sample_id, n, CAST(sum(cents * (CASE WHEN k = (n + 1) // 2 THEN 1 ELSE 0 END + CASE WHEN k = n // 2 + 1 THEN 1 ELSE 0 END)) AS BIGINT) AS twice_median,
  max(CASE WHEN k = 1 THEN event_id END) AS least_event, max(CASE WHEN k = n THEN event_id END) AS most_event FROM r GROUP BY ALL""")
def q33c(spark, sf_dir):
    """A function without a partial form: medians, from all rows of each sample in the order of their values."""
    rows = st.load(spark, sf_dir, "events").select(
        st.run_of("user_id").alias("run_id"), F.col("user_id").cast("string").alias("sample_id"), "event_id", "value")
    schema = "run_id string, sample_id string, n bigint, twice_median bigint, least_event bigint, most_event bigint"
    return hooks.each_sample(rows, _user_median, schema, order=["value", "event_id"])


@query("q33b_batch_hook", "SELECT event_type AS tool, count(*) AS n, max(value) AS top_value FROM events GROUP BY 1")
def q33b(spark, sf_dir):
    return hooks.batch(
        st.load(spark, sf_dir, "events"),
        lambda df: df.groupBy(F.col("event_type").alias("tool")).agg(F.count("*").alias("n"), F.max("value").alias("top_value")),
    )


@query("q35_stream_progress", f"""SELECT 'run' || (user_id % 8) AS run_id, event_type AS tool,
  CASE WHEN {st.EVENT_K} % 5 = 0 THEN 'failed' ELSE 'completed' END AS status, count(*) AS n FROM events GROUP BY ALL""")
def q35(spark, sf_dir):
    schema = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("props", T.StringType()),
    ])
    arriving = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), st.run_of("user_id").alias("run_id"),
        F.col("event_type").alias("tool"),
        F.when(st.event_k() % 5 == 0, "failed").otherwise("completed").alias("status"),
    )
    out = shared_path(spark, "progress")
    write_progress(stream_progress(arriving, ["event_id"]), out, shared_path(spark, "progress-state"))
    return read_progress(spark, out)
