"""Driver tables shaped as lab tables: each Spark frame and the SQL that builds the same rows."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise import schemas
from platewise.session import spread_if_few


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_of(key: str) -> Column:
    return F.concat(F.lit("run"), (F.col(key) % 8).cast("string"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        run_of("c_custkey").alias("run_id"), F.col("c_custkey").alias("sample_ord"),
        F.col("c_custkey").cast("string").alias("sample_id"),
    )


SAMPLES = """samples AS (
  SELECT 'run' || (c_custkey % 8) AS run_id, c_custkey AS sample_ord, CAST(c_custkey AS VARCHAR) AS sample_id
  FROM customer)"""


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return load(spark, sf_dir, "orders").select(
        run_of("o_custkey").alias("run_id"),
        F.col("o_custkey").cast("string").alias("sample_id"),
        F.col("o_orderkey").alias("line_no"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("percentage"),
        F.col("o_orderkey").cast("string").alias("count_clade"),
        F.col("o_custkey").cast("string").alias("count_taxon"),
        F.when(status == "F", "G").when(status == "O", "S").otherwise("U").alias("rank_code"),
        (F.col("o_orderkey") % 1000).cast("string").alias("taxid"),
        F.concat(F.lit("   "), "o_orderpriority").alias("name"),
    )


REPORT_LINES = """report_lines AS (
  SELECT 'run' || (o_custkey % 8) AS run_id, CAST(o_custkey AS VARCHAR) AS sample_id, o_orderkey AS line_no,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS percentage,
    CAST(o_orderkey AS VARCHAR) AS count_clade, CAST(o_custkey AS VARCHAR) AS count_taxon,
    CASE o_orderstatus WHEN 'F' THEN 'G' WHEN 'O' THEN 'S' ELSE 'U' END AS rank_code,
    CAST(o_orderkey % 1000 AS VARCHAR) AS taxid, o_orderpriority AS name
  FROM orders)"""


def kraken_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, turn = F.col("o_orderstatus"), F.col("o_orderkey") % 3
    suffix = F.when(turn == 0, ".kraken").when(turn == 1, "").otherwise("_processed")
    return load(spark, sf_dir, "orders").select(
        run_of("o_custkey").alias("run_id"),
        F.concat(F.col("o_custkey").cast("string"), suffix).alias("metric_key"),
        F.col("o_orderkey").alias("pos"),
        F.when(status == "F", "G").when(status == "O", "S").otherwise("U").alias("rank_code"),
        (F.col("o_totalprice") / 1000).alias("percent"),
        F.col("o_orderpriority").alias("classif"),
    )


KRAKEN_HITS = """kraken_hits AS (
  SELECT 'run' || (o_custkey % 8) AS run_id, CAST(o_custkey AS VARCHAR) AS base_id,
    CAST(o_custkey AS VARCHAR)
      || CASE o_orderkey % 3 WHEN 0 THEN '.kraken' WHEN 1 THEN '' ELSE '_processed' END AS metric_key,
    o_orderkey % 3 AS priority, o_orderkey AS pos,
    CASE o_orderstatus WHEN 'F' THEN 'G' WHEN 'O' THEN 'S' ELSE 'U' END AS rank_code,
    o_totalprice / 1000 AS percent, o_orderpriority AS classif
  FROM orders)"""


def event_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


EVENT_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def fastqc_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    mate = (F.col("event_id") % 2 + 1).cast("string")
    verdict = event_k() % 3
    return load(spark, sf_dir, "events").select(
        run_of("user_id").alias("run_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("_processed_R"), mate).alias("metric_key"),
        F.when(F.col("event_type") == "view", "per_base_sequence_content").otherwise(F.col("event_type")).alias("module"),
        F.when(verdict == 0, "pass").when(verdict == 1, "warn").otherwise("fail").alias("status"),
    )


FASTQC_FAILS = f"""fails AS (
  SELECT run_id, base_id, string_agg(module, '; ' ORDER BY module) AS fastqc_fails
  FROM (SELECT DISTINCT 'run' || (user_id % 8) AS run_id, CAST(user_id AS VARCHAR) AS base_id, event_type AS module
        FROM events WHERE event_type <> 'view' AND {EVENT_K} % 3 = 2) GROUP BY ALL)"""


def task_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as task outcomes, before the status is decided."""
    k = event_k()
    return load(spark, sf_dir, "events").select(
        "event_id",
        run_of("user_id").alias("run_id"),
        F.col("event_type").alias("tool"),
        F.lit("per_sample").alias("execution_mode"),
        F.col("user_id").cast("string").alias("sample_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        k.alias("k"),
        F.when(k % 5 == 0, 1).otherwise(0).alias("exit_code"),
        (k + 1).cast("double").alias("runtime_s"),
        (F.col("value") * 1024 * 1024).alias("max_rss_kb"),
        F.col("value").alias("user_s"),
        F.lit(0.5).alias("sys_s"),
        (k + 1).cast("double").alias("wall_s"),
    )


def allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").where("c_acctbal < 0").select(
        run_of("c_custkey").alias("run_id"), F.col("c_custkey").cast("string").alias("sample_id")
    )


def status_of(rows: DataFrame) -> Column:
    from platewise.operators.accounting import classify_status

    k, tool = F.col("k"), F.col("tool")
    return classify_status(
        output_exists=(tool == "view") & (k < 50), forced=k % 10 == 0,
        input_missing=(tool == "click") & (k < 10), exit_code=F.col("exit_code"),
        allowed=F.col("allowed"), raised=k == 99,
    )


def task_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from platewise.operators.accounting import is_allowed_failure

    rows = is_allowed_failure(task_events(spark, sf_dir), allowed(spark, sf_dir))
    return rows.withColumn("status", status_of(rows))


TASK_RUNS = f"""raw_tasks AS (
  SELECT event_id, 'run' || (user_id % 8) AS run_id, event_type AS tool, user_id, ts, value, {EVENT_K} AS k FROM events),
task_runs AS (
  SELECT t.*, CAST(t.user_id AS VARCHAR) AS sample_id, CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS exit_code,
    CAST(k + 1 AS DOUBLE) AS runtime_s,
    CASE WHEN tool = 'view' AND k < 50 AND k % 10 <> 0 THEN 'skipped'
         WHEN tool = 'click' AND k < 10 THEN 'skipped_missing_input'
         WHEN k = 99 THEN 'failed' WHEN k % 5 <> 0 THEN 'completed'
         WHEN EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = t.user_id AND c.c_acctbal < 0) THEN 'allowed_failure'
         ELSE 'failed' END AS status
  FROM raw_tasks t)"""


TOOLS_ROWS = [
    (1, "F", "per_sample", 10, "{rundir}/{tool}/{sample_id}.out", "{rundir}/{tool}/summary.tsv", ["{input_dir}/{sample_id}.in"], []),
    (2, "O", "per_sample", 4, "{rundir}/{tool}/{sample_id}*.out", None, ["{rundir}/F/{sample_id}.out"], []),
    (3, "P", "per_sample", 4, "{rundir}/{tool}/{sample_id}.out", None, ["{rundir}/F/{sample_id}.out"], []),
    (4, "report", "batch", None, None, "{rundir}/report.html", ["{rundir}/F/summary.tsv"], []),
]
DEPS_ROWS = [(1, "O", "F"), (2, "P", "F"), (3, "P", "O"), (4, "P", "unknown"), (5, "report", "P"), (6, "report", "report")]


def tools(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TOOLS_ROWS, schemas.TOOLS)


def tool_deps(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEPS_ROWS, schemas.TOOL_DEPS)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = load(spark, sf_dir, "customer").select(run_of("c_custkey").alias("run_id")).distinct()
    return ids.select(
        "run_id", F.concat(F.lit("/data/"), "run_id").alias("rundir"),
        F.concat(F.lit("/in/"), "run_id").alias("input_dir"), F.lit("/scripts").alias("script_dir"),
    )


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One output per (customer, status) with an order, plus the batch outputs of some runs."""
    mark = F.when(F.col("o_orderstatus") == "O", "_x").otherwise("")
    outputs = load(spark, sf_dir, "orders").select(
        F.concat(
            F.lit("/data/"), run_of("o_custkey"), F.lit("/"), "o_orderstatus", F.lit("/"),
            F.col("o_custkey").cast("string"), mark, F.lit(".out"),
        ).alias("path"),
        F.lit(1).cast("bigint").alias("length"),
    )
    batch = load(spark, sf_dir, "region").select(
        F.concat(F.lit("/data/run"), F.col("r_regionkey").cast("string"), F.lit("/F/summary.tsv")).alias("path"),
        F.lit(1).cast("bigint").alias("length"),
    )
    return outputs.unionByName(batch)


# tool O's pattern '<id>*.out' matches the outputs of every sample whose id starts with the same digits
MANIFEST = f"""{SAMPLES},
runs AS (SELECT DISTINCT run_id FROM samples),
artifacts AS (
  SELECT DISTINCT '/data/run' || (o_custkey % 8) || '/' || o_orderstatus || '/' || o_custkey
    || CASE o_orderstatus WHEN 'O' THEN '_x' ELSE '' END || '.out' AS path FROM orders
  UNION SELECT '/data/run' || r_regionkey || '/F/summary.tsv' FROM region),
manifest AS (
  SELECT run_id, t.ord AS tool_ord, t.tool, t.mode AS execution_mode, sample_ord, sample_id,
    '/data/' || run_id || '/' || t.tool || '/' || sample_id || CASE t.tool WHEN 'O' THEN '*' ELSE '' END || '.out' AS path
  FROM samples, (VALUES (1, 'F', 'per_sample'), (2, 'O', 'per_sample'), (3, 'P', 'per_sample')) t(ord, tool, mode)
  UNION ALL SELECT run_id, 1, 'F', 'per_sample', NULL, NULL, '/data/' || run_id || '/F/summary.tsv' FROM runs
  UNION ALL SELECT run_id, 4, 'report', 'batch', NULL, NULL, '/data/' || run_id || '/report.html' FROM runs),
present AS (
  SELECT m.* FROM manifest m WHERE m.path IN (SELECT path FROM artifacts)
  UNION ALL
  SELECT m.* FROM manifest m WHERE m.tool = 'O' AND EXISTS (
    SELECT 1 FROM orders o WHERE o.o_orderstatus = 'O' AND 'run' || (o.o_custkey % 8) = m.run_id
      AND substr(CAST(o.o_custkey AS VARCHAR), 1, length(m.sample_id)) = m.sample_id)),
pending AS (
  SELECT m.* FROM manifest m LEFT JOIN present p ON p.path = m.path WHERE p.path IS NULL)"""

# Scores of the quality symbols given to text: line ends very low, then stops, blanks, digits, letters.
PRINTABLE = "".join(chr(c) for c in range(32, 127))
_BASE_SCORES = {"|": 2, "~": 25, ".": 8, ",": 9, " ": 18}


def _quality_symbols(shift: int) -> str:
    out = []
    for char in PRINTABLE:
        if char in _BASE_SCORES:
            score = max(2, _BASE_SCORES[char] - shift)
        elif char in string.ascii_letters:
            score = 22 + ord(char) % 19
        else:
            score = 13
        out.append(chr(33 + score))
    return "".join(out)


QUALITY_1, QUALITY_2 = _quality_symbols(0), _quality_symbols(5)


def _quality(text: Column, symbols: str) -> Column:
    plain = F.regexp_replace(F.regexp_replace(text, "[\\n\\r\\t]", "|"), "[^ -~]", "~")
    return F.translate(plain, PRINTABLE, symbols)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_if_few(load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), "doc_id")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read pairs: the source is the sample, the whole text the first mate, its complement the second."""
    text = F.col("text")
    return documents(spark, sf_dir).select(
        run_of("doc_id").alias("run_id"), F.col("source").alias("sample_id"), F.col("lang").alias("lane"),
        F.col("doc_id").cast("string").alias("read_id"),
        text.alias("seq1"), _quality(text, QUALITY_1).alias("qual1"),
        F.translate(text, "ACGTacgt", "TGCAtgca").alias("seq2"), _quality(text, QUALITY_2).alias("qual2"),
    )


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_quality(symbols: str) -> str:
    plain = "regexp_replace(regexp_replace(text, '[\\n\\r\\t]', '|', 'g'), '[^ -~]', '~', 'g')"
    return f"translate({plain}, {sql_text(PRINTABLE)}, {sql_text(symbols)})"


READS = f"""reads AS (
  SELECT 'run' || (doc_id % 8) AS run_id, source AS sample_id, lang AS lane, CAST(doc_id AS VARCHAR) AS read_id,
    text AS seq1, {_sql_quality(QUALITY_1)} AS qual1,
    translate(text, 'ACGTacgt', 'TGCAtgca') AS seq2, {_sql_quality(QUALITY_2)} AS qual2
  FROM documents),
mates AS (
  SELECT run_id, sample_id, read_id, 'R1' AS mate, seq1 AS seq, qual1 AS qual FROM reads
  UNION ALL SELECT run_id, sample_id, read_id, 'R2', seq2, qual2 FROM reads)"""
