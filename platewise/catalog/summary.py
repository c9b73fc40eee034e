"""q01 to q06, q34, q44: sample sheet, report picks and the QC summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from platewise.catalog import query
from platewise.catalog import standins as st
from platewise.functions.numeric import round_binary_half_even
from platewise.operators import taxa
from platewise.operators.summary import fastqc_fails
from platewise.plans.qc_summary import qc_summary
from platewise.plans.species_calls import species_calls
from platewise.session import broadcast_if_small, shared_path
from platewise.sources.multiqc import read_multiqc_json
from platewise.sources.text import samples_from_table


def _round(sql: str, digits: int) -> str:
    return f"CAST(printf('%.{digits}f', {sql}) AS DOUBLE)"


@query("q01_sample_sheet", f"WITH {st.SAMPLES} SELECT * FROM samples")
def q01(spark, sf_dir):
    rows = st.load(spark, sf_dir, "customer")
    return samples_from_table(rows, st.run_of("c_custkey"), F.col("c_custkey"), F.col("c_custkey"))


@query("q02_top_hits", f"""WITH {st.REPORT_LINES}, r AS (
  SELECT *, row_number() OVER (PARTITION BY run_id, sample_id, rank_code ORDER BY line_no) AS rn FROM report_lines)
SELECT run_id, sample_id, CAST(CASE rank_code WHEN 'G' THEN 0 WHEN 'S' THEN 3 ELSE 6 END + rn AS INTEGER) AS hit_ord,
  percentage AS "Percentage", count_clade AS "Count_Clade", count_taxon AS "Count_Taxon",
  CASE rank_code WHEN 'G' THEN 'Genus' WHEN 'S' THEN 'Species' ELSE 'Unclassified' END AS "TaxRank",
  taxid AS "TaxID", name AS "Organism"
FROM r WHERE rn <= CASE rank_code WHEN 'U' THEN 1 ELSE 3 END""")
def q02(spark, sf_dir):
    return taxa.top_hits(st.report_lines(spark, sf_dir))


RENAME_ROWS = [(1, "Brand#7", "Brand#9"), (2, "Brand#7", "Brand#8"), (3, "Brand#26", "Brand#25")]


@query("q03_species_calls", """WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'Brand#' || (l_partkey % 27) AS name FROM lineitem
  WHERE l_returnflag = 'R'),
first AS (
  SELECT l_orderkey, name, l_partkey FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lines)
  WHERE rn = 1),
named AS (
  SELECT l_orderkey, CASE name WHEN 'Brand#7' THEN 'Brand#8' WHEN 'Brand#26' THEN 'Brand#25' ELSE name END AS species,
    CAST(l_partkey AS VARCHAR) AS taxid FROM first),
sizes AS (SELECT p_brand, arg_min(p_size, p_partkey) AS size FROM part GROUP BY p_brand)
SELECT 'run' || (o_orderkey % 8) AS run_id, CAST(o_orderkey AS VARCHAR) AS sample_id,
  coalesce(species, 'Unknown') AS top_species, coalesce(taxid, 'NA') AS taxid,
  coalesce(CAST(size AS VARCHAR), 'NA') AS expected_genome_size
FROM orders LEFT JOIN named ON o_orderkey = l_orderkey LEFT JOIN sizes ON species = p_brand""")
def q03(spark, sf_dir):
    flag = F.col("l_returnflag")
    lines = st.load(spark, sf_dir, "lineitem").select(
        st.run_of("l_orderkey").alias("run_id"), F.col("l_orderkey").cast("string").alias("sample_id"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("line_no"),
        F.when(flag == "R", "S").when(flag == "A", "G").otherwise("U").alias("rank_code"),
        F.col("l_partkey").cast("string").alias("taxid"),
        F.concat(F.lit("  Brand#"), (F.col("l_partkey") % 27).cast("string")).alias("name"),
    )
    orders = st.load(spark, sf_dir, "orders")
    sheet = samples_from_table(orders, st.run_of("o_orderkey"), F.col("o_orderkey"), F.col("o_orderkey"))
    sizes = st.load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("line_no"), F.col("p_brand").alias("species"),
        F.col("p_size").cast("string").alias("genome_size"),
    )
    renames = spark.createDataFrame(RENAME_ROWS, "line_no int, old_name string, new_name string")
    return species_calls(sheet, lines, renames, sizes)


FIRST_SECOND = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY run_id, metric_key, rank_code ORDER BY pos) AS rn FROM kraken_hits),
per_key AS (
  SELECT run_id, base_id, metric_key, priority,
    max(classif) FILTER (rank_code = 'G' AND rn = 1) AS genus_1, max(percent) FILTER (rank_code = 'G' AND rn = 1) AS genus_1_pct,
    max(classif) FILTER (rank_code = 'G' AND rn = 2) AS genus_2, max(percent) FILTER (rank_code = 'G' AND rn = 2) AS genus_2_pct,
    max(classif) FILTER (rank_code = 'S' AND rn = 1) AS species_1, max(percent) FILTER (rank_code = 'S' AND rn = 1) AS species_1_pct,
    max(classif) FILTER (rank_code = 'S' AND rn = 2) AS species_2, max(percent) FILTER (rank_code = 'S' AND rn = 2) AS species_2_pct,
    max(percent) FILTER (rank_code = 'U' AND rn = 1) AS unclassified_pct
  FROM ranked GROUP BY ALL)"""


@query("q04_first_second", f"WITH {st.KRAKEN_HITS}, {FIRST_SECOND} SELECT * EXCLUDE (base_id, priority) FROM per_key")
def q04(spark, sf_dir):
    return taxa.first_second_taxa(st.kraken_hits(spark, sf_dir))


@query("q04b_first_present_key", f"""WITH {st.KRAKEN_HITS}, {FIRST_SECOND}
SELECT * EXCLUDE (metric_key, priority, n) FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, base_id ORDER BY priority) AS n FROM (
    SELECT run_id, metric_key AS base_id, metric_key, 1 AS priority, * EXCLUDE (run_id, base_id, metric_key, priority) FROM per_key
    UNION ALL SELECT run_id, base_id, metric_key, priority, * EXCLUDE (run_id, base_id, metric_key, priority) FROM per_key
    WHERE priority <> 1))
WHERE n = 1""")
def q04b(spark, sf_dir):
    return taxa.first_present_key(taxa.first_second_taxa(st.kraken_hits(spark, sf_dir)))


def _summary_inputs(spark, sf_dir):
    key = F.concat(F.col("user_id").cast("string"), F.lit("_processed_R1")).alias("metric_key")
    value = F.col("value").cast("decimal(18,2)")
    general = st.load(spark, sf_dir, "events").groupBy(st.run_of("user_id").alias("run_id"), key).agg(
        F.count("*").cast("double").alias("total_sequences"),
        (F.sum(st.event_k()) / F.count("*")).alias("percent_gc"),
        (F.sum(value).cast("double") / F.count("*")).alias("avg_sequence_length"),
    )
    trim = st.load(spark, sf_dir, "orders").groupBy(
        st.run_of("o_custkey").alias("run_id"), F.col("o_custkey").cast("string").alias("metric_key")
    ).agg((F.count_if(F.col("o_orderstatus") == "F") * 100 / F.count("*")).alias("surviving_pct"))
    nation = st.load(spark, sf_dir, "nation")
    calls = st.load(spark, sf_dir, "customer").where("c_acctbal >= 0").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        st.run_of("c_custkey").alias("run_id"), F.col("c_custkey").cast("string").alias("sample_id"),
        F.when(F.col("n_nationkey") == 0, "Unknown").otherwise(F.col("n_name")).alias("top_species"),
        F.when(F.col("n_nationkey") == 0, "NA").otherwise(F.col("n_nationkey").cast("string")).alias("taxid"),
        (F.col("n_regionkey") * 1000000).cast("string").alias("expected_genome_size"),
    )
    return dict(
        samples=st.samples(spark, sf_dir), fastqc_general=general, trim_stats=trim,
        kraken_hits=st.kraken_hits(spark, sf_dir), fastqc_status=st.fastqc_status(spark, sf_dir), calls=calls,
    )


SUMMARY_SQL = f"""WITH {st.SAMPLES}, {st.KRAKEN_HITS}, {FIRST_SECOND}, {st.FASTQC_FAILS},
taxa AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, base_id ORDER BY priority) AS n FROM per_key) WHERE n = 1),
general AS (
  SELECT user_id, count(*) AS total, CAST(sum({st.EVENT_K}) AS DOUBLE) / count(*) AS gc,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS len FROM events GROUP BY user_id),
trim AS (
  SELECT o_custkey, CAST(count(*) FILTER (o_orderstatus = 'F') * 100 AS DOUBLE) / count(*) AS pct FROM orders GROUP BY o_custkey),
calls AS (
  SELECT c_custkey, CASE n_nationkey WHEN 0 THEN 'Unknown' ELSE n_name END AS species,
    CASE n_nationkey WHEN 0 THEN 'NA' ELSE CAST(n_nationkey AS VARCHAR) END AS taxid,
    CAST(n_regionkey * 1000000 AS VARCHAR) AS size
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0)
SELECT s.run_id, s.sample_ord, s.sample_id AS "Sample_ID",
  CAST(coalesce(total, 0) * 2 AS BIGINT) AS "Total_Trimmed_Reads",
  {_round('coalesce(gc, 0.0)', 1)} AS "GC_PCT", {_round('coalesce(len, 0.0)', 1)} AS "Avg_Sequence_Length",
  {_round('coalesce(pct, 0.0)', 2)} AS "Passing_Trim_PCT", {_round('coalesce(unclassified_pct, 0.0)', 1)} AS "Unclassified_PCT",
  coalesce(genus_1, 'N/A') AS "Top_Genus", {_round('coalesce(genus_1_pct, 0.0)', 2)} AS "Top_Genus_PCT",
  coalesce(genus_2, 'N/A') AS "Second_Genus", {_round('coalesce(genus_2_pct, 0.0)', 2)} AS "Second_Genus_PCT",
  CASE WHEN c.c_custkey IS NOT NULL THEN c.species ELSE coalesce(species_1, 'N/A') END AS "Top_Species",
  {_round('coalesce(species_1_pct, 0.0)', 2)} AS "Top_Species_PCT",
  coalesce(species_2, 'N/A') AS "Second_Species", {_round('coalesce(species_2_pct, 0.0)', 2)} AS "Second_Species_PCT",
  coalesce(fastqc_fails, '') AS "FASTQC_fails",
  CASE WHEN c.c_custkey IS NOT NULL THEN c.taxid ELSE 'NA' END AS "TaxID",
  CASE WHEN c.c_custkey IS NOT NULL THEN c.size ELSE 'NA' END AS "Expected_Genome_Size"
FROM samples s LEFT JOIN general g ON g.user_id = s.sample_ord LEFT JOIN trim t ON t.o_custkey = s.sample_ord
LEFT JOIN taxa x ON x.run_id = s.run_id AND x.base_id = s.sample_id
LEFT JOIN fails f ON f.run_id = s.run_id AND f.base_id = s.sample_id
LEFT JOIN calls c ON c.c_custkey = s.sample_ord"""


@query("q05_qc_summary", SUMMARY_SQL)
def q05(spark, sf_dir):
    return qc_summary(**_summary_inputs(spark, sf_dir))


@query("q06_fail_list", f"WITH {st.FASTQC_FAILS} SELECT * FROM fails")
def q06(spark, sf_dir):
    return fastqc_fails(st.fastqc_status(spark, sf_dir))


#: What one event adds to the sections of its run's report.
JSON_PARTS = {
    "general": '"%1$s_processed_R1": {"total_sequences": %2$s, "percent_gc": %3$s.5}',
    "kraken": '"%1$s.kraken": [{"rank_code": "G", "percent": %3$s, "classif": "%4$s"}, {"rank_code": "S", "percent": 1, "classif": "x"}], "%1$s": []',
    "trim": '"%1$s": {"surviving_pct": %3$s}', "fastqc": '"%1$s_processed_R2": {"%4$s": "fail", "basic_statistics": "pass"}',
}
JSON_DOC = (
    '{"report_general_stats_data": [{}, {}, {%s}],\n "report_saved_raw_data": {"multiqc_kraken": {%s},\n'
    ' "multiqc_trimmomatic": {%s}, "multiqc_fastqc": {%s}}}'
)


#: Entries of a section of one report file, about.
JSON_ENTRIES = 2_000


def _json_tables(spark, sf_dir):
    """The report files of every run, read back: a run of many events has several, each with all sections.

    Files are dealt by event, so an event that comes twice is twice in one file.
    """
    path = shared_path(spark, "metrics")
    event, k = F.col("event_id").cast("string"), F.get_json_object("props", "$.k")
    values = [F.concat(F.lit("e"), event), event, k, F.col("event_type")]
    events = st.load(spark, sf_dir, "events").withColumn("run_id", st.run_of("user_id"))
    files = events.groupBy(F.col("run_id").alias("_run")).agg(F.ceil(F.count("*") / JSON_ENTRIES).alias("_files"))
    dealt = events.join(broadcast_if_small(files), F.col("run_id").eqNullSafe(F.col("_run")))
    parts = dealt.select(
        "run_id", F.pmod(F.xxhash64("event_id"), F.col("_files")).alias("file"),
        *(F.format_string(form, *values).alias(name) for name, form in JSON_PARTS.items()))
    joined = parts.repartition("run_id", "file").groupBy("run_id", "file").agg(*(F.array_join(F.collect_list(name), ", ").alias(name) for name in JSON_PARTS))
    joined.select("run_id", "file", F.format_string(JSON_DOC, *JSON_PARTS).alias("value")).write.partitionBy("run_id", "file").text(path)
    return read_multiqc_json(spark, f"{path}/*/*/*.txt", run_pattern="run_id=([^/]+)/")


@query("q34_json_sections", f"""WITH e AS (
  SELECT 'run' || (user_id % 8) AS run_id, event_id, 'e' || event_id AS u, event_type, {st.EVENT_K} AS k FROM events)
SELECT run_id, u || '_processed_R1' AS metric_key, 'general' AS section, 'total_sequences' AS name, CAST(event_id AS DOUBLE) AS value FROM e
UNION ALL SELECT run_id, u || '_processed_R1', 'general', 'percent_gc', k + 0.5 FROM e
UNION ALL SELECT run_id, u || '.kraken', 'kraken', 'G:0:' || event_type, k FROM e
UNION ALL SELECT run_id, u || '.kraken', 'kraken', 'S:1:x', 1 FROM e
UNION ALL SELECT run_id, u, 'kraken', NULL, NULL FROM e
UNION ALL SELECT run_id, u, 'trim', 'surviving_pct', k FROM e
UNION ALL SELECT run_id, u || '_processed_R2', 'fastqc', event_type || '=fail', NULL FROM e
UNION ALL SELECT run_id, u || '_processed_R2', 'fastqc', 'basic_statistics=pass', NULL FROM e""")
def q34(spark, sf_dir):
    tables = _json_tables(spark, sf_dir)
    key = ["run_id", "metric_key"]

    def rows(section, name, value, table):
        return tables[table].select(
            *key, F.lit(section).alias("section"), name.alias("name"), value.cast("double").alias("value")
        )

    number = F.col("total_sequences")
    hit = F.concat("rank_code", F.lit(":"), F.col("pos").cast("string"), F.lit(":"), "classif")
    return (
        rows("general", F.lit("total_sequences"), number, "fastqc_general")
        .unionByName(rows("general", F.lit("percent_gc"), F.col("percent_gc"), "fastqc_general"))
        .unionByName(rows("kraken", hit, F.col("percent"), "kraken_hits"))
        .unionByName(rows("trim", F.lit("surviving_pct"), F.col("surviving_pct"), "trim_stats"))
        .unionByName(rows("fastqc", F.concat("module", F.lit("="), "status"), F.lit(None), "fastqc_status"))
    )


@query("q44_rounding", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(printf('%.1f', l_extendedprice / 100) AS DOUBLE) AS tenths, CAST(printf('%.2f', l_discount * l_tax) AS DOUBLE) AS hundredths,
  CAST(printf('%.3f', l_extendedprice / l_quantity) AS DOUBLE) AS thousandths,
  CAST(printf('%.1f', CAST(l_partkey AS DOUBLE) / 20) AS DOUBLE) AS ties FROM lineitem""")
def q44(spark, sf_dir):
    return st.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        round_binary_half_even("l_extendedprice / 100", 1).alias("tenths"),
        round_binary_half_even("l_discount * l_tax", 2).alias("hundredths"),
        round_binary_half_even("l_extendedprice / l_quantity", 3).alias("thousandths"),
        round_binary_half_even("l_partkey / 20", 1).alias("ties"),
    )
