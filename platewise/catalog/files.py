"""q37 to q42: tables written as the files of a run and read back through the sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from platewise import schemas
from platewise.catalog import query
from platewise.catalog import standins as st
from platewise.catalog.accounting import USAGE_SQL
from platewise.catalog.summary import SUMMARY_SQL, q05
from platewise.operators.accounting import is_empty_or_header_only, sub_tool_versions
from platewise.operators.taxa import top_hits, union_species
from platewise.plans.run_accounting import resource_log
from platewise.session import shared_path
from platewise.sources.artifacts import concat_lanes, discover_samples, list_artifacts
from platewise.sources.fastq import read_fastq_pairs, write_fastq_pairs
from platewise.sources.sinks import (
    append_resource_usage, append_versions, read_resource_usage, read_top_hits, read_versions, versions_as_text, write_qc_summary, write_top_hits,
)
from platewise.sources.text import (
    merge_species_calls, ordered_lines, read_genome_sizes, read_renames, read_report_lines, read_samples,
)

RUN_DIR = r"run_id=([^/]+)/"


@query("q37_sheet_files", f"""WITH {st.SAMPLES}
SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY sample_ord) - 1 AS sample_ord, sample_id FROM samples""")
def q37(spark, sf_dir):
    path = shared_path(spark, "sheets")
    rows = st.load(spark, sf_dir, "customer").select(
        st.run_of("c_custkey").alias("run_id"), "c_custkey", "c_name", F.col("c_custkey").cast("string").alias("SAMPLE_ID"), "c_mktsegment"
    )
    sheets = rows.repartition("run_id").sortWithinPartitions("run_id", "c_custkey").drop("c_custkey")
    sheets.write.partitionBy("run_id").options(sep="\t", header=True).csv(path)
    return read_samples(spark, f"{path}/*/*.csv", run_pattern=RUN_DIR)


@query("q38_report_lines", f"""WITH {st.REPORT_LINES}, n AS (
  SELECT *, row_number() OVER (PARTITION BY run_id, rank_code ORDER BY line_no) - 1 AS n FROM report_lines),
r AS (
  SELECT *, row_number() OVER (PARTITION BY run_id, rank_code ORDER BY n) AS rn FROM n WHERE CAST(percentage AS DOUBLE) >= 20000)
SELECT run_id, rank_code || ' 1+' AS sample_id, n AS line_no, percentage, count_clade, count_taxon, rank_code, taxid, name,
  rn <= CASE rank_code WHEN 'U' THEN 1 ELSE 3 END AS top FROM r""")
def q38(spark, sf_dir):
    """Orders as report files, one for each run and status; lines of cheap orders are a field short and must be dropped, but keep their numbers."""
    path = shared_path(spark, "reports")
    lines = st.report_lines(spark, sf_dir)
    fields = ["percentage", "count_clade", "count_taxon", "rank_code", "taxid"]
    name = F.when(F.col("percentage").cast("double") >= 20000, F.col("name"))
    text = lines.select("run_id", F.concat("rank_code", F.lit(" 1+")).alias("sample_id"), "line_no", F.concat(F.lit("  "), F.concat_ws("\t", *fields, name), F.lit("\r")).alias("value"))
    files = text.repartition("run_id", "sample_id").sortWithinPartitions("run_id", "sample_id", "line_no").drop("line_no")
    files.write.partitionBy("run_id", "sample_id").text(path)
    back = read_report_lines(spark, f"{path}/*/*/*.txt", key_pattern=r"run_id=([^/]+)/sample_id=([^/]+)/").withColumn("sample_id", F.url_decode(F.replace("sample_id", F.lit("+"), F.lit("%2B"))))
    top = top_hits(back).select("run_id", "sample_id", F.col("Count_Clade").alias("count_clade"), F.lit(True).alias("top"))
    return back.join(top, ["run_id", "sample_id", "count_clade"], "left").withColumns({"top": F.coalesce("top", F.lit(False)), "name": F.ltrim("name")})


@query("q39_fastq_files", f"""WITH {st.READS}
SELECT sample_id, read_id, md5(regexp_replace(seq1, '[^!-~]', 'N', 'g')) AS seq1, md5(qual1) AS qual1,
  md5(regexp_replace(seq2, '[^!-~]', 'N', 'g')) AS seq2, md5(qual2) AS qual2 FROM reads""")
def q39(spark, sf_dir):
    path = shared_path(spark, "fastq")
    reads = st.reads(spark, sf_dir)
    plain = {name: F.regexp_replace(name, "[^!-~]", "N") for name in ("seq1", "seq2")}
    write_fastq_pairs(reads.withColumns(plain), path)
    sheet = reads.select(F.lit("r1").alias("run_id"), "sample_id").distinct()
    back = concat_lanes(read_fastq_pairs(spark, path, run_id="r1"), sheet)
    digests = [F.md5(F.col(c).cast("binary")).alias(c) for c in ("seq1", "qual1", "seq2", "qual2")]
    return back.select("sample_id", "read_id", *digests)


@query("q48_discovered_lanes", f"""WITH {st.READS}, s AS (SELECT sample_id, count(*) AS n_pairs FROM reads GROUP BY 1)
SELECT sample_id, row_number() OVER (ORDER BY sample_id) - 1 AS sample_ord, n_pairs FROM s""")
def q48(spark, sf_dir):
    """Files of two lanes per sample; the sheet is what their names say."""
    path = shared_path(spark, "lanes")
    reads = st.reads(spark, sf_dir).withColumn("seq1", F.lit("ACGT")).withColumn("qual1", F.lit("IIII")).withColumn("seq2", F.lit("AC")).withColumn("qual2", F.lit("II"))
    write_fastq_pairs(reads.repartition(2, "read_id"), path)
    sheet = discover_samples(list_artifacts(spark, path), run_id="r1")
    back = concat_lanes(read_fastq_pairs(spark, path, run_id="r1"), sheet)
    counts = back.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_pairs"))
    return sheet.join(counts, "sample_id").select("sample_id", "sample_ord", "n_pairs")


@query("q40_species_files", """SELECT 'run' || (c_custkey % 8) AS run_id, CAST(c_custkey AS VARCHAR) AS sample_id, c_mktsegment AS top_species,
  CAST(c_nationkey AS VARCHAR) AS taxid, 'NA' AS expected_genome_size FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def q40(spark, sf_dir):
    path = shared_path(spark, "species")
    key = F.col("c_custkey").cast("string")
    rows = st.load(spark, sf_dir, "customer").select(
        st.run_of("c_custkey").alias("run_id"), key.alias("Sample_ID"), F.col("c_mktsegment").alias("Top_Species"),
        F.col("c_nationkey").cast("string").alias("TaxID"), F.lit("NA").alias("Expected_Genome_Size"),
    )
    rows.write.partitionBy("run_id").options(sep="\t", header=True).csv(path)
    sheet = st.load(spark, sf_dir, "orders").select(
        st.run_of("o_custkey").alias("run_id"), F.col("o_custkey").cast("string").alias("sample_id")
    )
    return union_species([merge_species_calls(spark, f"{path}/*/*.csv", run_pattern=RUN_DIR)], sheet)


@query("q41_summary_tsv", f"SELECT * EXCLUDE (run_id, sample_ord, \"FASTQC_fails\"), nullif(\"FASTQC_fails\", '') AS \"FASTQC_fails\" FROM ({SUMMARY_SQL})")
def q41(spark, sf_dir):
    path = shared_path(spark, "summary")
    write_qc_summary(q05(spark, sf_dir), path)
    return spark.read.options(sep="\t", header=True).schema(schemas.QC_SUMMARY).csv(path)


@query("q42_resource_log", f"""WITH {USAGE_SQL},
hosts AS (SELECT 'run' || r_regionkey AS run_id, 96 AS cores, 1007.4 AS memory FROM region),
fit AS (
  SELECT u.*, CAST(memory AS DOUBLE) AS memory, cores, CAST(trunc(CAST(memory AS DOUBLE) * 0.8::DOUBLE / max_memory_gb) AS BIGINT) AS mr,
    CAST(trunc(CAST(memory AS DOUBLE) / max_memory_gb) AS BIGINT) AS ml, CAST(trunc(cores * 0.8::DOUBLE / max_cpu_cores) AS BIGINT) AS cr,
    CAST(trunc(cores / max_cpu_cores) AS BIGINT) AS cl FROM usage u LEFT JOIN hosts h USING (run_id))
SELECT run_id, '2025-01-15 14:23:10' AS timestamp, tool, execution_mode, n_ran, CAST(printf('%.3f', mean_memory_gb) AS DOUBLE) AS mean_memory_gb,
  CAST(printf('%.3f', max_memory_gb) AS DOUBLE) AS max_memory_gb, CAST(printf('%.1f', mean_cpu_cores) AS DOUBLE) AS mean_cpu_cores,
  CAST(printf('%.1f', max_cpu_cores) AS DOUBLE) AS max_cpu_cores, CAST(printf('%.1f', runtime_seconds) AS DOUBLE) AS runtime_seconds,
  CAST(CASE tool WHEN 'click' THEN 10 WHEN 'view' THEN 4 ELSE 1 END AS INTEGER) AS parallel, least(mr, cr) AS suggested_threads, mr AS memory_t_recommended, ml AS memory_t_limit,
  cr AS cpu_t_recommended, cl AS cpu_t_limit, CASE WHEN mr < cr THEN 'memory' WHEN memory IS NOT NULL THEN 'cpu' END AS bottleneck,
  CAST(printf('%.1f', least(mr, cr) * max_memory_gb / memory * 100) AS DOUBLE) AS mem_total_percent,
  CAST(printf('%.1f', least(mr, cr) * max_cpu_cores / cores * 100) AS DOUBLE) AS cpu_total_percent FROM fit""")
def q42(spark, sf_dir):
    path = shared_path(spark, "resource-usage")
    hosts = st.load(spark, sf_dir, "region").select(
        F.concat(F.lit("run"), F.col("r_regionkey").cast("string")).alias("run_id"), F.lit(96).alias("logical_cores"),
        F.lit(48).alias("cpu_cores"), F.lit(1007.4).alias("memory_gb"),
    )
    tools = spark.createDataFrame([("click", 10), ("view", 4)], "tool string, parallel int")
    rows = resource_log(st.task_runs(spark, sf_dir), hosts, tools, "2025-01-15 14:23:10")
    # two appends, as two runs of the job would make them; the second is repeated, as after a failure
    append_resource_usage(rows.where("tool <= 'error'"), path, batch="first")
    for _ in range(2):
        append_resource_usage(rows.where("tool > 'error'"), path, batch="second")
    return read_resource_usage(spark, path)


@query("q42b_version_log", """WITH e AS (SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, user_id FROM events)
SELECT timestamp, event_type AS tool, 'v' || event_id AS version, '/bin/' || event_type AS path, CASE WHEN event_id % 2 = 0 THEN 'db' ELSE 'none' END AS database FROM e
UNION ALL SELECT timestamp, 'click:gzip', '1.13', '/bin/gzip', 'none' FROM e WHERE event_type = 'click'
UNION ALL SELECT timestamp, 'click:sed', '4.8', '/bin/sed', 'regex' FROM e WHERE event_type = 'click'""")
def q42b(spark, sf_dir):
    path = shared_path(spark, "versions")
    captured = st.load(spark, sf_dir, "events").select(
        st.run_of("user_id").alias("run_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("tool"),
        F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("version"), F.concat(F.lit("/bin/"), "event_type").alias("path"),
        F.when(F.col("event_id") % 2 == 0, "db").alias("database"),
    )
    subs = [("gzip", "1.13", "/bin/gzip", None), ("sed", "4.8", "/bin/sed", "regex")]
    tools = spark.createDataFrame([(1, "click", "per_sample", 1, None, None, None, subs)], schemas.TOOLS)
    for _ in range(2):  # a repeated append changes nothing
        append_versions(sub_tool_versions(tools, captured), path, batch="2025-01-15")
    return versions_as_text(read_versions(spark, path))


@query("q45_lookup_files", """SELECT 'size' AS kind, p_name AS name, CAST(p_retailprice AS VARCHAR) AS value FROM part WHERE p_size >= 10
UNION ALL SELECT 'rename', s_name, 'nation ' || s_nationkey FROM supplier""")
def q45(spark, sf_dir):
    """Parts as genome sizes (small parts lack the third field and are ignored) and suppliers as renames."""
    sizes_path, renames_path = shared_path(spark, "sizes"), shared_path(spark, "renames")
    price = F.when(F.col("p_size") >= 10, F.col("p_retailprice").cast("string"))
    line = F.concat_ws("\t", "p_name", F.col("p_partkey").cast("string"), price).alias("species\ttaxid\tgenome_size")
    st.load(spark, sf_dir, "part").select(line).write.options(sep="\x01", header=True, quote="").csv(sizes_path)
    st.load(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("old_name"), F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("new_name")
    ).write.options(sep="\t", header=True).csv(renames_path)

    def rows(table, kind, name, value):
        return table.select(F.lit(kind).alias("kind"), F.col(name).alias("name"), F.col(value).alias("value"))

    sizes = rows(read_genome_sizes(spark, sizes_path), "size", "species", "genome_size")
    return sizes.unionByName(rows(read_renames(spark, renames_path), "rename", "old_name", "new_name"))


@query("q46_artifact_files", """SELECT role, count(*) AS n_lines, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes, FALSE AS empty
FROM (SELECT role, conv_id || ':' || turn || ':' || regexp_replace(text, '[\n\r]', ' ', 'g') AS line FROM conversations) GROUP BY role""")
def q46(spark, sf_dir):
    """Conversation turns as the lines of files, one folder per role: listed, measured and counted."""
    path = shared_path(spark, "artifacts")
    parts = [F.col("conv_id").cast("string"), F.col("turn").cast("string"), F.regexp_replace("text", "[\\n\\r]", " ")]
    rows = st.load(spark, sf_dir, "conversations").select("role", F.concat_ws(":", *parts).alias("value"))
    rows.write.partitionBy("role").text(path)
    found = list_artifacts(spark, path, glob="*.txt")
    measured = is_empty_or_header_only(ordered_lines(spark, f"{path}/*/*.txt"), found).join(found, "path")
    return measured.groupBy(F.regexp_extract("path", "role=([^/]+)/", 1).alias("role")).agg(
        F.sum("n_lines").alias("n_lines"), F.sum("length").alias("bytes"),
        (F.sum("n_lines") == 0).alias("empty"),
    )


@query("q50_top_hit_files", f"""WITH {st.REPORT_LINES}, r AS (
  SELECT *, row_number() OVER (PARTITION BY run_id, sample_id, rank_code ORDER BY line_no) AS rn FROM report_lines)
SELECT run_id, sample_id, percentage AS "Percentage", count_clade AS "Count_Clade", count_taxon AS "Count_Taxon",
  CASE rank_code WHEN 'G' THEN 'Genus' WHEN 'S' THEN 'Species' ELSE 'Unclassified' END AS "TaxRank", taxid AS "TaxID", trim(name) AS "Organism"
FROM r WHERE rn <= CASE rank_code WHEN 'U' THEN 1 ELSE 3 END""")
def q50(spark, sf_dir):
    """Top hits written as the files of samples and read back."""
    path = shared_path(spark, "top-hits")
    write_top_hits(top_hits(st.report_lines(spark, sf_dir)), path)
    return read_top_hits(spark, path)
