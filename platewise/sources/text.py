"""Text files: ordered lines, sample sheets, reports, lookup tables and logs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from platewise import schemas
from platewise.functions.text import BLANKS, parse_elapsed
from platewise.session import broadcast_if_small, checkpointed

_ID_COLUMN = "SAMPLE_ID"


def file_path() -> Column:
    """Path of the file a row was read from, as plain text and without a ``file:`` scheme."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "/")


def numbered(scan: DataFrame, name: str, *columns: Column) -> DataFrame:
    """``columns`` of a scan of text files with ``path`` and a dense number, from 0, for the rows of each file.

    Two passes: the first counts the rows of every file block, and sums of the counts say how many rows of the file lie before it; the second adds a row's
    place in its block, which the task that reads the block knows. Nothing is sorted and rows are not shuffled, whatever the
    size of the splits and however many of them one task reads. If the two passes cut the files differently, because a setting was
    changed or a file was rewritten in between, that is an error. Must be given the plain scan; rows that are dropped later keep their numbers.
    """
    row, block = F.monotonically_increasing_id().alias("_row"), F.col("_metadata.file_block_start").alias("_block")
    rows = scan.select(file_path().alias("path"), block, row, *columns)
    counts = rows.groupBy("path", "_block").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = checkpointed(counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))))
    index = broadcast_if_small(blocks.select(F.col("path").alias("_path"), F.col("_block").alias("_at"), "_n", "_first", "_before"))
    joined = rows.join(index, (F.col("path") == F.col("_path")) & (F.col("_block") == F.col("_at")), "left")
    place = F.col("_row") - F.col("_first")
    changed = F.raise_error(F.concat(F.lit("files or splits changed while lines were numbered: "), F.col("path"))).cast("bigint")
    number = F.when(place.isNull() | (place < 0) | (place >= F.col("_n")), changed).otherwise(F.col("_before") + place)
    return joined.select("path", number.alias(name), *(F.col(f"`{c}`") for c in rows.columns[3:]))


def ordered_lines(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """Text lines as ``path, line_no, value``, numbered from 0 in each file.

    Files are split and read in parallel as usual; see :func:`numbered`.
    """
    return numbered(spark.read.options(**options).text(path), "line_no", F.col("value"))


def read_samples(
    spark: SparkSession, path: str | list[str], id_column: str = _ID_COLUMN,
    run_pattern: str = r"([^/]+)/[^/]+$",
) -> DataFrame:
    """Sample sheets (TSV with header) as ``run_id, sample_ord, sample_id`` in sheet order.

    Ids stay text: '007' and 'NA' are ids, only an empty cell is none. Duplicates are kept. The run id is
    the first group of ``run_pattern`` in the file's path. All sheets must share one header. ``sample_ord`` is the number of the row
    in its file, from 0, rows without an id counted too.
    """
    sheet = spark.read.options(sep="\t", header=True, enforceSchema=False, inferSchema=False).csv(path)
    if id_column not in sheet.columns:
        raise ValueError(
            f"Column '{id_column}' not found in {path}. Available columns: {', '.join(sheet.columns)}"
        )
    rows = numbered(sheet, "sample_ord", F.col(f"`{id_column}`").alias("sample_id"))
    ids = rows.select(F.regexp_extract("path", run_pattern, 1).alias("run_id"), "sample_ord", "sample_id").where(
        F.col("sample_id").isNotNull() & (F.col("sample_id") != "")
    )
    if ids.isEmpty():
        raise ValueError(f"No sample IDs found in column '{id_column}' of {path}")
    return ids


def samples_from_table(rows: DataFrame, run_id: Column, order: Column, sample_id: Column) -> DataFrame:
    """A sheet that already is a table: same columns and rules as :func:`read_samples`."""
    text = sample_id.cast("string")
    return rows.where(text.isNotNull() & (text != "")).select(
        run_id.cast("string").alias("run_id"), order.cast("bigint").alias("sample_ord"), text.alias("sample_id")
    )


def split_report_lines(lines: DataFrame) -> DataFrame:
    """Classification report fields of ``value``; lines with fewer than six fields are dropped."""
    fields = F.split(F.btrim("value", F.lit(BLANKS)), "\t")
    names = ["percentage", "count_clade", "count_taxon", "rank_code", "taxid", "name"]
    rest = [c for c in lines.columns if c != "value"]
    return (
        lines.withColumn("_f", fields)
        .where(F.size("_f") >= len(names))
        .select(*rest, *[F.get("_f", F.lit(i)).alias(n) for i, n in enumerate(names)])
    )


def read_report_lines(
    spark: SparkSession, path: str | list[str],
    key_pattern: str = r"([^/]+)/[^/]+/[^/]+/([^/]+)\.kraken\.report\.txt$", **options: str,
) -> DataFrame:
    """Classification reports as report lines; the pattern's groups in the path are run and sample id."""
    lines = ordered_lines(spark, path, **options)
    keyed = lines.select(
        F.regexp_extract("path", key_pattern, 1).alias("run_id"),
        F.regexp_extract("path", key_pattern, 2).alias("sample_id"),
        "line_no", "value",
    )
    return split_report_lines(keyed)


def _lookup_table(spark: SparkSession, path: str, columns: list[str], **options: object) -> DataFrame:
    schema = schemas.table(**{c: schemas.STR for c in columns})
    rows = spark.read.options(sep="\t", header=True, **options).schema(schema).csv(path)
    return numbered(rows, "line_no", *(F.col(c) for c in columns))


def read_genome_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Genome sizes (TSV, header), ordered by file and line; rows with fewer than three fields are ignored."""
    rows = _lookup_table(spark, path, ["species", "taxid", "genome_size"], quote="")
    return rows.where(F.col("genome_size").isNotNull())


def read_renames(spark: SparkSession, path: str | None) -> DataFrame:
    """Species renames (TSV, header), ordered by file and line; without the file there are none."""
    if path:
        try:
            rows = _lookup_table(spark, path, ["old_name", "new_name"])
            return rows.where(F.col("old_name").isNotNull())
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schemas.RENAMES)


def merge_species_calls(
    spark: SparkSession, path: str | list[str], run_pattern: str = r"([^/]+)/[^/]+/[^/]+/[^/]+\.species\.tsv$",
    **options: str,
) -> DataFrame:
    """All per-sample species files below ``path`` as one table (merged under one header)."""
    names = ["Sample_ID", "Top_Species", "TaxID", "Expected_Genome_Size"]
    schema = schemas.table(**{n: schemas.STR for n in names})
    rows = spark.read.options(sep="\t", header=True, **options).schema(schema).csv(path)
    return rows.select(
        F.regexp_extract(file_path(), run_pattern, 1).alias("run_id"),
        F.col("Sample_ID").alias("sample_id"), F.col("Top_Species").alias("top_species"),
        F.col("TaxID").alias("taxid"), F.col("Expected_Genome_Size").alias("expected_genome_size"),
    )


def parse_resource_reports(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Memory (GB), cores and user seconds per report from the text of ``time -v``; missing lines are 0."""
    def number(label: str) -> Column:
        text = F.regexp_extract("value", label + r"\s*(\S+)", 1)
        return F.coalesce(F.max(F.when(text != "", text.try_cast("double"))), F.lit(0.0))

    wall_text = F.regexp_extract("value", r"Elapsed \(wall clock\) time .*\):\s*([0-9:.]+)", 1)
    wall = F.coalesce(F.max(F.when(wall_text != "", parse_elapsed(wall_text))), F.lit(0.0))
    per_report = lines.groupBy(*keys).agg(
        number(r"Maximum resident set size \(kbytes\):").alias("max_rss_kb"),
        number(r"User time \(seconds\):").alias("user_s"),
        number(r"System time \(seconds\):").alias("sys_s"),
        wall.alias("wall_s"),
    )
    cores = F.when(F.col("wall_s") > 0, (F.col("user_s") + F.col("sys_s")) / F.col("wall_s")).otherwise(0.0)
    return per_report.withColumn("peak_memory_gb", F.col("max_rss_kb") / 1024 / 1024).withColumn("cpu_cores", cores)


def read_resource_reports(
    spark: SparkSession, path: str | list[str],
    key_pattern: str = r"([^/]+)/([^/]+)/([^/]+)\.time\.txt$", **options: str,
) -> DataFrame:
    """Resource reports below ``path``; the pattern's groups in the path are run, tool and sample id."""
    lines = spark.read.options(**options).text(path).select(file_path().alias("path"), "value")
    keys = ["run_id", "tool", "sample_id"]
    keyed = lines.select(
        *[F.regexp_extract("path", key_pattern, i + 1).alias(k) for i, k in enumerate(keys)], "value"
    )
    return parse_resource_reports(keyed, keys)


def _runtime_seconds(text: Column) -> Column:
    """Seconds from the runtime written in a status line."""
    def part(pattern: str) -> Column:
        found = F.regexp_extract(text, pattern, 1)
        return F.coalesce(F.when(found != "", found.try_cast("double")), F.lit(0.0))

    return part(r"(\d+)h ") * 3600 + part(r"(\d+)m ") * 60 + part(r"([\d.]+)(?:s$| seconds$)")


def parse_status_log(lines: DataFrame, prefix: str = "") -> DataFrame:
    """Status lines of a run log as typed rows; other lines are dropped.

    Adds ``sample_id, event, status, exit_code, runtime_s, detail``. The status is taken from the form of
    the line, never from words inside a sample id. ``prefix`` is a regular expression for what the log
    writes in front of each message.
    """
    start = "(?s)^" + prefix
    forms = [
        (r"(?:✅ )?(.+?) skipped \(output exists: (.*)\)$", "skipped", "skipped"),
        (r"(.+?): ERROR: missing input file (.*)$", "missing_input", "skipped_missing_input"),
        (r"(.+?): Allowed failure \(exit code (-?\d+)\)$", "allowed_failure", "allowed_failure"),
        (r"(.+?): Failed with exit code (-?\d+)$", "failed", "failed"),
        (r"(.+?): Failed - (.*)$", "exception", "failed"),
        (r"(.+?): Completed \(runtime: (.*)\)$", "completed", "completed"),
        (r"(.+?): (Starting)$", "starting", "starting"),
    ]
    # the form is found once; the fields are then taken from the matching form only
    form = F.coalesce(*[F.when(F.col("value").rlike(start + p), n) for n, (p, _, _) in enumerate(forms)])

    def of_form(values: list[Column]) -> Column:
        return F.coalesce(*[F.when(F.col("_form") == n, v) for n, v in enumerate(values)])

    rest = [c for c in lines.columns if c != "value"]
    parsed = lines.withColumn("_form", form).where(F.col("_form").isNotNull()).select(
        *rest,
        of_form([F.regexp_extract("value", start + p, 1) for p, _, _ in forms]).alias("sample_id"),
        of_form([F.lit(e) for _, e, _ in forms]).alias("event"),
        of_form([F.lit(s) for _, _, s in forms]).alias("status"),
        of_form([F.regexp_extract("value", start + p, 2) for p, _, _ in forms]).alias("detail"),
    )
    coded = F.col("event").isin("allowed_failure", "failed")
    exit_code = F.when(coded, F.col("detail").try_cast("int")).when(F.col("event") == "completed", 0)
    runtime = F.when(F.col("event") == "completed", _runtime_seconds(F.col("detail")))
    return parsed.withColumn("exit_code", exit_code).withColumn("runtime_s", runtime)


def read_status_log(
    spark: SparkSession, path: str | list[str], run_pattern: str = r"([^/]+)/[^/]+$", prefix: str = "", **options: str
) -> DataFrame:
    """Run logs below ``path`` as typed status rows in log order (``line_no``)."""
    lines = ordered_lines(spark, path, **options).select(
        F.regexp_extract("path", run_pattern, 1).alias("run_id"), "line_no", "value"
    )
    return parse_status_log(lines, prefix)
