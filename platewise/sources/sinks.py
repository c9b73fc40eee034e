"""Writers of the result tables."""

from __future__ import annotations

import io
import re
import uuid
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from platewise import schemas
from platewise.functions.numeric import round_binary_half_even
from platewise.session import checkpointed
from platewise.sources.artifacts import LISTED, open_root

_HITS_FILE, _NO_VALUE = "part-00000.csv", "__HIVE_DEFAULT_PARTITION__"
#: What Spark escapes in the names of partitions' directories.
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")
#: Directories of samples that one task reads.
FOLDERS_A_TASK = 2_000


def write_qc_summary(summary: DataFrame, path: str, fmt: str = "tsv") -> None:
    """QC summary in sheet order, as TSV with header (the 17 columns) or as Parquet by run."""
    if fmt == "parquet":
        summary.write.mode("overwrite").partitionBy("run_id").parquet(path)
        return
    ordered = summary.orderBy("run_id", "sample_ord").select(*schemas.QC_SUMMARY.names)
    ordered.write.mode("overwrite").options(sep="\t", header=True, emptyValue="").csv(path)


def write_top_hits(hits: DataFrame, path: str) -> None:
    """Top hits as CSV with header, one directory per run and sample; a sample without hits has none.

    Directories are named as Spark names those of partitions. There are as many as samples, so tasks put their files in their places themselves:
    the driver neither moves nor lists them. A file gets its name when it is whole, the same name in every attempt of a task, so a repeated one leaves no double.
    """
    keys = ["run_id", "sample_id"]
    columns = [c for c in schemas.TOP_HITS.names if c not in (*keys, "hit_ord")]
    filesystem, root = open_root(path)
    if filesystem.get_file_info(root).type != fs.FileType.NotFound:
        filesystem.delete_dir(root)
    filesystem.create_dir(root, recursive=True)
    header = ",".join(columns)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, attempt = open_root(path)[0], TaskContext.get().taskAttemptId()
        now, stream, draft, folder, files = None, None, "", "", 0
        for batch in batches:
            runs, samples, lines = (c.to_pylist() for c in batch.columns)
            for key, group in groupby(zip(runs, samples, lines), lambda r: r[:2]):
                if key != now:
                    if stream:
                        stream.close()
                        target.move(draft, f"{folder}/{_HITS_FILE}")
                    now, files = key, files + 1
                    folder = f"{root}/" + "/".join(f"{name}={_partition_value(value)}" for name, value in zip(keys, key))
                    draft = f"{folder}/.{_HITS_FILE}.{attempt}"
                    target.create_dir(folder, recursive=True)
                    stream = target.open_output_stream(draft, compression=None)
                    stream.write(f"{header}\n".encode())
                stream.write("".join(f"{line}\n" for *_, line in group).encode())
        if stream:
            stream.close()
            target.move(draft, f"{folder}/{_HITS_FILE}")
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    # An empty key has the directory of a null one.
    named = hits.withColumns({k: F.nullif(F.col(k).cast("string"), F.lit("")) for k in keys})
    dealt = named.repartition(*keys).sortWithinPartitions(*keys, "hit_ord").select(*keys, F.to_csv(F.struct(*columns)).alias("line"))
    dealt.mapInArrow(put, "files bigint").agg(F.sum("files")).collect()
    filesystem.open_output_stream(f"{root}/_SUCCESS", compression=None).close()


def read_top_hits(spark: SparkSession, path: str) -> DataFrame:
    """The files of :func:`write_top_hits`: their columns, ``run_id`` and ``sample_id``.

    Directories are listed by tasks, run by run, then dealt to tasks that read the files in them: the driver holds no list of files.
    """
    columns = [c for c in schemas.TOP_HITS.names if c not in ("run_id", "sample_id", "hit_ord")]

    def folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = open_root(path)[0]
        for batch in batches:
            for parent in batch.column(0).to_pylist():
                found = [i.path for i in source.get_file_info(fs.FileSelector(parent)) if i.type == fs.FileType.Directory]
                for start in range(0, len(found), LISTED):
                    yield pa.RecordBatch.from_arrays([pa.array(found[start:start + LISTED], pa.string())], names=["folder"])

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = open_root(path)[0]
        for batch in batches:
            at, found = [], []
            for folder in batch.column(0).to_pylist():
                for info in source.get_file_info(fs.FileSelector(folder)):
                    if not info.is_file or info.base_name.startswith((".", "_")):
                        continue
                    with io.TextIOWrapper(source.open_input_stream(info.path, compression=None), encoding="utf-8") as text:
                        next(text, None)  # the header
                        for line in text:
                            if line.strip():
                                at.append(folder)
                                found.append(line.rstrip("\n"))
                            if len(found) == LISTED:
                                yield pa.RecordBatch.from_arrays([pa.array(at, pa.string()), pa.array(found, pa.string())], names=["folder", "line"])
                                at, found = [], []
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.string()), pa.array(found, pa.string())], names=["folder", "line"])

    level = spark.createDataFrame([(open_root(path)[1],)], "folder string")
    for _ in ("run_id", "sample_id"):
        level = checkpointed(level.mapInArrow(folders, "folder string"))
        level = level.repartition(max(1, spark.sparkContext.defaultParallelism, level.count() // FOLDERS_A_TASK), "folder")

    def value(name: str) -> Column:
        text = F.regexp_extract("folder", f"/{name}=([^/]*)", 1)
        return F.when(text != _NO_VALUE, F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))).alias(name)

    fields = F.from_csv("line", ", ".join(f"{c} string" for c in columns))
    read = level.mapInArrow(lines, "folder string, line string").select("folder", fields.alias("f"))
    return read.select("f.*", value("run_id"), value("sample_id"))


def _partition_value(value: str | None) -> str:
    """A value as Spark writes it in the name of a partition's directory."""
    return _NO_VALUE if value is None else _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value)


def resource_rows(plan: DataFrame, tools: DataFrame, timestamp: str) -> DataFrame:
    """Rows of the resource log from a capacity plan: the log's columns, rounding and order; ``parallel`` is 1 if not given."""
    parallel = tools.select("tool", "parallel")
    digits = {
        "mean_memory_gb": 3, "max_memory_gb": 3, "mean_cpu_cores": 1, "max_cpu_cores": 1, "runtime_seconds": 1,
    }
    rows = plan.join(parallel, "tool", "left").withColumn("timestamp", F.lit(timestamp))
    rows = rows.withColumn("parallel", F.coalesce("parallel", F.lit(1)))
    rows = rows.withColumns({name: round_binary_half_even(name, n) for name, n in digits.items()})
    return rows.select(
        "run_id", *[F.col(f.name).cast(f.dataType) for f in schemas.RESOURCE_USAGE.fields]
    )


def _append(rows: DataFrame, path: str, batch: str | None) -> None:
    """Add a batch of rows to a log, or put it in the place of the same batch.

    A batch has a folder of its own in each run, and a write replaces the folders that it has rows for: a job that gives its batch a name (its run's
    time, say) may be repeated and leaves no double. Without a name every write is a new batch.
    """
    batch = batch or uuid.uuid4().hex
    named = rows.withColumn("batch", F.lit(batch))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "batch").parquet(path)


def _read_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    fields = [f for f in schema.fields if f.name not in ("run_id", "batch")]
    typed = StructType([*fields, StructField("run_id", StringType()), StructField("batch", StringType())])
    return spark.read.schema(typed).parquet(path).drop("batch")


def append_resource_usage(rows: DataFrame, path: str, batch: str | None = None) -> None:
    """Append to the resource log; unknown limits are null. A repeated ``batch`` replaces itself."""
    _append(rows, path, batch)


def read_resource_usage(spark: SparkSession, path: str) -> DataFrame:
    """The resource log, all batches."""
    return _read_log(spark, path, schemas.RESOURCE_USAGE)


def append_versions(rows: DataFrame, path: str, batch: str | None = None) -> None:
    """Append to the version log. A repeated ``batch`` replaces itself."""
    _append(rows.select(*schemas.VERSIONS.names), path, batch)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """The version log, all batches."""
    return _read_log(spark, path, schemas.VERSIONS).select(*schemas.VERSIONS.names)


def versions_as_text(rows: DataFrame) -> DataFrame:
    """Version log in its written form: ``tool`` or ``tool:sub_tool``."""
    name = F.concat_ws(":", "tool", "sub_tool")
    return rows.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), name.alias("tool"),
        "version", "path", "database",
    )
