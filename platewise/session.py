"""Session settings, shared-folder materialisation, the size-checked broadcast and batch sizes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch, whichever is reached first; a batch has at least one row.
ROWS_PER_BATCH = 256
BYTES_PER_BATCH = 4 << 20


def get_session(app_name: str = "platewise", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators assume; extra ``conf`` wins."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="platewise-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for a table written once and read back."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably in the shared folder and cut its lineage there."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)


def bucketed(df: DataFrame, *columns: str, buckets: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder as a table bucketed and sorted by ``columns``, and read it back.

    A join or aggregation by these columns needs no shuffle of it, and none at all with another table of as many buckets.
    There are as many buckets as shuffle partitions, each one file. The table is known to the session's catalog under a name of its own.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"platewise_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *columns).write.format("parquet").bucketBy(buckets, *columns).sortBy(*columns)
    writer.option("path", shared_path(spark, "bucketed")).saveAsTable(name)
    return spark.table(name)


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether a stored table has no more than ``rows`` rows."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """Broadcast hint only when a count proves ``df`` has at most ``max_rows`` rows.

    ``df`` is materialised first, so neither the count nor the join recomputes it. A larger side is
    returned without a hint: the join then shuffles, and adaptive execution splits its hot keys.
    """
    stored = checkpointed(df)
    return F.broadcast(stored) if has_at_most(stored, max_rows) else stored


def spread_if_few(df: DataFrame, *columns: str) -> DataFrame:
    """Redistribute a scan of few files over all cores, by columns that identify a row.

    Meant right after a scan whose rows are costly to work on (long texts, unsplittable files). A scan
    that already has a partition per core is returned as it is and not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *columns) if df.rdd.getNumPartitions() < cores else df


def short_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH, size: int = BYTES_PER_BATCH) -> None:
    """Let Arrow batches of this session hold at most ``rows`` rows and ``size`` bytes: texts may be very long, rows alone bound nothing."""
    for key, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{key}"
        text = spark.conf.get(key)
        now = int(text) if text.lstrip("-").isdigit() else most + 1
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))
