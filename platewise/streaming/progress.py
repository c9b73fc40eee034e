"""Running counts of task outcomes from arriving rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["run_id", "tool", "status"]


def stream_progress(task_runs: DataFrame, id_columns: list[str]) -> DataFrame:
    """Counts per (run, tool, status) over a stream, each id once however late or often its row arrives.

    There is no watermark: logs of other runs arrive hours later, and a cut would leave their rows out. State therefore holds the
    ids of all tasks, spread over the shuffle partitions, and one row per key; keep large histories in the RocksDB state store
    (``spark.sql.streaming.stateStore.providerClass``).
    """
    return task_runs.dropDuplicates(id_columns).groupBy(*KEYS).agg(F.count("*").alias("n"))


def write_progress(progress: DataFrame, path: str, checkpoint: str) -> None:
    """Process what has arrived. Every micro-batch writes the counts it changed under its own batch
    number, so a repeated batch replaces itself."""
    def save(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = (
        progress.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )
    query.awaitTermination()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The newest count of every key."""
    rows = spark.read.option("basePath", path).parquet(path)
    return rows.groupBy(*KEYS).agg(F.max_by("n", "batch_id").alias("n"))
