"""Existing files and the samples their names announce."""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatchcase
from functools import reduce

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from platewise.functions.text import base_name, parent_dir
from platewise.session import broadcast_if_small, checkpointed

#: Entries of a batch, and tasks of a round.
LISTED, MAX_TASKS = 10_000, 10_000
READ_FILE = r"^(.+?)(?:_(L\d{3,}))?_(R[12])\.(?:fastq|fq)(?:\.gz)?$"


def open_root(root: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a folder given as a path or as a URI."""
    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


def list_artifacts(spark: SparkSession, root: str | list[str], glob: str | None = None) -> DataFrame:
    """Files below ``root`` as ``path, length`` (paths without scheme), empty ones included; contents are not read.

    The tree is listed level by level: each round lists the folders that the round before found, spread over tasks, so a deep or
    lopsided tree, all of it below one folder say, keeps many tasks busy. There are as many rounds as the tree is deep; a round's entries are
    stored, and leave their task in batches of ``LISTED``.
    """
    level = "root string, path string, length bigint, is_file boolean"
    at_once = LISTED

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, path in zip(batch["root"], batch["path"]):
                found = open_root(uri)[0].get_file_info(fs.FileSelector(path, recursive=False))
                for start in range(0, len(found), at_once):
                    rows = [
                        (uri, i.path, i.size or 0, i.is_file) for i in found[start:start + at_once]
                        if not i.is_file or glob is None or fnmatchcase(i.base_name, glob)
                    ]
                    yield pd.DataFrame(rows, columns=["root", "path", "length", "is_file"])

    roots = [(uri, open_root(uri)[1]) for uri in ([root] if isinstance(root, str) else root)]
    frontier, tasks, levels = spark.createDataFrame(roots, "root string, path string"), len(roots), []
    while tasks:
        found = checkpointed(frontier.repartition(min(tasks, MAX_TASKS), "path").mapInPandas(entries, level))
        levels.append(found.where("is_file").select("path", "length"))
        frontier = found.where(~F.col("is_file")).select("root", "path")
        tasks = frontier.count()
    return reduce(DataFrame.unionByName, levels)


def discover_samples(artifacts: DataFrame, run_id: str = "", run_pattern: str | None = None) -> DataFrame:
    """The samples that first-mate file names announce, as a sheet: ``run_id, sample_ord, sample_id``.

    Ids follow the rule of ``lane_files``, which ``read_fastq_pairs`` keeps too: all lanes and folders of an id are one sample.
    The run is ``run_id``, or group 1 of ``run_pattern`` in the path. Samples of a run are numbered from 0 by their ids.
    """
    run = F.regexp_extract("path", run_pattern, 1) if run_pattern else F.lit(run_id)
    ids = lane_files(artifacts).where(F.col("mate") == "R1").select(run.alias("run_id"), "sample_id").distinct()
    place = F.row_number().over(Window.partitionBy("run_id").orderBy("sample_id")) - 1
    return ids.select("run_id", place.cast("long").alias("sample_ord"), "sample_id")


def lane_files(artifacts: DataFrame) -> DataFrame:
    """Read files with their sample, lane and mate: an exact sample id and an optional ``_L001`` lane."""
    name = base_name(F.col("path"))
    return artifacts.where(name.rlike(READ_FILE)).select(
        "path",
        F.regexp_extract(name, READ_FILE, 1).alias("sample_id"),
        F.regexp_extract(name, READ_FILE, 2).alias("lane"),
        F.regexp_extract(name, READ_FILE, 3).alias("mate"),
    )


def concat_lanes(reads: DataFrame, samples: DataFrame, prefix: bool = False) -> DataFrame:
    """The sheet's samples with the reads of all their lanes.

    By default a lane belongs to the sample whose id it names. With ``prefix`` a sample takes every read
    file whose name starts with its id, so S1 also takes the reads of S10. Reads are matched through
    their distinct file stems, a table of the size of the file list.
    """
    ids = samples.select("run_id", "sample_id").distinct()
    if not prefix:
        return reads.join(broadcast_if_small(ids), ["run_id", "sample_id"], "left_semi").select(*reads.columns)
    stems = reads.select("run_id", F.col("sample_id").alias("stem")).distinct()
    starts = stems.withColumn("n", F.explode(F.sequence(F.lit(1), F.length("stem")))).select(
        "run_id", "stem", F.substr("stem", F.lit(1), F.col("n")).alias("sample_id")
    )
    mapping = broadcast_if_small(starts.join(ids, ["run_id", "sample_id"]))
    return (
        reads.withColumnRenamed("sample_id", "stem")
        .join(mapping, ["run_id", "stem"])
        .select(*reads.columns)
    )
