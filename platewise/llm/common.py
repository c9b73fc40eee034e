"""What the operators of this folder share: words, free column names, stored tables, batch sizes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.session import shared_path, short_batches  # noqa: F401

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def free_name(taken: Iterable[str], base: str) -> str:
    """``base`` with underscores appended until no column of ``taken`` has that name in any case."""
    used = {c.lower() for c in taken}
    while base.lower() in used:
        base += "_"
    return base


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back: computed once, its lineage cut."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Groups of rows with equal keys from batches sorted by them. One group is held from batch to batch, no more."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for x in values:
            change |= x[1:] != x[:-1]
        bounds = [0, *(np.nonzero(change)[0] + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds[:-1], bounds[1:]):
            key = tuple(x[a] for x in values)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` with ``value`` computed once, also where ``body`` uses it per array element."""
    return F.transform(F.array(value), body)[0]


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
