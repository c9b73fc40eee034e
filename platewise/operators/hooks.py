"""User functions over samples and over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema


def per_sample(
    df: DataFrame,
    partial: Callable[[tuple, pd.DataFrame], pd.DataFrame],
    schema: str,
    combine: Callable[[DataFrame], DataFrame],
    keys: list[str] | None = None,
    rows_at_once: int = 200_000,
) -> DataFrame:
    """Run a user function for every sample.

    ``partial(key, rows)`` sees some of a sample's rows at a time and returns partial results (its key
    columns included) of the given schema; ``combine`` is a DataFrame aggregation that merges them.
    Rows are dealt by sample and sorted by it, so that the calls grow with the samples and not with the rows, and handled at most about
    ``rows_at_once`` at a time. Adaptive execution splits large partitions: a sample that holds most of the data is spread over tasks.
    """
    keys = keys or ["run_id", "sample_id"]

    def results(waiting: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Results of equal types go out as one frame."""
        if waiting:
            found = (partial(key, rows) for key, rows in pd.concat(waiting).groupby(keys, sort=False, dropna=False))
            for _, alike in groupby(found, lambda frame: (tuple(frame.columns), tuple(frame.dtypes))):
                frame = pd.concat(alike)
                # Arrow-backed columns are in chunks now, which Spark does not take
                yield frame.astype({c: object for c, kind in frame.dtypes.items() if isinstance(kind, (pd.StringDtype, pd.ArrowDtype))})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        for batch in batches:
            waiting.append(batch)
            if sum(map(len, waiting)) >= rows_at_once:
                yield from results(waiting)
                waiting = []
        yield from results(waiting)

    return combine(df.hint("rebalance", *keys).sortWithinPartitions(*keys).mapInPandas(run, schema))


def each_sample(
    df: DataFrame,
    fn: Callable[[tuple, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: str,
    keys: list[str] | None = None,
    order: list[str] | None = None,
    bytes_at_once: int = 4 << 20,
) -> DataFrame:
    """Run a user function over all rows of every sample, in ``order``, for functions that have no partial form.

    ``fn(key, parts)`` gets the sample's rows as an iterator of frames of about ``bytes_at_once`` and yields result frames (key columns included). Samples are
    dealt to partitions by key and sorted there, so a task streams through one sample after the other: a sample that holds most of the data
    is one task's work, but never in memory at once. Rows that ``fn`` does not ask for are passed over. A null is a key like any other.
    """
    keys = keys or ["run_id", "sample_id"]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pd.DataFrame]]:
        """Stretches of equal keys, cut to the size."""
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(k)).dictionary_encode() for k in keys]
            codes = np.stack([c.indices.fill_null(-1).to_numpy(zero_copy_only=False) for c in columns])
            edges = [0, *(np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            most = max(1, int(batch.num_rows * bytes_at_once / max(batch.nbytes, 1)))
            for a, b in zip(edges, edges[1:]):
                key = tuple(batch.column(batch.schema.get_field_index(k))[a].as_py() for k in keys)
                for start in range(a, b, most):
                    yield key, batch.slice(start, min(most, b - start)).to_pandas()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in groupby(parts(batches), lambda part: part[0]):
            for result in fn(key, (frame for _, frame in group)):
                yield from pa.Table.from_pandas(result[names], types, preserve_index=False).to_batches()

    empty = df.sparkSession.createDataFrame([], schema)
    names, types = empty.columns, to_arrow_schema(empty.schema)
    return df.repartition(*keys).sortWithinPartitions(*keys, *(order or [])).mapInArrow(run, schema)


def batch(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a user function once over the whole table."""
    return df.transform(fn)
