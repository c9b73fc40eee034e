import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from platewise.operators import hooks
from platewise.streaming.progress import read_progress, stream_progress, write_progress


def test_per_sample_sees_every_row_once(spark, rows):
    def partial(key, part):
        return pd.DataFrame({"run_id": [key[0]], "sample_id": [key[1]], "n": [len(part)], "top": [part["v"].max()]})

    data = [("r", "hot" if i % 3 else f"S{i % 5}", float(i)) for i in range(3000)]
    df = spark.createDataFrame(data, "run_id string, sample_id string, v double").repartition(6)
    for at_once in (50, 200_000):
        got = hooks.per_sample(
            df, partial, "run_id string, sample_id string, n bigint, top double",
            lambda parts: parts.groupBy("run_id", "sample_id").agg(F.sum("n").alias("n"), F.max("top").alias("top")),
            rows_at_once=at_once,
        )
        expected = {}
        for run, sample, v in data:
            n, top = expected.get((run, sample), (0, v))
            expected[run, sample] = (n + 1, max(top, v))
        assert rows(got) == sorted((*k, *v) for k, v in expected.items())


def test_per_sample_calls_grow_with_the_samples(spark, rows):
    """Rows of a sample that lie far apart meet in few calls; results whose types differ are not mixed up."""
    def partial(key, part):
        big = 2**53 + 1
        return pd.DataFrame({"run_id": [key[0]], "sample_id": [key[1]], "n": [len(part)], "calls": [1], "big": [big if key[1] != "S7" else None]})

    data = [("r", f"S{i % 300}") for i in range(6000)]
    df = spark.createDataFrame(data, "run_id string, sample_id string").repartition(6)
    schema = "run_id string, sample_id string, n bigint, calls bigint, big bigint"
    got = hooks.per_sample(df, partial, schema, lambda parts: parts.groupBy("sample_id").agg(
        F.sum("n").alias("n"), F.sum("calls").alias("calls"), F.max("big").alias("big"))).collect()
    assert len(got) == 300 and {r["n"] for r in got} == {20}
    assert {r["sample_id"]: r["big"] for r in got} == {s: None if s == "S7" else 2**53 + 1 for _, s in data}
    assert sum(r["calls"] for r in got) <= 310


@pytest.mark.parametrize("size", [1, 200, 4 << 20])
def test_each_sample_streams_through_all_rows(spark, rows, size):
    """Medians from rows in order, one sample with most of them, nulls as keys, frames of bounded size."""
    data = [("r", None if i % 97 == 0 else "hot" if i % 3 else f"S{i % 5}", (i * 7919) % 1000, "x" * (i % 50)) for i in range(3000)]

    def median(key, parts):
        values, frames = [], 0
        for part in parts:
            assert len(part) == 1 or size > 1
            values += part["v"].tolist()
            frames += 1
        assert values == sorted(values)
        yield pd.DataFrame({"sample_id": [key[1]], "run_id": [key[0]], "n": [len(values)], "middle": [values[len(values) // 2]], "frames": [frames]})

    df = spark.createDataFrame(data, "run_id string, sample_id string, v bigint, pad string").repartition(6)
    got = hooks.each_sample(df, median, "run_id string, sample_id string, n bigint, middle bigint, frames bigint", order=["v"], bytes_at_once=size)
    expected = {}
    for run, sample, v, _ in data:
        expected.setdefault((run, sample), []).append(v)
    assert rows(got.drop("frames")) == rows(spark.createDataFrame([(*k, len(v), sorted(v)[len(v) // 2]) for k, v in expected.items()], "run_id string, sample_id string, n bigint, middle bigint"))
    if size == 200:
        assert max(r.frames for r in got.collect()) > 20


def test_each_sample_may_stop_early(spark, rows):
    def first(key, parts):
        yield next(parts).head(1)[["run_id", "sample_id", "v"]]

    df = spark.createDataFrame([("r", f"S{i % 3}", i) for i in range(3000)], "run_id string, sample_id string, v bigint").repartition(1)
    got = hooks.each_sample(df, first, "run_id string, sample_id string, v bigint", order=["v"], bytes_at_once=500)
    assert rows(got) == [("r", "S0", 0), ("r", "S1", 1), ("r", "S2", 2)]
    assert hooks.each_sample(df.limit(0), first, "run_id string, sample_id string, v bigint").collect() == []


def test_batch(spark):
    assert hooks.batch(spark.range(5), lambda df: df.agg(F.sum("id"))).first()[0] == 10


def test_progress_counts_each_row_once(spark, tmp_path, rows):
    t0 = dt.datetime(2025, 1, 1)
    schema = "id bigint, run_id string, tool string, status string, ts timestamp"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/in")
    arriving = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    progress = stream_progress(arriving, ["id"])
    expected = {}
    for step in range(3):
        # each step is three hours older than the one before
        new = [(i, "r", "trim", "completed" if i % 4 else "failed", t0 + dt.timedelta(minutes=i, hours=-3 * step)) for i in range(step * 10, step * 10 + 10)]
        again = new[:3]
        spark.createDataFrame(new + again, schema).write.mode("append").parquet(f"{tmp_path}/in")
        for _, run, tool, status, _ in new:
            expected[run, tool, status] = expected.get((run, tool, status), 0) + 1
        write_progress(progress, f"{tmp_path}/out", f"{tmp_path}/state")
        assert rows(read_progress(spark, f"{tmp_path}/out")) == sorted((*k, n) for k, n in expected.items())
