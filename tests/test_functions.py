import random

import pytest
from pyspark.sql import functions as F

from platewise.functions.numeric import paired_total, round_binary_half_even
from platewise.functions.text import (
    base_name, base_sample_id, clean_name, decode_rank, expand_template, format_runtime, glob_to_regex, parent_dir,
    parse_elapsed, parse_skip_list,
)


def test_rounding_is_that_of_the_binary_value(spark):
    random.seed(7)
    values = [12.25, 12.35, 0.15, 2.5, 3.5, -12.25, -12.35, 0.0, 0.005, 0.0005, 1e-9, 99.95, 100.0, 1e6 + 0.25, 2**42 + 0.5]
    values += [random.randint(0, 10**6) / 1000 for _ in range(3000)] + [random.uniform(-500, 500) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", *[round_binary_half_even("v", n).alias(f"d{n}") for n in range(4)]).collect()
    for row in got:
        for n in range(4):
            assert row[f"d{n}"] == round(row["v"], n), (row["v"], n)


def test_rounding_keeps_missing_and_special(spark):
    df = spark.sql("SELECT * FROM VALUES (CAST(NULL AS DOUBLE)), (double('NaN')), (double('Infinity')) t(v)")
    got = [r[0] for r in df.select(round_binary_half_even("v", 1)).collect()]
    assert got[0] is None and got[1] != got[1] and got[2] == float("inf")
    with pytest.raises(ValueError):
        round_binary_half_even("v", 4)


def test_format_runtime(spark):
    wanted = {
        0.0: "0.0 seconds", 3.25: "3.2 seconds", 29.3: "29.3 seconds", 59.94: "59.9 seconds", 59.96: "60.0 seconds", 60.0: "1m 0.0s",
        61.25: "1m 1.2s", 3599.99: "59m 60.0s", 3600.0: "1h 0m 0.0s", 3661.5: "1h 1m 1.5s", 7325.75: "2h 2m 5.8s", 100000.05: "27h 46m 40.1s",
    }
    df = spark.createDataFrame([(v,) for v in wanted], "v double")
    assert [r[0] for r in df.select(format_runtime("v")).collect()] == list(wanted.values())


def test_elapsed(spark):
    df = spark.createDataFrame([("0:10.00",), ("1:02:03",), ("4:05.50",)], "t string")
    assert [r[0] for r in df.select(parse_elapsed(F.col("t"))).collect()] == [10.0, 3723.0, 245.5]


def test_names_and_keys(spark):
    df = spark.createDataFrame([("a_processed_R1_processed_R2", "\t  Klebsiella \r", "G1")], "k string, n string, r string")
    row = df.select(
        base_sample_id(F.col("k")).alias("k"), clean_name(F.col("n")).alias("n"), decode_rank(F.col("r")).alias("r"),
        decode_rank(F.lit("S")).alias("s"), paired_total(F.lit(10.9)).alias("p"),
    ).first()
    assert (row.k, row.n, row.r, row.s, row.p) == ("a", "Klebsiella", None, "Species", 20)


def test_skip_list(spark):
    df = spark.createDataFrame([("NEG, a,,b",), (None,), (" , ",)], "s string")
    assert [r[0] for r in df.select(parse_skip_list(F.col("s"))).collect()] == [["NEG", "a", "b"], [], []]


def test_template_keeps_unknown_and_missing_names(spark):
    df = spark.createDataFrame([("{rundir}/{sample_id}/{input_dir}/{x}", "/d", "S1", None)], "t string, d string, s string, i string")
    got = df.select(expand_template(F.col("t"), {"rundir": F.col("d"), "sample_id": F.col("s"), "input_dir": F.col("i")}))
    assert got.first()[0] == "/d/S1/{input_dir}/{x}"


@pytest.mark.parametrize("pattern,name,expected", [
    ("a*.html", "a1_fastqc.html", True), ("a*.html", "b1.html", False), ("a?c", "abc", True), ("a?c", "abbc", False),
    ("a.c", "abc", False), ("x[12].t", "x1.t", True), ("x[!12].t", "x1.t", False), ("x[.t", "x[.t", True),
    ("(a)+|{b}$*", "(a)+|{b}$z", True), ("*", "any", True), ("a\\b*", "a\\bc", True),
])
def test_glob(spark, pattern, name, expected):
    df = spark.createDataFrame([(pattern, name)], "p string, n string")
    assert df.select(F.rlike("n", glob_to_regex(F.col("p")))).first()[0] is expected


def test_path_parts(spark):
    df = spark.createDataFrame([("/a/b/c.txt",), ("c.txt",), ("/c",)], "p string")
    assert [tuple(r) for r in df.select(parent_dir(F.col("p")), base_name(F.col("p"))).collect()] == [
        ("/a/b", "c.txt"), ("", "c.txt"), ("", "c")
    ]
