"""Pattern automata against fnmatch, and the presence of outputs as one join."""

import fnmatch
import random
import time

import pytest
from pyspark.sql import functions as F

from platewise import schemas
from platewise.operators import accounting as acc
from platewise.operators import globs
from platewise.session import bucketed


def random_globs(seed, n):
    draw = random.Random(seed)
    bits = ["a", "b", "ab", "x_", "*", "**", "?", "[ab]", "[!a]", "[a-c]", "[]b]", "[!]a]", "[", "[]", "]", "[a-]", "[c-a]", ".", "é", "[!", "[-a]"]
    return ["".join(draw.choices(bits, k=draw.randrange(6))) for _ in range(n)]


def random_names(seed, n):
    draw = random.Random(seed)
    return ["".join(draw.choices(["a", "b", "c", "x_", "]", "[", "-", ".", "é", "!", "\n"], k=draw.randrange(8))) for _ in range(n)]


@pytest.mark.parametrize("states", [globs.STATES, 3])
def test_automaton(states):
    patterns, names = random_globs(1, 400), random_names(2, 600)
    automaton = globs.PatternAutomaton(patterns, states)
    for name in names:
        want = {k for k, p in enumerate(patterns) if fnmatch.fnmatchcase(name, p)}
        assert set(automaton.matches(name)) == want, name


def test_shared_pieces_cost_the_files_only():
    """A hundred thousand patterns that share all their pieces but one."""
    patterns = [f"*_{k}_*" for k in range(100_000)]
    automaton = globs.PatternAutomaton(patterns)
    names = [f"r{k}_{k % 7}_{k}_x.out" for k in range(20_000)]
    start = time.time()
    for k, name in enumerate(names):
        assert set(automaton.matches(name)) == {k % 7, k}
    assert time.time() - start < 20


@pytest.mark.parametrize("block,names", [(globs.BLOCK, globs.NAMES), (3, 5)])
def test_folders(spark, rows, monkeypatch, block, names):
    """Many folders, one of them crowded, patterns with and without classes, repeated patterns and files; blocks and salts."""
    monkeypatch.setattr(globs, "BLOCK", block)
    monkeypatch.setattr(globs, "NAMES", names)
    draw = random.Random(3)
    folder = ["/d", "/d", "/d", "/e/f", "", "rel", "/lonely"]
    patterns = [f"{draw.choice(folder)}/{g}" for g in random_globs(4, 80)] + ["*a", "a?", "/d/*", "/d/*"]
    files = [f"{draw.choice(folder[:-1])}/{n}" for n in random_names(5, 200) if n] + ["ba", "/d/a", "/d/a"]

    def parts(path):
        return path.rsplit("/", 1) if "/" in path else ("", path)

    want = {p for p in patterns for f in files if parts(f)[0] == parts(p)[0] and fnmatch.fnmatchcase(parts(f)[1], parts(p)[1])}
    got = globs.glob_match(spark.createDataFrame([(p,) for p in patterns], "pattern string"), spark.createDataFrame([(f, 1) for f in files], schemas.ARTIFACTS))
    assert sorted(r[0] for r in got.collect()) == sorted(want)
    assert globs.glob_match(spark.createDataFrame([], "pattern string"), spark.createDataFrame([], schemas.ARTIFACTS)).collect() == []


MANIFEST = "run_id string, path string"


def test_presence(spark, rows):
    manifest = spark.createDataFrame([("r", p) for p in ("/d/a", "/d/b", "/d/*x", "/d/?", "/d/[ab]?", "/d/a", None)], MANIFEST)
    artifacts = spark.createDataFrame([("/d/a", 1), ("/d/a", 2), ("/d/yx", 0), (None, 1)], schemas.ARTIFACTS)
    want = [("r", "/d/*x", True), ("r", "/d/?", True), ("r", "/d/[ab]?", False), ("r", "/d/a", True), ("r", "/d/a", True), ("r", "/d/b", False), ("r", None, False)]
    assert rows(acc.with_presence(manifest, artifacts)) == rows(acc.presence_index(manifest, artifacts)) == want
    assert len(rows(acc.pending_outputs(manifest, artifacts))) == 3 and len(rows(acc.existing_outputs(manifest, artifacts))) == 4


def exchanges(df):
    # final plan: what ran, without the plan it started from
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def test_bucketed_sides_meet_without_a_shuffle(spark):
    """Once kept by path, neither side is shuffled again; a plain side is shuffled alone."""
    left = bucketed(spark.range(1000).select(F.concat(F.lit("/p"), "id").alias("path"), "id"), "path")
    right = bucketed(spark.range(0, 1000, 3).select(F.concat(F.lit("/p"), "id").alias("path"), F.lit(True).alias("there")), "path")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(left.join(right, "path", "left")) == 0
        assert exchanges(left.join(spark.range(9).select(F.concat(F.lit("/p"), "id").alias("path")).distinct(), "path", "left_semi")) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert left.join(right, "path").count() == 334
