import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from platewise import schemas
from platewise.functions import sequence
from platewise.operators import reads as rd

ADAPTER = "AGATCGGAAGAGCACACGTC"


def make_pairs(n=250, seed=3):
    random.seed(seed)

    def mate():
        length = random.choice([0, 1, 3, 4, 60, 99, 100, 101, 150, 150, 150])
        seq = "".join(random.choice("ACGTN") for _ in range(length))
        qual = [random.choice([2, 38, 38, 38, 38, 30, 25, 19]) if random.random() < 0.15 else random.randint(24, 40) for _ in range(length)]
        for i in range(random.randint(0, 4)):
            if i < length:
                qual[i] = 2
                qual[-1 - i] = 2
        if length == 150 and random.random() < 0.5:
            at, tail = random.randint(0, 130), list(ADAPTER)
            for i in random.sample(range(16), random.randint(0, 3)):
                tail[i] = "N"
            seq = (seq[:at] + "".join(tail) + seq[at:])[:150]
        return seq, "".join(chr(33 + q) for q in qual)

    return [("r", f"S{i % 3}", "", f"x{i}", *mate(), *mate()) for i in range(n)]


@pytest.fixture(scope="module")
def pairs():
    return make_pairs()


@pytest.fixture
def reads(spark, pairs):
    return spark.createDataFrame(pairs, schemas.READS)


def brute_trim(seq, qual, adapters=()):
    scores = [ord(c) - 33 for c in qual]
    lo, hi = 0, len(seq)
    while lo < hi and scores[lo] < 3:
        lo += 1
    while hi > lo and scores[hi - 1] < 3:
        hi -= 1
    for i in range(lo, hi - 3):
        if sum(scores[i:i + 4]) / 4 < 20:
            hi = i
            break
    if hi - lo < 100:
        return "", ""
    seq, qual = seq[lo:hi], qual[lo:hi]
    starts = [
        i for a in adapters for i in range(len(seq) - min(len(a), 16) + 1)
        if sum(x != y for x, y in zip(seq[i:i + 16], a[:16])) <= 2 * min(len(a), 16) // 16
    ]
    cut = min(starts, default=len(seq))
    return seq[:cut], qual[:cut]


@pytest.mark.parametrize("adapters", [[], [ADAPTER], [ADAPTER, "N" * 16, "TOOSHORT"], [ADAPTER[:14]], [ADAPTER[:8], ADAPTER + "ACGTACGT"]])
def test_trim_equals_brute_force(reads, pairs, adapters):
    got = {r.read_id: r for r in rd.trim_reads(reads, adapters).collect()}
    classes = set()
    for _, _, _, name, s1, q1, s2, q2 in pairs:
        first, second = brute_trim(s1, q1, adapters), brute_trim(s2, q2, adapters)
        row = got[name]
        assert ((row.seq1, row.qual1), (row.seq2, row.qual2)) == (first, second), name
        expected = {(1, 1): "paired", (1, 0): "unpaired_r1", (0, 1): "unpaired_r2", (0, 0): "dropped"}
        assert row.survivor == expected[bool(first[0]), bool(second[0])]
        classes.add(row.survivor)
    assert len(classes) == 4


def test_edges_of_the_length_limit(spark):
    good = lambda n: ("A" * n, "I" * n)
    data = [("r", "S", "", str(n), *good(n), *good(100)) for n in (99, 100)]
    got = {r.read_id: r.survivor for r in rd.trim_reads(spark.createDataFrame(data, schemas.READS)).collect()}
    assert got == {"99": "unpaired_r2", "100": "paired"}


def test_survival_shares(reads):
    rows = rd.trim_survival(rd.trim_reads(reads)).collect()
    for r in rows:
        assert r.paired + r.unpaired_r1 + r.unpaired_r2 + r.dropped == r.pairs
        assert r.surviving_pct == r.paired / r.pairs * 100
    assert sum(r.pairs for r in rows) == reads.count() == sum(r.pairs for r in rd.pair_count(reads).collect())


def order_key(seed, lane, read_id):
    text = f"{seed}:{lane}:{read_id}"
    return hashlib.md5(text.encode()).hexdigest(), text


@pytest.mark.parametrize("bits", [4, 12])
def test_subsample_keeps_exactly_n_of_large_samples(spark, bits):
    # one sample holds most rows; others sit at and just above the threshold
    sizes = {"hot": 4000, "n": 100, "n1": 101, "n2": 102, "few": 5}
    data = [("r", s, f"L{i % 2}", f"{s}-{i}") for s, size in sizes.items() for i in range(size)]
    df = spark.createDataFrame(data, "run_id string, sample_id string, lane string, read_id string")
    expected = set()
    for sample, size in sizes.items():
        mine = sorted((d for d in data if d[1] == sample), key=lambda d: order_key(7, d[2], d[3]))
        expected |= set(mine if size <= 101 else mine[:100])
    for shuffled in (df, df.repartition(7, "read_id")):
        got = [tuple(r) for r in rd.subsample_pairs(shuffled, n=100, min_pairs=101, seed=7, bits=bits).collect()]
        assert len(got) == len(set(got)) and set(got) == expected


def test_subsample_without_large_samples_keeps_all(spark, reads):
    assert rd.subsample_pairs(reads, n=1000, min_pairs=1001).exceptAll(reads).isEmpty()
    assert rd.subsample_pairs(reads, n=1000, min_pairs=1001).count() == reads.count()


def test_read_stats(reads, pairs):
    for r in rd.read_stats(reads).collect():
        at = 4 if r.mate == "R1" else 6
        mine = [p[at] for p in pairs if p[1] == r.sample_id and p[at]]
        assert r.total_sequences == len(mine)
        assert r.percent_gc == pytest.approx(100 * sum(s.count("G") + s.count("C") for s in mine) / sum(map(len, mine)))
        assert r.avg_sequence_length == pytest.approx(sum(map(len, mine)) / len(mine))


def test_lengths_and_duplicates(spark, pairs):
    data = pairs + [("r", "S0", "", f"copy{i}", "ACGT" * 20, "I" * 80, "G", "I") for i in range(500)]
    reads = spark.createDataFrame(data, schemas.READS)
    for r in rd.length_histogram(reads).collect():
        at = 4 if r.mate == "R1" else 6
        assert r.n_reads == sum(p[1] == r.sample_id and len(p[at]) == r.read_length for p in data)
    for r in rd.duplicate_reads(reads).collect():
        at = 4 if r.mate == "R1" else 6
        mine = [p[at] for p in data if p[1] == r.sample_id]
        assert (r.n_reads, r.n_distinct) == (len(mine), len(set(mine)))
        assert r.duplicate_pct == pytest.approx(100 * (len(mine) - len(set(mine))) / len(mine))


@pytest.mark.parametrize("bin_width", [1, 10])
def test_position_profile(reads, pairs, bin_width):
    cells = {}
    for p in pairs:
        for mate, seq, qual in (("R1", p[4], p[5]), ("R2", p[6], p[7])):
            for i, (b, q) in enumerate(zip(seq, qual)):
                cells.setdefault((p[1], mate, i // bin_width * bin_width), []).append((b, ord(q) - 33))
    got = rd.position_profile(rd.position_counts(reads, bin_width)).collect()
    assert {(r.sample_id, r.mate, r.pos) for r in got} == set(cells)
    for r in got:
        mine = cells[r.sample_id, r.mate, r.pos]
        scores = sorted(q for _, q in mine)
        assert r.depth == len(mine) and r.mean_quality == pytest.approx(sum(scores) / len(scores))
        for share, value in ((0.25, r.q1_quality), (0.5, r.median_quality), (0.75, r.q3_quality)):
            assert value == next(q for n, q in enumerate(scores, 1) if n >= share * len(scores))
        assert r.pct_N == pytest.approx(100 * sum(b not in "ACGT" for b, _ in mine) / len(mine))
        assert r.pct_A == pytest.approx(100 * sum(b == "A" for b, _ in mine) / len(mine))


def test_position_counts_work_in_slices(reads, monkeypatch, rows):
    whole = rows(rd.position_counts(reads))
    from platewise.functions import sequence

    monkeypatch.setattr(sequence, "BASES_AT_ONCE", 500)
    assert rows(rd.position_counts(reads.coalesce(1))) == whole


def test_module_status(spark):
    data = [("r", s, "R1", pos, q) for s, scores in {"ok": (30, 28), "mid": (30, 24), "bad": (30, 19)}.items() for pos, q in enumerate(scores)]
    profile = spark.createDataFrame(data, "run_id string, sample_id string, mate string, pos int, median_quality int")
    assert {r.sample_id: r.status for r in rd.module_status(profile).collect()} == {"ok": "pass", "mid": "warn", "bad": "fail"}


def test_lanes_and_matrix(spark, reads, rows):
    halves = [reads.where("sample_id = 'S0'"), reads.where("sample_id <> 'S0'")]
    assert rd.union_lanes(halves).exceptAll(reads).isEmpty()
    long = spark.createDataFrame([("r", "a", "x", 1.0), ("r", "a", "y", 2.0), ("r", "b", "x", 3.0)], "run_id string, sample_id string, metric string, value double")
    assert rows(rd.metric_matrix(long, ["x", "y"])) == [("r", "a", 1.0, 2.0), ("r", "b", 3.0, None)]


@pytest.mark.parametrize("seq,qual", [("ACG", "II"), ("ACG", "I I"), ("AC", "I\x7f"), ("A", None)])
def test_bad_qualities_are_errors(seq, qual):
    with pytest.raises(ValueError):
        list(sequence.count_cells(pd.Series(["A", seq]), pd.Series(["I", qual]), np.array([0, 0]), 1))


@pytest.mark.parametrize("copies", [1, 400])
def test_cells_counted_or_sorted_are_the_same(copies):
    seqs, quals, groups = ["ACGTN", "ac", "", "TT"] * copies, ["IIJ!~", "#I", "", "II"] * copies, np.array([0, 1, 0, 1] * copies)
    got = {(g, int(c)): int(n) for g, cells, counts in sequence.count_cells(pd.Series(seqs), pd.Series(quals), groups, 1) for c, n in zip(cells, counts)}
    wanted = Counter()
    for s, q, g in zip(seqs, quals, groups.tolist()):
        wanted.update((g, (i * 5 + "ACGTN".index(b.upper())) * 94 + ord(c) - 33) for i, (b, c) in enumerate(zip(s, q)))
    assert got == wanted


def test_trimming_bounds_the_bytes_of_a_batch(spark):
    """Long qualities go to Python in batches of bounded bytes."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    spark.conf.unset(key)
    try:
        data = [("r", "S", "", str(n), "A" * 50_000, "I" * 50_000, "C" * 10, "I" * 10) for n in range(300)]
        reads = spark.createDataFrame(data, "run_id string, sample_id string, lane string, read_id string, seq1 string, qual1 string, seq2 string, qual2 string")
        trimmed = rd.trim_reads(reads)
        assert 0 < int(spark.conf.get(key)) <= 4 << 20
        assert trimmed.where("length(seq1) = 50000 AND survivor = 'unpaired_r1'").count() == 300
    finally:
        spark.conf.set(key, old)


@pytest.mark.parametrize("size", [1, 5, 40])
def test_window_cut_in_pieces(spark, monkeypatch, size):
    """Reads longer than what is summed at once, and empty and short ones, are cut as before."""
    draw = random.Random(size)
    quals = ["".join(chr(33 + draw.choice((5, 20, 20, 30))) for _ in range(n)) for n in (0, 1, 3, 4, 5, 9, 30, 39, 40, 41, 100)] + ["I" * 90, None]

    def expected(q):
        fails = [k for k in range(len(q) - 3) if sum(ord(c) - 33 for c in q[k:k + 4]) < 80]
        return fails[0] if fails else len(q)

    monkeypatch.setattr(sequence, "SCORES_AT_ONCE", size)
    for q in quals:
        assert sequence._first_failing_of_one(q or "", 4, 20) == expected(q or "")
    frame = spark.createDataFrame(list(enumerate(quals)), "n int, q string")
    assert {r["n"]: r["k"] for r in frame.select("n", sequence.window_cut(F.col("q"), 4, 20).alias("k")).collect()} == {n: expected(q or "") for n, q in enumerate(quals)}
