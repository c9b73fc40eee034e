"""FASTQ files in pieces: the same rows whatever the split size, format and layout of the blocks."""

import gzip
import os
import random

import pytest

from platewise.sources import fastq
from platewise.sources.artifacts import list_artifacts
from platewise.sources.fastq import bgzf_block, read_fastq_pairs, write_fastq_pairs

SCHEMA = "run_id string, sample_id string, lane string, read_id string, seq1 string, qual1 string, seq2 string, qual2 string"


def records(seed, n, longest):
    """Reads of very different lengths; qualities begin with any symbol, '@' and '+' too."""
    draw = random.Random(seed)

    def one():
        size = draw.choice([0, 1, 5, longest, draw.randrange(longest + 1)])
        return "".join(draw.choices("ACGTN", k=size)), "".join(draw.choices("@+I#5", k=size))

    return [(f"r{k}", *one(), *one()) for k in range(n)]


def text(rows, mate, ending="\n", final=True):
    out = ending.join(line for r in rows for line in (f"@{r[0]}/{mate} extra {mate}", r[2 * mate - 1], "+" + r[0], r[2 * mate]))
    return (out + (ending if final and out else "")).encode()


def blocked(data, seed):
    """BGZF with blocks of all sizes, empty ones and contents that look like block headers included."""
    draw, out, at = random.Random(seed), b"", 0
    while at < len(data):
        size = draw.choice([0, 1, 7, 300, 2000])
        out += bgzf_block(data[at:at + size])
        at += size
    return out + bgzf_block(b"")


def put(folder, name, one, two):
    os.makedirs(folder, exist_ok=True)
    for mate, data in (("R1", one), ("R2", two)):
        with open(f"{folder}/{name.format(mate)}", "wb") as f:
            f.write(data)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("reads"))
    expected = []
    shapes = {
        "plain": ("{}.fastq", lambda d, s: d), "unix": ("{}.fq", lambda d, s: d), "blocks": ("{}.fastq.gz", blocked),
        "whole": ("{}.fq.gz", lambda d, s: gzip.compress(d[:len(d) // 2]) + gzip.compress(d[len(d) // 2:])),
    }
    for k, (sample, (ending, pack)) in enumerate(shapes.items()):
        rows = records(k, 400, 90)
        line_end, final = ("\r\n", True) if sample == "plain" else ("\n", sample != "unix")
        put(folder, f"{sample}_L001_{ending}", *(pack(text(rows, m, line_end, final), k + m) for m in (1, 2)))
        expected += [("run", sample, "L001", *r) for r in rows]
    put(folder, "empty_{}.fastq", b"", b"")
    put(folder, "none_{}.fastq.gz", bgzf_block(b""), gzip.compress(b""))
    return folder, sorted(expected)


@pytest.mark.parametrize("split", [97, 1000, 12_345, 1 << 25])
def test_split_sizes(spark, files, split):
    folder, expected = files
    reads = read_fastq_pairs(spark, folder, run_id="run", split_bytes=split)
    assert sorted(tuple(r) for r in reads.collect()) == expected
    if split == 1000:
        # One file is read by many tasks.
        parts = reads.selectExpr("sample_id", "spark_partition_id() AS p").distinct().groupBy("sample_id").count().collect()
        counts = {r["sample_id"]: r["count"] for r in parts}
        assert counts["plain"] > 5 and counts["unix"] > 5 and counts["blocks"] > 5 and counts["whole"] == 1


def test_small_buffers(spark, files, monkeypatch):
    """Records and blocks that cross buffers."""
    monkeypatch.setattr(fastq, "_BUFFER", 61)
    folder, expected = files
    reads = read_fastq_pairs(spark, folder, run_id="run", split_bytes=5000)
    assert sorted(tuple(r) for r in reads.collect()) == expected


def test_format_reader(spark, files):
    folder, expected = files
    spark.dataSource.register(fastq.FastqPairs)
    reads = spark.read.format("fastq_pairs").option("run_id", "run").load(folder)
    assert sorted(tuple(r) for r in reads.collect()) == expected


def test_first_block_is_found_everywhere(tmp_path):
    """From any offset the next block's beginning is found, also past bytes that look like one."""
    import pyarrow as pa

    fake = bgzf_block(b"x")[:18]
    starts, data = [], b""
    for content in (b"abc", fake * 50, b"", b"y" * 60_000, fake):
        starts.append(len(data))
        # Stored, not deflated: the fake headers are there byte for byte.
        data += bgzf_block(content) if len(content) < 900 else bgzf_block(content)
    path = tmp_path / "f.gz"
    path.write_bytes(data)
    with pa.OSFile(str(path)) as stream:
        for at in [*range(0, 150), *range(len(data) - 60, len(data))]:
            later = [s for s in starts if s >= at]
            assert fastq._first_block(stream, at, len(data)) == (later[0] if later else None)


@pytest.mark.parametrize("second,message", [
    (lambda rows: text(rows[:-1], 2), "mates out of step"), (lambda rows: text([*rows, ("more", "", "", "A", "I")], 2), "mates out of step"),
    (lambda rows: text(rows[1:] + rows[:1], 2), "mates out of step"), (lambda rows: text(rows, 2)[:-30] + b"\n", "broken read record|mates out of step"),
    (lambda rows: text(rows, 2) + b"\n", "broken read record"), (lambda rows: text(rows, 2).replace(b"@r7/", b"xr7/"), "broken read record"),
    (lambda rows: text(rows, 2).replace(b"r9/2 extra", "r9/2 é".encode()), "broken read record"),
])
@pytest.mark.parametrize("split", [300, 1 << 25])
def test_errors(spark, tmp_path, second, message, split):
    rows = records(3, 40, 30)
    put(str(tmp_path), "S1_{}.fastq", text(rows, 1), second(rows))
    with pytest.raises(Exception, match=message):
        read_fastq_pairs(spark, str(tmp_path), split_bytes=split).collect()


def test_damaged_block(spark, tmp_path):
    rows = records(3, 400, 90)
    data = bytearray(blocked(text(rows, 1), 1))
    data[len(data) // 2] ^= 1
    put(str(tmp_path), "S1_{}.fastq.gz", bytes(data), blocked(text(rows, 2), 1))
    with pytest.raises(Exception, match="broken block"):
        read_fastq_pairs(spark, str(tmp_path)).collect()


def test_written_files_are_blocked(spark, tmp_path):
    """What the writer leaves is gzip for any reader, and splits; a sample's rows in many batches and tasks make one file per task."""
    rows = [("run", f"S{k % 3}", "", *r) for k, r in enumerate(records(5, 3000, 600))]
    write_fastq_pairs(spark.createDataFrame(rows, SCHEMA).repartition(2), f"{tmp_path}/out")
    names = sorted(os.listdir(f"{tmp_path}/out"))
    assert len(names) == 3 * 2 * 2 and not [n for n in names if "draft" in n]
    with gzip.open(f"{tmp_path}/out/{names[0]}", "rt") as f:
        assert len(f.readlines()) % 4 == 0
    back = read_fastq_pairs(spark, f"{tmp_path}/out", run_id="run", split_bytes=20_000)
    assert sorted((r[1], *r[3:]) for r in back.collect()) == sorted((r[1], *r[3:]) for r in rows)
    assert back.rdd.getNumPartitions() > 12


def test_line_counts_are_spread(spark, files):
    """Cuts are few small rows with much work: adaptive execution must not put them into one task."""
    named = list_artifacts(spark, files[0]).selectExpr("'/' AS root", "path", "length")
    cuts = fastq.file_cuts(named, 1000)
    plan = cuts._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "REPARTITION_BY_COL" not in plan
    assert cuts.groupBy("path").agg({"n_lines": "max"}).count() == 12
