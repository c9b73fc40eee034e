"""Paired FASTQ files, plain, gzip or blocked gzip (BGZF), read in pieces and written as BGZF.

``read_fastq_pairs`` and ``write_fastq_pairs``; ``spark.read.format("fastq_pairs")`` reads the same files, one pair of files per partition.

A record is four lines, whatever they hold, so a record's place in a file is a line number. A first job cuts every file at multiples of ``split_bytes``
and counts the line ends in each cut: of plain files by bytes, of BGZF files by the blocks that begin there; other gzip files are one cut. The counts
before a cut tell which record begins in it, in the mate's file too, where the same record lies at another offset. The second job reads pieces of
records that are bounded by the cuts of the first mate: each task starts both files at a cut, skips the lines before its first record and
stops after its last one. No read is shuffled. Records are found and checked by array operations on whole buffers.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from platewise import schemas
from platewise.functions.text import base_name, parent_dir
from platewise.session import checkpointed
from platewise.sources.artifacts import READ_FILE, list_artifacts, open_root

SPLIT_BYTES = 32 << 20
_BUFFER, _BLOCK = 4 << 20, 0xFF00
_BATCH_ROWS = 8192
#: Compression of written blocks: three times as fast as zlib's usual 6, files are 3 % larger.
_LEVEL = 4
PLAIN, GZIP, BGZF = "plain", "gzip", "bgzf"


def _block_size(head: bytes, at: int = 0) -> int | None:
    """Size of the BGZF block whose header begins at ``at``; None if none does."""
    if head[at:at + 4] != b"\x1f\x8b\x08\x04" or len(head) < at + 12:
        return None
    end = at + 12 + struct.unpack_from("<H", head, at + 10)[0]
    field = at + 12
    while field + 4 <= min(end, len(head)):
        name, size = head[field:field + 2], struct.unpack_from("<H", head, field + 2)[0]
        if name == b"BC" and size == 2 and field + 6 <= len(head):
            return struct.unpack_from("<H", head, field + 4)[0] + 1
        field += 4 + size
    return None


def _inflated(block: bytes) -> bytes | None:
    """Content of one whole BGZF block, None if it is damaged or no block."""
    extra = struct.unpack_from("<H", block, 10)[0]
    try:
        content = zlib.decompress(block[12 + extra:-8], -15)
    except zlib.error:
        return None
    return content if (zlib.crc32(content), len(content)) == struct.unpack_from("<II", block, len(block) - 8) else None


def _first_block(stream, start: int, end: int) -> int | None:
    """Offset of the first block that begins in [start, end): the first place where a whole, undamaged block lies."""
    if start == 0:
        return 0
    at = start
    while at < end:
        # A block and a header after it, wherever in this window the block begins.
        stream.seek(at)
        window = stream.read(3 << 16)
        found = window.find(b"\x1f\x8b\x08\x04")
        while 0 <= found < (1 << 16) + 1:
            size = _block_size(window, found)
            if size and found + size <= len(window) and _inflated(window[found:found + size]) is not None:
                return at + found if at + found < end else None
            found = window.find(b"\x1f\x8b\x08\x04", found + 1)
        at += 1 << 16
    return None


def file_kind(filesystem: fs.FileSystem, path: str) -> str:
    with filesystem.open_input_stream(path, compression=None) as stream:
        head = stream.read(64)
    return PLAIN if head[:2] != b"\x1f\x8b" else BGZF if _block_size(head) else GZIP


def _content(filesystem: fs.FileSystem, path: str, kind: str, begin: int, end: int | None = None) -> Iterator[bytes]:
    """Text of a file from offset ``begin``; ``end`` is where the last byte, or the last block, has to begin before."""
    if kind == GZIP:
        with filesystem.open_input_stream(path, compression="gzip") as stream:
            while data := stream.read(_BUFFER):
                yield data
        return
    with filesystem.open_input_file(path) as stream:
        stream.seek(begin)
        if kind == PLAIN:
            left = end - begin if end is not None else None
            while data := stream.read(_BUFFER if left is None else min(_BUFFER, left)):
                left = None if left is None else left - len(data)
                yield data
            return
        raw, at, base = stream.read(_BUFFER), 0, begin
        while at < len(raw) and (end is None or base + at < end):
            size = _block_size(raw, at)
            if size is None or at + size > len(raw):
                more = stream.read(_BUFFER)
                if not more:
                    raise ValueError(f"broken block in {path} at {base + at}")
                base, raw, at = base + at, raw[at:] + more, 0
                continue
            content = _inflated(raw[at:at + size])
            if content is None:
                raise ValueError(f"broken block in {path} at {base + at}")
            if content:
                yield content
            at += size
            if at == len(raw):
                base, raw, at = base + at, stream.read(_BUFFER), 0


_SPACES = np.zeros(256, bool)
_SPACES[[*range(9, 14), *range(28, 33)]] = True


def _spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Strings of the given parts of a buffer; parts are in order and do not overlap."""
    edges = np.zeros(len(data) + 1, np.int8)
    np.add.at(edges, starts, 1)
    np.subtract.at(edges, ends, 1)
    inside = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[inside])).cast(pa.string())


def parse_records(text: bytes, path: str) -> pa.Table:
    """Read id, bases and qualities of whole four-line records."""
    data = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
    ends = ends - ((ends > starts) & (data[ends - 1] == 13))
    head, seq, plus, qual = (slice(k, None, 4) for k in range(4))
    size = ends - starts
    good = (size[head] > 0) & (data[starts[head]] == 64) & (size[plus] > 0) & (data[np.minimum(starts[plus], len(data) - 1)] == 43) & (size[seq] == size[qual])
    if not good.all() or (data >= 128).any():
        bad = int(np.flatnonzero(~good)[0]) if not good.all() else int((np.flatnonzero(data >= 128)[0] >= starts[head]).sum() - 1)
        line = bytes(data[starts[head][bad]:ends[head][bad]]).decode("ascii", "backslashreplace")
        raise ValueError(f"broken read record in {path}: {line}")
    # The id is the first word behind '@', without a mate's number.
    begin, stop = starts[head] + 1, ends[head]
    while True:
        blank = (begin < stop) & _SPACES[data[np.minimum(begin, len(data) - 1)]]
        if not blank.any():
            break
        begin = begin + blank
    spaces = np.append(np.flatnonzero(_SPACES[data]), len(data))
    stop = np.minimum(stop, np.maximum(spaces[np.searchsorted(spaces, begin)], begin))
    numbered = (stop - begin >= 2) & (data[stop - 2] == 47) & ((data[stop - 1] == 49) | (data[stop - 1] == 50))
    return pa.table({
        "read_id": _spans(data, begin, stop - 2 * numbered), "seq": _spans(data, starts[seq], ends[seq]), "qual": _spans(data, starts[qual], ends[qual]),
    })


def _records(buffers: Iterator[bytes], path: str, skip: int, count: int | None) -> Iterator[pa.Table]:
    """Tables of records behind the first ``skip`` lines, ``count`` of them or all there are."""
    held, left = b"", count
    for data in buffers:
        while skip and data:
            ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
            if len(ends) < skip:
                skip, data = skip - len(ends), b""
            else:
                data, skip = data[ends[skip - 1] + 1:], 0
        if skip or not data:
            continue
        held += data
        if len(held) < _BUFFER and data.count(b"\n") == 0:
            continue
        ends = np.flatnonzero(np.frombuffer(held, np.uint8) == 10)
        n = len(ends) // 4 if left is None else min(len(ends) // 4, left)
        if n:
            cut = int(ends[4 * n - 1]) + 1
            yield parse_records(held[:cut], path)
            held = held[cut:]
            left = None if left is None else left - n
        if left == 0:
            return
    if held and (left is None or left):
        yield parse_records(held + b"\n" * (1 if held.count(b"\n") % 4 == 3 and not held.endswith(b"\n") else max(0, 4 - held.count(b"\n"))), path)


def _pairs(piece: dict) -> Iterator[pa.RecordBatch]:
    """Rows of one piece of a pair of files: records from both mates, step by step."""
    filesystem, _ = open_root(piece["root"])
    schema = pa.schema([(name, pa.string()) for name in schemas.READS.names])
    fixed = [piece["run_id"], piece["sample_id"], piece["lane"]]
    streams = [
        _records(_content(filesystem, piece[f"path{m}"], piece[f"kind{m}"], piece[f"begin{m}"]), piece[f"path{m}"], piece[f"skip{m}"], piece["records"])
        for m in (1, 2)
    ]
    held: list = [None, None]
    seen = 0
    while True:
        for m in (0, 1):
            if held[m] is None or not held[m].num_rows:
                held[m] = next(streams[m], None)
        n = min(0 if x is None else x.num_rows for x in held)
        first, second = (x.slice(0, n) if x is not None else None for x in held)
        one_left = n == 0 and (held[0] is not None or held[1] is not None)
        if one_left or (n and not first.column("read_id").equals(second.column("read_id"))):
            raise ValueError(f"mates out of step: {piece['path1']}, {piece['path2']}")
        if n == 0:
            break
        held = [x.slice(n) for x in held]
        seen += n
        columns = [first.column("read_id"), first.column("seq"), first.column("qual"), second.column("seq"), second.column("qual")]
        for a in range(0, n, _BATCH_ROWS):
            rows = [c.slice(a, _BATCH_ROWS).combine_chunks() for c in columns]
            yield pa.RecordBatch.from_arrays([*(pa.array([v] * len(rows[0]), pa.string()) for v in fixed), *rows], schema=schema)
    if piece["records"] is not None and seen < piece["records"]:
        raise ValueError(f"mates out of step: {piece['path1']}, {piece['path2']}")


def file_cuts(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Rows (root, path, kind, part, begin, before, n_lines) of files (root, path, length): cuts in which something begins, and the line ends before them.

    ``n_lines`` is the number of lines of the whole file, a last one without an end included.
    """

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for root, path, length in batch.itertuples(index=False):
                kind = file_kind(open_root(root)[0], path)
                edges = [0, max(length, 1)] if kind == GZIP else [*range(0, max(length, 1), split_bytes), max(length, 1)]
                rows += [(root, path, kind, k, a, b) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
            yield pd.DataFrame(rows, columns=["root", "path", "kind", "part", "start", "end"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for root, path, kind, part, start, end in batch.itertuples(index=False):
                filesystem, _ = open_root(root)
                begin = start
                if kind == BGZF:
                    with filesystem.open_input_file(path) as stream:
                        begin = _first_block(stream, start, end)
                lines, size, last = 0, 0, 10
                for data in _content(filesystem, path, kind, begin, end) if begin is not None else ():
                    lines, size, last = lines + data.count(b"\n"), size + len(data), data[-1]
                rows.append((root, path, kind, part, start if begin is None else begin, lines, size, last != 10))
            yield pd.DataFrame(rows, columns=["root", "path", "kind", "part", "begin", "lines", "size", "open"])

    # Rows are few and small, their work is not: with numbers of their own, partitions are not put together by size.
    cores = files.sparkSession.sparkContext.defaultParallelism
    cuts = checkpointed(files.select("root", "path", "length").repartition(cores, "path").mapInPandas(
        parts, "root string, path string, kind string, part long, start long, end long"))
    counted = cuts.repartition(max(1, min(cuts.count(), 8 * cores)), "path", "part").mapInPandas(
        count, "root string, path string, kind string, part long, begin long, lines long, size long, open boolean")
    whole = Window.partitionBy("path")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    open_end = F.max_by("open", F.when(F.col("size") > 0, F.col("part"))).over(whole)
    placed = counted.withColumn("before", F.coalesce(F.sum("lines").over(earlier), F.lit(0))).withColumn(
        "n_lines", F.sum("lines").over(whole) + F.coalesce(open_end, F.lit(False)).cast("long"))
    return placed.where((F.col("size") > 0) | (F.col("part") == 0)).select("root", "path", "kind", "part", "begin", "before", "n_lines")


def _mates(files: DataFrame, run: Column) -> DataFrame:
    """Pairs of files (root, run_id, sample_id, lane, path1, path2), mates of one folder, sample, lane and ending; one alone is an error."""
    name = base_name(F.col("path"))
    named = files.where(name.rlike(READ_FILE)).select(
        "root", "path", parent_dir(F.col("path")).alias("folder"), F.regexp_extract(name, READ_FILE, 1).alias("sample_id"),
        F.regexp_extract(name, READ_FILE, 2).alias("lane"), F.regexp_extract(name, READ_FILE, 3).alias("mate"),
        F.regexp_extract(name, r"(\.(?:fastq|fq)(?:\.gz)?)$", 1).alias("ending"))
    alone = F.raise_error(F.concat(F.lit("mate file missing for "), F.coalesce("path1", "path2"))).cast("string")
    found = named.groupBy("root", "folder", "sample_id", "lane", "ending").agg(
        F.max(F.when(F.col("mate") == "R1", F.col("path"))).alias("path1"), F.max(F.when(F.col("mate") == "R2", F.col("path"))).alias("path2"))
    both = F.col("path1").isNotNull() & F.col("path2").isNotNull()
    found = found.withColumn("path1", F.when(both, F.col("path1")).otherwise(alone))
    return found.select("root", run.alias("run_id"), "sample_id", "lane", "path1", "path2")


def read_pieces(pairs: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows saying what one task reads: (root, run_id, sample_id, lane, records, and for each mate path, kind, begin, skip).

    A piece holds the records that begin between two cuts of the first mate; ``records`` is null in the last piece of a pair,
    which reads both files to their ends.
    """
    bounds = cuts.select(F.col("path").alias("path1"), "part", F.ceil(F.col("before") / 4).alias("first"), F.ceil(F.col("n_lines") / 4).alias("all"))
    bounds = bounds.groupBy("path1", "first").agg(F.min("part").alias("part"), F.max("all").alias("all"))
    # A cut may lie behind the beginning of the last record: then nothing is left for it.
    bounds = bounds.where((F.col("first") < F.col("all")) | (F.col("first") == 0))
    following = F.lead("first").over(Window.partitionBy("path1").orderBy("first"))
    pieces = pairs.join(bounds.withColumn("records", following - F.col("first")), "path1")
    for m in (1, 2):
        path = f"path{m}"
        line = F.col("first") * 4
        # The last cut with fewer line ends before it than the piece has; the first one for the first piece. Cuts and pieces meet in one order.
        marks = cuts.select(F.col("path").alias("p"), "before", F.when(F.col("part") == 0, -1).otherwise(F.col("before")).alias("at"), F.lit(1).alias("kind_of"), F.struct("begin", "before", "kind").alias("cut"))
        wants = pieces.select(F.col(path).alias("p"), F.col("first").alias("wanted"), line.alias("at")).distinct()
        mixed = marks.select("p", "at", F.lit(1).alias("turn"), "cut", F.lit(None).cast("long").alias("wanted")).unionByName(
            wants.select("p", "at", F.lit(0).alias("turn"), F.lit(None).cast(marks.schema["cut"].dataType).alias("cut"), "wanted"))
        so_far = Window.partitionBy("p").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        found = mixed.withColumn("from", F.last("cut", ignorenulls=True).over(so_far)).where(F.col("wanted").isNotNull()).select(
            F.col("p").alias(path), F.col("wanted").alias("first"), F.col("from.begin").alias(f"begin{m}"), F.col("from.kind").alias(f"kind{m}"),
            (F.col("wanted") * 4 - F.col("from.before")).alias(f"skip{m}"))
        pieces = pieces.join(found, [path, "first"])
    return pieces


class FastqPairReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.run_id = options.get("run_id", "")
        self.run_pattern = options.get("run_pattern")
        self.recursive = options.get("recursive", "true").lower() == "true"

    def partitions(self) -> list[FilePair]:
        filesystem, root = open_root(self.root)
        infos = filesystem.get_file_info(fs.FileSelector(root, recursive=self.recursive))
        found: dict[tuple, dict[str, str]] = {}
        for info in infos:
            match = re.match(READ_FILE, info.base_name)
            if info.is_file and match:
                sample_id, lane, mate = match.groups()
                folder = info.path[: -len(info.base_name)]
                ending = info.base_name[match.end(3):]
                found.setdefault((folder, sample_id, lane or "", ending), {})[mate] = info.path
        pairs = []
        for (_, sample_id, lane, _), mates in sorted(found.items()):
            if set(mates) != {"R1", "R2"}:
                raise FileNotFoundError(f"mate file missing for {next(iter(mates.values()))}")
            pairs.append(FilePair(self._run_of(mates["R1"]), sample_id, lane, mates["R1"], mates["R2"]))
        return pairs

    def _run_of(self, path: str) -> str:
        if not self.run_pattern:
            return self.run_id
        match = re.search(self.run_pattern, path)
        if not match:
            raise ValueError(f"no run in path {path}")
        return match.group(1)

    def read(self, partition: FilePair) -> Iterator[pa.RecordBatch]:
        filesystem, _ = open_root(self.root)
        piece = {"root": self.root, "records": None, **vars(partition)}
        for m in (1, 2):
            piece |= {f"kind{m}": file_kind(filesystem, piece[f"path{m}"]), f"begin{m}": 0, f"skip{m}": 0}
        yield from _pairs(piece)


@dataclass
class FilePair(InputPartition):
    run_id: str
    sample_id: str
    lane: str
    path1: str
    path2: str


@dataclass
class WrittenFiles(WriterCommitMessage):
    paths: list[tuple[str, str]]


def bgzf_block(data: bytes) -> bytes:
    """One block with ``data``, at most ``_BLOCK`` bytes; an empty one ends a file."""
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    return struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


class _BlockFile:
    """A BGZF file that is being written."""

    def __init__(self, filesystem: fs.FileSystem, path: str):
        self.stream, self.held = filesystem.open_output_stream(path, compression=None), b""

    def write(self, data: bytes) -> None:
        self.held += data
        full = len(self.held) // _BLOCK * _BLOCK
        for at in range(0, full, _BLOCK):
            self.stream.write(bgzf_block(self.held[at:at + _BLOCK]))
        self.held = self.held[full:]

    def close(self) -> None:
        if self.held:
            self.stream.write(bgzf_block(self.held))
        self.stream.write(bgzf_block(b""))
        self.stream.close()


def _as_text(rows: pa.RecordBatch, mate: int) -> bytes:
    """The records of a batch as the text of a file."""
    columns = [rows.column(rows.schema.get_field_index(name)) for name in ("read_id", f"seq{mate}", f"qual{mate}")]
    lines = pc.binary_join_element_wise("@", columns[0], "\n", columns[1], "\n+\n", columns[2], "\n", "")
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines), "")
    text = (joined[0].as_py() or "").encode()
    if not text.isascii():
        raise ValueError("reads to be written must be ASCII")
    return text


class FastqPairWriter(DataSourceArrowWriter):
    """Every task writes its rows as lanes of its own, ``<sample>_L<number>_R1.fastq.gz`` and ``_R2``, in BGZF.

    Numbers start above the lanes that are there. Rows come sorted by sample, so one pair of files is open at a time; a sample that comes back
    is an error. Files get their name when the whole job commits, so a repeated task leaves no double.
    """

    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        filesystem, root = open_root(self.root)
        there = filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True))
        lanes = [re.match(READ_FILE, info.base_name) for info in there]
        self.first_lane = max((int((m.group(2) or "L0")[1:]) + 1 for m in lanes if m), default=0)

    def write(self, batches: Iterator[pa.RecordBatch]) -> WrittenFiles:
        filesystem, root = open_root(self.root)
        filesystem.create_dir(root, recursive=True)
        task = TaskContext.get()
        lane, attempt = f"L{self.first_lane + task.partitionId():03d}", task.taskAttemptId()
        paths: list[tuple[str, str]] = []
        files: list[_BlockFile] = []
        now, done = None, set()
        for batch in batches:
            if not batch.num_rows:
                continue
            samples = batch.column(batch.schema.get_field_index("sample_id")).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(samples[1:] != samples[:-1]) + 1).tolist(), len(samples)]
            for a, b in zip(edges, edges[1:]):
                if samples[a] != now:
                    for file in files:
                        file.close()
                    now = samples[a]
                    if now in done:
                        raise ValueError("reads to be written must be sorted by sample")
                    done.add(now)
                    named = [f"{root}/{now}_{lane}_R{n}.fastq.gz" for n in (1, 2)]
                    drafts = [f"{path}.draft-{attempt}" for path in named]
                    files = [_BlockFile(filesystem, draft) for draft in drafts]
                    paths += zip(drafts, named)
                for n, file in enumerate(files, start=1):
                    file.write(_as_text(batch.slice(a, b - a), n))
        for file in files:
            file.close()
        return WrittenFiles(paths)

    def commit(self, messages: list[WrittenFiles | None]) -> None:
        filesystem, _ = open_root(self.root)
        for message in messages:
            for draft, named in message.paths if message else []:
                filesystem.move(draft, named)

    def abort(self, messages: list[WrittenFiles | None]) -> None:
        filesystem, _ = open_root(self.root)
        for message in messages:
            for draft, _ in message.paths if message else []:
                filesystem.delete_file(draft)


class FastqPairs(DataSource):
    """One partition per pair of mate files; one row per pair."""

    @classmethod
    def name(cls) -> str:
        return "fastq_pairs"

    def schema(self) -> StructType:
        return schemas.READS

    def reader(self, schema: StructType) -> DataSourceReader:
        return FastqPairReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return FastqPairWriter(self.options)


def read_fastq_pairs(
    spark: SparkSession, path: str, run_id: str = "", spread: int | None = None, run_pattern: str | None = None, split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Read pairs below a directory, of ``.fastq`` and ``.fq`` files, plain, gz or BGZF; plain and BGZF files in pieces of about ``split_bytes``.

    All belong to ``run_id``, or each file to group 1 of ``run_pattern`` in its path; a path without it is an error.
    ``spread`` redistributes rows by read id, for large gz files that cannot be split.
    """
    run = F.lit(run_id)
    if run_pattern:
        missing = F.raise_error(F.concat(F.lit("no run in path "), F.col("path1"))).cast("string")
        run = F.when(F.regexp_like("path1", F.lit(run_pattern)), F.regexp_extract("path1", run_pattern, 1)).otherwise(missing)
    files = checkpointed(list_artifacts(spark, path).withColumn("root", F.lit(path)))
    pairs = checkpointed(_mates(files, run))
    named = files.where(base_name(F.col("path")).rlike(READ_FILE))
    pieces = checkpointed(read_pieces(pairs, checkpointed(file_cuts(named, split_bytes))))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.to_pylist():
                yield from _pairs(piece)

    # One task for each piece, as far as hashing tells them apart.
    tasks = max(1, pieces.count())
    reads = pieces.repartition(tasks, F.xxhash64("path1", "first")).mapInArrow(read, schemas.READS)
    return reads.repartition(spread, "sample_id", "read_id") if spread else reads


def write_fastq_pairs(reads: DataFrame, path: str) -> None:
    """Read pairs as BGZF FASTQ files below a directory; the tasks' files are the lanes of a sample."""
    reads.sparkSession.dataSource.register(FastqPairs)
    reads.select(*schemas.READS.names).sortWithinPartitions("sample_id").write.format("fastq_pairs").mode("append").save(path)
