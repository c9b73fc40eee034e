"""Binary training files: documents as token ids, packed by best-fit decreasing into rows of fixed width.

Each task encodes its documents, cuts what is longer than a row into pieces without losing an id, gathers pieces until a shard's
worth of tokens is there, and packs them: longest first, each into the open row with the least room that still holds it. Open
rows are counted by the room they have left in a segment tree over 0 .. capacity, which finds the least sufficient room in
log(capacity) steps. A shard holds at most ``ROWS_PER_SHARD`` rows' worth of tokens, so memory is bounded whatever a task reads,
and a lost task writes the same shards again.

A shard is one row of the result: ``ids`` a matrix (rows x capacity, little-endian, padded with ``pad``), ``cu_seqlens`` the cumulative
segment lengths of each row one after the other (each beginning with 0), ``row_segments`` the number of segments per row,
``position_resets`` one bit per cell that is set where a segment begins, and ``members`` which piece of which document each segment is.
Written with Spark's own file writer, so a shard is there as a whole or not at all. ``read_segments`` reads them back.

Nulls: a null text is empty and has only its separator id; a null document id stays null. Repeated rows are written each time. An
empty table gives no shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from platewise.llm.common import short_batches
from platewise.llm.packing import cut, with_separator
from platewise.llm.tokens import TEXTS_PER_BATCH, encoder

ROWS_PER_SHARD = 1024
MEMBER = "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,row:int,offset:int>"
SHARD = (
    "shard bigint, n_rows int, capacity int, width int, ids binary, row_segments array<int>, cu_seqlens array<int>, "
    f"position_resets binary, members array<{MEMBER}>"
)


class RoomTree:
    """How many open rows have each amount of room left; finds the least room that is enough."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)

    def add(self, room: int, n: int) -> None:
        at = room + self.size
        while at:
            self.tree[at] += n
            at >>= 1

    def least(self, needed: int) -> int | None:
        """The smallest room of at least ``needed`` that an open row has."""
        at = needed + self.size
        if not self.tree[at]:
            while at > 1 and (at & 1 or not self.tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.tree[2 * at] else 2 * at + 1
        return at - self.size


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of positions in ``lengths``: longest first, each into the fullest row that holds it."""
    tree, rows = RoomTree(capacity), []
    open_rows: dict[int, list[int]] = {}
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        room = tree.least(lengths[k])
        if room is None:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row = open_rows[room].pop()
            tree.add(room, -1)
        rows[row].append(k)
        left = room - lengths[k]
        if left:
            open_rows.setdefault(left, []).append(row)
            tree.add(left, 1)
    return rows


def write_shard(number: int, pieces: list, capacity: int, dtype: str, pad: int) -> dict:
    """One packed shard of pieces (doc_id, piece, start, ids)."""
    rows = best_fit_decreasing([len(p[3]) for p in pieces], capacity)
    matrix = np.full((len(rows), capacity), pad, dtype)
    resets = np.zeros((len(rows), capacity), bool)
    segments, ends, members = [], [], []
    for r, row in enumerate(rows):
        at = 0
        ends.append(0)
        for k in row:
            doc_id, piece, start, ids = pieces[k]
            matrix[r, at:at + len(ids)] = ids
            resets[r, at] = True
            members.append({"doc_id": doc_id, "piece": piece, "start": start, "length": len(ids), "row": r, "offset": at})
            at += len(ids)
            ends.append(at)
        segments.append(len(row))
    return {
        "shard": number, "n_rows": len(rows), "capacity": capacity, "width": matrix.itemsize, "ids": matrix.tobytes(), "row_segments": segments,
        "cu_seqlens": ends, "position_resets": np.packbits(resets).tobytes(), "members": members,
    }


def pack_shards(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, separator: int | None = 0,
    pad: int = 0, dtype: str = "<u2", rows_per_shard: int = ROWS_PER_SHARD,
) -> DataFrame:
    """Packed shards (schema ``SHARD``) of whole texts. ``dtype`` must hold every id, one that it cannot hold is an error; ``separator`` ends each document."""
    short_batches(docs.sparkSession, TEXTS_PER_BATCH)
    schema = to_arrow_schema(T._parse_datatype_string(SHARD))

    def batch_of(shard: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([shard], schema=schema)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, waiting, tokens, block = encoder(vocabulary), [], 0, 0
        task = TaskContext.get().partitionId()
        for batch in batches:
            ids, offsets = with_separator(*own.encode(batch.column(1)), separator)
            if len(ids) and int(ids.max()) > np.iinfo(dtype).max:
                raise ValueError(f"token id {int(ids.max())} does not fit {dtype}")
            ids = ids.astype(dtype)
            numbers = batch.column(0).to_pylist()
            for document, piece, start, n in zip(*(x.tolist() for x in cut(np.diff(offsets), capacity))):
                if tokens + n > rows_per_shard * capacity:
                    yield batch_of(write_shard((task << 24) + block, waiting, capacity, dtype, pad))
                    waiting, tokens, block = [], 0, block + 1
                begin = offsets[document] + start
                waiting.append((numbers[document], piece, start, ids[begin:begin + n]))
                tokens += n
        if waiting:
            yield batch_of(write_shard((task << 24) + block, waiting, capacity, dtype, pad))

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(packed, SHARD)


SEGMENT = "shard bigint, row int, segment int, doc_id bigint, piece int, start bigint, length bigint, offset int, ids_crc32 bigint, resets int"


def read_segments(shards: DataFrame) -> DataFrame:
    """One row per segment, read from the matrices: what it is, where it lies, and a checksum of its ids as 32-bit integers.

    The offset and length come from ``cu_seqlens``, ``resets`` counts the position resets inside the segment (1 if all is right).
    """
    names = [f.name for f in T._parse_datatype_string(SEGMENT).fields]

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in batch.to_dict("records"):
                matrix = np.frombuffer(s["ids"], f"<u{s['width']}").reshape(s["n_rows"], s["capacity"])
                resets = np.unpackbits(np.frombuffer(s["position_resets"], np.uint8), count=matrix.size).reshape(matrix.shape)
                rows, at, member = [], 0, iter(s["members"])
                for r, n in enumerate(s["row_segments"]):
                    ends = s["cu_seqlens"][at:at + n + 1]
                    at += n + 1
                    for k in range(n):
                        m, begin, end = next(member), int(ends[k]), int(ends[k + 1])
                        crc = zlib.crc32(matrix[r, begin:end].astype("<u4").tobytes())
                        rows.append((s["shard"], r, k, m["doc_id"], m["piece"], m["start"], end - begin, begin, crc, int(resets[r, begin:end].sum())))
                found = pd.DataFrame(rows, columns=names)
                found["doc_id"] = found["doc_id"].astype("Int64")
                yield found

    return shards.mapInPandas(segments, SEGMENT)
