"""Pack pieces of text into as few sequences of fixed capacity as can be found.

The number of sequences depends on the pieces' lengths only, and there are at most ``capacity`` different ones: the histogram of
lengths, one number per length, is what is solved, whatever the size of the corpus.

1. Configuration linear program. A configuration is a multiset of lengths that fits a sequence; the program asks for the least total
   use of configurations that covers the histogram. It is solved by multiplicative weights: every length has a price; a knapsack
   by dynamic programming finds the configurations that are worth most at these prices; those near the best are used in equal
   parts; the prices of what they cover fall. One pass of the knapsack gives the best configuration through every
   length, so a round uses many configurations at once. The best prices seen are also a lower bound for the number of sequences.
2. Rounding. Each configuration is used as often as the whole part of its share says, never beyond what is left of a length. The program of what is left is solved and
   rounded again and again; where whole parts place little, full configurations are rounded up. The rest, under a hundredth of the tokens
   on the test tables, goes by best-fit decreasing or by filling sequence after sequence as full as possible, whichever needs fewer; both work on the histogram too.
3. Assignment. Pieces of a length are numbered: they are dealt to buckets by a hash, numbered in each bucket, and the sizes of
   the buckets before it are added. A length with a third of all pieces has as many buckets as it needs. A number then names a sequence
   and a place by a lookup in the plan, whose size is bounded by the configurations in use, not by the pieces.

Nulls: a null text is an empty one, a null document id stays null. Lengths outside 1 .. capacity are an error. Repeated rows are
packed each time. An empty table gives an empty result. Payload columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.llm.common import free_name, short_batches, stored
from platewise.llm.tokens import TEXTS_PER_BATCH, encoder

CAPACITY = 2048
#: Rounds of multiplicative weights for the whole histogram, and for what rounding leaves of it.
ROUNDS, AGAIN = 150, 40

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


def cut(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of documents with these lengths: (document's position, piece, start, length). The first piece takes the odd rest."""
    pieces = -(-lengths // capacity)
    first = lengths - (pieces - 1) * capacity
    document = np.repeat(np.arange(len(lengths)), pieces)
    piece = np.arange(len(document)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = np.where(piece > 0, first[document] + (piece - 1) * capacity, 0)
    return document, piece, start, np.where(piece > 0, capacity, first[document])


def with_separator(ids: np.ndarray, offsets: np.ndarray, separator: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a column with the separator after each text."""
    if separator is None:
        return ids, offsets
    return np.insert(ids, offsets[1:], separator), offsets + np.arange(len(offsets))


def tokenize_pieces(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, separator: int | None = 0) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids): each document's ids and the separator, cut only if longer than ``capacity``.

    A cut document's first piece takes the odd rest, so that all other pieces are full. ``ids`` are little-endian unsigned 32-bit integers.
    """
    short_batches(docs.sparkSession, TEXTS_PER_BATCH)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in batches:
            ids, offsets = with_separator(*own.encode(batch.column(1)), separator)
            document, piece, start, length = cut(np.diff(offsets), capacity)
            ends = np.concatenate([[0], np.cumsum(length)])
            data = pa.Array.from_buffers(pa.large_binary(), len(document), [None, pa.py_buffer(ends * 4), pa.py_buffer(ids.astype("<u4"))])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(document)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), data.cast(pa.binary()),
            ], names=["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(pieces, PIECE)


def knapsack(prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Greatest total price of lengths that fit each room 0 .. capacity, and the length to take first (0: leave it empty)."""
    best = np.zeros(capacity + 1)
    take = np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        worth = prices[1:room + 1] + best[room - 1::-1]
        k = int(worth.argmax())
        if worth[k] > best[room - 1]:
            best[room], take[room] = worth[k], k + 1
        else:
            best[room], take[room] = best[room - 1], 0
    return best, take


def _configuration(take: np.ndarray, room: int, first: int = 0) -> tuple[tuple[int, int], ...]:
    """The lengths (with their number) on the best way to fill ``room``, ``first`` among them."""
    found: dict[int, int] = {}
    if first:
        found[first] = 1
        room -= first
    while room > 0:
        length = int(take[room])
        if length:
            found[length] = found.get(length, 0) + 1
        room -= length or 1
    return tuple(sorted(found.items(), reverse=True))


@dataclass
class Solution:
    """Shares of configurations covering the histogram, and a lower bound for the number of sequences."""

    shares: dict
    bound: float


def solve_configurations(histogram: np.ndarray, rounds: int = ROUNDS, near: float = 0.002, step: float = 0.5) -> Solution:
    """The configuration program by multiplicative weights; ``histogram[l]`` counts the pieces of length ``l``."""
    capacity = len(histogram) - 1
    there = np.nonzero(histogram)[0]
    lengths = np.arange(capacity + 1, dtype=float)
    prices = np.where(histogram > 0, lengths / capacity, 0.0)
    shares: dict = {}
    covered = np.zeros(capacity + 1)
    bound = float(np.ceil((lengths * histogram).sum() / capacity))
    for _ in range(rounds):
        best, take = knapsack(prices, capacity)
        bound = max(bound, float((prices * histogram).sum() / best[capacity]))
        through = prices[there] + best[capacity - there]
        chosen = {_configuration(take, capacity, int(l)) for l in there[through >= (1 - near) * best[capacity]]}
        used = np.zeros(capacity + 1)
        for configuration in chosen:
            # Each is used until it runs out of one of its lengths, in a share of the rounds.
            amount = min(histogram[l] / n for l, n in configuration) / len(chosen)
            shares[configuration] = shares.get(configuration, 0.0) + amount
            for l, n in configuration:
                used[l] += amount * n
        covered += used
        ratio = np.divide(used, histogram, out=np.zeros_like(used), where=histogram > 0)
        prices = prices * np.exp(-step * ratio / max(ratio.max(), 1e-12))
    enough = np.divide(covered, histogram, out=np.full_like(covered, np.inf), where=histogram > 0)
    reach = float(np.median(enough[there])) if len(there) else 1.0
    return Solution({c: x / reach for c, x in shares.items()} if reach > 0 else {}, bound)


def best_fit(histogram: np.ndarray) -> dict:
    """Best-fit decreasing on a histogram: configurations and how many sequences have each."""
    capacity = len(histogram) - 1
    by_room: dict[int, dict] = {}
    for length in range(capacity, 0, -1):
        left = int(histogram[length])
        for room in range(length, capacity):
            if not left:
                break
            groups = by_room.get(room)
            while left and groups:
                configuration, n = groups.popitem()
                m = min(n, left)
                if n > m:
                    groups[configuration] = n - m
                grown = _with(configuration, length)
                target = by_room.setdefault(room - length, {})
                target[grown] = target.get(grown, 0) + m
                left -= m
        while left:
            per = min(capacity // length, left)
            m = left // per
            configuration = ((length, per),)
            target = by_room.setdefault(capacity - per * length, {})
            target[configuration] = target.get(configuration, 0) + m
            left -= m * per
    found: dict = {}
    for groups in by_room.values():
        for configuration, n in groups.items():
            found[configuration] = found.get(configuration, 0) + n
    return found


def _with(configuration: tuple, length: int) -> tuple:
    found = dict(configuration)
    found[length] = found.get(length, 0) + 1
    return tuple(sorted(found.items(), reverse=True))


def full_sequences(histogram: np.ndarray) -> dict:
    """Fill sequence after sequence: the longest piece left, then those of the others that leave the least room, longer ones first.

    What the others can add up to is a set of sums kept as the bits of one number; a filled configuration is repeated as often as
    its lengths last.
    """
    capacity = len(histogram) - 1
    left = {int(l): int(histogram[l]) for l in np.nonzero(histogram)[0][::-1]}
    found: dict = {}
    while left:
        longest = next(iter(left))
        room = capacity - longest
        sums, mask, steps = 1, (1 << (room + 1)) - 1, []
        for length, n in left.items():
            if length > room:
                continue
            for _ in range(min(n - (length == longest), room // length)):
                steps.append((length, sums))
                grown = (sums | sums << length) & mask
                if grown == sums:
                    break
                sums = grown
            if sums >> room & 1:
                break
        chosen, at = {longest: 1}, sums.bit_length() - 1
        for length, before in reversed(steps):
            if not before >> at & 1:
                chosen[length] = chosen.get(length, 0) + 1
                at -= length
        configuration = tuple(sorted(chosen.items(), reverse=True))
        m = min(left[l] // n for l, n in configuration)
        found[configuration] = found.get(configuration, 0) + m
        for l, n in configuration:
            left[l] -= m * n
            if not left[l]:
                del left[l]
    return found


def rounded_program(histogram: np.ndarray, rounds: int = ROUNDS, again: int = AGAIN) -> tuple[dict, np.ndarray, float]:
    """Sequences per configuration from the rounded program, the pieces that are left, and the lower bound.

    Shares are rounded down, the largest first. What is left is a smaller histogram, whose program is solved and rounded again; where whole parts
    no longer place much, configurations that fill a sequence are rounded up, as far as the pieces last. It ends when a turn places hardly anything.
    Small capacities, whose rounds are cheap, get more and smaller steps.
    """
    left, plan, bound, capacity = histogram.astype(np.int64).copy(), {}, 0.0, len(histogram) - 1
    finer = max(1, 512 // max(capacity, 1))

    def place(shares: list[tuple[tuple, float]]) -> None:
        for configuration, share in shares:
            m = min(int(share), min(int(left[l]) // n for l, n in configuration))
            if m > 0:
                plan[configuration] = plan.get(configuration, 0) + m
                for l, n in configuration:
                    left[l] -= m * n

    while left.any():
        before = int(left.sum())
        solution = solve_configurations(left, (again if plan else rounds) * finer, step=0.5 / finer**0.5)
        bound = bound or solution.bound
        shares = sorted(solution.shares.items(), key=lambda x: (-x[1], x[0]))
        place([(c, x + 1e-9) for c, x in shares])
        if left.sum() > 0.7 * before:
            place([(c, np.ceil(x - 1e-9)) for c, x in shares if sum(l * n for l, n in c) == capacity])
        if left.sum() > 0.97 * before:
            break
    return plan, left, bound


def plan_packing(histogram: np.ndarray, rounds: int = ROUNDS) -> tuple[dict, float]:
    """Sequences per configuration that hold the histogram exactly, and the lower bound: the rounded program, and the few pieces that it leaves."""
    plan, left, bound = rounded_program(histogram, rounds)
    for configuration, n in min((best_fit(left), full_sequences(left)), key=lambda p: sum(p.values())).items():
        plan[configuration] = plan.get(configuration, 0) + n
    return plan, bound


def lookup_table(plan: dict, capacity: int) -> dict[str, np.ndarray]:
    """The plan as arrays sorted by (length, first number): pieces with these numbers go to these sequences and offsets."""
    numbered = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for configuration, m in sorted(plan.items(), reverse=True):
        offset = 0
        for length, n in configuration:
            rows.append((length, int(numbered[length]), n, sequence, offset))
            numbered[length] += m * n
            offset += length * n
        sequence += m
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "number", "per", "sequence", "offset"), columns))


def pack(pieces: DataFrame, length: str = "length", order: tuple[str, ...] = ("doc_id", "piece"), capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (free names if they are taken). Pass slim, stored rows: they are read three times and shuffled once."""
    spark = pieces.sparkSession
    counted = pieces.groupBy(F.col(length).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    histogram = np.zeros(capacity + 1, np.int64)
    wrong = counted.filter(F.col("length").isNull() | (F.col("length") < 1) | (F.col("length") > capacity)).limit(1).count()
    if wrong:
        raise ValueError(f"piece lengths must lie in 1 .. {capacity}")
    for row in counted.collect():  # at most one row per length up to the capacity
        histogram[row["length"]] = row["n"]
    plan, _ = plan_packing(histogram, rounds)
    table = lookup_table(plan, capacity)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_bucket = max(100, int(histogram.sum()) // (8 * parts))
    buckets = F.element_at(F.split(F.lit(",".join(str(1 + int(n) // per_bucket) for n in histogram)), ",").cast("array<int>"), F.col(length).cast("int") + 1)
    bucket, rank, before, key = (free_name(pieces.columns, c) for c in ("bucket", "rank", "before", "length_key"))
    dealt = stored(pieces.withColumn(bucket, F.pmod(F.xxhash64(*order, F.lit(7)), buckets.cast("long"))), "packing-pieces")
    sizes = dealt.groupBy(F.col(length).alias(key), F.col(bucket).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(key).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket: at most one per length and 8 per shuffle partition.
    begins = F.broadcast(sizes.select(key, F.col("b").alias(f"{bucket}_of"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before)))
    inside = Window.partitionBy(length, bucket).orderBy(*order)
    numbered = dealt.withColumn(rank, F.row_number().over(inside) - 1).join(begins, (F.col(length) == F.col(key)) & (F.col(bucket) == F.col(f"{bucket}_of")))

    @F.pandas_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        keys = table["length"] * (1 << 48) + table["number"]
        at = np.searchsorted(keys, lengths.to_numpy(np.int64) * (1 << 48) + numbers.to_numpy(np.int64), side="right") - 1
        turn = numbers.to_numpy(np.int64) - table["number"][at]
        return pd.DataFrame({
            "sequence_id": table["sequence"][at] + turn // table["per"][at],
            "offset": table["offset"][at] + turn % table["per"][at] * lengths.to_numpy(np.int64),
        })

    name = free_name(pieces.columns, "place")
    placed = numbered.withColumn(name, place(F.col(length).cast("long"), (F.col(rank) + F.col(before)).cast("long")))
    added = [F.col(f"{name}.{c}").alias(free_name(pieces.columns, c)) for c in ("sequence_id", "offset")]
    return placed.select(*(F.col(f"`{c}`") for c in pieces.columns), *added)


def pack_documents(docs: DataFrame, vocabulary: str, digest: Column | None = None, **options) -> DataFrame:
    """Pieces of ``docs`` packed: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    The ids themselves stay out of the shuffle; ``tokenize_pieces`` gives them for the same (doc_id, piece).
    """
    pieces = tokenize_pieces(docs, vocabulary, **options)
    slim = pieces.select("doc_id", "piece", "start", "length", (F.crc32("ids") if digest is None else digest).alias("ids_crc32"))
    return pack(stored(slim, "packing-lengths"), order=("doc_id", "piece", "ids_crc32"))
