"""Taxonomic classification by exact k-mers.

``taxonomy`` has ``taxid, rank_code, name, path``; ``path`` lists the taxids from the root to the taxon
itself. References and taxonomy come from the user. The algorithm is this library's own contract.

Taxa are numbered depth first (``nested_sets``): a taxon's descendants are the numbers from its own to its last one. Ancestor tests are then
comparisons and sums over clades are running sums of what begins and ends along the numbers. k-mers travel as super-k-mers, runs of
neighbours that share their minimizer, which is also what they are shuffled by.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.session import broadcast_if_small, checkpointed, has_at_most, short_batches

SAMPLE_KEY = ["run_id", "sample_id"]
STRIDES = (16_384, 1_024, 64)
#: Bases of a minimizer, k-mers of a run at most, and characters that are cut at once.
MINIMIZER, RUN_KMERS, AT_ONCE = 10, 64, 1 << 20
#: Characters that are hashed at once where all k-mers of reads are looked up; arrays of so many numbers stay in a core's cache.
HASHED_AT_ONCE = 1 << 16
#: Odd factor of the hashes of k-mers.
FACTOR = 0x9E3779B97F4A7C15
#: Taxa whose numbers may be broadcast, three numbers each.
MAX_TAXA = 2_000_000


def _chunks(rows: DataFrame, column: str, k: int, stride: int) -> DataFrame:
    """Cut strings in overlapping pieces that together hold every k-mer exactly once."""
    starts = F.sequence(F.lit(0), F.floor((F.length(column) - k) / stride).cast("int"))
    piece = F.substr(column, F.col("_chunk") * stride + 1, F.lit(stride + k - 1))
    return rows.withColumn("_chunk", F.explode(starts)).withColumn(column, piece).drop("_chunk")


def kmers(rows: DataFrame, column: str, k: int) -> DataFrame:
    """One row per k-mer of ``column`` (whole text): ``kmer``, and ``at``, its place in the piece it was cut from.

    ``substr`` walks a UTF-8 string from its start, so strings are first cut in ever smaller pieces; the
    whole cost then stays near linear in the text. Strings shorter than k have no row.
    """
    pieces = rows.where(F.length(column) >= k)
    for stride in STRIDES:
        pieces = _chunks(pieces, column, k, stride)
    at = F.sequence(F.lit(1), F.length(column) - (k - 1))
    return pieces.withColumn("at", F.explode(at)).withColumn(
        "kmer", F.substr(column, F.col("at"), F.lit(k))
    ).drop(column)


def _common_prefix(low: Column, high: Column) -> Column:
    """Shared start of two arrays."""
    pairs = F.arrays_zip(low.alias("a"), high.alias("b"))
    differing = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size(low), F.size(high)) - 1),
        lambda i: ~F.get(low, i).eqNullSafe(F.get(high, i)),
    )
    return F.slice(low, F.lit(1), F.coalesce(F.get(differing, F.lit(0)), F.size(pairs)))


def running(rows: DataFrame, order: list[str], value: str) -> DataFrame:
    """``rows`` with ``before``, the sum of ``value`` over all rows that come earlier in ``order``, whatever their number.

    The rows are dealt to sorted ranges and stored; sums inside a range and over the ranges before it are added.
    """
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = checkpointed(sorted_rows.withColumn("_range", F.spark_partition_id()))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    sums = dealt.groupBy("_range").agg(F.sum(value).alias("_sum")).select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(F.broadcast(sums), "_range")
    return placed.withColumn("before", F.col("_base") + F.col("_inside")).drop("_range", "_base", "_inside")


def nested_sets(taxonomy: DataFrame) -> DataFrame:
    """``taxonomy`` with ``enter`` and ``leave``: its number in depth-first order and the last number among its descendants.

    Sorted paths are in depth-first order, so a taxon's number is the count of smaller paths. Its descendants end before the path that
    has its last step raised by one, so that path's place among the others is one past ``leave``.
    """
    last = F.element_at("path", -1)
    beyond = F.concat(F.slice("path", F.lit(1), F.size("path") - 1), F.array(last + 1))
    marks = taxonomy.select("taxid", F.explode(F.array(
        F.struct(F.col("path").alias("key"), F.lit(1).alias("real")), F.struct(beyond.alias("key"), F.lit(0).alias("real")))).alias("m"))
    placed = running(marks.select("taxid", "m.key", "m.real"), ["key", "real", "taxid"], "real")
    numbers = placed.groupBy("taxid").agg(
        F.max(F.when(F.col("real") == 1, F.col("before"))).alias("enter"), (F.max(F.when(F.col("real") == 0, F.col("before"))) - 1).alias("leave"))
    return checkpointed(taxonomy.join(numbers, "taxid"))


def numbered(rows: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with ``columns`` of their taxid; a taxid that the taxonomy does not have is an error that names it."""
    unknown = F.raise_error(F.concat(F.lit("taxid not in the taxonomy: "), F.coalesce(F.col("taxid").cast("string"), F.lit("null"))))
    joined = rows.join(broadcast_if_small(sets.select("taxid", *columns), MAX_TAXA), "taxid", "left")
    first = F.when(F.col(columns[0]).isNull(), unknown.cast(sets.schema[columns[0]].dataType)).otherwise(F.col(columns[0]))
    return joined.withColumn(columns[0], first)


def _parts(texts: list[str], k: int, at_once: int) -> Iterator[tuple[list[int], list[str]]]:
    """Row numbers and texts of about ``at_once`` characters; long texts come in pieces that overlap by k - 1."""
    owners, pieces, size = [], [], 0
    for owner, text in enumerate(texts):
        if not text or len(text) < k:
            continue
        for start in range(0, len(text) - k + 1, at_once):
            piece = text[start:start + at_once + k - 1]
            owners.append(owner)
            pieces.append(piece)
            size += len(piece)
            if size >= at_once:
                yield owners, pieces
                owners, pieces, size = [], [], 0
    if pieces:
        yield owners, pieces


def super_kmers(rows: DataFrame, column: str, k: int, m: int = MINIMIZER) -> DataFrame:
    """The other columns of ``rows`` with ``minimizer, run``: runs that together hold every k-mer of ``column`` exactly once.

    The minimizer of a k-mer is the smallest hash of its stretches of ``m`` characters. Neighbours mostly share it, so a run of them takes little
    more than one k-mer, and equal k-mers have equal minimizers wherever they are. Runs have at most ``RUN_KMERS`` k-mers.
    """
    m = min(m, k)
    keys = [c for c in rows.columns if c != column]
    schema = T.StructType([*rows.select(*keys).schema, T.StructField("minimizer", T.LongType()), T.StructField("run", T.StringType())])
    at_once, longest = AT_ONCE, RUN_KMERS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owners, pieces in _parts(batch.column(len(keys)).to_pylist(), k, at_once):
                whole = "".join(pieces)
                codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
                piece = np.repeat(np.arange(len(pieces)), [len(x) for x in pieces])
                hashes = np.zeros(len(codes) - m + 1, np.uint64)
                for j in range(m):
                    hashes *= np.uint64(0x9E3779B97F4A7C15)
                    hashes += codes[j:len(codes) - m + 1 + j]
                hashes ^= hashes >> np.uint64(31)
                hashes *= np.uint64(0xBF58476D1CE4E5B9)
                hashes ^= hashes >> np.uint64(29)
                size = 1
                while 2 * size <= k - m + 1:
                    hashes = np.minimum(hashes[:-size], hashes[size:])
                    size *= 2
                rest = k - m + 1 - size
                least = np.minimum(hashes[:-rest], hashes[rest:]) if rest else hashes
                there = piece[:len(least)] == piece[k - 1:]
                new = np.ones(len(least), bool)
                new[1:] = (least[1:] != least[:-1]) | (piece[1:len(least)] != piece[:len(least) - 1]) | ~there[:-1]
                begin = np.maximum.accumulate(np.where(new, np.arange(len(least)), 0))
                starts = np.flatnonzero(there & (new | ((np.arange(len(least)) - begin) % longest == 0)))
                # A run ends at the next one or where its piece ends.
                ends = np.append(starts[1:], len(least))
                last = np.cumsum([len(x) for x in pieces])[piece[starts]] - (k - 1)
                ends = np.minimum(ends, last) + k - 1
                width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
                byte = np.concatenate([[0], np.cumsum(width)])
                a, b = byte[starts], byte[ends]
                offsets = np.concatenate([[0], np.cumsum(b - a)])
                data = np.frombuffer(whole.encode(), np.uint8)[np.arange(offsets[-1]) + np.repeat(a - offsets[:-1], b - a)]
                runs = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())
                at = pa.array(np.array(owners)[piece[starts]])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(at) for c in range(len(keys))), pa.array(least[starts].view(np.int64)), runs], names=[*keys, "minimizer", "run"])

    return rows.select(*keys, column).mapInArrow(cut, schema)


def _of_runs(rows: DataFrame, k: int, run: str = "run") -> DataFrame:
    """One row per k-mer of ``run``."""
    at = F.explode(F.sequence(F.lit(1), F.length(run) - (k - 1)))
    return rows.withColumn("_at", at).withColumn("kmer", F.substr(run, F.col("_at"), F.lit(k))).drop(run, "_at")


def kmer_index(references: DataFrame, taxonomy: DataFrame, k: int) -> DataFrame:
    """k-mer to the lowest common ancestor of all references that contain it.

    The lowest common ancestor of any set of taxa is that of the first and the last of them in depth-first order, so a
    k-mer needs two numbers and no list. Equal runs are combined before they are shuffled, then distinct runs are
    dealt by minimizer; k-mers are cut out of them where they meet and are not shuffled. Every pair of numbers is resolved once.
    """
    sets = nested_sets(taxonomy)
    placed = numbered(references.select("taxid", "seq"), sets, "enter").select("enter", "seq")
    runs = super_kmers(placed, "seq", k).groupBy("minimizer", "run").agg(F.min("enter").alias("low"), F.max("enter").alias("high"))
    bounds = _of_runs(runs.repartition("minimizer"), k).groupBy("minimizer", "kmer").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    bounds = checkpointed(bounds.select("kmer", "low", "high"))
    paths = sets.select("enter", "path")
    pairs = (
        bounds.select("low", "high").distinct()
        .join(paths.select(F.col("enter").alias("low"), F.col("path").alias("a")), "low")
        .join(paths.select(F.col("enter").alias("high"), F.col("path").alias("b")), "high")
        .select("low", "high", F.element_at(_common_prefix(F.col("a"), F.col("b")), -1).alias("taxid"))
    )
    return bounds.join(broadcast_if_small(pairs, MAX_TAXA), ["low", "high"]).select("kmer", "taxid")


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of ``FACTOR`` from the first on and those of its inverse from the zeroth on, modulo 2 ** 64."""
    ups = np.cumprod(np.full(size, FACTOR, np.uint64))
    downs = np.full(size, pow(FACTOR, -1, 1 << 64), np.uint64)
    downs[0] = 1
    return ups, np.cumprod(downs)


def _hashes(text: str, k: int, ups: np.ndarray, downs: np.ndarray) -> np.ndarray:
    """A hash of every k-mer of ``text``: its characters times rising powers, taken from a running sum, so it costs the same for any k."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * ups[:len(codes)], out=sums[1:])
    return (sums[k:] - sums[:-k]) * downs[:len(codes) - k + 1]


def _index_hashes(index: DataFrame, k: int) -> np.ndarray:
    """The hashes of the k-mers of an index that may be broadcast, sorted: 8 bytes for each."""
    at_once = HASHED_AT_ONCE

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ups, downs = _powers(2 * at_once + k)
        for batch in batches:
            for _, pieces in _parts(batch.column(0).to_pylist(), k, at_once):
                starts = np.cumsum([0, *(len(x) for x in pieces[:-1])])
                found = _hashes("".join(pieces), k, ups, downs)[starts]
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["hash"])

    exact = index.where(F.length("kmer") == k).select("kmer")
    return np.unique(exact.mapInArrow(hashed, "hash bigint").toArrow()["hash"].to_numpy().view(np.uint64))


def likely_runs(rows: DataFrame, column: str, k: int, index: DataFrame) -> DataFrame:
    """The other columns of ``rows`` with ``_run``: runs that together hold every k-mer of ``column`` that ``index`` has, each exactly once.

    Most k-mers of reads are in no reference. Tasks hash all k-mers of a read as arrays and let go of those with hashes that the index does not have, so
    only the rest become rows. Different k-mers may share a hash: what is left has to be joined with the index. Runs have at most ``RUN_KMERS`` k-mers.
    """
    keys = [c for c in rows.columns if c != column]
    schema = T.StructType([*rows.select(*keys).schema, T.StructField("_run", T.StringType())])
    at_once, longest = HASHED_AT_ONCE, RUN_KMERS
    shared = rows.sparkSession.sparkContext.broadcast(_index_hashes(index, k))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        ups, downs = _powers(2 * at_once + k)
        # The first bits of a hash name a slot, about 16 for each k-mer of the index; few hashes pass it and are searched for.
        bits = len(known).bit_length() + 4
        shift = np.uint64(64 - bits)
        slots = np.zeros(1 << bits, bool)
        slots[known >> shift] = True
        for batch in batches:
            # bytes that are no text end no job
            texts = [x and x.decode("utf-8", "replace") for x in batch.column(len(keys)).to_pylist()]
            for owners, pieces in _parts(texts, k, at_once):
                whole = "".join(pieces)
                hashes = _hashes(whole, k, ups, downs)
                at = np.flatnonzero(slots[(hashes >> shift).view(np.int64)])
                # k-mers across two pieces are none
                ends = np.cumsum([len(x) for x in pieces])
                piece = np.searchsorted(ends, at, side="right")
                inside = at + k <= ends[piece]
                at, piece = at[inside], piece[inside]
                place = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
                there = known[place] == hashes[at]
                at, piece = at[there], piece[there]
                if not len(at):
                    continue
                new = np.ones(len(at), bool)
                new[1:] = (np.diff(at) != 1) | (np.diff(piece) != 0)
                begin = np.maximum.accumulate(np.where(new, at, 0))
                starts = np.flatnonzero(new | ((at - begin) % longest == 0))
                last = np.append(starts[1:], len(at)) - 1
                runs = [whole[a:b + k] for a, b in zip(at[starts].tolist(), at[last].tolist())]
                of = pa.array(np.array(owners)[piece[starts]])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(of) for c in range(len(keys))), pa.array(runs, pa.string())], names=[*keys, "_run"])

    short_batches(rows.sparkSession)
    return rows.select(*keys, F.col(column).cast("binary").alias(column)).mapInArrow(cut, schema)


def _hot_minimizers(read_runs: DataFrame, fraction: float, limit: int, at_least: int) -> DataFrame:
    """The minimizers with most k-mers in a sample of the runs. They decide what is salted, not what is counted."""
    counts = read_runs.sample(fraction, seed=1).groupBy("minimizer").agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), "minimizer").limit(limit).where(F.col("n") >= at_least)
    return broadcast_if_small(top.select("minimizer", F.lit(True).alias("hot")), limit)


def _met(read_runs: DataFrame, index: DataFrame, hot: DataFrame, keys: list[str], k: int, salts: int) -> DataFrame:
    """Read k-mers (keys, taxid) that the index has, met by minimizer.

    Runs of both sides go to the same partitions by minimizer; their k-mers are cut there, and a k-mer's taxon is handed to all its rows
    inside the partition. Rows of hot minimizers are spread over ``salts`` copies of their part of the index.
    """
    of_index = super_kmers(index, "kmer", k)
    copies = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = of_index.join(hot, "minimizer", "left").withColumn("salt", F.explode(copies))
    spread = F.pmod(F.xxhash64(*keys, "run", F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    left = read_runs.join(hot, "minimizer", "left").withColumn("salt", F.when(F.col("hot"), spread).otherwise(0))
    who = F.struct(*keys)
    kind = read_runs.select(who.alias("who")).schema["who"].dataType
    both = left.select("minimizer", "salt", "run", who.alias("who"), F.lit(None).cast("bigint").alias("own")).unionByName(
        right.select("minimizer", "salt", "run", F.lit(None).cast(kind).alias("who"), F.col("taxid").cast("bigint").alias("own")))
    rows = _of_runs(both.repartition("minimizer", "salt"), k)
    taxid = F.max("own").over(Window.partitionBy("minimizer", "salt", "kmer"))
    return rows.withColumn("taxid", taxid).where(F.col("who").isNotNull() & F.col("taxid").isNotNull()).select("who.*", "taxid")


def kmer_match(
    reads: DataFrame, index: DataFrame, k: int, keys: list[str] | None = None, max_broadcast: int = 1_000_000,
    salts: int = 64, sample: float = 0.001, hot_limit: int = 1000, hot_count: int = 50, seqs: Sequence[str] = ("seq",),
) -> DataFrame:
    """k-mer hits per (read, taxon): ``reads`` has its key columns and ``seqs``, ``("seq1", "seq2")`` for pairs.

    The hits of all sequences of a row are summed, so a pair is classified as one read; a missing mate adds none.

    A k-mer occurs once in the index, so a read k-mer meets at most one row. The index is stored; one of at
    most ``max_broadcast`` rows is broadcast and reads are not shuffled before their hits are counted. Its hashes go
    ahead of it, and only k-mers of reads with such a hash become rows (``likely_runs``).
    Beyond it both sides are shuffled by minimizer as runs of k-mers, with the hottest minimizers salted.
    """
    keys = keys or [*SAMPLE_KEY, "read_id"]
    stored = checkpointed(index.select("kmer", "taxid"))
    # each sequence for itself: no k-mer spans two mates
    single = reads.select(*keys, F.explode(F.array(*seqs)).alias("seq"))
    if has_at_most(stored, max_broadcast):
        matched = _of_runs(likely_runs(single, "seq", k, stored), k, "_run").join(F.broadcast(stored), "kmer")
    else:
        runs = super_kmers(single, "seq", k)
        matched = _met(runs, stored, _hot_minimizers(runs, sample, hot_limit, hot_count), keys, k, salts)
    return matched.groupBy(*keys, "taxid").agg(F.count("*").alias("hits"))


def classify_reads(hits: DataFrame, taxonomy: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The taxon whose path from the root collects most k-mer hits; reads without hits have no row.

    Ties go to the taxon with more hits of its own, then to the smaller taxid. A taxon's hits begin to count for its
    descendants at its number and end behind its last one, so along the numbers of a read a running sum of what began and ended is
    the score of each taxon: one sort of the read's few taxa, no path, no join of the hits with themselves.
    """
    keys = keys or [*SAMPLE_KEY, "read_id"]
    placed = numbered(hits, nested_sets(taxonomy), "enter", "leave")
    none = F.lit(None).cast("bigint")
    steps = placed.select(*keys, F.explode(F.array(
        F.struct(F.col("enter").alias("at"), F.col("hits").alias("step"), F.col("taxid").cast("bigint").alias("taxid"), F.col("hits").alias("own")),
        F.struct((F.col("leave") + 1).alias("at"), (-F.col("hits")).alias("step"), none.alias("taxid"), none.alias("own")))).alias("s"))
    # all rows of the same place count, those that end there too
    score = F.sum("step").over(Window.partitionBy(*keys).orderBy("at"))
    scored = steps.select(*keys, "s.*").withColumn("score", score).where(F.col("taxid").isNotNull())
    best = F.max_by(F.struct("taxid", "score"), F.struct(F.col("score"), F.col("own"), -F.col("taxid")))
    return scored.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.taxid", "_b.score")


def _report_nodes(counts: DataFrame, sets: DataFrame) -> DataFrame:
    """Every sample's taxa with calls and all their ancestors, once each: ``enter`` of the taxon on its path at ``depth``.

    In depth-first order a taxon brings in the part of its path that the taxon before it does not have.
    """
    placed = numbered(counts, sets, "enter", "path")
    before = F.lag("path").over(Window.partitionBy(*SAMPLE_KEY).orderBy("enter"))
    known = F.coalesce(F.size(_common_prefix(F.col("_before"), F.col("path"))), F.lit(0))
    fresh = F.slice("path", F.col("_known") + 1, F.size("path") - F.col("_known"))
    return (
        placed.withColumn("_before", before).withColumn("_known", F.when(F.col("_before").isNull(), 0).otherwise(known))
        .select(*SAMPLE_KEY, F.explode(fresh).alias("taxid"))
    )


def _within(nodes: DataFrame, amounts: DataFrame, name: str) -> DataFrame:
    """``nodes`` with the sum of a sample's ``amounts`` (enter, amount) that lie between ``enter`` and ``leave``: the difference of two running sums."""
    none = F.lit(None).cast("bigint")
    marks = nodes.select(*SAMPLE_KEY, F.explode(F.array(
        F.struct((F.col("enter") - 1).alias("at"), F.col("enter").alias("node"), F.lit(-1).alias("sign")),
        F.struct(F.col("leave").alias("at"), F.col("enter").alias("node"), F.lit(1).alias("sign")))).alias("m"))
    rows = marks.select(*SAMPLE_KEY, "m.*", F.lit(0).cast("bigint").alias("amount")).unionByName(
        amounts.select(*SAMPLE_KEY, F.col("enter").alias("at"), none.alias("node"), F.lit(None).cast("int").alias("sign"), F.col("amount").cast("bigint").alias("amount")))
    so_far = F.sum("amount").over(Window.partitionBy(*SAMPLE_KEY).orderBy("at"))
    sums = rows.withColumn("so_far", so_far).where(F.col("node").isNotNull()).groupBy(*SAMPLE_KEY, F.col("node").alias("enter")).agg(
        F.sum(F.col("so_far") * F.col("sign")).alias(name))
    return nodes.join(sums, [*SAMPLE_KEY, "enter"])


def taxon_report(calls: DataFrame, taxonomy: DataFrame, digits: int = 2) -> DataFrame:
    """Classification report per sample from ``run_id, sample_id, taxid`` (null taxid: unclassified).

    Clade counts include descendants. Lines come in depth-first order, siblings by clade count, with the
    unclassified line first and names indented by depth. Calls are counted per taxon before anything
    is joined, so all later steps have the size of samples times taxa, and every one is a sum along the depth-first numbers:
    a clade's count, its number of lines, and a line's place, which is what its ancestors and it itself have before them among their siblings.
    """
    sets = nested_sets(taxonomy)
    counts = checkpointed(calls.groupBy(*SAMPLE_KEY, "taxid").agg(F.count("*").alias("direct")))
    total = counts.groupBy(*SAMPLE_KEY).agg(F.sum("direct").alias("total"))
    classified = counts.where(F.col("taxid").isNotNull())
    parent = F.when(F.size("path") > 1, F.element_at("path", -2))
    described = sets.select("taxid", "enter", "leave", "rank_code", "name", parent.alias("parent"), F.size("path").alias("depth"))
    nodes = _report_nodes(classified, sets).join(broadcast_if_small(described, MAX_TAXA), "taxid")
    nodes = checkpointed(nodes.join(classified, [*SAMPLE_KEY, "taxid"], "left").withColumn("direct", F.coalesce("direct", F.lit(0))))
    clades = _within(nodes, nodes.select(*SAMPLE_KEY, "enter", F.col("direct").alias("amount")), "clade")
    clades = _within(clades, nodes.select(*SAMPLE_KEY, "enter", F.lit(1).alias("amount")), "n_lines")

    siblings = Window.partitionBy(*SAMPLE_KEY, "parent").orderBy(F.desc("clade"), "taxid").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.lit(1) + F.coalesce(F.sum("n_lines").over(siblings), F.lit(0))
    placed = checkpointed(clades.withColumn("ahead", ahead))
    none = F.lit(None).cast("bigint")
    steps = placed.select(*SAMPLE_KEY, F.explode(F.array(
        F.struct(F.col("enter").alias("at"), F.col("ahead").alias("step"), F.col("enter").alias("enter")),
        F.struct((F.col("leave") + 1).alias("at"), (-F.col("ahead")).alias("step"), none.alias("enter")))).alias("s"))
    place = F.sum("step").over(Window.partitionBy(*SAMPLE_KEY).orderBy("at"))
    lines = steps.select(*SAMPLE_KEY, "s.*").withColumn("place", place).where(F.col("enter").isNotNull()).select(*SAMPLE_KEY, "enter", "place")

    names = F.concat(F.repeat(F.lit("  "), F.col("depth")), "name")
    named = placed.join(lines, [*SAMPLE_KEY, "enter"]).select(*SAMPLE_KEY, "place", "clade", "direct", "rank_code", "taxid", names.alias("name"))
    unclassified = counts.where(F.col("taxid").isNull()).select(
        *SAMPLE_KEY, F.lit(0).cast("bigint").alias("place"), F.col("direct").alias("clade"), "direct", F.lit("U").alias("rank_code"),
        F.lit(0).cast("bigint").alias("taxid"), F.lit("unclassified").alias("name"))
    order = Window.partitionBy(*SAMPLE_KEY).orderBy("place")
    return (
        unclassified.unionByName(named)
        .join(total, SAMPLE_KEY)
        .select(
            *SAMPLE_KEY,
            F.row_number().over(order).alias("line_no"),
            F.bround(F.col("clade") * 100 / F.col("total"), digits).alias("percentage"),
            F.col("clade").alias("count_clade"),
            F.col("direct").alias("count_taxon"),
            "rank_code", "taxid", "name",
        )
    )
