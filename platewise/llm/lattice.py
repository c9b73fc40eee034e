"""Near-duplicate embeddings by lattice hashing.

Vectors are scaled to unit length in double precision. Each of ``TABLES`` tables projects them to 8 dimensions by a random orthonormal
basis and decodes the point, scaled and shifted, to the nearest point of the E8 lattice. A vector lies in the cell of its lattice point
and also looks into the ``PROBES`` neighbouring cells that are nearest to it. Vectors that meet in a cell are compared by
their exact cosine, matrix by matrix inside a task; links of at least the threshold are all that leaves it.

With the defaults two vectors at cosine 0.9 meet in a table with probability 0.55 and are missed by all ten with 0.0004; at greater
cosines less. A cell may hold any number of vectors: cells of more than ``BLOCK`` rows are cut into blocks of rows, and every two blocks
of a cell form a group of their own, so nothing is left out and no task gets a whole hot cell. Equal vectors are one vector
with a multiplicity, which is counted in the links of its neighbours and of its copies.

Nulls: vectors that are null, zero, or hold null or non-finite components link with nothing and form components of their own; vectors of
another dimension than the first one are an error. Repeated ids count as vectors of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import short_batches, stored
from platewise.llm.components import components

TABLES, PROBES, SCALE, BLOCK = 10, 3, 4.0, 512


def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or eight of +-1/2 with an even number of minus signs."""
    found = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            found.append(v)
    found += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(found)


def _even_integers(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer entries of even sum: round, and where the sum is odd round the worst entry the other way."""
    near = np.rint(x)
    rows = np.nonzero(near.sum(1) % 2)[0]
    off = x[rows] - near[rows]
    worst = np.abs(off).argmax(1)
    near[rows, worst] += np.where(off[np.arange(len(rows)), worst] >= 0, 1, -1)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 lattice points: the better of the even integers and the even integers shifted by one half."""
    a, b = _even_integers(x), _even_integers(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.where(closer[:, None], a, b)


class LatticeTables:
    """Random projections with the cells of vectors in each: the own cell, and neighbouring ones to look into."""

    def __init__(self, dimension: int, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, seed: int = 11):
        random = np.random.default_rng(seed)
        width = max(dimension, 8)
        self.bases = [np.linalg.qr(random.normal(size=(width, 8)))[0][:dimension] * scale * np.sqrt(width / 64) for _ in range(tables)]
        self.shifts = [random.random(8) for _ in range(tables)]
        self.primes = random.integers(1, 1 << 62, (tables, 8)) | 1
        self.around, self.probes = neighbours(), probes

    def _name(self, table: int, points: np.ndarray) -> np.ndarray:
        return (np.rint(2 * points).astype(np.int64) * self.primes[table]).sum(-1) + table

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own cells (n, tables) and probed cells (n, tables, probes) as 64-bit names."""
        own, probed = [], []
        for k, (basis, shift) in enumerate(zip(self.bases, self.shifts)):
            x = unit @ basis + shift
            points = decode(x)
            nearest = np.argpartition(-((x - points) @ self.around.T), self.probes, axis=1)[:, :self.probes]
            own.append(self._name(k, points))
            probed.append(self._name(k, points[:, None, :] + self.around[nearest]))
        return np.stack(own, 1), np.stack(probed, 1)


def usable(embedding: Column) -> Column:
    """True for vectors that can have a cosine."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(embedding, number) & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled to length 1 in double precision, large and small numbers alike."""
    x = vectors / np.abs(vectors).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def cell_rows(vectors: DataFrame, tables: LatticeTables, dimension: int) -> DataFrame:
    """Rows (cell, at_home, id, names, vector) of distinct vectors (id, vector), one per cell that a vector lies in or probes."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data = batch.column(1)
            if (np.diff(data.offsets.to_numpy()) != dimension).any():
                raise ValueError(f"all vectors must have {dimension} dimensions")
            own, probed = tables.cells(_unit(_matrix(data)))
            n, t, p = probed.shape
            cell = np.concatenate([own[:, :, None], probed], 2)
            who = np.repeat(np.arange(n), t * (p + 1))
            yield pa.RecordBatch.from_arrays([
                pa.array(cell.ravel()), pa.array(np.tile(np.arange(p + 1) == 0, n * t)), batch.column(0).take(pa.array(who)),
                pa.array(np.tile(np.repeat(np.arange(t, dtype=np.int32), p + 1), n)),
                pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * t), pa.array(own.ravel())).take(pa.array(who)),
                data.take(pa.array(who)),
            ], names=["cell", "at_home", "id", "place", "names", "vector"])

    kind = dict(vectors.dtypes)["vector"]
    return vectors.mapInArrow(rows, f"cell bigint, at_home boolean, id bigint, place int, names array<bigint>, vector {kind}")


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """A batch of cell rows as arrays, the vectors scaled to length 1."""
    found = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "low", "high", "block", "id", "at_home", "place")}
    return found | {"names": batch.column("names").flatten().to_numpy().reshape(batch.num_rows, -1), "unit": _unit(_matrix(batch.column("vector")))}


def _links_of_group(rows: dict[str, np.ndarray], begin: int, end: int, threshold: float) -> np.ndarray:
    """Links between rows begin .. end, one group: the pairs of which one row at least is at home, across its two blocks or within its one."""
    block = rows["block"][begin:end]
    low, high = rows["low"][begin], rows["high"][begin]
    mine = begin + np.nonzero(block == low)[0]
    other = mine if low == high else begin + np.nonzero(block == high)[0]
    unit, ids, home, names, place = rows["unit"], rows["id"], rows["at_home"], rows["names"], int(rows["place"][begin])
    found = []
    for start in range(0, len(mine), BLOCK):
        some = mine[start:start + BLOCK]
        i, j = np.nonzero(unit[some] @ unit[other].T >= threshold)
        i, j = some[i], other[j]
        wanted = (home[i] | home[j]) & ((ids[i] < ids[j]) if low == high else (ids[i] != ids[j]))
        i, j = i[wanted], j[wanted]
        if place and len(i):
            # A pair at home in one cell of an earlier table was found there.
            new = ~(names[i, :place] == names[j, :place]).any(1)
            i, j = i[new], j[new]
        found.append(np.stack([np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])], 1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _meeting(threshold: float):
    """Task code: links of all groups of a partition sorted by group. One group is held over from batch to batch, no more."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def of(rows: dict, bounds: np.ndarray) -> pa.RecordBatch:
            pairs = [_links_of_group(rows, a, b, threshold) for a, b in zip(bounds[:-1], bounds[1:]) if b - a > 1]
            both = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _columns(batch)
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
            change = np.zeros(len(rows["cell"]) - 1, bool)
            for c in ("cell", "low", "high"):
                change |= rows[c][1:] != rows[c][:-1]
            bounds = np.concatenate([[0], np.nonzero(change)[0] + 1])
            yield of(rows, bounds)
            held = {c: x[bounds[-1]:] for c, x in rows.items()}
        if held is not None:
            yield of(held, np.array([0, len(held["cell"])]))

    return meet


def links(vectors: DataFrame, threshold: float = 0.9, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> DataFrame:
    """Links (a, b), a < b, between distinct stored vectors (id, vector)."""
    first = vectors.select(F.size("vector")).first()
    if first is None:
        return vectors.select(F.col("id").alias("a"), F.col("id").alias("b"))
    short_batches(vectors.sparkSession)
    rows = stored(cell_rows(vectors, LatticeTables(first[0], tables, probes, scale), first[0]), "lattice-cells")
    # Cells in which somebody is at home with company, and how many blocks they need.
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("at_home").alias("any_home")).filter((F.col("n") > 1) & F.col("any_home"))
    sizes = stored(sizes.select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "lattice-sizes")
    dealt = rows.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks").cast("long")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    grouped = (
        dealt.withColumn("other", other).withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
        .drop("blocks", "other")
    )
    group = ["cell", "low", "high"]
    found = grouped.repartition(*group).sortWithinPartitions(*group).mapInArrow(_meeting(threshold), "a bigint, b bigint")
    return stored(found.distinct(), "lattice-links")


def near_vectors(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.9, **options) -> DataFrame:
    """Rows (vec_id, n_links, component_id), one per row of the table."""
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vector"))
    good = usable(F.col("vector"))
    # -0.0 and 0.0 are one number.
    same = stored(rows.filter(good).groupBy(F.transform("vector", lambda x: x + 0.0).cast(dict(rows.dtypes)["vector"]).alias("vector")).agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "lattice-vectors")
    pairs = links(same.select("id", "vector"), threshold, **options)
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("id"), F.col("a").alias("other")))
    weight = same.select(F.col("id").alias("other"), "copies")
    degree = stored(both.join(weight, "other").groupBy("id").agg(F.sum("copies").alias("near")), "lattice-degrees")
    classes = stored(components(pairs), "lattice-classes")
    known = same.join(degree, "id", "left").join(classes, F.col("id") == F.col("node"), "left").select(
        F.col("vector").alias("v"), (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    known = stored(known, "lattice-known")
    key = F.when(good, F.transform("vector", lambda x: x + 0.0).cast(dict(rows.dtypes)["vector"]))
    joined = rows.withColumn("k", key).join(known, F.col("k") == F.col("v"), "left")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
