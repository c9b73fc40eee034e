"""Near-duplicate documents by consistent weighted sampling over TF-IDF word shingles.

Documents are multisets of five-word shingles. A shingle weighs ``tf * idf``, with the smoothed ``idf = ln(1 + N / (df + N / SMOOTH))``, in units of
the idf of a shingle of one document. It falls with every further document: at 1 % of all documents to 0.95, at 10 % to 0.69, at a third to 0.45, in all to 0.23.
The smoothing keeps the shingles of a large group of near copies from weighing next to nothing beside the words in which its members
differ. Two documents are near duplicates if the weighted Jaccard similarity, sum of minima over sum of maxima, is at least
``threshold``; classes are the connected components of that relation.

1. Document frequencies, exact for every shingle in more than one of ``EXACT`` documents, in two steps: distinct shingles are counted over
   ``DF_CELLS`` hash cells; where a cell holds more than that, its shingles are counted one by one. There are at most ``EXACT`` times as
   many such shingles as a document has on average. Any other's idf is within 2.6 % of that of a shingle of one document, and is taken to be that;
   up to ``EXACT`` documents there is no other.
2. Sketches. ``SAMPLES`` samples per document by improved consistent weighted sampling (a gamma-distributed step, a gamma-distributed
   score and a uniform shift per shingle and sample): two documents agree in a sample with probability equal to their weighted Jaccard.
   A band is a hash of ``BAND`` samples chosen at random; two documents at 0.8 share one of ``BANDS`` bands in 99.7 % of
   cases, at 0.85 in 99.97 %. Copies of two that share none stay two documents; larger groups usually connect through others.
3. Copies. Documents with the same words in the same order are one class from here on, represented by the smallest id.
4. Candidates without all pairs. In each bucket of a band every member is compared with the bucket's smallest id. Classes that this links
   are found, and buckets that lie in one class are done. In the others, members outside the class of the smallest id are compared with
   the members of other classes inside tasks: the bucket is cut into blocks of bounded size, every two blocks meet in a group of their own,
   and only links leave it, as many as connect its classes. So every two members of a bucket end up either compared or in one class.
5. Every comparison is the exact weighted Jaccard of the two documents' shingles.

Results depend on ids and texts only. Nulls: a null text is an empty one; texts without words are copies of each other. A text of
one to four words is one shingle. A document without an id is no representative: it gets the class of the documents with its words,
null if none has an id. Rows with equal ids are one document in the graph. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import short_batches, sorted_groups, stored
from platewise.llm.components import components
from platewise.session import has_at_most

SHINGLE = 5
SAMPLES, BAND, BANDS = 48, 6, 40
DF_CELLS = 1 << 18
#: Part of the documents that smooths frequencies, and part up to which a shingle counts as rare.
SMOOTH, EXACT = 16, 200
#: Bytes of texts and words that are worked on at once.
SLICE, PORTION = 2 << 20, 1 << 18
#: Rows and shingles of a block of a bucket, and elements of a matrix.
BLOCK_ROWS, BLOCK_SHINGLES, COLUMNS = 512, 400_000, 2048
#: Representatives whose ids may be broadcast: 8 bytes each.
MAX_BROADCAST_IDS = 500_000
U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _cuts(data: np.ndarray, offsets: np.ndarray) -> list[int]:
    """Places that cut the texts into slices of about ``SLICE`` bytes, never inside a word."""
    cuts = [0]
    while cuts[-1] + SLICE < len(data):
        begin, end = cuts[-1], cuts[-1] + SLICE
        while True:
            window = data[begin:end]
            blank = np.flatnonzero((window == 32) | ((window >= 9) & (window <= 13)))
            texts = offsets[np.searchsorted(offsets, begin, side="right"):np.searchsorted(offsets, end, side="right")]
            found = max(begin + int(blank[-1]) + 1 if len(blank) else 0, int(texts[-1]) if len(texts) else 0)
            if found > cuts[-1]:
                break
            if end >= len(data):  # one word to the end
                found = len(data)
                break
            begin, end = end, end + SLICE
        if found >= len(data):
            break
        cuts.append(found)
    return [*cuts, len(data)]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of UTF-8 texts laid out one after the other, and the text of each.

    A word is a run of anything but the six ASCII white space bytes, so bytes can be looked at without decoding. The work is done
    in slices that end between words: it takes about 40 bytes for each byte of a slice, whatever the length of a text.
    """
    hashes, begins = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    cuts = _cuts(data, offsets)
    for a, b in zip(cuts, cuts[1:]):
        inner = offsets[np.searchsorted(offsets, a):np.searchsorted(offsets, b)]
        h, begin = _hashed(data[a:b], inner - a)
        hashes.append(h)
        begins.append(begin + a)
    begin = np.concatenate(begins)
    return np.concatenate(hashes), np.searchsorted(offsets, begin, side="right") - 1


def _hashed(data: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the words of a slice, in which texts begin at the given places."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    starts_text = np.zeros(len(data) + 1, bool)
    starts_text[texts] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    begin = np.nonzero(inside & (~before | starts_text[:-1]))[0]
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    end = np.nonzero(inside & (~after | starts_text[1:]))[0] + 1
    # A polynomial in the bytes, evaluated for all words at once from the running sum; powers start anew in each word.
    longest = int((end - begin).max()) if len(begin) else 0
    power = np.cumprod(np.concatenate([[U(1)], np.full(min(longest, 1 << 22), _ODD, U)]), dtype=U)
    place = np.arange(len(data)) - np.repeat(begin, end - begin)[np.cumsum(inside) - 1] if len(begin) else np.zeros(len(data), np.int64)
    terms = np.where(inside, (data.astype(U) + U(1)) * power[np.where(inside, place, 0) % len(power)], U(0))
    running = np.concatenate([[U(0)], np.cumsum(terms, dtype=U)])
    return _mix(running[end] - running[begin] + (end - begin).astype(U) * _ODD), begin


def shingles(hashes: np.ndarray, document: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each document with their counts, and a 128-bit fingerprint of its words.

    Returns shingle hashes and counts sorted by document, the first place of each document (one more entry), and fingerprints (n, 2).
    Beside the words and their shingles only portions of ``PORTION`` words are held.
    """
    words = np.bincount(document, minlength=documents)
    first = np.concatenate([[0], np.cumsum(words)])
    rolling, starts = np.empty(len(hashes), U), np.empty(len(hashes), bool)
    salts = (U(0x1234567), U(0x89ABCDE))
    sums = np.zeros((documents, 2), U)
    for a in range(0, len(hashes), PORTION):
        b = min(a + PORTION, len(hashes))
        owner = document[a:b]
        place, size = np.arange(a, b) - first[owner], words[owner]
        now = np.zeros(b - a, U)
        ahead = np.zeros(b - a + SHINGLE, U)
        ahead[:min(b + SHINGLE, len(hashes)) - a] = hashes[a:b + SHINGLE]
        for k in range(SHINGLE):
            # Texts shorter than a shingle are one shingle of what they have.
            now = _mix(now * _ODD + np.where(place + k < size, ahead[k:k + b - a], U(0)) + U(k))
        rolling[a:b] = now
        starts[a:b] = (place <= size - SHINGLE) | (place == 0)
        begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        for k, salt in enumerate(salts):
            terms = _mix(hashes[a:b] ^ _mix(place.astype(U) * _ODD + salt))
            sums[owner[begins], k] += np.add.reduceat(terms, begins)
    prints = _mix(sums + words.astype(U)[:, None])
    found, owner = rolling[starts], document[starts]
    del rolling, starts
    if documents == 1:
        found.sort()
    else:
        order = np.lexsort((found, owner))
        found, owner = found[order], owner[order]
    new = np.concatenate([[True], (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])]) if len(found) else np.zeros(0, bool)
    at = np.nonzero(new)[0]
    counts = np.diff(np.concatenate([at, [len(found)]]))
    found, owner = found[at], owner[at]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=documents))])
    return found, counts, bounds, prints


def _quantiles(cells: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1) in the middle of equal cells, and their logarithms, by Newton steps on x -> 1 - (1 + x) exp(-x)."""
    p = (np.arange(cells) + 0.5) / cells
    x = np.sqrt(2 * p) + p
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / (x * np.exp(-x)), 1e-9)
    return x, np.log(x)


class Sampler:
    """Improved consistent weighted sampling of many weighted sets at once."""

    def __init__(self, samples: int = SAMPLES, band: int = BAND, bands: int = BANDS, seed: int = 7):
        random = np.random.default_rng(seed)
        self.salts = random.integers(1, 1 << 63, samples, dtype=np.uint64)
        self.bands = [np.sort(random.choice(samples, band, replace=False)) for _ in range(bands)]
        self.gamma, self.log_gamma = _quantiles()

    def samples(self, found: np.ndarray, weights: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """(documents, samples) 64-bit samples; a document without shingles has zeros."""
        full = np.nonzero(np.diff(bounds))[0]
        out = np.zeros((len(bounds) - 1, len(self.salts)), U)
        if not len(full):
            return out
        starts, log_weight = bounds[full], np.log(weights)
        least = np.full((len(self.salts), len(full)), np.iinfo(U).max, U)
        for a in range(0, len(found), PORTION):
            b = min(a + PORTION, len(found))
            # The documents of this portion and where each begins in it.
            low, high = np.searchsorted(starts, a, side="right") - 1, np.searchsorted(starts, b)
            own = np.maximum(starts[low:high] - a, 0)
            part = found[a:b]
            # Most shingles weigh 1 and have level 0; only the others need the division.
            other = np.nonzero(log_weight[a:b])[0]
            log_other = log_weight[a:b][other]
            at = np.arange(a, b, dtype=U)
            for k, salt in enumerate(self.salts):
                h = _mix(part ^ salt)
                step = self.gamma[(h >> U(50)).view(np.int64)]
                shift = (h & U(0xFFFFFFFF)).astype(np.float64)
                shift *= 2.0**-32
                offset = 1 - shift
                offset[other] += np.floor(log_other / step[other] + shift[other])
                value = self.log_gamma[((h >> U(36)) & U(0x3FFF)).view(np.int64)]
                value -= step * offset
                # The order of the values in the upper half, the place in the lower: the least is the sample. Places of a document are
                # in the order of its shingles, so equal values are decided alike in every document.
                bits = value.astype(np.float32).view(np.uint32)
                bits ^= (bits.view(np.int32) >> 31).view(np.uint32) | np.uint32(1 << 31)
                least[k, low:high] = np.minimum(least[k, low:high], np.minimum.reduceat((bits.astype(U) << U(32)) | at, own))
        for k, salt in enumerate(self.salts):
            chosen = (least[k] & U(0xFFFFFFFF)).astype(np.int64)
            h = _mix(found[chosen] ^ salt)
            levels = np.floor(log_weight[chosen] / self.gamma[(h >> U(50)).view(np.int64)] + (h & U(0xFFFFFFFF)).astype(np.float64) * 2.0**-32).astype(np.int64)
            out[full, k] = _mix(h + levels.view(U) * _ODD) >> U(32)
        return out

    def band_keys(self, samples: np.ndarray) -> np.ndarray:
        """(documents, bands) hashes of the samples in each band."""
        keys = np.zeros((len(samples), len(self.bands)), U)
        for k, chosen in enumerate(self.bands):
            h = np.full(len(samples), U(k + 1))
            for c in chosen:
                h = _mix(h * _ODD + samples[:, c])
            keys[:, k] = h
        return keys


def laid_out(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts, and where each text begins (one more entry than texts). Null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def shingled(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return shingles(*word_hashes(*laid_out(texts)), len(texts))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def idf_weight(documents: int, frequency: float) -> float:
    """Smoothed idf of a shingle in ``frequency`` of the documents; 1 for a shingle of one document."""
    smoothing = documents / SMOOTH
    return math.log(1 + documents / (frequency + smoothing)) / math.log(1 + documents / (1 + smoothing))


def common_shingles(docs: DataFrame, text: str = "text") -> tuple[dict[int, float], int]:
    """Idf by shingle, of all shingles that are not rare, and the number of documents. Exact counts over all documents."""
    texts = docs.select(F.col(text).alias("text"))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, documents = np.zeros(DF_CELLS, np.int64), 0
        for batch in batches:
            found, *_ = shingled(batch.column(0))
            total += np.bincount((found >> U(40)).astype(np.int64) % DF_CELLS, minlength=DF_CELLS)
            documents += batch.num_rows
        there = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(there, -1)), pa.array(np.append(total[there], documents))], names=["cell", "n"])

    counted = stored(texts.mapInArrow(cells, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")), "shingle-cells")
    documents = counted.filter(F.col("cell") == -1).agg(F.sum("n")).first()[0] or 0
    heavy = {r["cell"] for r in counted.filter((F.col("cell") >= 0) & (EXACT * F.col("n") > documents)).collect()}  # at most DF_CELLS numbers
    if not heavy:
        return {}, documents
    wanted = np.zeros(DF_CELLS, bool)
    wanted[list(heavy)] = True

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, *_ = shingled(batch.column(0))
            one, n = np.unique(found[wanted[(found >> U(40)).astype(np.int64) % DF_CELLS]], return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(one), pa.array(n)], names=["shingle", "n"])

    often = texts.mapInArrow(counts, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n")).filter((F.col("n") > 1) & (EXACT * F.col("n") > documents))
    # At most EXACT times as many as a document has shingles on average.
    return {r["shingle"]: idf_weight(documents, r["n"]) for r in often.collect()}, documents


class Weights:
    """Weights of shingles: count times idf, the idf looked up among the common ones."""

    def __init__(self, common: dict[int, float]):
        keys = np.array(sorted(common), np.int64)
        self.keys, self.values = keys.view(U), np.array([common[int(k)] for k in keys])
        order = np.argsort(self.keys)
        self.keys, self.values = self.keys[order], self.values[order]

    def of(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = counts.astype(np.float64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
            weights = np.where(self.keys[at] == found, weights * self.values[at], weights)
        return weights


def sketches(docs: DataFrame, weights: Weights, sampler: Sampler, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, p1, p2, weight, bands): fingerprint of the words, total weight, hashes of the bands (none without words)."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts, bounds, prints = shingled(batch.column(1))
            weight = weights.of(found, counts)
            keys = sampler.band_keys(sampler.samples(found, weight, bounds))
            total = np.concatenate([[0], np.cumsum(weight)])
            has = np.diff(bounds) > 0
            width = np.where(has, keys.shape[1], 0)
            bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(width)]), pa.int32()), _signed(keys[has].ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _signed(prints[:, 0]), _signed(prints[:, 1]), pa.array(total[bounds[1:]] - total[bounds[:-1]]), bands],
                names=["doc_id", "p1", "p2", "weight", "bands"])

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(sketch, "doc_id bigint, p1 bigint, p2 bigint, weight double, bands array<bigint>")


def shingle_sets(docs: DataFrame, weights: Weights, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (rep, shingles, weights): the weighted set of each document, sorted by shingle."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts, bounds, _ = shingled(batch.column(1))
            at = pa.array(bounds, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.ListArray.from_arrays(at, _signed(found)),
                pa.ListArray.from_arrays(at, pa.array(weights.of(found, counts).astype(np.float32))),
            ], names=["rep", "shingles", "weights"])

    return docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).alias("text")).mapInArrow(sets, "rep bigint, shingles array<bigint>, weights array<float>")


def weighted_jaccard(sa: pd.Series, wa: pd.Series, sb: pd.Series, wb: pd.Series) -> pd.Series:
    """Sum of minima over sum of maxima of two weighted sets."""
    found = []
    for a, x, b, y in zip(sa, wa, sb, wb):
        _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
        both = np.minimum(x[i], y[j]).sum(dtype=np.float64)
        total = x.sum(dtype=np.float64) + y.sum(dtype=np.float64) - both
        found.append(both / total if total > 0 else 1.0)
    return pd.Series(found)


def _expanded(found: np.ndarray, owner: np.ndarray, amount: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted sets as plain ones: a shingle that occurs n times gives n elements, each weighing its idf."""
    times = np.maximum(np.rint(amount / idf).astype(np.int64), 1)
    copy = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    element = np.repeat(found, times)
    return np.where(copy > 0, _mix(element + copy.astype(U) * _ODD), element), np.repeat(owner, times), np.repeat(idf, times)


def similarities(element: np.ndarray, owner: np.ndarray, idf: np.ndarray, mine: np.ndarray, other: np.ndarray, documents: int) -> np.ndarray:
    """Weighted Jaccard of documents in ``mine`` with others in ``other``, as products of matrices of ``COLUMNS`` elements at a time.

    Elements of one document only are left out of the matrices, so what it says of a document and itself means nothing.
    """
    _, first, column, times = np.unique(element, return_index=True, return_inverse=True, return_counts=True)
    total = np.bincount(owner, idf, documents)
    shared = np.nonzero(times > 1)[0]
    both = np.zeros((len(mine), len(other)))
    number = np.full(len(times), -1)
    number[shared] = np.arange(len(shared))
    column, weight = number[column], idf[first][shared]
    order = np.argsort(column, kind="stable")
    bounds = np.searchsorted(column[order], np.arange(0, len(shared) + COLUMNS, COLUMNS))
    for start, (a, b) in zip(range(0, len(shared), COLUMNS), zip(bounds[:-1], bounds[1:])):
        part = order[a:b]
        dense = np.zeros((documents, min(COLUMNS, len(shared) - start)))
        dense[owner[part], column[part] - start] = 1
        both += (dense[mine] * weight[start:start + COLUMNS]) @ dense[other].T
    return both / (total[mine][:, None] + total[other][None, :] - both)


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of edges that are enough to connect what all edges a[i] - b[i] connect: one less than there are nodes at most."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[y] = x
            kept.append(k)
    return np.array(kept, np.int64)


def _block_links(weights: Weights, threshold: float):
    """Task code: links between members of different classes in sorted groups of two blocks (or one) of a bucket."""
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ("band", "key", "low", "high")):
            column = {c: group.column(c).to_numpy() for c in ("rep", "component", "outside", "block", "low", "high")}
            low, high, block, ids = column["low"][0], column["high"][0], column["block"], column["rep"]
            if not column["outside"].any():
                continue
            sets = group.column("shingles").combine_chunks()
            found = sets.flatten().to_numpy().view(U)
            owner = np.repeat(np.arange(len(sets)), np.diff(sets.offsets.to_numpy()))
            amount = group.column("weights").combine_chunks().flatten().to_numpy().astype(np.float64)
            mine, other = np.nonzero(block == low)[0], np.nonzero(block == high)[0]
            similar = similarities(*_expanded(found, owner, amount, weights.of(found, np.ones(len(found)))), mine, other, len(ids))
            i, j = np.nonzero(similar >= threshold - 1e-9)
            i, j = mine[i], other[j]
            classes = column["component"]
            new = (classes[i] != classes[j]) & (column["outside"][i] | column["outside"][j])
            kept = spanning(classes[i[new]], classes[j[new]])
            yield pa.RecordBatch.from_arrays([pa.array(ids[i[new][kept]]), pa.array(ids[j[new][kept]])], names=["a", "b"])

    return links


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (a, b) whose weighted Jaccard is at least the threshold."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"), F.col("weights").alias("wa"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"), F.col("weights").alias("wb"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    similarity = F.pandas_udf(weighted_jaccard, "double")
    return joined.filter(similarity("sa", "wa", "sb", "wb") >= threshold - 1e-9).select("a", "b")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """Rows (doc_id, rep, class_id), one per row of ``docs``: the smallest id with the same words, and the smallest of the class."""
    short_batches(docs.sparkSession)
    common, _ = common_shingles(docs, text)
    weights = Weights(common)
    sketched = stored(sketches(docs, weights, Sampler(), doc_id, text), "neardup-sketches")
    reps = stored(sketched.groupBy("p1", "p2").agg(F.min("doc_id").alias("rep")), "neardup-copies")
    prints = sketched.select("doc_id", "p1", "p2", "weight")
    members = stored(prints.join(reps, ["p1", "p2"]).select("doc_id", "rep"), "neardup-members")

    # One row per representative and band; equal rows of one document fall together.
    own = sketched.join(reps.select("p1", "p2", "rep"), ["p1", "p2"]).filter(F.col("doc_id") == F.col("rep"))
    rows = own.select("rep", "weight", F.posexplode("bands").alias("band", "key"))
    buckets = rows.groupBy("band", "key").agg(F.min("rep").alias("center"), F.max("rep").alias("last")).filter(F.col("center") != F.col("last")).drop("last")
    shared = stored(rows.join(stored(buckets, "neardup-buckets"), ["band", "key"]), "neardup-shared")

    def similar_size(a: Column, b: Column) -> Column:
        return F.least(a, b) >= (threshold - 1e-6) * F.greatest(a, b)

    centers = shared.filter(F.col("rep") == F.col("center")).select("center", F.col("weight").alias("center_weight")).distinct()
    stars = shared.filter(F.col("rep") != F.col("center")).select("rep", "weight", "center").distinct().join(stored(centers, "neardup-centers"), "center")
    stars = stored(stars.filter(similar_size(F.col("weight"), F.col("center_weight"))).select(F.col("center").alias("a"), F.col("rep").alias("b")), "neardup-stars")
    wanted = _few(stored(shared.select(F.col("rep").alias("wanted")).distinct(), "neardup-wanted"))
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(wanted, F.col("id") == F.col("wanted"), "left_semi")
    sets = stored(shingle_sets(texts, weights, "id", "text"), "neardup-sets")
    links = stored(_verified(stars, sets, threshold), "neardup-links")

    # Buckets with members outside the class of their smallest id: these against the members of other classes, block by block.
    classes = stored(components(links), "neardup-classes")
    named = shared.join(classes, shared["rep"] == classes["node"], "left").select("band", "key", "rep", "weight", "center", F.coalesce("component", "rep").alias("component"))
    of_center = classes.select(F.col("node").alias("center_node"), F.col("component").alias("center_component"))
    named = named.join(of_center, F.col("center") == F.col("center_node"), "left")
    named = stored(named.withColumn("outside", F.col("component") != F.coalesce("center_component", "center")).drop("center_node", "center_component"), "neardup-named")
    load = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("weight") / BLOCK_SHINGLES)).cast("int")
    mixed = named.groupBy("band", "key").agg(F.max("outside").alias("any_outside"), load.alias("blocks")).filter("any_outside").drop("any_outside")
    inside = stored(named.join(stored(mixed, "neardup-mixed"), ["band", "key"]), "neardup-inside")
    dealt = inside.withColumn("block", F.pmod(F.xxhash64("rep", F.lit(3)), F.col("blocks").cast("long")).cast("int"))
    dealt = dealt.join(sets, "rep").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("band", "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "rep", "component", "outside", "shingles", "weights")
    group = ["band", "key", "low", "high"]
    more = stored(dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(_block_links(weights, threshold), "a bigint, b bigint"), "neardup-more")
    final = stored(components(classes.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)), "neardup-components")
    found = members.join(final, F.col("rep") == F.col("node"), "left")
    return found.select("doc_id", "rep", F.coalesce("component", "rep").alias("class_id"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """One document of each class, the one with the smallest id. Rows without an id cannot be told apart and stay.

    Rows that repeat an id with an equal text are one; with another text they stay, as their texts need not be alike.
    """
    found = near_duplicates(docs, doc_id, text, threshold)
    gone = _few(stored(found.filter(F.col("doc_id") != F.col("class_id")).select(F.col("doc_id").alias("gone_id")).distinct(), "neardup-gone"))
    kept = docs.join(gone, F.col(f"`{doc_id}`").cast("long") == F.col("gone_id"), "left_anti")
    repeated = found.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("again_id")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    again = stored(repeated.select("again_id"), "neardup-again")
    if not has_at_most(again, 0):
        on = F.col(f"`{doc_id}`").cast("long") == F.col("again_id")
        kept = kept.join(_few(again), on, "left_anti").unionByName(kept.join(_few(again), on, "left_semi").dropDuplicates([doc_id, text]))
    return kept


def _few(ids: DataFrame) -> DataFrame:
    """A stored table of ids, with a broadcast hint if its number of rows is checked to be small."""
    return F.broadcast(ids) if has_at_most(ids, MAX_BROADCAST_IDS) else ids
