"""Phrase collocations from weighted acyclic automata over words.

A text is cut into pieces at ``. , ; : ! ?`` and line ends, a piece into words; everything is counted per language. A candidate is a phrase of
two to ``longest`` words with a count ``a`` of at least ``least``. A cut after its first k words has parts with counts ``l`` and ``r`` and the score
``floor(10**6 * a * a / (l * r))``; a candidate has the score of its worst cut.

1. Shards. A task numbers the words of its texts, slice by slice, up to ``SHARD_WORDS`` words, and counts all n-grams of one to ``longest`` words by
   sorting their codes. Every prefix of an n-gram is an n-gram of the shard too, so the sorted n-grams are a trie in levels.
2. Prefix ranges. The space of sorted n-grams is divided at boundaries from a bounded sample (``SAMPLED`` n-grams for each range): the boundaries decide which task
   counts an n-gram, never what is counted. A boundary may lie between two continuations of one word, so a very frequent first word
   is spread over many ranges.
3. Transducers. What a shard has in a range becomes a minimal acyclic transducer: arcs carry a word and, as output, the count of the n-gram that ends there.
   It is built bottom up from the sorted n-grams, portion by portion; a state is looked up in a register of all states by its arcs, so that
   equal continuations (most of them a single word seen once) are stored once.
4. Union. The transducers of a range and language are unfolded and added: equal n-grams become one, their counts are summed. Only then is the threshold
   applied. A part of a phrase is at least as frequent as the phrase, so no count that a candidate needs is lost.
5. Parts. The parts of all candidates, each once, are sent to the range that holds them; they form an acceptor, and its composition with the transducer
   of the range reads off the counts. Scores are exact decimals.

Nulls: a null text is an empty one, a null language ``und``. Texts without words count nothing; repeated rows count each time. Ties rank by
count, then phrase in the order of UTF-8 bytes. An empty table gives an empty result; columns with other names are not looked at. A range is
held by one task: its size is about ``RANGE_BYTES`` of text, more only beyond ``MAX_RANGES`` ranges.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platewise.llm.common import short_batches, sorted_groups, stored

LONGEST, LEAST, COVERED, TOP = 3, 10, 50, 2000
SHARD_WORDS, SLICE, PORTION = 1_500_000, 1 << 20, 1 << 18
RANGE_BYTES, MAX_RANGES, SAMPLED = 8 << 20, 100_000, 4
#: Nodes that may wait unfolded before they are added up.
WAITING = 3_000_000
#: Letters A-Z lowered, separators of pieces to one of them, tab to space.
TRANSLATE = bytes(b + 32 if 65 <= b <= 90 else 46 if chr(b) in ".,;:!?\n\v\f\r" else 32 if b == 9 else b for b in range(256))

#: A trie in levels: for each n-gram of a level its prefix's place in the level before, its last word and its count, sorted.
Levels = list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def tokens(data: bytes, size: int = SLICE) -> Iterator[list[bytes]]:
    """Words of a text and ``b"."`` where a piece ends, slice by slice. No slice ends inside a word."""
    at, held = 0, b""
    while at < len(data):
        piece = data[at:at + size].translate(TRANSLATE)
        at += len(piece)
        end = len(piece) if at >= len(data) else max(piece.rfind(b" "), piece.rfind(b".")) + 1
        if not end:
            held += piece
            continue
        yield (held + piece[:end]).replace(b".", b" . ").split()
        held = piece[end:]
    if held:
        yield [held]


def grouped(codes: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes in order, their summed weights (or how often they occur), and the place of each code among them."""
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(codes) else np.zeros(0, bool)
    at = np.nonzero(new)[0]
    place = np.empty(len(codes), np.int64)
    place[order] = np.cumsum(new) - 1
    if weights is None:
        return ordered[at], np.diff(np.append(at, len(codes))), place
    return ordered[at], np.add.reduceat(weights[order], at) if len(at) else np.zeros(0, np.int64), place


def count_ngrams(labels: np.ndarray, n_words: int, longest: int) -> Levels:
    """All n-grams of a row of labels, in which -1 ends a piece; ``n_words`` labels exist."""
    at = np.nonzero(labels >= 0)[0]
    node = np.full(len(labels) + 1, -1, np.int64)
    found, n, place = grouped(labels[at].astype(np.int64))
    node[at] = place
    levels = [(np.zeros(len(found), np.int64), found, n)]
    padded = np.concatenate([labels.astype(np.int64), np.full(longest, -1)])
    for m in range(1, longest):
        at = at[padded[at + m] >= 0]
        found, n, place = grouped(node[at] * n_words + padded[at + m])
        node[at] = place
        levels.append((found // max(n_words, 1), found % max(n_words, 1), n))
    return levels


def cut_at(levels: Levels, words: list[bytes], boundary: tuple[bytes, ...]) -> list[int]:
    """For every level, how many of its n-grams lie before the boundary; a prefix of the boundary does."""
    places, node, exact = [], 0, True
    for m, (parent, label, _) in enumerate(levels):
        if not exact or m >= len(boundary):
            # The n-grams below all nodes before the place found in the level before.
            node = int(np.searchsorted(parent, node + (exact and m > 0)))
            exact = False
            places.append(node)
            continue
        a, b = (0, len(label)) if m == 0 else np.searchsorted(parent, (node, node + 1))
        word = bisect_left(words, boundary[m])
        node = int(a + np.searchsorted(label[a:b], word))
        exact = node < b and word < len(words) and words[word] == boundary[m] and int(label[node]) == word
        places.append(node + (exact and m + 1 < len(boundary)))
    return places


def between(levels: Levels, lower: list[int], upper: list[int]) -> Levels | None:
    """The n-grams between two cuts, with the prefixes that lead to them (with count 0 if they lie outside); None if there are none."""
    need = list(zip(lower, upper))
    if all(a >= b for a, b in need):
        return None
    for m in range(len(levels) - 1, 0, -1):
        a, b = need[m]
        if a < b:
            parent = levels[m][0]
            low, high = int(parent[a]), int(parent[b - 1]) + 1
            c, d = need[m - 1]
            need[m - 1] = (min(c, low), max(d, high)) if c < d else (low, high)
    out, begin = [], 0
    for m, (parent, label, weight) in enumerate(levels):
        a, b = need[m]
        own = weight[a:b].copy()
        place = np.arange(a, b)
        own[(place < lower[m]) | (place >= upper[m])] = 0
        out.append((parent[a:b] - begin if m else parent[a:b], label[a:b], own))
        begin = a
    return out


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Transducer:
    """Minimal acyclic transducer: state s has the arcs first[s] .. first[s + 1], sorted by label; state 0 has none, the last is the root."""

    words: list[bytes]
    first: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray

    def to_bytes(self) -> bytes:
        lengths = np.array([len(w) for w in self.words], np.int64)
        arrays = [lengths, np.diff(self.first), self.label, self.weight, self.target]
        parts = []
        for x in arrays:
            most = int(x.max()) if len(x) else 0
            kind = next(k for k in (1, 2, 4, 8) if most < 1 << (8 * k))
            parts += [struct.pack("<BQ", kind, len(x)), x.astype(f"<u{kind}").tobytes()]
        data = b"".join([*parts, *self.words])
        return struct.pack("<Q", len(data)) + pa.compress(data, codec="zstd", asbytes=True)

    @staticmethod
    def from_bytes(data: bytes) -> Transducer:
        raw = pa.decompress(data[8:], decompressed_size=struct.unpack_from("<Q", data)[0], codec="zstd", asbytes=True)
        at, arrays = 0, []
        for _ in range(5):
            kind, n = struct.unpack_from("<BQ", raw, at)
            arrays.append(np.frombuffer(raw, f"<u{kind}", n, at + 9).astype(np.int64))
            at += 9 + kind * n
        lengths, arcs, label, weight, target = arrays
        ends = (at + np.cumsum(lengths)).tolist()
        words = [raw[a:b] for a, b in zip([at, *ends[:-1]], ends)]
        return Transducer(words, np.concatenate([[0], np.cumsum(arcs)]), label, weight, target)

    def levels(self) -> Levels:
        """The n-grams as a trie, sorted."""
        out: Levels = []
        states = np.array([len(self.first) - 2])
        while True:
            n = self.first[states + 1] - self.first[states]
            if not n.sum():
                return out
            parent = np.repeat(np.arange(len(states)), n)
            arc = np.arange(len(parent)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[states], n)
            out.append((parent, self.label[arc], self.weight[arc]))
            states = self.target[arc]


def build(levels: Levels, words: list[bytes], portion: int = PORTION) -> Transducer:
    """The minimal transducer of a sorted trie; labels that do not occur are left out."""
    used = np.zeros(len(words), bool)
    for _, label, _ in levels:
        used[label] = True
    number = np.cumsum(used) - 1
    kept = [words[k] for k in np.nonzero(used)[0].tolist()]
    register: dict[tuple, int] = {}
    arcs: list[list[np.ndarray]] = [[], [], []]
    counts: list[np.ndarray] = [np.zeros(1, np.int64)]
    states = 1
    target = np.zeros(len(levels[-1][0]), np.int64)
    for m in range(len(levels) - 1, -1, -1):
        parent, label, weight = levels[m]
        label = number[label]
        above = np.zeros(len(levels[m - 1][0]) if m else 1, np.int64)
        # Sorted portions that end where a state ends: its arcs are all there, it is complete.
        begins = np.nonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))[0] if len(parent) else np.zeros(0, np.int64)
        ends = np.append(begins[1:], len(parent))
        k = 0
        while k < len(begins):
            last = max(k + 1, int(np.searchsorted(ends, begins[k] + portion, side="right")))
            a, b = int(begins[k]), int(ends[last - 1])
            mine = begins[k:last] - a
            arc = _mix(label[a:b].astype(np.uint64) + _mix(target[a:b].astype(np.uint64) + _mix(weight[a:b].astype(np.uint64) + np.uint64(1))))
            one, two = np.add.reduceat(arc, mine), np.add.reduceat(_mix(arc ^ np.uint64(0x5851F42D4C957F2D)), mine)
            _, shown, which = np.unique(one ^ _mix(two), return_index=True, return_inverse=True)
            sizes = ends[k:last] - begins[k:last]
            number_of = np.empty(len(shown), np.int64)
            fresh = []
            for i, (x, y, z) in enumerate(zip(one[shown].tolist(), two[shown].tolist(), sizes[shown].tolist())):
                known = register.setdefault((x, y, z), states)
                number_of[i] = known
                if known == states:
                    fresh.append(shown[i])
                    states += 1
            if fresh:
                fresh = np.array(fresh)
                n = sizes[fresh]
                at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(mine[fresh] + a, n)
                for kept_arcs, x in zip(arcs, (label, weight, target)):
                    kept_arcs.append(x[at])
                counts.append(n)
            above[parent[begins[k:last]]] = number_of[which]
            k = last
        target = above
    return Transducer(kept, np.concatenate([[0], np.cumsum(np.concatenate(counts))]), *(np.concatenate(x or [np.zeros(0, np.int64)]) for x in arcs))


def union(parts: list[tuple[list[bytes], Levels]]) -> tuple[list[bytes], Levels]:
    """All n-grams of the parts, the counts of equal ones added."""
    if len(parts) == 1:
        return parts[0]
    words = sorted(set().union(*(w for w, _ in parts)))
    place = {w: k for k, w in enumerate(words)}
    numbers = [np.array([place[w] for w in own], np.int64) for own, _ in parts]
    nodes = [np.zeros(1, np.int64) for _ in parts]
    out: Levels = []
    for m in range(max(len(levels) for _, levels in parts)):
        codes, weights = [], []
        for k, (_, levels) in enumerate(parts):
            parent, label, weight = levels[m] if m < len(levels) else (np.zeros(0, np.int64),) * 3
            codes.append(nodes[k][parent] * len(words) + numbers[k][label] if len(parent) else np.zeros(0, np.int64))
            weights.append(weight)
        found, total, at = grouped(np.concatenate(codes), np.concatenate(weights))
        ends = np.cumsum([len(c) for c in codes])
        nodes = np.split(at, ends[:-1])
        out.append((found // len(words), found % len(words), total))
    return words, out


def prune(levels: Levels, least: int) -> Levels:
    """The n-grams with a count of at least ``least`` and the prefixes that lead to them."""
    keep: list[np.ndarray] = []
    below = None
    for m in range(len(levels) - 1, -1, -1):
        mine = levels[m][2] >= least
        if below is not None:
            mine[levels[m + 1][0][below]] = True
        keep.insert(0, mine)
        below = mine
    out, number = [], np.zeros(1, np.int64)
    for mine, (parent, label, weight) in zip(keep, levels):
        out.append((number[parent[mine]], label[mine], weight[mine]))
        number = np.cumsum(mine) - 1
    return out


def compose(transducer: Transducer, parts: list[tuple[bytes, ...]]) -> np.ndarray:
    """Counts of the parts: the acceptor of the parts composed with the transducer, level by level; 0 for a part that it does not hold."""
    place = {w: k for k, w in enumerate(transducer.words)}
    size = len(place) + 1
    state_of_arc = np.repeat(np.arange(len(transducer.first) - 1), np.diff(transducer.first))
    keys = state_of_arc * size + transducer.label
    counts = np.zeros(len(parts), np.int64)
    # Paths of the acceptor: a part's node on each level, and the transducer's state there (-1: it has none).
    node, states, m = np.zeros(len(parts), np.int64), np.array([len(transducer.first) - 2]), 0
    alive = np.arange(len(parts))
    while len(alive):
        labels = np.array([place.get(parts[k][m], size - 1) for k in alive.tolist()], np.int64)
        arcs, _, at = grouped(node[alive] * size + labels)
        wanted = states[arcs // size] * size + arcs % size
        found = np.searchsorted(keys, wanted)
        there = (wanted >= 0) & (found < len(keys))
        there[there] = keys[found[there]] == wanted[there]
        weight = np.where(there, transducer.weight[np.where(there, found, 0)], 0) if len(keys) else np.zeros(len(arcs), np.int64)
        states = np.where(there, transducer.target[np.where(there, found, 0)], -1) if len(keys) else np.full(len(arcs), -1)
        node[alive] = at
        m += 1
        over = np.array([len(parts[k]) == m for k in alive.tolist()], bool)
        counts[alive[over]] = weight[at[over]]
        alive = alive[~over]
    return counts


def boundaries(docs: DataFrame, longest: int, ranges: int) -> dict[str, list[tuple[bytes, ...]]]:
    """Sorted boundaries of each language, ``ranges`` minus one in all, from at most ``SAMPLED * ranges`` n-grams of a hashed part of the texts."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = data.as_buffer().to_pybytes()
                for part in tokens(data):
                    for k in range(crc32(data[:64]) % 61, len(part) - longest + 1, 61):
                        if b"." not in part[k:k + longest]:
                            rows.append((lang, b" ".join(part[k:k + longest])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.binary()))], names=["lang", "gram"])

    some = docs.filter(F.pmod(F.xxhash64("text", F.lit(17)), F.lit(16)) == 0).mapInArrow(sample, "lang string, gram binary").distinct()
    found = sorted((r["lang"].encode(), tuple(bytes(r["gram"]).split(b" "))) for r in some.orderBy(F.xxhash64("gram", F.lit(19)), "lang").limit(SAMPLED * ranges).collect())
    chosen: dict[str, list] = {}
    for k in sorted({len(found) * i // ranges for i in range(1, ranges)}) if found else ():
        lang, gram = found[k]
        own = chosen.setdefault(lang.decode(), [])
        if not own or own[-1] != gram:
            own.append(gram)
    return chosen


def shards(docs: DataFrame, bounds: dict[str, list[tuple[bytes, ...]]], longest: int) -> DataFrame:
    """Rows (lang, part, data): the transducer of what a shard has of a language in one of its prefix ranges."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, dict[bytes, int]] = {}
        codes: dict[str, list[np.ndarray]] = {}
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, own in codes.items():
                number = numbers[lang]
                words = sorted(number)
                rank = np.empty(len(words) + 1, np.int64)
                rank[[number[w] for w in words]] = np.arange(len(words))
                rank[-1] = -1
                levels = count_ngrams(rank[np.concatenate(own)], len(words), longest)
                cuts = [cut_at(levels, words, b) for b in bounds.get(lang, ())]
                cuts = [[0] * longest, *cuts, [len(x[0]) for x in levels]]
                for k in range(len(cuts) - 1):
                    block = between(levels, cuts[k], cuts[k + 1])
                    if block is not None:
                        data = build(block, words).to_bytes()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang]), pa.array([k], pa.int32()), pa.array([data], pa.binary())], names=["lang", "part", "data"])

        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                number = numbers.setdefault(lang, {})
                own = codes.setdefault(lang, [])
                for part in tokens(data.as_buffer().to_pybytes()):
                    own.append(np.array([-1 if w == b"." else number.setdefault(w, len(number)) for w in part], np.int32))
                    held += len(part)
                own.append(np.array([-1], np.int32))
                held += 1
                if held >= SHARD_WORDS:
                    yield from out()
                    numbers, codes, held = {}, {}, 0
        yield from out()

    return docs.mapInArrow(count, "lang string, part int, data binary")


def merged(parts: DataFrame, least: int) -> DataFrame:
    """Rows (lang, part, n, data): the union of each range's transducers without n-grams below ``least``, and its word occurrences."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_groups(batches, ("lang", "part")):
            total, waiting, nodes = None, [], 0
            for data in rows.column("data"):
                one = Transducer.from_bytes(data.as_buffer().to_pybytes())
                waiting.append((one.words, one.levels()))
                nodes += sum(len(x[0]) for x in waiting[-1][1])
                if nodes > WAITING:
                    total = union([total, *waiting] if total else waiting)
                    waiting, nodes = [], 0
            if waiting:
                total = union([total, *waiting] if total else waiting)
            words, levels = total
            n = int(levels[0][2].sum())
            data = build(prune(levels, least), words).to_bytes()
            yield pa.RecordBatch.from_arrays(
                [rows.column("lang").combine_chunks().slice(0, 1), rows.column("part").combine_chunks().slice(0, 1), pa.array([n]), pa.array([data], pa.binary())],
                names=["lang", "part", "n", "data"])

    return parts.repartition("lang", "part").sortWithinPartitions("lang", "part").mapInArrow(add, "lang string, part int, n bigint, data binary")


def candidates(counted: DataFrame, bounds: dict[str, list[tuple[bytes, ...]]], least: int) -> DataFrame:
    """Rows (lang, phrase, words, a, k, first, first_part, rest, rest_part), one per cut of each candidate, with the ranges of its parts."""
    names = ["lang", "phrase", "words", "a", "k", "first", "first_part", "rest", "rest_part"]
    types = [pa.string(), pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.int32()]

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                one = Transducer.from_bytes(data.as_buffer().to_pybytes())
                own, grams, rows = bounds.get(lang, []), [()], []
                for parent, label, weight in one.levels():
                    grams = [grams[p] + (one.words[w],) for p, w in zip(parent.tolist(), label.tolist())]
                    for gram, a in zip(grams, weight.tolist()):
                        if len(gram) < 2 or a < least:
                            continue
                        for k in range(1, len(gram)):
                            rows.append((
                                lang, b" ".join(gram), len(gram), a, k, b" ".join(gram[:k]), bisect_right(own, gram[:k]), b" ".join(gram[k:]), bisect_right(own, gram[k:])))
                    if len(rows) > 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    found = counted.select("lang", "data").mapInArrow(
        expand, "lang string, phrase binary, words int, a bigint, k int, first binary, first_part int, rest binary, rest_part int")
    return found.select("lang", *(F.col(c).cast("string").alias(c) for c in ("phrase", "first", "rest")), "words", "a", "k", "first_part", "rest_part")


def part_counts(found: DataFrame, counted: DataFrame) -> DataFrame:
    """Rows (lang, phrase, n): the count of every part that a candidate has, each looked up once in the range that holds it."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_groups(batches, ("lang", "part")):
            data = rows.column("data").drop_null()
            asked = [p.encode() for p in rows.column("phrase").to_pylist() if p is not None]
            if not asked or not len(data):
                continue
            counts = compose(Transducer.from_bytes(data[0].as_buffer().to_pybytes()), [tuple(p.split(b" ")) for p in asked])
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows.column("lang")[0].as_py()] * len(asked), pa.string()), pa.array(asked, pa.binary()), pa.array(counts)], names=["lang", "bytes", "n"])

    asked = found.select("lang", F.explode(F.array(F.struct(F.col("first_part").alias("part"), F.col("first").alias("phrase")), F.struct(F.col("rest_part").alias("part"), F.col("rest").alias("phrase")))).alias("x"))
    asked = asked.select("lang", "x.part", "x.phrase").distinct().withColumn("data", F.lit(None).cast("binary"))
    both = counted.select("lang", "part", F.lit(None).cast("string").alias("phrase"), "data").unionByName(asked)
    answers = both.repartition("lang", "part").sortWithinPartitions("lang", "part").mapInArrow(look_up, "lang string, bytes binary, n bigint")
    return answers.select("lang", F.col("bytes").cast("string").alias("part_phrase"), "n")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, covered: int = COVERED, top: int = TOP,
    ranges: int | None = None,
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's ``top`` candidates that no longer one covers in ``covered`` % of their places."""
    spark = docs.sparkSession
    short_batches(spark)
    docs = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))
    if ranges is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = min(MAX_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // RANGE_BYTES))
    bounds = boundaries(docs, longest, ranges)
    counted = stored(merged(shards(docs, bounds, longest), least), "collocation-ranges")
    cuts = stored(candidates(counted, bounds, least), "collocation-candidates")

    known = stored(part_counts(cuts, counted), "collocation-parts")
    one = known.select("lang", F.col("part_phrase").alias("first"), F.col("n").alias("l"))
    two = known.select("lang", F.col("part_phrase").alias("rest"), F.col("n").alias("r"))
    wide = [F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")]
    score = F.call_function("div", F.lit(10**6).cast("decimal(7,0)") * (wide[0] * wide[0]), wide[1] * wide[2])
    scored = cuts.join(one, ["lang", "first"]).join(two, ["lang", "rest"]).groupBy("lang", "phrase", "words", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    # Contiguous parts of two words or more of every candidate, with the greatest count of those that hold them.
    whole = cuts.filter("k = 1 AND words > 2").select("lang", "a", "words", F.split("phrase", " ").alias("w"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda k: F.array_join(F.slice("w", k, n), " "))))
    inside = whole.select("lang", "a", F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.lit(100).cast("decimal(3,0)") * F.col("longer").cast("decimal(19,0)") < F.lit(covered).cast("decimal(3,0)") * F.col("a").cast("decimal(19,0)")))

    total = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    order = (F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
