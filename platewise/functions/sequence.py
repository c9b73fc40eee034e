"""Read and quality strings. Thresholds and cutting rules are this library's own contract."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PHRED_OFFSET = 33
BASES_AT_ONCE = 2_000_000
#: Qualities of which windows are summed at once, about 40 bytes each.
SCORES_AT_ONCE = 1 << 18
SCORES = 94
BASE_CLASSES = "ACGTN"


def low_symbols(threshold: int) -> str:
    """The quality symbols of all scores below ``threshold``."""
    return "".join(chr(PHRED_OFFSET + q) for q in range(threshold))


def leading_low(quality: Column, threshold: int) -> Column:
    """Number of symbols at the start with a score below ``threshold``."""
    return F.length(quality) - F.length(F.ltrim(quality, F.lit(low_symbols(threshold))))


def trailing_low(quality: Column, threshold: int) -> Column:
    return F.length(quality) - F.length(F.rtrim(quality, F.lit(low_symbols(threshold))))


def _joined(strings: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all strings in one array, and where each string starts (one entry more)."""
    present = strings.fillna("")
    codes = np.frombuffer("".join(present).encode("utf-32-le"), dtype=np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in present], dtype=np.int64)))
    return codes, starts


def slices(lengths: pd.Series, at_once: int | None = None) -> Iterator[slice]:
    """Row ranges that hold about ``at_once`` bases each (``BASES_AT_ONCE`` if not given), at least one row."""
    part = lengths.cumsum().to_numpy() // (at_once or BASES_AT_ONCE)
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)]
    return (slice(start, end) for start, end in zip(edges, edges[1:]))


def _first_failing(qualities: pd.Series, window: int, required: int) -> np.ndarray:
    """Start of each read's first failing window, or its length."""
    codes, starts = _joined(qualities)
    lengths = np.diff(starts)
    if len(codes) < window:
        return lengths
    total = np.concatenate(([0], np.cumsum(codes, dtype=np.int64)))
    failing = np.flatnonzero(total[window:] - total[:-window] < window * (required + PHRED_OFFSET))
    # the first failing window at or after each read's start, if it lies inside the read
    first = np.append(failing, np.iinfo(np.int64).max)[np.searchsorted(failing, starts[:-1])]
    return np.where(first <= starts[1:] - window, first - starts[:-1], lengths)


def _first_failing_of_one(quality: str, window: int, required: int) -> int:
    """The same for one read of any length, in overlapping pieces up to the first failing window."""
    for start in range(0, max(len(quality) - window + 1, 1), SCORES_AT_ONCE):
        piece = quality[start:start + SCORES_AT_ONCE + window - 1]
        first = int(_first_failing(pd.Series([piece]), window, required)[0])
        if first < len(piece):
            return start + first
    return len(quality)


def window_cut(quality: Column, window: int, required: int) -> Column:
    """Bases to keep: those before the start of the first window with a mean below ``required``.

    A read shorter than one window is kept whole by this step. Window sums need every single base, which
    array expressions interpret one by one; here a batch of qualities is summed as one numpy array, and
    only a number per read comes back.
    """
    @F.pandas_udf("int")
    def cut(qualities: pd.Series) -> pd.Series:
        present = qualities.fillna("")
        found = np.empty(len(present), np.int64)
        for part in slices(present.str.len(), SCORES_AT_ONCE):
            rows = present.iloc[part]
            short = rows.str.len() <= SCORES_AT_ONCE
            if short.all():
                found[part] = _first_failing(rows, window, required)
            else:
                found[part] = [_first_failing_of_one(quality, window, required) for quality in rows]
        return pd.Series(found)

    return cut(quality)


def gc_count(seq: Column) -> Column:
    return F.length(seq) - F.length(F.translate(seq, "GCgc", ""))


def _literal(text: str) -> str:
    """Text as a regular expression that matches just it."""
    return "".join(c if c.isalnum() and c.isascii() else "\\" + c for c in text)


def seed_pieces(seed: str, mismatches: int) -> list[tuple[int, str]]:
    """Cut a seed in ``mismatches + 1`` pieces: (offset, piece). One of them must match exactly."""
    cuts = [len(seed) * n // (mismatches + 1) for n in range(mismatches + 2)]
    return [(start, seed[start:end]) for start, end in zip(cuts, cuts[1:])]


def seed_pattern(seed: str, mismatches: int) -> str:
    """Regular expression for the seed with at most ``mismatches`` positions free.

    At each position it first looks for an exact piece, so the list of variants is rarely tried.
    """
    pieces = "|".join(f".{{{at}}}{_literal(piece)}" for at, piece in seed_pieces(seed, mismatches))
    variants = "|".join(
        "".join("." if i in free else _literal(c) for i, c in enumerate(seed))
        for free in combinations(range(len(seed)), mismatches)
    )
    return f"(?s)(?={pieces})(?:{variants})"


def adapter_start(seq: Column, seeds: list[str], mismatches: int) -> Column:
    """First position (0-based) where any seed matches with at most ``mismatches``; null if none.

    Reads without any exact piece of a seed cost one substring search per piece.
    """
    def first_match(seed: str) -> Column:
        present = reduce(or_, [F.contains(seq, F.lit(piece)) for _, piece in seed_pieces(seed, mismatches)])
        parts = F.split(seq, seed_pattern(seed, mismatches), 2)
        return F.when(present & (F.size(parts) > 1), F.length(F.get(parts, F.lit(0))))

    return F.array_min(F.array(*[first_match(seed) for seed in seeds]))


def count_cells(seqs: pd.Series, quals: pd.Series, groups: np.ndarray, bin_width: int) -> Iterator[tuple]:
    """(group, cells, counts) of a batch of reads; a cell is position bin, base class and score in one number."""
    symbols, starts = _joined(seqs)
    scores, ends = _joined(quals)
    lengths = np.diff(starts)
    if not np.array_equal(starts, ends):
        raise ValueError("a read's sequence and quality differ in length")
    if len(scores) and not PHRED_OFFSET <= scores.min() <= scores.max() < PHRED_OFFSET + SCORES:
        raise ValueError(f"a quality symbol is outside the {SCORES} scores from {PHRED_OFFSET}")
    classes = np.full(128, len(BASE_CLASSES) - 1, dtype=np.int64)
    for code, letter in enumerate(BASE_CLASSES[:-1]):
        classes[[ord(letter), ord(letter.lower())]] = code
    bins = (np.arange(len(symbols)) - np.repeat(starts[:-1], lengths)) // bin_width
    base = classes[np.minimum(symbols, 127)]
    cell = (bins * len(BASE_CLASSES) + base) * SCORES + (scores.astype(np.int64) - PHRED_OFFSET)
    size = int(cell.max(initial=0)) + 1
    numbers = np.repeat(groups, lengths) * size + cell
    if (int(groups.max(initial=0)) + 1) * size <= 4 * len(numbers):
        # few enough cells to count in one pass without sorting
        counts = np.bincount(numbers)
        found = np.flatnonzero(counts)
        n = counts[found]
    else:
        found, n = np.unique(numbers, return_counts=True)
    group, cells = np.divmod(found, size)
    for start, end in zip(edges := np.flatnonzero(np.diff(group, prepend=-1)), [*edges[1:], len(group)]):
        yield int(group[start]), cells[start:end], n[start:end]


def cell_position(cell: Column, bin_width: int) -> Column:
    """First position of a cell's bin."""
    return (F.floor(cell / (len(BASE_CLASSES) * SCORES)) * bin_width).cast("int")


def cell_base(cell: Column) -> Column:
    code = F.floor(cell / SCORES) % len(BASE_CLASSES)
    return F.substr(F.lit(BASE_CLASSES), code.cast("int") + 1, F.lit(1))


def cell_quality(cell: Column) -> Column:
    return (cell % SCORES).cast("int")
