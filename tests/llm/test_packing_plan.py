"""The packing plan comes from the rounded configuration program; odd tables of pieces."""

import numpy as np
import pytest

from platewise.llm import packing


def tokens(plan):
    return sum(n * sum(l * m for l, m in c) for c, n in plan.items())


@pytest.mark.parametrize("n,capacity", [(9000, 2048), (300, 2048), (40_000, 512)])
def test_program_places_most(n, capacity):
    """Skewed lengths: at least four fifths of the tokens below full length from the program, hardly more sequences than the lower bound."""
    draw = np.random.default_rng(n)
    lengths = np.clip(draw.lognormal(np.log(capacity / 5), 1, n).astype(int), 1, capacity)
    histogram = np.bincount(lengths, minlength=capacity + 1)
    plan, left, bound = packing.rounded_program(histogram)
    short = {c: m for c, m in plan.items() if c != ((capacity, 1),)}
    assert tokens(short) >= 0.8 * (histogram * np.arange(capacity + 1))[:capacity].sum()
    whole, again = packing.plan_packing(histogram)
    assert again == bound and sum(whole.values()) <= 1.005 * bound + 1
    held = np.zeros(capacity + 1, np.int64)
    for c, m in whole.items():
        assert sum(l * k for l, k in c) <= capacity
        for l, k in c:
            held[l] += m * k
    assert (held == histogram).all()
    rest = packing.best_fit(histogram)
    assert sum(whole.values()) <= sum(rest.values())


def test_large_counts():
    """Numbers as of a huge corpus: shares far above one."""
    histogram = np.zeros(101, np.int64)
    histogram[[7, 33, 34, 50, 66, 100]] = [10**9, 3 * 10**8, 10**8 + 1, 5, 2 * 10**8, 10**7]
    plan, bound = packing.plan_packing(histogram)
    assert bound <= sum(plan.values()) <= 1.01 * bound + 2


def test_clashing_names_and_repeated_rows(spark):
    rows = [(1, 0, 30, "a", 5), (1, 0, 30, "a", 5), (None, None, 30, None, None), (2, 1, 70, "b", 6)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, length long, sequence_id string, offset long").repartition(2)
    found = packing.pack(pieces, capacity=100)
    assert found.columns == [*pieces.columns, "sequence_id_", "offset_"]
    got = found.collect()
    assert sorted((r["length"], str(r["sequence_id"])) for r in got) == [(30, "None"), (30, "a"), (30, "a"), (70, "b")]
    places = sorted((r["sequence_id_"], r["offset_"], r["length"]) for r in got)
    assert len({p[:2] for p in places}) == 4 and {s: sum(p[2] for p in places if p[0] == s) for s, *_ in places} in ({0: 100, 1: 60}, {0: 60, 1: 100})
