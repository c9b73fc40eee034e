"""Long texts in portions and repeated ids."""

import random

import numpy as np
import pyarrow as pa
import pytest

from platewise.llm import neardup


def texts(seed, n):
    draw = random.Random(seed)
    parts = ["a", "bb", "é", " ", "  ", "\n", "x" * 30, "word ", "\t"]
    return [None if draw.random() < 0.1 else "".join(draw.choices(parts, k=draw.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("size,portion", [(1, 1), (7, 3), (50, 8)])
def test_portions_change_nothing(monkeypatch, size, portion):
    """Words, shingles, fingerprints and samples are the same whatever is worked on at once, also where one word is longer than a slice."""
    batches = [pa.array(texts(k, k % 7), pa.string()) for k in range(40)]
    sampler = neardup.Sampler()

    def results():
        out = []
        for batch in batches:
            found, counts, bounds, prints = neardup.shingled(batch)
            weights = counts * np.where(found % np.uint64(3) == 0, 0.3, 1.0)
            out.append((found, counts, bounds, prints, sampler.samples(found, weights, bounds)))
        return out

    whole = results()
    monkeypatch.setattr(neardup, "SLICE", size)
    monkeypatch.setattr(neardup, "PORTION", portion)
    for one, two in zip(whole, results()):
        assert all(np.array_equal(a, b) for a, b in zip(one, two))


def test_long_texts(spark):
    """Texts of megabytes, one of a single word, beside short ones; copies of them are found."""
    draw = random.Random(4)
    long = " ".join(f"w{draw.randrange(5000)}" for _ in range(400_000))
    rows = [(1, long), (2, long + " end"), (3, "z" * 5_000_000), (4, "z" * 5_000_000), (5, "short text of a few words only"), (6, None)]
    found = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6}


def test_repeated_ids_lose_no_text(spark):
    one, two = "a b c d e f g h i j k l", "nothing like the other text that has this id at all"
    rows = [(1, one), (1, one), (1, two), (2, "quite another text of its own with some words"), (None, one), (None, one)]
    kept = neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == sorted([("1", one), ("1", two), ("2", rows[3][1]), ("None", one), ("None", one)])


def test_idf_falls_with_every_document():
    weight = [neardup.idf_weight(10_000, df) for df in (1, 2, 50, 100, 1000, 3333, 10_000)]
    assert weight[0] == 1 and all(a > b for a, b in zip(weight, weight[1:]))


def test_idf_decides_a_pair(spark):
    """Two pairs alike but for how common their shared shingles are, each shingle in less than a third of all documents."""
    def words(name, n):
        return [f"{name}{k}" for k in range(n)]

    def pair(first, shared, name):
        # 45 of 45 + 2 * 5 shingles are shared: 0.82 if all weigh the same.
        return [(first, " ".join(shared + words(f"{name}a", 5))), (first + 1, " ".join(shared + words(f"{name}b", 5)))]

    common, rare = words("common", 49), words("rare", 49)
    texts = pair(0, rare, "r") + pair(2, common, "c")
    texts += [(10 + k, " ".join(common + words(f"long{k}x", 400))) for k in range(20)] + [(100 + k, " ".join(words(f"other{k}x", 30))) for k in range(80)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert found[0] == found[1] == 0
    assert found[2] == 2 and found[3] == 3
    weights, n = neardup.common_shingles(docs)
    assert n == 104 and len(weights) == 45 + 45 and set(weights.values()) == {neardup.idf_weight(104, 22), neardup.idf_weight(104, 2)}
