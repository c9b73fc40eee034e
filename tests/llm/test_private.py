"""Personal data: base spans against the plain patterns, the tagger against plain formulas and held-out labels."""

import dataclasses
import hashlib
import itertools
import os
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from platewise.llm import private as p
from platewise.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    """The patterns as they stand, with the checks."""
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = kind == "email"
            if kind == "ip":
                good = all(int(x) <= 255 for x in m[0].split("."))
            if kind == "card":
                twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(d))]
                good = 13 <= len(d) <= 19 and sum(x // 10 + x % 10 for x in twice) % 10 == 0
            if kind == "phone":
                good = 9 <= len(d) <= 15
            if good:
                out.append((kind, *m.span()))
    return out


def odd_texts(seed, n):
    draw = random.Random(seed)
    bits = ["@", ".", "-", "+", " ", "1", "25", "4111111111111111", "a", "Z", "é", "🙂", "(", ")", "a@b.c", "1.2.3.4", "+1 (988) 555-2485", "%", "_", "\n", "00", "256"]
    return ["".join(draw.choices(bits, k=draw.randrange(25))) for _ in range(n)]


def test_base_spans():
    for text in ["", "a@b@c.de", "1.2.3.4.5.6.7.8", "0001.2.3.4", "+1" + " " * 9 + "2345678 9", "4111 1111-1111 1111", *odd_texts(1, 4000)]:
        assert p.base_spans(text) == plain_spans(text), text
    assert p.base_spans(None) == []


@pytest.mark.parametrize("unit", ["1", "a", "@", ".", "+", "+1", "1.", "a@", "a.", "1 ", "-", "@a", "1-1.", "a@b.", "+1(", "é"])
def test_base_spans_of_long_texts(unit):
    start = time.time()
    p.base_spans(unit * (400_000 // len(unit)))
    assert time.time() - start < 5


def in_double(model):
    wide = [w.astype(np.float64) for w in model.weights()]
    return p.Tagger(wide[:2], wide[2:4], *wide[4:])


def test_gradients():
    draw = np.random.default_rng(0)
    model = in_double(p.Tagger.fresh(3, 1))
    codes, gold = draw.integers(0, p.CLASSES, (7, 4)), np.zeros((7, 4), int)
    gold[2, 1], gold[3, 1], gold[5, 2] = 1, 2, 7
    _, grads = model.gradients(codes, gold)
    for weight, grad in zip(model.weights(), grads):
        for _ in range(6):
            at = tuple(draw.integers(0, s) for s in weight.shape)
            kept, step = weight[at], 1e-5
            weight[at] = kept + step
            up, _ = model.gradients(codes, gold)
            weight[at] = kept - step
            down, _ = model.gradients(codes, gold)
            weight[at] = kept
            assert abs((up - down) / (2 * step) - grad[at]) < 1e-6


def test_likelihood_is_that_of_all_paths():
    """The loss is minus the log of the gold path's share among all paths, written out."""
    model = in_double(p.Tagger.fresh(2, 3))
    model.moves += np.random.default_rng(4).normal(0, 1, model.moves.shape)
    codes, gold = np.array([[3], [9], [1]]), np.array([[0], [1], [2]])
    scores = model.emissions(codes)[:, :, 0].astype(float)

    def worth(path):
        return sum(scores[t, k] for t, k in enumerate(path)) + model.first[path[0]] + sum(model.moves[a, b] for a, b in itertools.pairwise(path))

    every = [worth(x) for x in itertools.product(range(p.N_TAGS), repeat=3)]
    loss, _ = model.gradients(codes, gold)
    assert abs(loss - (np.log(np.exp(every).sum()) - worth((0, 1, 2)))) < 1e-4


def test_decoding_is_the_best_path():
    draw = np.random.default_rng(5)
    seen = 0
    for seed in range(30):
        model = p.Tagger.fresh(3, seed)
        model.out *= 6
        model.bias[0] = draw.normal(1, 2)
        codes = draw.integers(0, p.CLASSES, (4, 6)).astype(np.uint8)
        scores = model.emissions(codes)
        moves = np.where(p.FORBIDDEN, -1e4, model.moves)
        found = model.decode(codes)
        for w in range(6):
            best = max(itertools.product(range(p.N_TAGS), repeat=4), key=lambda x: sum(scores[t, k, w] for t, k in enumerate(x)) + model.first[x[0]] + sum(moves[a, b] for a, b in itertools.pairwise(x)))
            assert tuple(found[w].tolist() if w in found else (0, 0, 0, 0)) == best
            seen += any(best)
    assert 20 < seen < 170


@pytest.fixture(scope="module")
def model(spark):
    return p.train(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def test_held_out_spans(model, spark):
    """Written forms and usual ones in documents and filler that were not trained on."""
    draw = random.Random(77)
    texts = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("length(text) > 200").select("text").collect()]
    cases = []
    for k in range(900):
        whole = draw.choice(texts)
        at = draw.randrange(len(whole) - 150)
        window = p.filler(draw) if k % 2 else whole[at:at + p.TRAINED]
        if not p.base_spans(window):
            cases.append(p.placed(window, [], draw))
    found = p.all_spans(model, [t for t, _ in cases])
    right = wanted = wrong = clean = 0
    for (text, spans), own in zip(cases, found):
        spans = [s for s in spans if s[2] < len(text)]
        wanted += len(spans)
        right += sum(any(k == kind and a <= x < b for k, a, b, _ in own for x in [(start + end) // 2]) for kind, start, end in spans)
        if not spans and not p.base_spans(text):
            clean += 1
            wrong += bool(own)
    assert wanted > 200 and clean > 200
    assert right / wanted >= 0.8, (right, wanted)
    assert wrong / clean <= 0.03, (wrong, clean)


def test_tagger_alone_finds_usual_forms(model, spark):
    """Without the patterns the tagger sees most base spans of documents it was not trained on."""
    rows = spark.read.parquet(f"{SF_DIR.replace('sf0.001', 'sf0.01')}/documents.parquet").filter("length(text) > 0").select("text").limit(400).collect()
    texts = [r["text"] for r in rows]
    hit = total = 0
    missed = []
    for text, tagged in zip(texts, p.tagged_spans(model, texts)):
        for kind, a, b in p.base_spans(text):
            total += 1
            if not any(k == kind and x < b and a < y for k, x, y in tagged):
                missed.append(text[a - 5:b + 5])
            hit += any(k == kind and x < b and a < y for k, x, y in tagged)
    assert total > 10 and hit / total >= 0.85, (hit, total, missed)


def test_windows_are_reconciled(model, monkeypatch):
    """Sections, batches and neighbours in a batch do not matter; a span across windows is one span."""
    draw = random.Random(8)
    long = "".join(p.placed(p.filler(draw), [], draw)[0] + "\n" for _ in range(60))
    texts = [long, "", "x", long[5:900], "mail me: jo.doe [at] host [dot] org now"]
    whole = p.all_spans(model, texts)
    assert any(a // 224 != b // 224 for _, a, b, _ in whole[0])
    monkeypatch.setattr(p, "SECTION", 300)
    monkeypatch.setattr(p, "TOGETHER", 3)
    assert p.all_spans(model, texts) == whole
    assert [p.all_spans(model, [t])[0] for t in texts] == whole
    assert [s for s in p.all_spans(model, [long * 40])[0] if s[2] < 3000] == [s for s in whole[0] if s[2] < 3000]


def test_spans_are_base_or_accepted(model):
    for text, spans in zip(odd_texts(9, 300), p.all_spans(model, odd_texts(9, 300))):
        assert [s[:3] for s in spans if s[3]] == plain_spans(text)
        taken = [s[1:3] for s in spans if s[3]]
        for kind, a, b, base in spans:
            assert 0 <= a < b <= len(text) and (base or p.accepted(kind, text[a:b]))
            assert base or not any(x < b and a < y for x, y in taken)


def test_query(spark):
    rows = QUERIES["op11_personal_data"](spark, SF_DIR).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        base = plain_spans(docs[r["doc_id"]])
        joined = [f"{k}:{a}:{b}" for k, a, b in base]
        assert [r[f"n_{k}"] for k in p.KINDS] == [sum(x[0] == k for x in base) for k in p.KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(joined) <= set(spans)
        key = [(p.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert key == sorted(key)


def test_odd_tables(spark, model):
    rows = [(1, None, "a", 1), (2, "", "b", 2), (3, "reach me at a@b.co!", "c", 3), (3, "reach me at a@b.co!", "c", 3), (None, "é" * 300 + " 10.0.0.1", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, private string, kind long")
    found, name = p.find_private(docs, model)
    assert name == "private_" and found.columns == [*docs.columns, name]
    got = found.select("doc_id", p.joined(F.col(name)).alias("s"), p.masked(F.col("text"), F.col(name)).alias("m"), "private").collect()
    assert sorted((str(r["doc_id"]), r["s"], r["m"], str(r["private"])) for r in got) == sorted([
        ("1", "", "None", "a"), ("2", "", "", "b"), *[("3", "email:12:18", "reach me at <EMAIL>!", "c")] * 2, ("None", "ip:301:309", "é" * 300 + " <IP>", "None")]
    ) or got[0]["m"] is None
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert p.find_private(empty, model)[0].collect() == []


def test_training_without_documents(spark):
    """An empty table trains on written forms alone; training is repeatable."""
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert p.sampled_windows(empty) == []
    one, two = (p.fit(p.examples([])[:200], epochs=1) for _ in range(2))
    assert all(np.array_equal(a, b) for a, b in zip(one.weights(), two.weights()))
    assert dataclasses.is_dataclass(one)
