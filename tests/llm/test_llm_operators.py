"""The dealt operators against brute force and exact round trips, with nulls, empty tables, ties and clashing names."""

import hashlib
import json
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from platewise.llm import binary, chat, components, lattice, mixing, neardup, packing, quality, tokens, toxicity, urls
from platewise.llm.queries import QUERIES, URL_RULES, vocabulary

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD_TEXTS = [None, "", " ", "\n", "a", "x y", "  two  spaces ", "tab\there", "ünï 漢字 🙂", "<|endoftext|> is text", "it's we'll", "a\u00a0b\u3000c", "\r\n\r\n", "9" * 300, "end "]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(vocabulary())
    found.encode_special_tokens = True
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


def docs_of(spark, texts, source="s", lang="en"):
    return spark.createDataFrame([(k, t, lang, source, len(t or "")) for k, t in enumerate(texts)], DOCS)


def texts_of(n, seed=3, most=60):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(1, most))) for _ in range(n)]


# Tokens, packing, binary files


def test_ids_equal_those_of_the_library(reference):
    rng = random.Random(5)
    parts = [" ", "\n", "\t", "a", "B", "é", "1", "'s", "!", "<|endoftext|>", "\x1c", "\xa0", "\u200b", "漢", "🙂", "\r\n", " the", "\0"]
    texts = ODD_TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    ids, offsets = tokens.TextEncoder(vocabulary()).encode(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[offsets[k]:offsets[k + 1]].tolist() == reference(text), repr(text)


def test_context_table(spark, reference):
    texts = ODD_TEXTS + texts_of(40)
    docs = docs_of(spark, texts).withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.lit("a")))
    histogram = tokens.length_histogram(docs, vocabulary(), by=["source"])
    lengths = {True: [], False: []}
    for k, t in enumerate(texts):
        lengths[k % 3 > 0].append(len(reference(t)) + 1)
    rows = tokens.context_table(histogram, by=["source"], cell=7).collect()
    assert len(rows) == sum(len(set(x)) for x in lengths.values())
    for r in rows:
        own, limit = lengths[r["source"] is not None], r["context_limit"]
        assert (r["documents"], r["total_tokens"], r["n_documents"]) == (len(own), sum(own), own.count(limit))
        assert (r["n_longer"], r["truncated_tokens"]) == (sum(x > limit for x in own), sum(min(x, limit) for x in own))
    assert tokens.context_table(tokens.length_histogram(docs_of(spark, []), vocabulary())).count() == 0


def test_any_limits_and_quantiles(spark):
    lengths = {"a": [1, 1, 5, 9, 9, 300], None: [700], "b": [2] * 10 + [600]}
    rows = [(s, n, x.count(n)) for s, x in lengths.items() for n in set(x)]
    histogram = spark.createDataFrame(rows, "source string, length bigint, n bigint")
    found = {(r["source"], r["context_limit"]): r for r in tokens.limit_table(histogram, [0, 1, 7, 512, 512, 4096], by=["source"]).collect()}
    assert set(found) == {(s, limit) for s in lengths for limit in (0, 1, 7, 512, 4096)}
    for (source, limit), r in found.items():
        own = lengths[source]
        assert (r["documents"], r["total_tokens"], r["n_documents"]) == (len(own), sum(own), own.count(limit))
        assert (r["n_longer"], r["truncated_tokens"]) == (sum(x > limit for x in own), sum(min(x, limit) for x in own))
        assert r["fitting_share"] == sum(x <= limit for x in own) / len(own)
    shares = [0.1, 0.5, 0.9, 1.0]
    table = tokens.context_table(histogram, by=["source"])
    marked = {(r["source"], s): r["context_limit"] for r in tokens.with_quantiles(table, shares).collect() for s in r["quantile_of"]}
    assert marked == {(r["source"], r["share"]): r["length"] for r in tokens.quantile_lengths(table, shares, by=["source"]).collect()}
    assert marked == {(s, q): sorted(x)[max(0, -(-int(q * 10) * len(x) // 10) - 1)] for s, x in lengths.items() for q in shares}
    assert tokens.limit_table(histogram.limit(0), [512], by=["source"]).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver tables not present")
def test_token_counts_answer_the_standard_limits(spark):
    rows = QUERIES["op4_token_counts"](spark, "/root/testdata/sf0.001").collect()
    scopes = {(r["scope"], r["source"]) for r in rows}
    keys = [(r["scope"], r["source"], r["context_limit"]) for r in rows]
    assert len(keys) == len(set(keys)) and {(*s, limit) for s in scopes for limit in tokens.LIMITS} <= set(keys)
    assert sorted((r["scope"], str(r["source"]), q) for r in rows for q in r["quantile_of"]) == sorted((a, str(b), q) for a, b in scopes for q in tokens.SHARES)


def test_knapsack_and_plan():
    rng = np.random.default_rng(1)
    prices = np.concatenate([[0], rng.random(12)])
    best, take = packing.knapsack(prices, 12)
    brute = [0.0] * 13
    for room in range(1, 13):
        brute[room] = max([brute[room - 1]] + [prices[l] + brute[room - l] for l in range(1, room + 1)])
    assert np.allclose(best, brute)
    histogram = np.zeros(65, np.int64)
    for l in rng.integers(1, 65, 3000):
        histogram[l] += 1
    plan, bound = packing.plan_packing(histogram)
    held = np.zeros(65, np.int64)
    for configuration, n in plan.items():
        assert sum(l * m for l, m in configuration) <= 64
        for l, m in configuration:
            held[l] += n * m
    assert (held == histogram).all()
    assert bound <= sum(plan.values()) <= 1.01 * bound + 2
    assert packing.plan_packing(np.zeros(9, np.int64)) == ({}, 0.0)


def check_placed(rows, reference, texts, capacity):
    by_doc, by_row = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_row.setdefault(r["sequence_id"], []).append(r)
    for k, text in enumerate(texts):
        ids, at = [*reference(text), 0], 0
        for number, r in enumerate(sorted(by_doc[k], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (number, at)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at:at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for placed in by_row.values():
        at = 0
        for r in sorted(placed, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity


def test_pack_documents(spark, reference):
    texts = ODD_TEXTS + texts_of(300, most=400)
    found = packing.pack_documents(docs_of(spark, texts), vocabulary())
    rows = [r.asDict() for r in found.collect()]
    check_placed(rows, reference, texts, 2048)
    assert len({r["sequence_id"] for r in rows}) <= 1 + -(-sum(r["length"] for r in rows) // 2048)
    assert packing.pack_documents(docs_of(spark, []), vocabulary()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0, 5000)], "doc_id bigint, piece int, length bigint"))


def test_shards(spark, reference):
    texts = ODD_TEXTS + texts_of(120, most=300) + ["long " * 3000]
    shards = binary.pack_shards(docs_of(spark, texts), vocabulary(), capacity=512, rows_per_shard=16)
    rows = [r.asDict() | {"sequence_id": (r["shard"], r["row"])} for r in binary.read_segments(shards).collect()]
    check_placed(rows, reference, texts, 512)
    assert all(r["resets"] == 1 for r in rows)
    assert binary.pack_shards(docs_of(spark, []), vocabulary()).count() == 0


def test_best_fit_decreasing():
    rng = random.Random(2)
    lengths = [rng.randint(1, 50) for _ in range(400)]
    rows = binary.best_fit_decreasing(lengths, 50)
    assert sorted(k for r in rows for k in r) == list(range(400))
    brute = []
    for n in sorted(lengths, reverse=True):
        fitting = [k for k, room in enumerate(brute) if room >= n]
        if fitting:
            brute[min(fitting, key=lambda k: brute[k])] -= n
        else:
            brute.append(50 - n)
    assert len(rows) == len(brute)


# Chat


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\n", "\\", "<\\", "[\\n", "", "a\\\\<[<", "\n"]
    turns = [(1, k, ("user", "assistant", "a\n<b\\")[k % 3], t) for k, t in enumerate(odd)] + [(2, None, None, None), (2, 0, "user", "x"), (2, 0, "user", "x"), (None, 0, "assistant", "y")]
    rows = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    records = rows.select("conv_id", F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    formatted = chat.format_turns(chat.canonical_turns(records))
    back = {r["conv_id"]: r for r in formatted.select("*", chat.read_back(F.col("formatted"), F.col("mask")).alias("b")).collect()}
    assert [(t["role"], t["text"]) for t in back[1]["b"]["turns"]] == [(r, t) for _, _, r, t in turns[:8]]
    assert back[1]["b"]["learned"] == [t for _, _, r, t in turns[:8] if r == "assistant"]
    assert back[1]["formatted"].count("<|im_end|>") == 8 and "[INST]" not in back[1]["formatted"]
    assert [(t["role"], t["text"]) for t in back[2]["b"]["turns"]] == [("user", "x"), ("user", "x"), ("", "")]
    assert back[None]["b"]["learned"] == ["y"]


def test_layouts_by_fingerprint(spark):
    records = [
        {"messages": [{"role": "human", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 3}, {"instruction": "i", "input": "more", "output": "o"},
        {"prompt": "p", "response": "r", "system": "s"}, {"conversations": [{"from": "gpt", "value": "v"}]}, {"question": "q", "answer": None}, {"strange": {"a": [1]}},
    ]
    rows = [(k, json.dumps(r)) for k, r in enumerate(records)] + [(6, None), (7, "not json")]
    found = {}
    for r in chat.canonical_turns(spark.createDataFrame(rows, "conv_id bigint, record string")).orderBy("conv_id", "position").collect():
        found.setdefault(r["conv_id"], []).append((r["layout"], r["role"], r["text"]))
    assert found[0] == [("messages", "user", "q"), ("messages", "assistant", "a")]
    assert found[1] == [("instruction", "user", "i\n\nmore"), ("instruction", "assistant", "o")]
    assert [x[1:] for x in found[2]] == [("system", "s"), ("user", "p"), ("assistant", "r")]
    assert found[3] == [("conversations", "assistant", "v")] and [x[1:] for x in found[4]] == [("user", "q"), ("assistant", "")]
    assert all(found[k] == [(None, None, None)] for k in (5, 6, 7))
    assert hashlib.sha256("strange.a[]".encode()).hexdigest()[:16] == chat.fingerprint(records[5])


# Near duplicates


def test_components(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(50)] + [(100 + rng.randint(0, 60), 100 + rng.randint(0, 60)) for _ in range(50)] + [(7, 7), (None, 3)]
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    label = {x: x for e in edges for x in e if x is not None and e[0] != e[1] and None not in e}
    for _ in range(len(label)):
        for a, b in edges:
            if a in label and b in label:
                label[a] = label[b] = min(label[a], label[b])
    assert found == label
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def shingles_of(text):
    w = (text or "").split()
    found = {}
    for k in range(max(1, len(w) - 4)) if w else ():
        found[tuple(w[k:k + 5])] = found.get(tuple(w[k:k + 5]), 0) + 1
    return found


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(8)
    texts = [None, "", "one", "one", "a b c", "a b c"] + texts_of(60, most=120)
    for base in texts_of(6, seed=9, most=200):
        for _ in range(8):
            words = base.split()
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"new{rng.random()}"
            texts.append(" ".join(words))
    docs = docs_of(spark, texts).withColumn("rep", F.lit(1)).withColumn("class_id", F.lit("x"))
    sets, n = [shingles_of(t) for t in texts], len(texts)
    df = {}
    for s in sets:
        for k in s:
            df[k] = df.get(k, 0) + 1
    label = list(range(n))

    def similarity(a, b):
        weigh = lambda s, k: s.get(k, 0) * neardup.idf_weight(n, df[k])
        every = a.keys() | b.keys()
        return sum(min(weigh(a, k), weigh(b, k)) for k in every) / sum(max(weigh(a, k), weigh(b, k)) for k in every) if every else 1.0

    links = [(a, b) for a in range(n) for b in range(a) if similarity(sets[a], sets[b]) >= 0.8]
    for _ in range(n):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    found = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()}
    assert found == dict(enumerate(label))
    kept = neardup.drop_near_duplicates(docs.unionByName(docs))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(label)) and kept.columns == docs.columns
    assert neardup.near_duplicates(docs_of(spark, [])).count() == 0


def test_block_similarities_are_the_exact_ones():
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.choice(300, 80, replace=False)).astype(np.uint64) for _ in range(12)]
    counts = [rng.integers(1, 4, 80) for _ in sets]
    common = {int(k): 0.5 + k / 1000 for k in range(0, 300, 7)}
    weights = neardup.Weights(common)
    amount = [weights.of(s, c) for s, c in zip(sets, counts)]
    found, owner = np.concatenate(sets), np.repeat(np.arange(12), 80)
    expanded = neardup._expanded(found, owner, np.concatenate(amount), weights.of(found, np.ones(len(found))))
    matrix = neardup.similarities(*expanded, np.arange(12), np.arange(12), 12)
    for a in range(12):
        for b in set(range(12)) - {a}:
            x, y = dict(zip(sets[a].tolist(), amount[a])), dict(zip(sets[b].tolist(), amount[b]))
            every = x.keys() | y.keys()
            assert matrix[a, b] == pytest.approx(sum(min(x.get(k, 0), y.get(k, 0)) for k in every) / sum(max(x.get(k, 0), y.get(k, 0)) for k in every))
    assert len(neardup.spanning(np.array([1, 2, 1, 5]), np.array([2, 3, 3, 6]))) == 3


def test_samples_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(5)
    found = rng.integers(0, 1 << 62, 150).astype(np.uint64)
    weight = rng.integers(1, 4, 150).astype(float)
    other = weight.copy()
    other[:30] = 0
    sampler = neardup.Sampler(samples=3000, bands=1)
    a = sampler.samples(found, weight, np.array([0, 150]))
    b = sampler.samples(found[30:], other[30:], np.array([0, 120]))
    assert (a == b).mean() == pytest.approx(other.sum() / weight.sum(), abs=0.03)


def test_similar_pairs_share_a_band():
    rng = np.random.default_rng(11)
    sampler = neardup.Sampler()
    assert set(np.concatenate(sampler.bands).tolist()) == set(range(neardup.SAMPLES))
    for similarity, most in ((0.80, 0.004), (0.82, 0.002), (0.85, 0.0006)):
        agree = rng.random((200_000, neardup.SAMPLES)) < similarity
        missed = ~np.any([agree[:, band].all(1) for band in sampler.bands], axis=0)
        assert missed.mean() <= most, similarity
    # Planted pairs of sets through the sampler itself, between 0.80 and 0.85.
    missed, pairs = 0, 1500
    for _ in range(pairs):
        own = int(rng.integers(150, 201))
        found = rng.integers(0, 1 << 62, 1000).astype(np.uint64)
        both, a, b = found[:own * 4], found[own * 4:own * 4 + own // 2], found[own * 4 + own // 2:own * 5 - own // 16]
        sets = [np.concatenate([both, x]) for x in (a, b)]
        assert 0.8 <= len(both) / (len(both) + len(a) + len(b)) <= 0.85
        bounds = np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])])
        keys = sampler.band_keys(sampler.samples(np.concatenate(sets), np.ones(bounds[-1]), bounds))
        missed += not (keys[0] == keys[1]).any()
    assert missed <= 0.006 * pairs


def test_lattice_decoding_is_nearest():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 8)) * 2
    points, around = lattice.decode(x), lattice.neighbours()
    assert len(around) == 240 and ((around ** 2).sum(1) == 2).all()
    own = ((x - points) ** 2).sum(1)
    for v in around:
        assert (own <= ((x - points - v) ** 2).sum(1) + 1e-9).all()


def test_near_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(150, 24))
    near = np.concatenate([base, base[:60] + rng.normal(size=(60, 24)) * 0.25, base[:20] + rng.normal(size=(20, 24)) * 0.1, base[:10], base[:5] * 3]).astype(np.float32)
    rows = [(k, v.tolist(), 0) for k, v in enumerate(near)]
    bad = [None, [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23]
    rows += [(1000 + k, v, 1) for k, v in enumerate(bad)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    x = near.astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    label = list(range(len(x)))
    for _ in range(len(x)):
        for a, b in zip(*np.nonzero(linked)):
            label[a] = label[b] = min(label[a], label[b])
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in lattice.near_vectors(table).collect()}
    wanted = {k: (int(linked[k].sum()), label[k]) for k in range(len(x))} | {1000 + k: (0, 1000 + k) for k in range(5)}
    links = sum(n for n, _ in wanted.values())
    assert sum(n for n, _ in found.values()) >= 0.99 * links and all(found[k][0] <= wanted[k][0] for k in wanted)
    assert all(found[1000 + k] == wanted[1000 + k] for k in range(5)) and len(found) == len(wanted)
    assert lattice.near_vectors(table.limit(0)).count() == 0


# Mixing, quality, toxicity, urls


def test_targets_and_mix(spark):
    texts = texts_of(400, most=50) + [None, ""]
    docs = docs_of(spark, texts).withColumn("source", F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c"), F.lit(None)), (F.when(F.col("doc_id") < 20, 1).otherwise(F.col("doc_id") % 3 + 2)).cast("int")))
    docs = docs.withColumn("mix", F.lit(1)).withColumn("size", F.lit(2))
    mixed, name = mixing.mix(docs)
    rows = [(r["source"], *r[name]) for r in mixed.collect()]
    sizes, targets, taken = {}, {}, {}
    for source, size, whole, target, copies, words in rows:
        sizes[source] = sizes.get(source, 0) + size
        taken[source] = taken.get(source, 0) + words
        targets[source] = target
        assert words == copies * size and copies <= 3
    weights, total = {"a": 5, "b": 2, "c": 1, None: 5}, sum(sizes.values())
    stopped = set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        share = {s: left * w / sum(weights[x] for x in weights if x not in stopped) for s, w in weights.items() if s not in stopped}
        over = {s for s in share if share[s] > 3 * sizes[s]}
        if not over:
            break
        stopped |= over
    for s in sizes:
        assert targets[s] == pytest.approx(3 * sizes[s] if s in stopped else share[s])
        assert abs(taken[s] - targets[s]) <= 50
    drawn = mixing.draw(docs)
    assert drawn.columns == docs.columns and drawn.count() == sum(r[5] // r[1] for r in rows if r[1])
    assert mixing.mix(docs.limit(0))[0].count() == 0
    preferred, name = mixing.mix(docs.withColumn("p", F.when(F.col("doc_id") % 2 == 0, 3.0)), preference="p")
    assert preferred.filter(F.col("doc_id") % 2 == 0).agg(F.sum(f"{name}.taken")).first()[0] > preferred.filter(F.col("doc_id") % 2 == 1).agg(F.sum(f"{name}.taken")).first()[0]


def brute_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = {}
    for k in range(len(words) - 4):
        windows.setdefault(tuple(words[k:k + 5]), []).append(k)
    inside = {k + j for starts in windows.values() if len(starts) > 1 for k in starts for j in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_quality_counts_and_fences(spark):
    texts = ODD_TEXTS + ["a b c d e a b c d e", "a " * 30, "x y z\nx y z\n \n\n", "q#*|<>&%$ r", "a b c d e f a b c d e f a b c d", "1 2 3 4 5 6 2 3 4 5 6 7 2 3 4 5 6"] + texts_of(30)
    texts += [" ".join(f"{w}$%#" for w in t.split()) for t in texts_of(3, seed=11)]
    docs = docs_of(spark, texts).withColumn("quality", F.lit(1)).withColumn("kept", F.lit(2)).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    measured, column = quality.measure(docs)
    measured.write.format("noop").mode("overwrite").save()
    for r in measured.collect():
        q = r[column]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"]) == brute_counts(texts[r["doc_id"]]), texts[r["doc_id"]]
        assert q["base_failed"] == (q["n_words"] < 10 or 100 * q["n_repeat_words"] > 20 * q["n_words"])
    judged, kept = quality.judge(measured, column)
    verdict = {r["doc_id"]: r[kept] for r in judged.collect()}
    ordinary = range(len(texts) - 33, len(texts) - 3)
    assert all(verdict[k] for k in ordinary if len(texts[k].split()) >= 10) and not any(verdict[k] for k in range(len(texts) - 3, len(texts)))
    assert quality.keep_good(docs).columns == docs.columns and quality.keep_good(docs.limit(0)).count() == 0


def test_sketch_quantiles_are_within_one_percent(spark):
    rows = spark.range(5000).select((F.rand(1) * 3).alias("v"))
    cells = rows.select(quality._bucket(F.col("v")).alias("bucket")).groupBy("bucket").count().orderBy("bucket").collect()
    upto, exact = 0, sorted(r["v"] for r in rows.collect())
    for r in cells:
        upto += r["count"]
        middle = 2 * quality.GAMMA ** r["bucket"] / (quality.GAMMA + 1)
        assert abs(middle - exact[upto - 1]) <= 0.0101 * exact[upto - 1] + 1e-12


def test_toxicity(spark):
    rng = random.Random(1)
    insults = ["zorg", "blatherskite"]
    texts, labels = [], []
    for k in range(600):
        words = texts_of(1, seed=k, most=80)[0].split() + ["filler"] * 5
        toxic = k % 4 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["ZORG", "z0rg!", "blatherskite", "zоrg"])
            words.append(rng.choice(insults))
        texts.append(" ".join(words))
        labels.append((k, 1, int(toxic)))
    docs = docs_of(spark, texts + [None, ""]).withColumn("score", F.lit(1))
    model = toxicity.train_on(docs, spark.createDataFrame(labels + [(None, 1, 1), (5000, 1, None)], "doc_id bigint, quality int, toxic int"))
    rows = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h"), model.score(F.col("text")).alias("s")).collect()
    out = [(r["s"] >= 0.7) == bool(labels[r["doc_id"]][2]) for r in rows if r["h"] and r["doc_id"] < 600]
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows) and sum(out) / len(out) > 0.97
    assert all(0 <= r["s"] < 0.3 for r in rows if r["doc_id"] >= 600)
    empty = toxicity.train_on(docs.limit(0), spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert docs.select(empty.score(F.col("text")).alias("s")).distinct().count() == 1


def test_toxicity_scores_do_not_depend_on_the_bound(spark):
    rng = random.Random(3)
    texts, labels = [], []
    for k in range(6000):
        toxic = k % 10 == 0
        words = [f"w{rng.randrange(20)}" for _ in range(30)]
        if rng.random() < (0.6 if toxic else 0.03):
            words[rng.randrange(30)] = "zorg"
        texts.append(" ".join(words))
        labels.append((k, int(toxic)))
    docs, known = docs_of(spark, texts), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    probes = docs_of(spark, ["w1 " * 30, "w1 " * 15 + "zorg " + "w2 " * 14])
    scores = []
    for rows in (20_000, 800):
        model = toxicity.train_on(docs, known, rows=rows)
        scores.append([r["s"] for r in probes.select("doc_id", model.score(F.col("text")).alias("s")).orderBy("doc_id").collect()])
    natural = (0.1 * 0.4 / (0.1 * 0.4 + 0.9 * 0.97), 0.1 * 0.6 / (0.1 * 0.6 + 0.9 * 0.03))
    assert scores[0] == pytest.approx(natural, abs=0.06) and scores[1] == pytest.approx(scores[0], abs=0.1)
    # Without a fit the score is the share of all usable labels, not that of the drawn ones.
    few = known.filter("toxic = 0 or doc_id < 300")
    alone = toxicity.train(toxicity.labelled_sample(docs, few, rows=40).filter("half"))
    assert probes.select(alone.score(F.col("text")).alias("s")).first()["s"] < 0.05


def test_folding_and_exceptions():
    assert toxicity.fold("Y0u 1D10T!! mоrоn $tup1d") == " you idiot moron stupid " and toxicity.fold(None) == toxicity.fold("!!") == " "
    model = toxicity.ToxicityModel({" trash ": 2.0, " tras": 1.0}, ("trash can",), (0.0, 1.0, 0.0))
    automaton = model.automaton()
    assert model.total(automaton, toxicity.fold("take the trash can")) == 0.0
    assert model.total(automaton, toxicity.fold("you trash")) == 2.0 and model.total(automaton, toxicity.fold("trashy")) == 1.0


def test_urls(spark):
    cases = [
        ("http://A.example.NET/en/1", "a.example.net", "/en/1", "example.net/en/", "allow"), ("http://b.net/x?q#f", "b.net", "/x", "net/", "block"),
        ("https://m.example.com/de/9", "m.example.com", "/de/9", "example.com/de/", "block"), ("http://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
        ("http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"), ("http://a.net", "a.net", "", None, None), ("nothing", "", "", None, "allow"),
        (None, "", "", None, "allow"), ("x://h?p=/de/", "h", "", None, None), ("a://B://c/d", "b:", "//c/d", None, None), ("http://È.example.org/fr/a\nb", "È.example.org", "/fr/a\nb", "org/fr/", "allow"),
    ]
    model = urls.train(urls.labelled_table(spark))
    pages = spark.createDataFrame([(k, c[0]) for k, c in enumerate(cases)], "page_id bigint, url string").withColumn("judged", F.lit(0))
    for r in urls.judge(pages, model, URL_RULES).collect():
        _, host, path, rule, verdict = cases[r["page_id"]]
        found = r["judged_"]
        assert (found["host"], found["path"], found["rule"]) == (host, path, rule) and verdict in (None, found["verdict"])
    for text, unwanted in (("https://www.casino-pills.example/buy", True), ("https://blog.thenion.example/en/12", False)):
        one = urls.judge(spark.createDataFrame([(text,)], "url string"), model, ()).first()["judged"]
        assert (one["verdict"] == "block") == unwanted
    # The score is that of a plain logistic regression on unit vectors of bucket counts.
    row = spark.createDataFrame([("http://ab.example/c",)], "url string").select(urls.buckets(urls.host(F.col("url")), urls.path(F.col("url"))).alias("b"), model.score(urls.host(F.col("url")), urls.path(F.col("url"))).alias("s")).first()
    count = np.bincount(row["b"], minlength=urls.FEATURES)
    assert row["s"] == pytest.approx(1 / (1 + np.exp(-(count @ np.array(model.weights) / np.linalg.norm(count) + model.intercept))))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="driver tables not present")
def test_held_out_urls(spark):
    model = urls.train(urls.labelled_table(spark))
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    unwanted = F.col("judged.host").rlike("ads-track|spam-farm|casino-win|adult-x|cheap-pills|free-bets")
    right = urls.judge(pages, model, ()).select(((F.col("judged.verdict") == "block") == unwanted).cast("double").alias("r")).agg(F.avg("r")).first()[0]
    assert right >= 0.97
