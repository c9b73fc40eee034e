"""Phrase collocations and their transducers against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from platewise.llm import collocations as c

SCHEMA = "doc_id long, text string, lang string, n long, phrase string"


def pieces(text):
    low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def expected(rows, longest, least, covered, top):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        for words in pieces(text):
            total[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                for k in range(len(words) - m + 1):
                    counts[lang or "und"][tuple(words[k:k + m])] += 1
    out = set()
    for lang, f in counts.items():
        found = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        gone = set()
        for g, a in found.items():
            for m in range(2, len(g)):
                for k in range(len(g) - m + 1):
                    if 100 * a >= covered * found[g[k:k + m]]:
                        gone.add(g[k:k + m])
        ranked = []
        for g, a in found.items():
            if g not in gone:
                score, _, l, r = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                ranked.append((-score, -a, " ".join(g).encode(), l, r))
        for k, (score, a, g, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.add((lang, k, g.decode(), -a, l, r, total[lang], -score))
    return out


def documents(seed, n=80):
    draw = random.Random(seed)
    words = ["a", "B", "b", "é", "日本", "x-y", "\x01", "the"] + [f"w{k}" for k in range(12)]
    breaks = [" ", " ", " ", "  ", "\t", ".", ", ", "!", "\n", "\r\n", " ;: "]
    rows = []
    for i in range(n):
        text = "".join(draw.choice(words) + draw.choice(breaks) for _ in range(draw.randrange(60)))
        text += " New York City" * draw.randrange(3)
        rows.append((i, draw.choice([text, text, text, None, "", "..", " "]), draw.choice(["en", "en", "de", None]), 1, "clash"))
    return rows + rows[:7]


@pytest.mark.parametrize("seed,longest,least,ranges,top", [(1, 3, 10, 1, 2000), (2, 3, 3, 9, 15), (3, 4, 2, 40, 100), (4, 2, 2, 5, 7)])
def test_collocations(spark, seed, longest, least, ranges, top):
    """The same rows whatever the number of ranges, for phrases of up to two, three and four words."""
    rows = documents(seed)
    found = c.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5), longest=longest, least=least, top=top, ranges=ranges)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected(rows, longest, least, 50, top))


def test_small_limits(spark, monkeypatch):
    """Shards of few words, slices inside texts and unions in many steps change nothing."""
    for name, value in (("SHARD_WORDS", 50), ("SLICE", 7), ("WAITING", 20), ("PORTION", 3)):
        monkeypatch.setattr(c, name, value)
    rows = documents(5)
    found = c.collocations(spark.createDataFrame(rows, SCHEMA), least=4, ranges=6)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected(rows, 3, 4, 50, 2000))


def test_hot_word(spark):
    """A word that begins most phrases is spread over ranges; counts stay exact."""
    draw = random.Random(6)
    rows = [(k, " ".join(f"the w{draw.randrange(30)}" for _ in range(200)), "en", 1, "") for k in range(120)]
    docs = spark.createDataFrame(rows, SCHEMA)
    bounds = c.boundaries(docs.selectExpr("lang", "cast(text as binary) as text"), 3, 16)
    assert sum(b[0] == b"the" for b in bounds["en"]) > 3
    found = c.collocations(docs, ranges=16)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected(rows, 3, 10, 50, 2000))


def test_no_rows(spark):
    assert c.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert c.collocations(spark.createDataFrame([(1, None, None, 1, ""), (2, "", "x", 1, "")], SCHEMA)).collect() == []


def test_large_counts(spark):
    """Scores of counts whose products pass 64 bits are exact."""
    a, l, r = 3_000_000_000, 4_000_000_001, 3_000_000_007
    wide = spark.sql(f"SELECT CAST(1000000 AS decimal(7,0)) * (CAST({a} AS decimal(19,0)) * CAST({a} AS decimal(19,0))) div (CAST({l} AS decimal(19,0)) * CAST({r} AS decimal(19,0))) AS s")
    assert wide.first()["s"] == 10**6 * a * a // (l * r)


def trie(counts):
    words = sorted({w for g in counts for w in g})
    place = {w: k for k, w in enumerate(words)}
    levels, before = [], {(): 0}
    for m in range(1, max(map(len, counts)) + 1):
        grams = sorted({g[:m] for g in counts if len(g) >= m})
        levels.append(tuple(np.array(x, np.int64) for x in (
            [before[g[:-1]] for g in grams], [place[g[-1]] for g in grams], [counts.get(g, 0) for g in grams])))
        before = {g: k for k, g in enumerate(grams)}
    return words, levels


def language(words, levels):
    out, grams = {}, [()]
    for parent, label, weight in levels:
        grams = [grams[p] + (words[w],) for p, w in zip(parent.tolist(), label.tolist())]
        out.update({g: n for g, n in zip(grams, weight.tolist()) if n})
    return out


@pytest.mark.parametrize("portion", [1, 4, 1 << 18])
def test_transducer(portion):
    draw = random.Random(7)
    counts = {tuple(draw.choices([b"a", b"b", b"\xc3\xa9", b"d"], k=draw.randrange(1, 5))): draw.choice([1, 1, 2, 300, 1 << 40]) for _ in range(150)}
    words, levels = trie(counts)
    one = c.build(levels, words, portion)
    again = c.Transducer.from_bytes(one.to_bytes())
    assert language(again.words, again.levels()) == counts
    # Minimal: no two states have the same arcs.
    states = [tuple(zip(*(x[one.first[s]:one.first[s + 1]].tolist() for x in (one.label, one.weight, one.target)))) for s in range(len(one.first) - 1)]
    assert len(set(states)) == len(states)
    parts = sorted(set(counts) | {(b"zz",), (b"a", b"zz"), (b"a", b"b", b"a", b"b", b"a")} | {g[:k] for g in counts for k in range(1, len(g))})
    draw.shuffle(parts)
    assert c.compose(one, parts).tolist() == [counts.get(p, 0) for p in parts]
    # Cut at any boundaries, the ranges hold every n-gram once; added up they are what was there.
    bounds = sorted(tuple(draw.choices([b"a", b"b", b"c", b"d", b"\xc3\xa9"], k=len(levels))) for _ in range(5))
    cuts = [[0] * len(levels), *(c.cut_at(levels, words, b) for b in bounds), [len(x[0]) for x in levels]]
    blocks = [c.between(levels, x, y) for x, y in zip(cuts, cuts[1:])]
    seen = Counter()
    for k, block in enumerate(blocks):
        for g, n in language(words, block).items() if block else ():
            seen[g] += n
            assert sum(b <= g for b in bounds) == k
    assert seen == counts
    doubled = c.union([(words, levels), (one.words, one.levels()), *((words, b) for b in blocks if b)])
    assert language(*doubled) == {g: 3 * n for g, n in counts.items()}
    wanted = {g[:k] for g, n in counts.items() if n > 1 for k in range(1, len(g) + 1)}
    assert language(words, c.prune(levels, 2)) == {g: n for g, n in counts.items() if g in wanted}


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_tokens(size):
    for text in ["", " ", "a", "A b.c", "abc" * 9, "x\ty,, z", "é日 本!?", "end ", ".", "a\r\nb"]:
        found = [w for part in c.tokens(text.encode(), size) for w in part]
        want = []
        for k, p in enumerate(pieces(text)):
            want += ([b"."] if k else []) + [w.encode() for w in p]
        assert found == want
