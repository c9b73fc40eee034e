"""The divergence audit against plain Python."""

import random
import re
from collections import Counter

import pytest

from platewise.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, term string, n long"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def expected(rows, least, top):
    counts, df, groups = Counter(), Counter(), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [lowered(t) for t in TERM.findall(text or "")]
        for t in terms:
            counts[lang, source, t] += 1
        for t in set(terms):
            df[lang, t] += 1
    out = set()
    for lang in {a for a, _ in groups}:
        kept = sorted(t for (a, t), n in df.items() if a == lang and n >= least)
        sources = sorted(s for a, s in groups if a == lang)

        def shares(of):
            total = sum(of(t) for t in kept)
            return {t: 1 + 10**9 * (of(t) + 5) // (total + 5 * len(kept)) for t in kept}

        q = shares(lambda t: sum(counts[lang, s, t] for s in sources))
        p = {s: shares(lambda t, s=s: counts[lang, s, t]) for s in sources}
        for s in sources:
            pairs = [(h, sum(abs(p[s][t] - p[h][t]) for t in kept)) for h in sources if h != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s, t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, k) for k, (item, value) in enumerate(found[:limit], 1)}
    return out


def check(spark, rows, least, top, **limits):
    found = [tuple(r) for r in divergence.audit(spark.createDataFrame(rows, SCHEMA), least=least, top=top).collect()]
    assert len(found) == len(set(found))
    assert set(found) == expected(rows, least, top)


def documents(seed, n=150):
    draw = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{'é' * (i % 3)}" for i in range(60)] + ["日本", "Ab", "aB", "x"]
    rows = []
    for i in range(n):
        text = draw.choice([" ", "-", "1", "\n", "_"]).join(draw.choices(words, k=draw.randrange(40)))
        rows.append((i, draw.choice([text, text, text, None, ""]), draw.choice(["en", "en", "de", None]), draw.choice(["s0", "s0", "s1", "s2", "ü", None]), "clash", 1))
    return rows + rows[:10] + [(900, "", "nl", "only", None, None), (901, None, "pt", "a", None, None), (902, "solo", "pt", "b", None, None)]


def test_audit(spark):
    check(spark, documents(1), least=5, top=4)


def test_audit_many_blocks(spark, monkeypatch):
    """Sources in several blocks and terms in several cells give what one block gives."""
    monkeypatch.setattr(divergence, "BLOCK", 2)
    monkeypatch.setattr(divergence, "CELL", 8)
    check(spark, documents(2), least=3, top=50)


def test_audit_sums_passed_on_early(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 5)
    check(spark, documents(3, 40), least=2, top=3)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("text", ["", " ", "aB1c", "x" * 50 + " y", "ab cd ef gh", "日本語" * 9 + "!Z", "q" * 8, "q" * 16 + " ", " " * 20])
@pytest.mark.parametrize("size", [1, 3, 8])
def test_slices(text, size):
    """A text cut into slices has the terms of the whole text, also where one term is longer than a slice."""
    data = text.encode()
    words = [w for piece in divergence.slices(data, size) for w in piece.split()]
    assert [w.decode() for w in words] == [lowered(t) for t in TERM.findall(text)]
