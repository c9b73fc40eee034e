import random
from collections import Counter

import pytest

from platewise import schemas
from platewise.operators import classify as cl
from platewise.session import broadcast_if_small

PATHS = {1: [1], 10: [1, 10], 11: [1, 11], 100: [1, 10, 100], 101: [1, 10, 101], 110: [1, 11, 110]}
RANKS = {1: "R", 2: "G", 3: "S"}
K = 8


@pytest.fixture
def taxonomy(spark):
    return spark.createDataFrame([(t, RANKS[len(p)], f"taxon {t}", p) for t, p in PATHS.items()], schemas.TAXONOMY)


@pytest.fixture(scope="module")
def genomes():
    random.seed(5)
    shared, genus = ("".join(random.choice("ACGT") for _ in range(60)) for _ in range(2))
    own = {t: "".join(random.choice("ACGT") for _ in range(700)) for t in (100, 101, 110)}
    poly = "A" * 50
    return {t: s + shared + poly + (genus if t < 110 else "") for t, s in own.items()}


def brute_index(genomes):
    found = {}
    for taxid, seq in genomes.items():
        for i in range(len(seq) - K + 1):
            found.setdefault(seq[i:i + K], set()).add(taxid)
    out = {}
    for kmer, taxa in found.items():
        common = [step[0] for step in zip(*(PATHS[t] for t in taxa)) if len(set(step)) == 1]
        out[kmer] = common[-1]
    return out


@pytest.mark.parametrize("strides", [cl.STRIDES, (64, 16), (8, 1)])
def test_every_kmer_once(spark, monkeypatch, strides):
    monkeypatch.setattr(cl, "STRIDES", strides)
    random.seed(1)
    texts = ["", "ACGT", "ACGTACGT", "é" * 30 + "ü\n" * 10] + ["".join(random.choice("ACGT") for _ in range(n)) for n in (9, 15, 16, 17, 71, 72, 73, 300)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, seq string")
    got = Counter((r.id, r.kmer) for r in cl.kmers(df, "seq", K).collect())
    assert got == Counter((n, t[i:i + K]) for n, t in enumerate(texts) for i in range(len(t) - K + 1))


def test_index_match_and_classification(spark, taxonomy, genomes):
    references = spark.createDataFrame(list(genomes.items()), "taxid bigint, seq string")
    index = cl.kmer_index(references, taxonomy, K)
    expected = brute_index(genomes)
    assert {r.kmer: r.taxid for r in index.collect()} == expected
    assert set(expected.values()) >= {1, 10, 100, 101, 110}

    random.seed(9)
    reads = {}
    for n in range(60):
        seq = genomes[random.choice(list(genomes))]
        at = random.randrange(len(seq) - 100)
        reads[f"x{n}"] = seq[at:at + 100]
    reads |= {"none": "N" * 100, "short": "ACG", "hot": "A" * 5000}
    df = spark.createDataFrame([("r", "S", n, s) for n, s in reads.items()], "run_id string, sample_id string, read_id string, seq string")
    hits = cl.kmer_match(df, index, K)
    brute = {n: Counter(expected[s[i:i + K]] for i in range(len(s) - K + 1) if s[i:i + K] in expected) for n, s in reads.items()}
    assert {(r.read_id, r.taxid): r.hits for r in hits.collect()} == {(n, t): c for n, found in brute.items() for t, c in found.items()}

    calls = {r.read_id: (r.taxid, r.score) for r in cl.classify_reads(hits, taxonomy).collect()}
    for name, found in brute.items():
        scores = {t: sum(found[a] for a in PATHS[t]) for t in found}
        if not scores:
            assert name not in calls
            continue
        best = max(scores, key=lambda t: (scores[t], found[t], -t))
        assert calls[name] == (best, scores[best])


def test_report_is_depth_first_and_adds_up(spark, taxonomy, rows):
    assigned = [100] * 5 + [101] * 7 + [10] * 2 + [110] * 30 + [1] * 3 + [None] * 13
    calls = spark.createDataFrame([("r", "S", t) for t in assigned] + [("r", "T", 11)], "run_id string, sample_id string, taxid bigint")
    report = cl.taxon_report(calls.repartition(3), taxonomy)
    got = [(r.line_no, r.percentage, r.count_clade, r.count_taxon, r.rank_code, r.taxid, r.name) for r in report.where("sample_id = 'S'").orderBy("line_no").collect()]
    assert got == [
        (1, 21.67, 13, 13, "U", 0, "unclassified"), (2, 78.33, 47, 3, "R", 1, "  taxon 1"), (3, 50.0, 30, 0, "G", 11, "    taxon 11"),
        (4, 50.0, 30, 30, "S", 110, "      taxon 110"), (5, 23.33, 14, 2, "G", 10, "    taxon 10"), (6, 11.67, 7, 7, "S", 101, "      taxon 101"),
        (7, 8.33, 5, 5, "S", 100, "      taxon 100"),
    ]
    assert got[0][2] + got[1][2] == len(assigned)
    assert rows(report.where("sample_id = 'T'"), "line_no", "taxid", "count_clade") == [(1, 1, 1), (2, 11, 1)]


def test_broadcast_only_below_the_bound(spark):
    small = spark.range(10)
    assert "ResolvedHint" in broadcast_if_small(small, 10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_if_small(small, 9)._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("hot_count", [5, 10**9])
def test_match_without_broadcast(spark, taxonomy, genomes, rows, hot_count):
    references = spark.createDataFrame(list(genomes.items()), "taxid bigint, seq string")
    index = cl.kmer_index(references, taxonomy, K)
    data = [("r", "S", f"x{n}", genomes[100] if n % 3 else "A" * 400 + "ACGT") for n in range(12)]
    df = spark.createDataFrame(data, "run_id string, sample_id string, read_id string, seq string")
    shuffled = cl.kmer_match(df, index, K, max_broadcast=0, salts=7, sample=1.0, hot_limit=3, hot_count=hot_count)
    assert rows(shuffled) == rows(cl.kmer_match(df, index, K))


def test_unknown_taxids_are_named(spark):
    taxonomy = spark.createDataFrame([(1, [1])], "taxid bigint, path array<bigint>")
    with pytest.raises(Exception, match="taxid not in the taxonomy: 99"):
        cl.kmer_index(spark.createDataFrame([(99, "ACGTACGT")], "taxid bigint, seq string"), taxonomy, 5).collect()
    hits = spark.createDataFrame([("r", "s", "x", 99, 3)], "run_id string, sample_id string, read_id string, taxid bigint, hits bigint")
    with pytest.raises(Exception, match="taxid not in the taxonomy: 99"):
        cl.classify_reads(hits, taxonomy).collect()


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_both_mates_count_for_the_pair(spark, taxonomy, genomes, rows, bound):
    index = cl.kmer_index(spark.createDataFrame(list(genomes.items()), "taxid bigint, seq string"), taxonomy, 15)
    texts = list(genomes.values())
    pairs = spark.createDataFrame(
        [("r", "s", str(i), a, b) for i, (a, b) in enumerate([(texts[0], texts[1]), (texts[0], None), (None, texts[1]), (None, None)])],
        "run_id string, sample_id string, read_id string, seq1 string, seq2 string",
    )
    hits = {(r, t): n for r, t, n in rows(cl.kmer_match(pairs, index, 15, max_broadcast=bound, seqs=("seq1", "seq2")), "read_id", "taxid", "hits")}
    taxa = {t for _, t in hits}
    assert {r for r, _ in hits} == {"0", "1", "2"}
    assert all(hits.get(("0", t), 0) == hits.get(("1", t), 0) + hits.get(("2", t), 0) for t in taxa)


def nodes(seed, n):
    """A random tree as paths."""
    draw = random.Random(seed)
    paths = {1: [1]}
    for taxid in draw.sample(range(2, 10 * n), n):
        paths[taxid] = [*paths[draw.choice(list(paths))], taxid]
    return paths


@pytest.mark.parametrize("seed,n", [(1, 1), (2, 40), (3, 400)])
def test_nested_sets(spark, seed, n):
    paths = nodes(seed, n)
    sets = cl.nested_sets(spark.createDataFrame(list(paths.items()), "taxid bigint, path array<bigint>").repartition(3))
    got = {r.taxid: (r.enter, r.leave) for r in sets.collect()}
    assert sorted(e for e, _ in got.values()) == list(range(len(paths)))
    for taxid, (enter, leave) in got.items():
        below = [got[t][0] for t, p in paths.items() if taxid in p]
        assert (min(below), max(below), len(below)) == (enter, leave, leave - enter + 1)


def test_report_on_a_deep_tree(spark):
    """Every line of the report against sums over paths, with several samples."""
    paths = nodes(4, 120)
    draw = random.Random(5)
    calls = [("r", s, draw.choice([None, *paths])) for s in ("a", "b", "b", "c") for _ in range(draw.randrange(1, 60))]
    taxonomy = spark.createDataFrame([(t, "S", f"n{t}", p) for t, p in paths.items()], schemas.TAXONOMY)
    report = cl.taxon_report(spark.createDataFrame(calls, "run_id string, sample_id string, taxid bigint"), taxonomy)
    got = {}
    for r in report.orderBy("sample_id", "line_no").collect():
        got.setdefault(r.sample_id, []).append((r.taxid, r.count_clade, r.count_taxon, r.name))
    for sample in {s for _, s, _ in calls}:
        direct = Counter(t for _, s, t in calls if s == sample)
        clade = Counter()
        for t, n in direct.items():
            for a in paths[t] if t else ():
                clade[a] += n
        wanted = [(0, direct[None], direct[None], "unclassified")] if direct[None] else []
        wanted += [(t, clade[t], direct[t], "  " * len(paths[t]) + f"n{t}") for t in sorted(clade, key=lambda t: [(-clade[a], a) for a in paths[t]])]
        assert got[sample] == wanted


def test_classification_on_a_deep_tree(spark):
    paths = nodes(6, 80)
    draw = random.Random(7)
    hits = [("x%d" % r, t, draw.randrange(1, 5)) for r in range(30) for t in draw.sample(list(paths), draw.randrange(1, 25))]
    taxonomy = spark.createDataFrame(list(paths.items()), "taxid bigint, path array<bigint>")
    calls = cl.classify_reads(spark.createDataFrame(hits, "read_id string, taxid bigint, hits bigint"), taxonomy, keys=["read_id"])
    for r in calls.collect():
        found = {t: n for x, t, n in hits if x == r.read_id}
        scores = {t: sum(found.get(a, 0) for a in paths[t]) for t in found}
        best = max(scores, key=lambda t: (scores[t], found[t], -t))
        assert (r.taxid, r.score) == (best, scores[best])


@pytest.mark.parametrize("k,m,at_once,longest", [(8, 3, 1 << 20, 64), (8, 10, 50, 3), (5, 1, 7, 64), (1, 1, 3, 2), (21, 10, 1 << 20, 64)])
def test_runs_hold_every_kmer_once(spark, monkeypatch, k, m, at_once, longest):
    monkeypatch.setattr(cl, "AT_ONCE", at_once)
    monkeypatch.setattr(cl, "RUN_KMERS", longest)
    draw = random.Random(8)
    texts = [None, "", "ACGT", "A" * 200, "é日🙂" * 20, "ACGTACGTA", *("".join(draw.choices("ACGTNé", k=draw.randrange(90))) for _ in range(40))]
    df = spark.createDataFrame([(n, f"t{n}", t) for n, t in enumerate(texts)], "id int, tag string, seq string").repartition(2)
    runs = cl.super_kmers(df, "seq", k, m).collect()
    got, minimizers = Counter(), {}
    for r in runs:
        assert r.tag == f"t{r.id}" and k <= len(r.run) <= longest + k - 1
        for i in range(len(r.run) - k + 1):
            got[r.id, r.run[i:i + k]] += 1
            minimizers.setdefault(r.run[i:i + k], set()).add(r.minimizer)
    assert got == Counter((n, t[i:i + k]) for n, t in enumerate(texts) for i in range(len(t or "") - k + 1))
    assert all(len(x) == 1 for x in minimizers.values())


@pytest.mark.parametrize("k,at_once,longest", [(8, 1 << 16, 64), (8, 30, 3), (21, 7, 64), (1, 3, 2)])
def test_only_kmers_of_the_index_become_rows(spark, monkeypatch, k, at_once, longest):
    monkeypatch.setattr(cl, "HASHED_AT_ONCE", at_once)
    monkeypatch.setattr(cl, "RUN_KMERS", longest)
    draw = random.Random(10)
    reference = "".join(draw.choices("ACGT", k=300)) + "é日🙂" * 10 + "G" * 40
    known = {reference[i:i + k] for i in range(len(reference) - k + 1)}
    extra = [(1, "A" * (k + 1)), (1, "C" * (k - 1)), (1, None)]
    index = spark.createDataFrame([(1, x) for x in sorted(known)] + extra, "taxid int, kmer string")
    texts = [None, "", "ACG", "G" * 300, reference, "x" + reference[50:90] + "y" + reference[91:130], "".join(draw.choices("acgtné🙂", k=20_000)), reference[:k - 1], reference[k - 1:]]
    df = spark.createDataFrame([(n, None if n == 4 else f"t{n}", t) for n, t in enumerate(texts)], "id int, tag string, seq string").repartition(2)
    got = Counter()
    for r in cl.likely_runs(df, "seq", k, index).collect():
        assert r.tag == (None if r.id == 4 else f"t{r.id}") and k <= len(r._run) <= longest + k - 1
        got.update((r.id, r._run[i:i + k]) for i in range(len(r._run) - k + 1))
    assert got == Counter((n, t[i:i + k]) for n, t in enumerate(texts) for i in range(len(t or "") - k + 1) if t[i:i + k] in known)


def test_equal_hashes_are_no_hits(spark, taxonomy, genomes, rows, monkeypatch):
    """Every hash the same: all k-mers of the reads get through, the index still decides."""
    index = cl.kmer_index(spark.createDataFrame(list(genomes.items()), "taxid bigint, seq string"), taxonomy, K)
    reads = [("r", None if n == 1 else "S", f"x{n}", t) for n, t in enumerate([genomes[100][:200], "N" * 100 + genomes[110][5:50], "é" * 70, None, "ACG"])]
    df = spark.createDataFrame(reads + reads[:1], "run_id string, sample_id string, read_id string, seq string")
    hits = rows(cl.kmer_match(df, index, K))
    expected = brute_index(genomes)
    found = Counter((s, n, expected[t[i:i + K]]) for _, s, n, t in reads + reads[:1] for i in range(len(t or "") - K + 1) if t[i:i + K] in expected)
    assert {(s, n, t): c for _, s, n, t, c in hits} == found
    empty = index.where("false")
    assert cl.kmer_match(df, empty, K).count() == 0
    whole = cl._hashes
    monkeypatch.setattr(cl, "_hashes", lambda text, k, ups, downs: whole(text, k, ups, downs) * 0)
    runs = cl.likely_runs(df.select("read_id", "seq"), "seq", K, index).collect()
    assert sum(len(r._run) - K + 1 for r in runs) == sum(max(0, len(t or "") - K + 1) for *_, t in reads + reads[:1])
    assert rows(cl.kmer_match(df, index, K)) == hits


def test_reads_of_broken_text(spark, taxonomy, genomes):
    index = cl.kmer_index(spark.createDataFrame(list(genomes.items()), "taxid bigint, seq string"), taxonomy, K)
    df = spark.createDataFrame([("x", bytearray(b"\xff\xfe" + genomes[100][:50].encode() + b"\xf0"))], "read_id string, seq binary")
    hits = cl.kmer_match(df.selectExpr("read_id", "cast(seq as string) as seq"), index, K, keys=["read_id"])
    assert sum(r.hits for r in hits.collect()) == 50 - K + 1
