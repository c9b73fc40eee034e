"""q18 to q25: read-pair stages over documents, and subsampling over lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from platewise.catalog import query
from platewise.catalog import standins as st
from platewise.functions import sequence as sq
from platewise.operators import reads as rd
from platewise.plans.read_stages import processed_reads
from platewise.session import checkpointed


@query("q18_read_stats", f"""WITH {st.READS},
s AS (SELECT run_id, sample_id, mate, count(*) AS total_sequences, CAST(sum(length(seq)) AS BIGINT) AS bases,
    CAST(sum(length(seq) - length(translate(seq, 'GCgc', ''))) AS BIGINT) AS gc_bases FROM mates WHERE seq <> '' GROUP BY ALL)
SELECT *, gc_bases * 100 / bases AS percent_gc, bases / total_sequences AS avg_sequence_length FROM s""")
def q18(spark, sf_dir):
    return rd.read_stats(st.reads(spark, sf_dir))


@query("q19_length_hist", f"""WITH {st.READS}
SELECT run_id, sample_id, mate, CAST(length(seq) AS INTEGER) AS read_length, count(*) AS n_reads FROM mates GROUP BY ALL""")
def q19(spark, sf_dir):
    return rd.length_histogram(st.reads(spark, sf_dir))


POSITION_SQL = f"""{st.READS},
symbols AS (
  SELECT run_id, sample_id, mate, unnest(regexp_extract_all(seq, '(?s).')) AS b, unnest(regexp_extract_all(qual, '(?s).')) AS q,
    unnest(range(length(seq))) AS pos FROM mates),
cells AS (
  SELECT run_id, sample_id, mate, pos // 50 * 50 AS pos, ord(q) - 33 AS quality,
    CASE WHEN upper(b) IN ('A', 'C', 'G', 'T') THEN upper(b) ELSE 'N' END AS base FROM symbols)"""


@query("q20_position_profile", f"""WITH {POSITION_SQL}
SELECT run_id, sample_id, mate, CAST(pos AS INTEGER) AS pos, count(*) AS depth, CAST(sum(quality) AS DOUBLE) / count(*) AS mean_quality,
  quantile_disc(quality, 0.25) AS q1_quality, quantile_disc(quality, 0.5) AS median_quality, quantile_disc(quality, 0.75) AS q3_quality,
  {", ".join(f"CAST(count(*) FILTER (base = '{b}') * 100 AS DOUBLE) / count(*) AS pct_{b}" for b in "ACGTN")}
FROM cells GROUP BY run_id, sample_id, mate, pos""")
def q20(spark, sf_dir):
    return rd.position_profile(rd.position_counts(st.reads(spark, sf_dir), bin_width=50))


@query("q20b_module_status", f"""WITH {POSITION_SQL},
medians AS (SELECT run_id, sample_id, mate, pos, quantile_disc(quality, 0.5) AS m FROM cells GROUP BY run_id, sample_id, mate, pos)
SELECT run_id, sample_id, mate, 'per_base_sequence_quality' AS module,
  CASE WHEN min(m) < 20 THEN 'fail' WHEN min(m) < 28 THEN 'warn' ELSE 'pass' END AS status FROM medians GROUP BY run_id, sample_id, mate""")
def q20b(spark, sf_dir):
    profile = rd.position_profile(rd.position_counts(st.reads(spark, sf_dir), bin_width=50))
    return rd.module_status(profile, warn_below=28)


@query("q21_duplicates", f"""WITH {st.READS},
s AS (SELECT run_id, sample_id, mate, count(*) AS n_reads, count(DISTINCT seq) AS n_distinct FROM mates GROUP BY ALL)
SELECT *, (n_reads - n_distinct) * 100 / n_reads AS duplicate_pct FROM s""")
def q21(spark, sf_dir):
    return rd.duplicate_reads(st.reads(spark, sf_dir))


@query("q22_subsample", """WITH r AS (
  SELECT l_returnflag, l_linenumber, concat_ws(':', l_orderkey, l_partkey, l_suppkey) AS read_id, l_quantity, l_shipdate,
    count(*) OVER (PARTITION BY l_returnflag, l_linenumber) AS total FROM lineitem),
k AS (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linenumber ORDER BY md5('100:' || read_id), read_id) AS rn FROM r)
SELECT l_returnflag, l_linenumber, read_id, l_quantity, strftime(l_shipdate, '%Y-%m-%d') AS shipdate FROM k
WHERE total <= 2860 OR rn <= 2850""")
def q22(spark, sf_dir):
    rows = st.load(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linenumber", F.concat_ws(":", "l_orderkey", "l_partkey", "l_suppkey").alias("read_id"),
        "l_quantity", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipdate"),
    )
    return rd.subsample_pairs(
        rows, n=2850, min_pairs=2860, keys=["l_returnflag", "l_linenumber"], id_columns=["read_id"]
    )


# three 16-base seeds that occur in the texts, one of them only with differences
ADAPTERS = ["The and attion to thanedble", "Orre Orre Orre Orre", "e_the, anea_ Eriner"]


def _sql_trim(n: int) -> str:
    """One mate: start and end by symbols, window sums by position, then length, then adapter."""
    low = st.sql_text(sq.low_symbols(3))
    seeds = ", ".join(st.sql_text(a[:16]) for a in ADAPTERS)
    return f"""ends{n} AS (
  SELECT read_id, seq{n} AS seq, qual{n} AS qual, length(qual{n}) - length(ltrim(qual{n}, {low})) AS lead,
    length(rtrim(ltrim(qual{n}, {low}), {low})) AS len FROM reads),
sym{n} AS (
  SELECT read_id, len, unnest(range(len)) AS pos, unnest(regexp_extract_all(substr(qual, lead + 1, len), '(?s).')) AS q FROM ends{n} WHERE len > 0),
win{n} AS (
  SELECT read_id, min(pos) AS cut FROM (
    SELECT read_id, len, pos, sum(ord(q) - 33) OVER (PARTITION BY read_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS s FROM sym{n})
  WHERE pos <= len - 4 AND s < 80 GROUP BY read_id),
cut{n} AS (
  SELECT read_id, lead, seq, qual, CASE WHEN coalesce(cut, len) < 100 THEN 0 ELSE coalesce(cut, len) END AS keep
  FROM ends{n} LEFT JOIN win{n} USING (read_id)),
kept{n} AS (SELECT read_id, substr(seq, lead + 1, keep) AS seq, substr(qual, lead + 1, keep) AS qual FROM cut{n}),
clip{n} AS (
  SELECT read_id, min(i) AS i FROM (
    SELECT read_id, seq, unnest(range(greatest(length(seq) - 15, 0))) AS i FROM kept{n}), (SELECT unnest([{seeds}]) AS seed)
  WHERE mismatches(substr(seq, CAST(i AS INTEGER) + 1, 16), seed) <= 2 GROUP BY read_id),
trim{n} AS (
  SELECT read_id, substr(seq, 1, coalesce(i, length(seq))) AS seq, substr(qual, 1, coalesce(i, length(seq))) AS qual
  FROM kept{n} LEFT JOIN clip{n} USING (read_id))"""


_DIFFERENCES = "len(list_filter(list_zip(regexp_extract_all(substr(seq, CAST(i AS INTEGER) + 1, 16), '(?s).'), regexp_extract_all(seed, '(?s).')), lambda p: p[1] <> p[2]))"
TRIM_SQL = f"""{st.READS}, {_sql_trim(1)}, {_sql_trim(2)},
trimmed AS (
  SELECT run_id, sample_id, read_id, a.seq AS seq1, a.qual AS qual1, b.seq AS seq2, b.qual AS qual2,
    CASE WHEN a.seq <> '' AND b.seq <> '' THEN 'paired' WHEN a.seq <> '' THEN 'unpaired_r1' WHEN b.seq <> '' THEN 'unpaired_r2' ELSE 'dropped' END AS survivor
  FROM reads JOIN trim1 a USING (read_id) JOIN trim2 b USING (read_id))""".replace(
    "mismatches(substr(seq, CAST(i AS INTEGER) + 1, 16), seed)", _DIFFERENCES
)


def _trimmed(spark, sf_dir):
    return rd.trim_reads(st.reads(spark, sf_dir), ADAPTERS)


@query("q23_trim", f"""WITH {TRIM_SQL}
SELECT read_id, length(seq1) AS len1, md5(seq1) AS seq1, md5(qual1) AS qual1, length(seq2) AS len2, md5(seq2) AS seq2, md5(qual2) AS qual2, survivor
FROM trimmed""")
def q23(spark, sf_dir):
    def digest(name):
        return F.md5(F.col(name).cast("binary")).alias(name)

    return _trimmed(spark, sf_dir).select(
        "read_id", F.length("seq1").alias("len1"), digest("seq1"), digest("qual1"), F.length("seq2").alias("len2"),
        digest("seq2"), digest("qual2"), "survivor",
    )


@query("q24_trim_survival", f"""WITH {TRIM_SQL}, s AS (
  SELECT run_id, sample_id, count(*) AS pairs, {", ".join(f"count(*) FILTER (survivor = '{c}') AS {c}" for c in ("paired", "unpaired_r1", "unpaired_r2", "dropped"))}
  FROM trimmed GROUP BY run_id, sample_id)
SELECT *, paired / pairs * 100 AS surviving_pct FROM s""")
def q24(spark, sf_dir):
    return rd.trim_survival(_trimmed(spark, sf_dir))


@query("q25_lane_union", f"WITH {st.READS} SELECT run_id, sample_id, count(*) AS pairs FROM reads GROUP BY ALL")
def q25(spark, sf_dir):
    reads = st.reads(spark, sf_dir)
    return rd.pair_count(rd.union_lanes([reads.where("lane = 'en'"), reads.where("lane <> 'en'")]))


@query("q47_processed_reads", f"""WITH {TRIM_SQL}, p AS (
  SELECT run_id, sample_id, lane, read_id, t.seq1, t.seq2, count(*) OVER (PARTITION BY run_id, sample_id) AS total,
    row_number() OVER (PARTITION BY run_id, sample_id ORDER BY md5(concat_ws(':', '100', lane, read_id)), read_id) AS rn
  FROM trimmed t JOIN (SELECT read_id, lane FROM reads) USING (read_id) WHERE survivor = 'paired')
SELECT run_id, sample_id, lane, read_id, md5(seq1) AS seq1, md5(seq2) AS seq2 FROM p WHERE total <= 2 OR rn <= 1""")
def q47(spark, sf_dir):
    kept = processed_reads(checkpointed(_trimmed(spark, sf_dir)), n=1, min_pairs=2)
    digests = [F.md5(F.col(c).cast("binary")).alias(c) for c in ("seq1", "seq2")]
    return kept.select("run_id", "sample_id", "lane", "read_id", *digests)
