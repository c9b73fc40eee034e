"""q29, q30, q36: k-mer index, read classification and taxon reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from platewise.catalog import query
from platewise.catalog import standins as st
from platewise.operators import classify as cl
from platewise.session import checkpointed

K = 21
ROOT, GENUS, ITEM = 1, 100, 1_000_000


def _taxonomy(spark, sf_dir):
    """Benchmark items as taxa below five genera below one root."""
    item = F.col("item_id")
    genus = F.lit(GENUS) + item % 5
    items = st.load(spark, sf_dir, "benchmark").select(
        (F.lit(ITEM) + item).alias("taxid"), F.lit("S").alias("rank_code"),
        F.concat(F.lit("item "), item.cast("string")).alias("name"),
        F.array(F.lit(ROOT).cast("bigint"), genus, F.lit(ITEM) + item).alias("path"),
    )
    genera = st.load(spark, sf_dir, "benchmark").select(genus.alias("taxid")).distinct().select(
        "taxid", F.lit("G").alias("rank_code"), F.concat(F.lit("genus "), F.col("taxid").cast("string")).alias("name"),
        F.array(F.lit(ROOT).cast("bigint"), "taxid").alias("path"),
    )
    root = st.load(spark, sf_dir, "benchmark").select(F.lit(ROOT).cast("bigint").alias("taxid")).distinct().select(
        "taxid", F.lit("R").alias("rank_code"), F.lit("root").alias("name"), F.array("taxid").alias("path")
    )
    return items.unionByName(genera).unionByName(root)


def _index(spark, sf_dir):
    references = st.load(spark, sf_dir, "benchmark").select(
        (F.lit(ITEM) + F.col("item_id")).alias("taxid"), F.col("text").alias("seq")
    )
    return cl.kmer_index(references, _taxonomy(spark, sf_dir), K)


def _reads(spark, sf_dir):
    return st.documents(spark, sf_dir).select("doc_id", F.col("text").alias("seq"))


# a k-mer of one item belongs to the item, of one genus to the genus, else to the root
INDEX_SQL = f"""ref AS (
  SELECT DISTINCT item_id, item_id % 5 AS genus, substr(text, CAST(i AS INTEGER), {K}) AS kmer
  FROM (SELECT item_id, text, unnest(range(1, length(text) - {K} + 2)) AS i FROM benchmark WHERE length(text) >= {K})),
idx AS (
  SELECT kmer, CASE WHEN count(DISTINCT item_id) = 1 THEN {ITEM} + min(item_id)
    WHEN count(DISTINCT genus) = 1 THEN {GENUS} + min(genus) ELSE {ROOT} END AS taxid FROM ref GROUP BY kmer)"""
HITS_SQL = f"""{INDEX_SQL},
reads AS (
  SELECT doc_id, substr(text, CAST(i AS INTEGER), {K}) AS kmer
  FROM (SELECT doc_id, text, unnest(range(1, length(text) - {K} + 2)) AS i FROM documents WHERE length(text) >= {K})),
hits AS (SELECT doc_id, taxid, count(*) AS hits FROM reads JOIN idx USING (kmer) GROUP BY ALL)"""
CALLS_SQL = f"""{HITS_SQL},
paths AS (
  SELECT DISTINCT taxid, {ROOT} AS node FROM hits UNION
  SELECT DISTINCT taxid, CASE WHEN taxid >= {ITEM} THEN {GENUS} + (taxid - {ITEM}) % 5 ELSE taxid END FROM hits WHERE taxid <> {ROOT} UNION
  SELECT DISTINCT taxid, taxid FROM hits),
scored AS (
  SELECT h.doc_id, h.taxid, h.hits, sum(a.hits) AS score FROM hits h JOIN paths p ON p.taxid = h.taxid
  JOIN hits a ON a.doc_id = h.doc_id AND a.taxid = p.node GROUP BY h.doc_id, h.taxid, h.hits),
calls AS (
  SELECT doc_id, CAST(taxid AS BIGINT) AS taxid, CAST(score AS BIGINT) AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, hits DESC, taxid) AS rn FROM scored) WHERE rn = 1)"""


@query("q29_kmer_index", f"WITH {INDEX_SQL} SELECT kmer, CAST(taxid AS BIGINT) AS taxid FROM idx")
def q29_index(spark, sf_dir):
    return _index(spark, sf_dir)


@query("q29b_kmer_match", f"WITH {HITS_SQL} SELECT doc_id, CAST(taxid AS BIGINT) AS taxid, hits FROM hits")
def q29_match(spark, sf_dir):
    return cl.kmer_match(_reads(spark, sf_dir), _index(spark, sf_dir), K, keys=["doc_id"])


@query("q29c_kmer_classify", f"WITH {CALLS_SQL} SELECT * FROM calls")
def q29_classify(spark, sf_dir):
    return cl.classify_reads(q29_match(spark, sf_dir), _taxonomy(spark, sf_dir), keys=["doc_id"])


@query("q29d_pair_classify", f"""WITH {INDEX_SQL}, {st.READS},
kmers AS (
  SELECT read_id, substr(seq, CAST(i AS INTEGER), {K}) AS kmer
  FROM (SELECT read_id, seq, unnest(range(1, length(seq) - {K} + 2)) AS i FROM mates WHERE length(seq) >= {K})),
hits AS (SELECT read_id AS doc_id, taxid, count(*) AS hits FROM kmers JOIN idx USING (kmer) GROUP BY ALL),
{CALLS_SQL.removeprefix(HITS_SQL).lstrip(", ")}
SELECT run_id, sample_id, doc_id AS read_id, taxid, score FROM calls JOIN reads ON reads.read_id = doc_id""")
def q29_pairs(spark, sf_dir):
    hits = cl.kmer_match(st.reads(spark, sf_dir), _index(spark, sf_dir), K, seqs=("seq1", "seq2"))
    return cl.classify_reads(hits, _taxonomy(spark, sf_dir))


@query("q36_document_report", f"""WITH {CALLS_SQL},
placed AS (
  SELECT 'run' || (d.doc_id % 8) AS run_id, source AS sample_id, taxid FROM documents d LEFT JOIN calls c ON c.doc_id = d.doc_id),
nodes AS (
  SELECT run_id, sample_id, taxid AS leaf, {ROOT} AS taxid FROM placed WHERE taxid IS NOT NULL
  UNION ALL SELECT run_id, sample_id, taxid, CASE WHEN taxid >= {ITEM} THEN {GENUS} + (taxid - {ITEM}) % 5 ELSE taxid END FROM placed WHERE taxid <> {ROOT}
  UNION ALL SELECT run_id, sample_id, taxid, taxid FROM placed WHERE taxid >= {ITEM}),
clades AS (SELECT run_id, sample_id, taxid, count(*) AS clade, count(*) FILTER (leaf = taxid) AS direct FROM nodes GROUP BY ALL
  UNION ALL SELECT run_id, sample_id, 0, count(*), count(*) FROM placed WHERE taxid IS NULL GROUP BY ALL),
total AS (SELECT run_id, sample_id, count(*) AS total FROM placed GROUP BY ALL)
SELECT run_id, sample_id, CAST(taxid AS BIGINT) AS taxid, CASE WHEN taxid = 0 THEN 'U' WHEN taxid = {ROOT} THEN 'R' WHEN taxid >= {ITEM} THEN 'S' ELSE 'G' END AS rank_code,
  clade AS count_clade, direct AS count_taxon, CAST(printf('%.6f', clade * 100 / total) AS DOUBLE) AS percentage
FROM clades JOIN total USING (run_id, sample_id)""")
def q36(spark, sf_dir):
    documents = st.documents(spark, sf_dir).select(
        "doc_id", st.run_of("doc_id").alias("run_id"), F.col("source").alias("sample_id")
    )
    calls = documents.join(q29_classify(spark, sf_dir), "doc_id", "left").select("run_id", "sample_id", "taxid")
    report = cl.taxon_report(checkpointed(calls), _taxonomy(spark, sf_dir), digits=6)
    return report.select(
        "run_id", "sample_id", "taxid", "rank_code", "count_clade", "count_taxon", "percentage"
    )


REGION, NATION, SUPPLIER = 10, 100, 1000


@query("q30_taxon_report", f"""WITH calls AS (
  SELECT l_returnflag, CASE WHEN l_discount = 0 THEN NULL ELSE l_suppkey END AS s FROM lineitem),
up AS (
  SELECT l_returnflag, s, n_nationkey AS n, n_regionkey AS r FROM calls JOIN supplier ON s = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
nodes AS (
  SELECT l_returnflag, 1 AS taxid, 'R' AS rank_code, 0 AS direct, [CAST(1 AS BIGINT)] AS path, 'root' AS name FROM up
  UNION ALL SELECT l_returnflag, {REGION} + r, 'G', 0, [1, {REGION} + r], r_name FROM up JOIN region ON r = r_regionkey
  UNION ALL SELECT l_returnflag, {NATION} + n, 'G1', 0, [1, {REGION} + r, {NATION} + n], n_name FROM up JOIN nation ON n = n_nationkey
  UNION ALL SELECT l_returnflag, {SUPPLIER} + s, 'S', 1, [1, {REGION} + r, {NATION} + n, {SUPPLIER} + s], s_name FROM up JOIN supplier ON s = s_suppkey),
clades AS (SELECT l_returnflag, taxid, rank_code, path, name, count(*) AS clade, sum(direct) AS direct FROM nodes GROUP BY ALL),
routes AS (
  SELECT c.l_returnflag, c.taxid, list(struct_pack(a := -a.clade, b := a.taxid) ORDER BY len(a.path)) AS route
  FROM clades c JOIN clades a ON a.l_returnflag = c.l_returnflag AND list_contains(c.path, a.taxid) GROUP BY ALL),
lines AS (
  SELECT c.l_returnflag, c.taxid, rank_code, clade, direct, repeat('  ', len(path)) || name AS name, route
  FROM clades c JOIN routes r ON r.l_returnflag = c.l_returnflag AND r.taxid = c.taxid
  UNION ALL SELECT l_returnflag, 0, 'U', count(*), count(*), 'unclassified', NULL FROM calls WHERE s IS NULL GROUP BY l_returnflag)
SELECT 'r1' AS run_id, l_returnflag AS sample_id,
  CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY route NULLS FIRST) AS INTEGER) AS line_no,
  CAST(printf('%.2f', clade * 100 / (SELECT count(*) FROM calls k WHERE k.l_returnflag = lines.l_returnflag)) AS DOUBLE) AS percentage,
  CAST(clade AS BIGINT) AS count_clade, CAST(direct AS BIGINT) AS count_taxon, rank_code, CAST(taxid AS BIGINT) AS taxid, name FROM lines""")
def q30(spark, sf_dir):
    one = F.lit(1).cast("bigint")
    region = st.load(spark, sf_dir, "region").select((F.lit(REGION) + F.col("r_regionkey")).cast("bigint").alias("r"), "r_regionkey", "r_name")
    nation = st.load(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey")).withColumn(
        "n", (F.lit(NATION) + F.col("n_nationkey")).cast("bigint")
    )
    supplier = st.load(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).withColumn(
        "s", F.lit(SUPPLIER) + F.col("s_suppkey")
    )

    def taxa(rows, taxid, rank, name, *path):
        return rows.select(
            F.col(taxid).alias("taxid"), F.lit(rank).alias("rank_code"), F.col(name).alias("name"),
            F.array(one, *path).alias("path"),
        )

    root = region.agg(F.min(F.lit("root")).alias("name")).select(
        one.alias("taxid"), F.lit("R").alias("rank_code"), "name", F.array(one).alias("path")
    )
    taxonomy = (
        root.unionByName(taxa(region, "r", "G", "r_name", "r"))
        .unionByName(taxa(nation, "n", "G1", "n_name", "r", "n"))
        .unionByName(taxa(supplier, "s", "S", "s_name", "r", "n", "s"))
    )
    calls = st.load(spark, sf_dir, "lineitem").select(
        F.lit("r1").alias("run_id"), F.col("l_returnflag").alias("sample_id"),
        F.when(F.col("l_discount") != 0, F.lit(SUPPLIER) + F.col("l_suppkey")).alias("taxid"),
    )
    return cl.taxon_report(calls, taxonomy)
