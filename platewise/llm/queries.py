"""The registered queries of these operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.llm import binary, chat, collocations, divergence, lattice, mixing, neardup, packing, private, quality, tokens, toxicity, urls
from platewise.llm.common import stored, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         (CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u,
         md5(coalesce(text, '')) AS tie
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM docs GROUP BY source),
filled AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER o, 0) AS left_size, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS left_w,
         row_number() OVER (ORDER BY 3 * source_size / w::DOUBLE, source ASC NULLS LAST) AS place
  FROM sources WINDOW o AS (ORDER BY 3 * source_size / w::DOUBLE, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT left_size, left_w, place AS first_free FROM filled WHERE (left_size * w)::DOUBLE / left_w <= 3 * source_size ORDER BY place LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN place >= first_free THEN (level.left_size * w)::DOUBLE / level.left_w ELSE (3 * source_size)::DOUBLE END AS target
  FROM filled, level),
expected AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN least(3.0::DOUBLE, target * 1.0::DOUBLE / source_size::DOUBLE) ELSE 0 END AS e
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
ordered AS (
  SELECT *, floor(e) AS certain, CASE WHEN e - floor(e) > 0 AND size > 0 THEN (u / (1 - u)) / ((e - floor(e)) / (1 - (e - floor(e)))) END AS q FROM expected),
need AS (SELECT *, target - sum(size * certain) OVER (PARTITION BY source) AS need FROM ordered),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY q, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM need WHERE q IS NOT NULL),
drawn AS (SELECT doc_id, tie, before + size / 2.0 <= need AS taken_again FROM placed)
SELECT n.doc_id, n.size, n.source_size, n.target, CAST(n.size * (n.certain + CASE WHEN d.taken_again THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM need n LEFT JOIN drawn d ON n.doc_id = d.doc_id AND n.tie = d.tie
"""


@query("op7_mixing", MIX_SQL)
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed, name = mixing.mix(docs, carry=("doc_id",))
    return mixed.select("doc_id", *(f"{name}.{c}" for c in ("size", "source_size", "target", "taken")))


QUALITY_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (SELECT r, i, w[i:i + 4] AS win FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM worded WHERE len(w) >= 5)),
starts AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM starts) GROUP BY r),
lines AS (SELECT r, line FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) AS all_lines, count(*) - count(DISTINCT line) AS again FROM lines GROUP BY r),
counted AS (
  SELECT d.r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(again, 0) AS BIGINT) AS n_dup_lines, coalesce(all_lines, 0) AS n_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(list_filter(w, lambda x: length(x) > 1 AND suffix(x, '!'))) AS n_shouts
  FROM worded d LEFT JOIN covered c USING (r) LEFT JOIN dup USING (r)),
base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted),
metrics AS (
  SELECT r, lang, source, base_failed, unnest([
    {'m': 0, 'v': CASE WHEN word_chars > 0 THEN n_symbols::DOUBLE / word_chars ELSE 0 END, 'least': 0.02, 'two': false},
    {'m': 1, 'v': CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END, 'least': 0.1, 'two': false},
    {'m': 2, 'v': CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END, 'least': 0.07, 'two': false},
    {'m': 3, 'v': CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0 END, 'least': 0.8, 'two': true},
    {'m': 4, 'v': CASE WHEN n_words > 0 THEN n_shouts::DOUBLE / n_words ELSE 0 END, 'least': 0.05, 'two': false}], recursive := true)
  FROM base),
cells AS (
  SELECT lvl, CASE WHEN lvl < 2 THEN lang END AS lang, CASE WHEN lvl < 1 THEN source END AS source, m, least, two,
         CASE WHEN v > 0 THEN ceil(ln(v) / ln(1.02)) END AS b, count(*) AS n
  FROM metrics, (VALUES (0), (1), (2)) AS x(lvl) WHERE NOT base_failed GROUP BY ALL),
upto AS (
  SELECT *, sum(n) OVER (PARTITION BY lvl, lang, source, m ORDER BY b NULLS FIRST) AS u, sum(n) OVER (PARTITION BY lvl, lang, source, m) AS total,
         coalesce(2 * pow(1.02, b) / 2.02, 0) AS mid FROM cells),
quart AS (
  SELECT lvl, lang, source, m, least, two, any_value(total) AS total, min(mid) FILTER (4 * u >= total) AS q1, min(mid) FILTER (4 * u >= 3 * total) AS q3
  FROM upto GROUP BY ALL),
fence AS (
  SELECT lvl, lang, source, m, total, q3 + 3.0 * greatest(q3 - q1, least) AS high, CASE WHEN two THEN q1 - 3.0 * greatest(q3 - q1, least) END AS low FROM quart),
chosen AS (
  SELECT r, bool_and(v <= f.high AND (f.low IS NULL OR v >= f.low)) AS inside
  FROM metrics x
  JOIN (SELECT lang, source, m, total FROM fence WHERE lvl = 0) a ON a.lang IS NOT DISTINCT FROM x.lang AND a.source IS NOT DISTINCT FROM x.source AND a.m = x.m
  JOIN (SELECT lang, m, total FROM fence WHERE lvl = 1) b ON b.lang IS NOT DISTINCT FROM x.lang AND b.m = x.m
  JOIN fence f ON f.m = x.m AND f.lvl = CASE WHEN a.total >= 200 THEN 0 WHEN b.total >= 200 THEN 1 ELSE 2 END
    AND (f.lvl = 2 OR f.lang IS NOT DISTINCT FROM x.lang) AND (f.lvl > 0 OR f.source IS NOT DISTINCT FROM x.source)
  GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(inside, false) AS kept
FROM base LEFT JOIN chosen USING (r)
"""


@query("op8_quality_rules", QUALITY_SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured, column = quality.measure(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    judged, kept = quality.judge(stored(measured.drop("text"), "quality-measured"), column)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return judged.select("doc_id", *(f"{column}.{c}" for c in counts), F.col(kept).alias("kept"))


URL_RULES = (
    urls.Rule("net", "/", "block"), urls.Rule("example.net", "/en/", "allow"), urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
)


@query("op10_url_filter")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = urls.train(urls.labelled_table(spark))
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), model, URL_RULES)
    return judged.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict", "judged.score")


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, 24 + length(role) + len(regexp_extract_all(role, '[\\<\[\n]')) + length(text) + len(regexp_extract_all(text, '[\\<\[]')) AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query("op1_chat_format", CHAT_SQL)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    records = rows.select("conv_id", F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    formatted = chat.format_turns(chat.canonical_turns(records))
    back = formatted.select("conv_id", "formatted", chat.read_back(F.col("formatted"), F.col("mask")).alias("back"))
    turns = F.array_join(F.transform("back.turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("back.learned", "")
    return back.select(
        "conv_id", F.size("back.turns").cast("long").alias("n_turns"), F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def vocabulary() -> str:
    """The production vocabulary: byte-level BPE with 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = stored(tokens.length_histogram(table(spark, sf_dir, "documents"), vocabulary(), by=["source"]), "token-lengths")
    whole = histogram.groupBy("length").agg(F.sum("n").alias("n"))

    def answers(rows: DataFrame, by: list[str]) -> DataFrame:
        # A standard limit that some document has as its length is in the context table already.
        others = tokens.limit_table(rows, tokens.LIMITS, by).filter("n_documents = 0")
        return tokens.with_quantiles(tokens.context_table(rows, by).unionByName(others), tokens.SHARES)

    corpus = answers(whole, []).withColumn("scope", F.lit("corpus")).withColumn("source", F.lit(None).cast("string"))
    return corpus.unionByName(answers(histogram, ["source"]).withColumn("scope", F.lit("source")))


@query("op9_token_binary")
def op9_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = stored(binary.pack_shards(table(spark, sf_dir, "documents"), vocabulary()), "token-shards")
    return binary.read_segments(shards)


@query("op3_minhash_neardup")
def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


@query("op5_embedding_neardup")
def op5_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lattice.near_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train_on(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


DIVERGENCE_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
found AS (
  SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM found GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
langs AS (SELECT lang, CAST(sum(lang_n) AS HUGEINT) AS total, CAST(count(*) AS HUGEINT) AS v FROM kept GROUP BY lang),
used AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT lang, source, CAST(coalesce(any_value(t.total), 0) AS HUGEINT) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM used GROUP BY ALL) t USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n, 1 + (1000000000 * CAST(coalesce(u.n, 0) + 5 AS HUGEINT)) // (g.total + 5 * l.v) AS p,
         1 + (1000000000 * CAST(k.lang_n + 5 AS HUGEINT)) // (l.total + 5 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN used u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN apart a ON a.lang = g.lang AND a.source = g.source AND a.item = h.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)) WHERE part = 'pair' OR rank <= 50
"""


@query("op12_source_divergence", DIVERGENCE_SQL)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


COLLOCATION_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
worded AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs)),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT lang, w, m, unnest(range(1, CAST(len(w) AS BIGINT) - m + 2)) AS i FROM worded, (VALUES (1), (2), (3)) AS x(m))),
f AS (SELECT lang, m, g, CAST(count(*) AS HUGEINT) AS n FROM grams GROUP BY ALL),
total AS (SELECT lang, count(*) AS n FROM grams WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, g, n AS a, string_split(g, ' ') AS w FROM f WHERE m > 1 AND n >= 10),
cuts AS (
  SELECT c.lang, c.m, c.g, c.a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:m], ' ') AS rest
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand) c),
scored AS (
  SELECT cuts.lang, cuts.m, cuts.g, a, k, x.n AS l, y.n AS r, (1000000 * a * a) // (x.n * y.n) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = first JOIN f y ON y.lang = cuts.lang AND y.g = rest),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (
  SELECT lang, s AS g, max(a) AS longer
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS s FROM cand WHERE m = 3) GROUP BY ALL),
ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.g) AS rank
  FROM worst w LEFT JOIN inside i ON i.lang = w.lang AND i.g = w.g WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, g AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, total.n AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@query("op13_collocations", COLLOCATION_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op11_personal_data")
def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, name = private.find_private(docs, private.train(docs))
    base = F.filter(name, lambda s: s["base"])
    counts = [F.size(private.of_kind(base, kind)).cast("long").alias(f"n_{kind}") for kind in private.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(private.joined(base).cast("binary"), 256).alias("base_sha256"), private.joined(F.col(name)).alias("spans"))
