"""Mix sources to target weights by Pareto order sampling.

Every source gets a target in words (``targets``): the whole size shared by weight, no source above ``max_copies`` times its
own size, the excess shared again among the others. A document of a source with rate ``r = target / size`` is expected
``e = r * v`` times, ``v`` being its preference divided by the source's mean (1 without a preference column), at most
``max_copies``. ``floor(e)`` copies are certain. What is left of the target is drawn without replacement: documents are ordered by

    Q = [u / (1 - u)] / [p / (1 - p)],   p = e - floor(e),

with ``u`` a uniform number from a hash of the seed and the document's id, and the first of them are taken until the source's
words are reached. The last one is taken if at least half of it still fits.

No source is sorted: the cut in the order of ``Q`` is found by two histograms of ``BINS`` cells each (sums per source and
cell, added up before the shuffle), and only documents of one cell of a cell are ranked one by one. The sources' table has
one row per source; it is broadcast only below a checked number of rows.

Nulls: a null text has no words, a null source is a source like any other and comes last, a null id is hashed as empty. Documents
without words are never taken. Rows that agree in id and text have the same ``Q`` and are taken together. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.llm.common import free_name, stored, word_count
from platewise.session import has_at_most

BINS = 512
MAX_BROADCAST_SOURCES = 100_000


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_copies: int = 3) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: weights repeat over the sources in code point order, null last.

    Sources that stop at ``max_copies`` times their size are those with the smallest size per weight: the table, one row
    per source, is ordered by that, and the share of the others follows from what is before them.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cap = F.col("source_size") * max_copies
    by_ratio = Window.orderBy((cap / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    shared = (
        sources.withColumn("weight", F.element_at(F.array(*(F.lit(w) for w in weights)), (turn % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("left_size", F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("free", (F.col("left_size") * F.col("weight")).cast("double") / F.col("left_weight") <= cap)
        .withColumn("any_before", F.max(F.col("free").cast("int")).over(by_ratio))
    )
    first = F.first(F.when(F.col("free"), F.struct("left_size", "left_weight")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = shared.withColumn("first_free", first)
    share = (F.col("first_free.left_size") * F.col("weight")).cast("double") / F.col("first_free.left_weight")
    target = F.when(F.col("any_before") == 1, share).otherwise(cap.cast("double"))
    return level.select(*sources.columns, target.alias("target"))


def uniform(doc_id: Column, seed: str) -> Column:
    """A number above 0 and below 1 from the first 52 bits of an md5."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)


def small(df: DataFrame, name: str) -> DataFrame:
    """A stored table of sources, with a broadcast hint if its number of rows is checked to be small."""
    kept = stored(df, name)
    return F.broadcast(kept) if has_at_most(kept, MAX_BROADCAST_SOURCES) else kept


def _expected(rows: DataFrame, wanted: DataFrame, max_copies: int) -> DataFrame:
    """Rows (key, size, u, v, ...) with certain copies, the ratio of odds ``q`` and its cells in the two histograms."""
    joined = rows.join(wanted, "key")
    e = F.least(F.lit(float(max_copies)), F.col("target") * F.col("v") / F.col("v_size"))
    e = F.when(F.col("v_size") > 0, e).otherwise(F.lit(0.0))
    p = F.col("e") - F.col("certain")
    place = F.col("q") / (1 + F.col("q")) * BINS
    return (
        joined.withColumn("e", e).withColumn("certain", F.floor("e"))
        .withColumn("q", F.when((p > 0) & (F.col("size") > 0), (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))))
        .withColumn("c1", F.floor(place)).withColumn("c2", F.floor((place - F.col("c1")) * BINS))
    )


def _reached(sums: DataFrame, cell: str, need: DataFrame) -> DataFrame:
    """Per key the cell in which the words needed are reached, and what is still needed when it begins."""
    order = Window.partitionBy("key").orderBy(cell)
    passed = sums.withColumn("upto", F.sum("words").over(order)).join(need, "key").filter(F.col("upto") > F.col("need"))
    first = passed.groupBy("key").agg(F.min(F.struct(cell, "upto", "words", "need")).alias("m"))
    return first.select("key", F.col(f"m.{cell}").alias(cell), (F.col("m.need") - F.col("m.upto") + F.col("m.words")).alias("need"))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (5, 2, 1),
    max_copies: int = 3, preference: str | None = None, seed: str = "mix", carry: tuple[str, ...] | None = None,
) -> tuple[DataFrame, str]:
    """``docs`` (or only its columns ``carry``) with a struct (size, source_size, target, copies, taken), and its name."""
    carry = tuple(docs.columns) if carry is None else carry
    name = free_name(docs.columns, "mix")
    prefer = F.greatest(F.coalesce(F.col(preference).cast("double"), F.lit(1.0)), F.lit(0.0)) if preference else F.lit(1.0)
    aux = F.struct(
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null")).alias("key"), F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"), uniform(F.col(doc_id), seed).alias("u"),
        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("tie"), prefer.alias("v"),
    )
    rows = stored(docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"), aux.alias("aux")), "mix-rows")
    slim = rows.select("aux.*")
    sources = slim.groupBy("key").agg(F.min("source").alias("source"), F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("v")).alias("v_size"))
    wanted = small(targets(stored(sources, "mix-sources"), weights, max_copies).drop("source"), "mix-targets")

    cells = _expected(slim, wanted, max_copies).select("key", "size", "tie", "certain", "q", "c1", "c2", "target")
    need = cells.groupBy("key").agg((F.first("target") - F.sum(F.col("size") * F.col("certain"))).alias("need"))
    drawn = cells.filter(F.col("q").isNotNull()).drop("target", "certain")
    cut1 = small(_reached(drawn.groupBy("key", "c1").agg(F.sum("size").alias("words")), "c1", need), "mix-cut1")
    cell = stored(drawn.join(cut1.drop("need"), ["key", "c1"]), "mix-cell")
    cut2 = small(_reached(cell.groupBy("key", "c2").agg(F.sum("size").alias("words")), "c2", cut1.drop("c1")), "mix-cut2")
    order = Window.partitionBy("key").orderBy("q", "tie").rowsBetween(Window.unboundedPreceding, -1)
    ranked = cell.join(cut2, ["key", "c2"]).withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
    fitting = ranked.filter(F.col("before") + F.col("size") / 2 <= F.col("need"))
    last = fitting.groupBy("key").agg(F.max(F.struct("q", "tie")).alias("last"))
    cuts = cut1.select("key", F.col("c1").alias("cut1")).join(cut2.select("key", F.col("c2").alias("cut2")), "key", "left").join(last, "key", "left")
    limits = small(wanted.join(cuts, "key", "left"), "mix-limits")

    result = _expected(rows.select("row", "aux.*").drop("source"), limits, max_copies)
    drawn_too = (
        F.when(F.col("q").isNull(), False).when(F.col("cut1").isNull(), True)
        .when(F.col("c1") != F.col("cut1"), F.col("c1") < F.col("cut1")).when(F.col("cut2").isNull(), True)
        .when(F.col("c2") != F.col("cut2"), F.col("c2") < F.col("cut2"))
        .otherwise(F.coalesce(F.struct("q", "tie") <= F.col("last"), F.lit(False)))
    )
    copies = F.when(F.col("size") > 0, F.col("certain") + drawn_too.cast("long")).otherwise(F.lit(0)).cast("long")
    out = F.struct("size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
    return result.select("row", out.alias("out")).select("row.*", F.col("out").alias(name)), name


def draw(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    mixed, name = mix(docs, **options)
    copy = free_name(mixed.columns, "copy")
    taken = mixed.filter(F.col(f"`{name}`.copies") > 0).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"`{name}`.copies"))))
    return taken.select(*(F.col(f"`{c}`") for c in docs.columns))
