"""Source divergence audit: how far the term distributions of a language's sources lie apart, in exact integers.

1. Tokens. One ``bytes.translate`` lowers the letters A-Z and blanks every other ASCII character, ``bytes.split`` cuts the terms, a
   ``Counter`` per document gives their frequencies, its keys the document counts. UTF-8 bytes beyond ASCII are letters, so nothing is decoded.
   A long text is translated slice by slice, cut at blanks. A task adds the documents up per (lang, source) and passes the sums on
   whenever it holds ``HELD`` of them.
2. Kept terms of a language occur in at least ``least`` of its documents. A group (lang, source) gives a kept term the share
   ``p = 1 + floor(UNIT * (count + ADD) / (N + ADD * V))``, N being its occurrences of the V kept terms; the language gives ``q`` alike.
3. ``pair``: the sum of ``abs(p - q)`` over all kept terms for every two sources of a language. Only terms that occur travel: sources are dealt
   to blocks of about ``BLOCK``, terms to cells of about ``CELL``; two blocks meet cell by cell in a small matrix that is filled with
   the share of absent terms. A task adds up its cells before it passes a pair of blocks on, and terms that neither block has are
   multiplied out at the end.
4. ``term``: the terms that a group uses more than its language does, by ``p - q``, only ranks to ``top``.

Nulls of text, lang and source are read as ''. Every (lang, source) that occurs is a group, with empty texts and without kept terms
too; a language with one source has no pairs, one without kept terms only pairs of value 0. Repeated rows count each time. Ties rank by item in
the order of UTF-8 bytes. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.llm.common import short_batches, sorted_groups, stored
from platewise.session import broadcast_if_small

LEAST, TOP, UNIT, ADD = 30, 50, 1_000_000_000, 5
#: Sums a task holds, bytes of a slice of a text, terms of a cell and sources of a block.
HELD, SLICE, CELL, BLOCK = 300_000, 1 << 20, 1024, 256
#: Letters A-Z lowered, a-z and bytes beyond ASCII kept, anything else blank.
TRANSLATE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def slices(data: bytes, size: int = SLICE) -> Iterator[bytes]:
    """The translated text in slices that end at a blank, or at the end of a term longer than a slice."""
    at = 0
    while at < len(data):
        piece = data[at:at + size].translate(TRANSLATE)
        end = len(piece)
        if at + end < len(data):
            end = piece.rfind(b" ") + 1
            if not end:  # one term fills the slice: take all of it
                parts = [piece]
                while parts[-1] and b" " not in parts[-1]:
                    at += len(parts[-1])
                    parts.append(data[at:at + size].translate(TRANSLATE))
                stop = parts[-1].find(b" ") + 1
                at += stop or len(parts[-1])
                yield b"".join([*parts[:-1], parts[-1][:stop or None]])
                continue
        at += end
        yield piece[:end]


def term_counter(data: bytes) -> Counter:
    """Occurrences of the terms of one document."""
    found: Counter = Counter()
    for piece in slices(data):
        found.update(piece.split())
    return found


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Rows (lang, source, term, n, docs): occurrences and documents; a row with the term '' for every group, whatever its texts hold."""
    short_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        size = 0

        def out() -> pa.RecordBatch:
            rows = [(a, b, t, n, seen[t]) for (a, b), (sums, seen) in held.items() for t, n in sums.items()]
            columns = list(zip(*rows))
            types = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "source", "bytes", "n", "docs"])

        for batch in batches:
            for a, b, data in zip(*(batch.column(k).to_pylist() for k in range(2)), batch.column(2)):
                group = held.get((a, b))
                if group is None:
                    group = held[a, b] = (Counter({b"": 0}), Counter())
                    size += 1
                one = term_counter(data.as_buffer().to_pybytes())
                before = len(group[0])
                group[0].update(one)
                group[1].update(one.keys())
                size += len(group[0]) - before
                if size >= HELD:
                    yield out()
                    held.clear()
                    size = 0
        if held:
            yield out()

    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))
    counted = rows.mapInArrow(count, "lang string, source string, bytes binary, n bigint, docs bigint")
    summed = counted.groupBy("lang", "source", "bytes").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return summed.select("lang", "source", F.col("bytes").cast("string").alias("term"), "n", "docs")


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(UNIT * (count + ADD) / (total + ADD * terms))``, exactly; null without terms."""
    def wide(c: Column) -> Column:
        return c.cast("decimal(19,0)")

    above = F.lit(UNIT).cast("decimal(10,0)") * wide(count + ADD)
    below = wide(total + ADD * terms)
    return F.when(below > 0, F.call_function("div", above, below) + 1)


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of absolute differences for two blocks, over the terms of the cells of this task.

    Rows are sorted by (lang, low, high, cell). A row without a term says what a source's absent terms weigh.
    """
    key, names, place, total, columns = None, None, None, None, 0

    def out() -> pa.RecordBatch:
        i, j = np.meshgrid(np.arange(len(names[0])), np.arange(len(names[1])), indexing="ij")
        # Two sources of one block meet once, those of two blocks always.
        own = (i < j).ravel() if key[1] == key[2] else np.ones(i.size, bool)
        a, b = pa.array(names[0]).take(pa.array(i.ravel()[own])), pa.array(names[1]).take(pa.array(j.ravel()[own]))
        n = int(own.sum())
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * n, pa.string()), a, b, pa.array(total.ravel()[own]), pa.array(np.full(n, columns, np.int64))],
            names=["lang", "a", "b", "apart", "terms"])

    for rows in sorted_groups(batches, ("lang", "low", "high", "cell")):
        lang, low, high = rows.column("lang")[0].as_py(), rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        term = rows.column("term").combine_chunks().dictionary_encode()
        absent = rows.column("term").is_null().to_numpy()
        source, block, p = (rows.column(c).to_numpy() for c in ("source", "block", "p"))
        if (lang, low, high) != key:
            if key is not None and min(map(len, names)):
                yield out()
            key = lang, low, high
            names = [sorted(set(source[absent & (block == k)])) for k in (low, high)]
            place = [{s: i for i, s in enumerate(x)} for x in names]
            total, columns = np.zeros((len(names[0]), len(names[1])), np.int64), 0
        width = len(term.dictionary)
        matrices = []
        for k, at in zip((low, high), place):
            base = np.zeros(len(at), np.int64)
            mine = block == k
            row = np.array([at[s] for s in source[mine]], np.int64)
            gone = absent[mine]
            base[row[gone]] = p[mine][gone]
            matrix = np.repeat(base[:, None], width, 1)
            code = term.indices.fill_null(0).to_numpy()[mine]
            matrix[row[~gone], code[~gone]] = p[mine][~gone]
            matrices.append(matrix)
        for i, line in enumerate(matrices[0]):
            total[i] += np.abs(matrices[1] - line).sum(1)
        columns += width
    if key is not None and min(map(len, names)):
        yield out()


def source_pairs(shares: DataFrame, groups: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows (lang, source, item, value) for every two sources of a language, both ways."""
    size = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.ceil(F.max("terms") / CELL).cast("int").alias("cells"))
    size = broadcast_if_small(size)
    block = F.pmod(F.xxhash64("source", F.lit(11)), F.col("blocks").cast("long")).cast("int")
    cell = F.pmod(F.xxhash64("term", F.lit(13)), F.col("cells").cast("long")).cast("int")
    there = shares.join(size, "lang").select("lang", "source", block.alias("block"), "blocks", cell.alias("cell"), "term", "p")
    cells = kept.join(size, "lang").select("lang", cell.alias("cell")).distinct()
    absent = groups.join(size, "lang").select("lang", "source", block.alias("block"), "blocks", F.col("absent").alias("p")).join(cells, "lang")
    rows = there.unionByName(absent.withColumn("term", F.lit(None).cast("string")))
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "lang", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "cell", "block", "source", "term", "p")
    group = ["lang", "low", "high", "cell"]
    parts = dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(_block_sums, "lang string, a string, b string, apart bigint, terms bigint")
    # The two sources of a pair may have met as (a, b) or (b, a): order them.
    sums = parts.groupBy("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("apart").alias("apart"), F.sum("terms").alias("met"))
    one = groups.select("lang", F.col("source").alias("a"), F.col("absent").alias("absent_a"), F.col("terms").alias("all_terms"))
    two = groups.select(F.col("lang").alias("lang_b"), F.col("source").alias("b"), F.col("absent").alias("absent_b"))
    pairs = one.join(two, (F.col("lang") == F.col("lang_b")) & (F.col("a") < F.col("b"))).drop("lang_b").join(sums, ["lang", "a", "b"], "left")
    neither = (F.col("all_terms") - F.coalesce("met", F.lit(0))) * F.abs(F.col("absent_a") - F.col("absent_b"))
    value = F.coalesce(F.coalesce("apart", F.lit(0)) + neither, F.lit(0)).cast("long")
    both = pairs.select("lang", value.alias("value"), F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"))
    return both.select("lang", "x.source", "x.item", "value")


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): every two sources' distance, and each group's ``top`` own terms."""
    counts = stored(term_counts(docs, text, lang, source), "divergence-counts")
    real = counts.filter("term != ''")
    kept = real.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("df")).filter(F.col("df") >= least)
    kept = stored(kept.select("lang", "term", "lang_n"), "divergence-terms")
    used = stored(real.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "divergence-kept")
    langs = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"))
    groups = broadcast_if_small(groups.withColumn("absent", share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))))
    shares = used.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"))
    shares = stored(shares, "divergence-shares")

    order = (F.col("value").desc(), F.col("item").asc())
    pairs = source_pairs(shares.select("lang", "source", "term", "p"), groups, kept)
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    terms = shares.filter(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))).filter(F.col("rank") <= top)
    both = pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
    return both.select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")
