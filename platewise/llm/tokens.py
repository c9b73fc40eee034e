"""Token ids of texts, and exact token counts for every context limit.

``TextEncoder`` encodes columns of whole texts with a byte-level BPE vocabulary file of the ``tokenizers`` library. The work is done by
``tiktoken`` with the ranks taken from that file: the same ids (the tests compare them with ``tokenizers``) in a fifth of the time. A
file whose ids do not follow its merges, for which this would not hold, is refused.

``length_histogram`` counts documents by encoded length, one row per group and length; ``context_table`` turns it by suffix sums
into the answers for every length that occurs, taken as the context limit: documents and tokens in total, documents that are longer,
tokens that are left if longer documents are cut there, and the share of documents that fit. Between two of these limits the number
of longer documents stays and the tokens left grow by that number with each unit; ``limit_table`` answers any limits that are asked for.
``with_quantiles`` marks the lengths that are quantiles.

Nulls: a null text has no tokens of its own, only the separator if one is asked for; a null group is a group. Repeated rows
count each time. An empty table gives an empty histogram. Input columns with other names are not looked at.
"""

from __future__ import annotations

import json
import sys
from array import array
from collections.abc import Iterable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platewise.llm.common import free_name, short_batches

TEXTS_PER_BATCH = 1024
#: Context limits that are answered even if no document has that length, and the quantiles that are marked.
LIMITS = (128, 256, 512, 1024, 2048, 4096, 8192, 16384, 32768)
SHARES = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0)
#: White space as the vocabulary's pattern sees it, and that pattern (fixed values).
SPACE = " \n\t\v\f\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def byte_symbols() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next free one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class TextEncoder:
    """Ids of whole texts with a byte-level BPE vocabulary file; special tokens' strings are ordinary text."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        before = described.get("pre_tokenizer") or {}
        if described.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        vocabulary = described["model"]["vocab"]
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in described["model"]["merges"]]
        ids = [vocabulary[m] for m in merges]
        if ids != sorted(set(ids)):
            raise ValueError(f"the ids of {path} are not in the order of its merges")
        special = {t["content"] for t in described.get("added_tokens", ())}
        symbols = {c: b for b, c in byte_symbols().items()}
        ranks = {bytes(symbols[c] for c in token): k for token, k in vocabulary.items() if token not in special}
        self.one = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column one after the other, and where each text's begin (one more entry than texts)."""
        found = [array("I", self.one(t)) if t else array("I") for t in texts.to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)]).astype(np.int64)
        return np.frombuffer(b"".join(found), np.uint32), offsets


def encoder(path: str) -> TextEncoder:
    """One encoder per worker process and file. The code comes anew with each task, so it is kept where the process keeps modules."""
    kept = vars(sys.modules.setdefault("platewise_encoders", ModuleType("platewise_encoders")))
    if path not in kept:
        kept[path] = TextEncoder(path)
    return kept[path]


def length_histogram(docs: DataFrame, vocabulary: str, by: Iterable[str] = (), text: str = "text", separator: bool = True) -> DataFrame:
    """Rows (group columns, length, n): exact number of documents per encoded length, one more for a separator if asked for."""
    short_batches(docs.sparkSession, TEXTS_PER_BATCH)
    by = list(by)
    groups = docs.select(*(F.col(f"`{c}`") for c in by)).schema
    schema = T.StructType([*groups.fields, T.StructField("length", T.LongType())])
    place, name = len(by), free_name(by, "text")

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in batches:
            _, offsets = own.encode(batch.column(place))
            columns = [*(batch.column(k) for k in range(place)), pa.array(np.diff(offsets) + separator)]
            yield pa.RecordBatch.from_arrays(columns, names=[*by, "length"])

    found = docs.select(*(F.col(f"`{c}`") for c in by), F.col(f"`{text}`").alias(name)).mapInArrow(lengths, schema)
    return found.groupBy(*by, "length").agg(F.count(F.lit(1)).alias("n"))


def context_table(histogram: DataFrame, by: Iterable[str] = (), cell: int = 64) -> DataFrame:
    """For every length that occurs, taken as the context limit: the totals and what a limit there does.

    Sums over all greater lengths are taken in two steps, inside cells of ``cell`` lengths and over the cells, so that no
    task sees more than ``cell`` rows of a group, or one row per cell.
    """
    by = list(by)
    rows = histogram.withColumn("tokens", F.col("length") * F.col("n")).withColumn("cell", F.floor(F.col("length") / cell))
    cells = rows.groupBy(*by, "cell").agg(F.sum("n").alias("cell_n"), F.sum("tokens").alias("cell_tokens"))
    later = Window.partitionBy(*by).orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*by)
    beyond = cells.select(
        *(F.col(c).alias(f"cell_{c}") for c in by), F.col("cell").alias("of_cell"),
        F.coalesce(F.sum("cell_n").over(later), F.lit(0)).alias("later_n"),
        F.coalesce(F.sum("cell_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("cell_n").over(every).alias("documents"), F.sum("cell_tokens").over(every).alias("total_tokens"),
    )
    same = F.col("cell") == F.col("of_cell")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"cell_{c}"))
    longer = Window.partitionBy(*by, "cell").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    found = (
        rows.withColumn("in_n", F.coalesce(F.sum("n").over(longer), F.lit(0)))
        .withColumn("in_tokens", F.coalesce(F.sum("tokens").over(longer), F.lit(0))).join(beyond, same)
        .withColumn("longer", F.col("in_n") + F.col("later_n")).withColumn("longer_tokens", F.col("in_tokens") + F.col("later_tokens"))
    )
    return found.select(
        *by, F.col("length").alias("context_limit"), F.col("n").alias("n_documents"), "documents", "total_tokens",
        F.col("longer").alias("n_longer"),
        (F.col("total_tokens") - F.col("longer_tokens") + F.col("longer") * F.col("length")).alias("truncated_tokens"),
        ((F.col("documents") - F.col("longer")) / F.col("documents")).alias("fitting_share"),
    )


def limit_table(histogram: DataFrame, limits: Iterable[int], by: Iterable[str] = ()) -> DataFrame:
    """The columns of ``context_table`` for every group and each of ``limits``, whether or not a document has that length."""
    by, asked = list(by), sorted({int(x) for x in limits})
    if asked and asked[0] < 0:
        raise ValueError("a context limit is not negative")
    rows = histogram.withColumn("context_limit", F.explode(F.array(*(F.lit(x) for x in asked)).cast("array<bigint>")))
    n, length, limit = F.col("n"), F.col("length"), F.col("context_limit")
    return rows.groupBy(*by, "context_limit").agg(
        F.sum(F.when(length == limit, n).otherwise(0)).alias("n_documents"), F.sum("n").alias("documents"), F.sum(length * n).alias("total_tokens"),
        F.sum(F.when(length > limit, n).otherwise(0)).alias("n_longer"), F.sum(F.least(length, limit) * n).alias("truncated_tokens"),
    ).withColumn("fitting_share", (F.col("documents") - F.col("n_longer")) / F.col("documents"))


def with_quantiles(table: DataFrame, shares: Iterable[float]) -> DataFrame:
    """A context table with one more column, the ``shares`` above 0 whose quantile (see ``quantile_lengths``) the row's limit is."""
    shorter = (F.col("documents") - F.col("n_longer") - F.col("n_documents")) / F.col("documents")
    wanted = F.array(*(F.lit(float(s)) for s in shares)).cast("array<double>")
    return table.withColumn("quantile_of", F.filter(wanted, lambda s: (s <= F.col("fitting_share")) & (s > shorter)))


def quantile_lengths(table: DataFrame, shares: Iterable[float], by: Iterable[str] = ()) -> DataFrame:
    """From a context table: per group and share, the smallest length that so many documents do not exceed."""
    wanted = F.explode(F.array(*(F.lit(float(s)) for s in shares)))
    rows = table.withColumn("share", wanted).filter(F.col("fitting_share") >= F.col("share"))
    return rows.groupBy(*by, "share").agg(F.min("context_limit").alias("length"))
