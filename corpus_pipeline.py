"""The corpus pipeline: good documents, without toxic ones and near copies, mixed to target weights and packed.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last return the columns of
``documents``; the last returns one row per packed piece. The mix repeats documents, so ids may occur more than once after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from platewise.llm import mixing, neardup, packing, quality, toxicity
from platewise.llm.common import stored, table
from platewise.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents outside the quality fences of their language and source."""
    return quality.keep_good(docs)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the lexicon, learned from the labelled ones among them, scores as toxic."""
    return toxicity.drop_toxic(docs, toxicity.train_on(docs, table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates."""
    return neardup.drop_near_duplicates(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw the sources' documents to the target weights."""
    return mixing.draw(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and pack what is left into sequences."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("quality_rules", quality_rules), ("toxicity", without_toxic), ("minhash_neardup", without_near_copies),
    ("mixing", mixed_sources), ("best_fit_packing", packed),
]

#: Sketches, sampling hashes and token ids cannot be said in SQL. The test of the pipeline checks columns, that ids only become fewer and that
#: sequences hold what they may; the tests of the operators compare near copies, word counts, targets and placement with brute force. The ids
#: that each stage keeps are not compared stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
