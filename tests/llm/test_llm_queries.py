"""The registered queries against their SQL, and the pipeline's stages against its operators' rules."""

import os

import pytest
from oracle import connect, differences

import corpus_pipeline
from platewise.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = connect(SF_DIR)
    df = QUERIES[name](spark, SF_DIR)
    assert differences(df.collect(), df.columns, con.execute(ORACLES[name])) == []


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, ids = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), name)
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and now and (ids is None or now <= ids)
        ids = now
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r["doc_id"] for r in rows} == ids
    used = {}
    for r in rows:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= 2048
