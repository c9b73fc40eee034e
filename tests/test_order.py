"""Results depend neither on row order nor on the number of shuffle partitions."""

import pytest

from platewise.catalog import QUERIES, load_all, standins

load_all()
SF_DIR = "/root/testdata/sf0.001"
NAMES = [
    "q02_top_hits", "q03_species_calls", "q04b_first_present_key", "q05_qc_summary", "q06_fail_list", "q10_stage_readiness",
    "q11_missing_preview", "q12_resource_usage", "q22_subsample", "q28_latest_versions", "q30_taxon_report",
]


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_for_shuffled_input(spark, monkeypatch, name):
    expected = sorted(map(repr, QUERIES[name](spark, SF_DIR).collect()))
    load = standins.load
    monkeypatch.setattr(standins, "load", lambda spark, sf_dir, table: load(spark, sf_dir, table).repartition(3).sortWithinPartitions(
        load(spark, sf_dir, table).columns[-1], ascending=False
    ))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert sorted(map(repr, QUERIES[name](spark, SF_DIR).collect())) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
