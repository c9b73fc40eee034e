import pytest

from platewise import schemas
from platewise.operators.summary import fastqc_fails
from platewise.plans.qc_summary import qc_summary, qc_summary_from_files
from platewise.sources.sinks import write_qc_summary


@pytest.fixture
def inputs(spark):
    def table(data, schema):
        return spark.createDataFrame(data, schema)

    samples = [("r1", 0, "S1"), ("r1", 1, "S2"), ("r1", 2, "S1"), ("r1", 3, "bare"), ("r1", 4, "S4")]
    return dict(
        samples=table(samples, schemas.SAMPLES),
        fastqc_general=table([("r1", "S1_processed_R1", 1000.9, 52.25, 148.35), ("r1", "S1_processed_R2", 7.0, 1.0, 1.0),
                              ("r2", "bare_processed_R1", 5.0, 5.0, 5.0)], schemas.FASTQC_GENERAL),
        trim_stats=table([("r1", "S1", 91.125), ("r1", "S2_processed_R1", 5.0)], schemas.TRIM_STATS),
        kraken_hits=table([
            ("r1", "S1.kraken", 0, "U", 12.25, "unclassified"), ("r1", "S1.kraken", 1, "G", 12.345, "Klebsiella"),
            ("r1", "S1.kraken", 2, "S", 30.0, "K. pneumoniae"), ("r1", "S1.kraken", 3, "G", 1.0, "Escherichia"),
            ("r1", "S2", 0, "S", 3.0, "metric species"), ("r1", "S4.kraken", None, None, None, None),
            ("r1", "S4", 0, "S", 3.0, "not used"),
        ], schemas.KRAKEN_HITS),
        fastqc_status=table([
            ("r1", "S1_processed_R1", "per_base_sequence_content", "fail"), ("r1", "S1_processed_R1", "b_module", "fail"),
            ("r1", "S1_processed_R2", "a_module", "fail"), ("r1", "S1_processed_R2", "b_module", "fail"),
            ("r1", "S1_processed_R2", "c_module", "warn"), ("r1", "S2_processed_R1", "per_base_sequence_content", "fail"),
            ("r1", "S4", "x", "fail"),
        ], schemas.FASTQC_STATUS),
        calls=table([("r1", "S1", "Renamed species", "573", "5600000"), ("r1", "S4", "Unknown", "NA", "NA"),
                     ("r1", "stale", "x", "1", "1")], schemas.SPECIES_CALLS),
    )


S1 = ("S1", 2000, 52.2, 148.3, 91.12, 12.2, "Klebsiella", 12.35, "Escherichia", 1.0, "Renamed species", 30.0, "N/A", 0.0,
      "a_module; b_module", "573", "5600000")


def _rows(df):
    return [tuple(r)[2:] for r in df.orderBy("sample_ord").collect()]


def test_summary_rows(inputs):
    summary = qc_summary(**inputs)
    assert summary.columns == ["run_id", "sample_ord", *schemas.QC_SUMMARY.names]
    assert [f.dataType for f in summary.schema.fields[2:]] == [f.dataType for f in schemas.QC_SUMMARY.fields]
    got = _rows(summary)
    expected_s1 = S1[:7] + (round(12.345, 2),) + S1[8:]
    assert got == [
        expected_s1,
        ("S2", 0, 0.0, 0.0, 0.0, 0.0, "N/A", 0.0, "N/A", 0.0, "metric species", 3.0, "N/A", 0.0, "", "NA", "NA"),
        expected_s1,
        ("bare", 0, 0.0, 0.0, 0.0, 0.0, "N/A", 0.0, "N/A", 0.0, "N/A", 0.0, "N/A", 0.0, "", "NA", "NA"),
        ("S4", 0, 0.0, 0.0, 0.0, 0.0, "N/A", 0.0, "N/A", 0.0, "Unknown", 0.0, "N/A", 0.0, "", "NA", "NA"),
    ]


def test_summary_does_not_depend_on_row_order(spark, inputs):
    expected = _rows(qc_summary(**inputs))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    for partitions in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        shuffled = {name: df.repartition(5) for name, df in inputs.items()}
        assert _rows(qc_summary(**shuffled)) == expected
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_duplicate_call_is_an_error(spark, inputs):
    calls = inputs["calls"]
    with pytest.raises(Exception, match="duplicate species call for sample r1/S1"):
        qc_summary(**{**inputs, "calls": calls.unionByName(calls.where("sample_id = 'S1'"))}).collect()


def test_fail_list_ignores_one_module(inputs, rows):
    assert rows(fastqc_fails(inputs["fastqc_status"])) == [("r1", "S1", "a_module; b_module")]


def test_summary_from_files(spark, inputs, tmp_path, write):
    write(f"{tmp_path}/r1/samples.tsv", "SAMPLE_ID\nS2\nS1\n")
    write(f"{tmp_path}/r1/multiqc/multiqc_data/multiqc_data.json", (
        '{"report_general_stats_data": [{}, {}, {"S1_processed_R1": {"total_sequences": 10, "percent_gc": 50, "avg_sequence_length": 100}}],'
        '"report_saved_raw_data": {"multiqc_kraken": {"S1": [{"rank_code": "S", "percent": 1.5, "classif": "x"}]},'
        '"multiqc_trimmomatic": {}, "multiqc_fastqc": {}}}'
    ))
    summary = qc_summary_from_files(
        spark, f"{tmp_path}/*/samples.tsv", f"{tmp_path}/*/multiqc/multiqc_data/multiqc_data.json", inputs["calls"]
    )
    got = [(r.Sample_ID, r.Total_Trimmed_Reads, r.Top_Species, r.Top_Species_PCT) for r in summary.orderBy("sample_ord").collect()]
    assert got == [("S2", 0, "N/A", 0.0), ("S1", 20, "Renamed species", 1.5)]
    write_qc_summary(summary, f"{tmp_path}/out")
    text = "".join(p.read_text() for p in sorted(tmp_path.glob("out/*.csv")))
    lines = [line for line in text.splitlines() if not line.startswith("Sample_ID")]
    assert text.startswith("\t".join(schemas.QC_SUMMARY.names))
    assert [line.split("\t")[0] for line in lines] == ["S2", "S1"]
    assert lines[0].split("\t")[14] == "" and len(lines[0].split("\t")) == 17
    write_qc_summary(summary, f"{tmp_path}/parquet", fmt="parquet")
    assert spark.read.parquet(f"{tmp_path}/parquet").where("run_id = 'r1'").count() == 2
