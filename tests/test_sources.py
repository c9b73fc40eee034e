import datetime as dt
import gzip
import random

import pytest
from pyspark.sql import functions as F

from platewise.operators.accounting import is_empty_or_header_only
from platewise.sources import artifacts as art
from platewise.sources import sinks, text
from platewise.operators.taxa import first_or_last_wins
from platewise.sources.fastq import read_fastq_pairs, write_fastq_pairs
from platewise.sources.multiqc import read_multiqc_json
from platewise.sources.sinks import write_top_hits

REPORT = (
    " 10.00\t100\t100\tU\t0\tunclassified\n 90.00\t900\t0\tR\t1\troot\n 50.00\t500\t10\tG\t570\t      Klebsiella\r\n"
    "short\tline\n 30.00\t300\t300\tS\t573\t        Klebsiella pneumoniae\n\n 0.10\t1\t1\tG1\t999\t      no\textra\n"
)


def test_lines_keep_file_order_across_splits(spark, tmp_path, write):
    for name in ("a", "b"):
        write(f"{tmp_path}/{name}.txt", "".join(f"{i}\n" for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        lines = text.ordered_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 10
        got = lines.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for name in ("a", "b"):
        mine = sorted((r.line_no, int(r.value)) for r in got if r.path.endswith(f"{name}.txt"))
        assert [v for _, v in mine] == list(range(5000))
        assert len({n for n, _ in mine}) == 5000


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    kept = {}

    def put(**values):
        for key, value in values.items():
            key = f"spark.sql.files.{key}"
            kept.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in kept.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("chosen", [
    {"maxPartitionBytes": "100"}, {"maxPartitionBytes": "1000", "openCostInBytes": "0"}, {"maxPartitionBytes": "300", "maxPartitionNum": "2"},
    {"maxPartitionBytes": "10000000", "openCostInBytes": "0", "maxPartitionNum": "1"},
])
def test_line_numbers_are_dense(spark, tmp_path, write, settings, chosen):
    """Numbers from 0 without gaps, whatever the splits are and however many of them a task reads."""
    draw = random.Random(1)
    files = {f"{k}.txt": [("x" * draw.randrange(80)) + str(i) for i in range(draw.choice([0, 1, 40, 300]))] for k in range(9)}
    for name, lines in files.items():
        write(f"{tmp_path}/{name}", "".join(f"{line}{draw.choice(['', chr(13)])}\n" for line in lines)[:None if lines else 0])
    settings(**chosen)
    lines = text.ordered_lines(spark, str(tmp_path))
    got = {}
    for r in lines.collect():
        got.setdefault(r.path.rsplit("/")[-1], []).append((r.line_no, r.value.rstrip("\r")))
    assert {k: sorted(v) for k, v in got.items()} == {k: list(enumerate(v)) for k, v in files.items() if v}


def test_settings_changed_between_the_passes(spark, tmp_path, write, settings):
    write(f"{tmp_path}/a.txt", "".join(f"{i}\n" for i in range(2000)))
    settings(maxPartitionBytes="900")
    lines = text.ordered_lines(spark, str(tmp_path))
    settings(maxPartitionBytes="500")
    with pytest.raises(Exception, match="changed while lines were numbered"):
        lines.collect()


def test_sheet_order_counts_every_row(spark, tmp_path, write, rows, settings):
    write(f"{tmp_path}/run1/s.tsv", "path\tSAMPLE_ID\tsample_id2\n" + "".join(f"p\t{'' if i % 5 == 0 else i}\tx\n" for i in range(200)))
    settings(maxPartitionBytes="64")
    sheet = text.read_samples(spark, f"{tmp_path}/*/s.tsv")
    assert sheet.columns == ["run_id", "sample_ord", "sample_id"]
    assert rows(sheet, "sample_ord", "sample_id") == sorted((i, str(i)) for i in range(200) if i % 5)


def test_sample_sheet_rules(spark, tmp_path, write):
    write(f"{tmp_path}/run1/samples.tsv", "other\tSAMPLE_ID\nx\t007\ny\tNA\nz\t\nw\tS1\nv\tS1\nu\tS10\n\nt\tfailed_ctrl\n")
    sheet = text.read_samples(spark, f"{tmp_path}/*/samples.tsv")
    got = [(r.run_id, r.sample_id) for r in sheet.orderBy("sample_ord").collect()]
    assert got == [("run1", s) for s in ["007", "NA", "S1", "S1", "S10", "failed_ctrl"]]


def test_sample_sheet_errors(spark, tmp_path, write):
    path = write(f"{tmp_path}/r/a.tsv", "ID\tx\n1\t2\n")
    with pytest.raises(ValueError, match="'SAMPLE_ID' not found.*Available columns: ID, x"):
        text.read_samples(spark, path)
    assert text.read_samples(spark, path, id_column="ID").first().sample_id == "1"
    with pytest.raises(ValueError, match="No sample IDs"):
        text.read_samples(spark, write(f"{tmp_path}/r/b.tsv", "SAMPLE_ID\n"))


def test_report_lines(spark, tmp_path, write):
    write(f"{tmp_path}/r1/kraken2/S1/S1.kraken.report.txt", REPORT)
    write(f"{tmp_path}/r1/kraken2/S2/S2.kraken.report.txt", "")
    lines = text.read_report_lines(spark, f"{tmp_path}/*/kraken2/*/*.kraken.report.txt")
    got = [(r.run_id, r.sample_id, r.percentage, r.rank_code, r.taxid, r.name) for r in lines.orderBy("line_no").collect()]
    assert got == [
        ("r1", "S1", "10.00", "U", "0", "unclassified"), ("r1", "S1", "90.00", "R", "1", "root"),
        ("r1", "S1", "50.00", "G", "570", "      Klebsiella"),
        ("r1", "S1", "30.00", "S", "573", "        Klebsiella pneumoniae"), ("r1", "S1", "0.10", "G1", "999", "      no"),
    ]


def test_lookup_tables(spark, tmp_path, write, rows):
    sizes = write(f"{tmp_path}/sizes.tsv", "species\ttaxid\tgenome_size\nA\t1\t10\nA\t1\t20\nB\t2\n[C] d\t3\t30\textra\n")
    got = text.read_genome_sizes(spark, sizes)
    assert rows(got, "species", "genome_size") == [("A", "10"), ("A", "20"), ("[C] d", "30")]
    assert got.orderBy("line_no").first().genome_size == "10"
    renames = write(f"{tmp_path}/renames.tsv", "old_name\tnew_name\na\tb\n")
    assert rows(text.read_renames(spark, renames), "old_name", "new_name") == [("a", "b")]
    assert text.read_renames(spark, f"{tmp_path}/none.tsv").count() == 0
    assert text.read_renames(spark, None).count() == 0
    # the first line of either file has the same number: the files' paths decide
    two = [write(f"{tmp_path}/sizes_{k}.tsv", f"species\ttaxid\tgenome_size\nA\t1\t{k}\n") for k in (9, 3, 5)]
    several = text.read_genome_sizes(spark, two)
    for keep, size in (("first", "3"), ("last", "9")):
        assert rows(first_or_last_wins(several, "species", "genome_size", keep)) == [("A", size)]


def test_species_files_are_merged(spark, tmp_path, write, rows):
    head = "Sample_ID\tTop_Species\tTaxID\tExpected_Genome_Size\n"
    write(f"{tmp_path}/r1/kraken2/S1/S1.species.tsv", head + "S1\tEscherichia coli\t562\t5150000\n")
    write(f"{tmp_path}/r1/kraken2/S2/S2.species.tsv", head + "S2\tUnknown\tNA\tNA\n")
    got = text.merge_species_calls(spark, f"{tmp_path}/*/kraken2/*/*.species.tsv")
    assert rows(got) == [("r1", "S1", "Escherichia coli", "562", "5150000"), ("r1", "S2", "Unknown", "NA", "NA")]


def test_resource_reports(spark, tmp_path, write):
    full = (
        "\tCommand being timed: \"x\"\n\tUser time (seconds): 12.5\n\tSystem time (seconds): 2.5\n"
        "\tElapsed (wall clock) time (h:mm:ss or m:ss): 0:10.00\n\tMaximum resident set size (kbytes): 1048576\n"
    )
    write(f"{tmp_path}/r1/trim/S1.time.txt", full)
    write(f"{tmp_path}/r1/trim/S2.time.txt", "\tElapsed (wall clock) time (h:mm:ss or m:ss): 0:00.00\n\tUser time (seconds): 1\n")
    got = {r.sample_id: r for r in text.read_resource_reports(spark, f"{tmp_path}/*/*/*.time.txt").collect()}
    assert (got["S1"].peak_memory_gb, got["S1"].cpu_cores, got["S1"].user_s, got["S1"].tool) == (1.0, 1.5, 12.5, "trim")
    assert (got["S2"].peak_memory_gb, got["S2"].cpu_cores, got["S2"].user_s) == (0.0, 0.0, 1.0)


def test_status_log(spark, tmp_path, write):
    log = (
        "=== Running trim ===\nRunner: S1: Starting\nRunner: S1: Completed (runtime: 1h 2m 3.5s)\nRunner: failed_ctrl: Completed (runtime: 3.5 seconds)\n"
        "Runner: ✅ S2 skipped (output exists: /o/S2)\nRunner: S3: ERROR: missing input file /i/S3\n"
        "Runner: S4: Allowed failure (exit code 1)\nRunner: S5: Failed with exit code 2\nRunner: S6: Failed - no disk: 5\n"
    )
    write(f"{tmp_path}/r1/run.log", log)
    got = text.read_status_log(spark, f"{tmp_path}/*/run.log", prefix="Runner: ").orderBy("line_no").collect()
    assert [(r.run_id, r.sample_id, r.event, r.status, r.exit_code, r.runtime_s) for r in got] == [
        ("r1", "S1", "starting", "starting", None, None), ("r1", "S1", "completed", "completed", 0, 3723.5),
        ("r1", "failed_ctrl", "completed", "completed", 0, 3.5), ("r1", "S2", "skipped", "skipped", None, None),
        ("r1", "S3", "missing_input", "skipped_missing_input", None, None),
        ("r1", "S4", "allowed_failure", "allowed_failure", 1, None), ("r1", "S5", "failed", "failed", 2, None),
        ("r1", "S6", "exception", "failed", None, None),
    ]
    assert got[-1].detail == "no disk: 5"


def test_artifacts_and_discovery(spark, tmp_path, write, rows):
    for name in ("S1_R1", "S1_R2", "S10_L001_R1", "S 2+_R1"):
        write(f"{tmp_path}/in/{name}.fastq.gz", "x\ny\n")
    write(f"{tmp_path}/in/empty.tsv", "")
    write(f"{tmp_path}/in/head.tsv", "only\n")
    found = art.list_artifacts(spark, str(tmp_path))
    assert found.columns == ["path", "length"] and found.count() == 6
    assert rows(art.discover_samples(found), "sample_id") == [("S 2+",), ("S1",), ("S10",)]
    assert rows(art.lane_files(found), "sample_id", "lane", "mate") == [
        ("S 2+", "", "R1"), ("S1", "", "R1"), ("S1", "", "R2"), ("S10", "L001", "R1")
    ]
    lines = text.ordered_lines(spark, f"{tmp_path}/in", pathGlobFilter="*.tsv")
    flags = is_empty_or_header_only(lines, found.where(F.col("path").endswith(".tsv")))
    assert [(r.path.rsplit("/")[-1], r.n_lines, r.header_only) for r in flags.orderBy("path").collect()] == [
        ("empty.tsv", 0, True), ("head.tsv", 1, True)
    ]


def test_listing_goes_down_level_by_level(spark, tmp_path, write, rows, monkeypatch):
    """A lopsided tree, all of it below one folder, some levels with many entries, empty folders; batches are bounded."""
    monkeypatch.setattr(art, "LISTED", 3)
    wanted = []
    folder = f"{tmp_path}/in/top"
    for depth in range(5):
        folder += f"/level{depth}"
        for k in range(depth * 3):
            wanted.append((write(f"{folder}/side{k}/f{k}.txt", "x" * k), k))
            wanted.append((write(f"{folder}/g{k}.csv", ""), 0))
    (tmp_path / "in" / "empty" / "deeper").mkdir(parents=True)
    assert rows(art.list_artifacts(spark, f"{tmp_path}/in")) == sorted(wanted)
    assert rows(art.list_artifacts(spark, [f"{tmp_path}/in/top", f"{tmp_path}/in/empty"], glob="*.csv")) == sorted(w for w in wanted if w[0].endswith("csv"))


def test_appends_can_be_repeated(spark, tmp_path, rows):
    """A batch that is written again under its name replaces itself; other batches and runs stay, and nameless ones add up."""
    schema = "run_id string, ts timestamp, tool string, sub_tool string, version string, path string, database string"

    def log(*tools):
        return spark.createDataFrame([("r" + t[-1], dt.datetime(2025, 1, 1), t, None, "1", "/p", "db") for t in tools], schema)

    path = f"{tmp_path}/log"
    for table, batch in ((log("a1", "b2"), "a"), (log("a1", "b2").repartition(3), "a"), (log("c1"), None), (log("c1"), None), (log("d1"), "x"), (log("e1"), "x"), (log("f2"), "x")):
        sinks.append_versions(table, path, batch)
    assert [r[0] for r in rows(sinks.read_versions(spark, path), "tool")] == ["a1", "b2", "c1", "c1", "e1", "f2"]
    assert sinks.read_versions(spark, path).columns == schema.replace(" string", "").replace(" timestamp", "").split(", ")


def test_metrics_report(spark, tmp_path, write, rows):
    doc = (
        '{"report_general_stats_data": [{}, {}, {"S1_processed_R1": {"total_sequences": 1234.0, "percent_gc": "52.25"}}],\n'
        ' "report_saved_raw_data": {"multiqc_kraken": {"S1.kraken": [], "S1": [{"rank_code": "G", "percent": 50, "classif": "K", "more": 1}]},'
        ' "multiqc_trimmomatic": {"S1": {"surviving_pct": 91.125, "input": 5}},'
        ' "multiqc_fastqc": {"S1_processed_R1": {"Filename": "f", "basic_statistics": "pass"}}}, "other": [1]}'
    )
    write(f"{tmp_path}/r1/multiqc/multiqc_data/multiqc_data.json", doc)
    tables = read_multiqc_json(spark, f"{tmp_path}/*/multiqc/multiqc_data/multiqc_data.json")
    assert rows(tables["fastqc_general"]) == [("r1", "S1_processed_R1", 1234.0, 52.25, None)]
    assert rows(tables["kraken_hits"]) == [("r1", "S1", 0, "G", 50.0, "K"), ("r1", "S1.kraken", None, None, None, None)]
    assert rows(tables["trim_stats"]) == [("r1", "S1", 91.125)]
    assert ("r1", "S1_processed_R1", "basic_statistics", "pass") in rows(tables["fastqc_status"])


def test_metrics_reports_of_a_run_are_bounded(spark, tmp_path, rows, monkeypatch):
    """A run of many events has several report files, each of bounded size, and the rows of all; a run that is null keeps its own."""
    from platewise.catalog import summary

    data = [(n, None if n % 50 == 0 else n % 2, "view", f'{{"k": {n % 7}}}') for n in range(900)]
    spark.createDataFrame(data, "event_id long, user_id long, event_type string, props string").write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(summary, "JSON_ENTRIES", 50)
    monkeypatch.setattr(summary, "shared_path", lambda spark, name: f"{tmp_path}/{name}")
    found = summary._json_tables(spark, str(tmp_path))["trim_stats"]
    assert [tuple(r) for r in rows(found, "metric_key", "surviving_pct")] == sorted((f"e{n}", float(n % 7)) for n in range(900))
    files = list(tmp_path.glob("metrics/run_id=run1/*/*.txt"))
    assert len(files) == 9 and max(f.read_text().count("surviving_pct") for f in files) <= 100
    assert {r["run_id"] for r in found.collect()} == {"run0", "run1", "__HIVE_DEFAULT_PARTITION__"}


def test_metrics_report_without_a_section(spark, tmp_path, write):
    write(f"{tmp_path}/r1/a/b/m.json", '{"report_general_stats_data": [{}], "report_saved_raw_data": {"multiqc_kraken": {}}}')
    tables = read_multiqc_json(spark, f"{tmp_path}/r1/a/b/m.json")
    for name, section in (("trim_stats", "multiqc_trimmomatic"), ("fastqc_general", "report_general_stats_data")):
        with pytest.raises(Exception, match=f"section missing in metrics report: {section}"):
            tables[name].collect()
    assert tables["kraken_hits"].collect() == []


def _fastq(path, records):
    with gzip.open(path, "ab") as f:
        for name, seq, qual in records:
            f.write(f"@{name}\n{seq}\n+\n{qual}\n".encode())


def test_fastq_pairs(spark, tmp_path, rows):
    # two gzip members in one file, a quality line that starts with '@', mate and comment suffixes
    _fastq(f"{tmp_path}/S1_L001_R1.fastq.gz", [("r1/1", "ACGT", "@III")])
    _fastq(f"{tmp_path}/S1_L001_R1.fastq.gz", [("r2 1:N:0", "AC", "II")])
    _fastq(f"{tmp_path}/S1_L001_R2.fastq.gz", [("r1/2", "TTTT", "IIII"), ("r2 2:N:0", "G", "#")])
    _fastq(f"{tmp_path}/S1_L002_R1.fastq.gz", [("r3", "A", "I")])
    _fastq(f"{tmp_path}/S1_L002_R2.fastq.gz", [("r3", "C", "I")])
    _fastq(f"{tmp_path}/S10_R1.fastq.gz", [])
    _fastq(f"{tmp_path}/S10_R2.fastq.gz", [])
    reads = read_fastq_pairs(spark, str(tmp_path), run_id="r")
    assert rows(reads) == [
        ("r", "S1", "L001", "r1", "ACGT", "@III", "TTTT", "IIII"), ("r", "S1", "L001", "r2", "AC", "II", "G", "#"),
        ("r", "S1", "L002", "r3", "A", "I", "C", "I"),
    ]
    assert reads.rdd.getNumPartitions() == 3


def test_discovered_samples_keep_their_lanes(spark, tmp_path, rows):
    for run, name, read in (("a", "S1_L001_{}.fastq.gz", "x1"), ("a", "S1_L002_{}.fastq.gz", "x2"), ("b", "S1_{}.fq.gz", "y1"), ("b", "S0_{}.fq.gz", "y2")):
        (tmp_path / f"run={run}").mkdir(exist_ok=True)
        for mate in ("R1", "R2"):
            _fastq(f"{tmp_path}/run={run}/{name.format(mate)}", [(read, "ACGT", "IIII")])
    pattern = "run=([^/]+)/"
    sheet = art.discover_samples(art.list_artifacts(spark, str(tmp_path)), run_pattern=pattern)
    assert rows(sheet) == [("a", 0, "S1"), ("b", 0, "S0"), ("b", 1, "S1")]
    reads = read_fastq_pairs(spark, str(tmp_path), run_pattern=pattern)
    for prefix in (False, True):
        assert rows(art.concat_lanes(reads, sheet, prefix=prefix), "run_id", "sample_id", "lane", "read_id") == [
            ("a", "S1", "L001", "x1"), ("a", "S1", "L002", "x2"), ("b", "S0", "", "y2"), ("b", "S1", "", "y1")
        ]
    one = str(tmp_path / "run=a")
    assert art.concat_lanes(read_fastq_pairs(spark, one), art.discover_samples(art.list_artifacts(spark, one))).count() == 2
    with pytest.raises(Exception, match="no run in path"):
        read_fastq_pairs(spark, one, run_pattern="sheet=([^/]+)/").collect()


@pytest.mark.parametrize("second,message", [
    (None, "mate file missing"), ([("x", "A", "I")], "mates out of step"), ([], "mates out of step"),
    ([("r1", "AC", "I")], "broken read record"),
])
def test_fastq_errors(spark, tmp_path, second, message):
    _fastq(f"{tmp_path}/S1_R1.fastq.gz", [("r1", "ACGT", "IIII")])
    if second is not None:
        _fastq(f"{tmp_path}/S1_R2.fastq.gz", second)
    with pytest.raises(Exception, match=message):
        read_fastq_pairs(spark, str(tmp_path)).collect()


def test_fastq_round_trip_and_lanes(spark, tmp_path, rows):
    data = [("r", f"S{i % 3 or 10}", "", f"x{i}", "ACGT", "IIII", "GG", "##") for i in range(50)]
    schema = "run_id string, sample_id string, lane string, read_id string, seq1 string, qual1 string, seq2 string, qual2 string"
    write_fastq_pairs(spark.createDataFrame(data, schema).repartition(4), f"{tmp_path}/reads")
    back = read_fastq_pairs(spark, f"{tmp_path}/reads", run_id="r")
    expected = sorted((d[1], *d[3:]) for d in data)
    assert rows(back.drop("run_id", "lane")) == expected
    assert not list(tmp_path.glob("reads/*draft*"))
    more = spark.createDataFrame([("r", "S1", "", "later", "A", "I", "C", "I")], schema)
    write_fastq_pairs(more, f"{tmp_path}/more")
    write_fastq_pairs(more, f"{tmp_path}/more")
    assert read_fastq_pairs(spark, f"{tmp_path}/more").count() == 2
    sheet = spark.createDataFrame([("r", "S1"), ("r", "S10")], "run_id string, sample_id string")
    exact = art.concat_lanes(back, sheet).groupBy("sample_id").count()
    assert rows(exact) == [("S1", 17), ("S10", 17)]
    by_prefix = art.concat_lanes(back, sheet, prefix=True).groupBy("sample_id").count()
    assert rows(by_prefix) == [("S1", 34), ("S10", 17)]


def test_top_hit_files(spark, tmp_path):
    data = [("r1", "S1", 1, "50.00", "500", "10", "Genus", "570", "Klebsiella")]
    schema = "run_id string, sample_id string, hit_ord int, Percentage string, Count_Clade string, Count_Taxon string, TaxRank string, TaxID string, Organism string"
    write_top_hits(spark.createDataFrame(data, schema), f"{tmp_path}/hits")
    (file,) = tmp_path.glob("hits/run_id=r1/sample_id=S1/*.csv")
    assert file.read_text().splitlines() == [
        "Percentage,Count_Clade,Count_Taxon,TaxRank,TaxID,Organism", "50.00,500,10,Genus,570,Klebsiella"
    ]


def test_top_hit_files_of_odd_keys_and_texts(spark, tmp_path, rows):
    """Tasks put the files in place: directories and lines are as Spark writes and reads them, and a second write replaces the first."""
    keys = [("r1", "S1"), ("r1", "S 1+%=/x"), ("run:'2'", "é{[a]}^"), (None, "S1"), ("r1", ""), ("r1", None)]
    texts = ["plain", 'a "b", c\\', "", None, "x;y", "#1"]
    data = [(*key, n, "50.00", "5", None, "Genus", "570", text) for key in keys for n, text in enumerate(texts)]
    schema = "run_id string, sample_id string, hit_ord int, Percentage string, Count_Clade string, Count_Taxon string, TaxRank string, TaxID string, Organism string"
    hits, path = spark.createDataFrame(data, schema), f"{tmp_path}/hits"
    write_top_hits(hits.limit(2).withColumn("run_id", F.lit("old")), path)
    write_top_hits(hits, path)
    assert len(list(tmp_path.glob("hits/*/*/*.csv"))) == 5  # an empty key is a null one
    assert not list(tmp_path.glob("hits/run_id=old"))
    draft = tmp_path / "hits/run_id=r1/sample_id=S1/.part-00000.csv.7"  # left by a task that was ended
    draft.write_text("half a li")
    got = sinks.read_top_hits(spark, path)
    plain = spark.read.options(header=True).schema(got.schema).csv(path)
    assert got.columns == plain.columns
    assert rows(got) == rows(plain)
    assert got.count() == len(data)
    assert [r.Organism for r in got.where("sample_id = 'S 1+%=/x'").collect()][0] == "plain"


def test_top_hit_files_of_no_rows(spark, tmp_path):
    schema = "run_id string, sample_id string, hit_ord int, Percentage string, Count_Clade string, Count_Taxon string, TaxRank string, TaxID string, Organism string"
    write_top_hits(spark.createDataFrame([], schema), f"{tmp_path}/hits")
    assert sinks.read_top_hits(spark, f"{tmp_path}/hits").collect() == []
