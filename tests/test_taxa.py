import pytest
from pyspark.sql import functions as F

from platewise import reference_values as ref
from platewise import schemas
from platewise.operators import taxa
from platewise.plans.species_calls import species_calls

LINES = [
    (1, "10.00", "100", "100", "U", "0", "unclassified"), (2, "90.00", "900", "0", "R", "1", "root"),
    (3, "50.00", "500", "10", "G", "570", "      Klebsiella"),
    (4, "30.00", "300", "300", "S", "573", "        Klebsiella pneumoniae"),
    (5, "19.00", "190", "190", "S", "548", "        [Enterobacter] aerogenes"),
    (6, "40.00", "400", "0", "G", "561", "      Escherichia"),
    (7, "40.00", "400", "400", "S", "562", "        Escherichia coli"), (8, "0.10", "1", "1", "G1", "999", "      none"),
]


@pytest.fixture
def lines(spark):
    data = [("r1", "S1", *line) for line in LINES]
    data += [("r1", "S2", 1, "5.00", "5", "5", "S", "548", "[Enterobacter] aerogenes")]
    data += [("r1", "S3", n, "1.00", "1", "1", rank, str(n), f"{rank}{n}") for n, rank in enumerate("GGGGSSSSUU", 1)]
    data += [("r1", "S4", 1, "100.00", "9", "9", "U", "0", "unclassified")]
    return spark.createDataFrame(data, schemas.REPORT_LINES)


@pytest.fixture
def sheet(spark):
    return spark.createDataFrame([("r1", n, f"S{n}") for n in (5, 4, 3, 2, 1)], schemas.SAMPLES)


def dimensions(spark):
    sizes = [(n, *row) for n, row in enumerate(ref.GENOME_SIZES)] + [(99, "Escherichia coli", "562", "1")]
    renames = [(0, "[Enterobacter] aerogenes", "wrong"), (1, *ref.RENAMES[0])]
    return spark.createDataFrame(renames, schemas.RENAMES), spark.createDataFrame(sizes, schemas.GENOME_SIZES)


def test_top_hits_in_report_order(lines, rows):
    got = [r for r in taxa.top_hits(lines).orderBy("sample_id", "hit_ord").collect()]
    first = [(r.TaxRank, r.Organism, r.Percentage) for r in got if r.sample_id == "S1"]
    assert first == [
        ("Genus", "Klebsiella", "50.00"), ("Genus", "Escherichia", "40.00"), ("Species", "Klebsiella pneumoniae", "30.00"),
        ("Species", "[Enterobacter] aerogenes", "19.00"), ("Species", "Escherichia coli", "40.00"),
        ("Unclassified", "unclassified", "10.00"),
    ]
    assert [r.Organism for r in got if r.sample_id == "S3"] == ["G1", "G2", "G3", "S5", "S6", "S7", "U9"]


def test_species_calls(spark, lines, sheet, rows):
    got = rows(species_calls(sheet, lines, *dimensions(spark)))
    assert got == [
        ("r1", "S1", "Klebsiella pneumoniae", "573", "5600000"), ("r1", "S2", "Klebsiella aerogenes", "548", "5600000"),
        ("r1", "S3", "S5", "5", "NA"), ("r1", "S4", "Unknown", "NA", "NA"), ("r1", "S5", "Unknown", "NA", "NA"),
    ]


def test_order_by_percent_is_an_option(spark, lines, sheet, rows):
    got = {r.sample_id: r.species for r in taxa.top_species(lines, order="percent").collect()}
    assert got["S1"] == "Escherichia coli"
    with pytest.raises(ValueError):
        taxa.top_hits(lines, order="other")


def test_first_genome_size_and_last_rename_win(spark, rows):
    renames, sizes = dimensions(spark)
    assert dict(rows(taxa.first_or_last_wins(sizes, "species", "genome_size", "first")))["Escherichia coli"] == "5150000"
    assert rows(taxa.first_or_last_wins(renames, "old_name", "new_name", "last")) == [ref.RENAMES[0]]


def test_first_and_second_taxa(spark, rows):
    data = [("r", "a", n, rank, float(n), f"{rank}{n}") for n, rank in enumerate(["U", "G", "S", "G", "G", "D", "S", "U"])]
    data += [("r", "one", 0, "G", 9.0, "only"), ("r", "empty", None, None, None, None)]
    got = {r.metric_key: r for r in taxa.first_second_taxa(spark.createDataFrame(data, schemas.KRAKEN_HITS)).collect()}
    assert tuple(got["a"])[2:] == ("G1", 1.0, "G3", 3.0, "S2", 2.0, "S6", 6.0, 0.0)
    assert (got["one"].genus_1, got["one"].genus_2) == ("only", None)
    assert tuple(got["empty"])[2:] == (None,) * 9


def test_first_present_key_wins_even_if_empty(spark):
    data = [
        ("r", "S1.kraken", None, None, None, None), ("r", "S1", 0, "G", 1.0, "plain"), ("r", "S2", 0, "G", 1.0, "plain"),
        ("r", "S2_processed", 0, "G", 1.0, "processed"), ("r", "S3_processed", 0, "G", 1.0, "processed"),
    ]
    got = taxa.first_present_key(taxa.first_second_taxa(spark.createDataFrame(data, schemas.KRAKEN_HITS)))
    found = {r.base_id: r.genus_1 for r in got.collect()}
    assert (found["S1"], found["S2"], found["S3"]) == (None, "plain", "processed")


def test_union_keeps_the_sheets_samples(spark, sheet, rows):
    def calls(*ids):
        return spark.createDataFrame([("r1", i, "x", "1", "2") for i in ids], schemas.SPECIES_CALLS)

    got = taxa.union_species([calls("S1", "old"), calls("S2")], sheet)
    assert rows(got, "sample_id") == [("S1",), ("S2",)]


def test_plan_limits_groups_before_the_shuffle(spark, lines):
    plan = taxa.top_hits(lines)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
