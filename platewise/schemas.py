"""Explicit schemas of every table the operators read or write (none is inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

STR, LONG, INT, DBL, TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType()


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


# one row per sample of a run, in sheet order
SAMPLES = table(run_id=STR, sample_ord=LONG, sample_id=STR)
# samples that may fail without stopping a run
ALLOWED_FAILURES = table(run_id=STR, sample_id=STR)
# one row per read pair: mates travel together
READS = table(
    run_id=STR, sample_id=STR, lane=STR, read_id=STR, seq1=STR, qual1=STR, seq2=STR, qual2=STR
)
# classification report; line_no orders the lines of one report and need not be dense
REPORT_LINES = table(
    run_id=STR, sample_id=STR, line_no=LONG, percentage=STR, count_clade=STR,
    count_taxon=STR, rank_code=STR, taxid=STR, name=STR,
)
GENOME_SIZES = table(line_no=LONG, species=STR, taxid=STR, genome_size=STR)
RENAMES = table(line_no=LONG, old_name=STR, new_name=STR)
SPECIES_CALLS = table(
    run_id=STR, sample_id=STR, top_species=STR, taxid=STR, expected_genome_size=STR
)
TOP_HITS = table(
    run_id=STR, sample_id=STR, hit_ord=INT, Percentage=STR, Count_Clade=STR, Count_Taxon=STR,
    TaxRank=STR, TaxID=STR, Organism=STR,
)

# the four sections read from a metrics report, one JSON object per run
_KRAKEN_HIT = table(rank_code=STR, percent=DBL, classif=STR)
MULTIQC_JSON = table(
    report_general_stats_data=T.ArrayType(T.MapType(STR, T.MapType(STR, STR))),
    report_saved_raw_data=table(
        multiqc_kraken=T.MapType(STR, T.ArrayType(_KRAKEN_HIT)),
        multiqc_trimmomatic=T.MapType(STR, table(surviving_pct=DBL)),
        multiqc_fastqc=T.MapType(STR, T.MapType(STR, STR)),
    ),
)
FASTQC_GENERAL = table(
    run_id=STR, metric_key=STR, total_sequences=DBL, percent_gc=DBL, avg_sequence_length=DBL
)
FASTQC_STATUS = table(run_id=STR, metric_key=STR, module=STR, status=STR)
KRAKEN_HITS = table(run_id=STR, metric_key=STR, pos=INT, rank_code=STR, percent=DBL, classif=STR)
TRIM_STATS = table(run_id=STR, metric_key=STR, surviving_pct=DBL)

QC_SUMMARY = table(
    Sample_ID=STR, Total_Trimmed_Reads=LONG, GC_PCT=DBL, Avg_Sequence_Length=DBL,
    Passing_Trim_PCT=DBL, Unclassified_PCT=DBL, Top_Genus=STR, Top_Genus_PCT=DBL, Second_Genus=STR,
    Second_Genus_PCT=DBL, Top_Species=STR, Top_Species_PCT=DBL, Second_Species=STR,
    Second_Species_PCT=DBL, FASTQC_fails=STR, TaxID=STR, Expected_Genome_Size=STR,
)

SUB_TOOL = table(name=STR, version=STR, path=STR, database=STR)
TOOLS = table(
    tool_ord=INT, tool=STR, execution_mode=STR, parallel=INT, sample_output_pattern=STR,
    output_pattern=STR, required=T.ArrayType(STR), sub_tools=T.ArrayType(SUB_TOOL),
)
TOOL_DEPS = table(dep_ord=INT, tool=STR, dep_tool=STR)
RUNS = table(run_id=STR, rundir=STR, input_dir=STR, script_dir=STR)
ARTIFACTS = table(path=STR, length=LONG)
TASK_RUNS = table(
    run_id=STR, tool=STR, execution_mode=STR, sample_id=STR, ts=TS, event=STR, status=STR,
    exit_code=INT, runtime_s=DBL, max_rss_kb=DBL, user_s=DBL, sys_s=DBL, wall_s=DBL,
)
HOSTS = table(run_id=STR, logical_cores=INT, cpu_cores=INT, memory_gb=DBL)
RESOURCE_USAGE = table(
    timestamp=STR, tool=STR, execution_mode=STR, n_ran=LONG, mean_memory_gb=DBL, max_memory_gb=DBL,
    mean_cpu_cores=DBL, max_cpu_cores=DBL, runtime_seconds=DBL, parallel=INT, suggested_threads=LONG,
    memory_t_recommended=LONG, memory_t_limit=LONG, cpu_t_recommended=LONG, cpu_t_limit=LONG,
    bottleneck=STR, mem_total_percent=DBL, cpu_total_percent=DBL,
)
VERSIONS = table(run_id=STR, ts=TS, tool=STR, sub_tool=STR, version=STR, path=STR, database=STR)
TAXONOMY = table(taxid=LONG, rank_code=STR, name=STR, path=T.ArrayType(LONG))
