"""Species call per sample: report lines, renames and genome sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise import reference_values as ref
from platewise.functions.numeric import default_missing
from platewise.operators.taxa import genome_size_lookup, species_rename, top_species


def species_calls(
    samples: DataFrame, lines: DataFrame, renames: DataFrame, sizes: DataFrame, order: str = "report"
) -> DataFrame:
    """One call per distinct sample of the sheet: Unknown / NA / NA where its report names no species."""
    keys = ["run_id", "sample_id"]
    calls = genome_size_lookup(species_rename(top_species(lines, order), renames), sizes)
    return samples.select(*keys).distinct().join(calls, keys, "left").select(
        *keys,
        default_missing(F.col("species"), ref.UNKNOWN_SPECIES).alias("top_species"),
        default_missing(F.col("taxid"), ref.MISSING_CALL).alias("taxid"),
        default_missing(F.col("expected_genome_size"), ref.MISSING_CALL).alias("expected_genome_size"),
    )
