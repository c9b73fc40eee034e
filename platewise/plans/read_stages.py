"""From raw read pairs to the processed set and its statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from platewise.operators import reads as rd
from platewise.session import checkpointed


def processed_reads(trimmed: DataFrame, **subsampling: object) -> DataFrame:
    """The pairs later stages see: paired survivors, subsampled where a sample has too many.

    ``trimmed`` is read three times, so pass a stored table.
    """
    paired = trimmed.where("survivor = 'paired'").drop("survivor")
    return rd.subsample_pairs(paired, **subsampling)


def read_stages(reads: DataFrame, adapters: Sequence[str] = (), **subsampling: object) -> dict[str, DataFrame]:
    """Trim, subsample and measure the reads of all samples. Trimmed and processed reads are stored."""
    trimmed = checkpointed(rd.trim_reads(reads, adapters))
    processed = checkpointed(processed_reads(trimmed, **subsampling))
    counts = rd.position_counts(processed)
    return {
        "trimmed": trimmed,
        "processed": processed,
        "trim_survival": rd.trim_survival(trimmed),
        "read_stats": rd.read_stats(processed),
        "length_histogram": rd.length_histogram(processed),
        "duplicate_reads": rd.duplicate_reads(processed),
        "position_profile": rd.position_profile(counts),
    }
