"""String rules: names, keys, templates, glob patterns and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from platewise import reference_values as ref
from platewise.functions.numeric import round_binary_half_even

BLANKS = " \t\r\n"


def clean_name(name: Column) -> Column:
    """Name without the indentation a report uses to show depth."""
    return F.btrim(name, F.lit(BLANKS))


def base_sample_id(metric_key: Column) -> Column:
    """Metric key with every mate suffix removed."""
    return F.regexp_replace(metric_key, "_processed_R[12]", "")


def decode_rank(rank_code: Column) -> Column:
    out = None
    for code, name in ref.RANK_NAMES.items():
        hit = rank_code == code
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def parse_skip_list(text: Column) -> Column:
    """``'NEG, a,,b'`` as ``[NEG, a, b]``; a missing list is empty."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda s: F.btrim(s, F.lit(BLANKS)))
    return F.filter(parts, lambda s: s != "")


def expand_template(template: Column, values: dict[str, Column]) -> Column:
    """Replace each ``{name}`` by its column, in the given order.

    Unknown names stay literal, and so does a name whose value is missing in that row.
    """
    out = template
    for name, value in values.items():
        token = F.lit("{" + name + "}")
        out = F.replace(out, token, F.coalesce(value.cast("string"), token))
    return out


def expand_entries(template: Column, entries: Column) -> Column:
    """Replace each ``{key}`` by its value, for (key, value) entries in the order of their keys; null values leave the name."""
    known = F.filter(entries, lambda e: e["key"].isNotNull() & e["value"].isNotNull())
    return F.aggregate(
        F.array_sort(known), template,
        lambda text, e: F.replace(text, F.concat(F.lit("{"), e["key"], F.lit("}")), e["value"]),
    )


def parent_dir(path: Column) -> Column:
    """Everything before the last slash, '' if there is none."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def has_wildcard(path: Column) -> Column:
    return path.contains("*") | path.contains("?")


def glob_to_regex(pattern: Column) -> Column:
    """File-name glob as an anchored regular expression: only ``*``, ``?`` and ``[...]`` are special."""
    out = F.regexp_replace(pattern, r"([\\.^$+{}()|])", r"\\$1")
    out = F.regexp_replace(out, r"\[(?![^\]]+\])", r"\\[")
    out = F.regexp_replace(out, r"\[!", "[^")
    out = F.regexp_replace(out, r"\?", "[^/]")
    out = F.regexp_replace(out, r"\*", "[^/]*")
    return F.concat(F.lit("(?s)^"), out, F.lit("$"))


def parse_elapsed(text: Column) -> Column:
    """Seconds from ``h:mm:ss`` or ``m:ss.ss``."""
    return F.aggregate(
        F.split(text, ":"),
        F.lit(0.0),
        lambda acc, part: acc * F.lit(60.0) + part.try_cast("double"),
    )


def format_runtime(seconds: str) -> Column:
    """``x.x seconds``, ``Nm x.xs`` or ``Nh Nm x.xs`` of a number of seconds (given as SQL text)."""
    value = F.expr(f"CAST({seconds} AS DOUBLE)")
    short = F.format_string("%.1f seconds", round_binary_half_even(seconds, 1))
    rest = round_binary_half_even(f"({seconds}) % 60D", 1)
    minutes, hours = F.floor(value / 60), F.floor(value / 3600)
    return (
        F.when(value < 60, short)
        .when(value < 3600, F.format_string("%dm %.1fs", minutes, rest))
        .otherwise(F.format_string("%dh %dm %.1fs", hours, F.floor((value % 3600) / 60), rest))
    )
