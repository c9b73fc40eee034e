"""Rounding and number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Nested transforms over one-element arrays name intermediate values, so each is computed once:
# size = |x|, scaled = fraction * 2**52, product = scaled * 10**digits, units = whole units of the last digit.
# What lies below 2**-52 (values under 1 only) is carried into the product.
_ROUND = """
CASE WHEN abs({x}) < 4398046511104D THEN signum({x}) * get(transform(array(abs({x})),
  size -> get(transform(array((size - floor(size)) * 4503599627370496D),
  scaled -> get(transform(array(floor(scaled) * {scale}L + floor((scaled - floor(scaled)) * {scale}L)),
  product -> get(transform(array(floor(size) * {scale}L + shiftright(product, 52)),
  units -> units + CASE
    WHEN product & 4503599627370495L > 2251799813685248L THEN 1
    WHEN product & 4503599627370495L < 2251799813685248L THEN 0
    WHEN (scaled - floor(scaled)) * {scale}L > floor((scaled - floor(scaled)) * {scale}L) THEN 1
    ELSE units & 1 END
  ), 0)), 0)), 0)), 0) / {scale}D
ELSE bround({x}, {digits}) END"""


def round_binary_half_even(x: str, digits: int) -> Column:
    """Round the exact binary value of a double (given as SQL text), ties to even.

    12.25 gives 12.2 and 12.35 (stored slightly below) gives 12.3, where ``bround`` works on the
    decimal text and gives 12.4. The fraction is scaled to an integer of 52 bits, so the computation is
    exact 64-bit arithmetic; ``digits`` may be 0 to 3. Values of 2**42 and more have no digits left to
    argue about and go through ``bround``.
    """
    if not 0 <= digits <= 3:
        raise ValueError("digits must be between 0 and 3")
    return F.expr(_ROUND.format(x=f"CAST({x} AS DOUBLE)", scale=10**digits, digits=digits))


def default_missing(value: Column, default: object) -> Column:
    """``value``, or a literal where it is missing."""
    return F.coalesce(value, F.lit(default))


def paired_total(total_sequences: Column) -> Column:
    """Reads of both mates from the first mate's count (the mates are equally long)."""
    return total_sequences.cast("bigint") * 2
