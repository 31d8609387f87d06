"""Rounding to two decimals, as the rain and earthquake figures are defined.

``F.round`` rounds the shortest decimal text of a double half up, so 676.175
gives 676.18.  The figures are defined on the binary value instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_exact(c: Column) -> Column:
    """Nearest two-decimal number to the exact binary value, ties to even."""
    return F.call_function("format_number", c, F.lit("0.00")).try_cast("double")


def round_scaled(c: Column) -> Column:
    """A hundred times the value to the nearest integer, ties to even, and back."""
    return F.rint(c * 100) / 100
