"""Rounding for display: half to even on the exact binary value."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_decimals(value: Column) -> Column:
    """A number in [0, 1] as text with two decimals.

    ``round`` and ``bround`` work on the shortest decimal form, which can sit on
    a midpoint where the number itself does not. Here the number is compared
    with the midpoint as a double; only on equality does the midpoint's own
    rounding decide, and there are just 100 midpoints.
    """
    at_midpoint = F.array(*[F.lit(round(float(f"{(2 * k + 1) / 200:.2f}") * 100)) for k in range(101)])
    low = F.floor(value * 100).cast("int")
    middle = (low * 2 + 1) / F.lit(200.0)
    cents = (
        F.when(value < middle, low)
        .when(value > middle, low + 1)
        .otherwise(F.get(at_midpoint, low))
    )
    return F.concat(
        F.floor(cents / 100).cast("string"),
        F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )


def whole_percent(value: Column) -> Column:
    return F.concat(F.bround(value, 0).cast("bigint").cast("string"), F.lit("%"))
