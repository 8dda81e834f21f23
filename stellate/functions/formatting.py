"""Fixed-width report line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def report_line(name: Column | str, amount: Column | str) -> Column:
    """Name left-aligned in 15 characters (never cut), amount right-aligned in
    10 with two decimals. The amount is rounded as a decimal (half up on the
    exact value) and printed as text, because ``%f`` on a double rounds
    2.675 up where the exact value is below."""
    n = F.col(name) if isinstance(name, str) else name
    a = F.col(amount) if isinstance(amount, str) else amount
    return F.format_string("%-15s %10s", n, a.cast(T.DecimalType(38, 2)).cast("string"))
