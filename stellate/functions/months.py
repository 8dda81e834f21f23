"""Month arguments in ``YYYY/MM`` form and the inclusive month-range filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def validate_month(value: str | None) -> None:
    """A month argument must have ``/`` as fifth character; empty passes."""
    if not value:
        return
    if len(value) < 5 or value[4] != "/":
        raise ValueError(value)


def month_of_url(url: Column | str) -> Column:
    """Last seven characters of an archive URL ending in ``/YYYY/MM``."""
    c = F.col(url) if isinstance(url, str) else url
    return F.substring(c, -7, 7)


def month_range_filter(df: DataFrame, month: Column | str, start: str | None, end: str | None) -> DataFrame:
    """Keep rows with ``start <= month <= end`` compared as text; an absent
    or empty bound does not filter. Plain column predicates, so they push
    down to the scan when ``month`` is a stored column."""
    validate_month(start)
    validate_month(end)
    m = F.col(month) if isinstance(month, str) else month
    if start:
        df = df.filter(m >= F.lit(start))
    if end:
        df = df.filter(m <= F.lit(end))
    return df


def bad_month_rows(df: DataFrame, month: Column | str) -> DataFrame:
    """Row form of the month check: non-empty values whose fifth character is
    not ``/`` (shorter strings included)."""
    m = F.col(month) if isinstance(month, str) else month
    return df.filter((F.length(m) > 0) & (F.coalesce(F.substring(m, 5, 1), F.lit("")) != "/"))
