"""Casts: strict text-to-decimal and per-column type hints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Precision used for the reference's unbounded ``numeric``; parameterised.
NUMERIC = T.DecimalType(28, 6)


def _session_ansi() -> bool:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark is None or str(spark.conf.get("spark.sql.ansi.enabled", "true")).lower() == "true"


def strict_decimal(col: Column | str, dtype: T.DecimalType = NUMERIC, *, ansi: bool | None = None) -> Column:
    """``text::numeric``: text that is not a number fails the query.

    With ANSI mode (Spark 4 default) the plain cast raises CAST_INVALID_INPUT
    (SQLSTATE 22018). When the session runs with ANSI off (detected, or
    ``ansi=False``), a failed ``try_cast`` of non-NULL text raises instead.
    """
    if ansi is None:
        ansi = _session_ansi()
    c = F.col(col) if isinstance(col, str) else col
    if ansi:
        return c.cast(dtype)
    tried = c.try_cast(dtype)
    return F.when(c.isNotNull() & tried.isNull(),
                  F.raise_error(F.concat(F.lit("[CAST_INVALID_INPUT] not a number: "), c))
                  ).otherwise(tried)


def money(col: Column | str, scale: int = 2, precision: int = 18) -> Column:
    """Amount rounded to ``scale`` decimals, for sources known to hold no more."""
    return strict_decimal(col, T.DecimalType(precision, scale))


def apply_type_hints(df: DataFrame, hints: dict[str, str]) -> DataFrame:
    """Column typing hints, applied in one projection.

    ``timestamp``: numbers are epoch seconds, text is parsed as a timestamp.
    Any other hint is a Spark SQL type name used in a cast.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name in df.columns:
        kind = hints.get(name)
        c = F.col(f"`{name}`")
        if kind is None:
            out.append(c)
        elif kind == "timestamp":
            if isinstance(types[name], T.NumericType):
                out.append(F.timestamp_seconds(c).alias(name))
            else:
                out.append(F.to_timestamp(c).alias(name))
        else:
            out.append(c.cast(kind).alias(name))
    return df.select(*out)
