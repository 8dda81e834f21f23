"""Nested lists to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def explode_list(df: DataFrame, list_col: str, keep: list[str], alias: str = "item") -> DataFrame:
    """One row per list element. A NULL or empty list yields no rows, the same
    as a missing list defaulting to ``[]``."""
    return df.select(*keep, F.explode(F.col(list_col)).alias(alias))


def child_rows(df: DataFrame, parent_id: str, list_col: str, *, position: str = "_pos",
               base_position: str | None = None) -> DataFrame:
    """Child table of a nested list: parent id, element position and the
    element's fields (struct elements are spread into columns).
    ``base_position`` adds an offset column when a long list was landed in
    several bounded chunks."""
    pos = F.col("_p") if base_position is None else F.col("_p") + F.col(base_position)
    exploded = df.select(F.col(parent_id), F.col(base_position) if base_position else F.lit(0).alias("_b"),
                         F.posexplode(F.col(list_col)).alias("_p", "_v"))
    elem = df.schema[list_col].dataType.elementType
    if isinstance(elem, T.StructType):
        value_cols = [F.col(f"_v.`{f.name}`").alias(f.name) for f in elem.fields]
    else:
        value_cols = [F.col("_v").alias("value")]
    return exploded.select(F.col(parent_id), pos.cast("bigint").alias(position), *value_cols)
