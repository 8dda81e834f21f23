"""Schema-driven column operations for landed JSON."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flat_cols(dtype: T.StructType, prefix: list[str], sep: str) -> list[Column]:
    out = []
    for f in dtype.fields:
        path = prefix + [f.name]
        if isinstance(f.dataType, T.StructType):
            out += _flat_cols(f.dataType, path, sep)
        else:
            ref = ".".join(f"`{p}`" for p in path)
            out.append(F.col(ref).alias(sep.join(path)))
    return out


def flatten(df: DataFrame, sep: str = "__") -> DataFrame:
    """Nested struct fields become ``parent__child`` columns, in one select.
    Lists stay as they are (see ``child_rows``)."""
    return df.select(*_flat_cols(df.schema, [], sep))


_CAMEL_1 = re.compile(r"(.)([A-Z][a-z]+)")
_CAMEL_2 = re.compile(r"([a-z0-9])([A-Z])")
_NON_WORD = re.compile(r"[^0-9a-zA-Z_]+")


def snake_case(name: str) -> str:
    """``onlineStatus`` -> ``online_status``; other characters become ``_``."""
    s = _CAMEL_2.sub(r"\1_\2", _CAMEL_1.sub(r"\1_\2", name))
    s = _NON_WORD.sub("_", s)
    return re.sub(r"_+", "_", s).lower()


def normalize_names(df: DataFrame) -> DataFrame:
    """Rename every top-level column to snake_case; two columns that map to
    the same name are an error."""
    new = [snake_case(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"column name collision: {seen[n]!r} and {old!r} -> {n!r}")
        seen[n] = old
    return df.toDF(*new)


def union_with_growth(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append with schema growth: columns are matched by name, new columns
    are added and earlier rows get NULL in them."""
    return old.unionByName(new, allowMissingColumns=True)
