"""Types that change between loads (A10).

A column takes values of another type if one type holds both exactly: whole
numbers widen among themselves and into decimals, 32-bit ones into doubles,
floats into doubles, decimals into wider ones; a text column takes the text
of any simple value. Where no such type exists, the new values go to a
variant column ``<name>__v_<type>`` and the column itself is NULL there.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Whole numbers, narrow types first, and the digits of a decimal that a Parquet
#: column of the type can be read as (fixed values of Spark's Parquet reader).
_DIGITS = {T.ByteType(): 10, T.ShortType(): 10, T.IntegerType(): 10, T.LongType(): 20}
_WHOLE = list(_DIGITS)
_NESTED = (T.StructType, T.ArrayType, T.MapType, T.BinaryType)


def widened(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type in which a column of type ``old`` holds ``new`` values too, or None."""
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.StringType):
        return None if isinstance(new, _NESTED) else old
    if old in _DIGITS and new in _DIGITS:
        return max(old, new, key=_WHOLE.index)
    if {old, new} <= {T.FloatType(), T.DoubleType()}:
        return T.DoubleType()
    whole = [t for t in (old, new) if t in _DIGITS]
    if whole and T.DoubleType() in (old, new):
        return T.DoubleType() if _DIGITS[whole[0]] <= 10 else None
    if all(t in _DIGITS or isinstance(t, T.DecimalType) for t in (old, new)):
        before, after = zip(*((t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[t], 0) for t in (old, new)))
        return T.DecimalType(max(before) + max(after), max(after)) if max(before) + max(after) <= 38 else None
    return None


def variant_name(name: str, kind: T.DataType) -> str:
    return f"{name}__v_{re.split('[^a-z0-9]', kind.simpleString())[0]}"


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with its columns in types that ``schema`` takes, values that it
    cannot take moved to variant columns."""
    known = {f.name: f.dataType for f in schema.fields}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name not in known or known[f.name] == f.dataType:
            out.append(c)
        elif (wide := widened(known[f.name], f.dataType)) is not None:
            out.append(c.cast(wide).alias(f.name))
        else:
            out.append(F.lit(None).cast(known[f.name]).alias(f.name))
            out.append(c.alias(variant_name(f.name, f.dataType)))
    df = df.select(*out)
    # a variant column may have changed its type too
    return df if all(known.get(f.name, f.dataType) == f.dataType or widened(known[f.name], f.dataType) == f.dataType for f in df.schema.fields) else aligned(df, schema)
