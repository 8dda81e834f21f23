"""Key lookups (left joins on business keys) and size-checked broadcasts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
# The driver builds the hash table of a broadcast, some four times the measured
# bytes, beside the rows it collected and the blocks it sends.
_HEAP_SHARE = 24


def _broadcast_limit(df: DataFrame, max_bytes: int | None) -> int:
    if max_bytes is not None:
        return max_bytes
    spark = df.sparkSession
    conf = spark.conf.get("stellate.broadcast.maxBytes", None)
    return int(conf) if conf else min(DEFAULT_BROADCAST_BYTES, spark._jvm.Runtime.getRuntime().maxMemory() // _HEAP_SHARE)


_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
    T.NullType: 1,
}


def _size_exprs(df: DataFrame):
    """(fixed bytes per row, column summing the variable-width bytes)."""
    var, fixed = [], 0
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        dt = f.dataType
        if isinstance(dt, (T.StringType, T.BinaryType)):
            var.append(F.coalesce(F.sum(F.octet_length(c)), F.lit(0)))
        elif isinstance(dt, (T.StructType, T.ArrayType, T.MapType)):
            var.append(F.coalesce(F.sum(F.octet_length(F.to_json(c))), F.lit(0)))
        elif isinstance(dt, T.DecimalType):
            fixed += 8 if dt.precision <= 18 else 16
        else:
            fixed += _FIXED_WIDTH.get(type(dt), 16)
    total = F.lit(0).cast("bigint")
    for v in var:
        total = total + v
    return fixed, total


def measured_bytes_many(dfs: list[DataFrame]) -> list[tuple[int, int]]:
    """(rows, bytes) of several DataFrames, measured together in one job (a
    union of one-row aggregates): fixed-width columns by their type size,
    strings and binaries by their real length, nested columns by the length
    of their JSON form."""
    union = None
    for i, df in enumerate(dfs):
        fixed, var = _size_exprs(df)
        one = df.agg(F.count(F.lit(1)).alias("rows"), var.alias("var")).select(
            F.lit(i).alias("i"), "rows", "var", F.lit(fixed + 16).alias("width"))
        union = one if union is None else union.unionByName(one)
    rows = sorted(union.collect()) if union is not None else []
    return [(int(r["rows"]), int(r["rows"]) * int(r["width"]) + int(r["var"])) for r in rows]


def measured_bytes(df: DataFrame) -> tuple[int, int]:
    return measured_bytes_many([df])[0]


# A table that Catalyst (by file sizes, or multiplied up by joins) takes to be
# this many times over the limit is not measured; it joins by shuffling.
_ESTIMATE_MARGIN = 8
_UNKNOWN = 1 << 62   # what Catalyst says about data it knows nothing of


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan (no job)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size if isinstance(size, int) else size.toString())


def bounded_many(dfs: list[DataFrame], max_bytes: int | None = None) -> list[bool]:
    """Whether a measurement proves each table to be under the limit, together
    with the smaller ones: a query's tables are in the driver at the same time."""
    if not dfs:
        return []
    limit = _broadcast_limit(dfs[0], max_bytes)
    likely = [i for i, df in enumerate(dfs) if not _ESTIMATE_MARGIN * limit < estimated_bytes(df) < _UNKNOWN]
    sizes = dict(zip(likely, measured_bytes_many([dfs[i] for i in likely])))
    fit, total = set(), 0
    for i in sorted(sizes, key=lambda i: sizes[i][1]):
        total += sizes[i][1]
        if total <= limit:
            fit.add(i)
    return [i in fit for i in range(len(dfs))]


def is_bounded(df: DataFrame, max_bytes: int | None = None) -> bool:
    return bounded_many([df], max_bytes)[0]


def bounded_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when a measurement proves it is under the limit;
    otherwise return it unchanged so the join shuffles (with AQE skew
    splitting) instead of shipping an unbounded table to every executor."""
    return bounded_broadcast_many([df], max_bytes)[0]


def bounded_broadcast_many(dfs: list[DataFrame], max_bytes: int | None = None) -> list[DataFrame]:
    """``bounded_broadcast`` for several tables, measured in one job."""
    return [F.broadcast(df) if small else df for df, small in zip(dfs, bounded_many(dfs, max_bytes))]


@dataclass(frozen=True)
class Lookup:
    """Left-join ``dim`` on ``fact_col == dim_col`` and add ``key_col``.

    ``carry`` maps dimension columns to names under which they stay on the
    row, so a later lookup can chain through them (snowflake lookup).
    """

    dim: DataFrame
    fact_col: str
    dim_col: str
    key_col: str
    carry: dict[str, str] = field(default_factory=dict)


def lookup_keys(fact: DataFrame, lookups: list[Lookup], *, broadcast_bytes: int | None = None,
                keep_carried: bool = False) -> DataFrame:
    """Every fact row survives; a missing match (or NULL business key) gives a
    NULL key; duplicate business keys in a dimension multiply rows, as a SQL
    LEFT JOIN does. Dimensions are broadcast only after their size is
    measured; larger ones are joined by shuffle."""
    out = fact
    carried: list[str] = []
    rights = [lk.dim.select(F.col(lk.dim_col).alias(f"_lk{i}_bk"), F.col(lk.key_col),
                            *[F.col(src).alias(dst) for src, dst in lk.carry.items()])
              for i, lk in enumerate(lookups)]
    rights = bounded_broadcast_many(rights, broadcast_bytes)      # one measuring job for all
    for i, (lk, right) in enumerate(zip(lookups, rights)):
        bk = f"_lk{i}_bk"
        out = out.join(right, F.col(lk.fact_col) == F.col(bk), "left").drop(bk)
        carried += list(lk.carry.values())
    if not keep_carried and carried:
        out = out.drop(*carried)
    return out
