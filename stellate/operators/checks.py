"""Constraint checks as DataFrames: an empty result means the check passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.operators.lookups import bounded_broadcast, bounded_broadcast_many


class ConstraintViolation(Exception):
    def __init__(self, message: str, sqlstate: str = "23505", violations: int | None = None):
        super().__init__(message)
        self._sqlstate = sqlstate
        self.violations = violations

    def getSqlState(self) -> str:  # noqa: N802
        return self._sqlstate


class MergeCardinalityError(ConstraintViolation):
    """A target row would be updated by more than one source row."""

    def __init__(self, message: str):
        super().__init__(message, "21000")


def pk_violations(df: DataFrame, key: list[str] | str) -> DataFrame:
    """Primary key check: groups of a key value seen more than once, or with a
    NULL in the key. Partial aggregation keeps a hot key to one row per map
    task before the shuffle."""
    key = [key] if isinstance(key, str) else list(key)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") > 1) | any_null))


def fk_violations(fact: DataFrame, fk_col: str, dim: DataFrame, dim_key: str,
                  broadcast_bytes: int | None = None) -> DataFrame:
    """Fact rows whose non-NULL foreign key is missing from the dimension."""
    keys = bounded_broadcast(dim.select(F.col(dim_key).alias(fk_col)), broadcast_bytes)
    return fact.filter(F.col(fk_col).isNotNull()).join(keys, fk_col, "left_anti")


def fk_violation_counts(fact: DataFrame, refs: list[tuple[str, DataFrame, str]],
                        broadcast_bytes: int | None = None, *, unique_keys: bool = False) -> dict[str, int]:
    """Violations of several foreign keys of one fact in a single pass over
    its key columns: ``refs`` holds (fk column, dimension, dimension key).
    Each dimension's keys are de-duplicated, unless known to be unique, and
    joined (broadcast when measured small); a non-NULL fk without a partner
    is a violation."""
    out = fact.select(*[fk for fk, _, _ in refs])
    checks, rights = [], []
    for i, (_, dim, key) in enumerate(refs):
        keys = dim.select(F.col(key).alias(f"_fk{i}_key"))
        rights.append((keys if unique_keys else keys.dropDuplicates()).withColumn(f"_fk{i}_ok", F.lit(True)))
    for i, ((fk, _, _), keys) in enumerate(zip(refs, bounded_broadcast_many(rights, broadcast_bytes))):
        out = out.join(keys, F.col(fk) == F.col(f"_fk{i}_key"), "left")
        checks.append(F.count_if(F.col(fk).isNotNull() & F.col(f"_fk{i}_ok").isNull()).alias(fk))
    row = out.agg(*checks).first()
    return {fk: int(row[fk]) for fk, _, _ in refs}


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column: (column_name, n_nulls), computed in one pass."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, n_nulls)")


def require_not_null(df: DataFrame, cols: list[str]) -> None:
    """NOT NULL constraint: raise (SQLSTATE 23502) when a column holds a NULL."""
    bad = [r["column_name"] for r in null_counts(df, cols).filter("n_nulls > 0").collect()]
    if bad:
        raise ConstraintViolation(f"NULL value in NOT NULL column(s) {bad}", "23502")


def source_key_repeats(source: DataFrame, key: list[str]) -> DataFrame:
    """Non-NULL source keys that occur more than once (NULL keys never match,
    so repeating them is legal)."""
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    return source.filter(not_null).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def has_key_repeats(source: DataFrame, key: list[str]) -> bool:
    """Whether ``source_key_repeats`` finds any. Eight bytes a row are shuffled;
    only when two rows share a hash are the keys themselves compared."""
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    shared = source.filter(not_null).groupBy(F.xxhash64(*key).alias("h")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return not shared.isEmpty() and not source_key_repeats(source, key).isEmpty()


def merge_cardinality_violations(source: DataFrame, target: DataFrame, key: list[str] | str) -> DataFrame:
    """Source keys that occur more than once AND match an existing target row.
    Duplicate source keys without a target match are legal (all inserted).
    The source is aggregated first, so only repeated keys meet the target."""
    from stellate.operators.lookups import is_bounded
    key = [key] if isinstance(key, str) else list(key)
    repeated = source_key_repeats(source, key)
    if is_bounded(repeated.select(*key)):
        # usual case: few or no repeated keys. Stream the target's key
        # columns past them (map-side) instead of shuffling the target.
        hit = target.select(*key).join(F.broadcast(repeated.select(*key)), key, "left_semi")
        return repeated.join(hit.dropDuplicates(key), key, "left_semi")
    return repeated.join(target.select(*key), key, "left_semi")
