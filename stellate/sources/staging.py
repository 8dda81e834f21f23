"""Staging loads: replace / append dispositions, lineage columns, load report,
resource choice."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stellate.sources.csv import read_csv, source_path
from stellate.sources.store import Change, TableStore

# Staging tables of the reference's CSV pipeline (fixed values).
STAGING_TABLES = ("customer", "country", "product", "sales_transactions")


@dataclass(frozen=True)
class LoadInfo:
    table: str
    load_id: str
    rows: int
    disposition: str


def new_load_id() -> str:
    """Load ids sort by time: epoch seconds with microseconds plus a suffix."""
    return f"{time.time():.6f}-{uuid.uuid4().hex[:6]}"


def row_ids() -> Column:
    """A UUID (version 8) per row: the digits of one load are drawn once, the
    last 60 bits number its rows by partition and place. Unlike ``uuid()``, the
    ids of a load share their first half, so they cost files and shuffles little."""
    drawn = uuid.uuid4().hex
    number = F.lower(F.lpad(F.hex(F.monotonically_increasing_id()), 15, "0"))
    return F.concat(F.lit(f"{drawn[:8]}-{drawn[8:12]}-8{drawn[13:16]}-8"), F.substring(number, 1, 3), F.lit("-"), F.substring(number, 4, 12))


def add_lineage(df: DataFrame, load_id: str, row_id: str = "uuid") -> DataFrame:
    """Add ``_load_id`` and ``_row_id`` to every row.

    ``row_id="uuid"`` gives a unique id per row (also for duplicate rows);
    ``row_id="content"`` gives a repeatable SHA-256 of the row's JSON, shared
    by identical rows.
    """
    if row_id == "uuid":
        rid = row_ids()
    elif row_id == "content":
        rid = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]),
                             {"ignoreNullFields": "false"}), 256)
    else:
        raise ValueError(row_id)
    return df.withColumn("_load_id", F.lit(load_id)).withColumn("_row_id", rid)


def stage(store: TableStore, table: str, df: DataFrame, *, disposition: str = "replace",
          load_id: str | None = None, namespace: str = "staging", lineage: bool = True,
          publish: bool = True) -> tuple[LoadInfo, Change]:
    """Write ``df`` to ``namespace.table``. ``replace``: the table holds
    exactly this input afterwards; ``append``: rows are added, no
    de-duplication. The row count is observed during the write (no extra
    pass)."""
    if disposition not in ("replace", "append"):
        raise ValueError(disposition)
    load_id = load_id or new_load_id()
    out = add_lineage(df, load_id) if lineage else df
    obs = Observation(f"load_{table}_{uuid.uuid4().hex[:6]}")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    qualified = f"{namespace}.{table}"
    ch = store.write_version(qualified, out)
    ch = Change(disposition, ch.path, ch.schema)
    if publish:
        store.commit({qualified: ch})
    return LoadInfo(qualified, load_id, int(obs.get["rows"]), disposition), ch


def stage_csv_dir(store: TableStore, data_dir: str | None, tables: Iterable[str] = STAGING_TABLES,
                  *, multi_line: bool = True, complete_rows: bool | None = None) -> dict[str, LoadInfo]:
    """Replace-load every named CSV of ``data_dir`` into staging."""
    out = {}
    for t in tables:
        df = read_csv(store.spark, source_path(data_dir, t), multi_line=multi_line, complete_rows=complete_rows)
        out[t], _ = stage(store, t, df, disposition="replace")
    return out


def load_report(store: TableStore, tables: Iterable[str], namespace: str = "staging") -> DataFrame:
    """One summary row per staged table and load: table, load id, rows."""
    parts = [store.read(f"{namespace}.{t}").groupBy("_load_id")
             .agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), F.col("_load_id").alias("load_id"), "row_count")
             for t in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def select_resources(builders: dict[str, Callable[[], DataFrame]], names: Iterable[str] | None = None,
                     deselected: Iterable[str] = ()) -> dict[str, Callable[[], DataFrame]]:
    """Resource choice: only the named builders, or all selected ones when no
    names are given. Builders are not called here, so unselected resources
    cost nothing."""
    if names is None:
        return {k: v for k, v in builders.items() if k not in set(deselected)}
    missing = [n for n in names if n not in builders]
    if missing:
        raise KeyError(f"unknown resources {missing}")
    return {n: builders[n] for n in names}
