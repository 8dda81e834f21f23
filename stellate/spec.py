"""Table specifications: one spec replaces the reference's four near-identical
procedures per job kind."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    """A warehouse table.

    name          table name inside its namespace, e.g. ``customers_dim``
    business_key  column(s) that identify a row in the source
    columns       source columns copied into the table, in target order
    key_column    surrogate key column assigned by the warehouse (or None)
    namespace     ``dwh`` for the star, ``staging`` for raw tables
    key_order     columns that order new surrogate keys; ``None`` numbers
                  rows in input order without a shuffle (large facts)
    """

    name: str
    business_key: tuple[str, ...]
    columns: tuple[str, ...]
    key_column: str | None = None
    namespace: str = "dwh"
    lineage: tuple[str, ...] = field(default=("_load_id", "_row_id"))
    ordered_keys: bool = True

    @property
    def key_order(self) -> tuple[str, ...] | None:
        return self.business_key if self.ordered_keys else None

    @property
    def qualified(self) -> str:
        return f"{self.namespace}.{self.name}"

    @property
    def sequence_name(self) -> str:
        return f"{self.qualified}.{self.key_column}"

    def source_columns(self) -> list[str]:
        return list(self.columns) + list(self.lineage)
