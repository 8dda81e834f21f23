from stellate.sources.store import TableStore, TableNotFound, Change
from stellate.sources.csv import read_csv, write_csv, source_path
from stellate.sources.staging import (
    LoadInfo, add_lineage, new_load_id, stage, stage_csv_dir, load_report, select_resources,
)

__all__ = [
    "TableStore", "TableNotFound", "Change", "read_csv", "write_csv", "source_path",
    "LoadInfo", "add_lineage", "new_load_id", "stage", "stage_csv_dir", "load_report",
    "select_resources",
]
