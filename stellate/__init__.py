"""stellate: a PySpark star-schema warehouse toolkit.

CSV/JSON landing files -> staging tables with load lineage -> dimension and
fact tables with dense surrogate keys -> full loads and type 1 merges with
key checks -> sales reports. Every operator is a DataFrame / Spark SQL
composition that runs on executors.
"""

from stellate.session import build_session, new_scratch_dir, recommended_conf, scratch_root
from stellate.spec import TableSpec
from stellate.sources.store import TableStore
from stellate.operators.keys import assign_dense_keys
from stellate.operators.lookups import Lookup, bounded_broadcast, lookup_keys
from stellate.operators.merge import merge_type1

__all__ = [
    "build_session", "scratch_root", "new_scratch_dir", "recommended_conf", "TableSpec", "TableStore",
    "assign_dense_keys", "Lookup", "bounded_broadcast", "lookup_keys", "merge_type1",
]
