from stellate.operators.keys import assign_dense_keys
from stellate.operators.lookups import Lookup, bounded_broadcast, lookup_keys
from stellate.operators.checks import (
    MergeCardinalityError, ConstraintViolation, pk_violations, fk_violations,
    null_counts, require_not_null, merge_cardinality_violations,
)
from stellate.operators.merge import merge_type1
from stellate.operators.nested import child_rows, explode_list

__all__ = [
    "assign_dense_keys", "Lookup", "bounded_broadcast", "lookup_keys",
    "MergeCardinalityError", "ConstraintViolation", "pk_violations", "fk_violations",
    "null_counts", "require_not_null", "merge_cardinality_violations",
    "merge_type1", "child_rows", "explode_list",
]
