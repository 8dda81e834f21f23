from stellate.functions.casts import strict_decimal, apply_type_hints, money
from stellate.functions.months import month_of_url, validate_month, month_range_filter, bad_month_rows
from stellate.functions.formatting import report_line
from stellate.functions.columns import flatten, snake_case, normalize_names, union_with_growth

__all__ = [
    "strict_decimal", "apply_type_hints", "money", "month_of_url", "validate_month",
    "month_range_filter", "bad_month_rows", "report_line", "flatten", "snake_case",
    "normalize_names", "union_with_growth",
]
