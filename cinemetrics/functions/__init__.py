"""Column expressions (all JVM-side, no Python UDF)."""

from cinemetrics.functions.columns import (
    digit_split,
    map_sort_by_value,
    parse_genres,
    rating_map,
    safe_divide,
    sorted_entries_by_value,
    tolerant_double,
)

__all__ = [
    "digit_split",
    "map_sort_by_value",
    "parse_genres",
    "rating_map",
    "safe_divide",
    "sorted_entries_by_value",
    "tolerant_double",
]
