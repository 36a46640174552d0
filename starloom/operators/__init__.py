from .aggregates import (distinct_rows, drop_null_any, drop_null_subset, group_avg, group_avg_min_max, row_count,
                         share_of_total, union_all)
from .joins import bounded_broadcast, fk_lookup, label_join, outer_chain, union_distinct_keys
from .keys import add_surrogate_key
from .profile import drop_sparse_columns, profile_columns, profile_examples, sparse_columns
from .quality import natural_key_duplicates, pk_check, star_coverage, star_join_sql
from .reshape import pivot_sum, unpivot_then_pivot, unpivot_years, value_columns

__all__ = ["distinct_rows", "drop_null_any", "drop_null_subset", "group_avg", "group_avg_min_max", "row_count",
           "share_of_total", "union_all", "bounded_broadcast", "fk_lookup", "label_join", "outer_chain",
           "union_distinct_keys", "add_surrogate_key", "drop_sparse_columns", "profile_columns", "profile_examples",
           "sparse_columns", "natural_key_duplicates", "pk_check", "star_coverage", "star_join_sql", "pivot_sum",
           "unpivot_then_pivot", "unpivot_years", "value_columns"]
