"""DataFrame -> DataFrame operators (use directly or with ``df.transform``)."""

from kestrel.operators.dedup import distinct_rows, distinct_values, drop_duplicates
from kestrel.operators.filters import (collapse_to_binary, drop_nan_rows, drop_nulls,
                                       drop_rare_values, exclude_equal, exclude_values,
                                       keep_equal, rare_values)
from kestrel.operators.columns import (column_distinct_counts, column_profile, constant_columns,
                                       drop_constant_columns, feature_columns, table_shape)
from kestrel.operators.stats import category_stats, total, value_counts
from kestrel.operators.sampling import (cap_value, cap_values, first_n, hash_split, last_n,
                                        random_split, rebalance, relabel_first)
from kestrel.operators.metrics import binary_metrics
from kestrel.operators.latest import latest_only, latest_window

__all__ = [n for n in dir() if not n.startswith("_")]
