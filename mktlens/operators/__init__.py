"""Reusable relational operators on DataFrames."""

from mktlens.operators.aggregates import count_nonnull_rows, duplicate_keys  # noqa: F401
from mktlens.operators.joins import (  # noqa: F401
    constant_row_join, interval_aggregate, interval_join, null_aware_anti_join, unmatched_rows,
    wildcard_join,
)
from mktlens.operators.sets import union_all_by_name, unpivot_slots  # noqa: F401
from mktlens.operators.topk import top_k  # noqa: F401
from mktlens.operators.windows import (  # noqa: F401
    lag_by_sequence, lag_when, min_by_key, moving_average, row_number_by, sequence_number,
)
