from kudosflow.operators.filters import drop_incomplete
from kudosflow.operators.joins import large_join, null_safe_join, semi_join_in, split_join
from kudosflow.operators.limits import (
    Limits,
    fits_broadcast,
    frequent_values,
    measured_bytes,
    measured_sizes,
    which_fit,
)
from kudosflow.operators.membership import possible_matches
from kudosflow.operators.ranking import first_per_group, number_rows
from kudosflow.operators.views import cached_view, register_views, sql_view

__all__ = [
    "Limits",
    "cached_view",
    "drop_incomplete",
    "first_per_group",
    "fits_broadcast",
    "frequent_values",
    "large_join",
    "measured_bytes",
    "measured_sizes",
    "null_safe_join",
    "number_rows",
    "possible_matches",
    "register_views",
    "semi_join_in",
    "split_join",
    "sql_view",
    "which_fit",
]
