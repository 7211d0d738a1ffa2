"""Column-expression helpers; everything here returns a ``Column``."""

from riskloom.functions.expr import (  # noqa: F401
    cut,
    is_numeric,
    numeric_columns,
    null_propagating_sum,
    null_skipping_sum,
    string_columns,
    value_map,
    yes_no,
)
