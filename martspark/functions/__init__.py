"""Column expressions shared by loaders and marts (all JVM-side built-ins)."""

from martspark.functions.core import (  # noqa: F401
    add_months_py,
    bpchar,
    date_window,
    exact_div,
    months_between_whole,
    month_window,
    parse_date_text,
    prune_months,
    split_qualified_name,
    to_char_digits,
    to_int8,
    to_numeric,
    trunc_month_py,
    unify_name,
    year_window,
)
