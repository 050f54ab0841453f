"""Column expressions shared by the operators; all native Spark functions."""

from tillroll.functions.expressions import (  # noqa: F401
    any_null, delay_flag, exact_mean, first_null_reason, first_value_by,
    money_sum, normalise_text, parse_ts, rounded_mean, sort_key,
)
from tillroll.functions.replicate import replicate_rows  # noqa: F401
