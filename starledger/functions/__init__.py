from starledger.functions.fields import (
    int_field,
    double_field,
    multi_value,
    split_fields,
    trim_controls,
)
from starledger.functions.months import register_month_functions, year_month, year_month_text

__all__ = [
    "double_field",
    "int_field",
    "multi_value",
    "register_month_functions",
    "split_fields",
    "trim_controls",
    "year_month",
    "year_month_text",
]
