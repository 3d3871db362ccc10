from riskframe.functions.core import (
    flag, safe_div, nan_to_null, row_mean, row_std, numeric_columns,
    string_columns, is_numeric_type,
)

__all__ = ["flag", "safe_div", "nan_to_null", "row_mean", "row_std",
           "numeric_columns", "string_columns", "is_numeric_type"]
