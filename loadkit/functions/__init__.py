"""Column expressions: null rules, rounding, ratios, text, classification."""

from loadkit.functions.nulls import (
    if_else3, missing_as_text, not_in, not_infinite, strict_sum, sum_or_zero)
from loadkit.functions.numeric import abs2, pct, round2, safe_ratio, signed_error
from loadkit.functions.rules import abbreviate, cap, classify, override, remainder
from loadkit.functions.text import paste, upper_all

__all__ = [
    "abbreviate", "abs2", "cap", "classify", "if_else3", "missing_as_text", "not_in",
    "not_infinite", "override", "paste", "pct", "remainder", "round2", "safe_ratio",
    "signed_error", "strict_sum", "sum_or_zero", "upper_all",
]
