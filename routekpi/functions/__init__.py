"""Column functions (Column -> Column); all JVM-side built-ins, no UDFs."""

from .codes import canonical_route, combined_flag, excluded, keyword_classify
from .metrics import (
    capped,
    density,
    gap_components,
    gap_score,
    guarded_ratio,
    index_to,
    pct_change,
    severity_tier,
    weighted_score,
    year_flag,
)
from .parse import (
    blank_default,
    null_tokens,
    parse_with_units,
    strip_units,
    try_decimal,
    try_double,
    try_int,
    try_integer,
)

__all__ = [
    "blank_default", "canonical_route", "capped", "combined_flag", "density", "excluded",
    "gap_components", "gap_score", "guarded_ratio", "index_to", "keyword_classify",
    "null_tokens", "parse_with_units", "pct_change", "severity_tier", "strip_units",
    "try_decimal", "try_double", "try_int", "try_integer", "weighted_score", "year_flag",
]
