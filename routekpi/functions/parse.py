"""Safe text parsing: every bad value becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import NULL_TOKENS, UNIT_STRIP_PATTERN


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c, tokens=NULL_TOKENS) -> Column:
    """Map the load-time null tokens (case-exact) to NULL."""
    c = _col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def null_token_frame(df, columns=None, tokens=NULL_TOKENS):
    """`null_tokens` on many text columns of a frame in one projection."""
    cols = list(columns) if columns is not None else [f.name for f in df.schema.fields]
    return df.na.replace(list(tokens), None, subset=cols)


def try_integer(c) -> Column:
    """Integer parse that rounds half-up ('5.7' -> 6) and yields NULL on bad text.

    Parsed through DECIMAL(38,0) rather than INT: an INT cast would reject
    '5.7' instead of rounding it.
    """
    return _col(c).try_cast("decimal(38,0)")


def try_int(c) -> Column:
    """`try_integer` narrowed to INT (NULL when out of range)."""
    return try_integer(c).try_cast("int")


def try_decimal(c, precision: int, scale: int) -> Column:
    """Decimal parse with HALF_UP rounding to `scale`; overflow and bad text give NULL."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def try_double(c) -> Column:
    return _col(c).try_cast("double")


def strip_units(c, pattern: str = UNIT_STRIP_PATTERN) -> Column:
    """Remove every character that is not a digit, '.' or '-' ('1,234 km' -> '1234')."""
    return F.regexp_replace(_col(c), pattern, "")


def parse_with_units(c, precision: int, scale: int) -> Column:
    return try_decimal(strip_units(c), precision, scale)


def blank_default(c, default) -> Column:
    """coalesce(nullif(trim(c), ''), default)."""
    trimmed = F.trim(_col(c))
    d = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.when(trimmed != "", trimmed), d)
