"""Route codes and ordered keyword classification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import _col, try_integer


# Codes that start with one of these are names, not numbers; the separator joins combined routes.
ROUTE_PREFIXES = ("R", "N")
ROUTE_SEPARATOR = "/"


def canonical_route(c, keep_prefixes=ROUTE_PREFIXES, separator: str = ROUTE_SEPARATOR) -> Column:
    """Canonical route code.

    * text starting with one of `keep_prefixes` (case-insensitive) is kept, trimmed,
      a separator in it included ('R4/R5' stays 'R4/R5');
    * anything else is the number before the first `separator`: '005/006' and
      '005' -> '5', '5.6' -> '6', NULL if that isn't one.

    The input is not trimmed before the test, so ' R4' is not a prefixed code and gives NULL.
    """
    c = _col(c)
    prefixed = reduce(lambda a, b: a | b, [F.startswith(F.upper(c), F.lit(p.upper())) for p in keep_prefixes])
    number = try_integer(F.split_part(c, F.lit(separator), F.lit(1)))
    return F.when(prefixed, F.trim(c)).otherwise(number.cast("string"))


def combined_flag(c, separator: str = "/") -> Column:
    """True when the raw code names several routes ('005/006'); NULL input gives False."""
    return F.coalesce(_col(c).contains(separator), F.lit(False))


def keyword_classify(c, rules, otherwise=None, upper: bool = True) -> Column:
    """Ordered LIKE rules; the first matching category wins.

    `rules` is a sequence of (category, patterns).  Unmatched text (and NULL)
    passes through unchanged unless `otherwise` is given.
    """
    c = _col(c)
    probe = F.upper(c) if upper else c
    expr = None
    for category, patterns in rules:
        cond = reduce(lambda a, b: a | b, [probe.like(p) for p in patterns])
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    fallback = c if otherwise is None else (otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
    return fallback if expr is None else expr.otherwise(fallback)


def excluded(c, names) -> Column:
    """True for rows whose upper(trim(c)) is one of `names` (NULL stays NULL)."""
    return F.upper(F.trim(_col(c))).isin(list(names))
