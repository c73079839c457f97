"""KPI expressions: guarded ratios, indices, tiers and the composite score.

All arithmetic stays in DECIMAL (inputs are decimals parsed from text) and is
rounded once, at the end, HALF_UP -- the numeric behaviour of the source
warehouse.  Literals that take part in decimal arithmetic are passed as
`Decimal`/int, never as Python floats (a float literal would turn the whole
expression into DOUBLE).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import (
    GAP_CAP_OVERCROWDING,
    GAP_CAP_PEAK_LOAD,
    GAP_WEIGHT_OVERCROWDING,
    GAP_WEIGHT_PEAK_LOAD,
    GAP_WEIGHT_UTILIZATION,
    SEVERITY_BANDS,
    SEVERITY_LOW,
    SEVERITY_UNKNOWN,
)
from .parse import _col


def _lit(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, float):
        v = Decimal(str(v))
    return F.lit(v)


def guarded_ratio(num, den) -> Column:
    """num / den when den > 0, else NULL (never divides by zero)."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, num / den)


def index_to(value, base, scale: int = 1, require_value: bool = False) -> Column:
    """round(value / base * 100, scale), NULL unless base > 0 (base = 100 index)."""
    value, base = _col(value), _col(base)
    cond = base > 0
    if require_value:
        cond = cond & value.isNotNull()
    return F.when(cond, F.round(value / base * 100, scale))


def pct_change(value, prior, scale: int = 2) -> Column:
    """round((value - prior) / prior * 100, scale), NULL unless prior > 0."""
    value, prior = _col(value), _col(prior)
    return F.when(prior > 0, F.round((value - prior) / prior * 100, scale))


def severity_tier(c, bands=SEVERITY_BANDS, low: str = SEVERITY_LOW, unknown: str = SEVERITY_UNKNOWN) -> Column:
    """Ordered tiers: NULL -> unknown, then the first band whose lower bound is reached."""
    c = _col(c)
    expr = F.when(c.isNull(), F.lit(unknown))
    for bound, label in bands:
        expr = expr.when(c >= _lit(bound), F.lit(label))
    return expr.otherwise(F.lit(low))


def capped(c, cap) -> Column:
    """least(c, cap) that stays NULL for a NULL input (Spark's least skips NULLs)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.least(c, _lit(cap)))


def gap_components(pct, peak_load_factor, utilization):
    """Unrounded components of the service gap score, each on a 0-100 scale.

    overcrowding = least(pct, 100); peak load = least(plf * 100, 150) / 150 * 100;
    utilization = util * 100 (not capped).
    """
    c1 = capped(pct, GAP_CAP_OVERCROWDING)
    c2 = capped(_col(peak_load_factor) * 100, GAP_CAP_PEAK_LOAD) / GAP_CAP_PEAK_LOAD * 100
    c3 = _col(utilization) * 100
    return c1, c2, c3


def weighted_score(terms, scale: int = 2) -> Column:
    """round(sum of already weighted terms, scale)."""
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.round(total, scale)


def gap_score(pct, peak_load_factor, utilization,
              weights=(GAP_WEIGHT_OVERCROWDING, GAP_WEIGHT_PEAK_LOAD, GAP_WEIGHT_UTILIZATION),
              scale: int = 2) -> Column:
    """round(w1 * least(pct, 100) + w2 * least(plf * 100, 150) / 150 * 100 + w3 * util * 100, scale).

    Each weight multiplies before the division, as written in the source
    formula: w2 * x / 150 is then an exact decimal, and the half-up rounding
    of the sum is exact too.
    """
    w1, w2, w3 = (_lit(w) for w in weights)
    t1 = w1 * capped(pct, GAP_CAP_OVERCROWDING)
    t2 = w2 * capped(_col(peak_load_factor) * 100, GAP_CAP_PEAK_LOAD) / GAP_CAP_PEAK_LOAD * 100
    t3 = w3 * _col(utilization) * 100
    return weighted_score([t1, t2, t3], scale)


def density(population, area, scale: int = 1) -> Column:
    """round(population / nullif(area, 0), scale) on decimals (integer inputs are widened)."""
    pop = _col(population).cast("decimal(18,0)")
    ar = _col(area).cast("decimal(18,0)")
    return F.round(pop / F.when(ar != 0, ar), scale)


def year_flag(year, flag_year) -> Column:
    return _col(year) == F.lit(flag_year)
