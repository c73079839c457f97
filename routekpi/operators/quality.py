"""Data-quality checks and the gate that stops bad staging data.

Each check is a declarative spec.  `run_checks` evaluates all checks of one
table, uniqueness too, with one scan and one exchange; the result is a small
DataFrame with one row per check.  `enforce` collects that summary (one row
per check, never table rows) and raises `QualityGateError` listing every
failing error-severity check; warn-severity failures are reported only.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = "error"
WARN = "warn"


class QualityGateError(RuntimeError):
    def __init__(self, failures):
        self.failures = list(failures)
        lines = [f"  {f['table']}.{f['check']}: {f['failures']} failing" for f in self.failures]
        super().__init__("quality gate failed:\n" + "\n".join(lines))


@dataclass(frozen=True)
class Check:
    """One data test.

    kind: not_null | accepted_values | range | non_negative | domain | unique
    `domain` fails NULL too; `accepted_values` lets NULL pass.
    """

    name: str
    kind: str
    columns: tuple
    values: tuple = ()
    low: object = None
    high: object = None
    severity: str = ERROR
    tags: tuple = field(default=())


def not_null(col: str, severity: str = ERROR) -> Check:
    return Check(f"not_null_{col}", "not_null", (col,), severity=severity)


def accepted_values(col: str, values, severity: str = ERROR) -> Check:
    return Check(f"accepted_values_{col}", "accepted_values", (col,), tuple(values), severity=severity)


def in_range(col: str, low, high, severity: str = ERROR) -> Check:
    return Check(f"range_{col}", "range", (col,), low=low, high=high, severity=severity)


def non_negative(col: str, severity: str = ERROR) -> Check:
    return Check(f"non_negative_{col}", "non_negative", (col,), severity=severity)


def domain(col: str, values, severity: str = ERROR) -> Check:
    return Check(f"domain_{col}", "domain", (col,), tuple(values), severity=severity)


def unique(*cols: str, severity: str = ERROR) -> Check:
    return Check("unique_" + "_".join(cols), "unique", tuple(cols), severity=severity)


def violation(check: Check) -> Column:
    """Row-level predicate that is true for a failing row."""
    c = F.col(check.columns[0])
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(list(check.values))
    if check.kind == "range":
        return c.isNotNull() & ((c < F.lit(check.low)) | (c > F.lit(check.high)))
    if check.kind == "non_negative":
        return c.isNotNull() & (c < 0)
    if check.kind == "domain":
        return c.isNull() | ~c.isin(list(check.values))
    raise ValueError(f"not a row-level check: {check.kind}")


def violations(df: DataFrame, check: Check) -> DataFrame:
    """The failing rows (row checks) or the duplicated keys with their count (unique)."""
    if check.kind == "unique":
        keys = list(check.columns)
        return (
            df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1)
        )
    return df.filter(violation(check))


#: Row checks whose failures one number holds as bits.
MASK_BITS = 62


def run_checks(df: DataFrame, checks, table: str) -> DataFrame:
    """Summary (table, check, kind, severity, failures) for all `checks` of one table.

    One scan and one exchange: a row becomes one small entry per uniqueness check
    (its number and 128 bits of hash of the key, if no key column is NULL) and one
    with the bits of the row checks it fails (if any).  Equal entries are counted in
    the map tasks first, so neither a key nor a failure that a third of all rows
    share is one task's.  `violations` lists the failing rows or keys themselves.
    """
    masks = [[c for c in checks if c.kind != "unique"][at : at + MASK_BITS] for at in range(0, sum(c.kind != "unique" for c in checks), MASK_BITS)]
    uniques = [c for c in checks if c.kind == "unique"]
    entry = lambda number, a, b: F.struct(F.lit(number).alias("number"), a.alias("a"), b.alias("b"))
    entries = []
    for m, some in enumerate(masks):
        bits = reduce(lambda x, y: x.bitwiseOR(y), [F.when(violation(c), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, c in enumerate(some)])
        entries.append(F.when(bits != 0, entry(-1 - m, bits, F.lit(0).cast("long"))))
    for u, c in enumerate(uniques):
        keys = [F.col(k) for k in c.columns]
        present = reduce(lambda x, y: x & y, [k.isNotNull() for k in keys])
        entries.append(F.when(present, entry(u, F.xxhash64(F.lit(2 * u), *keys), F.xxhash64(F.lit(2 * u + 1), *keys))))
    counted = df.select(F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL").select("e.*")
    counted = counted.groupBy("number", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    totals = {}
    for m, some in enumerate(masks):
        for i, c in enumerate(some):
            totals[c.name] = F.sum(F.when((F.col("number") == -1 - m) & (F.col("a").bitwiseAND(F.lit(1 << i).cast("long")) != 0), F.col("n")))
    for u, c in enumerate(uniques):
        totals[c.name] = F.count_if((F.col("number") == u) & (F.col("n") > 1))
    held = counted.agg(*[F.coalesce(totals[c.name], F.lit(0)).cast("long").alias(f"c{i}") for i, c in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(c.name).alias("check"), F.lit(c.kind).alias("kind"), F.lit(c.severity).alias("severity"), F.col(f"c{i}").alias("failures"))
        for i, c in enumerate(checks)
    ])
    return held.select(F.lit(table).alias("table"), F.inline(rows)).withColumn(
        "status",
        F.when(F.col("failures") == 0, F.lit("pass"))
        .when(F.col("severity") == WARN, F.lit("warn"))
        .otherwise(F.lit("fail")),
    )


def enforce(summary: DataFrame):
    """Collect the (small) summary and raise on any failing error check."""
    rows = [r.asDict() for r in summary.collect()]
    failing = [r for r in rows if r["status"] == "fail"]
    if failing:
        raise QualityGateError(failing)
    return rows
