"""Table constraints as a report (K8): unique key, not-null key, text length,
numeric precision.  A database would reject a whole load on the first violation;
here every violation is counted, per constraint and column, and ``require`` stops
a load that has any.

A typed column cannot hold a value that does not fit, so precision is checked
from what the scan noted before the cast (``feed.UNFIT``), or on columns that
are still text or wider numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.feed import UNFIT


class ConstraintError(ValueError):
    """A load that breaks constraints of its table."""


def require(report: DataFrame, table: str) -> None:
    """Raise if a report of ``check_schema`` (one row per check) has violations."""
    broken = report.filter("violations > 0").collect()
    if broken:
        raise ConstraintError(f"{table}: " + ", ".join(f"{r['check_name']}({r['column_name']}) x {r['violations']}" for r in broken))


def row_checks(df: DataFrame, key: str, text_limits: dict[str, int],
               numeric: dict[str, str] | None = None, not_null: list[str] | None = None) -> list[tuple[str, str, Column]]:
    """(check_name, column_name, aggregate of its violations) of the checks that need single rows only."""
    numeric = numeric or {c: f.dataType.simpleString() for c in [f.name for f in df.schema.fields]
                          for f in [df.schema[c]] if isinstance(f.dataType, T.DecimalType)}
    not_null = not_null or [key]
    checks = []
    for c in not_null:
        checks.append(("not_null", c, F.count_if(F.col(c).isNull())))
    for c, n in sorted(text_limits.items()):
        if c in df.columns:
            checks.append((f"max_length_{n}", c, F.count_if(F.length(F.col(c)) > n)))
    for c, t in sorted(numeric.items()):
        if c in df.columns:
            broken = F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()
            if UNFIT in df.columns:
                broken = broken | F.coalesce(F.array_contains(UNFIT, c), F.lit(False))
            checks.append((f"fits_{t}", c, F.count_if(broken)))
    return checks


def observed(checks: list[tuple[str, str, Column]]) -> list[Column]:
    """The checks as metrics of an Observation, for a job that reads the rows anyway."""
    return [expr.cast("long").alias(f"_check_{i}") for i, (_, _, expr) in enumerate(checks)]


def require_observed(checks: list[tuple[str, str, Column]], metrics: dict, table: str) -> None:
    """Raise if the metrics of ``observed`` show violations."""
    broken = [(name, col, metrics[f"_check_{i}"]) for i, (name, col, _) in enumerate(checks) if metrics[f"_check_{i}"]]
    if broken:
        raise ConstraintError(f"{table}: " + ", ".join(f"{name}({col}) x {n}" for name, col, n in broken))


def check_schema(df: DataFrame, key: str, text_limits: dict[str, int],
                 numeric: dict[str, str] | None = None, not_null: list[str] | None = None) -> DataFrame:
    """(check_name, column_name, violations) - one row per check, zero included.

    One global aggregate for the row-level checks and one keyed aggregate
    (partial per task, so a hot key is cheap) for uniqueness.
    """
    checks = row_checks(df, key, text_limits, numeric, not_null)
    row = df.agg(*[expr.cast("long").alias(f"_{i}") for i, (_, _, expr) in enumerate(checks)])
    pairs = ", ".join(f"'{name}', '{col}', `_{i}`" for i, (name, col, _) in enumerate(checks))
    counted = row.select(F.expr(f"stack({len(checks)}, {pairs}) AS (check_name, column_name, violations)"))
    dup = (df.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") > 1)
           .agg(F.count(F.lit(1)).cast("long").alias("violations"))
           .select(F.lit("unique").alias("check_name"), F.lit(key).alias("column_name"), "violations"))
    return counted.unionByName(dup)
