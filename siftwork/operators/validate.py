"""A declarative rule engine over aggregates: checks with codes, observed values and a verdict."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """``observed`` is an aggregate over the table; the check passes where it lies within ``least`` and ``most``."""

    code: str
    observed: Column
    least: float | None = None
    most: float | None = None


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(code, observed, passed): all checks of a table in one aggregate, which is one scan. An observed null fails."""
    names = [f"_c{i}" for i in range(len(checks))]
    one = df.agg(*[c.observed.cast("double").alias(n) for c, n in zip(checks, names)])

    def passed(c: Check, n: str) -> Column:
        ok = F.lit(True)
        if c.least is not None:
            ok = ok & (F.col(n) >= c.least)
        if c.most is not None:
            ok = ok & (F.col(n) <= c.most)
        return F.coalesce(ok, F.lit(False)) & F.col(n).isNotNull()

    rows = F.explode(F.array(*[F.struct(F.lit(c.code).alias("code"), F.col(n).alias("observed"), passed(c, n).alias("passed")) for c, n in zip(checks, names)])).alias("x")
    return one.select(rows).select("x.*")


def duplicates(column: str) -> Column:
    return F.count(column) - F.count_distinct(column)


def violations(bad: Column) -> Column:
    """Rows for which the predicate holds; null counts as a violation."""
    return F.count_if(F.coalesce(bad, F.lit(True)))


def vector_checks(column: str, width: int, tolerance: float = 0.01) -> list[Check]:
    """Width, finiteness and unit norm of vectors."""
    from siftwork.functions.values import norm

    n = norm(column)
    return [
        Check("VECTOR_WIDTH", violations(F.size(column) != width), most=0),
        Check("VECTOR_NOT_FINITE", violations(F.exists(column, lambda x: F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))), most=0),
        Check("VECTOR_NORM", F.max(F.abs(n - 1)), most=tolerance),
    ]


def verdict(report: DataFrame) -> DataFrame:
    """(verdict, failed): PASS or FAIL and the failing codes, sorted."""
    return report.agg(F.when(F.coalesce(F.every("passed"), F.lit(True)), "PASS").otherwise("FAIL").alias("verdict"), F.array_join(F.array_sort(F.collect_set(F.when(~F.col("passed"), F.col("code")))), "|").alias("failed"))


def require(df: DataFrame, ok: Column, message: str) -> DataFrame:
    """``df`` unchanged; a row for which ``ok`` isn't true is an error at run time."""
    return df.where(F.when(F.coalesce(ok, F.lit(False)), True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))
