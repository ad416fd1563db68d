"""Data-quality rules: run all of them in one pass, report, split or refuse."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """Raised when a gate refuses a frame."""


@dataclass(frozen=True)
class Rule:
    """``failed`` is SQL text that is true for a bad row; null counts as good."""

    name: str
    failed: str

    def bad(self) -> Column:
        return F.coalesce(F.expr(self.failed), F.lit(False))


def not_null(column: str) -> Rule:
    return Rule(f"not_null({column})", f"`{column}` IS NULL")


def in_set(column: str, values: Sequence[str]) -> Rule:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return Rule(f"in_set({column})", f"`{column}` NOT IN ({listed})")


def check(name: str, expression: str) -> Rule:
    """A CHECK constraint: only a false result fails, a null one passes."""
    return Rule(name, f"NOT ({expression})")


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rows checked, rows failed, success. One scan for all rules."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(r.bad()).alias(f"_f{i}") for i, r in enumerate(rules)]
    )
    results = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.col("_rows").alias("checked"),
                F.col(f"_f{i}").alias("failed"),
                (F.col(f"_f{i}") == 0).alias("success"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(F.explode(results).alias("r")).select("r.*")


def unexpected(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """The distinct values outside the set, with their row counts."""
    return df.filter(in_set(column, values).bad()).groupBy(column).agg(F.count("*").alias("n_rows"))


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows); both are filters over the same scan."""
    bad = reduce(Column.__or__, [r.bad() for r in rules])
    return df.filter(~bad), df.filter(bad)


def enforce(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The frame itself, or QualityError naming the rules that failed."""
    broken = [r.rule for r in validate(df, rules).filter(~F.col("success")).collect()]
    if broken:
        raise QualityError("failed rules: " + ", ".join(sorted(broken)))
    return df


def profile(df: DataFrame) -> DataFrame:
    """Per column: rows, nulls, distinct values, smallest and largest as text.

    Distinct counting goes over (column, value) pairs with map-side combine,
    one shuffle for all columns; a value that fills a column is one pair per task.
    """
    names = df.columns
    pairs = F.array(
        *[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in names]
    )
    values = (
        df.select(F.explode(pairs).alias("p"))
        .groupBy(F.col("p.c").alias("column_name"), F.col("p.v").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    counts = values.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.count("value").alias("n_distinct"),
    )
    ends = df.agg(
        *[F.min(c).cast("string").alias(f"lo_{i}") for i, c in enumerate(names)],
        *[F.max(c).cast("string").alias(f"hi_{i}") for i, c in enumerate(names)],
    )
    bounds = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"lo_{i}").alias("lowest"), F.col(f"hi_{i}").alias("highest"))
            for i, c in enumerate(names)
        ]
    )
    return counts.join(ends.select(F.explode(bounds).alias("b")).select("b.*"), "column_name")
