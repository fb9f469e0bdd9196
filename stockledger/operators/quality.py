"""Data checks. Each returns the rows that break the rule; empty means pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls are ignored."""
    return check_unique_combination(df.filter(F.col(column).isNotNull()), [column])


def _out_of_range(column: str, low: float | None, high: float | None) -> Column:
    broken = F.lit(False)
    if low is not None:
        broken = broken | (F.col(column) < low)
    if high is not None:
        broken = broken | (F.col(column) > high)
    return broken


def check_range(
    df: DataFrame, column: str, min_value: float | None = None, max_value: float | None = None
) -> DataFrame:
    """Rows outside the inclusive bounds; nulls pass, either bound may be open."""
    return df.filter(_out_of_range(column, min_value, max_value))


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


@dataclass(frozen=True)
class Checks:
    """The checks of one table."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    unique_combinations: Sequence[Sequence[str]] = ()


def _row_rules(checks: Checks) -> list[tuple[str, Column]]:
    """The name of each row-wise check and what breaks it."""
    rules = [(f"not_null({name})", F.col(name).isNull()) for name in checks.not_null]
    return rules + [
        (f"range({name})", _out_of_range(name, low, high))
        for name, (low, high) in checks.ranges.items()
    ]


def _counted(rules: Sequence[tuple[str, Column]]) -> list[Column]:
    return [F.count(F.when(broken, 1)).alias(f"rule_{i}") for i, (_, broken) in enumerate(rules)]


def _keys(checks: Checks) -> list[tuple[str, Sequence[str], bool]]:
    """The name of each key check, its columns, and whether a null key may repeat."""
    return [
        *((f"unique({name})", [name], True) for name in checks.unique),
        *((f"unique({', '.join(names)})", names, False) for names in checks.unique_combinations),
    ]


def _in_one_pass(
    df: DataFrame,
    table: str,
    rules: Sequence[tuple[str, Column]],
    key: tuple[str, Sequence[str], bool] | None,
) -> DataFrame:
    """Row-wise checks and one key of a table from a single reading of it.

    Rows that break a rule are counted for each key value on the way to the values that repeat.
    """
    counted = _counted(rules)
    names = [label for label, _ in rules]
    if key is None:
        sums = df.agg(*counted)
    else:
        label, columns, nulls_repeat = key
        again = F.col("n") > 1
        if nulls_repeat:
            again = again & F.col(columns[0]).isNotNull()
        values = df.groupBy(*columns).agg(F.count("*").alias("n"), *counted)
        total = [F.coalesce(F.sum(f"rule_{i}"), F.lit(0)).alias(f"rule_{i}") for i in range(len(rules))]
        sums = values.agg(*total, F.count(F.when(again, 1)).alias(f"rule_{len(rules)}"))
        names.append(label)
    entries = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(label).alias("check_name"),
                F.col(f"rule_{i}").alias("failures"),
            )
            for i, label in enumerate(names)
        ]
    )
    return sums.select(F.inline(entries))


def _checked(df: DataFrame, table: str, checks: Checks, rules: Sequence[tuple[str, Column]]) -> list[DataFrame]:
    first, *others = _keys(checks) or [None]
    found = [_in_one_pass(df, table, rules, first)] if rules or first else []
    return found + [_in_one_pass(df, table, [], key) for key in others]


class Watch:
    """Row-wise checks that are counted while a table is written, so that it isn't read for them.

    Write ``rows`` once, then ask for the ``report``.
    """

    def __init__(self, df: DataFrame, table: str, checks: Checks):
        self.table, self.rules = table, _row_rules(checks)
        self.seen = Observation() if self.rules else None
        self.rows = df.observe(self.seen, *_counted(self.rules)) if self.rules else df

    def report(self) -> list[tuple[str, str, int]]:
        counts = self.seen.get if self.seen else {}
        return [(self.table, label, counts[f"rule_{i}"]) for i, (label, _) in enumerate(self.rules)]


def report_of(
    spark: SparkSession,
    watched: Sequence[tuple[str, str, int]],
    tables: Mapping[str, DataFrame],
    spec: Mapping[str, Checks],
) -> DataFrame:
    """One row per check: row-wise ones as they were counted in writing, keys on what was written."""
    counted = spark.createDataFrame(list(watched), "table_name string, check_name string, failures long")
    keys = [part for table, checks in spec.items() for part in _checked(tables[table], table, checks, [])]
    return reduce(DataFrame.unionByName, keys, counted)


def run_checks(tables: Mapping[str, DataFrame], spec: Mapping[str, Checks]) -> DataFrame:
    """One row per check with the number of violations.

    A table is read once for all its row-wise checks and its first key, and once for each further key.
    """
    reports = [
        part
        for table, checks in spec.items()
        for part in _checked(tables[table], table, checks, _row_rules(checks))
    ]
    return reduce(DataFrame.unionByName, reports)
