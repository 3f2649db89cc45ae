"""Data-quality rules: an aggregate or a query, compared with an expected value."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import eq, gt, lt, ne
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The comparisons a rule can make; the actual value is on the left.
COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {"=": eq, "!=": ne, "<": lt, ">": gt}


@dataclass(frozen=True)
class Rule:
    """`actual` is an aggregate over a table, or the text of a query whose first value counts."""

    name: str
    actual: Column | str
    op: str
    expected: int | float
    table: str | None = None


class QualityError(ValueError):
    """Raised when a rule fails; the message lists every failed rule."""


def row_count() -> Column:
    return F.count(F.lit(1))


def null_count(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def has_rows(table: str) -> Rule:
    return Rule(f"{table} has rows", row_count(), ">", 0, table)


def never_null(table: str, column: str) -> Rule:
    return Rule(f"{column} never null", null_count(column), "=", 0, table)


def _outcome(rule: Rule, actual: Column, value_type: str) -> Column:
    expected = F.lit(rule.expected)
    success = COMPARISONS[rule.op](actual, expected)
    return F.struct(
        F.lit(rule.name).alias("test_name"),
        actual.cast(value_type).alias("actual"),
        F.lit(rule.op).alias("op"),
        expected.cast(value_type).alias("expected"),
        F.coalesce(success, F.lit(False)).alias("success"),
    )


def run_rules(
    spark: SparkSession,
    rules: Iterable[Rule],
    tables: Mapping[str, DataFrame] | None = None,
    value_type: str | None = None,
) -> DataFrame:
    """One row per rule: test_name, actual, op, expected, success.

    A query that returns no row, or a null, has a null `actual` and fails. Values are compared as
    they are. They are reported as double, or as bigint if all rules are aggregates compared with
    whole numbers; `value_type` names another type.

    All aggregate rules of a table are worked out in one pass over it. A table that is not
    in `tables` is looked up by name.
    """
    rules = list(rules)
    whole = all(isinstance(r.expected, int) and not isinstance(r.actual, str) for r in rules)
    value_type = value_type or ("bigint" if whole else "double")
    by_table: dict[str, list[Rule]] = {}
    results = []
    for rule in rules:
        if rule.op not in COMPARISONS:
            raise ValueError(f"rule {rule.name!r}: no comparison {rule.op!r}")
        if isinstance(rule.actual, str):
            asked = spark.sql(rule.actual)
            named = asked.toDF(*(f"_{n}" for n in range(len(asked.columns))))
            # An aggregate gives one row for no rows too.
            answer = named.limit(1).agg(F.first("_0").alias("value"))
            results.append(answer.select(_outcome(rule, F.col("value"), value_type).alias("r")))
        else:
            by_table.setdefault(rule.table, []).append(rule)
    for name, of_table in by_table.items():
        rows = (tables or {}).get(name)
        rows = spark.table(name) if rows is None else rows
        outcomes = F.array(*[_outcome(rule, rule.actual, value_type) for rule in of_table])
        results.append(rows.agg(outcomes.alias("all")).select(F.explode("all").alias("r")))
    return reduce(DataFrame.unionByName, results).select("r.*")


def require(results: DataFrame) -> list:
    """The results as rows; raises if a rule failed. There are as many rows as rules."""
    return require_all(results.collect())


class Outcome(NamedTuple):
    test_name: str
    actual: int | float | None
    op: str
    expected: int | float
    success: bool


def require_all(outcomes: Sequence) -> Sequence:
    """The outcomes themselves; raises if a rule failed."""
    failed = [o for o in outcomes if not o.success]
    if failed:
        raise QualityError(
            "; ".join(f"{o.test_name}: {o.actual} should be {o.op} {o.expected}" for o in failed)
        )
    return outcomes


def observed(rows: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Callable[[], list[Outcome]]]:
    """The same rows, which work out the rules as they go by, and the outcomes to ask for once the
    rows have been written: the source is read once for both.

    Rules are aggregates of one table; counts of distinct values cannot be observed.
    """
    for rule in rules:
        if isinstance(rule.actual, str):
            raise ValueError(f"rule {rule.name!r} is a query, not an aggregate of the rows")
        if rule.op not in COMPARISONS:
            raise ValueError(f"rule {rule.name!r}: no comparison {rule.op!r}")
    observation = Observation()
    watched = rows.observe(observation, *[rule.actual.alias(f"rule_{n}") for n, rule in enumerate(rules)])

    def outcomes() -> list[Outcome]:
        values = observation.get
        found = [values.get(f"rule_{n}") for n in range(len(rules))]
        return [
            Outcome(rule.name, value, rule.op, rule.expected, value is not None and COMPARISONS[rule.op](value, rule.expected))
            for rule, value in zip(rules, found)
        ]

    return watched, outcomes


def require_rows(rows: DataFrame, name: str) -> DataFrame:
    """The frame itself; raises if it has no rows. Looks for one row, does not count."""
    if rows.isEmpty():
        raise QualityError(f"{name} has no rows")
    return rows


def repeated_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """How many key values occur more than once."""
    counts = rows.groupBy(*keys).agg(row_count().alias("n"))
    return counts.agg(F.count_if(F.col("n") > 1).alias("violations"))


def missing_values(rows: DataFrame, column: str) -> DataFrame:
    return rows.agg(null_count(column).alias("violations"))


def orphans(rows: DataFrame, foreign_key: str, parents: DataFrame, key: str) -> DataFrame:
    """How many rows have a foreign key that no parent has. A null foreign key is no violation.

    Rows are counted per foreign key before the join, so it shuffles one row per key value. Parents
    may grow with the rows: they do not go through the driver.
    """
    used = rows.groupBy(F.col(foreign_key).alias("key")).agg(row_count().alias("n"))
    unknown = used.dropna(subset=["key"]).join(
        parents.select(F.col(key).alias("key")).hint("merge"), "key", "left_anti"
    )
    return unknown.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))


def constraints(checks: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """One row per named constraint with the number of violations."""
    named = [rows.select(F.lit(name).alias("test_name"), "violations") for name, rows in checks]
    return reduce(DataFrame.unionByName, named)
