"""Declared data-quality rules, evaluated as aggregates. A failed rule is a finding, no error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class IsComplete:
    """No NULL in the column. Observed: the share of rows with a value."""

    column: str

    @property
    def name(self) -> str:
        return f'IsComplete "{self.column}"'

    def measure(self) -> Column:
        return F.count(self.column)

    def passed(self, measured: Column, rows: Column) -> Column:
        return measured == rows

    def observed(self, measured: Column, rows: Column) -> Column:
        return measured / rows


@dataclass(frozen=True)
class Positive:
    """Every value above zero. NULL and text that is no number are left to IsComplete.

    Observed: the number of violations.
    """

    column: str

    @property
    def name(self) -> str:
        return f'ColumnValues "{self.column}" > 0'

    def measure(self) -> Column:
        return F.count_if(F.col(self.column).try_cast("double") <= 0)

    def passed(self, measured: Column, rows: Column) -> Column:
        return measured == 0

    def observed(self, measured: Column, rows: Column) -> Column:
        return measured.cast("double")


@dataclass(frozen=True)
class Uniqueness:
    """Values that occur exactly once, as a share of all rows."""

    column: str
    threshold: float = 1.0

    @property
    def name(self) -> str:
        return f'Uniqueness "{self.column}" = {self.threshold}'

    def measure(self) -> Column:
        """Over rows already counted per value."""
        return F.count_if((F.col("_n") == 1) & F.col(self.column).isNotNull())

    def passed(self, measured: Column, rows: Column) -> Column:
        return measured / rows >= self.threshold

    def observed(self, measured: Column, rows: Column) -> Column:
        return measured / rows


Rule = IsComplete | Positive | Uniqueness

# The standing rulesets of the lake.
ORDERS_RULES: tuple[Rule, ...] = (
    IsComplete("customer_id"),
    Uniqueness("order_id"),
    Positive("quantity"),
)
PRODUCTS_RULES: tuple[Rule, ...] = (Positive("price"),)


def _measured(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: the row count and the measure of every rule, from a single scan.

    With a uniqueness rule the rows are counted per value first. The other measures
    are counts as well, so they are taken in the same grouping and added up. A hot
    value is combined before the shuffle.
    """
    unique = [(i, rule) for i, rule in enumerate(rules) if isinstance(rule, Uniqueness)]
    others = [(i, rule) for i, rule in enumerate(rules) if not isinstance(rule, Uniqueness)]
    if len(unique) > 1:
        raise ValueError("a single scan measures one uniqueness rule; split the ruleset")
    rule_measures = [rule.measure().alias(f"_m{i}") for i, rule in others]
    if not unique:
        return frame.agg(F.count("*").alias("_rows"), *rule_measures)
    position, rule = unique[0]
    per_value = frame.groupBy(rule.column).agg(F.count("*").alias("_n"), *rule_measures)
    return per_value.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
        *[F.coalesce(F.sum(f"_m{i}"), F.lit(0)).alias(f"_m{i}") for i, _ in others],
        rule.measure().alias(f"_m{position}"),
    )


def uniqueness(frame: DataFrame, column: str) -> DataFrame:
    """(rows, values_once, uniqueness)."""
    rule = Uniqueness(column)
    rows, once = F.col("_rows"), F.col("_m0")
    return _measured(frame, [rule]).select(
        rows.alias("rows"),
        once.alias("values_once"),
        rule.observed(once, rows).alias("uniqueness"),
    )


def dq_results(tables: Mapping[str, tuple[DataFrame, Sequence[Rule]]]) -> DataFrame:
    """One row per rule: (ruleset, rule, passed, observed). Each table is scanned once per
    uniqueness rule, and once in all if it has at most one."""
    parts = []
    for ruleset, (frame, rules) in tables.items():
        for group in _scans(rules):
            rows = F.col("_rows")
            results = [
                F.struct(
                    F.lit(ruleset).alias("ruleset"),
                    F.lit(rule.name).alias("rule"),
                    rule.passed(F.col(f"_m{i}"), rows).alias("passed"),
                    rule.observed(F.col(f"_m{i}"), rows).alias("observed"),
                )
                for i, rule in enumerate(group)
            ]
            parts.append(_measured(frame, group).select(F.inline(F.array(*results))))
    return reduce(DataFrame.unionByName, parts)


def _scans(rules: Sequence[Rule]) -> list[list[Rule]]:
    unique = [rule for rule in rules if isinstance(rule, Uniqueness)]
    others = [rule for rule in rules if not isinstance(rule, Uniqueness)]
    first = [*others, *unique[:1]]
    return [first, *[[rule] for rule in unique[1:]]]


def dq_score(results: DataFrame) -> DataFrame:
    """Passed rules as a share of all rules of a ruleset, two digits."""
    return (
        results.groupBy("ruleset")
        .agg(
            F.count("*").alias("rules"),
            F.count_if("passed").alias("rules_passed"),
            F.round(F.avg(F.col("passed").cast("int")), 2).alias("score"),
        )
        .orderBy("ruleset")
    )
