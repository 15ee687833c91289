"""Constraint checks that report, or stop the load."""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ConstraintViolation(ValueError):
    """A load in ``fail`` mode met rows that break a rule."""


@dataclass(frozen=True)
class Rules:
    """What a table must satisfy. ``checks`` maps a rule name to a condition every row must meet."""

    not_null: tuple[str, ...] = ()
    checks: dict[str, Column] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: tuple[tuple[str, DataFrame, str], ...] = ()


def _row_rules(rules: Rules) -> dict[str, Column]:
    """Rule name -> condition that marks a violating row. As in SQL, an unknown check passes."""
    broken = {f"not_null:{c}": F.col(c).isNull() for c in rules.not_null}
    broken |= {f"check:{name}": ~condition for name, condition in rules.checks.items()}
    broken |= {f"length:{c}": F.length(c) > n for c, n in rules.lengths.items()}
    return broken


def check_constraints(df: DataFrame, rules: Rules) -> DataFrame:
    """(rule, violations) for every rule.

    All row rules share one pass. Key rules first shrink the table to one row per key value, so a
    value that fills a third of the table is a single row by the time it is joined.
    """
    reports = []
    row_rules = _row_rules(rules)
    if row_rules:
        totals = df.agg(*[F.count_if(cond).alias(f"r{i}") for i, cond in enumerate(row_rules.values())])
        rows = [
            F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations"))
            for i, name in enumerate(row_rules)
        ]
        reports.append(totals.select(F.inline(F.array(*rows))))
    for keys in rules.unique:
        surplus = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("n")).filter(F.col("n") > 0)
        reports.append(_total(surplus, f"unique:{','.join(keys)}"))
    for column, parent, parent_column in rules.foreign:
        values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        known = parent.select(F.col(parent_column).alias(column))
        reports.append(_total(values.join(known, column, "left_anti"), f"foreign:{column}"))
    return reduce(DataFrame.unionByName, reports)


def _total(df: DataFrame, rule: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(F.lit(rule).alias("rule"), "violations")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose key is unknown to the parent."""
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.join(known, column, "left_anti").select(*child.columns)


def enforce(df: DataFrame, rules: Rules, mode: str = "fail") -> DataFrame:
    """The report; in ``fail`` mode broken rules raise. The report has one row per rule."""
    report = check_constraints(df, rules)
    if mode == "fail":
        broken = report.filter(F.col("violations") > 0).collect()
        if broken:
            raise ConstraintViolation(", ".join(f"{r['rule']}={r['violations']}" for r in sorted(broken)))
    elif mode != "report":
        raise ValueError(f"unknown mode {mode!r}")
    return report
