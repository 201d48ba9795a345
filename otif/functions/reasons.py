"""Ordered, de-duplicated reason arrays (PRJ-15).

A rule is ``(condition, reason)``. A null condition counts as not violated.
All rules of a table compile into one projection, so the plan stays a single
codegen stage instead of one ``array_union`` per rule.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

def empty_reasons() -> Column:
    return F.array().cast("array<string>")


def reasons(rules: Iterable[tuple[Column, str]]) -> Column:
    """Array of the reasons whose condition is true, in rule order."""
    rules = list(rules)
    if not rules:
        return empty_reasons()
    flagged = [F.when(cond, F.lit(reason)) for cond, reason in rules]
    listed = F.array_except(F.array(*flagged), F.array(F.lit(None).cast("string")))  # distinct, without nulls, compiled
    # Most rows break no rule: no array is built and searched for them.
    return F.when(F.coalesce(*flagged).isNull(), empty_reasons()).otherwise(listed)


def append_reasons(existing: Column, rules: Iterable[tuple[Column, str]]) -> Column:
    """``existing`` ∪ new reasons, keeping first-seen order (array_union semantics)."""
    return F.array_union(F.coalesce(existing, empty_reasons()), reasons(rules))


def has_reasons(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.size(col), F.lit(0)) > 0
