"""Quality flags: ordered rules per column, one score per record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OK = "ok"
CRITICAL = "critical"
WARNING = "warning"
CLEAN = "clean"
SCORE = "quality_record"

Rules = Sequence[tuple[Column, str]]


def flag(rules: Rules, default: str = OK) -> Column:
    """First rule that holds names the flag.  A NULL condition does not hold."""
    (first, label), *rest = rules
    chain = reduce(lambda c, rule: c.when(*rule), rest, F.when(first, label))
    return chain.otherwise(default)


def in_range(col: Column, low: float, high: float) -> Column:
    """Closed interval, NULL for NULL."""
    return col.between(low, high)


def number_rules(
    col: Column,
    *,
    above: float | None = None,
    at_least: float | None = None,
    bad: str = "invalid_value",
    limits: tuple[float | None, float | None] = (None, None),
) -> list[tuple[Column, str]]:
    """Null, sign and business-range rules for one number, in this order."""
    rules = [(col.isNull(), "null_in_source")]
    if above is not None:
        rules.append((col <= above, bad))
    if at_least is not None:
        rules.append((col < at_least, bad))
    low, high = limits
    if high is not None:
        rules.append((col > high, "out_of_range"))
    if low is not None:
        rules.append((col < low, "out_of_range"))
    return rules


def reference_rules(
    value: Column, found: Column, wrong_role: Column, wrong_label: str,
    null_label: str = "null_in_source", missing_label: str = "referential_integrity_fail",
) -> list[tuple[Column, str]]:
    """Null test, then missing parent, then parent in the wrong role.  The order matters."""
    return [(value.isNull(), null_label), (found.isNull(), missing_label), (wrong_role, wrong_label)]


def score(
    critical: Mapping[str, Sequence[str]] | Sequence[str],
    warning: Mapping[str, Sequence[str]] | Sequence[str] = (),
) -> Column:
    """Record score from flag columns.

    Each argument lists flag columns, or maps a flag column to the labels it may carry without
    lowering the score (``ok`` alone by default).
    """

    def any_bad(spec) -> Column | None:
        allowed = spec if isinstance(spec, Mapping) else {c: (OK,) for c in spec}
        tests = [~F.col(c).isin(*labels) for c, labels in allowed.items()]
        return reduce(lambda a, b: a | b, tests) if tests else None

    chain = F.when(any_bad(critical), CRITICAL)
    soft = any_bad(warning)
    if soft is not None:
        chain = chain.when(soft, WARNING)
    return chain.otherwise(CLEAN)


def usable(df: DataFrame) -> DataFrame:
    """Rows fit for facts: scored, and not critical (a NULL score is dropped too)."""
    return df.filter(F.col(SCORE) != CRITICAL)
