"""Expectation suites: lists of checks turned into one result row per check.

All checks that need only counts run in a single aggregate over the table. A
uniqueness check or a duplicate-row check adds one grouped count each.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    kind: str
    column: str | None = None
    params: dict[str, Any] = field(default_factory=dict, hash=False)

    def params_json(self) -> str:
        return json.dumps(self.params, sort_keys=True)


def exists(column: str) -> Check:
    return Check("column_exists", column)


def not_null(column: str, mostly: float = 1.0) -> Check:
    return Check("not_null", column, {"mostly": mostly})


def between(column: str, low: float | None = None, high: float | None = None, mostly: float = 1.0) -> Check:
    return Check("between", column, {"min": low, "max": high, "mostly": mostly})


def in_set(column: str, values: Sequence[Any], mostly: float = 1.0) -> Check:
    return Check("in_set", column, {"values": list(values), "mostly": mostly})


def unique(column: str, mostly: float = 1.0) -> Check:
    return Check("unique", column, {"mostly": mostly})


def rows_at_least(n: int) -> Check:
    return Check("rows_at_least", None, {"min": n})


def rows_distinct() -> Check:
    return Check("rows_distinct")


def not_in_future(column: str, now: str) -> Check:
    """Opt-in: no time after ``now``."""
    return Check("not_in_future", column, {"now": now, "mostly": 1.0})


def run_suite(df: DataFrame, suite: str, checks: Sequence[Check]) -> DataFrame:
    """Rows: suite, check_no, check, column, params, success, evaluated, unexpected, observed.

    Nulls do not count against range, set and uniqueness checks. ``mostly`` is the
    share of values that must pass. A check on a missing column fails.
    """
    counted, parts = [], []
    for no, check in enumerate(checks, 1):
        if check.column is not None and check.column not in df.columns:
            counted.append((no, check, F.lit(0), F.lit(0), F.lit(False)))
        elif check.kind == "column_exists":
            counted.append((no, check, F.lit(0), F.lit(0), F.lit(True)))
        elif check.kind == "rows_at_least":
            n = F.count(F.lit(1))
            counted.append((no, check, n, F.lit(0), n >= check.params["min"]))
        elif check.kind == "unique":
            parts.append(_unique_row(df, suite, no, check))
        elif check.kind == "rows_distinct":
            parts.append(_distinct_row(df, suite, no, check))
        else:
            evaluated, bad = _value_counts(check)
            counted.append((no, check, evaluated, bad, _mostly(evaluated, bad, check)))
    if counted:
        row = df.agg(*[_result(suite, *c).alias(f"c{c[0]}") for c in counted])
        parts.insert(0, row.select(F.inline(F.array(*[F.col(f"c{c[0]}") for c in counted]))))
    return reduce(DataFrame.unionByName, parts)


def _result(suite: str, no: int, check: Check, evaluated, bad, success) -> Column:
    evaluated, bad = evaluated.cast("long"), bad.cast("long")
    return F.struct(
        F.lit(suite).alias("suite"),
        F.lit(no).alias("check_no"),
        F.lit(check.kind).alias("check"),
        F.lit(check.column or "").alias("column"),
        F.lit(check.params_json()).alias("params"),
        success.alias("success"),
        evaluated.alias("evaluated"),
        bad.alias("unexpected"),
        (bad / F.nullif(evaluated.cast("double"), F.lit(0.0))).alias("unexpected_share"),
    )


def _mostly(evaluated: Column, bad: Column, check: Check) -> Column:
    """Whether enough values pass; an empty column passes."""
    share = (evaluated - bad) / F.nullif(evaluated.cast("double"), F.lit(0.0))
    return F.coalesce(share >= check.params.get("mostly", 1.0), F.lit(True))


def out_of_range(column: str | Column, low: float | None, high: float | None) -> Column:
    """True outside the closed range; null for a null value."""
    value = F.col(column) if isinstance(column, str) else column
    tests = []
    if low is not None:
        tests.append(value < low)
    if high is not None:
        tests.append(value > high)
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def _value_counts(check: Check) -> tuple[Column, Column]:
    """Counts of evaluated and unexpected values, as aggregates."""
    value = F.col(check.column)
    if check.kind == "not_null":
        return F.count(F.lit(1)), F.count_if(value.isNull())
    present = F.count(value)
    if check.kind == "between":
        return present, F.count_if(out_of_range(value, check.params["min"], check.params["max"]))
    if check.kind == "in_set":
        return present, F.count_if(~value.isin(check.params["values"]))
    if check.kind == "not_in_future":
        return present, F.count_if(value > F.lit(check.params["now"]).cast("timestamp"))
    raise ValueError(f"unknown check {check.kind!r}")


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """One row: non-null values, and those whose value occurs more than once."""
    per_value = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return per_value.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("evaluated"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("unexpected"),
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """One row: number of rows and of distinct rows (nulls compare equal)."""
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return per_row.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    )


def _unique_row(df: DataFrame, suite: str, no: int, check: Check) -> DataFrame:
    evaluated, bad = F.col("evaluated"), F.col("unexpected")
    result = _result(suite, no, check, evaluated, bad, _mostly(evaluated, bad, check))
    return duplicate_values(df, check.column).select(F.inline(F.array(result)))


def _distinct_row(df: DataFrame, suite: str, no: int, check: Check) -> DataFrame:
    rows, spare = F.col("total_rows"), F.col("total_rows") - F.col("distinct_rows")
    result = _result(suite, no, check, rows, spare, spare == 0)
    return distinct_rows(df).select(F.inline(F.array(result)))


def suite_summary(results: DataFrame, by: Sequence[str] = ("suite",)) -> DataFrame:
    """Counts, pass percent and overall success per suite. An empty group-all gives 100 %."""
    passed, total = F.count_if("success"), F.count(F.lit(1))
    return results.groupBy(*by).agg(
        total.alias("evaluated_checks"),
        passed.alias("successful_checks"),
        (total - passed).alias("failed_checks"),
        F.coalesce(passed * 100.0 / F.nullif(total.cast("double"), F.lit(0.0)), F.lit(100.0)).alias(
            "success_percent"
        ),
        F.coalesce(F.every("success"), F.lit(True)).alias("success"),
    )


def empty_results(df: DataFrame, suite: str) -> DataFrame:
    return run_suite(df, suite, [rows_at_least(0)]).limit(0)


# --- the suites ------------------------------------------------------------------------

# Allowed sets and bounds of the suites.
TRANSACTION_TYPES = ("PURCHASE", "REFUND", "TRANSFER", "WITHDRAWAL", "DEPOSIT", "FEE")
CUSTOMER_SEGMENTS = ("RETAIL", "PREMIUM", "SMB", "CORPORATE")
AMOUNT_BOUNDS = (0.01, 999_999.99)
CREDIT_BOUNDS = {
    "credit_utilization": (0.0, 5.0),
    "payment_history_score": (0.0, 1.0),
    "debt_to_income": (0.0, 10.0),
    "estimated_credit_score": (300.0, 850.0),
    "credit_age_months": (0, 720),
    "recent_hard_inquiries_6m": (0, 50),
}
FEATURE_BOUNDS = {
    "fraud_rate_90d": (0.0, 1.0),
    "transaction_count_7d": (0, None),
    "transaction_count_30d": (0, None),
    "fraud_count_90d": (0, None),
    "avg_spend_7d": (0.0, None),
    "avg_spend_30d": (0.0, None),
    "total_spend_7d": (0.0, None),
    "international_txn_ratio_30d": (0.0, 1.0),
}


def transactions_suite(now: str | None = None) -> list[Check]:
    columns = ("transaction_id", "customer_id", "amount", "event_timestamp", "transaction_type")
    checks = [exists(c) for c in columns]
    checks += [not_null(c) for c in ("transaction_id", "customer_id", "event_timestamp")]
    checks += [
        between("amount", *AMOUNT_BOUNDS),
        not_null("amount"),
        in_set("transaction_type", TRANSACTION_TYPES),
        unique("transaction_id"),
    ]
    return checks + ([not_in_future("event_timestamp", now)] if now else [])


def credit_suite() -> list[Check]:
    required = (
        "customer_id",
        "event_timestamp",
        "credit_utilization",
        "payment_history_score",
        "debt_to_income",
        "estimated_credit_score",
    )
    checks = [make(c) for c in required for make in (exists, not_null)]
    return checks + [between(c, *limits) for c, limits in CREDIT_BOUNDS.items()]


def feature_output_suite(columns: Sequence[str]) -> list[Check]:
    """Checks for the known columns among ``columns``; none if there are none."""
    checks = [between(c, *limits) for c, limits in FEATURE_BOUNDS.items() if c in columns]
    if "customer_segment" in columns:
        checks.append(in_set("customer_segment", CUSTOMER_SEGMENTS, mostly=0.99))
    return checks


def training_suite(columns: Sequence[str], label: str = "is_fraud") -> list[Check]:
    features = [c for c in columns if c not in (label, "event_timestamp")]
    return [
        exists(label),
        not_null(label),
        rows_at_least(1000),
        rows_distinct(),
        *[not_null(c, mostly=0.95) for c in features],
    ]


def check_transactions(df: DataFrame, now: str | None = None) -> DataFrame:
    return run_suite(df, "transactions_suite", transactions_suite(now))


def check_credit(df: DataFrame) -> DataFrame:
    return run_suite(df, "credit_bureau_suite", credit_suite())


def check_feature_output(df: DataFrame) -> DataFrame:
    """No rows, hence a trivial pass, if the table has no known column."""
    checks = feature_output_suite(df.columns)
    if not checks:
        return empty_results(df, "feature_store_output_suite")
    return run_suite(df, "feature_store_output_suite", checks)


def check_training_set(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return run_suite(df, "training_dataset_suite", training_suite(df.columns, label))
