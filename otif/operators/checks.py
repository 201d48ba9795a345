"""Invariant checks and publication guards (CHK-1..10, FIF-5, FLT-5, PRF-18, SRT-3).

Each table is checked by one aggregation pass of ``count_if`` conditions;
uniqueness costs one extra grouped count. The named checks are stacked into
``(check_name, violations, status)`` rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEDULE_GRAIN = ["sap_client_id", "purchase_order_id", "purchase_order_item_id", "schedule_line_id"]


def _rate_out_of_range(c: str) -> Column:
    return ~F.col(c).between(0, 1)


def _stack(agg_row: DataFrame, names: list[str]) -> DataFrame:
    """One-row aggregate → one row per check."""
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return agg_row.selectExpr(f"stack({len(names)}, {pairs}) AS (check_name, violations)")


def invariant_checks(schedules: DataFrame, monthly: DataFrame, balance: DataFrame) -> DataFrame:
    """Named post-run checks on published schedule, monthly and balance results."""
    kpi_missing = F.col("is_on_time").isNull() | F.col("is_in_full").isNull() | F.col("quantity_fill_rate").isNull()
    kpi_present = (F.col("is_on_time").isNotNull() | F.col("is_in_full").isNotNull()
                   | F.col("quantity_fill_rate").isNotNull())
    sched = schedules.agg(
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("long").alias("GOLD_ITEMS_PRESENT"),
        F.count_if(F.col("is_evaluable") & kpi_missing).alias("EVALUABLE_SCHEDULES_HAVE_KPI"),
        F.count_if(~F.col("is_evaluable") & kpi_present).alias("EXCLUDED_SCHEDULES_HAVE_NO_KPI"),
        F.count_if(F.col("allocated_quantity") > F.col("scheduled_quantity")).alias("SCHEDULE_ALLOCATION_LIMIT"),
    )
    dup = (schedules.groupBy(*SCHEDULE_GRAIN).count().filter("count > 1")
           .agg(F.count(F.lit(1)).alias("UNIQUE_SCHEDULE_KEY")))
    rates = ["on_time_rate", "in_full_rate", "mean_quantity_fill_rate", "performance_score",
             "evaluation_coverage_rate"]
    month = monthly.agg(
        F.count_if(F.col("candidate_schedule_line_count")
                   != F.col("evaluated_schedule_line_count") + F.col("excluded_schedule_line_count"))
        .alias("MONTHLY_COUNTS_BALANCE"),
        F.count_if(_any([_rate_out_of_range(r) for r in rates])).alias("MONTHLY_RATES_IN_RANGE"),
        F.count_if((F.col("evaluated_schedule_line_count") > 0)
                   & (F.col("on_time_rate").isNull() | F.col("in_full_rate").isNull()
                      | F.col("performance_score").isNull())).alias("EVALUATED_MONTHS_HAVE_RATES"),
    )
    bal = balance.agg(F.count_if((F.col("unallocated_quantity") < 0)
                                 | (F.col("delivered_quantity")
                                    != F.col("allocated_quantity") + F.col("unallocated_quantity")))
                      .alias("DELIVERY_QUANTITY_BALANCE"))
    stacked = (_stack(sched, ["GOLD_ITEMS_PRESENT", "EVALUABLE_SCHEDULES_HAVE_KPI",
                              "EXCLUDED_SCHEDULES_HAVE_NO_KPI", "SCHEDULE_ALLOCATION_LIMIT"])
               .unionByName(_stack(dup, ["UNIQUE_SCHEDULE_KEY"]))
               .unionByName(_stack(month, ["MONTHLY_COUNTS_BALANCE", "MONTHLY_RATES_IN_RANGE",
                                           "EVALUATED_MONTHS_HAVE_RATES"]))
               .unionByName(_stack(bal, ["DELIVERY_QUANTITY_BALANCE"])))
    return stacked.select("check_name", F.col("violations").cast("long").alias("violations"),
                          F.when(F.col("violations") == 0, "PASS").otherwise("CHECK").alias("status"))


def _any(conds: list[Column]) -> Column:
    out = F.lit(False)
    for c in conds:
        out = out | F.coalesce(c, F.lit(False))
    return out


#: Rows of published tables that would mean a lost or doubled quantity (FIF-5); counted while the tables are written.
UNCONSERVED = {
    "delivery_allocations": "allocated_quantity IS NULL OR allocated_quantity <= 0",
    "delivery_allocation_balance": "unallocated_quantity IS NULL OR unallocated_quantity < 0",
    "schedule_line_performance": "allocated_quantity > schedule_quantity",
}


def assert_conserved(violations: Mapping[str, int]) -> None:
    """Stop before publishing when a table has rows that ``UNCONSERVED`` names."""
    if broken := {table: n for table, n in violations.items() if n}:
        raise ValueError(f"allocated quantities are not conserved: {broken}")


def assert_branch_mapping(quarantined: int, branches: DataFrame) -> None:
    """Stop unless every branch code is valid and has one name (FLT-5)."""
    codes = branches.agg(F.count("*").alias("rows"), F.count_distinct("WERKS").alias("codes")).first()
    if quarantined or not codes.rows or codes.rows != codes.codes:
        raise ValueError(f"branch mapping: {quarantined} rows in quarantine, {codes.rows} valid rows with {codes.codes} codes")


def published_grain_check(monthly: DataFrame, as_of: dt.date) -> DataFrame:
    """Cross-check of a published monthly table: grain, counts, cutoff, scopes (PRF-18)."""
    grain = ["report_month", "report_scope", "branch_code", "supplier_id"]
    dup = (monthly.groupBy(*grain).count().filter("count > 1").agg(F.count(F.lit(1)).alias("DUPLICATE_GRAIN")))
    counts = ["candidate_schedule_line_count", "evaluated_schedule_line_count", "excluded_schedule_line_count"]
    body = monthly.agg(
        F.count_if(_any([F.col(c).isNull() | (F.col(c) < 0) for c in counts])).alias("INVALID_COUNTS"),
        F.count_if(F.col("as_of_date").isNull() | (F.col("as_of_date") != F.lit(as_of))).alias("CUTOFF_MISMATCH"),
        F.count_if(~F.col("report_scope").isin("ALL", "BRANCH")).alias("UNKNOWN_SCOPE"),
        F.count_if(F.last_day("report_month") > F.lit(as_of)).alias("OPEN_MONTH_ROWS"),
    )
    stacked = _stack(dup, ["DUPLICATE_GRAIN"]).unionByName(
        _stack(body, ["INVALID_COUNTS", "CUTOFF_MISMATCH", "UNKNOWN_SCOPE", "OPEN_MONTH_ROWS"]))
    return stacked.select("check_name", F.col("violations").cast("long").alias("violations"),
                          F.when(F.col("violations") == 0, "PASS").otherwise("CHECK").alias("status"))
