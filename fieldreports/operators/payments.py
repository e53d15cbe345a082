"""Monthly pay for workers and supervisors (M1-M7, A1-A3).

Shuffles: one ``groupBy(paymentPhone, payment_due)`` with map-side partial
aggregation, one small ``groupBy(phone_ps, payment_due)`` for supervisors and
the final sort of the (small) result. The payment date is a row expression
(:mod:`fieldreports.functions.calendar`), so there is no range join and no
grouping by training date (which would be a handful of very hot keys).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldreports.functions import calendar
from fieldreports.functions.money import (
    REPORT_CAP,
    SUPERVISOR_BONUS,
    WORKER_BONUS,
    base_pay,
    bonus,
    capped,
)

# Attributes carried from reports into the monthly counts (first non-null value).
FIRST_COLUMNS = ("treat", "phone_ps", "chw_district", "workerName")
REPORT_ORDER = ("timestamp", "_id")


def payment_windows(roster: DataFrame, as_of, wrap_years: bool = True) -> DataFrame:
    """One row per open payment window of each roster worker (M1)."""
    w = F.explode(calendar.payment_windows("training_date", as_of, wrap_years)).alias("w")
    return roster.select("reporting_number", "training_date", w).select(
        "reporting_number", "training_date", "w.window_start", "w.window_end"
    )


def add_payment_due(messages: DataFrame, as_of, wrap_years: bool = True) -> DataFrame:
    """``payment_due`` = end of the window holding ``serviceDate`` (M2/J13); NULL outside."""
    return messages.withColumn(
        "payment_due", calendar.payment_due("training_date", "serviceDate", as_of, wrap_years)
    )


def report_counts(
    df: DataFrame,
    keys: Sequence[str] = ("paymentPhone", "payment_due"),
    first_columns: Sequence[str] = FIRST_COLUMNS,
    order: Sequence[str] = REPORT_ORDER,
) -> DataFrame:
    """Reports per key plus the first non-NULL value of each attribute (A1).

    Rows with a NULL key are dropped. "First" follows ``order``; ``min_by``
    ignores rows whose ordering is NULL, which is how NULL values are skipped.
    """
    keys = list(keys)
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    aggs = [F.count(F.lit(1)).cast("bigint").alias("reports")]
    if first_columns:
        ordering = F.struct(*[F.col(o) for o in order])
        aggs += [
            F.min_by(F.col(c), F.when(F.col(c).isNotNull(), ordering)).alias(c) for c in first_columns
        ]
    return df.where(cond).groupBy(*keys).agg(*aggs)


def capped_counts(enriched: DataFrame, as_of, cap: int = REPORT_CAP, wrap_years: bool = True) -> DataFrame:
    """Non-training reports → counts per worker and payment date, ``counted`` capped (A2)."""
    needed = ["paymentPhone", "serviceDate", "training_date", "timestamp", "_id", *FIRST_COLUMNS]
    work = enriched.where(~F.col("training")).select(*needed)
    counts = report_counts(add_payment_due(work, as_of, wrap_years))
    return counts.withColumn("counted", capped("reports", cap))


def with_pay(counts: DataFrame, schedule: Mapping[int, int]) -> DataFrame:
    """Base pay plus the arm bonus for rows with something counted (M3, M4)."""
    return (
        counts.where(F.col("counted") > 0)
        .withColumn("base", base_pay("counted"))
        .withColumn("bonus", bonus("treat", "counted", schedule))
        .withColumn("payment", (F.col("base") + F.col("bonus")).cast("bigint"))
    )


def worker_payments(counts: DataFrame, schedule: Mapping[int, int] = WORKER_BONUS) -> DataFrame:
    """Pay per worker and payment date (M5)."""
    return with_pay(counts, schedule).select(
        F.col("paymentPhone").alias("number"), "payment", "reports", "payment_due"
    )


def supervisor_counts(counts: DataFrame) -> DataFrame:
    """Worker counts rolled up per supervisor and payment date (A3).

    The cap is already applied per worker-month. The supervisor's arm is the
    arm of the lowest-numbered worker with a known arm.
    """
    return (
        counts.where(F.col("phone_ps").isNotNull() & F.col("payment_due").isNotNull())
        .groupBy("phone_ps", "payment_due")
        .agg(
            F.sum("counted").cast("bigint").alias("counted"),
            F.sum("reports").cast("bigint").alias("reports"),
            F.min_by(F.col("treat"), F.when(F.col("treat").isNotNull(), F.col("paymentPhone"))).alias("treat"),
        )
    )


def super_payments(counts: DataFrame, schedule: Mapping[int, int] = SUPERVISOR_BONUS) -> DataFrame:
    """Pay per supervisor and payment date (M6). The number is written without leading zeros."""
    number = F.col("phone_ps").cast("bigint").cast("string")
    return with_pay(supervisor_counts(counts), schedule).select(
        number.alias("number"), "payment", "reports", "payment_due"
    )


def calc_payments(enriched: DataFrame, as_of, payer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Sorted payments of any payer: a function from the capped counts (A2) to
    payment rows, such as :func:`worker_payments` or :func:`super_payments` (u2)."""
    return sort_payments(payer(capped_counts(enriched, as_of)))


def sort_payments(payments: DataFrame) -> DataFrame:
    """Report order: by payment date, then number (O1)."""
    return payments.orderBy("payment_due", "number")
