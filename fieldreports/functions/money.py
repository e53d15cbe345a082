"""Pay rules as Column expressions.

A pay schedule is a mapping ``treatment arm -> amount per counted report``;
arms not listed earn no bonus. Callers may pass their own schedule.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldreports.constants import BASE_PAY, REPORT_CAP, SUPERVISOR_BONUS, WORKER_BONUS  # noqa: F401


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bonus(treat, counted, schedule: Mapping[int, int]) -> Column:
    """``rate(treat) * counted``; 0 for arms without a rate and for NULL arms."""
    t = _col(treat)
    rate = F.lit(0)
    for arm, amount in sorted(schedule.items(), reverse=True):
        rate = F.when(t == arm, F.lit(amount)).otherwise(rate)
    return (F.coalesce(rate, F.lit(0)) * _col(counted)).cast("bigint")


def capped(reports, cap: int = REPORT_CAP) -> Column:
    return F.least(_col(reports), F.lit(cap)).cast("bigint")


def base_pay(counted, amount: int = BASE_PAY) -> Column:
    """Base pay for a month with at least one counted report."""
    return F.when(_col(counted) > 0, F.lit(amount)).otherwise(F.lit(0)).cast("bigint")
