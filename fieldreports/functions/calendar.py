"""Monthly payment windows in closed form.

A worker trained on day ``t`` is paid in windows that start at ``anchor = t + 1
day`` and advance by calendar months, each computed from the anchor (so 31 Jan
+ 1 month is the last day of February). The number of open windows at
``as_of`` is the *months component* of the calendar difference, i.e. the full
months modulo 12 (``wrap_years=True``); with ``wrap_years=False`` the full
month count is used.

Instead of materialising windows and range-joining messages into them, a
message's window index is ``full_months(anchor, serviceDate)``: the largest
``m`` with ``anchor + m months <= serviceDate``. That is a row expression, so the
payment date needs no join, no grouping by training date and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldreports.functions.dates import ts_literal


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit_ts(value) -> Column:
    return ts_literal(value)


def plus_months(ts, months) -> Column:
    """``ts + months`` calendar months, day clamped to the month's end; time kept."""
    m = months if isinstance(months, Column) else F.lit(months)
    return _col(ts) + F.make_ym_interval(F.lit(0), m.cast("int"))


def payment_anchor(training_date) -> Column:
    return _col(training_date) + F.make_interval(days=F.lit(1))


def full_months(anchor, x) -> Column:
    """Largest ``m`` with ``anchor + m months <= x`` (negative when ``x < anchor``)."""
    a, v = _col(anchor), _col(x)
    raw = (F.year(v) - F.year(a)) * 12 + (F.month(v) - F.month(a))
    return raw - F.when(plus_months(a, raw) > v, 1).otherwise(0)


def window_count(training_date, as_of, wrap_years: bool = True) -> Column:
    """Number of payment windows open at ``as_of``."""
    anchor = payment_anchor(training_date)
    now = _lit_ts(as_of)
    full = full_months(anchor, now)
    n = F.pmod(full, F.lit(12)) if wrap_years else full
    return F.when(now < anchor, F.lit(0)).otherwise(n)


def payment_due(training_date, service_date, as_of, wrap_years: bool = True) -> Column:
    """End of the payment window holding ``service_date``; NULL outside all windows."""
    anchor = payment_anchor(training_date)
    k = full_months(anchor, service_date)
    n = window_count(training_date, as_of, wrap_years)
    return F.when((k >= 0) & (k < n), plus_months(anchor, k + 1))


def payment_windows(training_date, as_of, wrap_years: bool = True) -> Column:
    """Array of ``struct(window_start, window_end)`` for ``explode``; NULL (no rows) when none."""
    anchor = payment_anchor(training_date)
    n = window_count(training_date, as_of, wrap_years)
    idx = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
    windows = F.transform(
        idx,
        lambda m: F.struct(
            plus_months(anchor, m).alias("window_start"),
            plus_months(anchor, m + 1).alias("window_end"),
        ),
    )
    return F.when(n > 0, windows)
