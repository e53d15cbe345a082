"""Counts of input problems that the transforms absorb instead of failing on.

The application this replaces wrote these cases to its log (malformed service
dates, events about unknown reports) or failed (unreadable visit dates).
Here they are handled (fallback date, ignored, NULL) and counted, in one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldreports.constants import EVENT_NAMES
from fieldreports.functions.dates import parse_visit_date, service_date_fell_back
from fieldreports.operators.survey import MESSAGE_KEYS, null_keys


METRICS = ("raw_reports", "date_fallbacks", "unknown_event_names", "events_unknown_ids", "unreadable_visit_dates")


def _metric(df: DataFrame, name: str, cond=None) -> DataFrame:
    n = F.count(F.lit(1)) if cond is None else F.count_if(cond)
    return df.agg(n.cast("bigint").alias("n")).select(F.lit(name).alias("metric"), "n")


# Of the messages that go into the survey merge: rows with a NULL key, rows of the most frequent key.
MERGE_METRICS = ("null_merge_keys", "largest_merge_key")


def _merge_metrics(messages: DataFrame) -> list[DataFrame]:
    sizes = messages.groupBy(*MESSAGE_KEYS).agg(F.count(F.lit(1)).alias("rows"))
    largest = sizes.agg(F.coalesce(F.max("rows"), F.lit(0)).cast("bigint").alias("n"))
    return [
        messages.agg(null_keys().cast("bigint").alias("n")).select(F.lit("null_merge_keys").alias("metric"), "n"),
        largest.select(F.lit("largest_merge_key").alias("metric"), "n"),
    ]


def intake_counts(raw: DataFrame, messages: DataFrame, events: DataFrame, survey_rows: DataFrame,
                  merge_keys: bool = False) -> DataFrame:
    """One row: raw reports, service-date fallbacks, events with an unknown
    name, events about unknown report ids, answered surveys with an unreadable
    visit date; with ``merge_keys`` also how skewed the keys of the survey merge
    are (:data:`MERGE_METRICS`). Each count is a partially aggregated branch; the one-row
    results are unioned and spread into columns (no joins)."""
    ids = messages.select(F.col("_id").alias("_mid")).distinct()
    answered = survey_rows.where(F.col("provided_care").isNotNull() & F.col("visitdate").isNotNull())
    parts = [
        _metric(raw, "raw_reports"),
        _metric(raw, "date_fallbacks", service_date_fell_back("Service_Date", "Report_Date")),
        _metric(events, "unknown_event_names", ~F.coalesce(F.col("event").isin(*EVENT_NAMES), F.lit(False))),
        _metric(events.join(ids, F.col("record._id") == F.col("_mid"), "left_anti"), "events_unknown_ids"),
        _metric(answered, "unreadable_visit_dates", parse_visit_date("visitdate").isNull()),
    ]
    metrics = METRICS
    if merge_keys:
        parts += _merge_metrics(messages)
        metrics += MERGE_METRICS
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.agg(*[F.max(F.when(F.col("metric") == m, F.col("n"))).alias(m) for m in metrics])
