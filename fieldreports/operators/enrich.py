"""Shared enrichment: dedupe, number translation, roster attributes, training
tags and status-event flags (A5, J1-J5).

Shuffle plan of :func:`enrich`: one shuffle to dedupe by ``_id`` (limited to one
row per id and map task before it), the crosswalk and roster joins as Spark
chooses by their bytes, and the event flags aggregated by ``record._id`` then joined
on ``_id`` - the join reuses the dedupe partitioning, so only the event side
moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldreports.constants import EVENT_NAMES
from fieldreports.functions.dates import day_start
from fieldreports.operators.common import first_per_group

# First-wins order among copies of one report: earliest report time, then landing id.
DEDUPE_ORDER = ("timestamp", "sourceId")


def dedupe_messages(messages: DataFrame, order: Sequence[str] = DEDUPE_ORDER) -> DataFrame:
    """Keep the first copy of each ``_id`` (A5)."""
    return first_per_group(messages, ["_id"], order)


def translate_numbers(df: DataFrame, crosswalk: DataFrame, old_key: str, new_key: str) -> DataFrame:
    """Replace ``old_key`` by the crosswalk's new number into ``new_key``.

    One hop only: a new number is not looked up again. Rows without a new
    number keep the old one. ``new_key`` may equal ``old_key`` (in-place).
    The crosswalk's own columns are not kept.
    """
    cw = crosswalk.select(
        F.col("old_number").alias("_cw_old"), F.col("new_payment_number").alias("_cw_new")
    )
    joined = df.join(cw, F.col(old_key) == F.col("_cw_old"), "left")
    new_value = F.coalesce(F.col("_cw_new"), F.col(old_key))
    cols = [new_value.alias(c) if c == new_key else F.col(c) for c in df.columns]
    if new_key not in df.columns:
        cols.append(new_value.alias(new_key))
    return joined.select(*cols)


def merge_worker_info(
    messages: DataFrame,
    roster: DataFrame,
    drop_keys: Sequence[str] = ("reporting_number", "contact_number"),
    tester_flag: str | None = None,
) -> DataFrame:
    """Attach roster attributes by ``paymentPhone = reporting_number``.

    Unmatched messages keep NULL attributes. ``name`` becomes ``workerName``.
    With ``tester_flag`` set, that boolean column says whether the number is
    missing from the roster (J3 folded into the same join).
    """
    r = roster.withColumn("_in_roster", F.lit(True))
    joined = messages.join(r, messages["paymentPhone"] == r["reporting_number"], "left")
    keep = [c for c in messages.columns] + [
        c for c in roster.columns if c not in drop_keys and c not in messages.columns
    ]
    cols = [F.col(c).alias("workerName") if c == "name" else F.col(c) for c in keep]
    if tester_flag:
        cols.append((~F.coalesce(F.col("_in_roster"), F.lit(False))).alias(tester_flag))
    return joined.select(*cols)


def tag_testers(messages: DataFrame, roster: DataFrame, flag: str = "training") -> DataFrame:
    """Set ``flag`` to true for numbers that are not in the roster; keep it otherwise."""
    numbers = roster.select(F.col("reporting_number").alias("_rn")).distinct().withColumn("_hit", F.lit(True))
    joined = messages.join(numbers, messages["paymentPhone"] == numbers["_rn"], "left")
    tagged = F.when(F.col("_hit").isNull(), F.lit(True)).otherwise(F.col(flag))
    return joined.select(*[tagged.alias(c) if c == flag else F.col(c) for c in messages.columns])


def tag_training_day(messages: DataFrame, flag: str = "training") -> DataFrame:
    """Reports dated on or before the worker's training day are training."""
    on_training = F.coalesce(F.col("training_date") >= day_start("serviceDate"), F.lit(False))
    tagged = F.when(on_training, F.lit(True)).otherwise(F.col(flag))
    return messages.select(*[tagged.alias(c) if c == flag else F.col(c) for c in messages.columns])


def status_flags(events: DataFrame, names: Sequence[str] = EVENT_NAMES) -> DataFrame:
    """One row per ``record._id`` with a boolean per event name. Unknown names count nowhere."""
    return (
        events.where(F.col("record._id").isNotNull())
        .groupBy(F.col("record._id").alias("_ev_id"))
        .agg(*[F.bool_or(F.col("event") == F.lit(n)).alias(n) for n in names])
    )


def add_status_events(messages: DataFrame, events: DataFrame, names: Sequence[str] = EVENT_NAMES) -> DataFrame:
    """Flags ``called`` / ``attempted`` / ``noConsent`` from the event table.

    Any number of events per report; events about unknown ids are ignored.
    """
    flags = status_flags(events, names)
    base = [c for c in messages.columns if c not in names]
    joined = messages.select(*base).join(flags, F.col("_id") == F.col("_ev_id"), "left")
    return joined.select(*base, *[F.coalesce(F.col(n), F.lit(False)).alias(n) for n in names])


def enrich(
    messages: DataFrame,
    events: DataFrame,
    roster: DataFrame,
    crosswalk: DataFrame,
    deduped: bool = False,
) -> DataFrame:
    """Normalised messages → enriched messages (the shared pipeline).

    dedupe (unless ``messages`` are ``deduped`` already) → payment number → roster attributes + tester tag → training-day
    tag → status flags. ``training`` starts false.
    """
    roster_now = translate_numbers(roster, crosswalk, "reporting_number", "reporting_number")
    m = messages if deduped else dedupe_messages(messages)
    m = translate_numbers(m, crosswalk, "senderPhone", "paymentPhone")
    m = merge_worker_info(m, roster_now, tester_flag="training")
    m = tag_training_day(m)
    return add_status_events(m, events)
