"""Maintenance jobs: tester discovery, directory upsert, flags → events,
date repair (J6, U1, N7, K4, U4, K5, N4, N5).

Writes are insert-only (first writer wins): the new version of a table is
the old one plus batch rows whose key is absent. That is an anti join
against the target's keys, so reruns are idempotent and a retried task can
never produce a second copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldreports import schemas
from fieldreports.constants import FLAG_EVENT_TIME, TEST_DISTRICT, TESTER_NAME
from fieldreports.functions.dates import date_or_keep, parse_service_date, ts_literal
from fieldreports.operators.common import first_per_group, possible_members
from fieldreports.operators.normalize import cast_identifiers, normalize_columns

EVENT_KEYS = ("event_time", "event", "record._id")
DIRECTORY_KEYS = ("reporting_number",)


def testers(messages: DataFrame, roster: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Directory rows for sender numbers that are neither in the roster nor a
    new number of the crosswalk (J6). NULL senders are not numbers and are skipped."""
    known = (
        roster.select(F.col("reporting_number").alias("_n"))
        .unionByName(crosswalk.select(F.col("new_payment_number").alias("_n")))
        .where(F.col("_n").isNotNull())
        .distinct()
    )
    senders = messages.select("senderPhone").where(F.col("senderPhone").isNotNull()).distinct()
    unknown = senders.join(known, F.col("senderPhone") == F.col("_n"), "left_anti")
    return unknown.select(
        F.col("senderPhone").alias("reporting_number"),
        F.col("senderPhone").alias("contact_number"),
        F.lit(TESTER_NAME).alias("name"),
        F.lit(TEST_DISTRICT).alias("chw_district"),
        F.lit(None).cast("timestamp_ntz").alias("training_date"),
        F.lit(None).cast("int").alias("treat"),
        F.lit(None).cast("string").alias("phone_ps"),
    )


def directory_batch(roster: DataFrame, tester_rows: DataFrame) -> DataFrame:
    """Roster plus tester rows, numbers as text (U1, N7). ``_priority`` makes
    roster rows win over tester rows with the same number."""
    both = roster.withColumn("_priority", F.lit(0)).unionByName(
        tester_rows.withColumn("_priority", F.lit(1)), allowMissingColumns=True
    )
    return cast_identifiers(both)


def _key_cols(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]


def new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str],
             order: Sequence[str | Column] | None = None, large_target: bool = True) -> DataFrame:
    """Batch rows whose key is absent from ``target``, first per key by ``order`` (K4).

    Keys may be nested paths (``record._id``) and match NULL-safely. Rows
    whose key exists are dropped before the first-per-key step: on a rerun
    nearly every key exists, so the dedupe only sees what is really new.
    Of the target only keys that may be in the batch (:func:`possible_members`)
    are made distinct and shuffled; the target itself is scanned, its key columns
    only, and not exchanged. That reads the batch keys once more; it pays unless the
    batch is about as large as the target (``large_target=False``).
    """
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = batch.select("*", *_key_cols(keys))
    if order is None:
        order = [F.struct(*[F.col(c) for c in batch.columns])]
    there = [f"_t{i}" for i in range(len(keys))]
    existing = target.select(*[F.col(k).alias(t) for k, t in zip(keys, there)])
    if large_target:
        existing = possible_members(existing, there, keyed, names)
    existing = existing.distinct()
    cond = F.lit(True)
    for i in range(len(keys)):
        cond = cond & F.col(f"_k{i}").eqNullSafe(F.col(f"_t{i}"))
    absent = keyed.join(existing, cond, "left_anti")
    return first_per_group(absent, names, order).select(*batch.columns)


def insert_only_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                       order: Sequence[str | Column] | None = None) -> DataFrame:
    """New version of ``target``: old rows unchanged plus :func:`new_rows` (K4)."""
    added = new_rows(target, batch, keys, order)
    return target.unionByName(added.select(*target.columns))


def directory_upsert(existing: DataFrame, roster: DataFrame, tester_rows: DataFrame) -> DataFrame:
    """Worker directory after inserting roster and tester numbers that are new (U1 + K4)."""
    batch = directory_batch(roster, tester_rows)
    order = ["_priority", "contact_number", "name"]
    added = new_rows(existing, batch, DIRECTORY_KEYS, order, large_target=False)  # a batch is a whole roster
    return existing.unionByName(added.select(*existing.columns))


def flags_to_events(legacy: DataFrame) -> DataFrame:
    """Legacy flags → status events (U4), in one pass over the legacy table.

    ``called`` and ``noConsent`` get the fixed time 1970-01-01 (``called``
    carries ``updates.code``); each element of ``attempts`` becomes one
    ``attempted`` event at that time. The record is the re-normalised
    original entry.
    """
    raw = F.col("originalEntry")
    record = F.struct(*normalize_columns(raw), raw.getField("sourceId").alias("sourceId"))
    fixed_time = ts_literal(FLAG_EVENT_TIME)
    no_update = F.lit(None).cast("struct<code:string>")

    def ev(name: str, time: Column, updates: Column) -> Column:
        return F.struct(
            F.lit(name).alias("event"), time.alias("event_time"), F.col("_rec").alias("record"),
            updates.alias("updates"),
        )

    singles = F.array(
        F.when(F.col("called") == F.lit(True), ev("called", fixed_time, F.struct(F.col("code").alias("code")))),
        F.when(F.col("noConsent") == F.lit(True), ev("noConsent", fixed_time, no_update)),
    )
    attempts = F.transform(
        F.coalesce(F.col("attempts"), F.array().cast("array<timestamp_ntz>")),
        lambda t: ev("attempted", t, no_update),
    )
    events = F.filter(F.concat(singles, attempts), lambda e: e.isNotNull())
    return legacy.withColumn("_rec", record).select(F.inline(events)).select(
        *[f.name for f in schemas.EVENT.fields]
    )


def event_upsert(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Event table after inserting events whose (time, name, record id) is new (K4)."""
    order = [F.col("updates.code"), F.col("record.timestamp"), F.col("record.sourceId")]
    return insert_only_upsert(existing, batch, EVENT_KEYS, order)


def flat_events(events: DataFrame) -> DataFrame:
    """Events as flat columns (for reports and checks)."""
    return events.select(
        "event", "event_time", F.col("record._id").alias("record_id"), F.col("updates.code").alias("updates_code")
    )


def repair_dates(legacy: DataFrame) -> DataFrame:
    """Recompute stored service dates from the original entry (K5, N4): no age
    limit, and the fallback is the full report time. One row per message id."""
    raw = F.col("originalEntry")
    fixed = parse_service_date(
        raw.getField("Service_Date"), raw.getField("Report_Date"), max_age_days=None, fallback="timestamp"
    )
    return legacy.select("_id", fixed.alias("serviceDate"))


def date_repairs(legacy: DataFrame, *extra: str) -> DataFrame:
    """``_id`` and repaired ``serviceDate`` of the messages whose stored date differs, with columns ``extra`` of theirs."""
    raw = F.col("originalEntry")
    fixed = parse_service_date(
        raw.getField("Service_Date"), raw.getField("Report_Date"), max_age_days=None, fallback="timestamp"
    )
    return legacy.where(~fixed.eqNullSafe(F.col("serviceDate"))).select("_id", fixed.alias("serviceDate"), *extra)


def update_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``target`` with ``columns`` set from the row of ``updates`` that has the same keys (K5).

    Rows without an update stay as they are, updates without a row are ignored, and a
    NULL in an update is written as such. Keys match NULL-safely. Of several updates of one
    key the first by their values counts, so no row is duplicated.
    """
    one = first_per_group(updates.select(*keys, *columns), list(keys), list(columns))
    new = one.select(*_key_cols(keys), F.struct(*columns).alias("_new"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = target.join(new, same, "left")
    hit = F.col("_new").isNotNull()
    return joined.select(*[
        F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns
    ])


def repaired_messages(legacy: DataFrame) -> DataFrame:
    """The legacy table after the date repair (K5 applied): only rows whose date changes are looked up."""
    return update_by_key(legacy, date_repairs(legacy), ["_id"], ["serviceDate"])


def dates_or_kept(df: DataFrame, col: str = "Service_Date", out: str = "serviceDate") -> DataFrame:
    """``d.m.yyyy`` text → ISO date text, other text unchanged."""
    return df.withColumn(out, date_or_keep(col))
