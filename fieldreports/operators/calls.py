"""Phone verification: which visits to call, and the per-district call queues
(F2, F3, A4, W1, W2, N8, N9, K3, A10).

Per-worker quotas and per-district queues are exactly where one key can hold
a large share of the rows (one very active worker; the ``Test`` district gets
every training report). Positions inside a group therefore come from
:func:`fieldreports.operators.common.rank_in_slices`, which numbers a group
slice by slice, and counts come from partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldreports.constants import (
    DEFAULT_SINCE_DAYS,
    DEFAULT_TARGET,
    NO_TRAINING_DATE,
    TEST_DISTRICT,
    TESTER_NAME,
)
from fieldreports.functions.dates import ts_literal
from fieldreports.operators.common import rank_in_slices
from fieldreports.operators.enrich import dedupe_messages
from fieldreports.operators.normalize import json_payload

SHUFFLE_SEED = 42
# Old queue entries numbered together in one slice.
SEQ_SLICE = 65_536
PICK_ORDER = ("timestamp", "_id")
PAYLOAD_COLUMNS = (
    "_id",
    "paymentPhone",
    "workerName",
    "chw_district",
    "patientName",
    "patientPhone",
    "code",
    "serviceDate",
    "training_date",
    "called",
    "attempted",
)


def call_candidates(enriched: DataFrame, as_of, since_days: int = DEFAULT_SINCE_DAYS) -> DataFrame:
    """Recent, consenting, non-training reports (F2). Recent = serviceDate strictly after as_of - since."""
    return enriched.where(_is_candidate(as_of, since_days))


def _is_candidate(as_of, since_days: int) -> Column:
    cutoff = ts_literal(as_of) - F.make_interval(days=F.lit(since_days))
    return (F.col("serviceDate") > cutoff) & ~F.col("training") & ~F.col("noConsent")


def recent_first_copies(messages: DataFrame, as_of, since_days: int = DEFAULT_SINCE_DAYS,
                        month: str | None = None) -> DataFrame:
    """First copies (A5) of the reports that can be call candidates (F2), read from recent partitions.

    A service date never lies after its report, so a candidate's report is later than the
    cut-off. Copies are decided over all reports all the same: a recent copy of an older report
    is no first copy, and older reports are read for their ids only. ``month`` names a
    partition column ``yyyy-MM`` of the report time, which prunes both reads.
    """
    cutoff = ts_literal(as_of) - F.make_interval(days=F.lit(since_days))
    recent, older = F.col("timestamp") > cutoff, F.col("timestamp") <= cutoff
    if month:
        edge = F.date_format(cutoff, "yyyy-MM")
        recent, older = recent & (F.col(month) >= edge), older & (F.col(month) <= edge)
    known = messages.where(older).select(F.col("_id").alias("_known")).distinct()
    return dedupe_messages(messages.where(recent)).join(known, F.col("_id").eqNullSafe(F.col("_known")), "left_anti")


def fill_training_defaults(df: DataFrame) -> DataFrame:
    """Training rows get a placeholder training date and worker name."""
    return df.withColumn(
        "training_date", F.coalesce(F.col("training_date"), ts_literal(NO_TRAINING_DATE))
    ).withColumn("workerName", F.coalesce(F.col("workerName"), F.lit(TESTER_NAME)))


def training_batch(enriched: DataFrame) -> DataFrame:
    """All training reports, queued under the ``Test`` district (F3 + N8). No time filter."""
    return fill_training_defaults(
        enriched.where(F.col("training")).withColumn("chw_district", F.lit(TEST_DISTRICT))
    )


def call_counts(messages: DataFrame) -> DataFrame:
    """Reports and already-called reports per payment number (A4)."""
    return (
        messages.where(F.col("paymentPhone").isNotNull())
        .groupBy("paymentPhone")
        .agg(
            F.count(F.lit(1)).cast("bigint").alias("reports"),
            F.sum(F.col("called").cast("bigint")).cast("bigint").alias("called"),
        )
    )


def needed_calls(counts: DataFrame, target: float = DEFAULT_TARGET) -> DataFrame:
    """``needed = ceil(reports * target) - called``; may be negative."""
    return counts.withColumn("needed", _quota("reports", "called", target))


def _quota(reports: str, called: str, target: float) -> Column:
    share = F.ceil(F.col(reports).cast("double") * F.lit(float(target)).cast("double"))
    return (share - F.col(called)).cast("bigint")


def quota_limit(needed: Column, size: Column) -> Column:
    """How many reports of a worker to take: a negative quota keeps all but the last ``|needed|``."""
    return F.when(needed >= 0, needed).otherwise(size + needed)


def _by_day(messages: DataFrame, order: Sequence[str], totals) -> DataFrame:
    return rank_in_slices(
        messages.where(F.col("paymentPhone").isNotNull()), ["paymentPhone"], {"_day": F.to_date(order[0])}, order, totals)


def pick_needed_calls(needed: DataFrame, messages: DataFrame, order: Sequence[str] = PICK_ORDER) -> DataFrame:
    """First ``needed`` reports of each worker in ``order``, which starts with a time.

    A negative quota keeps all but the last ``|needed|`` reports; a worker
    without a quota gets none. Already-called reports are not excluded.
    """
    cols = messages.columns
    ranked = _by_day(messages, order, {"_cnt": F.lit(1)})
    quota = needed.select(F.col("paymentPhone").alias("_qp"), F.col("needed").alias("_needed"))
    joined = ranked.join(quota, F.col("paymentPhone") == F.col("_qp"), "inner")
    return joined.where(F.col("_rank") <= quota_limit(F.col("_needed"), F.col("_cnt"))).select(*cols)


def shuffle_key(seed: int = SHUFFLE_SEED, col: str = "_id") -> Column:
    """Seeded pseudo-random order (O2): reproducible, unlike ``rand()``."""
    return F.md5(F.concat(F.lit(str(seed)), F.coalesce(F.col(col), F.lit(""))))


def queue_entries(batch: DataFrame, payload_columns: Sequence[str] = PAYLOAD_COLUMNS,
                  seed: int = SHUFFLE_SEED) -> DataFrame:
    """Batch rows → ``(district, payload, _order)``, and ``_batch`` where rows carry one: JSON payload with explicit nulls."""
    return batch.select(
        F.col("chw_district").alias("district"),
        json_payload(batch, payload_columns).alias("payload"),
        shuffle_key(seed).alias("_order"),
        *(["_batch"] if "_batch" in batch.columns else []),
    )


def district_load(batch: DataFrame) -> DataFrame:
    """Entries per district in a batch (A10). A NULL district is one queue."""
    return batch.groupBy(F.col("chw_district").alias("district")).agg(
        F.count(F.lit(1)).cast("bigint").alias("loaded")
    )


def queue_refresh(old: DataFrame, *batches: DataFrame) -> DataFrame:
    """Push batches, one after the other, onto per-district queues and trim them (K3).

    A batch that touches a district leaves its queue as long as it was, or as
    the batch if that is longer: all new entries and the newest old ones. The
    order of the pushes makes no difference to the length, so after all batches
    a touched queue is the newest ``max(old, batch 1, batch 2, ...)`` entries of
    the old ones followed by the batches. That is one ranking. Districts absent
    from every batch are untouched. ``seq`` is renumbered 1.. per touched
    district, newest highest; a batch is pushed in ``_order``.
    """
    entries = None
    for i, batch in enumerate(batches, 1):
        part = batch.select("district", "payload", "_order", F.lit(i).alias("_batch"))
        entries = part if entries is None else entries.unionByName(part)
    return push_entries(old, entries, len(batches)) if batches else old.select("district", "seq", "payload")


def push_entries(old: DataFrame, entries: DataFrame, batches: int, touched_only: bool = False) -> DataFrame:
    """:func:`queue_refresh` of entries that carry the number of their batch (``_batch``, from 1 on).

    ``touched_only`` leaves out the queues that no batch touches.
    """
    pushed = old.select("district", "payload", "seq", F.lit(0).alias("_batch"), F.lit("").alias("_order")).unionByName(
        entries.select("district", "payload", F.lit(0).cast("bigint").alias("seq"), F.col("_batch").cast("int").alias("_batch"), "_order"))
    sizes = {f"_size{i}": F.when(F.col("_batch") == i, 1).otherwise(0) for i in range(batches + 1)}
    ranked = rank_in_slices(
        pushed, ["district"],
        # along the queue: batch, then old entries by number and new ones by leading hash digits
        {"_s0": F.col("_batch"), "_s1": F.floor(F.col("seq") / SEQ_SLICE), "_s2": F.substring("_order", 1, 2)},
        ["_batch", "seq", "_order", "payload"], sizes,
    )
    total = sum((F.col(c) for c in sizes), F.lit(0))
    length = F.greatest(*[F.col(c) for c in sizes])
    new = total - F.col("_size0")
    place = (F.col("_rank") - (total - length)).cast("bigint")
    kept = (new > 0) & (place > 0) if touched_only else (new == 0) | (place > 0)
    return ranked.where(kept).select(
        "district", F.when(new == 0, F.col("seq")).otherwise(place).alias("seq"), "payload")


def call_batch(enriched: DataFrame, as_of, target: float = DEFAULT_TARGET,
               since_days: int = DEFAULT_SINCE_DAYS) -> DataFrame:
    """Reports to verify by phone: F2 → A4 → W1 → W2, quota and rank from one ranking."""
    candidates = call_candidates(enriched, as_of, since_days)
    ranked = _by_day(candidates, PICK_ORDER, {"reports": F.lit(1), "_calls": F.col("called").cast("bigint")})
    # the flag of a row is called ``called`` too, so the sum takes its place for the quota only
    quota = needed_calls(ranked.withColumn("_flag", F.col("called")).withColumn("called", F.col("_calls")), target)
    picked = quota.where(F.col("_rank") <= quota_limit(F.col("needed"), F.col("reports")))
    return picked.select(*[F.col("_flag").alias(c) if c == "called" else F.col(c) for c in candidates.columns])


def queue_batches(enriched: DataFrame, as_of, target: float = DEFAULT_TARGET,
                  since_days: int = DEFAULT_SINCE_DAYS) -> DataFrame:
    """The entries of both daily batches from one pass over the reports: the picked calls
    (``_batch`` 1, as :func:`call_batch`) and all training reports (2, as :func:`training_batch`).

    Every report is in one batch at most, so a label takes the place of two derivations and
    one ranking serves both.
    """
    label = F.when(F.col("training"), 2).when(_is_candidate(as_of, since_days) & F.col("paymentPhone").isNotNull(), 1)
    rows = enriched.withColumn("_batch", label).where(F.col("_batch").isNotNull())
    ranked = rank_in_slices(
        rows, ["_batch", "paymentPhone"], {"_day": F.to_date(PICK_ORDER[0])}, PICK_ORDER,
        {"_reports": F.lit(1), "_calls": F.col("called").cast("bigint")})
    test = F.col("_batch") == 2
    picked = ranked.where(test | (F.col("_rank") <= quota_limit(_quota("_reports", "_calls", target), F.col("_reports"))))
    filled = picked.select(
        *[c for c in rows.columns if c not in ("training_date", "workerName", "chw_district")],
        F.when(test, F.lit(TEST_DISTRICT)).otherwise(F.col("chw_district")).alias("chw_district"),
        F.when(test, F.coalesce("training_date", ts_literal(NO_TRAINING_DATE))).otherwise(F.col("training_date")).alias("training_date"),
        F.when(test, F.coalesce("workerName", F.lit(TESTER_NAME))).otherwise(F.col("workerName")).alias("workerName"),
    )
    return queue_entries(filled)
