"""Named queries over the shared test tables: one per operator of the
inventory, each ``(spark, sf_dir) -> DataFrame``. ``__spark_entry__`` exposes
them; ``bench.py`` times some of them.

Every query reads the test tables through :mod:`fieldreports.sources.adapter`,
so its work grows with the scale factor. Nothing here collects to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldreports.sources import adapter as A
from fieldreports.operators import enrich as E
from fieldreports.operators import payments as P
from fieldreports.operators import calls as C
from fieldreports.operators import survey as V
from fieldreports.operators.normalize import flatten_survey as _flatten
from fieldreports.operators import maintenance as M
from fieldreports.operators import quality as QC
from fieldreports.functions.dates import day_start
from fieldreports.functions.dates import parse_service_date as _service_date
from fieldreports.functions.money import SUPERVISOR_BONUS, WORKER_BONUS, bonus
from fieldreports.sources import readers as R
from fieldreports.sources.slices import slice_of

AS_OF = A.AS_OF
SLICE_START = "2024-01-01"

Query = Callable[[SparkSession, str], DataFrame]


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return E.enrich(A.messages(spark, sf), A.status_events(spark, sf), A.roster(spark, sf), A.crosswalk(spark, sf))


def _capped(spark: SparkSession, sf: str) -> DataFrame:
    return P.capped_counts(_enriched(spark, sf), AS_OF)


# --- sources / normalisation -------------------------------------------------

def normalize_messages(spark, sf):
    return A.messages(spark, sf)


def dedupe_messages(spark, sf):
    return E.dedupe_messages(A.messages(spark, sf))


def load_roster(spark, sf):
    return A.roster(spark, sf)


def load_crosswalk(spark, sf):
    return A.crosswalk(spark, sf)


# --- enrichment ---------------------------------------------------------------

def translate_roster(spark, sf):
    return E.translate_numbers(A.roster(spark, sf), A.crosswalk(spark, sf), "reporting_number", "reporting_number")


def translate_numbers(spark, sf):
    d = E.dedupe_messages(A.messages(spark, sf))
    t = E.translate_numbers(d, A.crosswalk(spark, sf), "senderPhone", "paymentPhone")
    return t.select("_id", "senderPhone", "paymentPhone")


def enrich(spark, sf):
    return _enriched(spark, sf)


def add_status_events(spark, sf):
    d = E.dedupe_messages(A.messages(spark, sf))
    return E.add_status_events(d, A.status_events(spark, sf)).select("_id", "called", "attempted", "noConsent")


# --- payments -----------------------------------------------------------------

def payment_due(spark, sf):
    e = _enriched(spark, sf).where(~F.col("training"))
    return P.add_payment_due(e, AS_OF).select("_id", "paymentPhone", "serviceDate", "training_date", "payment_due")


def report_counts(spark, sf):
    return _capped(spark, sf).drop("counted")


def capped_counts(spark, sf):
    return _capped(spark, sf).select("paymentPhone", "payment_due", "reports", "counted", "treat", "phone_ps")


def worker_payments(spark, sf):
    return P.sort_payments(P.worker_payments(_capped(spark, sf)))


def super_payments(spark, sf):
    return P.sort_payments(P.super_payments(_capped(spark, sf)))


# --- calls --------------------------------------------------------------------

def _candidates(spark, sf):
    return C.call_candidates(_enriched(spark, sf), AS_OF)


def _picks(spark, sf):
    return C.call_batch(_enriched(spark, sf), AS_OF)


def call_candidates(spark, sf):
    return _candidates(spark, sf)


def recent_candidates(spark, sf):
    """The call candidates, from the first copies of recent reports."""
    firsts = C.recent_first_copies(A.messages(spark, sf), AS_OF)
    e = E.enrich(firsts, A.status_events(spark, sf), A.roster(spark, sf), A.crosswalk(spark, sf), deduped=True)
    return C.call_candidates(e, AS_OF)


def call_counts(spark, sf):
    return C.call_counts(_candidates(spark, sf))


def needed_calls(spark, sf):
    return C.needed_calls(C.call_counts(_candidates(spark, sf)), C.DEFAULT_TARGET)


def pick_needed_calls(spark, sf):
    return _picks(spark, sf)


def training_queue(spark, sf):
    t = C.training_batch(_enriched(spark, sf))
    return t.select("_id", "paymentPhone", "chw_district", "training_date", "workerName")


def queue_payload(spark, sf):
    return C.queue_entries(_picks(spark, sf)).drop("_order")


def district_load(spark, sf):
    return C.district_load(_picks(spark, sf))


def queue_refresh(spark, sf):
    return C.push_entries(A.old_queue(spark, sf), C.queue_batches(_enriched(spark, sf), AS_OF), batches=2)


# --- survey ---------------------------------------------------------------------

def _clean(spark, sf):
    return V.clean_survey(_flatten(A.survey_responses(spark, sf)))


def _survey_inputs(spark, sf):
    return _enriched(spark, sf), _clean(spark, sf)


def _roster_now(spark, sf):
    return E.translate_numbers(A.roster(spark, sf), A.crosswalk(spark, sf), "reporting_number", "reporting_number")


def flatten_survey(spark, sf):
    return _flatten(A.survey_responses(spark, sf))


def survey_slices(spark, sf):
    """Responses and answers per request window."""
    rows = _flatten(A.survey_responses(spark, sf)).withColumn("slice", slice_of("submitted_at", SLICE_START))
    return rows.groupBy("slice").agg(
        F.count(F.lit(1)).alias("responses"), F.count("provided_care").alias("answered"))


def clean_survey(spark, sf):
    return _clean(spark, sf)


def merge_exact(spark, sf):
    return V.merge_exact(*_survey_inputs(spark, sf), with_date=True)


def reconcile_survey(spark, sf):
    return V.reconcile_survey(*_survey_inputs(spark, sf))[0]


def survey_orphans(spark, sf):
    return V.reconcile_survey(*_survey_inputs(spark, sf))[1]


def orphan_candidates(spark, sf):
    return V.orphan_candidates(*_survey_inputs(spark, sf))


def roster_coverage(spark, sf):
    report = V.reconcile_survey(*_survey_inputs(spark, sf))[0]
    # checked against the directory before the upsert, which lacks workers
    return V.roster_coverage(report, A.existing_directory(spark, sf))


def final_report(spark, sf):
    report = V.reconcile_survey(*_survey_inputs(spark, sf))[0]
    return V.final_report(report, _roster_now(spark, sf))


def unique_visits(spark, sf):
    return V.unique_visits(_enriched(spark, sf))


# --- maintenance ------------------------------------------------------------------

def testers(spark, sf):
    return M.testers(A.messages(spark, sf), A.roster(spark, sf), A.crosswalk(spark, sf))


def directory_upsert(spark, sf):
    roster = A.roster(spark, sf)
    found = M.testers(A.messages(spark, sf), roster, A.crosswalk(spark, sf))
    return M.directory_upsert(A.existing_directory(spark, sf), roster, found)


def flags_to_events(spark, sf):
    return M.flat_events(M.flags_to_events(A.legacy_messages(spark, sf)))


def event_upsert(spark, sf):
    new = M.flags_to_events(A.legacy_messages(spark, sf))
    return M.flat_events(M.event_upsert(A.status_events(spark, sf), new))


def repair_dates(spark, sf):
    return M.repair_dates(A.legacy_messages(spark, sf))


def repaired_messages(spark, sf):
    fixed = M.repaired_messages(A.legacy_messages(spark, sf))
    return fixed.select("_id", "code", "called", "noConsent", "serviceDate")


def legacy_with_flag(spark, sf):
    """The filtered reads of the legacy table, one per kind of flag."""
    legacy = A.legacy_messages(spark, sf)
    kinds = [R.legacy_with_flag(legacy, kind).select("_id", F.lit(kind).alias("kind")) for kind in R.LEGACY_KINDS]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


def date_or_keep(spark, sf):
    return M.dates_or_kept(A.raw_messages(spark, sf).select("sourceId", "Service_Date"))


# --- remaining single operators ------------------------------------------------

def payment_windows(spark, sf):
    return P.payment_windows(_roster_now(spark, sf), AS_OF)


def bonus_schedule(spark, sf):
    c = _capped(spark, sf)
    return c.select(
        "paymentPhone", "payment_due", "treat", "counted",
        bonus("treat", "counted", WORKER_BONUS).alias("worker_bonus"),
        bonus("treat", "counted", SUPERVISOR_BONUS).alias("supervisor_bonus"),
    )


def _paid(spark, sf):
    d = E.dedupe_messages(A.messages(spark, sf))
    return E.translate_numbers(d, A.crosswalk(spark, sf), "senderPhone", "paymentPhone")


def merge_worker_info(spark, sf):
    m = E.merge_worker_info(_paid(spark, sf), _roster_now(spark, sf))
    return m.select("_id", "paymentPhone", "workerName", "chw_district", "treat", "phone_ps", "training_date")


def tag_testers(spark, sf):
    m = _paid(spark, sf).withColumn("training", F.lit(False))
    return E.tag_testers(m, _roster_now(spark, sf)).select("_id", "paymentPhone", "training")


def tag_training_day(spark, sf):
    m = E.merge_worker_info(_paid(spark, sf), _roster_now(spark, sf)).withColumn("training", F.lit(False))
    return E.tag_training_day(m).select("_id", "serviceDate", "training_date", "training")


def parse_service_date(spark, sf):
    raw = A.raw_messages(spark, sf)
    return raw.select("sourceId", _service_date("Service_Date", "Report_Date").alias("serviceDate"))


def message_id(spark, sf):
    return A.messages(spark, sf).select("sourceId", "_id")


def extraction_windows(spark, sf):
    starts = A.raw_messages(spark, sf).agg(F.min(day_start("Report_Date")).alias("start"))
    return R.extraction_windows(starts, AS_OF, weeks=1)


def quality_counts(spark, sf):
    return QC.intake_counts(
        A.raw_messages(spark, sf), E.dedupe_messages(A.messages(spark, sf)), A.status_events(spark, sf),
        _flatten(A.survey_responses(spark, sf)), merge_keys=True,
    )


QUERIES: dict[str, Query] = {
    "normalize_messages": normalize_messages,
    "dedupe_messages": dedupe_messages,
    "load_roster": load_roster,
    "load_crosswalk": load_crosswalk,
    "translate_roster": translate_roster,
    "translate_numbers": translate_numbers,
    "add_status_events": add_status_events,
    "enrich": enrich,
    "payment_due": payment_due,
    "report_counts": report_counts,
    "capped_counts": capped_counts,
    "worker_payments": worker_payments,
    "super_payments": super_payments,
    "call_candidates": call_candidates,
    "recent_candidates": recent_candidates,
    "call_counts": call_counts,
    "needed_calls": needed_calls,
    "pick_needed_calls": pick_needed_calls,
    "training_queue": training_queue,
    "queue_payload": queue_payload,
    "district_load": district_load,
    "queue_refresh": queue_refresh,
    "flatten_survey": flatten_survey,
    "survey_slices": survey_slices,
    "clean_survey": clean_survey,
    "merge_exact": merge_exact,
    "reconcile_survey": reconcile_survey,
    "survey_orphans": survey_orphans,
    "orphan_candidates": orphan_candidates,
    "roster_coverage": roster_coverage,
    "final_report": final_report,
    "unique_visits": unique_visits,
    "testers": testers,
    "directory_upsert": directory_upsert,
    "flags_to_events": flags_to_events,
    "event_upsert": event_upsert,
    "repair_dates": repair_dates,
    "repaired_messages": repaired_messages,
    "legacy_with_flag": legacy_with_flag,
    "date_or_keep": date_or_keep,
    "payment_windows": payment_windows,
    "bonus_schedule": bonus_schedule,
    "merge_worker_info": merge_worker_info,
    "tag_testers": tag_testers,
    "tag_training_day": tag_training_day,
    "parse_service_date": parse_service_date,
    "message_id": message_id,
    "extraction_windows": extraction_windows,
    "quality_counts": quality_counts,
}
