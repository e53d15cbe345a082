"""Reconciling reports with call-survey answers.

The surveys are marked first: one row per four keys of the messages, with the set of
their service days, tells each survey whether a message shares its four keys and
whether one also shares the day. Both passes are then one left join of the messages
(:func:`reconcile_survey`), and what no message matched is a filter of the marked
surveys. No full outer join is used: AQE can split skewed partitions of inner, left
and anti joins, but not of a full outer one, and NULL keys, which all hash to one
partition, are handled the same way.

Join sides carry no broadcast hints: Spark chooses by bytes, at plan time or, with
AQE, from the sizes it measured.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldreports.constants import MERGE_SUFFIXES, REPORT_HIDDEN_FIELDS
from fieldreports.functions.dates import iso_day, parse_visit_date
from fieldreports.operators.common import first_per_group, nearest_day

SURVEY_KEYS = ("patientphone", "patient", "code", "visitdate")
SURVEY_ORDER = ("submitted_at", "response_id")
MESSAGE_KEYS = ("senderPhone", "patientPhone", "patientName", "code")
RESPONSE_KEYS = ("workerphone", "patientphone", "patient", "code")
APP_SUFFIX, SURVEY_SUFFIX = MERGE_SUFFIXES
# Columns dropped from the reconciled report, with survey names after suffixing.
HIDDEN_COLUMNS = tuple(f"patientphone{SURVEY_SUFFIX}" if c == "patientphone" else c for c in REPORT_HIDDEN_FIELDS)
VISIT_ORDER = ("patientName", "code", "serviceDate", "patientPhone")


def clean_survey(rows: DataFrame) -> DataFrame:
    """Answered surveys, one per (patient phone, patient, code, visit date).

    Copies collapse to the first submission with ``provided_care`` = any copy
    said yes. Grouping uses the raw text; afterwards the visit date becomes
    ISO ``yyyy-MM-dd`` (month-first reading, NULL if unreadable) and patient
    and code are upper-cased.
    """
    answered = rows.where(F.col("provided_care").isNotNull())
    first = first_per_group(
        answered, SURVEY_KEYS, SURVEY_ORDER, drop_null_keys=True,
        replace={"provided_care": F.bool_or("provided_care")},
    )
    out = []
    for c in rows.columns:
        if c == "visitdate":
            out.append(iso_day(parse_visit_date("visitdate")).alias(c))
        elif c in ("patient", "code"):
            out.append(F.upper(c).alias(c))
        else:
            out.append(F.col(c))
    return first.select(*out)


def _keys_equal(left: Sequence[str], right: Sequence[str]) -> Column:
    cond = F.lit(True)
    for lc, rc in zip(left, right):
        cond = cond & F.col(lc).eqNullSafe(F.col(rc))
    return cond


def _survey_name(c: str, message_cols: Sequence[str]) -> str:
    """Survey column name in merged output: the shared key ``code`` is internal
    (``_s_code``); a name equal to a message column up to case gets ``_typeform``
    (Spark resolves names case-insensitively)."""
    if c == "code":
        return "_s_code"
    if c.lower() in {m.lower() for m in message_cols}:
        return f"{c}{SURVEY_SUFFIX}"
    return c


def _sides(messages: DataFrame, survey: DataFrame):
    """Rename overlapping columns: equal names get ``_app`` / ``_typeform``,
    names equal up to case get ``_typeform``; the shared key ``code`` is kept
    once (coalesced) as in a merge on equally named keys.
    """
    m = messages
    for c in survey.columns:
        if c != "code" and c in messages.columns:
            m = m.withColumnRenamed(c, f"{c}{APP_SUFFIX}")
    m = m.withColumn("_sday", iso_day("serviceDate"))
    return m, survey.select(*[F.col(c).alias(_survey_name(c, messages.columns)) for c in survey.columns])


def _keys(with_date: bool):
    lk = list(MESSAGE_KEYS) + (["_sday"] if with_date else [])
    rk = [_survey_name(c, MESSAGE_KEYS) for c in RESPONSE_KEYS] + (["visitdate"] if with_date else [])
    return lk, rk


def _day_key(day: Column) -> Column:
    """A day that is never NULL, so that sets of days can hold it."""
    return F.coalesce(F.concat(F.lit("="), day), F.lit(""))


def _marked(m: DataFrame, s: DataFrame) -> DataFrame:
    """Surveys with ``_found`` (a message has the four keys) and ``_same_day`` (one also has the visit day).

    The messages are cut to those that share four keys with a survey before they
    are grouped, so a row per key is only built for keys in use; its set of days is
    bounded by the number of days.
    """
    lk, rk = _keys(False)
    names = [f"_d{i}" for i in range(len(lk))]
    asked = s.select(*[F.col(c).alias(f"_a{i}") for i, c in enumerate(rk)]).distinct()
    days = (
        m.select(*lk, _day_key(F.col("_sday")).alias("_day"))
        .join(asked, _keys_equal(lk, [f"_a{i}" for i in range(len(lk))]), "left_semi")
        .groupBy(*[F.col(c).alias(n) for c, n in zip(lk, names)])
        .agg(F.collect_set("_day").alias("_days"))
    )
    found = s.join(days, _keys_equal(rk, names), "left")
    return found.select(
        *s.columns, F.col("_days").isNotNull().alias("_found"),
        F.coalesce(F.array_contains("_days", _day_key(F.col("visitdate"))), F.lit(False)).alias("_same_day"),
    )


def merge_exact(messages: DataFrame, survey: DataFrame, with_date: bool = True) -> DataFrame:
    """Outer merge of messages and surveys with a ``_merge`` marker.

    Keys: sender = worker phone, patient phone, patient name, code, and the
    service day as ``yyyy-MM-dd`` text = visit date when ``with_date``. NULL
    keys match each other. ``called`` becomes ``called_app`` /
    ``called_typeform``; ``code`` appears once.
    """
    m, s = _sides(messages, survey)
    lk, rk = _keys(with_date)
    hit = F.when(F.col("_hit").isNotNull(), F.lit("both")).otherwise(F.lit("left_only"))
    left = m.join(s.withColumn("_hit", F.lit(True)), _keys_equal(lk, rk), "left").withColumn("_merge", hit).drop("_hit")
    right_only = (
        _marked(m, s).where(~F.col("_same_day" if with_date else "_found"))
        .withColumn("code", F.col("_s_code"))
        .withColumn("_merge", F.lit("right_only"))
    )
    return _finish(left.unionByName(right_only, allowMissingColumns=True), m, s)


def _finish(df: DataFrame, m: DataFrame, s: DataFrame) -> DataFrame:
    cols = [c for c in m.columns if c != "_sday"] + [c for c in s.columns if c != "_s_code"] + ["_merge"]
    return df.select(*cols)


def reconcile_survey(
    messages: DataFrame, survey: DataFrame, share: Callable[[DataFrame], DataFrame] = lambda leftover: leftover
) -> tuple[DataFrame, DataFrame]:
    """Two-pass reconciliation (J9). Returns ``(report, orphans)``.

    Pass 1 matches on the four keys plus the day. Surveys left over are
    matched in pass 2 on the four keys alone, to every message that shares them.
    Surveys with no such message are the orphans. The report is pass-1 matches
    and unmatched messages plus pass-2 matches; a message can appear twice.
    ``share`` may write the marked surveys to a table, for callers that use both results.

    The messages are read once: each one looks for the surveys of its day (pass 1)
    and for those that no day matched (pass 2), both in one left join on the four
    keys, the pass and the day.
    """
    m, s = _sides(messages, survey)
    lk, rk = _keys(False)
    marked = share(_marked(m, s))
    first = F.col("_same_day")
    asked = marked.select(
        *s.columns, F.when(first, 1).otherwise(2).alias("_asked"), F.when(first, _day_key(F.col("visitdate"))).alias("_asked_day"))
    looks = m.withColumn("_pass", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "_look_day", F.when(F.col("_pass") == 1, _day_key(F.col("_sday"))))
    joined = looks.join(
        asked, _keys_equal([*lk, "_look_day"], [*rk, "_asked_day"]) & (F.col("_pass") == F.col("_asked")), "left")
    hit = F.col("_asked").isNotNull()
    report = joined.where(hit | (F.col("_pass") == 1)).withColumn("_merge", F.when(hit, F.lit("both")).otherwise(F.lit("left_only")))
    original = {_survey_name(c, messages.columns): c for c in survey.columns}
    orphans = marked.where(~F.col("_found")).select(*[F.col(c).alias(original[c]) for c in s.columns])
    return _finish(report, m, s).drop(*HIDDEN_COLUMNS), orphans


def orphan_candidates(messages: DataFrame, survey: DataFrame) -> DataFrame:
    """For each final orphan survey, unmatched messages of the same patient phone.

    Gives the number of such messages and the one nearest the visit date
    (``candidate_id``, ``candidate_date``; of one day the latest report). No
    orphan-message pairs are formed: messages and visit dates are reduced to
    one row per phone and day, matched there, and the answer is joined back to
    the orphans, a join whose hot phones Spark can split.
    """
    m, s = _sides(messages, survey)
    lk5, rk5 = _keys(True)
    unmatched = m.join(s.select(*rk5).distinct(), _keys_equal(lk5, rk5), "left_anti")
    _, orphans = reconcile_survey(messages, survey)
    orphans = orphans.select("response_id", "patientphone", "visitdate", F.to_date("visitdate").alias("_visit"))
    wanted = orphans.where(F.col("patientphone").isNotNull())
    seen = unmatched.where(F.col("patientPhone").isNotNull()).select(
        F.col("patientPhone").alias("_phone"), F.to_date("serviceDate").alias("_visit"), "_id", "timestamp"
    ).join(wanted.select(F.col("patientphone").alias("_phone")).distinct(), "_phone", "left_semi")
    per_phone = seen.groupBy("_phone").agg(F.count(F.lit(1)).cast("bigint").alias("n_candidates"))
    days = seen.groupBy("_phone", "_visit").agg(F.max_by("_id", F.struct("timestamp", "_id")).alias("_id"))
    asked = wanted.select(F.col("patientphone").alias("_phone"), "_visit").distinct()
    nearest = nearest_day(days, asked, "_phone", "_visit").where(F.col("_match").isNotNull())
    return (
        wanted.join(nearest, F.col("patientphone").eqNullSafe(F.col("_phone")) & wanted["_visit"].eqNullSafe(nearest["_visit"]), "inner")
        .drop("_phone").join(per_phone, F.col("patientphone") == F.col("_phone"), "inner")
        .select(
            "response_id", "patientphone", "visitdate", "n_candidates",
            F.col("_match._id").alias("candidate_id"),
            F.col("_match._visit").cast("timestamp_ntz").alias("candidate_date"),
        )
    )


def roster_coverage(report: DataFrame, roster: DataFrame) -> DataFrame:
    """Non-training report rows whose worker is missing from the roster (F8, J7):
    one row with the count. :func:`check_roster_coverage` raises on it."""
    missing = report.where(F.col("training") == F.lit(False)).join(
        roster, F.col("paymentPhone") == F.col("reporting_number"), "left_anti"
    )
    return missing.agg(F.count(F.lit(1)).cast("bigint").alias("missing"))


def check_roster_coverage(report: DataFrame, roster: DataFrame) -> None:
    missing = roster_coverage(report, roster).first()["missing"]
    if missing:
        raise ValueError(f"{missing} report rows from numbers missing in the roster")


def with_contact(report: DataFrame, roster: DataFrame) -> DataFrame:
    """Report rows with the worker's ``contact_number`` and whether the roster has the number (``_covered``)."""
    r = roster.select(F.col("reporting_number").alias("_rn"), "contact_number", F.lit(True).alias("_in"))
    joined = report.join(r, F.col("paymentPhone") == F.col("_rn"), "left").drop("_rn")
    return joined.withColumn("_covered", F.coalesce("_in", F.lit(False))).drop("_in")


def uncovered() -> Column:
    """Aggregate over :func:`with_contact`: non-training rows whose number the roster lacks (F8)."""
    return F.count_if((F.col("training") == F.lit(False)) & ~F.col("_covered"))


def null_keys() -> Column:
    """Aggregate over messages: rows with a NULL among the merge keys; they all meet in one join key or few."""
    some = F.lit(False)
    for c in MESSAGE_KEYS:
        some = some | F.col(c).isNull()
    return F.count_if(some)


def final_report(report: DataFrame, roster: DataFrame) -> DataFrame:
    """Report rows of roster workers with the worker's contact number."""
    r = roster.select(F.col("reporting_number").alias("_rn"), "contact_number")
    return report.join(r, F.col("paymentPhone") == F.col("_rn"), "inner").drop("_rn", "_merge")


def unique_visits(messages: DataFrame, order: Sequence[str] = ("timestamp", "_id")) -> DataFrame:
    """First report per (patient, code, service date, patient phone) (A6); NULL keys dropped."""
    return first_per_group(messages, VISIT_ORDER, order, drop_null_keys=True)
