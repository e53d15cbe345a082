"""Normalisation of landed records (projections and per-row expressions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldreports.constants import MAX_SERVICE_AGE_DAYS, PROVIDED_CARE_QUESTION
from fieldreports.functions.dates import parse_service_date
from fieldreports.functions.ids import message_id


def normalize_columns(raw: Column | None = None, max_age_days: int | None = MAX_SERVICE_AGE_DAYS,
                      fallback: str = "day") -> list[Column]:
    """Column list turning a raw report (top-level columns or the struct ``raw``)
    into a normalised message (N1-N3)."""

    def f(name: str) -> Column:
        return raw.getField(name) if raw is not None else F.col(name)

    name = F.upper(f("Patient_Name"))
    code = F.upper(f("Service_Code"))
    return [
        message_id(f("Service_Date"), name, f("Patient_Phone_Number"), code).alias("_id"),
        parse_service_date(f("Service_Date"), f("Report_Date"), max_age_days, fallback).alias("serviceDate"),
        f("Service_Date").alias("ogServiceDate"),
        f("Patient_Phone_Number").alias("patientPhone"),
        name.alias("patientName"),
        f("Sender_Phone_Number").alias("senderPhone"),
        f("Report_Date").alias("timestamp"),
        code.alias("code"),
    ]


def normalize_messages(raw: DataFrame, keep: Sequence[str] = ("sourceId",)) -> DataFrame:
    """Raw reports → messages: rename, upper-case name and code, parse the
    service date, derive ``_id``. Columns in ``keep`` are carried along."""
    return raw.select(*normalize_columns(), *[F.col(c) for c in keep])


def flatten_survey(responses: DataFrame, question_id: str = PROVIDED_CARE_QUESTION) -> DataFrame:
    """Survey responses → one flat row each.

    ``provided_care`` is the boolean of the first answer to ``question_id``;
    ``called`` says whether that answer exists (an explicit *false* is still a
    call). ``get`` returns NULL for a missing element where ``[0]`` would raise.
    """
    answer = F.get(F.filter("answers", lambda a: a["field"]["id"] == F.lit(question_id)), 0)
    return responses.select(
        "response_id",
        "submitted_at",
        "hidden.workerphone",
        "hidden.worker",
        "hidden.patientphone",
        "hidden.patient",
        "hidden.code",
        "hidden.visitdate",
        "hidden.messageid",
        answer.isNotNull().alias("called"),
        answer["boolean"].alias("provided_care"),
    )


def cast_identifiers(df: DataFrame, cols: Sequence[str] = ("reporting_number", "contact_number")) -> DataFrame:
    """Phone numbers as text."""
    return df.select(*[F.col(c).cast("string").alias(c) if c in cols else F.col(c) for c in df.columns])


def json_payload(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """Row → JSON object text with explicit ``null`` values.

    Timestamps are written as ISO text so the payload does not depend on the
    writer's timestamp format.
    """
    cols = list(cols or df.columns)
    fields = []
    for c in cols:
        dtype = df.schema[c].dataType.simpleString()
        col = F.col(c)
        if dtype.startswith("timestamp") or dtype == "date":
            col = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
        fields.append(col.alias(c))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
