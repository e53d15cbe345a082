"""Declared schemas. Nothing is inferred at read time."""

from pyspark.sql import types as T

S = T.StringType()
TS = T.TimestampNTZType()
B = T.BooleanType()
L = T.LongType()
I = T.IntegerType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# A report as it arrives from the SMS gateway. ``sourceId`` is the landing id of
# the record; it breaks ties when duplicates are dropped.
RAW_MESSAGE = _struct(
    ("Report_Date", TS),
    ("Service_Date", S),
    ("Patient_Name", S),
    ("Patient_Phone_Number", S),
    ("Sender_Phone_Number", S),
    ("Service_Code", S),
    ("sourceId", L),
)

# A normalised report.
MESSAGE = _struct(
    ("_id", S),
    ("serviceDate", TS),
    ("ogServiceDate", S),
    ("patientPhone", S),
    ("patientName", S),
    ("senderPhone", S),
    ("timestamp", TS),
    ("code", S),
    ("sourceId", L),
)

# Roster as landed from the spreadsheet export: numbers are numeric,
# the training date is text ``dd.mm.yy``.
ROSTER_LANDED = _struct(
    ("reporting_number", L),
    ("contact_number", L),
    ("name", S),
    ("chw_district", S),
    ("training_date", S),
    ("treat", I),
    ("phone_ps", S),
)

ROSTER = _struct(
    ("reporting_number", S),
    ("contact_number", S),
    ("name", S),
    ("chw_district", S),
    ("training_date", TS),
    ("treat", I),
    ("phone_ps", S),
)

# The worker directory has the roster's columns.
DIRECTORY = ROSTER

# Number-change sheet as landed: ``z08_2`` holds the old number.
CROSSWALK_LANDED = _struct(("z08_2", L), ("new_payment_number", L))
CROSSWALK = _struct(("old_number", S), ("new_payment_number", S))

# Status event: one of called / attempted / noConsent about one report.
EVENT = T.StructType(
    [
        T.StructField("event", S, True),
        T.StructField("event_time", TS, True),
        T.StructField("record", MESSAGE, True),
        T.StructField("updates", _struct(("code", S)), True),
    ]
)

# Report as kept by the older application: flags instead of events.
LEGACY_MESSAGE = T.StructType(
    [
        T.StructField("_id", S, True),
        T.StructField("originalEntry", RAW_MESSAGE, True),
        T.StructField("code", S, True),
        T.StructField("called", B, True),
        T.StructField("noConsent", B, True),
        T.StructField("attempts", T.ArrayType(TS, True), True),
        T.StructField("serviceDate", TS, True),
    ]
)

SURVEY_HIDDEN = _struct(
    ("workerphone", S),
    ("worker", S),
    ("patientphone", S),
    ("patient", S),
    ("code", S),
    ("visitdate", S),
    ("messageid", S),
)

SURVEY_ANSWER = T.StructType(
    [
        T.StructField("field", _struct(("id", S)), True),
        T.StructField("type", S, True),
        T.StructField("boolean", B, True),
    ]
)

# Call-survey response as delivered by the form service (landed JSON).
SURVEY_RESPONSE = T.StructType(
    [
        T.StructField("response_id", L, True),
        T.StructField("submitted_at", TS, True),
        T.StructField("hidden", SURVEY_HIDDEN, True),
        T.StructField("answers", T.ArrayType(SURVEY_ANSWER, True), True),
    ]
)

SURVEY_ROW = _struct(
    ("response_id", L),
    ("submitted_at", TS),
    ("workerphone", S),
    ("worker", S),
    ("patientphone", S),
    ("patient", S),
    ("code", S),
    ("visitdate", S),
    ("messageid", S),
    ("called", B),
    ("provided_care", B),
)

# Per-district call queue; the highest ``seq`` is the newest entry.
QUEUE = _struct(("district", S), ("seq", L), ("payload", S))

PAYMENT = _struct(
    ("number", S),
    ("payment", L),
    ("reports", L),
    ("payment_due", TS),
)
