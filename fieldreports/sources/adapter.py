"""Domain views over the shared test tables.

The shared test data is a generic star schema plus an ``events`` table. These
functions derive the application's inputs from it with deterministic rules so
that every view grows with the scale factor:

* raw reports from ``events`` (``k`` = the integer ``props.k``),
* roster and number changes from ``customer`` + ``nation``,
* status events, survey responses and legacy messages from the reports,
* an old call queue from ``nation``; an existing directory from the roster.

The DuckDB oracle in ``__spark_entry__.py`` repeats the same rules in SQL.
"""

from __future__ import annotations

import weakref
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldreports import schemas
from fieldreports.operators.enrich import dedupe_messages
from fieldreports.operators.common import first_per_group
from fieldreports.operators.normalize import PROVIDED_CARE_QUESTION, normalize_messages
from fieldreports.functions.ids import message_id
from fieldreports.functions.dates import parse_service_date
from fieldreports.sources.readers import load_crosswalk, load_roster

# Fixed values of the adapter rules.
AS_OF = datetime(2024, 2, 10)
OLD_TRAINING_DAY = "2022-12-05"
TRAINING_BASE_DAY = "2023-11-01"
CROSSWALK_OFFSET = 1000000
EXTRA_CROSSWALK = (14, 1000011)
SUPERVISOR_BASE = 5000
DUPLICATE_ID_OFFSET = 1000000


# Declared schemas of the shared test tables this adapter reads.
TEST_TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}

# The shared test tables are read-only, so a session reads each one once:
# later uses reuse the DataFrame (no repeated file listing).
_READS: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared test table, read with its declared schema."""
    path = f"{sf_dir}/{name}.parquet"
    reads = _READS.setdefault(spark, {})
    if path not in reads:
        reader = spark.read
        if name in TEST_TABLE_SCHEMAS:
            reader = reader.schema(TEST_TABLE_SCHEMAS[name])
        reads[path] = reader.parquet(path)
    return reads[path]


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def _day_text(ts: Column, shift_days: Column, fmt: str) -> Column:
    return F.date_format(F.date_add(F.to_date(ts), shift_days.cast("int")), fmt)


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reports, one per ``events`` row."""
    e = table(spark, sf_dir, "events")
    k = _k(F.col("props"))
    ts = F.col("ts").cast("timestamp_ntz")
    service = (
        F.when(k % 19 == 0, F.lit("31.02.2024"))
        .when(k % 23 == 0, F.lit("unknown"))
        .when(k % 37 == 0, F.lit("01.01.0000"))
        .when(k % 29 == 0, _day_text(ts, F.lit(3), "dd.MM.yyyy"))
        .when(k % 31 == 0, _day_text(ts, F.lit(-70), "dd.MM.yyyy"))
        .when(k % 2 == 0, _day_text(ts, -(k % 5), "dd-MM-yyyy"))
        .otherwise(_day_text(ts, -(k % 5), "dd/MM/yyyy"))
    )
    sender = F.when(F.col("event_id") % 101 == 0, F.lit(None).cast("string")).otherwise(
        F.col("user_id").cast("string")
    )
    return e.select(
        ts.alias("Report_Date"),
        service.alias("Service_Date"),
        F.concat(F.lit("patient "), (F.col("user_id") % 3).cast("string")).alias("Patient_Name"),
        k.cast("string").alias("Patient_Phone_Number"),
        sender.alias("Sender_Phone_Number"),
        F.substring("event_type", 1, 1).alias("Service_Code"),
        F.col("event_id").cast("bigint").alias("sourceId"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_messages(raw_messages(spark, sf_dir))


def landed_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    trained = F.when(key % 10 == 7, F.to_date(F.lit(OLD_TRAINING_DAY))).otherwise(
        F.date_add(F.to_date(F.lit(TRAINING_BASE_DAY)), ((key * 7) % 75).cast("int"))
    )
    # nation is a fixed 25-row dimension.
    return (
        c.where(key % 15 != 14)
        .join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"], "inner")
        .select(
            key.cast("bigint").alias("reporting_number"),
            key.cast("bigint").alias("contact_number"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("chw_district"),
            F.date_format(trained, "dd.MM.yy").alias("training_date"),
            (key % 4).cast("int").alias("treat"),
            (F.lit(SUPERVISOR_BASE) + key % 20).cast("string").alias("phone_ps"),
        )
    )


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_roster(landed_roster(spark, sf_dir))


def landed_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    changed = c.where(key % 11 == 0).select(
        key.cast("bigint").alias("z08_2"), (key + CROSSWALK_OFFSET).cast("bigint").alias("new_payment_number")
    )
    old, new = EXTRA_CROSSWALK
    extra = spark.range(1).select(
        F.lit(old).cast("bigint").alias("z08_2"), F.lit(new).cast("bigint").alias("new_payment_number")
    )
    return changed.unionByName(extra)


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_crosswalk(landed_crosswalk(spark, sf_dir))


def status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events about raw reports (before dedupe): k%6 called, k%7 attempted,
    k%13 noConsent; plus events about unknown ids for k%41.

    The record struct is built above the generator so that Catalyst can prune
    it to the fields a consumer reads (the flags only need ``record._id``).
    """
    m = messages(spark, sf_dir)
    k = F.col("patientPhone").cast("int")
    no_update = F.lit(None).cast("struct<code:string>")

    def kind(cond: Column, name: str, updates: Column, unknown: bool) -> Column:
        return F.when(
            cond,
            F.struct(F.lit(name).alias("event"), updates.alias("updates"), F.lit(unknown).alias("unknown")),
        )

    kinds = F.array(
        kind(k % 6 == 0, "called", F.struct(F.col("code").alias("code")), False),
        kind(k % 7 == 0, "attempted", no_update, False),
        kind(k % 13 == 0, "noConsent", no_update, False),
        kind(k % 41 == 0, "called", no_update, True),
        kind(k % 43 == 0, "visited", no_update, False),  # a name no flag knows
    )
    exploded = m.select("*", F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("_e"))
    record_id = F.when(F.col("_e.unknown"), F.concat(F.lit("x"), F.col("sourceId").cast("string"))).otherwise(
        F.col("_id")
    )
    record = F.struct(*[record_id.alias("_id") if f.name == "_id" else F.col(f.name) for f in schemas.MESSAGE.fields])
    return exploded.select(
        F.col("_e.event").alias("event"),
        F.col("timestamp").alias("event_time"),
        record.alias("record"),
        F.col("_e.updates").alias("updates"),
    )


def survey_responses(spark: SparkSession, sf_dir: str, deduped: DataFrame | None = None) -> DataFrame:
    """One response per deduped report with k%6=0, plus a contradicting copy
    for ``sourceId % 4 = 0``.

    ``deduped`` may pass already deduplicated messages (for example the
    enriched table of the same run) so they are not derived again.
    """
    k = F.col("patientPhone").cast("int")
    if deduped is not None:
        d = deduped.where(k % 6 == 0)
    else:
        # k comes from the patient phone, which is part of the id, so every copy
        # of an id has the same k: filtering before the dedupe keeps the result
        # and sends a sixth of the rows through the shuffle.
        d = dedupe_messages(messages(spark, sf_dir).where(k % 6 == 0))
    visit = F.date_add(F.to_date("serviceDate"), F.when(k % 18 == 0, 1).otherwise(0))
    visit_text = (
        F.when(k % 36 == 0, F.date_format(visit, "MM.dd.yyyy"))
        .when(k % 66 == 0, F.lit("soon"))
        .when(k % 30 == 0, F.concat(F.date_format(visit, "yyyy-MM-dd"), F.lit("T12:00:00Z")))
        .when(k % 42 == 0, F.date_format(visit, "d MMM yyyy"))
        .when(k % 78 == 0, F.date_format(visit, "M/d/yy"))
        .when(k % 102 == 0, F.date_format(visit, "yyyyMMdd"))
        .when(k % 114 == 0, F.date_format(visit, "EEEE, d'th of' MMMM yyyy 'at 3:30 pm'"))
        .when(k % 138 == 0, F.date_format(visit, "yyyy.MM/dd"))
        .otherwise(F.date_format(visit, "yyyy-MM-dd"))
    )
    hidden = F.struct(
        F.col("senderPhone").alias("workerphone"),
        F.concat(F.lit("w"), F.col("senderPhone")).alias("worker"),
        F.when(k % 54 == 0, F.concat(F.lit("9"), F.col("patientPhone")))
        .otherwise(F.col("patientPhone"))
        .alias("patientphone"),
        # a wrong name leaves an orphan whose phone other reports share
        F.when(k % 90 == 0, F.lit("someone")).otherwise(F.lower("patientName")).alias("patient"),
        F.lower("code").alias("code"),
        visit_text.alias("visitdate"),
        F.col("_id").alias("messageid"),
    )
    other = F.struct(
        F.struct(F.lit("other").alias("id")).alias("field"),
        F.lit("text").alias("type"),
        F.lit(None).cast("boolean").alias("boolean"),
    )

    def answers(care: Column) -> Column:
        asked = F.struct(
            F.struct(F.lit(PROVIDED_CARE_QUESTION).alias("id")).alias("field"),
            F.lit("boolean").alias("type"),
            care.alias("boolean"),
        )
        return F.when(k % 60 == 0, F.array(other)).otherwise(F.array(other, asked))

    care = k % 12 == 0
    # the response and, for every fourth report, a later copy that contradicts it
    copies = F.array(
        F.struct(F.lit(0).cast("bigint").alias("shift"), F.lit(0).alias("hours"), care.alias("care")),
        F.when(F.col("sourceId") % 4 == 0, F.struct(
            F.lit(DUPLICATE_ID_OFFSET).cast("bigint").alias("shift"), F.lit(1).alias("hours"), (~care).alias("care"))),
    )
    rows = d.withColumn("_copy", F.explode(F.filter(copies, lambda c: c.isNotNull())))
    return rows.select(
        (F.col("sourceId") + F.col("_copy.shift")).alias("response_id"),
        (F.col("timestamp") + F.make_interval(days=F.lit(2), hours=F.col("_copy.hours"))).alias("submitted_at"),
        hidden.alias("hidden"),
        answers(F.col("_copy.care")).alias("answers"),
    )


def legacy_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports as the older application kept them: one per id, with flags."""
    raw = raw_messages(spark, sf_dir).withColumn(
        "_id",
        message_id("Service_Date", F.upper("Patient_Name"), "Patient_Phone_Number", F.upper("Service_Code")),
    )
    first = first_per_group(raw, ["_id"], ["Report_Date", "sourceId"])
    k = F.col("Patient_Phone_Number").cast("int")
    ts = F.col("Report_Date")
    attempts = (
        F.when(k % 17 == 0, F.lit(None).cast("array<timestamp_ntz>"))
        .when(k % 7 == 0, F.array(ts, ts + F.make_interval(days=F.lit(1))))
        .when(k % 11 == 0, F.array(ts))
        .otherwise(F.array().cast("array<timestamp_ntz>"))
    )
    return first.select(
        "_id",
        F.struct(*[F.col(f.name) for f in schemas.RAW_MESSAGE.fields]).alias("originalEntry"),
        F.upper("Service_Code").alias("code"),
        (k % 6 == 0).alias("called"),
        (k % 13 == 0).alias("noConsent"),
        attempts.alias("attempts"),
        parse_service_date("Service_Date", "Report_Date").alias("serviceDate"),
    )


def old_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An existing call queue: ``n_nationkey % 5`` entries per district, a thousand
    times as many where ``n_nationkey % 10 = 4``, and three in some districts that
    no batch touches."""
    n = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    open_ones = n.select(
        F.col("n_name").alias("district"), (key % 5 * F.when(key % 10 == 4, 1000).otherwise(1)).alias("n"))
    closed = n.where(key % 6 == 0).select(F.concat(F.lit("closed "), "n_name").alias("district"), F.lit(3).alias("n"))
    return (
        open_ones.unionByName(closed)
        .where(F.col("n") > 0)
        .select("district", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("seq"))
        .select(
            "district",
            F.col("seq").cast("bigint").alias("seq"),
            F.concat(F.lit('{"old":'), F.col("seq").cast("string"), F.lit("}")).alias("payload"),
        )
    )


def existing_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The worker directory before the upsert: roster rows with an even number."""
    return roster(spark, sf_dir).where(F.col("reporting_number").cast("bigint") % 2 == 0)
