"""Readers for landed data.

Every reader declares its schema. The operational stores of the original
application (document store, key-value queue, form service, spreadsheets) are
replaced by landed files that Spark reads in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldreports import schemas
from fieldreports.constants import EVENT_NAMES
from fieldreports.functions.dates import iso_timestamp, parse_roster_date, ts_literal


def _read(spark: SparkSession, path: str, schema, fmt: str) -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)


def read_raw_messages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Raw reports."""
    return _read(spark, path, schemas.RAW_MESSAGE, fmt)


def read_events(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Status events."""
    return _read(spark, path, schemas.EVENT, fmt)


def read_legacy_messages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, schemas.LEGACY_MESSAGE, fmt)


# Timestamps in landed JSON keep microseconds.
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def read_survey_responses(spark: SparkSession, path: str, fmt: str = "json",
                          timestamp_format: str = JSON_TIMESTAMP_FORMAT) -> DataFrame:
    """Survey responses (S6). All weekly slices under ``path`` are one read."""
    reader = spark.read.schema(schemas.SURVEY_RESPONSE).format(fmt)
    if fmt == "json":
        reader = reader.option("timestampNTZFormat", timestamp_format)
    return reader.load(path)


def load_roster(landed: DataFrame, strict: bool = True) -> DataFrame:
    """Landed roster → roster (S3): numbers as text, ``dd.mm.yy`` → timestamp.

    With ``strict`` an unparseable training date fails the job, as the sheet
    loader did; otherwise it becomes NULL.
    """
    parsed = parse_roster_date("training_date")
    if strict:
        parsed = F.when(
            F.col("training_date").isNotNull() & parsed.isNull(),
            F.raise_error(F.concat(F.lit("bad roster training_date: "), F.col("training_date"))),
        ).otherwise(parsed)
    return landed.select(
        F.col("reporting_number").cast("string").alias("reporting_number"),
        F.col("contact_number").cast("string").alias("contact_number"),
        "name",
        "chw_district",
        parsed.cast("timestamp_ntz").alias("training_date"),
        F.col("treat").cast("int").alias("treat"),
        F.col("phone_ps").cast("string").alias("phone_ps"),
    )


def read_roster(spark: SparkSession, path: str, fmt: str = "parquet", **csv_options) -> DataFrame:
    reader = spark.read.schema(schemas.ROSTER_LANDED).format(fmt)
    for k, v in csv_options.items():
        reader = reader.option(k, v)
    return load_roster(reader.load(path))


def _number_text(c: Column) -> Column:
    """Number → text; empty or ``nan`` text counts as missing."""
    t = F.trim(c.cast("string"))
    return F.when((t == "") | (F.lower(t) == "nan"), F.lit(None).cast("string")).otherwise(t)


def load_crosswalk(landed: DataFrame) -> DataFrame:
    """Landed number changes → ``(old_number, new_payment_number)`` text."""
    return landed.select(
        _number_text(F.col("z08_2")).alias("old_number"),
        _number_text(F.col("new_payment_number")).alias("new_payment_number"),
    )


def read_crosswalk(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return load_crosswalk(_read(spark, path, schemas.CROSSWALK_LANDED, fmt))


def file_listing(spark: SparkSession, directory: str, glob: str = "*") -> DataFrame:
    """``(path, modificationTime, length)`` of the files under ``directory``.

    Uses the ``binaryFile`` source with only metadata columns selected, so
    file contents are not read.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(directory)
        .select("path", "modificationTime", "length")
    )


def latest_file(spark: SparkSession, directory: str, glob: str = "*") -> DataFrame:
    """The newest file under ``directory`` (S5, O3): one row ``(path, modificationTime)``."""
    files = file_listing(spark, directory, glob)
    newest = F.max_by(F.col("path"), F.struct("modificationTime", "path"))
    return files.agg(newest.alias("path"), F.max("modificationTime").alias("modificationTime"))


def extraction_windows(starts: DataFrame, as_of, weeks: int = 1, start_col: str = "start") -> DataFrame:
    """Consecutive ``weeks``-long request windows from each start while the
    window start is before ``as_of`` (S7). ISO text ``since`` / ``until``."""
    now = ts_literal(as_of)
    step = F.make_dt_interval(F.lit(7 * weeks))
    start = F.col(start_col).cast("timestamp_ntz")
    seq = F.when(start < now, F.sequence(start, now, step))
    w = starts.select(F.explode(seq).alias("since")).where(F.col("since") < now)
    return w.select(
        iso_timestamp("since").alias("since"),
        iso_timestamp(F.col("since") + step).alias("until"),
    )


# The legacy flag kinds are the status event names.
LEGACY_KINDS = EVENT_NAMES


def legacy_with_flag(legacy: DataFrame, kind: str) -> DataFrame:
    """Legacy messages carrying one kind of flag."""
    if kind == "called":
        return legacy.where(F.col("called") == F.lit(True))
    if kind == "attempted":
        return legacy.where(F.coalesce(F.size("attempts") > 0, F.lit(False)))
    if kind == "noConsent":
        return legacy.where(F.col("noConsent") == F.lit(True))
    raise ValueError(f"unknown event kind {kind!r}; expected one of {LEGACY_KINDS}")
