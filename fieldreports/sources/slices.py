"""Incremental reads of survey slices.

Responses land in one folder per request window, ``slice=<first day>``. A ledger table
holds the windows that were read, with the number of files and the newest modification time
seen; a run reads only windows that are new or whose files changed since (late
responses), and replaces just their partitions in the response table. The lists that
reach the driver have one row per window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fieldreports import schemas
from fieldreports.functions.dates import day_start, ts_literal
from fieldreports.session import path_exists
from fieldreports.sinks.writers import append_rows, overwrite_partitions
from fieldreports.sources.readers import JSON_TIMESTAMP_FORMAT, extraction_windows

LEDGER = "slice string, files bigint, newest timestamp"


def slice_of(time, start, weeks: int = 1) -> Column:
    """First day (``yyyy-MM-dd``) of the window of :func:`extraction_windows` that holds ``time``; NULL before ``start``."""
    first = F.to_date(ts_literal(start))
    past = F.datediff(F.to_date(day_start(time)), first)
    day = F.date_add(first, (F.floor(past / (7 * weeks)) * (7 * weeks)).cast("int"))
    return F.when(past >= 0, F.date_format(day, "yyyy-MM-dd"))


def landed_slices(spark: SparkSession, landed: str) -> DataFrame:
    """(slice, files, newest) of the landed folders; metadata only."""
    files = spark.read.format("binaryFile").load(landed).select(F.col("slice").cast("string").alias("slice"), "modificationTime")
    return files.groupBy("slice").agg(F.count(F.lit(1)).alias("files"), F.max("modificationTime").alias("newest"))


def pending_slices(spark: SparkSession, landed: str, ledger: str, start, as_of, weeks: int = 1) -> DataFrame:
    """Landed windows that the ledger does not know in their present state."""
    starts = spark.range(1).select(ts_literal(start).alias("start"))
    windows = extraction_windows(starts, as_of, weeks).select(F.substring("since", 1, 10).alias("slice"))
    found = landed_slices(spark, landed).join(windows, "slice", "left_semi")
    if not path_exists(spark, ledger):
        return found
    return found.join(spark.read.schema(LEDGER).parquet(ledger), ["slice", "files", "newest"], "left_anti")


def read_new_slices(spark: SparkSession, landed: str, table: str, ledger: str, start, as_of,
                    weeks: int = 1, fmt: str = "json") -> list[str]:
    """Bring the response table (parquet by ``slice``) up to date; returns the slices that were read.

    The ledger is written last: a run that dies is repeated, and replacing a slice's
    partition twice gives the same table. A slice whose files are all gone keeps its rows.
    """
    todo = pending_slices(spark, landed, ledger, start, as_of, weeks).collect()
    names = sorted(r["slice"] for r in todo)
    if names:
        schema = StructType([*schemas.SURVEY_RESPONSE.fields, StructField("slice", StringType())])
        reader = spark.read.schema(schema).format(fmt)
        if fmt == "json":
            reader = reader.option("timestampNTZFormat", JSON_TIMESTAMP_FORMAT)
        overwrite_partitions(reader.load(landed).where(F.col("slice").isin(names)), table, ["slice"])
        append_rows(spark.createDataFrame(todo, LEDGER).coalesce(1), ledger)
    return names
