"""Incremental intake of raw reports with Structured Streaming.

The batch jobs re-read every report each day. This keeps a normalised
message table up to date instead: each micro-batch of newly landed raw files
is normalised, reduced to the first copy per ``_id`` (map-side combined) and
appended only for ids the table does not hold yet - the same insert-only rule
as the other upserts, so a retried batch cannot add a second copy.

First-wins here means first *arrived*: a copy that lands in a later batch
never replaces a stored one, even with an earlier report time. The daily
batch dedupe (:func:`fieldreports.operators.enrich.dedupe_messages`) orders by
report time over all data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fieldreports import schemas
from fieldreports.operators.enrich import DEDUPE_ORDER
from fieldreports.operators.maintenance import new_rows
from fieldreports.operators.normalize import normalize_messages
from fieldreports.session import path_exists
from fieldreports.sinks.writers import append_rows


def _existing(spark: SparkSession, table_dir: str) -> DataFrame:
    # the table does not exist before the first batch; any other trouble must
    # stop the batch, which would else be appended a second time
    if not path_exists(spark, table_dir):
        return spark.createDataFrame([], schemas.MESSAGE)
    return spark.read.schema(schemas.MESSAGE).parquet(table_dir)


def start_intake(
    spark: SparkSession,
    raw_dir: str,
    table_dir: str,
    checkpoint_location: str,
    raw_format: str = "parquet",
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the stream ``raw_dir`` → normalised, deduplicated ``table_dir``.

    ``checkpoint_location`` must be on the shared file system (stream
    progress and the list of processed files live there). With
    ``available_now`` the stream processes what has landed and stops, which
    suits a scheduled run; otherwise it triggers every ``processing_time``.
    """
    raw = spark.readStream.schema(schemas.RAW_MESSAGE).format(raw_format).load(raw_dir)
    messages = normalize_messages(raw)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        added = new_rows(_existing(spark, table_dir), batch, ["_id"], list(DEDUPE_ORDER))
        append_rows(added, table_dir)

    writer = messages.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
