"""Incremental survey slices, pruned call candidates, free-form dates."""

import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldreports.functions.dates import parse_visit_date
from fieldreports.operators import calls as C
from fieldreports.plans import catalog
from fieldreports.sources import adapter as A
from fieldreports.sources import slices as S

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.exists(SF), reason="shared test data not present")


def test_free_form_dates_by_token(spark):
    want = {
        "Wednesday, 10th January 2024 3:30 pm": "2024-01-10", "wed 10 jan 2024": "2024-01-10", "Jan 10th, 2024 at 12pm": "2024-01-10",
        "the 3rd of March 2024": "2024-03-03", "2024.01/10": "2024-01-10", "1 2-2024": "2024-01-02", "13.2.2024": "2024-02-13",
        "2/29/2024": "2024-02-29", "2/29/2023": None, "Sept 5 2023": "2023-09-05", "5-may-99": "1999-05-05", "2024 January 5": "2024-01-05",
        "20240110": "2024-01-10", "2024-01-10T12:00:00Z": "2024-01-10", "2024-01-10 23:59 (local)": "2024-01-10",
        "10:30 01/02/24": "2024-01-02", "2024-13-05": "2024-05-13", "0000-01-01": None, "soon": None, "": None, None: None, "1.2": None,
        "Mayday 5 2024": None, "2024-1-2-3": None, "99999999": None, "1.2.123": None, "12 foo 2024": None, "١٢/١/2024": None,
    }
    df = spark.createDataFrame([(t,) for t in want], "t string")
    got = {r["t"]: str(r["d"]) if r["d"] else None for r in df.select("t", parse_visit_date("t").alias("d")).collect()}
    assert got == want


@needs_tables
def test_second_run_reads_only_new_and_late_slices(spark, tmp_dir):
    landed, table, ledger = (os.path.join(tmp_dir, x) for x in ("landed", "responses", "ledger"))
    start, as_of = datetime(2024, 1, 1), datetime(2024, 6, 1)
    rows = A.survey_responses(spark, SF).withColumn("slice", S.slice_of("submitted_at", start)).where("slice IS NOT NULL")
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    names = sorted(r["slice"] for r in rows.select("slice").distinct().collect())
    assert len(names) > 2
    land = lambda df: df.coalesce(1).write.mode("append").partitionBy("slice").option(
        "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(landed)
    early = F.col("response_id") % 5 != 0
    land(rows.where(early & (F.col("slice") < names[-1])))
    run = lambda: S.read_new_slices(spark, landed, table, ledger, start, as_of)
    assert run() == names[:-1] and run() == []
    kept = {f: os.stat(f).st_mtime_ns for f in _files(table)}
    time.sleep(1.1)  # modification times in seconds
    land(rows.where((F.col("slice") == names[-1]) | (~early & (F.col("slice") == names[0]))))
    assert run() == [names[0], names[-1]] and run() == []
    for f, at in kept.items():
        if names[0] not in f:
            assert os.stat(f).st_mtime_ns == at
    got = spark.read.parquet(table).groupBy(F.col("slice").cast("string").alias("slice")).count()
    here = rows.where(early | F.col("slice").isin(names[0], names[-1])).groupBy("slice").count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, here.collect()))
    assert S.pending_slices(spark, landed, ledger, start, datetime(2024, 1, 2)).count() == 0


def _files(folder):
    return [os.path.join(root, n) for root, _, names in os.walk(folder) for n in names if n.startswith("part-")]


@needs_tables
def test_candidates_from_recent_partitions(spark, tmp_dir):
    firsts = C.recent_first_copies(A.messages(spark, SF), A.AS_OF)
    want = catalog.dedupe_messages(spark, SF).where(F.col("timestamp") > F.lit("2024-01-13 00:00:00").cast("timestamp_ntz"))
    ids = lambda df: sorted(map(tuple, df.select("_id", "sourceId").collect()))
    assert ids(firsts) == ids(want) and ids(want)
    keyed = spark.read.schema("_id string, timestamp timestamp_ntz, sourceId bigint, month string")
    A.messages(spark, SF).select("_id", "timestamp", "sourceId", F.date_format("timestamp", "yyyy-MM").alias("month")).write.partitionBy(
        "month").parquet(tmp_dir + "/messages")
    pruned = C.recent_first_copies(keyed.parquet(tmp_dir + "/messages"), A.AS_OF, month="month")
    assert ids(pruned) == ids(want)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(month") == 2, plan
