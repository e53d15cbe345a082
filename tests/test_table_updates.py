"""In-place updates: queue by district, repair of legacy dates, keyed updates."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldreports import schemas
from fieldreports.operators import calls as C
from fieldreports.operators import maintenance as M
from fieldreports.plans import catalog, jobs
from fieldreports.sinks import writers as W
from fieldreports.sources import adapter as A

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.exists(SF), reason="shared test data not present")


def files(folder):
    """Data files and their modification times."""
    found = {}
    for root, _, names in os.walk(folder):
        for n in names:
            if n.startswith("part-"):
                found[os.path.join(root, n)] = os.stat(os.path.join(root, n)).st_mtime_ns
    return found


def inputs(spark):
    return {"raw": A.raw_messages(spark, SF), "events": A.status_events(spark, SF), "roster": A.roster(spark, SF),
            "crosswalk": A.crosswalk(spark, SF)}


def queue_rows(df):
    return sorted((tuple(r) for r in df.select("district", "seq", "payload").collect()), key=str)


@needs_tables
def test_queue_table_leaves_other_districts_alone(spark, tmp_dir):
    table = os.path.join(tmp_dir, "queue")
    A.old_queue(spark, SF).write.partitionBy("district").parquet(table)
    before = files(table)
    written = jobs.refresh_queue_table(spark, inputs(spark), A.AS_OF, table, "t-queue")
    read = lambda: spark.read.schema(schemas.QUEUE).parquet(table)
    want = queue_rows(catalog.queue_refresh(spark, SF))
    assert queue_rows(read()) == want
    after = files(table)
    closed = {f for f in before if "closed" in f}
    assert closed and all(after.get(f) == before[f] for f in closed)
    assert written and not any("closed" in (d or "") for d in written)
    assert not os.path.exists(f"{table}/_staged/20240210")
    # the same date again pushes nothing twice
    assert jobs.refresh_queue_table(spark, inputs(spark), A.AS_OF, table, "t-queue2") == []
    assert files(table) == after


@needs_tables
def test_queue_table_goes_on_after_a_crash(spark, tmp_dir, monkeypatch):
    table = os.path.join(tmp_dir, "queue")

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "overwrite_partitions", fail)
        with pytest.raises(RuntimeError):
            jobs.refresh_queue_table(spark, inputs(spark), A.AS_OF, table, "t-crash")
    # the second run needs no input any more: the staged content is complete
    assert jobs.refresh_queue_table(spark, {}, A.AS_OF, table, "t-crash2")
    fresh = C.push_entries(spark.createDataFrame([], schemas.QUEUE), C.queue_batches(catalog._enriched(spark, SF), A.AS_OF), 2)
    assert queue_rows(spark.read.schema(schemas.QUEUE).parquet(table)) == queue_rows(fresh)


@needs_tables
def test_one_pass_batches_equal_the_separate_ones(spark):
    e = catalog._enriched(spark, SF)
    both = C.queue_batches(e, A.AS_OF)
    calls, training = C.queue_entries(C.call_batch(e, A.AS_OF)), C.queue_entries(C.training_batch(e))
    cols = ["district", "payload", "_order"]
    for n, one in ((1, calls), (2, training)):
        got = sorted((tuple(r) for r in both.where(F.col("_batch") == n).select(*cols).collect()), key=str)
        assert got and got == sorted((tuple(r) for r in one.select(*cols).collect()), key=str)


@needs_tables
def test_repair_rewrites_only_partitions_with_wrong_dates(spark, tmp_dir):
    table = os.path.join(tmp_dir, "legacy")
    legacy = A.legacy_messages(spark, SF)
    codes = sorted(r["code"] for r in legacy.select("code").distinct().collect())
    fixed = M.repaired_messages(legacy)
    # all codes but the first are right already
    mixed = legacy.where(F.col("code") == codes[0]).unionByName(fixed.where(F.col("code") != codes[0]))
    mixed.write.partitionBy("code").parquet(table)
    before = files(table)
    n = jobs.repair_legacy_table(spark, table, "t-repair")
    assert n == M.date_repairs(legacy.where(F.col("code") == codes[0])).count() > 0
    read = spark.read.schema(schemas.LEGACY_MESSAGE).parquet(table).select("_id", "code", "called", "noConsent", "serviceDate")
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, catalog.repaired_messages(spark, SF).collect()))
    after = files(table)
    kept = {f for f in before if f"code={codes[0]}" not in f}
    assert kept and all(after.get(f) == before[f] for f in kept)
    assert jobs.repair_legacy_table(spark, table, "t-repair2") == 0 and files(table) == after


def test_update_by_key(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (2, "c", 3.0), (None, "d", 4.0)], "k int, t string, v double")
    updates = spark.createDataFrame([(2, 9.0), (None, None), (7, 1.0), (2, 9.5)], "k int, v double")
    got = M.update_by_key(target, updates, ["k"], ["v"])
    assert got.columns == target.columns
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [(1, "a", 1.0), (2, "b", 9.0), (2, "c", 9.0), (None, "d", None)], key=str)


PAY = "number string, payment int"


def test_failing_writer_keeps_the_old_report(spark, tmp_dir):
    ts = datetime(2018, 6, 10, 1, 0)
    df = spark.createDataFrame([("01", 1), ("02", 2)], PAY)
    path = W.write_csv_report(df, tmp_dir, "workers", ts)
    assert W.manifest(spark, path)["files"]
    before = files(path)
    bad = spark.range(0, 8, 1, 4).select(
        F.when(F.col("id") == 7, F.raise_error(F.lit("broken row"))).otherwise(F.col("id").cast("string")).alias("number"),
        F.lit(1).alias("payment"))
    with pytest.raises(Exception, match="broken row"):
        W.write_csv_report(bad, tmp_dir, "workers", ts)
    assert files(path) == before and os.listdir(tmp_dir) == ["workers-2018-06-10_01-00"]
    W.write_csv_report(df.limit(1), tmp_dir, "workers", ts)
    assert spark.read.option("header", True).csv(path).count() == 1 and os.listdir(tmp_dir) == ["workers-2018-06-10_01-00"]


def test_publish_that_was_cut_short(spark, tmp_dir):
    ts = datetime(2018, 6, 10, 1, 0)
    path = W.write_csv_report(spark.createDataFrame([("01", 1)], PAY), tmp_dir, "workers", ts)
    before = W._beside(path, "replaced")
    os.rename(path, before)  # between the two renames
    W.recover(spark, path)
    assert os.listdir(tmp_dir) == ["workers-2018-06-10_01-00"]
    os.makedirs(before)  # after both, before the removal
    W.recover(spark, path)
    assert os.listdir(tmp_dir) == ["workers-2018-06-10_01-00"] and spark.read.option("header", True).csv(path).count() == 1


@needs_tables
def test_report_job_checks_coverage_before_it_publishes(spark, tmp_dir):
    data = {**inputs(spark), "responses": A.survey_responses(spark, SF)}
    ts = datetime(2024, 2, 10)
    with pytest.raises(ValueError, match="missing in the roster"):
        jobs.run_report(spark, data, tmp_dir, ts, "t-guard", roster=A.existing_directory(spark, SF))
    assert os.listdir(tmp_dir) == []
    report, orphans = jobs.run_report(spark, data, tmp_dir, ts, "t-guard2")
    assert sorted(os.listdir(tmp_dir)) == ["final-2024-02-10_00-00", "orphans-2024-02-10_00-00", "reports-2024-02-10_00-00"]
    final = spark.read.option("header", True).csv(os.path.join(tmp_dir, "final-2024-02-10_00-00"))
    assert final.count() == catalog.final_report(spark, SF).count() and "contact_number" in final.columns
    counted = W.manifest(spark, report)["counted"]
    assert counted["uncovered"] == 0 and counted["rows"] == catalog.reconcile_survey(spark, SF).count()
    assert counted["null_merge_keys"] == catalog.quality_counts(spark, SF).first()["null_merge_keys"] > 0
    assert W.manifest(spark, orphans)["files"]
