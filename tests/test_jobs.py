"""Jobs end to end: land the adapter views as files, run each job through its
readers and sinks, compare with the registered queries."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldreports import schemas
from fieldreports.plans import catalog, jobs
from fieldreports.sinks.writers import read_csv_report
from fieldreports.sources import adapter as A

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="shared test data not present")


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("landed"))
    views = {
        "raw_messages": A.raw_messages(spark, SF),
        "events": A.status_events(spark, SF),
        "roster": A.landed_roster(spark, SF),
        "crosswalk": A.landed_crosswalk(spark, SF),
        "survey_responses": A.survey_responses(spark, SF),
        "legacy_messages": A.legacy_messages(spark, SF),
        "directory": A.existing_directory(spark, SF),
        "queue": A.old_queue(spark, SF),
    }
    specs = {}
    for name, df in views.items():
        path = f"{base}/{name}"
        df.write.parquet(path)
        specs[name] = {"path": path, "format": "parquet"}
    inputs = jobs.Inputs(**specs)
    return base, jobs.load_inputs(spark, inputs)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_payments_job(spark, landed):
    base, data = landed
    w_path, s_path = jobs.run_payments(spark, data, A.AS_OF, f"{base}/out", "t-pay")
    assert rows(read_csv_report(spark, w_path, schemas.PAYMENT)) == rows(catalog.worker_payments(spark, SF))
    assert rows(read_csv_report(spark, s_path, schemas.PAYMENT)) == rows(catalog.super_payments(spark, SF))


def test_calls_job(spark, landed):
    base, data = landed
    path = jobs.run_calls(spark, data, A.AS_OF, f"{base}/queue_out", "t-calls")
    assert rows(spark.read.parquet(path)) == rows(catalog.queue_refresh(spark, SF))


def test_report_job(spark, landed):
    base, data = landed
    report_path, orphan_path = jobs.run_report(spark, data, f"{base}/reports", datetime(2024, 2, 10), "t-rep")
    expected = catalog.reconcile_survey(spark, SF).drop("_merge")
    assert spark.read.option("header", True).csv(report_path).count() == expected.count()
    assert spark.read.option("header", True).csv(orphan_path).count() == catalog.survey_orphans(spark, SF).count()


def test_maintenance_job(spark, landed):
    base, data = landed
    written = jobs.run_maintenance(spark, data, f"{base}/maint", "20240210")
    assert spark.read.parquet(written["directory"]).count() == catalog.directory_upsert(spark, SF).count()
    assert spark.read.parquet(written["events"]).count() == catalog.event_upsert(spark, SF).count()
    assert spark.read.parquet(written["service_dates"]).count() == catalog.repair_dates(spark, SF).count()


def test_duplicate_crosswalk_numbers_fail(spark, landed):
    _, data = landed
    dup = data["crosswalk"].unionByName(data["crosswalk"])
    with pytest.raises(ValueError):
        jobs.validate_dimensions(data["roster"], dup)


def test_cli_payments(spark, landed, tmp_path):
    import json

    base, _ = landed
    specs = {name: {"path": f"{base}/{name}", "format": "parquet"}
             for name in ["raw_messages", "events", "roster", "crosswalk"]}
    inputs = tmp_path / "inputs.json"
    inputs.write_text(json.dumps(specs))
    out = tmp_path / "out"
    jobs.main(["payments", "--inputs", str(inputs), "--as-of", "2024-02-10", "--out", str(out)])
    written = sorted(p.name for p in out.iterdir())
    assert written == ["supers-2024-02-10_00-00", "workers-2024-02-10_00-00"]
    back = read_csv_report(spark, str(out / written[1]), schemas.PAYMENT)
    assert rows(back) == rows(catalog.worker_payments(spark, SF))


def test_calls_job_without_an_old_queue(spark, landed):
    base, data = landed
    fresh = {k: v for k, v in data.items() if k != "queue"}
    path = jobs.run_calls(spark, fresh, A.AS_OF, f"{base}/queue_fresh", "t-calls-fresh")
    out = spark.read.parquet(path)
    # with no old entries every queue holds exactly its new entries, numbered 1..n
    per = {r["district"]: (r["n"], r["lo"], r["hi"]) for r in
           out.groupBy("district").agg(F.count("*").alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi")).collect()}
    assert per and all(lo == 1 and hi == n for n, lo, hi in per.values())


def test_cli_other_jobs(spark, landed, tmp_path):
    import json

    base, _ = landed
    names = ["raw_messages", "events", "roster", "crosswalk", "survey_responses", "legacy_messages", "directory", "queue"]
    specs = {name: {"path": f"{base}/{name}", "format": "parquet"} for name in names}
    inputs = tmp_path / "inputs.json"
    inputs.write_text(json.dumps(specs))
    for job in ["calls", "report", "maintain"]:
        out = tmp_path / job
        jobs.main([job, "--inputs", str(inputs), "--as-of", "2024-02-10", "--out", str(out)])
        assert any(out.iterdir())
    assert spark.read.parquet(str(tmp_path / "calls" / "v=20240210")).count() == catalog.queue_refresh(spark, SF).count()
    assert sorted(p.name for p in (tmp_path / "maintain").iterdir()) == ["directory", "events", "service_dates"]
