import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldreports import schemas
from fieldreports.sinks.writers import read_csv_report, write_csv_report, write_table_version
from fieldreports.sources import readers as R


def test_latest_file(spark, tmp_dir):
    for i, name in enumerate(["a.csv", "b.csv", "c.csv"]):
        p = os.path.join(tmp_dir, name)
        with open(p, "w") as fh:
            fh.write("x\n")
        os.utime(p, (time.time(), 1_600_000_000 + [50, 90, 10][i]))
    row = R.latest_file(spark, tmp_dir, "*.csv").first()
    assert row["path"].endswith("b.csv")


def test_extraction_windows(spark):
    starts = spark.createDataFrame([(datetime(2018, 5, 1),)], "start timestamp_ntz")
    rows = R.extraction_windows(starts, datetime(2018, 5, 20)).orderBy("since").collect()
    assert [(r["since"], r["until"]) for r in rows] == [
        ("2018-05-01T00:00:00", "2018-05-08T00:00:00"),
        ("2018-05-08T00:00:00", "2018-05-15T00:00:00"),
        ("2018-05-15T00:00:00", "2018-05-22T00:00:00"),
    ]
    assert R.extraction_windows(starts, datetime(2018, 5, 1)).count() == 0


def test_load_roster(spark):
    landed = spark.createDataFrame([(12, 13, "n", "d", "05.12.22", 2, "5001")], schemas.ROSTER_LANDED)
    row = R.load_roster(landed).first()
    assert row["reporting_number"] == "12" and row["training_date"] == datetime(2022, 12, 5)
    bad = spark.createDataFrame([(12, 13, "n", "d", "2022-12-05", 2, "5001")], schemas.ROSTER_LANDED)
    with pytest.raises(Exception):
        R.load_roster(bad).collect()


def test_load_crosswalk_treats_nan_as_missing(spark):
    landed = spark.createDataFrame([("1", "nan"), ("2", "20"), ("3", "")], "z08_2 string, new_payment_number string")
    rows = sorted(tuple(r) for r in R.load_crosswalk(landed).collect())
    assert rows == [("1", None), ("2", "20"), ("3", None)]


def test_csv_report_round_trip(spark, tmp_dir):
    df = spark.createDataFrame(
        [("01", 12000, 1, datetime(2018, 2, 2)), ("02", 10000, 3, datetime(2018, 4, 2))], schemas.PAYMENT
    )
    path = write_csv_report(df, tmp_dir, "workers", datetime(2018, 6, 10, 1, 0))
    assert path.endswith("workers-2018-06-10_01-00")
    back = read_csv_report(spark, path, schemas.PAYMENT)
    assert sorted(back.collect()) == sorted(df.collect())


def test_table_versions_rerun_replaces_only_its_version(spark, tmp_dir):
    df = spark.createDataFrame([("d", 1, "x")], schemas.QUEUE)
    table = os.path.join(tmp_dir, "queue")
    first = write_table_version(df, table, "20240209")
    path = write_table_version(df, table, "20240210")
    write_table_version(df, table, "20240210")       # rerun of the same day
    assert spark.read.parquet(path).count() == 1
    assert spark.read.parquet(first).count() == 1
    assert spark.read.parquet(table).count() == 2    # one row per version


def test_survey_responses_read_from_landed_json(spark, tmp_dir):
    from fieldreports.operators.normalize import flatten_survey
    from fieldreports.sources import adapter as A

    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("shared test data not present")
    responses = A.survey_responses(spark, sf)
    path = os.path.join(tmp_dir, "responses")
    responses.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    back = R.read_survey_responses(spark, path)
    assert back.schema == schemas.SURVEY_RESPONSE
    assert sorted(flatten_survey(back).collect()) == sorted(flatten_survey(responses).collect())
