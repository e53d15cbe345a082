from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldreports.operators import enrich as E

TRAINED = datetime(2021, 6, 10)
ROSTER = "reporting_number string, contact_number string, phone_ps string, treat int, training_date timestamp_ntz, name string, chw_district string"
REPORT = "_id string, senderPhone string, note string, serviceDate timestamp_ntz"
EVENT = "event string, event_time timestamp_ntz, record struct<_id:string>"


@pytest.fixture()
def roster(spark):
    return spark.createDataFrame(
        [(f"700{i}", f"800{i}", f"90{i % 2}", i % 4, TRAINED, f"Worker {i}", "North") for i in range(5)], ROSTER)


@pytest.fixture()
def reports(spark):
    """Two reports of 7000 (one on the training day), one of 7003, one of a number outside the roster."""
    return spark.createDataFrame([
        ("r1", "7000", "a", datetime(2021, 6, 10, 16, 0)),
        ("r2", "7003", "b", datetime(2021, 7, 1, 8, 30)),
        ("r3", "7000", "c", datetime(2021, 7, 2, 9, 15)),
        ("r4", "6666", "d", None),
    ], REPORT)


def changes(spark, *pairs):
    return spark.createDataFrame(list(pairs), "old_number string, new_payment_number string")


def column(df, name):
    return {r["_id"]: r[name] for r in df.collect()}


def test_a_changed_number_replaces_the_roster_number(spark, roster):
    now = E.translate_numbers(roster, changes(spark, ("7001", "7901")), "reporting_number", "reporting_number")
    assert sorted(r["reporting_number"] for r in now.collect()) == ["7000", "7002", "7003", "7004", "7901"]
    assert now.columns == roster.columns


def test_reports_get_the_number_to_pay_and_keep_the_sender(spark, reports):
    now = E.translate_numbers(reports, changes(spark, ("7000", "7900"), ("7003", "7900")), "senderPhone", "paymentPhone")
    assert column(now, "paymentPhone") == {"r1": "7900", "r2": "7900", "r3": "7900", "r4": "6666"}
    assert column(now, "senderPhone") == column(reports, "senderPhone")


def test_a_new_number_is_not_looked_up_again(spark, reports):
    now = E.translate_numbers(reports, changes(spark, ("7003", "7500"), ("7500", "7999")), "senderPhone", "paymentPhone")
    assert column(now, "paymentPhone")["r2"] == "7500"


def paid(reports):
    return reports.withColumn("paymentPhone", F.col("senderPhone"))


def test_worker_columns_join_by_the_number_to_pay(reports, roster):
    info = E.merge_worker_info(paid(reports), roster)
    assert column(info, "treat") == {"r1": 0, "r2": 3, "r3": 0, "r4": None}
    assert column(info, "workerName")["r2"] == "Worker 3"
    assert not {"reporting_number", "contact_number", "name"} & set(info.columns)


def test_numbers_outside_the_roster_are_testers(reports, roster):
    flagged = E.tag_testers(paid(reports).withColumn("training", F.lit(False)), roster)
    assert column(flagged, "training") == {"r1": False, "r2": False, "r3": False, "r4": True}
    folded = E.merge_worker_info(paid(reports), roster, tester_flag="training")
    assert column(folded, "training") == column(flagged, "training")
    kept = E.tag_testers(paid(reports).withColumn("training", F.lit(True)), roster)
    assert set(column(kept, "training").values()) == {True}


def test_reports_up_to_the_training_day_are_training(reports, roster):
    info = E.merge_worker_info(paid(reports), roster).withColumn("training", F.lit(False))
    assert column(E.tag_training_day(info), "training") == {"r1": True, "r2": False, "r3": False, "r4": False}


def test_event_flags(spark, reports):
    at = datetime(2021, 7, 5, 12)
    events = spark.createDataFrame(
        [("called", at, ("r2",)), ("called", at, ("r2",)), ("attempted", at, ("r2",)), ("noConsent", at, ("r3",)),
         ("called", at, ("unknown",)), ("renamed", at, ("r1",)), ("called", at, (None,))], EVENT)
    out = E.add_status_events(reports, events)
    assert out.count() == 4
    assert column(out, "called") == {"r1": False, "r2": True, "r3": False, "r4": False}
    assert column(out, "attempted") == {"r1": False, "r2": True, "r3": False, "r4": False}
    assert column(out, "noConsent") == {"r1": False, "r2": False, "r3": True, "r4": False}


def test_enrich_keeps_the_first_copy_of_a_report(spark, roster):
    schema = ("_id string, serviceDate timestamp_ntz, ogServiceDate string, patientPhone string, patientName string, "
              "senderPhone string, timestamp timestamp_ntz, code string, sourceId bigint")
    day, early, late = datetime(2021, 7, 1), datetime(2021, 7, 1, 8), datetime(2021, 7, 1, 9)
    rows = [("r1", day, "t", "p", "n", "7002", late, "K", 11), ("r1", day, "t", "p", "n", "7002", early, "K", 14),
            ("r1", day, "t", "p", "n", "7002", early, "K", 12), ("r2", day, "t", "p", "n", "7004", late, "K", 13)]
    events = spark.createDataFrame([("attempted", day, ("r1",))], EVENT)
    out = E.enrich(spark.createDataFrame(rows, schema), events, roster, changes(spark, ("7004", "7904")))
    assert column(out, "sourceId") == {"r1": 12, "r2": 13}
    assert column(out, "paymentPhone") == {"r1": "7002", "r2": "7904"}
    assert column(out, "attempted") == {"r1": True, "r2": False}
