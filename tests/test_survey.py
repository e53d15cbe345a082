from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldreports import schemas
from fieldreports.operators import survey as V
from fieldreports.operators.normalize import PROVIDED_CARE_QUESTION, flatten_survey

MSG = "_id string, senderPhone string, patientPhone string, patientName string, code string, serviceDate timestamp_ntz, timestamp timestamp_ntz, called boolean, training boolean, paymentPhone string"
T0 = datetime(2024, 2, 1)


def answers(care):
    other = (("other",), "text", None)
    if care == "missing":
        return [other]
    return [other, ((PROVIDED_CARE_QUESTION,), "boolean", care)]


def response(rid, care, phone="p1", patient="ann", code="c1", visit="2024-01-10", worker="w1", minutes=0):
    hidden = (worker, "w", phone, patient, code, visit, f"m{rid}")
    return (rid, datetime(2024, 2, 1, 0, minutes), hidden, answers(care))


def test_flatten_survey(spark):
    df = spark.createDataFrame([response(1, True), response(2, "missing"), response(3, False)], schemas.SURVEY_RESPONSE)
    rows = {r["response_id"]: r for r in flatten_survey(df).collect()}
    assert (rows[1]["called"], rows[1]["provided_care"]) == (True, True)
    assert (rows[2]["called"], rows[2]["provided_care"]) == (False, None)
    assert (rows[3]["called"], rows[3]["provided_care"]) == (True, False)
    assert rows[1]["workerphone"] == "w1" and rows[1]["visitdate"] == "2024-01-10"


def test_clean_survey_collapses_copies(spark):
    df = spark.createDataFrame(
        [response(1, False, visit="02.01.2024"), response(2, True, visit="02.01.2024", minutes=5),
         response(3, "missing", phone="p2"), response(4, True, phone="p3", patient="bob")],
        schemas.SURVEY_RESPONSE,
    )
    rows = {r["response_id"]: r for r in V.clean_survey(flatten_survey(df)).collect()}
    assert set(rows) == {1, 4}
    assert rows[1]["provided_care"] is True
    assert rows[1]["visitdate"] == "2024-02-01"   # month first
    assert rows[4]["patient"] == "BOB" and rows[4]["code"] == "C1"


def survey_rows(spark, rows):
    return spark.createDataFrame(
        [(i, T0, w, "w", p, n, c, v, f"m{i}", True, True) for i, (w, p, n, c, v) in enumerate(rows, 1)],
        schemas.SURVEY_ROW,
    )


@pytest.fixture()
def pair(spark):
    def m(i, w, p, n, c, d):
        return (f"m{i}", w, p, n, c, datetime(2024, 1, d), datetime(2024, 1, d, 12), False, False, w)

    msgs = spark.createDataFrame(
        [m(1, "w1", "p1", "A", "C1", 10), m(2, "w1", "p2", "B", "C1", 11), m(3, "w2", "p3", "C", "C2", 5),
         m(4, "w2", "p3", "C", "C2", 20), m(5, None, "p5", "E", "C5", 2)],
        MSG,
    )
    survey = survey_rows(spark, [
        ("w1", "p1", "A", "C1", "2024-01-10"),
        ("w2", "p3", "C", "C2", "2024-01-07"),
        ("w9", "p2", "Z", "C9", "2024-01-01"),
        (None, "p5", "E", "C5", "2024-01-02"),
    ])
    return msgs, survey


def test_merge_exact_marks_sides(pair):
    msgs, survey = pair
    merged = V.merge_exact(msgs, survey, with_date=True)
    marks = sorted((r["_merge"], r["response_id"] or 0) for r in merged.collect())
    assert marks == [("both", 1), ("both", 4), ("left_only", 0), ("left_only", 0), ("left_only", 0),
                     ("right_only", 2), ("right_only", 3)]
    right = merged.where(F.col("_merge") == "right_only").collect()
    assert {r["code"] for r in right} == {"C2", "C9"}
    assert {"called_app", "called_typeform", "patientphone_typeform"} <= set(merged.columns)


def test_reconcile_two_passes(pair):
    msgs, survey = pair
    report, orphans = V.reconcile_survey(msgs, survey)
    rows = sorted((r["_merge"], r["response_id"] or 0, r["patientPhone"], r["serviceDate"].day) for r in report.collect())
    # survey 2 has no message of its day and fits both messages of its four keys
    assert rows == [
        ("both", 1, "p1", 10), ("both", 2, "p3", 5), ("both", 2, "p3", 20), ("both", 4, "p5", 2),
        ("left_only", 0, "p2", 11), ("left_only", 0, "p3", 5), ("left_only", 0, "p3", 20),
    ]
    assert [r["response_id"] for r in orphans.collect()] == [3]
    assert set(orphans.columns) == set(survey.columns)
    assert not set(V.HIDDEN_COLUMNS) & set(report.columns)


def test_orphan_candidates_by_patient_phone(pair):
    msgs, survey = pair
    rows = V.orphan_candidates(msgs, survey).collect()
    assert [(r["response_id"], r["n_candidates"], r["candidate_id"]) for r in rows] == [(3, 1, "m2")]


def test_roster_coverage_and_final_report(spark, pair):
    msgs, survey = pair
    report, _ = V.reconcile_survey(msgs, survey)
    roster = spark.createDataFrame([("w1", "c-w1"), ("w2", "c-w2")], "reporting_number string, contact_number string")
    assert V.roster_coverage(report, roster).first()["missing"] == 1   # the NULL sender
    with pytest.raises(ValueError):
        V.check_roster_coverage(report, roster)
    final = V.final_report(report, roster)
    assert final.count() == 6 and "contact_number" in final.columns and "_merge" not in final.columns


def test_unique_visits_drop_null_keys(spark):
    rows = [("a", "n", "c", datetime(2024, 1, 1), "p", datetime(2024, 1, 2)),
            ("b", "n", "c", datetime(2024, 1, 1), "p", datetime(2024, 1, 1)),
            ("c", None, "c", datetime(2024, 1, 1), "p", datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "_id string, patientName string, code string, serviceDate timestamp_ntz, patientPhone string, timestamp timestamp_ntz")
    assert [r["_id"] for r in V.unique_visits(df).collect()] == ["b"]


def test_pass_two_matches_null_keys(spark):
    def m(i, d):
        return (f"m{i}", None, "p7", "G", "C7", datetime(2024, 1, d), datetime(2024, 1, d, 12), False, False, None)

    msgs = spark.createDataFrame([m(1, 3), m(2, 20)], MSG)
    survey = survey_rows(spark, [(None, "p7", "G", "C7", "2024-01-05")])   # no same-day message
    report, orphans = V.reconcile_survey(msgs, survey)
    both = sorted((r["response_id"], r["serviceDate"].day) for r in report.where(F.col("_merge") == "both").collect())
    assert both == [(1, 3), (1, 20)]
    assert orphans.count() == 0


def test_candidates_of_one_hot_phone(spark):
    """100,000 unmatched messages and 100,000 orphans on one phone: linear work."""
    n = 100_000
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int"))
    msgs = spark.range(n).select(
        F.concat(F.lit("m"), "id").alias("_id"), F.lit("w").alias("senderPhone"), F.lit("p").alias("patientPhone"),
        F.lit("A").alias("patientName"), F.lit("C").alias("code"), day.cast("timestamp_ntz").alias("serviceDate"),
        day.cast("timestamp_ntz").alias("timestamp"), F.lit(False).alias("called"), F.lit(False).alias("training"), F.lit("w").alias("paymentPhone"))
    survey = spark.range(n).select(
        F.col("id").alias("response_id"), F.lit(T0).cast("timestamp_ntz").alias("submitted_at"), F.lit("x").alias("workerphone"),
        F.lit("w").alias("worker"), F.lit("p").alias("patientphone"), F.lit("B").alias("patient"), F.lit("C").alias("code"),
        F.date_format(F.date_add(F.lit("2019-12-20").cast("date"), (F.col("id") % 30).cast("int")), "yyyy-MM-dd").alias("visitdate"),
        F.lit("m").alias("messageid"), F.lit(True).alias("called"), F.lit(True).alias("provided_care"))
    out = V.orphan_candidates(msgs, survey)
    got = out.groupBy("n_candidates", F.to_date("candidate_date").alias("d")).count().collect()
    assert {r["n_candidates"] for r in got} == {n} and sum(r["count"] for r in got) == n
    assert {str(r["d"]) for r in got} == {str(datetime(2020, 1, d).date()) for d in range(1, 19)}
