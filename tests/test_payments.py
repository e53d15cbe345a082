import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fieldreports.functions import calendar
from fieldreports.operators import payments as P

AS_OF = datetime(2021, 9, 20)
TRAINED = datetime(2021, 3, 14)
SCHEMA = "paymentPhone string, serviceDate timestamp_ntz, phone_ps string, treat int, training_date timestamp_ntz, training boolean, timestamp timestamp_ntz, _id string, chw_district string, workerName string"

# (worker, service date, supervisor, arm): windows run from the 15th to the 15th
VISITS = [
    ("710", datetime(2021, 3, 20), "91", 2), ("710", datetime(2021, 4, 14), "91", 2), ("710", datetime(2021, 4, 15), "91", 2),
    ("711", datetime(2021, 4, 1), "91", 3),
    ("712", datetime(2021, 5, 20), "92", 1), ("712", datetime(2021, 5, 21), "92", 1),
    ("713", datetime(2021, 5, 30), "93", 0),
    ("714", datetime(2030, 1, 1), "93", 2),  # after the last window
]


def frame(spark, records):
    rows = [
        (p, d, ps, t, TRAINED, False, d, f"id{i:04d}", "D", "W") for i, (p, d, ps, t) in enumerate(records)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def paid(df):
    return {(r["number"], r["payment_due"].strftime("%m-%d")): (r["payment"], r["reports"]) for r in df.collect()}


def windows(spark, trained, now):
    df = spark.createDataFrame([(trained,)], "training_date timestamp_ntz").withColumn("reporting_number", F.lit("x"))
    return [(r["window_start"], r["window_end"]) for r in P.payment_windows(df, now).orderBy("window_start").collect()]


def test_windows_start_the_day_after_training(spark):
    day = lambda m, d: datetime(2021, m, d)
    assert windows(spark, day(7, 30), day(10, 5)) == [(day(7, 31), day(8, 31)), (day(8, 31), day(9, 30))]


@pytest.mark.parametrize("trained, open_windows", [
    (datetime(2021, 9, 20), 0), (datetime(2021, 8, 18), 1), (datetime(2021, 8, 19), 1), (datetime(2021, 8, 20), 0),
    (datetime(2020, 7, 1), 2)])
def test_number_of_windows_counts_whole_months_within_a_year(spark, trained, open_windows):
    assert len(windows(spark, trained, AS_OF)) == open_windows


def _months_component(now, anchor):
    """Months component of the calendar difference, as a loop."""
    if now < anchor:
        return 0
    m = (now.year - anchor.year) * 12 + now.month - anchor.month
    while _add_months(anchor, m) > now:
        m -= 1
    return m % 12


def _add_months(d, m):
    y, mo = divmod(d.month - 1 + m, 12)
    y += d.year
    mo += 1
    days = [31, 29 if (y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)) else 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
    return d.replace(year=y, month=mo, day=min(d.day, days[mo - 1]))


def _due_loop(trained, service, now):
    anchor = trained + timedelta(days=1)
    due = None
    for m in range(_months_component(now, anchor)):
        start, end = _add_months(anchor, m), _add_months(anchor, m + 1)
        if start <= service < end:
            due = end
    return due


def test_payment_due_matches_window_loop_on_month_ends(spark):
    rnd = random.Random(7)
    ends = [datetime(2019, 1, 31), datetime(2019, 2, 28), datetime(2020, 2, 29), datetime(2019, 3, 30), datetime(2019, 12, 31)]
    cases = []
    for _ in range(1500):
        trained = rnd.choice(ends) if rnd.random() < 0.5 else datetime(2019, 1, 1) + timedelta(days=rnd.randrange(500))
        service = trained + timedelta(days=rnd.randrange(-40, 500), hours=rnd.randrange(24))
        now = trained + timedelta(days=rnd.randrange(-10, 700))
        cases.append((trained, service, now))
    df = spark.createDataFrame(cases, "t timestamp_ntz, s timestamp_ntz, n timestamp_ntz")
    got = df.select(calendar.payment_due("t", "s", F.col("n"))).collect()
    expected = [_due_loop(t, s, n) for t, s, n in cases]
    assert [r[0] for r in got] == expected


def test_reports_per_worker_and_payment_date(spark):
    due = datetime(2021, 4, 15)
    df = spark.createDataFrame([("710", due), ("711", due), ("710", due), (None, due), ("712", None)], "paymentPhone string, payment_due timestamp_ntz")
    rows = P.report_counts(df, first_columns=()).collect()
    assert {(r["paymentPhone"], r["payment_due"]): r["reports"] for r in rows} == {("710", due): 2, ("711", due): 1}


def test_first_non_null_attribute(spark):
    due = datetime(2021, 4, 15)
    df = spark.createDataFrame(
        [("710", due, None, datetime(2021, 4, 1), "x"), ("710", due, 2, datetime(2021, 4, 3), "y"), ("710", due, 3, datetime(2021, 4, 2), "z")],
        "paymentPhone string, payment_due timestamp_ntz, treat int, timestamp timestamp_ntz, _id string",
    )
    assert P.report_counts(df, first_columns=("treat",)).first()["treat"] == 3


def test_pay_is_base_plus_the_bonus_of_the_arm(spark):
    counts = P.capped_counts(frame(spark, VISITS), AS_OF)
    assert paid(P.worker_payments(counts)) == {
        ("710", "04-15"): (14000, 2), ("710", "05-15"): (12000, 1), ("711", "04-15"): (11000, 1),
        ("712", "06-15"): (10000, 2), ("713", "06-15"): (10000, 1)}
    # the supervisor's arm is that of the lowest worker number: 2 for supervisor 91
    assert paid(P.super_payments(counts)) == {
        ("91", "04-15"): (10000, 3), ("91", "05-15"): (10000, 1), ("92", "06-15"): (14000, 2), ("93", "06-15"): (10000, 1)}


def test_at_most_30_reports_of_a_month_count(spark):
    busy = [("720", datetime(2021, 6, 20), "94", 3)] * 31 + [("721", datetime(2021, 6, 21), "94", 3)] * 2 + [("722", datetime(2021, 6, 22), "95", 2)] * 30
    counts = P.capped_counts(frame(spark, busy), AS_OF)
    assert paid(P.worker_payments(counts)) == {("720", "07-15"): (40000, 31), ("721", "07-15"): (12000, 2), ("722", "07-15"): (70000, 30)}
    assert paid(P.super_payments(counts))[("94", "07-15")] == (42000, 33)  # the cap holds per worker


def test_any_payer_can_be_plugged_in(spark):
    by_arm = P.calc_payments(frame(spark, VISITS), AS_OF, lambda counts: P.worker_payments(counts, {0: 500}))
    assert paid(by_arm)[("713", "06-15")] == (10500, 1)
    assert [r["payment_due"] for r in by_arm.collect()] == sorted(r["payment_due"] for r in by_arm.collect())


def test_training_rows_are_not_paid(spark):
    df = frame(spark, VISITS).withColumn("training", F.lit(True))
    assert P.capped_counts(df, AS_OF).count() == 0


def test_supervisor_number_drops_leading_zeros(spark):
    df = frame(spark, [("710", datetime(2021, 4, 1), "0091", 2)])
    assert [r["number"] for r in P.super_payments(P.capped_counts(df, AS_OF)).collect()] == ["91"]


@pytest.mark.parametrize("wrap,expected", [(True, 2), (False, 14)])
def test_wrap_years_switch(spark, wrap, expected):
    df = spark.createDataFrame([(datetime(2020, 7, 1),)], "t timestamp_ntz")
    n = df.select(calendar.window_count("t", AS_OF, wrap_years=wrap)).first()[0]
    assert n == expected


def test_payment_windows_match_loop_on_random_dates(spark):
    rnd = random.Random(23)
    ends = [datetime(2019, 1, 31), datetime(2019, 2, 28), datetime(2020, 2, 29), datetime(2019, 8, 31)]
    cases = []
    for i in range(300):
        trained = rnd.choice(ends) if rnd.random() < 0.4 else datetime(2019, 1, 1) + timedelta(days=rnd.randrange(700))
        now = trained + timedelta(days=rnd.randrange(-20, 900))
        cases.append((f"w{i}", trained, now))
    df = spark.createDataFrame(cases, "reporting_number string, training_date timestamp_ntz, now timestamp_ntz")
    w = F.explode(calendar.payment_windows("training_date", F.col("now"))).alias("w")
    got = {}
    for r in df.select("reporting_number", w).select("reporting_number", "w.*").collect():
        got.setdefault(r["reporting_number"], []).append((r["window_start"], r["window_end"]))
    for num, trained, now in cases:
        anchor = trained + timedelta(days=1)
        expected = [(_add_months(anchor, m), _add_months(anchor, m + 1)) for m in range(_months_component(now, anchor))]
        assert sorted(got.get(num, [])) == expected, (num, trained, now)
