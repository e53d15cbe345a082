from datetime import date, datetime

from pyspark.sql import functions as F

from fieldreports import schemas
from fieldreports.functions.dates import (
    date_or_keep,
    parse_roster_date,
    parse_service_date,
    parse_visit_date,
    strict_dmy,
)
from fieldreports.functions.ids import message_id
from fieldreports.operators.normalize import normalize_messages

REPORT = datetime(2018, 2, 27, 13, 8, 16)


def raw_row(service_date="10.02.2018", name="ANN smith", code="e", report=REPORT):
    return (report, service_date, name, "200", "100", code, 1)


def normalize_one(spark, **kw):
    df = spark.createDataFrame([raw_row(**kw)], schemas.RAW_MESSAGE)
    return normalize_messages(df).first()


def test_message_ids_differ_per_field(spark):
    rows = [
        ("11.2.3", "foo", "foo", "A"),
        ("11.2.3", "bar", "foo", "A"),
        ("11.2.3", "bar", "bar", "A"),
        ("bar", "bar", "bar", "A"),
    ]
    df = spark.createDataFrame(rows, "og string, name string, phone string, code string")
    ids = [r[0] for r in df.select(message_id("og", "name", "phone", "code")).collect()]
    assert all(isinstance(i, str) and len(i) == 32 for i in ids)
    assert len(set(ids)) == 4


def test_message_id_spells_null_as_none(spark):
    df = spark.createDataFrame([(None, "a", "b", "c")], "og string, name string, phone string, code string")
    got = df.select(message_id("og", "name", "phone", "code").alias("i"), F.md5(F.lit("Noneabc")).alias("e")).first()
    assert got["i"] == got["e"]


def test_valid_service_date_is_parsed(spark):
    assert normalize_one(spark)["serviceDate"] == datetime(2018, 2, 10)


def test_impossible_date_falls_back_to_report_day(spark):
    assert normalize_one(spark, service_date="29.02.2018")["serviceDate"] == datetime(2018, 2, 27)


def test_upper_cases_code_and_name(spark):
    row = normalize_one(spark)
    assert row["code"] == "E"
    assert row["patientName"] == "ANN SMITH"


def test_service_date_rules(spark):
    cases = [
        ("10/02/2018", datetime(2018, 2, 10)),      # separators become dots
        ("x10-2-2018", datetime(2018, 2, 10)),      # one leading non-digit dropped
        ("010.02.2018", datetime(2018, 2, 27)),     # over-long day rejected
        ("10.02.18", datetime(2018, 2, 27)),        # two-digit year rejected
        ("10.02.2018.", datetime(2018, 2, 27)),     # trailing separator rejected
        ("01.01.2018", datetime(2018, 2, 27)),      # more than 8 weeks old
        ("03.01.2018", datetime(2018, 1, 3)),       # 55 days 13 h before the report time: kept
        ("02.01.2018", datetime(2018, 2, 27)),      # 56 days 13 h: more than 8 weeks
        ("28.02.2018", datetime(2018, 2, 27)),      # after the report
        ("", datetime(2018, 2, 27)),
        (None, datetime(2018, 2, 27)),
    ]
    df = spark.createDataFrame([(c, REPORT) for c, _ in cases], "s string, r timestamp_ntz")
    got = [r[0] for r in df.select(parse_service_date("s", "r")).collect()]
    assert got == [e for _, e in cases]


def test_lenient_repair_keeps_report_time_and_old_dates(spark):
    df = spark.createDataFrame([("01.01.2017", REPORT), ("bad", REPORT)], "s string, r timestamp_ntz")
    got = [r[0] for r in df.select(parse_service_date("s", "r", max_age_days=None, fallback="timestamp")).collect()]
    assert got == [datetime(2017, 1, 1), REPORT]


def test_date_or_keep(spark):
    df = spark.createDataFrame([("10.02.2018",), ("31.02.2018",), ("soon",)], "s string")
    assert [r[0] for r in df.select(date_or_keep("s")).collect()] == ["2018-02-10", "31.02.2018", "soon"]


def test_roster_two_digit_years_pivot(spark):
    df = spark.createDataFrame([("05.12.22",), ("01.01.69",), ("31.12.68",), ("1.2.99",), ("32.1.20",)], "s string")
    got = [r[0] for r in df.select(parse_roster_date("s")).collect()]
    assert got == [datetime(2022, 12, 5), datetime(1969, 1, 1), datetime(2068, 12, 31), datetime(1999, 2, 1), None]


def test_visit_dates_read_month_first(spark):
    df = spark.createDataFrame([("2018-02-10",), ("10.02.2018",), ("13/02/2018",), ("junk",)], "s string")
    got = [r[0] for r in df.select(parse_visit_date("s")).collect()]
    assert got == [date(2018, 2, 10), date(2018, 10, 2), date(2018, 2, 13), None]


def _python_rule(text, report, max_age_days=56):
    """The service-date rule stated in plain Python (ASCII digits only)."""
    import re
    from datetime import timedelta

    fallback = report.replace(hour=0, minute=0, second=0, microsecond=0)
    if text is None:
        return fallback
    d = re.sub(r"[^0-9]+", ".", text)
    d = re.sub(r"^[^0-9]", "", d)
    try:
        parsed = datetime.strptime(d, "%d.%m.%Y")
    except ValueError:
        return fallback
    if parsed > report or report - parsed > timedelta(days=max_age_days):
        return fallback
    return parsed


def test_service_date_matches_python_rule_on_random_text(spark):
    import random
    from datetime import timedelta

    rnd = random.Random(11)
    seps = [".", "/", "-", " ", "..", "x", ". ", ""]
    cases = []
    for _ in range(3000):
        report = datetime(2024, 1, 1) + timedelta(minutes=rnd.randrange(60 * 24 * 400))
        day = report - timedelta(days=rnd.randrange(-5, 70))
        dd = str(day.day).zfill(rnd.choice([1, 2, 2, 3]))
        mm = str(day.month).zfill(rnd.choice([1, 2, 2, 3]))
        yy = rnd.choice([str(day.year), str(day.year)[2:], "0" + str(day.year)])
        if rnd.random() < 0.1:
            dd = str(rnd.randrange(0, 35))
        if rnd.random() < 0.1:
            mm = str(rnd.randrange(0, 15))
        text = rnd.choice(["", "x", " "]) + dd + rnd.choice(seps) + mm + rnd.choice(seps) + yy + rnd.choice(["", ".", " ", "z"])
        if rnd.random() < 0.03:
            text = None
        cases.append((text, report))
    df = spark.createDataFrame(cases, "s string, r timestamp_ntz")
    got = [r[0] for r in df.select(parse_service_date("s", "r")).collect()]
    expected = [_python_rule(t, r) for t, r in cases]
    mismatches = [(c, g, e) for c, g, e in zip(cases, got, expected) if g != e]
    assert not mismatches, mismatches[:5]


def test_there_is_no_year_zero(spark):
    df = spark.createDataFrame([("01.01.0000",), ("01.01.0001",)], "t string")
    assert [r[0] is None for r in df.select(strict_dmy("t")).collect()] == [True, False]
    assert [r[0] for r in df.select(date_or_keep("t")).collect()] == ["01.01.0000", "0001-01-01"]


def test_free_form_visit_dates(spark):
    day = "2018-10-02"
    texts = {t: day for t in ("2018-10-02", "2018-10-02T12:00:00Z", "2018-10-02 07:30", "2 Oct 2018", "2 october 2018", "Oct 2, 2018",
                              "October 2 2018", "10/2/18", "10.02.2018", "20181002", " 2018/10/2 ")}
    texts |= {"13/2/99": "1999-02-13", "soon": None, "2018-13-40": None, "": None, "2018-10-02Tnoon": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: str(r["d"]) if r["d"] else None for r in df.select("t", parse_visit_date("t").alias("d")).collect()}
    assert got == texts
