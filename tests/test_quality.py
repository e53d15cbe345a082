from datetime import datetime

from fieldreports import schemas
from fieldreports.operators import normalize as N
from fieldreports.operators.quality import intake_counts

TS = datetime(2018, 2, 27, 13, 0)


def test_intake_counts(spark):
    raw = spark.createDataFrame(
        [(TS, "10.02.2018", "a", "1", "9", "e", 1), (TS, "31.02.2018", "b", "2", "9", "e", 2),
         (TS, "junk", "c", "3", "9", "e", 3)],
        schemas.RAW_MESSAGE,
    )
    messages = N.normalize_messages(raw)
    ids = [r["_id"] for r in messages.collect()]
    events = spark.createDataFrame(
        [("called", TS, (ids[0],)), ("visited", TS, (ids[1],)), ("called", TS, ("nope",))],
        "event string, event_time timestamp_ntz, record struct<_id:string>",
    )
    survey = spark.createDataFrame(
        [(1, TS, "9", "w", "1", "a", "E", "2018-02-10", ids[0], True, True),
         (2, TS, "9", "w", "2", "b", "E", "someday", ids[1], True, False),
         (3, TS, "9", "w", "3", "c", "E", "whenever", ids[2], False, None)],
        schemas.SURVEY_ROW,
    )
    row = intake_counts(raw, messages, events, survey).first().asDict()
    assert row == {"raw_reports": 3, "date_fallbacks": 2, "unknown_event_names": 1,
                   "events_unknown_ids": 1, "unreadable_visit_dates": 1}
