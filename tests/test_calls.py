import json
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldreports import schemas
from fieldreports.operators import calls as C
from fieldreports.operators.common import nearest_day, rank_in_slices
from fieldreports.operators.normalize import json_payload

MSG = "paymentPhone string, serviceDate timestamp_ntz, called boolean, attempted boolean"
ORDER = ("serviceDate", "called", "attempted")


@pytest.fixture()
def messages(spark):
    """Worker 31: five reports, two called; worker 32: four reports, none called; one report without a number."""
    rows = [("31", datetime(2021, 3, d), d in (2, 9), False) for d in (1, 2, 2, 9, 20)]
    rows += [("32", datetime(2021, 3, d), False, True) for d in (4, 5, 6, 7)] + [(None, datetime(2021, 3, 1), True, False)]
    return spark.createDataFrame(rows, MSG)


def test_reports_and_calls_per_worker(messages):
    rows = {r["paymentPhone"]: (r["reports"], r["called"]) for r in C.call_counts(messages).collect()}
    assert rows == {"31": (5, 3), "32": (4, 0)}


@pytest.mark.parametrize("target, needed", [(0.2, {"31": -2, "32": 1}), (0.5, {"31": 0, "32": 2}), (1.0, {"31": 2, "32": 4})])
def test_quota_is_rounded_up_and_less_the_calls_made(messages, target, needed):
    rows = C.needed_calls(C.call_counts(messages), target).collect()
    assert {r["paymentPhone"]: r["needed"] for r in rows} == needed


def test_first_reports_of_each_worker_are_picked(messages):
    needed = C.needed_calls(C.call_counts(messages), 0.5)
    picked = C.pick_needed_calls(needed, messages, ORDER)
    assert [(r["paymentPhone"], r["serviceDate"].day) for r in picked.orderBy("paymentPhone", "serviceDate").collect()] == [("32", 4), ("32", 5)]
    assert picked.columns == messages.columns


def test_batch_takes_quota_and_rank_from_one_ranking(spark):
    schema = ("paymentPhone string, serviceDate timestamp_ntz, timestamp timestamp_ntz, _id string, called boolean, "
              "training boolean, noConsent boolean")
    rows = [(str(w), datetime(2021, 3, 1 + i % 9), datetime(2021, 3, 1 + i % 9, i % 24), f"{w}-{i:03d}", i % w == 0, False, False)
            for w in (2, 3, 7) for i in range(11 * w)]
    df = spark.createDataFrame(rows, schema)
    as_of = datetime(2021, 3, 12)
    two_steps = C.pick_needed_calls(C.needed_calls(C.call_counts(df), 0.4), df)
    one = C.call_batch(df, as_of, 0.4)
    assert one.columns == df.columns
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two_steps.collect()))


def test_negative_quota_keeps_all_but_last(spark):
    rows = [("a", datetime(2018, 4, d), False, False) for d in (1, 2, 3)] + [("b", datetime(2018, 4, 1), False, False)]
    msgs = spark.createDataFrame(rows, MSG)
    needed = spark.createDataFrame([("a", -1), ("b", -5)], "paymentPhone string, needed bigint")
    picked = C.pick_needed_calls(needed, msgs, ORDER).orderBy("serviceDate").collect()
    assert [(r["paymentPhone"], r["serviceDate"].day) for r in picked] == [("a", 1), ("a", 2)]


def test_worker_without_quota_gets_nothing(spark, messages):
    needed = spark.createDataFrame([("32", 5)], "paymentPhone string, needed bigint")
    picked = C.pick_needed_calls(needed, messages, ORDER)
    assert {r["paymentPhone"] for r in picked.collect()} == {"32"}


def queue(spark, rows):
    return spark.createDataFrame(rows, schemas.QUEUE)


def entries(spark, rows):
    return spark.createDataFrame(rows, "district string, payload string, _order string")


def as_lists(df):
    out = {}
    for r in df.orderBy("district", "seq").collect():
        out.setdefault(r["district"], []).append(r["payload"])
    return out


def test_a_batch_as_long_as_the_queue_replaces_it(spark):
    old = queue(spark, [("east", 1, "o1"), ("east", 2, "o2"), ("west", 4, "o")])
    new = entries(spark, [("east", "n2", "b"), ("east", "n1", "a"), ("west", "n2", "b"), ("west", "n1", "a")])
    assert as_lists(C.queue_refresh(old, new)) == {"east": ["n1", "n2"], "west": ["n1", "n2"]}


def test_a_short_batch_pushes_out_the_oldest(spark):
    old = queue(spark, [("east", n, f"o{n}") for n in (3, 5, 8, 9)])
    out = C.queue_refresh(old, entries(spark, [("east", "n", "a")]))
    assert as_lists(out) == {"east": ["o5", "o8", "o9", "n"]}
    assert [r["seq"] for r in out.orderBy("seq").collect()] == [1, 2, 3, 4]


def test_refresh_accepts_null_district_and_keeps_other_districts(spark):
    old = queue(spark, [("south", 7, "k"), (None, 1, "o")])
    out = C.queue_refresh(old, entries(spark, [(None, "n", "1")]))
    assert as_lists(out) == {None: ["n"], "south": ["k"]}
    assert out.where("district = 'south'").first()["seq"] == 7


def test_payload_keeps_nulls(spark):
    df = spark.createDataFrame([(None, "east")], "amount double, chw_district string")
    payload = df.select(json_payload(df)).first()[0]
    assert json.loads(payload) == {"amount": None, "chw_district": "east"}
    assert '"amount":null' in payload


def test_training_batch_defaults(spark):
    schema = "training boolean, chw_district string, training_date timestamp_ntz, workerName string"
    df = spark.createDataFrame([(True, "X", None, None), (False, "Y", None, None)], schema)
    rows = C.training_batch(df).collect()
    assert len(rows) == 1
    assert rows[0]["chw_district"] == "Test"
    assert rows[0]["training_date"] == datetime(1970, 1, 1)
    assert rows[0]["workerName"] == C.TESTER_NAME


def test_call_candidates_window_is_strict(spark):
    schema = "serviceDate timestamp_ntz, training boolean, noConsent boolean"
    as_of = datetime(2018, 6, 10)
    df = spark.createDataFrame(
        [(datetime(2018, 5, 13), False, False), (datetime(2018, 5, 14), False, False),
         (datetime(2018, 6, 1), True, False), (datetime(2018, 6, 1), False, True)], schema)
    assert [r[0] for r in C.call_candidates(df, as_of).collect()] == [datetime(2018, 5, 14)]


def test_slices_give_the_row_number_of_a_hot_group(spark):
    # one key holds half the rows; NULL keys form a group of their own
    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot"))
        .when(F.col("id") % 7 == 1, F.lit(None))
        .otherwise((F.col("id") % 13).cast("string")).alias("g"),
        ((F.col("id") * 7919) % 6007).alias("o"),
        F.col("id"),
    )
    ranked = rank_in_slices(df, ["g"], {"_s": F.floor(F.col("o") / 500)}, ["o", "id"], {"n": F.lit(1), "t": F.col("o")}, "r")
    group = Window.partitionBy("g")
    ref = df.select("id", F.row_number().over(group.orderBy("o", "id")).alias("e"),
                    F.count(F.lit(1)).over(group).alias("c"), F.sum("o").over(group).alias("u"))
    joined = ranked.join(ref, "id")
    assert joined.count() == 6000
    assert joined.where("r <> e OR n <> c OR t <> u").count() == 0


def _simulate_lists(old, new):
    """Queues as lists, oldest first: the length is read before the batch is
    pushed, then the list is trimmed."""
    out = {}
    for district in set(old) | set(new):
        before = list(old.get(district, []))
        batch = new.get(district, [])
        if not batch:
            out[district] = before
            continue
        merged = before + batch            # newest at the end
        size = len(before)
        keep = size if size > len(batch) else len(batch)
        out[district] = merged[len(merged) - keep:]
    return out


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_refresh_by_two_batches_is_two_list_refreshes(spark, seed, monkeypatch):
    import random

    monkeypatch.setattr(C, "SEQ_SLICE", 2)
    rnd = random.Random(seed)
    old, new, more = {}, {}, {}
    for d in ["a", "b", "c", "d", "e", None]:
        for name, lists in (("old", old), ("new", new), ("more", more)):
            n = rnd.randrange(0, 6) if rnd.random() < 0.7 else 0
            if n or lists is old:
                lists[d] = [f"{d}-{name}-{i}" for i in range(n)]
    old_rows = [(d, i + 1, p) for d, ps in old.items() for i, p in enumerate(ps)]
    batch = lambda lists: entries(spark, [(d, p, f"{i:03d}") for d, ps in lists.items() for i, p in enumerate(ps)])
    got = as_lists(C.queue_refresh(queue(spark, old_rows), batch(new), batch(more)))
    expected = {d: ps for d, ps in _simulate_lists(_simulate_lists(old, new), more).items() if ps}
    assert got == expected


def test_literals_do_not_depend_on_the_process_time_zone(spark):
    import os
    import time

    from fieldreports.functions.dates import ts_literal

    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        row = spark.range(1).select(
            ts_literal(datetime(1970, 1, 1)).alias("a"), ts_literal(datetime(2024, 2, 10, 6, 30)).alias("b")
        ).first()
        schema = "training boolean, chw_district string, training_date timestamp_ntz, workerName string"
        filled = C.training_batch(spark.createDataFrame([(True, None, None, None)], schema)).first()
    finally:
        if old is None:
            os.environ.pop("TZ")
        else:
            os.environ["TZ"] = old
        time.tzset()
    assert row["a"] == datetime(1970, 1, 1) and row["b"] == datetime(2024, 2, 10, 6, 30)
    assert filled["training_date"] == datetime(1970, 1, 1)


def test_nearest_day_against_brute_force(spark):
    import random
    from datetime import date, timedelta

    rnd = random.Random(17)
    base = date(2024, 1, 1)
    have = {(rnd.choice("abc"), base + timedelta(days=rnd.randrange(0, 60))): f"L{i}" for i in range(60)}
    want = {(rnd.choice("abcz"), base + timedelta(days=rnd.randrange(-5, 65))) for _ in range(150)}
    left = spark.createDataFrame([(k, d, x) for (k, d), x in have.items()], "k string, d date, name string")
    asked = spark.createDataFrame(sorted(want), "k string, d date")
    got = {(r["k"], r["d"]): r["_match"]["name"] if r["_match"] else None for r in nearest_day(left, asked, "k", "d").collect()}

    def brute(k, d):
        found = [(abs((ld - d).days), ld, x) for (lk, ld), x in have.items() if lk == k]
        return min(found)[2] if found else None   # nearest, then earlier day

    assert got == {(k, d): brute(k, d) for k, d in want}


def test_refresh_with_an_empty_batch_changes_nothing(spark):
    old = queue(spark, [("foo", 1, "a"), ("foo", 2, "b"), (None, 1, "c")])
    out = C.queue_refresh(old, entries(spark, []))
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted((tuple(r) for r in old.collect()), key=str)
