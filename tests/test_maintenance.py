from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from fieldreports import schemas
from fieldreports.operators import common
from fieldreports.operators import maintenance as M
from fieldreports.sources.readers import legacy_with_flag

ROSTER = "reporting_number string, contact_number string, name string, chw_district string, training_date timestamp_ntz, treat int, phone_ps string"
TS = datetime(2018, 2, 27, 13, 8, 16)


def roster(spark, numbers):
    return spark.createDataFrame([(n, n, f"name {n}", "D", datetime(2018, 1, 1), 1, "5") for n in numbers], ROSTER)


def test_testers(spark):
    msgs = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), (None,)], "senderPhone string")
    cw = spark.createDataFrame([("x", "b")], "old_number string, new_payment_number string")
    rows = M.testers(msgs, roster(spark, ["a"]), cw).collect()
    assert [(r["reporting_number"], r["chw_district"], r["name"]) for r in rows] == [("c", "Test", M.TESTER_NAME)]
    assert rows[0]["training_date"] is None


def test_a_sender_of_a_later_copy_is_found(spark, tmp_dir):
    """The id leaves the sender out, so copies of one report may come from two numbers."""
    import os

    from fieldreports.plans import jobs

    raw = [(TS, "10.02.2018", "ann", "1", "500", "e", 1), (datetime(2018, 2, 28), "10.02.2018", "ann", "1", "501", "e", 2)]
    data = {
        "raw": spark.createDataFrame(raw, schemas.RAW_MESSAGE), "roster": roster(spark, ["400"]),
        "crosswalk": spark.createDataFrame([], "old_number string, new_payment_number string"),
        "directory": roster(spark, ["400"]),
    }
    written = jobs.run_maintenance(spark, data, os.path.join(tmp_dir, "out"), "1")
    assert {r["reporting_number"] for r in spark.read.parquet(written["directory"]).collect()} == {"400", "500", "501"}


def test_directory_upsert_inserts_only_new_numbers(spark):
    existing = roster(spark, ["a"]).withColumn("name", F.lit("old name"))
    found = M.testers(spark.createDataFrame([("c",), ("d",)], "senderPhone string"), roster(spark, []),
                      spark.createDataFrame([], "old_number string, new_payment_number string"))
    out = {r["reporting_number"]: r["name"] for r in M.directory_upsert(existing, roster(spark, ["a", "d"]), found).collect()}
    assert out == {"a": "old name", "d": "name d", "c": M.TESTER_NAME}


def legacy(spark):
    def row(i, called, consent, attempts, code="X"):
        raw = (TS, "10.02.2018", "ann", "200", "100", "e", i)
        return (f"id{i}", raw, code, called, consent, attempts, None)

    return spark.createDataFrame(
        [row(1, True, False, [], "Z"), row(2, False, True, None), row(3, False, False, [TS, datetime(2018, 3, 1)])],
        schemas.LEGACY_MESSAGE,
    )


def test_flags_to_events(spark):
    ev = M.flags_to_events(legacy(spark))
    assert ev.schema == schemas.EVENT
    rows = sorted((r["event"], r["event_time"], r["updates"]["code"] if r["updates"] else None) for r in ev.collect())
    assert rows == [
        ("attempted", TS, None), ("attempted", datetime(2018, 3, 1), None),
        ("called", datetime(1970, 1, 1), "Z"), ("noConsent", datetime(1970, 1, 1), None),
    ]
    rec = ev.first()["record"]
    assert rec["patientName"] == "ANN" and rec["serviceDate"] == datetime(2018, 2, 10) and len(rec["_id"]) == 32


def test_event_upsert_is_idempotent(spark):
    batch = M.flags_to_events(legacy(spark))
    empty = spark.createDataFrame([], schemas.EVENT)
    once = M.event_upsert(empty, batch)
    twice = M.event_upsert(once, batch)
    assert once.count() == 4 and twice.count() == 4
    assert M.event_upsert(once, batch.unionByName(batch)).count() == 4


def test_repair_dates(spark):
    rows = {r["_id"]: r["serviceDate"] for r in M.repair_dates(legacy(spark)).collect()}
    assert rows == {"id1": datetime(2018, 2, 10), "id2": datetime(2018, 2, 10), "id3": datetime(2018, 2, 10)}


def test_legacy_filters(spark):
    lg = legacy(spark)
    assert legacy_with_flag(lg, "called").count() == 1
    assert legacy_with_flag(lg, "noConsent").count() == 1
    assert legacy_with_flag(lg, "attempted").count() == 1
    with pytest.raises(ValueError):
        legacy_with_flag(lg, "visited")


@pytest.mark.parametrize("bits", [7, 24])
def test_new_rows_behind_the_key_filter(spark, monkeypatch, bits):
    """A table of few bits lets stored keys through that are not in the batch; the rows stay exact."""
    monkeypatch.setattr(common, "FILTER_BITS", bits)
    target = spark.createDataFrame([(i, f"k{i % 50}" if i % 7 else None, i) for i in range(0, 300, 2)], "a int, b string, v int")
    batch = spark.createDataFrame([(i % 300, f"k{i % 50}" if i % 7 else None, i) for i in range(600)] + [(None, None, 1)] * 2,
                                  "a int, b string, v int")
    stored = {(r["a"], r["b"]) for r in target.collect()}
    want = {}
    for r in batch.collect():
        key = (r["a"], r["b"])
        if key not in stored:
            want[key] = min(want.get(key, r["v"]), r["v"])
    got = M.new_rows(target, batch, ["a", "b"], ["v"]).collect()
    assert sorted(map(repr, got)) == sorted(repr(Row(a=k[0], b=k[1], v=v)) for k, v in want.items())
    assert M.new_rows(target.where("false"), batch, ["a", "b"]).count() == len({(r["a"], r["b"]) for r in batch.collect()})
    assert M.new_rows(target, batch.where("false"), ["a", "b"]).count() == 0


def test_possible_members_do_not_shuffle_the_rows(spark, tmp_dir):
    spark.range(100_000).select(F.col("id").cast("string").alias("k")).write.parquet(f"{tmp_dir}/target")
    target = spark.read.parquet(f"{tmp_dir}/target")
    keys = spark.range(99_990, 100_010).select(F.col("id").cast("string").alias("b"))
    left = common.possible_members(target, ["k"], keys, ["b"])
    rows = {r["k"] for r in left.collect()}
    assert {str(i) for i in range(99_990, 100_000)} <= rows and len(rows) < 20
    plan = left._jdf.queryExecution().executedPlan().toString()
    above_scan = plan[: plan.index("FileScan")]
    assert "BroadcastHashJoin" in above_scan and " Exchange hashpartitioning" not in above_scan.split("BroadcastExchange")[0]


def test_possible_members_need_equal_types(spark):
    with pytest.raises(ValueError, match="key types differ"):
        common.possible_members(spark.range(3), ["id"], spark.range(3).select(F.col("id").cast("int").alias("i")), ["i"])
