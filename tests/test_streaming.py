import os
from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from fieldreports import schemas
from fieldreports.streaming.intake import start_intake


def land(spark, rows, path):
    spark.createDataFrame(rows, schemas.RAW_MESSAGE).write.mode("append").parquet(path)


def test_intake_is_insert_only_across_batches(spark, tmp_dir):
    raw_dir = os.path.join(tmp_dir, "raw")
    table = os.path.join(tmp_dir, "messages")
    ckpt = os.path.join(tmp_dir, "ckpt")
    t = datetime(2018, 2, 27, 13, 0)
    a = (t, "10.02.2018", "ann", "1", "100", "e", 1)
    a_copy = (datetime(2018, 2, 27, 12, 0), "10.02.2018", "ann", "1", "200", "e", 2)
    b = (t, "11.02.2018", "bob", "2", "100", "e", 3)

    land(spark, [a, a_copy], raw_dir)
    start_intake(spark, raw_dir, table, ckpt).awaitTermination()
    first = spark.read.parquet(table).collect()
    assert len(first) == 1 and first[0]["senderPhone"] == "200"   # earlier copy of the batch wins

    land(spark, [b, a], raw_dir)
    start_intake(spark, raw_dir, table, ckpt).awaitTermination()
    rows = sorted((r["patientName"], r["senderPhone"]) for r in spark.read.parquet(table).collect())
    assert rows == [("ANN", "200"), ("BOB", "100")]

    # nothing new: a rerun adds nothing
    start_intake(spark, raw_dir, table, ckpt).awaitTermination()
    assert spark.read.parquet(table).count() == 2


def test_intake_stops_when_its_table_cannot_be_read(spark, tmp_dir):
    """A damaged table must not pass for an empty one: the batch would be appended again."""
    raw_dir, table = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "messages")
    land(spark, [(datetime(2018, 2, 27), "10.02.2018", "ann", "1", "100", "e", 1)], raw_dir)
    os.makedirs(table)
    with open(os.path.join(table, "part-0.parquet"), "w") as fh:
        fh.write("not a parquet file")
    with pytest.raises(PySparkException):
        start_intake(spark, raw_dir, table, os.path.join(tmp_dir, "ckpt")).awaitTermination()
    assert os.listdir(table) == ["part-0.parquet"] or not [f for f in os.listdir(table) if f.endswith(".snappy.parquet")]
