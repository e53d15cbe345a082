"""The driver contract and a small oracle comparison at sf0.001."""

import datetime as dt
import os
from collections import Counter

import pytest

import __spark_entry__ as entry_mod
from fieldreports.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="shared test data not present")


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["number", "payment", "reports", "payment_due"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert set(QUERIES) <= set(entry_mod.oracle_sql())


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, dt.datetime):
            return v.isoformat()
        return v

    return [cols[i] for i in order], Counter(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", ["worker_payments", "super_payments", "pick_needed_calls", "queue_refresh",
                                  "reconcile_survey", "event_upsert"])
def test_matches_duckdb(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry_mod.queries()[name](spark, SF)
    cur = con.execute(entry_mod.oracle_sql()[name])
    duck = _canon([d[0] for d in cur.description], cur.fetchall())
    ours = _canon(df.columns, [tuple(r) for r in df.collect()])
    assert ours == duck
