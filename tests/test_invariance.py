"""Results must not depend on how the input is partitioned or ordered."""

import os

import pytest
from pyspark.sql import functions as F

from fieldreports.operators import calls as C
from fieldreports.operators import enrich as E
from fieldreports.operators import payments as P
from fieldreports.sources import adapter as A

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="shared test data not present")


def shuffled(df, n, seed):
    return df.repartition(n).orderBy(F.rand(seed))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def enriched(spark, msgs):
    return E.enrich(msgs, A.status_events(spark, SF), A.roster(spark, SF), A.crosswalk(spark, SF))


def test_dedupe_and_payments_ignore_input_order(spark):
    msgs = A.messages(spark, SF)
    other = shuffled(msgs, 7, 3)
    assert rows(E.dedupe_messages(msgs)) == rows(E.dedupe_messages(other))
    pay = P.worker_payments(P.capped_counts(enriched(spark, msgs), A.AS_OF))
    pay2 = P.worker_payments(P.capped_counts(enriched(spark, other), A.AS_OF))
    assert rows(pay) == rows(pay2)


def test_quota_pick_ignores_input_order(spark):
    e = enriched(spark, A.messages(spark, SF))
    picks = C.call_batch(e, A.AS_OF)
    picks2 = C.call_batch(shuffled(e, 5, 9), A.AS_OF)
    assert rows(picks) == rows(picks2)
