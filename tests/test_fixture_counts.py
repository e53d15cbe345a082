"""Branch counts at sf0.001: the adapter's branches hold rows, and the counts equal
those of the SQL formulation."""

import os

import pytest
from pyspark.sql import functions as F

from fieldreports.operators import survey as V
from fieldreports.operators.normalize import flatten_survey
from fieldreports.plans import catalog as K
from fieldreports.sources import adapter as A

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="shared test data not present")

COUNTS = {
    "after dedupe": "dd", "non-training": "enriched WHERE NOT training", "picked": "picks", "survey responses": "resp",
    "unanswered": "resp WHERE provided_care IS NULL", "clean survey rows": "cs", "final orphans": "orph2",
    "matched in pass 1": "both1", "matched in pass 2": "both2",
}


def test_counts_match_the_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    import oracle_sql

    con = duckdb.connect()
    for t in ("events", "customer", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = {k: con.execute(oracle_sql.with_ctes(f"SELECT count(*) FROM {src}")).fetchone()[0] for k, src in COUNTS.items()}

    e = K._enriched(spark, SF)
    responses = flatten_survey(A.survey_responses(spark, SF))
    clean = V.clean_survey(responses)
    report, orphans = V.reconcile_survey(e, clean)
    same_day = F.col("visitdate") == F.date_format("serviceDate", "yyyy-MM-dd")
    matched = report.where(F.col("_merge") == "both")
    got = {
        "after dedupe": e.count(),
        "non-training": e.where(~F.col("training")).count(),
        "picked": K.pick_needed_calls(spark, SF).count(),
        "survey responses": responses.count(),
        "unanswered": responses.where(F.col("provided_care").isNull()).count(),
        "clean survey rows": clean.count(),
        "final orphans": orphans.count(),
        "matched in pass 1": matched.where(same_day).count(),
        "matched in pass 2": matched.where(~F.coalesce(same_day, F.lit(False))).count(),
    }
    assert got == want and min(got.values()) > 0


def test_branches_that_need_special_rows(spark):
    counts = K.quality_counts(spark, SF).first().asDict()
    assert counts["unknown_event_names"] > 0 and counts["unreadable_visit_dates"] > 0
    assert K.roster_coverage(spark, SF).first()["missing"] > 0
    queue = K.queue_refresh(spark, SF)
    assert queue.where("district LIKE 'closed %'").count() > 0
    assert queue.where("payload LIKE '{\"old\"%' AND district NOT LIKE 'closed %'").count() > 0
