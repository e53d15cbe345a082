"""The pipeline stages in order, each judged on its own input."""

import os

import __spark_entry__ as entry
import corpus_pipeline as cp
from fieldreports.llm import decontaminate, quality_rules
from fieldreports.llm.queries import ORACLE_SQL, QUERIES
from fieldreports.llm.shared import new_path


def test_queries_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(QUERIES) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_stages(spark, shared_tables):
    docs = spark.read.parquet(f"{shared_tables}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in cp.STAGES[:-1]:
        out = cp.stored(stage(spark, docs, shared_tables))
        assert out.columns == columns and out.schema == docs.schema, name
        kept = {r["doc_id"] for r in out.collect()}
        assert kept <= ids
        if name == "quality rules":
            good = {r["doc_id"] for r in quality_rules.quality_rules(docs).where("kept").collect()}
            assert kept == good
        elif name == "line dedup":
            assert kept == ids and out.where("n_chars <> length(text)").count() == 0
        elif name == "benchmark decontamination":
            left = decontaminate.contamination_report(out, spark.read.parquet(f"{shared_tables}/benchmark.parquet"))
            assert left.where("contaminated").count() == 0
        docs, ids = out, kept
    mixed = cp.STAGES[-1][1](spark, docs, shared_tables).collect()
    assert {r["doc_id"] for r in mixed} <= ids and mixed


def test_run(spark, shared_tables):
    out = cp.run(spark, shared_tables)
    assert out.count() > 0 and "doc_id" in out.columns


def test_run_keeps_only_the_last_result(spark, shared_tables):
    folder = new_path(spark).rsplit("/", 1)[0].removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    out = cp.run(spark, shared_tables)
    # the result that the mixture is drawn from, and tables of the mixing stage itself
    last = {f.removeprefix("file://").split(folder)[1].split("/")[1] for f in out.inputFiles() if folder in f}
    assert set(os.listdir(folder)) - before >= last and len(set(os.listdir(folder)) - before) <= 2
    assert out.count() > 0
