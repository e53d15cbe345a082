"""Operators 6 and 7: held-out accuracy and odd rows."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from fieldreports.llm import language_id, quality_classifier
from fieldreports.llm.ftrl import Ftrl, softmax, temperature

import numpy as np


def held(doc_id, parts, rest):
    return zlib.crc32(str(doc_id).encode()) % parts == rest


def test_language_held_out_accuracy(spark, shared_tables):
    docs = spark.read.parquet(f"{shared_tables}/documents.parquet")
    out = language_id.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == docs.count()
    assert all(r["held_out"] == held(r["doc_id"], 5, 0) and 0 <= r["score"] <= 1 for r in out)
    new = [r for r in out if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in new) >= 0.9 * len(new)


def test_language_learns_nothing_from_held_out_rows(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        lang = "xx" if i % 2 else "yy"
        word = (lambda: "".join(rng.choice("abc" if lang == "xx" else "xyz") for _ in range(5)))
        # the held-out rows carry a wrong language
        rows.append((i, " ".join(word() for _ in range(12)), "zz" if held(i, 5, 0) else lang))
    rows += [(1001, None, "xx"), (1002, "", "xx"), (1003, "12 !? 34", None), (1004, "abcab cabca", None), (None, "abc", "xx"), (1004, "abcab cabca", None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    out = language_id.language_report(docs).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    assert all(by[i]["lang_pred"] == ("xx" if i % 2 else "yy") for i in range(300))
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (1001, 1002, 1003))
    assert by[1004]["lang_pred"] == "xx" and not by[None]["held_out"]


def test_language_nothing_to_learn(spark, corpus):
    unlabelled = corpus.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.language_report(unlabelled).collect()} == {"und"}
    assert language_id.language_report(corpus.where("false")).count() == 0


def test_grams_do_not_cross_texts():
    alone, _ = language_id.grams(["ab"])
    both, at = language_id.grams(["ab", "ab", "", "İx"])
    assert both[: len(alone)].tolist() == alone.tolist() == both[at[1] : at[2]].tolist()
    assert at[2] == at[3] and at[-1] == len(both)


def test_quality_held_out_accuracy(spark, shared_tables):
    docs = spark.read.parquet(f"{shared_tables}/documents.parquet")
    labels = spark.read.parquet(f"{shared_tables}/labels.parquet")
    out = quality_classifier.quality_report(docs, labels)
    got = out.join(labels.dropDuplicates(["doc_id"]), "doc_id").collect()
    assert out.count() == docs.count()
    assert all(r["held_out"] == held(r["doc_id"], 4, 2) and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    new = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in new) >= 0.85 * len(new)


def test_quality_odd_rows(spark, corpus, rows):
    labels = spark.createDataFrame([(i, i % 2, "t") for i in range(60)] + [(1, 1, "t"), (1, 1, "t"), (2, None, "t"), (None, 1, "t"), (9999, 0, "t")],
                                   "doc_id long, quality int, text string")
    out = quality_classifier.quality_report(corpus, labels).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert quality_classifier.quality_report(corpus.where("false"), labels).count() == 0
    assert {r["score"] for r in quality_classifier.quality_report(corpus, labels.where("false")).collect()} == {0.5}


def test_ftrl_separates_and_is_sparse():
    rng = np.random.default_rng(0)
    model = Ftrl(50, 3, rate=0.5, l1=0.5, l2=0.01)
    for _ in range(400):
        y = int(rng.integers(3))
        at, value = np.array([y, 3 + int(rng.integers(47))]), np.ones(2)
        error = softmax(value @ model.weights(at))
        error[y] -= 1
        model.learn(at, value, error)
    w = model.weights()
    assert (w[:3].argmax(axis=1) == np.arange(3)).all() and (w == 0).mean() > 0.3


@pytest.mark.parametrize("scale", [0.3, 1.0, 4.0])
def test_temperature_recovers_the_scale(scale):
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(4000, 3)) * 2
    truth = np.array([rng.choice(3, p=p) for p in softmax(scores)])
    assert temperature(scores * scale, truth) == pytest.approx(scale, rel=0.15)
    assert temperature(np.zeros((0, 3)), np.zeros(0, dtype=int)) == 1.0
