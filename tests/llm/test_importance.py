import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldreports.llm import importance_resampling as ir

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_features(text, max_n, buckets):
    w = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(w[i : i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]
    return len(w), [zlib.crc32(r.encode()) % buckets for r in runs]


def expected(rows, target, max_n=1, buckets=ir.BUCKETS, least=20, share=10, seed="2024"):
    """(doc_id, n_features, weight, score, rank) of every row, ranks by sorting all rows."""
    found = [(d, *plain_features(t, max_n, buckets)) for d, t in rows]
    s = Counter(b for *_, f in found for b in f)
    t = Counter(b for x in target for b in plain_features(x, max_n, buckets)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets)))) for b in s}
    out = []
    for d, n, f in found:
        weight, score = sum(gain[b] for b in f), None
        if d is not None:
            h = int(hashlib.sha256(f"{seed}:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(f), weight, score, None, n])
    able = [r for r in out if r[5] >= least and r[0] is not None]
    for k, r in enumerate(sorted(able, key=lambda r: (-r[3], r[0]))[: share * len(able) // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in out), key=str)


def result(docs, target, **options):
    got = ir.importance_sample(docs, target, **options)
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"max_n": 3, "buckets": 50, "least_words": 5, "share_percent": 60, "seed": "x"}, {"share_percent": 100}])
def test_matches_a_sort_of_all_rows(spark, corpus, rows, options):
    texts = [t for _, t in rows[50:58]] + [None, "", "Kara MO 7"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id int, text string")
    plain = {"max_n": "max_n", "buckets": "buckets", "least_words": "least", "share_percent": "share", "seed": "seed"}
    assert result(corpus, target, **options) == expected(rows, texts, **{plain[k]: v for k, v in options.items()})


def test_no_target_no_documents_and_nothing_drawn(spark, corpus, rows):
    empty = spark.createDataFrame([], "item_id int, text string")
    assert result(corpus, empty) == expected(rows, [])
    none = spark.createDataFrame([], "doc_id long, text string")
    assert result(none, empty) == []
    short = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert all(r[4] is None for r in result(short, empty))


@pytest.mark.parametrize("values", [[5], [3, 3, 3, 1, 9], [-4, -4, 7, 0, 0, 0, 2], [-(1 << 63), (1 << 63) - 1, 0, 0],
                                    [(1 << 40) + i // 3 for i in range(700)]])
def test_threshold_over_numbers(spark, values):
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, row long")
    rows.cache()
    for k in {1, 2, len(values) // 2, len(values)} - {0}:
        v = sorted(values)[k - 1] if k <= len(values) else None
        if v is None:
            continue
        assert ir.kth_smallest(rows, "v", k) == (v, sum(x < v for x in values), values.count(v))
        chosen = rows.where(ir.first_k(rows, ["v", "row"], k))
        assert sorted(tuple(r) for r in chosen.collect()) == sorted(sorted((v, i) for i, v in enumerate(values))[:k])


def test_many_ties(spark):
    """A third of the rows has one score; the cut falls among them."""
    rng = random.Random(3)
    values = [(7 if i % 3 == 0 else rng.randrange(1000), i // 2, i) for i in range(600)]
    rows = spark.createDataFrame(values, "fall long, doc_id long, row long").repartition(5)
    drawn = rows.where(ir.first_k(rows, ["fall", "doc_id", "row"], 101))
    ranks = ir.ranked(drawn, ["fall", "doc_id", "row"]).orderBy("rank").collect()
    assert [(r["fall"], r["doc_id"], r["row"]) for r in ranks] == sorted(values)[:101]
    assert [r["rank"] for r in ranks] == list(range(1, 102))


def test_words_of_any_length(spark):
    texts = ["x" * 4000 + " " + "é" * 300, "A" * 3 + "\x00b", "٣ ß É"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert result(docs, docs.select("text"), least_words=1, share_percent=50) == expected(list(enumerate(texts)), texts, least=1, share=50)
    assert docs.count() == ir.importance_sample(docs, docs).where(F.col("rank").isNull()).count()
