import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from fieldreports.llm import periodic_runs as pr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w, least=6, times=4):
    """All runs by comparing every word with the one q words on, for every q."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        same = [w[k] == w[k + q] for k in range(len(w) - q)] + [False]
        k = 0
        while k < len(same):
            n = same.index(False, k) - k
            if n and n + q >= max(least, times * q) and not any(
                    all(w[k + x] == w[k + x + p] for x in range(n + q - p)) for p in range(1, q)):
                out.append((k, n + q, q))
            k += n + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text, rewrite=True):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if rewrite and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[:1]
    told = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    rest = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *(best[0] if best else (None,) * 3), best[0][1] * 1000 // best[0][2] if best else None,
            hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest())


def result(docs, **options):
    got = pr.periodic_runs(docs, **options).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("least, times", [(6, 4), (2, 2), (5, 3)])
def test_runs_of_random_words(least, times):
    rng = random.Random(31)
    texts = []
    for _ in range(600):
        n, kinds = rng.randint(0, 60), rng.choice([1, 2, 3, 4])
        w = [rng.randrange(kinds) for _ in range(n)]
        if n and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(2, 10)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        texts.append(w)
        assert sorted(pr.stretch_runs(w, least, times), key=lambda r: (r[0], r[2])) == plain_runs(w, least, times)
    h = np.array([x for w in texts for x in w], dtype=np.uint64)
    at = np.cumsum([0] + [len(w) for w in texts])
    assert pr.runs_of_texts(h, at, least, times) == [plain_runs(w, least, times) for w in texts]


def test_matches_plain_version(spark, corpus, rows):
    assert result(corpus, rewrite=pr.planted_order) == sorted((expected(d, t) for d, t in rows if True), key=str)


def test_repeating_texts(spark):
    rng = random.Random(8)
    texts = [None, "", "a", "a a a a a", "a a a a a a", "x " + "a b " * 3 + "y", "x " + "a b\n" * 4 + "a y", ("p q r " * 4 + "z ") * 5,
             "buy now! " * 700, "Zürich ß x " * 9, "A a " * 8]
    for _ in range(60):
        w = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 90))]
        texts.append(" ".join(w))
    rows = list(enumerate(texts)) + [(None, "o o o o o o o"), (4, "a a a a a a"), (4, "b b b b b b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(docs) == sorted((expected(d, t, False) for d, t in rows), key=str)
    assert result(docs, rewrite=pr.planted_order) == sorted((expected(d, t) for d, t in rows), key=str)


def test_collapse_keeps_rows_and_columns(spark):
    rows = [(1, "go  on\n" + "ha " * 9 + "stop", 7), (1, "plain  text\n", None), (None, None, 1), (2, "", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, run int")
    got = pr.collapse_runs(docs)
    assert got.schema == docs.schema
    assert [tuple(r) for r in got.collect()] == [(1, "go on ha stop", 7), (1, "plain  text\n", None), (None, None, 1), (2, "", 2)]


def test_long_texts_in_seconds():
    for w in ([0] * 100_000, [i % 2 for i in range(100_000)], [(i % 3000) * 7 for i in range(60_000)]):
        found = pr.stretch_runs(w)
        assert len(found) == 1 and found[0][:2] == (0, len(w))


def test_empty_table(spark):
    assert pr.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
