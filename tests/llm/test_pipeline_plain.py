"""Each pipeline stage against a plain version of its own, on a small fixture; odd tables."""

import os
import re

import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline as cp
from fieldreports.llm import line_dedup as ld
from fieldreports.llm import mixing, quality_rules as qr
from test_jaccard_join import shingle_set
from test_line_blocks import one_run_expected
from test_line_dedup import distance
from test_native import mix_expected
from test_texts import quality_expected

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def banded(text):
    """The compression bands of operator 8, one text at a time."""
    data, packer = text.encode(), zstandard.ZstdCompressor(level=qr.LEVEL)
    share = lambda part: len(packer.compress(part)) / len(part)
    low, high = next((lo, hi) for below, lo, hi in qr.WHOLE_BANDS if below is None or len(data) < below)
    size, least, most = next((c, lo, hi) for below, c, lo, hi in qr.CHUNKS if below is None or len(data) < below)
    starts = list(range(0, len(data) - size + 1, size))
    if starts and len(data) % size:
        starts.append(len(data) - size)
    bad = sum(not least <= share(data[s : s + size]) <= most for s in starts)
    return low <= share(data) <= high and bad <= qr.CHUNK_SHARE * len(starts)


def quality_plain(rows):
    return [(d, t) for d, t in rows if t and not quality_expected(t)[-1] and banded(t)]


def lines_plain(rows):
    first, seen = {}, []
    for doc, text in rows:
        for k, line in ld.lines_of(text, 1) if doc is not None else ():
            seen.append(((doc, k), line))
            first[line] = min(first.get(line, (doc, k)), (doc, k))

    def near(x, y):
        if x == y or min(len(x), len(y)) < ld.MIN_CHARS or abs(len(x) - len(y)) > max(len(x), len(y)) // 10 + 10:
            return x == y
        return one_run_expected(x, y) or abs(len(x) - len(y)) <= ld.TAU and distance(x, y) <= ld.TAU

    least = {x: min(f for y, f in first.items() if near(x, y)) for x in first}
    gone = {at for at, line in seen if at > least[line]}
    return [(d, t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone)) for d, t in rows]


def near_plain(rows):
    sets = [(d, shingle_set(t)) for d, t in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if None not in (a, b) and x and y and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return [(d, t) for d, t in rows if d is None or find(d) == d]


def clean_plain(rows, items):
    words = lambda t: ALNUM.findall((t or "").translate(LOWER))
    windows = set()
    for item in items:
        w = words(item)
        n = min(len(w), 10)
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
    sizes = {len(x) for x in windows}
    hit = lambda w: any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))
    return [(d, t) for d, t in rows if not hit(words(t))]


PLAIN = {"quality rules": quality_plain, "line dedup": lines_plain, "near duplicates": near_plain}


@pytest.fixture(scope="module")
def folder(spark, corpus, rows, tmp_path_factory):
    """The odd corpus with some near copies that keep their lines apart, and a benchmark with two of its passages."""
    base = str(tmp_path_factory.mktemp("sf"))
    corpus.write.parquet(f"{base}/documents.parquet")
    texts = {d: t for d, t in rows}
    items = [" ".join(texts[5].split()[3:20]), " ".join(texts[9].split()[:12]), "no such words at all", "", None]
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base, items


def test_stages_match_plain_versions(spark, folder):
    base, items = folder
    docs = spark.read.parquet(f"{base}/documents.parquet")
    counts = []
    for name, stage in cp.STAGES[:-1]:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = cp.stored(stage(spark, docs, base))
        got = [(r["doc_id"], r["text"]) for r in out.collect()]
        want = PLAIN[name](before) if name in PLAIN else clean_plain(before, items)
        assert sorted(got, key=str) == sorted(want, key=str), name
        assert out.columns == docs.columns
        counts.append((len(before), len(got), before != got and sorted(before, key=str) != sorted(got, key=str)))
        docs = out
    # every stage but the near-duplicate one, whose copies lost their lines before, changes something here
    assert counts[0][2] and counts[1][2] and counts[3][2] and counts[1][0] == counts[1][1]
    left = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    mixed = cp.STAGES[-1][1](spark, docs, base)
    want, _ = mix_expected(left, mixing.ENTROPY_SHARE, mixing.MAX_REPEATS, mixing.BUDGET_SHARE)
    got = sorted(((r["doc_id"], r["source"], r["n_tokens"], r["epoch"]) for r in mixed.collect()), key=str)
    assert got == want and len(got) > 20


def test_near_duplicate_stage_keeps_the_smallest_of_each_group(spark, corpus, rows):
    got = sorted(((r["doc_id"], r["text"]) for r in cp.near_duplicate_stage(spark, corpus, "").collect()), key=str)
    want = near_plain(rows)
    assert got == sorted(want, key=str) and len(want) < len(rows)


def test_empty_tables(spark, corpus, folder, tmp_path):
    base = str(tmp_path)
    corpus.where("false").write.parquet(f"{base}/documents.parquet")
    spark.read.parquet(f"{folder[0]}/benchmark.parquet").where("false").write.parquet(f"{base}/benchmark.parquet")
    assert cp.run(spark, base).count() == 0
    some = spark.read.parquet(f"{folder[0]}/documents.parquet").where(F.col("doc_id") < 30)
    assert cp.decontaminate_stage(spark, some, base).count() == some.count()
    assert os.path.exists(f"{base}/benchmark.parquet")
