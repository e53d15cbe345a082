"""Operator 1: lines that differ in one run, and short lines."""

import random

import numpy as np
import pytest

from conftest import prose
from fieldreports.llm import line_dedup as ld
from test_line_dedup import distance


def one_run_expected(x, y):
    short, most = sorted((len(x), len(y)))
    return any(x[:p] == y[:p] and x[len(x) - s:] == y[len(y) - s:] for p in range(short + 1) for s in [max(0, most - max(most // 10, min(10, most // 6)) - p)] if p + s <= short)


def changed_run(rng, s):
    at, size = rng.randrange(len(s)), rng.randrange(len(s) // 7 + 1)
    return s[:at] + "".join(rng.choice("xyzé") for _ in range(rng.randrange(len(s) // 7 + 1))) + s[at + size:]


@pytest.fixture(scope="module")
def near_lines():
    rng = random.Random(31)
    base = [prose(rng, rng.randrange(4, 60)) for _ in range(60)]
    lines = base + [changed_run(rng, x) for x in base for _ in range(3)] + [changed_run(rng, changed_run(rng, x)) for x in base]
    lines = [x for x in dict.fromkeys(x.strip() for x in lines) if len(x) >= ld.MIN_CHARS]
    rng.shuffle(lines)
    return lines


def test_one_run(near_lines):
    rng = random.Random(32)
    pairs = [(x, changed_run(rng, x)) for x in near_lines] + [(x, x) for x in near_lines[:5]] + [("ab" * 20, "ab" * 21), ("a" * 30, "a" * 34)]
    want = [one_run_expected(x, y) for x, y in pairs]
    assert [ld.one_run(x, y) for x, y in pairs] == want and 20 < sum(want) < len(want) - 20


def test_every_pair_of_one_run_shares_an_end(near_lines):
    key, owner = ld.segment_rows(near_lines, np.arange(len(near_lines), dtype=np.int64) * 2, True)
    probes, cuts = {}, {}
    for k, o in zip(key.tolist(), owner.tolist()):
        if k & 1:
            probes.setdefault(k, set()).add(o >> 1)
            if o & 1:
                cuts.setdefault(k, set()).add(o >> 1)
    met = {(x, y) for k, some in cuts.items() for x in some for y in probes[k]}
    near = [(i, j) for i in range(len(near_lines)) for j in range(i) if one_run_expected(near_lines[i], near_lines[j])]
    assert len(near) > 50 and all((i, j) in met or (j, i) in met for i, j in near)


@pytest.mark.parametrize("tile", [ld.TILE, 2])
def test_report_with_blocks_matches_comparison_of_all_lines(spark, monkeypatch, near_lines, tile):
    monkeypatch.setattr(ld, "TILE", tile)
    linked = lambda x, y: one_run_expected(x, y) or abs(len(x) - len(y)) <= ld.TAU and distance(x, y) <= ld.TAU
    want = {i for i, x in enumerate(near_lines) if any(linked(x, y) for y in near_lines[:i])}
    docs = spark.createDataFrame(list(enumerate(near_lines)), "doc_id long, text string").repartition(3)
    assert {r["doc_id"] for r in ld.line_report(docs, blocks=True).where("n_removed > 0").collect()} == want
    plain = {r["doc_id"] for r in ld.line_report(docs).where("n_removed > 0").collect()}
    assert plain < want


def test_a_changed_word_or_date_and_short_repeats(spark):
    line = "the committee met on {} to hear the report of the {} about the harbour"
    texts = ["Yes.\n" + line.format("2020-05-12", "engineer"), "Yes.\n\n" + line.format("1999-11-30", "engineer"),
             " Yes. \n\n" + line.format("2020-05-12", "inspector"), "yes."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["text"]) for r in ld.line_report(docs, blocks=True).collect()}
    assert got == {0: (0, texts[0]), 1: (2, ""), 2: (2, ""), 3: (0, "yes.")}
