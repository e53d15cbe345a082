import random

import numpy as np
import pytest

from fieldreports.llm import line_dedup as ld


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, s, edits):
    s = list(s)
    for _ in range(edits):
        at, kind = rng.randrange(len(s)), rng.randrange(3)
        if kind == 0:
            s[at] = rng.choice("abé")
        elif kind == 1:
            s.insert(at, rng.choice("abé"))
        elif len(s) > 1:
            del s[at]
    return "".join(s)


def expected(rows):
    """Removed line numbers per document, by comparing every two lines."""
    first, seen = {}, []
    for doc, text in rows:
        if doc is not None:
            for k, line in ld.lines_of(text):
                seen.append(((doc, k), line))
                first[line] = min(first.get(line, (doc, k)), (doc, k))
    least = {x: min(f for y, f in first.items() if x == y or abs(len(x) - len(y)) <= ld.TAU and distance(x, y) <= ld.TAU)
             for x in first}
    return {at for at, line in seen if at > least[line]}


def test_automaton_is_edit_distance():
    rng = random.Random(3)
    left = ["".join(rng.choice("abé") for _ in range(rng.randrange(1, 25))) for _ in range(300)]
    right = [changed(rng, x, rng.randrange(5)) for x in left]
    assert ld.within(left, right).tolist() == [distance(x, y) <= ld.TAU for x, y in zip(left, right)]
    assert ld.within(["", "", "ab"], ["", "abc", ""]).tolist() == [True, False, True]


def test_every_near_pair_shares_a_segment():
    rng = random.Random(4)
    base = ["".join(rng.choice("abé") for _ in range(rng.randrange(6, 20))) for _ in range(200)]
    lines = list(dict.fromkeys(base + [changed(rng, x, rng.randrange(1, 3)) for x in base]))
    key, owner = ld.segment_rows(lines, np.arange(len(lines), dtype=np.int64) * 2)
    probes, cuts = {}, {}
    for k, o in zip(key.tolist(), owner.tolist()):
        probes.setdefault(k, set()).add(o >> 1)
        if o & 1:
            cuts.setdefault(k, set()).add(o >> 1)
    met = {(x, y) for k, some in cuts.items() for x in some for y in probes[k]}
    near = [(i, j) for i in range(len(lines)) for j in range(i) if distance(lines[i], lines[j]) <= ld.TAU]
    assert near and all((i, j) in met or (j, i) in met for i, j in near)


def test_report_matches_comparison_of_all_lines(corpus, rows):
    gone = expected(rows)
    assert len(gone) > 5
    got = ld.line_report(corpus).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for d, t in rows if d == r["doc_id"] and ((t is None) == (r["text"] is None)))
        if text is None:
            assert (r["n_lines"], r["n_removed"], r["text"]) == (0, 0, None)
            continue
        lines = text.split("\n")
        kept = [x for k, x in enumerate(lines) if (r["doc_id"], k) not in gone]
        assert r["text"] == "\n".join(kept)
        assert (r["n_lines"], r["n_removed"]) == (len(lines), len(lines) - len(kept))


def test_hot_group_is_dealt_into_tiles(spark, monkeypatch):
    """Many different lines that share a segment; tiles of two lines."""
    rng = random.Random(6)
    middle = "the same words stand in the middle of every line"
    lines = [changed(rng, "abcdefghijklmnopqr", 3) + middle + changed(rng, "rqponmlkjihgfedcba", rng.randrange(3)) for _ in range(60)]
    rows = [(i, x) for i, x in enumerate(lines)]
    monkeypatch.setattr(ld, "TILE", 2)
    got = {r["doc_id"] for r in ld.line_report(spark.createDataFrame(rows, "doc_id long, text string")).where("n_removed > 0").collect()}
    assert got == {doc for doc, _ in expected(rows)}


def test_dedup_keeps_rows_and_columns(corpus):
    out = ld.dedup_lines(corpus)
    assert out.schema == corpus.schema
    left = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    report = sorted(((r["doc_id"], r["text"]) for r in ld.line_report(corpus).collect()), key=str)
    assert left == report


def test_empty_table(spark, corpus):
    none = corpus.where("false")
    assert ld.line_report(none).count() == 0
    assert ld.dedup_lines(none).count() == 0


@pytest.mark.parametrize("n", [20, 21, 22, 23, 100])
def test_segments_cover_the_line(n):
    parts = [(int(s[0]), int(m[0])) for s, m in ld.segment_starts(np.array([n]))]
    assert parts[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(parts, parts[1:])) and sum(parts[-1]) == n
