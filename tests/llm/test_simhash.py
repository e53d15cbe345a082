import random
import re

import numpy as np
import pytest
import xxhash

from fieldreports.llm import simhash_join as sj

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def expected(rows):
    """(doc_id, fingerprint, component) by comparing every two rows."""
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    root = {d: d for d, _ in prints if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(prints):
        for b, y in prints[:i]:
            if a is not None and b is not None and (x ^ y).bit_count() <= 4:
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return sorted(((d, f"{x:016x}", None if d is None else find(d)) for d, x in prints), key=str)


def result(docs):
    return sorted((tuple(r) for r in sj.simhash_groups(docs).select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_matches_comparison_of_all_texts(corpus, rows):
    assert result(corpus) == expected(rows)


def near(rng, base, most):
    for b in rng.sample(range(64), rng.randint(0, most)):
        base ^= 1 << b
    return base


def plain_links(codes):
    return {(x, y) for x in codes for y in codes if x < y and (x ^ y).bit_count() <= 4}


def roots(codes, links):
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a, b in links:
        root[find(a)] = find(b)
    groups = {}
    for c in codes:
        groups.setdefault(find(c), set()).add(c)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("tile", [2048, 8])
def test_links_of_families(spark, monkeypatch, tile):
    """Families of near fingerprints, whole and in tiles, next to unrelated ones."""
    monkeypatch.setattr(sj, "TILE", tile)
    rng = random.Random(17)
    codes = {0, (1 << 64) - 1, 1, 1 << 63}
    for _ in range(12):
        base = rng.getrandbits(64)
        codes |= {near(rng, base, 6) for _ in range(rng.choice([2, 5, 60]))}
    codes |= {rng.getrandbits(64) for _ in range(300)}
    signed = np.array(sorted(codes), dtype=np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(c,) for c in signed], "fp long").repartition(4)
    found = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in sj.fingerprint_links(nodes).collect()]
    assert roots(codes, found) == roots(codes, plain_links(codes))
    assert len(found) <= 64 * len(codes)


def test_every_pair_shares_a_key_and_keeps_its_budgets():
    """For every pattern of differing bits a chain exists under which the pair meets and passes."""
    rng = random.Random(23)
    for n in range(1, 6):
        for _ in range(400):
            x = rng.getrandbits(64)
            y = x
            for b in rng.sample(range(64), n):
                y ^= 1 << b
            pair = np.array([x, y], dtype=np.uint64)
            key, probe, row = sj.chain_keys(pair)
            met = set()
            for k, p, r in zip(key.tolist(), probe.tolist(), row.tolist()):
                met |= {k >> 40 for k2, p2, r2 in zip(key.tolist(), probe.tolist(), row.tolist()) if k2 == k and r2 != r and not (p and p2)}
            starts = np.array(sorted(met), dtype=np.int64)
            passed = len(sj.close(np.full(len(starts), x ^ y, dtype=np.uint64), starts)) > 0
            assert passed == (n <= 4)


def test_long_text_and_empty_table(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(70_000)), "q" * 100_000, "A\tb\x0bC", "a b c", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert result(docs) == expected(list(enumerate(texts)))
    assert result(spark.createDataFrame([], "doc_id long, text string")) == []


def test_leaders():
    rng = random.Random(4)
    for _ in range(50):
        n = rng.randint(1, 40)
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randint(0, n))]
        a, b = (np.array([x[k] for x in links], dtype=np.int64) for k in (0, 1))
        lead = sj.leaders(a, b, n)
        for group in roots(range(n), links):
            assert {int(lead[c]) for c in group} == {group[0]}
