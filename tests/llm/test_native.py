"""Operators 2 and 10: SQL functions only."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldreports.llm import mixing, pseudonyms


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return (sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def rewrite(spark, texts, key="k"):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.asDict() for r in pseudonyms.pseudonymise(docs, key).orderBy("doc_id").collect()]


def test_formats_and_validity(spark):
    card, invalid = "4111 1111 1111 1111", "4111111111111112"
    got = rewrite(spark, [
        f"card {card} or {invalid}.", "card 4111-1111-1111-1111", "mail jo.doe7@mail.example.com!", "ip 10.0.0.255 not 300.1.1.1", "on 2001-02-28 not 2001-02-30",
        "on 02/28/2001", "on 28.02.2001", "ssn 123-45-6789 not 000-12-3456", "call +1 (766) 555-2373 or 766-555-2373", "iban GB82 WEST 1234 5698 7654 32"])
    new = [r["text"] for r in got]
    found = re.search(r"card (\d{4} \d{4} \d{4} \d{4}) or", new[0])[1]
    assert found != card and luhn(found.replace(" ", "")) and invalid in new[0]
    assert new[1] == "card " + found.replace(" ", "-")  # linked across layouts
    assert re.fullmatch(r"mail [A-Za-z0-9]{2}\.[A-Za-z0-9]{4}@mail\.example\.com!", new[2]) and "jo.doe7" not in new[2]
    assert all(int(x) < 256 for x in re.search(r"ip ([\d.]+) not", new[3])[1].split(".")) and "300.1.1.1" in new[3]
    y, m, d = re.search(r"on (\d{4})-(\d\d)-(\d\d) not 2001-02-30", new[4]).groups()
    assert new[5] == f"on {m}/{d}/{y}" and new[6] == f"on {d}.{m}.{y}"
    area, group, serial = re.search(r"ssn (\d{3})-(\d\d)-(\d{4}) not 000-12-3456", new[7]).groups()
    assert 0 < int(area) < 900 and area != "666" and int(group) and int(serial)
    a, b, c, x, y, z = re.fullmatch(r"call \+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3})-(\d{3})-(\d{4})", new[8]).groups()
    assert (a, b, c) == (x, y, z) != ("766", "555", "2373") and int(a) >= 200 and int(b) >= 200
    iban = re.search(r"iban (GB\d\d WEST \d{4} \d{4} \d{4} \d\d)", new[9])[1].replace(" ", "")
    assert int("".join(str(int(ch, 36)) for ch in iban[4:] + iban[:4])) % 97 == 1
    assert [r["n_card"] for r in got[:2]] == [1, 1] and got[2]["n_mail"] == 1 and got[8]["n_phone"] == 2
    assert rewrite(spark, [f"card {card}"], key="other")[0]["text"] != f"card {found}"


def test_permutations_are_bijections(spark):
    ids = spark.range(73000)
    image = ids.select(pseudonyms.feistel("k", "date", F.col("id"), *pseudonyms.DAYS).alias("x")).distinct()
    assert image.agg(F.count("*"), F.min("x"), F.max("x")).first() == (73000, 0, 72999)
    for n in (1, 2, 3):
        digits = spark.range(10**n).select(F.lpad(F.col("id").cast("string"), n, "0").alias("s"))
        assert digits.select(pseudonyms._permute_digits("k", "t", F.col("s")).alias("x")).distinct().count() == 10**n
    mails = spark.createDataFrame([(i, f"{a}{b}@x.org") for i, (a, b) in enumerate((a, b) for a in "abcxyz019AZ" for b in "abcxyz019AZ")], "doc_id long, text string")
    assert pseudonyms.pseudonymise(mails, "k").select("text").distinct().count() == 121


def test_phones_keep_their_class_and_never_meet(spark):
    rng = random.Random(3)
    numbers = [(rng.randrange(1000), rng.randrange(1000), rng.randrange(10000)) for _ in range(300)] + [(11, 555, 1), (199, 999, 9999), (999, 199, 0), (0, 0, 0)]
    numbers = list(dict.fromkeys(numbers))
    got = rewrite(spark, [f"+1 ({a:03d}) {b:03d}-{c:04d}" for a, b, c in numbers])
    new = [tuple(map(int, re.fullmatch(r"\+1 \((\d{3})\) (\d{3})-(\d{4})", r["text"]).groups())) for r in got]
    kind = lambda a, b: "low" if a < 200 else "odd" if b < 200 else "good"
    assert [kind(a, b) for a, b, _ in new] == [kind(a, b) for a, b, _ in numbers]
    assert len(set(new)) == len(numbers) and sum(x == y for x, y in zip(new, numbers)) == 0
    assert all(r["n_phone"] == 1 for r in got)


def test_pseudonyms_odd_rows(corpus, rows, spark):
    got = pseudonyms.pseudonymise(corpus, "k")
    plain = {t for _, t in rows}
    assert {r["text"] for r in got.collect()} == plain  # nothing personal in it
    assert got.count() == len(rows) and pseudonyms.pseudonymise(corpus.where("false"), "k").count() == 0
    long = "x " * 20_000 + "a.b@c.de"
    assert rewrite(spark, [long, ""])[0]["text"].startswith("x x x")


def test_pseudonyms_run_without_python(corpus):
    plan = pseudonyms.pseudonymise(corpus, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.split("Scan")[0].split("Project")[-1]


# -- operator 10 ------------------------------------------------------------------

def order(seed, epoch, doc):
    return int(hashlib.md5(f"{seed}:{epoch}:{doc}".encode()).hexdigest()[:15], 16)


def mix_expected(rows, entropy_share, max_repeats, budget_share=1.0, seed=mixing.SEED):
    """(doc, source, tokens, epoch) drawn, with the exponent found by plain bisection of both conditions."""
    docs = [(d, s, len((t or "").split())) for d, t, s in rows]
    docs = [x for x in docs if x[2]]
    tokens = Counter()
    for _, s, n in docs:
        tokens[s] += n
    total = sum(tokens.values())
    p = {s: n / total for s, n in tokens.items()}

    def weights(x):
        z = sum(v**x for v in p.values())
        return {s: v**x / z for s, v in p.items()}

    def even(x):
        return -sum(v * math.log(v) for v in weights(x).values()) >= entropy_share * math.log(len(p))

    def rare(x):
        return max(budget_share * w / p[s] for s, w in weights(x).items()) <= max_repeats

    def bisect(test, low=0.0, high=1.0):
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if test(mid) else (low, mid)
        return low

    x = max(1.0 if even(1.0) else bisect(even), 0.0 if rare(0.0) else bisect(lambda v: not rare(v)))
    out = []
    for s, w in weights(x).items():
        budget = math.floor(budget_share * total * w)
        epochs, rest = divmod(budget, tokens[s])
        mine = sorted((d for d in docs if d[1] == s), key=lambda d: (order(seed, epochs, d[0]), d[0], d[2]))
        used = 0
        for d in mine:
            used += d[2]
            out += [(d[0], s, d[2], e) for e in range(epochs + (used <= rest))]
    return sorted(out, key=str), x


@pytest.mark.parametrize("entropy_share, max_repeats", [(0.98, 4.0), (0.98, 1.7), (0.1, 4.0), (1.0, 100.0)])
def test_mix_matches_plain_version(spark, entropy_share, max_repeats):
    rng = random.Random(12)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 40)), "big" if i % 3 else rng.choice(["a", "b", "c", None])) for i in range(400)]
    rows += [(400, "", "a"), (401, None, "b")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, epochs int").repartition(4)
    got = mixing.mix(docs, entropy_share, max_repeats)
    want, x = mix_expected(rows, entropy_share, max_repeats)
    assert sorted(((r["doc_id"], r["source"], r["n_tokens"], r["epoch"]) for r in got.collect()), key=str) == want
    assert 0 <= x <= 1
    for r in got.limit(20).collect():
        assert r["order_key"] == order(mixing.SEED, r["epoch"], r["doc_id"]) and r["block"] == r["order_key"] >> 48


def test_mix_cut_in_a_deep_block(spark, monkeypatch):
    """Blocks of one bit: the cut lies in a part that holds many documents."""
    monkeypatch.setattr(mixing, "BLOCK_BITS", 1)
    rows = [(i, "w " * (1 + i % 7), f"s{i % 2 * (i % 5)}") for i in range(200)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), 0.97, 3.0)
    assert sorted(((r["doc_id"], r["source"], r["n_tokens"], r["epoch"]) for r in got.collect()), key=str) == mix_expected(rows, 0.97, 3.0)[0]


def test_mix_odd_rows(corpus):
    out = mixing.mix(corpus)
    assert out.columns == ["doc_id", "source", "n_tokens", "epoch", "order_key", "block"]
    assert out.where("n_tokens = 0").count() == 0
    assert mixing.mix(corpus.where("false")).count() == 0
