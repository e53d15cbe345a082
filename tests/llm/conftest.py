import os
import random

import pytest

SF = "/root/testdata/sf0.001"
VOCABULARY = [a + b + c for a in ("ka", "mo", "tir", "sel", "uné") for b in ("ra", "lin", "do", "ß") for c in ("", "s", "ten", "ia")]
# Column names that the operators use inside.
CLASHES = ("doc", "gone", "copy", "key", "route", "cls", "n", "size", "a", "b", "first", "found", "block", "u", "h", "score")


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="session")
def shared_tables():
    if not os.path.exists(SF):
        pytest.skip("shared test data not present")
    return SF


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents with copies, near copies, shared passages and odd rows; extra columns with clashing names."""
    rng = random.Random(5)
    rows = []
    base = prose(rng, 120)
    passage = prose(rng, 30)
    for i in range(40):
        rows.append((i, prose(rng, rng.randint(12, 90)) + "\n" + prose(rng, 20)))
    for i in range(40, 52):  # near copies: a few words exchanged
        words = base.split()
        for _ in range(i - 40):
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
        rows.append((i, " ".join(words)))
    for i in range(52, 58):
        rows.append((i, prose(rng, 15) + "\n" + passage + "\n" + prose(rng, 15)))
    for i in range(58, 62):  # near lines: one or two characters differ
        rows.append((i, passage[: 10 * (i - 57)] + "x" + passage[10 * (i - 57):] + "\n" + prose(rng, 14)))
    rows += [(62, rows[3][1]), (63, rows[3][1].upper()), (64, ""), (65, None), (66, "kara"), (67, "kara mo"), (68, "   \n\t "),
             (69, prose(rng, 6000)), (70, rows[41][1]), (70, rows[41][1]), (None, base), (None, None), (71, "a" * 5000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in CLASHES)
    data = [(i, t, None if (i or 0) % 7 == 0 else "xx", None if (i or 0) % 5 == 0 else f"s{(i or 0) % 3}", None, *[1] * len(CLASHES))
            for i, t in rows]
    return spark.createDataFrame(data, schema).repartition(3)


@pytest.fixture(scope="session")
def rows(corpus):
    return [(r["doc_id"], r["text"]) for r in corpus.collect()]
