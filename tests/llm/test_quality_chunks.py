"""Operator 8: encoded text at the end of a document, in one of three chunks, and in short documents."""

import base64
import random

import pyarrow as pa

from fieldreports.llm import quality_rules
from fieldreports.llm.words import texts_of

SYLLABLES = ("ka", "mo", "tir", "sel", "un", "ra", "lin", "do", "s", "e")


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 5))) for _ in range(n))[:n]


def blob(rng, n):
    text = base64.b64encode(rng.randbytes(n)).decode()
    return "\n".join(text[i : i + 76] for i in range(0, len(text), 76))[:n]


def good(texts):
    return quality_rules.bands(texts_of(pa.array(texts)))["good"].tolist()


def test_encoded_text_is_found_wherever_it_stands():
    rng = random.Random(41)
    for _ in range(10):
        assert good([prose(rng, n) for n in (300, 900, 1400, 4095, 6144)]) == [True] * 5
        bad = [prose(rng, 2048) + blob(rng, 2047), prose(rng, 2048) + blob(rng, 2048) + prose(rng, 2048), prose(rng, 4096) + blob(rng, 2047),
               prose(rng, 700) + blob(rng, 700), blob(rng, 900), blob(rng, 300)]
        assert good(bad) == [False] * len(bad)


def test_chunks_cover_the_text():
    assert [quality_rules.chunk_starts(n, 4) for n in (0, 3, 4, 7, 8, 9)] == [[], [], [0], [0, 3], [0, 4], [0, 4, 5]]
