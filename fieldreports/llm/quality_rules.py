"""Quality rules by compression bands (operator 8).

Text that says little compresses too well, text that says nothing (random
bytes, encoded blobs) does not compress at all. Each document is compressed
with zstandard as a whole and in chunks; both ratios (compressed bytes / UTF-8 bytes)
must lie in a band that depends on the length, because a short text carries more
frame overhead and gives the compressor less to reuse. The chunks cover the whole
text: the last one ends where the text ends and overlaps the one before. Texts of
less than two large chunks are cut into small ones; a text below a small chunk is
judged as a whole only.

One pass, no shuffle: a row needs only its own text.

Defined results: a null or empty text has no words, so every count is 0 and it
fails the base rules (fewer than ten words). A null ``doc_id`` stays null.
Repeated rows are judged each on its own. An empty table gives an empty table.
Very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from fieldreports.llm.words import (
    NON_SPACE, Texts, byte_class, chunks, covered, hash_words, inside_text, mix, per_text, split_words, texts_of,
    window_hashes,
)

# (bytes below this, least ratio, greatest ratio); the last entry holds beyond.
WHOLE_BANDS = (
    (128, 0.45, 2.00),
    (256, 0.40, 1.20),
    (1 << 9, 0.36, 0.82),  # base64 text: 0.84 and more
    (1 << 10, 0.34, 0.76),  # 0.79 and more
    (1 << 12, 0.28, 0.74),  # base64 text stays near 0.77 at any length, prose falls
    (1 << 16, 0.24, 0.72),
    (None, 0.18, 0.72),
)
# (texts of bytes below this, chunk, least ratio, greatest ratio); the last entry holds beyond.
CHUNKS = ((1 << 12, 512, 0.25, 0.78), (None, 2048, 0.20, 0.62))
# A document may hold a table or a blob: it goes only when more than this share
# of its chunks lies outside the band.
CHUNK_SHARE = 0.2
LEVEL = 3
MIN_WORDS = 10
REPEAT_WINDOW = 5
REPEAT_PERCENT = 20

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_CONTINUATION = byte_class((0x80, 0xBF))

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, chunks long, chunks_outside long"
)


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """The base counts of each text (see the schema)."""
    words = split_words(texts)
    raw = texts.raw
    chars = NON_SPACE[raw] & ~_CONTINUATION[raw]
    h = hash_words(words)
    win, ok = window_hashes(h, REPEAT_WINDOW), inside_text(words, REPEAT_WINDOW)
    owner = words.owner()[: len(win)].astype(np.uint64)
    at = np.flatnonzero(ok)
    # the same window in two texts must not count as a repeat
    key = mix(win[at] ^ mix(owner[at] + np.uint64(1)))
    _, group, size = np.unique(key, return_inverse=True, return_counts=True)
    repeat = covered(len(words), at[size[group] > 1], REPEAT_WINDOW)
    n_words, n_repeat = words.counts(), per_text(repeat, words.at)
    return {
        "n_words": n_words,
        "word_chars": per_text(chars, texts.off),
        "n_symbols": per_text(_SYMBOLS[raw], texts.off),
        "n_dup_lines": np.array([_dup_lines(texts, i) for i in range(len(texts))], dtype=np.int64),
        "n_repeat_words": n_repeat,
        "base_failed": (n_words < MIN_WORDS) | (100 * n_repeat > REPEAT_PERCENT * n_words),
    }


def _dup_lines(texts: Texts, i: int) -> int:
    lines = [x for x in texts.raw[texts.off[i] : texts.off[i + 1]].tobytes().split(b"\n") if x.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def chunk_starts(n: int, chunk: int) -> list[int]:
    """Starts of the chunks of a text of ``n`` bytes; the last one ends with the text."""
    starts = list(range(0, n - chunk + 1, chunk))
    return starts + [n - chunk] if starts and n % chunk else starts


def bands(texts: Texts) -> dict[str, np.ndarray]:
    """Whole-text ratio, chunks, chunks outside their band, and the verdict."""
    packer = zstandard.ZstdCompressor(level=LEVEL)
    n = len(texts)
    ratio, total, outside, good = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    for i in range(n):
        text = texts.raw[texts.off[i] : texts.off[i + 1]].tobytes()
        if not text:
            continue
        ratio[i] = len(packer.compress(text)) / len(text)
        size, least, most = next((c, lo, hi) for below, c, lo, hi in CHUNKS if below is None or len(text) < below)
        for at in chunk_starts(len(text), size):
            total[i] += 1
            part = len(packer.compress(text[at : at + size])) / size
            outside[i] += not least <= part <= most
        lo, hi = next((lo, hi) for below, lo, hi in WHOLE_BANDS if below is None or len(text) < below)
        good[i] = lo <= ratio[i] <= hi and outside[i] <= CHUNK_SHARE * total[i]
    return {"ratio": ratio, "chunks": total, "chunks_outside": outside, "good": good}


def judge(column: pa.Array) -> dict[str, np.ndarray]:
    """All measures of a column of texts, and ``kept``."""
    parts = [base_counts(c) | bands(c) for _, _, c in chunks(texts_of(column))]
    if not parts:
        parts = [base_counts(Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))) | bands(Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64)))]
    out = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    out["kept"] = ~out["base_failed"] & out.pop("good")
    return out


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` with the base counts, the ratios and the verdict."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "chunks", "chunks_outside")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = judge(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(found[n]) for n in names)], names=["doc_id", *names]
            )

    return docs.select(id_col, text_col).mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns unchanged."""
    columns: Sequence[str] = docs.columns
    at = columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(judge(batch.column(at))["kept"]))

    return docs.mapInArrow(run, docs.schema)
