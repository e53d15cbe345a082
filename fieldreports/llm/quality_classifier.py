"""Quality classifier (operator 7): hashed word n-gram logistic regression.

Tokens are runs of letters and digits, and every other visible byte by itself, so
decoration and separators are words of their own; a token equal to the one
before it becomes a repeat mark. Features are hashed tokens and token pairs with
1 + ln(count), scaled to unit length. The weights are trained with
follow-the-regularised-leader updates on about ``SAMPLE`` labelled documents
(whole texts) and broadcast; scoring is a sparse dot product per document.

Labels, language, source and id never enter a score.

Defined results: a null or empty text has only the constant feature; a null
``doc_id`` stays null and is not learned from; null labels are not learned from;
repeated label rows count once, contradicting ones both; repeated documents are
scored each. Without labels every score is 0.5. An empty table gives an empty one.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldreports.llm.ftrl import Ftrl, sigmoid
from fieldreports.llm.language_id import bucket
from fieldreports.llm.words import (
    NON_SPACE, Texts, Words, byte_class, chunks, hash_words, inside_text, mix, texts_of, window_hashes,
)

FEATURES = 1 << 18
SAMPLE = 20_000
EPOCHS = 3
RATE, L1, L2 = 0.3, 0.01, 0.01
THRESHOLD = 0.7
_WORD = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_REPEAT = np.uint64(0x5265706561746564)


def tokens(texts: Texts) -> Words:
    """Runs of letters and digits, and single other visible bytes."""
    n = len(texts.raw)
    raw = np.zeros(n + 8, dtype=np.uint8)
    raw[:n] = texts.raw
    word, mark = _WORD[raw[:n]], NON_SPACE[raw[:n]] & ~_WORD[raw[:n]]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    full = texts.off[:-1] < texts.off[1:]
    heads, tails = texts.off[:-1][full], texts.off[1:][full] - 1
    first[heads], last[tails] = word[heads], word[tails]
    start, end = np.flatnonzero(first | mark), np.flatnonzero(last | mark) + 1
    return Words(raw, start, end, np.searchsorted(start, texts.off))


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, value, first feature of each text and the end); the constant comes with every text."""
    words = tokens(texts)
    h = hash_words(words, seed=7)
    owner = words.owner()
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    h[same] = _REPEAT
    pairs, ok = window_hashes(h, 2), inside_text(words, 2)
    shift = np.uint64(64 - FEATURES.bit_length() + 1)
    single = (mix(h) >> shift).astype(np.int64)
    double = (pairs[ok] >> shift).astype(np.int64)
    key = np.concatenate([owner * FEATURES + single, owner[: len(pairs)][ok] * FEATURES + double])
    key, count = np.unique(key, return_counts=True)
    doc, feature = key // FEATURES, key % FEATURES
    value = 1.0 + np.log(count)
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    norm = np.sqrt(np.concatenate(([0.0], np.cumsum(value * value))))
    length = np.sqrt(np.maximum(norm[at[1:]] ** 2 - norm[at[:-1]] ** 2, 1e-12))
    return feature, value / np.repeat(length, np.diff(at)), at


def fit(column: pa.Array, labels: np.ndarray) -> tuple[float, np.ndarray]:
    """(constant, weights) learned in the given order."""
    model, constant = Ftrl(FEATURES, 1, rate=RATE, l1=L1, l2=L2), Ftrl(1, 1, rate=RATE)
    zero, one = np.zeros(1, dtype=np.int64), np.ones(1)
    for _ in range(EPOCHS):
        for first, _, texts in chunks(texts_of(column)):
            feature, value, at = features(texts)
            for i in range(len(texts)):
                f, v = feature[at[i] : at[i + 1]], value[at[i] : at[i + 1]]
                error = sigmoid(v @ model.weights(f) + constant.weights(zero)[0]) - labels[first + i]
                model.learn(f, v, error)
                constant.learn(zero, one, error)
    return float(constant.weights()[0, 0]), model.weights()[:, 0].astype(np.float32)


def scores(model: tuple[float, np.ndarray] | None, column: pa.Array) -> np.ndarray:
    out = [np.zeros(0)]
    for _, _, texts in chunks(texts_of(column)):
        if model is None:
            out.append(np.full(len(texts), 0.5))
            continue
        feature, value, at = features(texts)
        running = np.concatenate(([0.0], np.cumsum(value * model[1][feature])))
        out.append(sigmoid(running[at[1:]] - running[at[:-1]] + model[0]))
    return np.concatenate(out)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"):
    """The model learned from ``labels`` (all of them learnable), or None without any."""
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    total = marked.count()
    if not total:
        return None
    # a hash threshold draws about SAMPLE label rows whatever the table's size
    h = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 62) - 1))
    drawn = marked.where(h <= F.lit(int(min(1.0, SAMPLE / total) * ((1 << 62) - 1)))).withColumn("h", h).distinct()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(drawn), "doc_id", "inner")  # about SAMPLE rows of 20 bytes

    def train(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(frames), ignore_index=True).sort_values(["h", "doc_id", "label"], kind="stable")
        column = pa.array([t or "" for t in got["text"]], type=pa.string())
        model = fit(column, got["label"].to_numpy(dtype=float)) if len(got) else None
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    # one bounded group in one task; one row (the model) comes back
    found = sample.repartition(1).mapInPandas(train, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores(shared.value, batch.column(1)))], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labels whose id's crc32 is not 2 modulo 4, score all documents."""
    model = learn(docs, labels.where(bucket("doc_id", 4) != 2))
    return score(docs, model).select(
        "doc_id", F.coalesce(bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
