"""Language identification (operator 6): sparse multinomial logistic regression.

Features are hashed character n-grams (one to three letters, case folded, with a
blank for every other character), weighted by relative frequency times inverse
document frequency. Document frequencies are counted over every learnable
document. The weights are trained with follow-the-regularised-leader updates and
an elastic-net penalty on a sample of about ``SAMPLE`` labelled documents (whole
texts), and a softmax temperature is fitted on the part of the sample kept out
of training. Prediction is one map stage over all documents.

Only text and language of the learnable documents are learned from; neither
language, source nor id enters a prediction.

Defined results: a null text, or one without letters, is ``und`` with score 0;
rows with null language are predicted but not learned from; repeated rows are
predicted each; a null ``doc_id`` stays null and is not learned from. With
nothing to learn from, everything is ``und``. An empty table gives an empty
table. The number of different languages is assumed to be in the hundreds at
most: the model has ``FEATURES`` x languages weights.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldreports.llm.ftrl import Ftrl, softmax, temperature
from fieldreports.llm.words import mix

FEATURES = 1 << 16
SAMPLE = 6000
EPOCHS = 2
RATE, L1, L2 = 0.5, 0.02, 0.02
SCALE = 40.0  # relative frequencies are small; brings typical scores to about one
CALIBRATION_SHARE = 5  # every fifth sampled document calibrates
CHUNK_CHARS = 1 << 19
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    """Letter table over all code points."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature of every n-gram occurrence, first occurrence of each text and the end)."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer("\0".join(low).encode("utf-32-le", "surrogatepass") + b"\0\0\0\0" * 3, dtype="<u4").copy()
    ends = np.cumsum([len(t) + 1 for t in low]) - 1
    letter = _letters()[codes]
    codes[~letter] = 32
    codes[ends], codes[-3:] = 0, 0  # no n-gram reaches over the end of its text
    n = len(codes) - 3
    c = codes.astype(np.uint64)
    one, two, three = c[:n], c[1 : n + 1], c[2 : n + 2]
    pair = one | two << np.uint64(21)
    triple = pair | three << np.uint64(42)
    good1 = letter[:n] & (one > 0)
    good2 = (one > 0) & (two > 0) & (letter[:n] | letter[1 : n + 1])
    good3 = good2 & (three > 0) & letter[1 : n + 1]
    key = np.stack([one, pair, triple], axis=1)
    keep = np.stack([good1, good2, good3], axis=1)
    feature = (mix(key[keep]) >> np.uint64(48)).astype(np.int64)
    upto = np.concatenate(([0], np.cumsum(keep.sum(axis=1))))
    starts = np.concatenate(([0], ends + 1))
    return feature, upto[np.minimum(starts, n)]


def _chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK_CHARS:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def bucket(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def document_frequency(rows: DataFrame) -> np.ndarray:
    """Documents that hold each feature, over all rows (text); at most FEATURES sums reach the driver."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            df = np.zeros(FEATURES, dtype=np.int64)
            for _, texts in _chunks([t or "" for t in frame["text"]]):
                feature, at = grams(texts)
                for i in range(len(texts)):
                    seen = np.zeros(FEATURES, dtype=bool)
                    seen[feature[at[i] : at[i + 1]]] = True
                    df += seen
            some = np.flatnonzero(df)
            yield pd.DataFrame({"feature": some, "df": df[some]})

    counts = rows.select("text").mapInPandas(run, "feature long, df long").groupBy("feature").agg(F.sum("df").alias("df"))
    out = np.zeros(FEATURES)
    for r in counts.toLocalIterator():
        out[r["feature"]] = r["df"]
    return out


def _vector(feature: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, count = np.unique(feature, return_counts=True)
    return at, SCALE * count / max(len(feature), 1) * idf[at]


def fit(texts: list[str], langs: list[str], idf: np.ndarray, order: list[int]) -> dict:
    """Train on (text, language) pairs; ``order`` fixes the sequence and the calibration part."""
    classes = sorted(set(langs))
    index = {c: i for i, c in enumerate(classes)}
    rank = np.argsort(order, kind="stable")
    vectors = []
    for _, part in _chunks(texts):
        feature, at = grams(part)
        vectors += [_vector(feature[at[i] : at[i + 1]], idf) for i in range(len(part))]
    model = Ftrl(FEATURES, len(classes), rate=RATE, l1=L1, l2=L2)
    held = [k for n, k in enumerate(rank) if n % CALIBRATION_SHARE == 0]
    train = [k for n, k in enumerate(rank) if n % CALIBRATION_SHARE]
    for _ in range(EPOCHS):
        for k in train:
            at, value = vectors[k]
            if len(at):
                error = softmax(value @ model.weights(at))
                error[index[langs[k]]] -= 1.0
                model.learn(at, value, error)
    w = model.weights()
    held = [k for k in held if len(vectors[k][0])]
    scores = np.array([vectors[k][1] @ w[vectors[k][0]] for k in held]).reshape(len(held), len(classes))
    t = temperature(scores, np.array([index[langs[k]] for k in held], dtype=np.int64))
    return {"classes": classes, "weights": (w * idf[:, None] * SCALE / t).astype(np.float32)}


def predict(model: dict | None, texts: list[str]) -> tuple[list[str], list[float]]:
    labels, scores = [], []
    for _, part in _chunks(texts):
        feature, at = grams(part)
        total = np.diff(at)
        if model is None:
            labels += [UNKNOWN] * len(part)
            scores += [0.0] * len(part)
            continue
        sums = np.zeros((len(part), len(model["classes"])))
        for k in range(sums.shape[1]):
            running = np.concatenate(([0.0], np.cumsum(model["weights"][feature, k], dtype=np.float64)))
            sums[:, k] = running[at[1:]] - running[at[:-1]]
        p = softmax(sums / np.maximum(total, 1)[:, None])
        best = p.argmax(axis=1)
        labels += [model["classes"][b] if n else UNKNOWN for b, n in zip(best, total)]
        scores += [float(x) if n else 0.0 for x, n in zip(p.max(axis=1), total)]
    return labels, scores


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict | None:
    """The model learned from ``docs`` (all of it learnable), or None without labelled rows."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    total = rows.count()
    if not total:
        return None
    df = document_frequency(rows)
    idf = np.log((1.0 + total) / (1.0 + df)) + 1.0
    # a hash threshold draws about SAMPLE rows whatever the table's size
    h = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 62) - 1))
    sample = rows.where(h <= F.lit(int(min(1.0, SAMPLE / total) * ((1 << 62) - 1)))).withColumn("h", h)

    def train(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(frames), ignore_index=True).sort_values(["h", "doc_id"], kind="stable")
        model = fit([t or "" for t in got["text"]], list(got["lang"]), idf, list(range(len(got)))) if len(got) else None
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    # one bounded group in one task; one row (the model) comes back
    found = sample.repartition(1).mapInPandas(train, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None


def identify(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores = predict(shared.value, [t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_report(docs: DataFrame) -> DataFrame:
    """Learn from the documents whose id's crc32 is not 0 modulo 5, predict all."""
    model = learn(docs.where(bucket("doc_id", 5) != 0))
    return identify(docs, model).select(
        "doc_id", F.coalesce(bucket("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
