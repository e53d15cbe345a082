"""Importance resampling towards a target distribution (operator 11).

Features of a text are its runs of 1 to ``max_n`` words, hashed into ``buckets``
buckets. A document weighs the sum of its features' gains: how much likelier the
feature's bucket is in the target texts than in the documents. Seeded Gumbel noise on
top of the weight and a cut at the greatest scores draw a share of the documents
without replacement, in proportion to their weights.

1. Bucket counts of both sides: every task counts into one array of fixed size, the
   arrays are summed by bucket.
2. Scoring: the gains are an array of ``buckets`` numbers that every task holds; a
   document's weight is a sum of look-ups. The scores are written once.
3. The cut: exact counts over the written scores narrow a numeric threshold, a few
   binary digits (``HALVINGS``) a job, until the score of the last drawn document is
   known; the same over its doc_id among ties, then over the row among equal ids.
   No sort of all documents, and nothing but the counts reaches the driver.
4. Ranks: only the drawn rows are range-partitioned and sorted; a rank is the place
   in its partition plus the rows of the earlier partitions.

Bounded by a parameter: ``buckets`` counts and gains (two numbers each) on the driver
and in every task.

Defined results: a null or empty text has no features and weight 0; rows with a null
``doc_id`` count as text but have no score and are never drawn; rows with the same id
are drawn separately (the same row may be drawn twice, in an undefined order between
equal rows); no documents of ``least_words`` words, or a share that comes to none,
draw nothing; an empty target has only zero counts; an empty table gives an empty
table. Only the id and text columns are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldreports.llm.shared import stored
from fieldreports.llm.words import ALNUM, Texts, chunks, joined, split_words, texts_of

BUCKETS = 10_000
MAX_N = 1
LEAST_WORDS = 20
SHARE_PERCENT = 10
SEED = "2024"
# Binary digits of the threshold that one counting job settles.
HALVINGS = 8
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row number below


def features(texts: Texts, max_n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every feature, and the words of every text."""
    words = split_words(texts, ALNUM, lower=True)
    text, start, end = joined(words)
    owner, found, whose = words.owner(), [], []
    for n in range(1, max_n + 1):
        last = len(words) - n + 1
        if last <= 0:
            break
        at = np.flatnonzero(owner[:last] == owner[n - 1 :])
        spans = zip(start[at].tolist(), end[at + n - 1].tolist())
        found.append(np.fromiter((zlib.crc32(text[s:e]) for s, e in spans), np.int64, len(at)) % buckets)
        whose.append(owner[at])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), words.counts()
    return np.concatenate(found), np.concatenate(whose), words.counts()


def bucket_counts(docs: DataFrame, text_col: str, max_n: int, buckets: int) -> DataFrame:
    """(bucket, n): features of all texts by bucket; buckets without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, texts in chunks(texts_of(batch.column(0))):
                total += np.bincount(features(texts, max_n, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    return docs.select(text_col).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text_col: str, target_text: str, max_n: int, buckets: int) -> np.ndarray:
    """Per bucket floor(1000 ln(share in the target / share in the documents)), both counts plus one."""
    ours = bucket_counts(docs, text_col, max_n, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).alias("t"))
    theirs = bucket_counts(target, target_text, max_n, buckets).select("bucket", F.lit(0).alias("s"), F.col("n").alias("t"))
    counts = np.zeros((2, buckets), dtype=np.int64)
    for row in ours.unionByName(theirs).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect():
        counts[:, row["bucket"]] = row["s"], row["t"]
    all_s, all_t = (float(x) for x in counts.sum(axis=1))
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * (all_s + buckets) / ((s + 1.0) * (all_t + buckets)))) for s, t in counts.T.tolist()
    ], dtype=np.int64)


def weights(docs: DataFrame, gains: np.ndarray, id_col: str, text_col: str, max_n: int) -> DataFrame:
    """doc_id, n_words, n_features, weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.zeros((3, 0), dtype=np.int64)]
            for lo, hi, texts in chunks(texts_of(batch.column(1))):
                bucket, owner, n_words = features(texts, max_n, len(gains))
                sums = np.zeros(hi - lo, dtype=np.int64)
                np.add.at(sums, owner, gains[bucket])
                parts.append(np.stack([n_words, np.bincount(owner, minlength=hi - lo), sums]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x) for x in np.concatenate(parts, axis=1)]],
                names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: str, doc_id: str = "doc_id") -> Column:
    """floor(1000 times a standard Gumbel value) that the seed and the id decide."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(doc_id).cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(float(1 << 32)))))


# -- the cut ----------------------------------------------------------------------

def kth_smallest(rows: DataFrame, column: str, k: int) -> tuple[int, int, int]:
    """The k-th smallest value of a long column, the rows below it and the rows that have it.

    Each job counts the rows that share the binary digits found so far by the next
    ``HALVINGS`` digits. ``rows`` holds at least ``k`` rows.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()
    digits = (low ^ high).bit_length() if (low < 0) == (high < 0) else 64
    prefix, below, same = low >> digits, 0, 0
    if digits == 0:
        return low, 0, rows.count()
    while digits:
        shared = rows if digits == 64 else rows.where(F.shiftright(column, digits) == prefix)
        digits -= min(HALVINGS, digits)
        found = shared.groupBy(F.shiftright(column, digits).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
        for prefix, same in sorted((r["part"], r["n"]) for r in found):
            if below + same >= k:
                break
            below += same
    return prefix, below, same


def first_k(rows: DataFrame, order: Sequence[str], k: int) -> Column:
    """Whether a row is among the first ``k`` by the long columns ``order``."""
    if k <= 0:
        return F.lit(False)
    bounds = []
    for column in order:
        value, below, same = kth_smallest(rows, column, k)
        bounds.append((column, value))
        k -= below
        if same == k:
            break
        rows = rows.where(F.col(column) == value)
    inside = F.lit(True)  # equal in every bound: the last drawn row, or ties that are all drawn
    for column, value in reversed(bounds):
        inside = (F.col(column) < value) | ((F.col(column) == value) & inside)
    return inside


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank``, their 1-based place by ``order``."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(dealt.withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", _ROW_BITS).alias("part")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    local = F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.withColumn("part", part).join(offsets, "part").withColumn(
        "rank", (local + F.col("offset") + 1).cast("long")).drop("part", "place", "offset")


def importance_sample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", *,
    max_n: int = MAX_N, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, share_percent: int = SHARE_PERCENT, seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_features, weight, score, and the rank of drawn rows (else null)."""
    gains = bucket_gains(docs, target, text_col, target_text, max_n, buckets)
    scored = weights(docs, gains, id_col, text_col, max_n).withColumn("score", (F.col("weight") + noise(seed)).cast("long"))
    scored = stored(scored.withColumns({"fall": -F.col("score"), "row": F.monotonically_increasing_id()}))
    open_ones = scored.where((F.col("n_words") >= least_words) & F.col("doc_id").isNotNull())
    order = ["fall", "doc_id", "row"]
    drawn = F.coalesce(
        (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull() & first_k(open_ones, order, open_ones.count() * share_percent // 100),
        F.lit(False))
    out = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    rest = scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return ranked(scored.where(drawn), order).select(*out).unionByName(rest.select(*out))
