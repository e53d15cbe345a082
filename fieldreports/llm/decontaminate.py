"""Benchmark decontamination by winnowing (operator 3).

Every text is reduced to fingerprints: of each ``GUARANTEE - GRAM + 1``
consecutive k-grams the smallest hash. Two
texts that share ``GUARANTEE`` words therefore share a fingerprint. Document
fingerprints are joined with those of the benchmark, and each hit is extended:
the ten-word windows that the fingerprint stands for are joined with the windows
of the benchmark by a 128-bit hash.

The benchmark stays a distributed table of any size. What is broadcast is a table
of 2 ** ``FILTER_BITS`` bits (4 MB, however large the benchmark) of its fingerprints
and windows; a document window is sent to the joins only where both bits are set.
A benchmark with many more windows than bits lets more of them through, and the joins
still decide exactly. Documents pass through one map stage and leave it as one narrow
row each; equal texts meet the benchmark once. Fingerprints and windows of the
benchmark are distinct before the joins, so a passage that a third of the documents
holds fans nothing out, and Spark may split its rows.

Defined results: a null or empty document has no words and no hits; a null or
empty item has no window. Items with fewer than ten words are one window, its own
fingerprint. Repeated document rows are reported each; repeated items (same id) count
once; the windows of an item with a null id count as hits, but it is not listed. An
empty benchmark contaminates nothing, an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldreports.llm.shared import free_name, stored
from fieldreports.llm.words import ALNUM, Words, chunks, hash_words, inside_text, mix, split_words, texts_of, window_hashes

GUARANTEE = 10
GRAM = 5
FILTER_BITS = 25
_SECOND_BASE, _STEP = np.uint64(0xA24BAED4963EE407), np.uint64(0x9E3779B97F4A7C15)


def fingerprints(words: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows of ``GUARANTEE`` words, and the fingerprint (k-gram hash) of each."""
    grams, span = window_hashes(h, GRAM), GUARANTEE - GRAM + 1
    at = np.flatnonzero(inside_text(words, GUARANTEE))
    if not len(at):
        return at, np.zeros(0, dtype=np.uint64)
    least = grams[: len(grams) - span + 1].copy()
    for j in range(1, span):
        np.minimum(least, grams[j : j + len(least)], out=least)
    return at, least[at]


def windows(words: Words, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``size`` words, and their fingerprints."""
    if size == GUARANTEE:
        return fingerprints(words, h)
    at = np.flatnonzero(inside_text(words, size))
    return at, window_hashes(h, size)[at]


def window_names(h: np.ndarray, start: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the windows that begin at ``start``."""
    second = h[start]
    for j in range(1, size):
        second = second * _SECOND_BASE + h[start + j]
    return window_hashes(h, size)[start], mix(second)


def places(hashes: np.ndarray, kind: int, bits: int) -> np.ndarray:
    """Bit numbers of fingerprints (``kind`` = window size) or windows (``kind`` = size + ``GUARANTEE``)."""
    return (mix(hashes + np.uint64(kind) * _STEP) >> np.uint64(64 - bits)).astype(np.int64)


class BitTable:
    """Bits at the places of the benchmark's fingerprints and windows, and the window sizes it has."""

    def __init__(self, words: np.ndarray, sizes: list[int]):
        self.words, self.sizes, self.bits = words, sizes, len(words).bit_length() + 5

    def has(self, hashes: np.ndarray, kind: int) -> np.ndarray:
        at = places(hashes, kind, self.bits)
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per window of every item: size, print, w1, w2, item and the two bit numbers."""
    bits = FILTER_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, texts in chunks(texts_of(batch.column(1))):
                words = split_words(texts, ALNUM, lower=True)
                h, n = hash_words(words), words.counts()
                for size in sorted(set(np.minimum(n[n > 0], GUARANTEE).tolist())):
                    at, prints = windows(words, h, size)
                    owner = words.owner()[at]
                    own = np.minimum(n, GUARANTEE)[owner] == size
                    at, prints, owner = at[own], prints[own], owner[own]
                    w1, w2 = window_names(h, at, size)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), size, dtype=np.int32)), pa.array(prints.view(np.int64)), pa.array(w1.view(np.int64)),
                         pa.array(w2.view(np.int64)), batch.column(0).take(pa.array(owner + lo)),
                         pa.array(places(prints, size, bits)), pa.array(places(w1, size + GUARANTEE, bits))],
                        names=["size", "print", "w1", "w2", "item", "print_bit", "window_bit"],
                    )

    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text"))
    return items.mapInArrow(run, "size int, print long, w1 long, w2 long, item string, print_bit long, window_bit long")


def bit_table(found: DataFrame) -> BitTable:
    """The bit table of :func:`benchmark_windows`: at most 2 ** (FILTER_BITS - 6) words reach the driver."""
    words = found.select(F.explode(F.array("print_bit", "window_bit")).alias("bit")).groupBy(
        F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("set")).toArrow()
    table = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    table[words.column("word").to_numpy()] = words.column("set").to_numpy().view(np.uint64)
    sizes = found.select("size").distinct().toArrow()  # at most GUARANTEE of them
    return BitTable(table, sorted(sizes.column("size").to_pylist()))


_CANDIDATES = "array<struct<size:int,start:int,print:long,w1:long,w2:long>>"


def candidate_rows(texts: DataFrame, table: BitTable) -> DataFrame:
    """(doc_id, key, n_words, windows) of every row (doc_id, key, text): the windows that pass the bit table."""
    shared = texts.sparkSession.sparkContext.broadcast(table)
    kind = pa.struct([("size", pa.int32()), ("start", pa.int32()), ("print", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for lo, hi, part in chunks(texts_of(batch.column(2))):
                words = split_words(part, ALNUM, lower=True)
                h, found = hash_words(words), [np.zeros((0, 6), dtype=np.int64)]
                for size in table.sizes:
                    at, prints = windows(words, h, size)
                    some = table.has(prints, size)
                    at, prints = at[some], prints[some]
                    w1, w2 = window_names(h, at, size)
                    some = table.has(w1, size + GUARANTEE)
                    owner = words.owner()[at[some]]
                    found.append(np.stack([
                        owner, np.full(len(owner), size), at[some] - words.at[owner],
                        prints[some].view(np.int64), w1[some].view(np.int64), w2[some].view(np.int64)], axis=1))
                rows = np.concatenate(found)
                rows = rows[np.argsort(rows[:, 0], kind="stable")]
                values = pa.StructArray.from_arrays(
                    [pa.array(rows[:, 1].astype(np.int32)), pa.array(rows[:, 2].astype(np.int32)), *[pa.array(rows[:, c]) for c in (3, 4, 5)]],
                    fields=list(kind))
                first = np.searchsorted(rows[:, 0], np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(words.counts().astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(first), values)],
                    names=["doc_id", "key", "n_words", "windows"],
                )

    return texts.select("doc_id", "key", "text").mapInArrow(run, f"doc_id long, key binary, n_words long, windows {_CANDIDATES}")


def text_key(text_col: str):
    """A 128-bit name of a text; null for a null text."""
    return F.unhex(F.md5(F.col(text_col).cast("binary")))


def found_windows(rows: DataFrame, bench: DataFrame) -> DataFrame:
    """(key, start, size, w1, w2) of the windows of different texts that are windows of the benchmark."""
    prints = bench.select("size", "print").distinct()
    known = bench.select("size", "w1", "w2").distinct()
    texts = rows.where(F.size("windows") > 0).select("key", "windows").dropDuplicates(["key"])
    return texts.select("key", F.inline("windows")).join(prints, ["size", "print"], "left_semi").join(
        known, ["size", "w1", "w2"], "left_semi")


def merged_runs(spans: DataFrame) -> DataFrame:
    """(key, runs) of (key, spans): overlapping and touching spans (start, size) become runs [start, end]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for spans in batch.column(1):
                start, size = (np.asarray(spans.values.field(c), dtype=np.int64) for c in ("start", "size"))
                order = np.argsort(start, kind="stable")
                start, reach = start[order], np.maximum.accumulate((start + size)[order])
                head = np.concatenate(([0], np.flatnonzero(start[1:] > reach[:-1]) + 1))
                out.append(np.stack([start[head], reach[np.concatenate((head[1:] - 1, [len(start) - 1]))]], axis=1).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.list_(pa.int64())))], names=["key", "runs"])

    return spans.select("key", "spans").mapInArrow(run, "key binary, runs array<array<long>>")


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs ``[start, end]`` of hit words, sorted ids of the items found."""
    bench = stored(benchmark_windows(benchmark, item_col, item_text))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    rows = stored(candidate_rows(texts, bit_table(bench)))
    found = stored(found_windows(rows, bench))
    runs = merged_runs(found.groupBy("key").agg(F.collect_list(F.struct("start", "size")).alias("spans")))
    # windows of one passage mostly belong to the same items: such sets of items are named, not repeated
    owners = bench.groupBy("size", "w1", "w2").agg(F.array_sort(F.collect_set("item")).alias("own")).withColumn(
        "own_key", F.md5(F.to_json("own").cast("binary")))
    items = found.select("key", "size", "w1", "w2").join(owners.drop("own"), ["size", "w1", "w2"]).select("key", "own_key").distinct().join(
        owners.select("own_key", "own").dropDuplicates(["own_key"]), "own_key"
    ).groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("own")))).alias("items"))
    return rows.select("doc_id", "key", "n_words").join(runs, "key", "left").join(items, "key", "left").select(
        "doc_id", "n_words",
        F.coalesce("runs", F.array().cast("array<array<long>>")).alias("runs"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest columns: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    zero = F.lit(0).cast("long")
    return contamination(docs, benchmark).select(
        "doc_id", "n_words",
        F.aggregate("runs", zero, lambda n, run: n + run[1] - run[0]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark, all columns unchanged.

    The names of contaminated texts are written first, so that Spark knows their size and
    broadcasts them where that is small.
    """
    bench = stored(benchmark_windows(benchmark, item_col, item_text))
    texts = docs.select(F.lit(None).cast("long").alias("doc_id"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))
    rows = stored(candidate_rows(texts, bit_table(bench)).where(F.size("windows") > 0))
    gone = free_name("gone", docs.columns)
    bad = stored(found_windows(rows, bench).select(F.col("key").alias(gone)).distinct())
    return docs.join(bad, text_key(text_col) == F.col(gone), "left_anti")
