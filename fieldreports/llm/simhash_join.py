"""Near duplicates by SimHash fingerprints, found by pigeonring filtering (operator 12).

A fingerprint bit is set where more than half of the hashes (XXH64, seed 42) of a
text's ``SHINGLE``-word shingles have it set. Texts whose fingerprints differ in at
most ``RADIUS`` bits are linked; the links' connected components are the groups.

The 64 bits form a ring of ``SEGMENTS`` = 2 * RADIUS + 1 segments. If two fingerprints
differ in at most RADIUS bits, then from some segment on every chain of ``l``
consecutive segments differs in at most ``l * RADIUS / SEGMENTS`` bits (rounded down:
0, 0, 1, 1, 2, 2, 3, 3, 4). So:

1. Equal fingerprints are one node; only different ones are compared.
2. For each start, the first ``CHAIN`` = 4 segments are the join key: the first two
   must be equal, the other two may differ in one bit. A fingerprint is stored
   under its own key and probes the keys that have one bit more set there.
3. Pairs under one key must keep the budgets of the longer chains, one segment after
   the other; the chain of all segments is the full Hamming check.

Keys are counted first (partial counts) and only keys with a pair go on. Groups of more
than ``TILE`` rows are dealt into tiles of ``TILE`` x ``TILE``. Pairs exist only as index
arrays inside a task, which returns for each node one row towards its component there, so
a family of near copies never becomes a table of all its pairs and no link is lost.

Defined results: a null or empty text, or one of white space only, has the fingerprint
zero and is linked like any other; a text of fewer than ``SHINGLE`` words is one shingle;
a row with a null ``doc_id`` has a fingerprint, a null component and no links; rows with
the same id are one document (in one component); an empty table gives an empty table.
Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldreports.llm.components import components
from fieldreports.llm.shared import dealt_anew, stored
from fieldreports.llm.words import NON_SPACE, Texts, chunks, joined, split_words, texts_of

SHINGLE = 4
HASH_SEED = 42
RADIUS = 4
SEGMENTS = 2 * RADIUS + 1
CHAIN = 4
EDGES = np.arange(SEGMENTS + 1) * 64 // SEGMENTS
TILE = 2048
HASH_BLOCK = 1 << 16
PAIR_BATCH = 1 << 20
_U = np.uint64


# -- fingerprints -----------------------------------------------------------------

def fingerprints(texts: Texts) -> np.ndarray:
    words = split_words(texts, NON_SPACE, lower=True)
    text, start, end = joined(words)
    n = words.counts()
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, n > 0)
    owner = np.repeat(np.arange(len(n)), count)
    first = words.at[:-1][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    last = first + np.minimum(n, SHINGLE)[owner] - 1
    ones = np.zeros((len(n), 64), dtype=np.int64)
    for lo in range(0, len(owner), HASH_BLOCK):
        part = slice(lo, lo + HASH_BLOCK)
        spans = zip(start[first[part]].tolist(), end[last[part]].tolist())
        h = np.fromiter((xxhash.xxh64_intdigest(text[s:e], HASH_SEED) for s, e in spans), np.uint64, len(owner[part]))
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        docs, begin = np.unique(owner[part], return_index=True)
        ones[docs] += np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > count[:, None], axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def fingerprint_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [fingerprints(texts) for _, _, texts in chunks(texts_of(batch.column(1)))]
            found = np.concatenate(parts) if parts else np.zeros(0, _U)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


# -- chains -----------------------------------------------------------------------

def turned(x: np.ndarray, by: np.ndarray | int) -> np.ndarray:
    """``x`` rotated right: bit ``by`` becomes bit 0."""
    by = np.asarray(by, dtype=np.uint64)
    return (x >> by) | (x << ((_U(64) - by) & _U(63)))


def widths(start: int) -> np.ndarray:
    """Bits of the chains of 1 to SEGMENTS segments from ``start`` on, around the ring."""
    size = np.diff(EDGES)
    return np.cumsum(np.roll(size, -start))


BUDGETS = np.arange(1, SEGMENTS + 1) * RADIUS // SEGMENTS
WIDTHS = np.stack([widths(i) for i in range(SEGMENTS)])
# Segments at the head of a chain that must be equal.
EXACT = int((BUDGETS == 0).sum())


def chain_keys(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, probe, row of ``x``) of all chains; the start is in the bits above the chain's."""
    keys, probes, rows = [], [], []
    every = np.arange(len(x))
    for i in range(SEGMENTS):
        equal, width = int(WIDTHS[i, EXACT - 1]), int(WIDTHS[i, CHAIN - 1])
        own = (turned(x, EDGES[i]) & _U((1 << width) - 1)) | _U(i << 40)
        keys.append(own)
        probes.append(np.zeros(len(x), dtype=bool))
        rows.append(every)
        for bit in range(equal, width):
            some = np.flatnonzero((own >> _U(bit)) & _U(1) == 0)
            keys.append(own[some] | _U(1 << bit))
            probes.append(np.ones(len(some), dtype=bool))
            rows.append(some)
    return np.concatenate(keys), np.concatenate(probes), np.concatenate(rows)


def key_rows(nodes: DataFrame) -> DataFrame:
    """(key, probe, fp) of all chains of the fingerprints ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(0).to_numpy().view(np.uint64)
            for lo in range(0, len(whole), 4096):
                x = whole[lo : lo + 4096]
                key, probe, row = chain_keys(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(probe), pa.array(x[row].view(np.int64))], names=["key", "probe", "fp"])

    return nodes.select("fp").mapInArrow(run, "key long, probe boolean, fp long")


def close(difference: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Positions of the differences whose chains from ``start`` on keep every budget."""
    ok = np.arange(len(difference))
    ring = turned(difference, EDGES[start])
    for length in range(CHAIN, SEGMENTS + 1):
        width = WIDTHS[start[ok], length - 1].astype(np.uint64)
        chain = ring[ok] & (~_U(0) >> (_U(64) - width))
        ok = ok[np.bitwise_count(chain) <= BUDGETS[length - 1]]
    return ok


# -- groups -----------------------------------------------------------------------

def row_pairs(first: np.ndarray, split: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (a, b) of the runs [first, last) with a < b and a < split, at most PAIR_BATCH or one row's at a time."""
    n = split - first
    a = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    width = np.repeat(last, n) - a - 1
    total = np.cumsum(width)
    at = 0
    while at < len(a):
        before = total[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(total, before + PAIR_BATCH, side="right")))
        w = width[at:upto]
        x = np.repeat(a[at:upto], w)
        yield x, x + 1 + np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        at = upto


def leaders(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0 .. n-1 with links (a, b), the smallest node of each one's component."""
    lead = np.arange(n)
    while True:
        least = np.minimum(lead[a], lead[b])
        new = lead.copy()
        np.minimum.at(new, lead[a], least)
        np.minimum.at(new, lead[b], least)
        new = new[new]
        if (new == lead).all():
            return lead
        lead = new


def group_links(rows: DataFrame) -> DataFrame:
    """(a, b) rows that connect the linked fingerprints of rows (key, i, j, probe, block, fp) sorted by (key, i, j, probe)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            start = runs(held)
            if len(start) > 1:  # the last run may go on in the next batch
                yield links(held.slice(0, int(start[-1])))
                held = held.slice(int(start[-1]))
        if held is not None and held.num_rows:
            yield links(held)

    def runs(table: pa.Table) -> np.ndarray:
        key = np.stack([table.column(c).to_numpy() for c in (0, 1, 2)], axis=1)
        return np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1)))) if len(key) else np.zeros(0, np.int64)

    def links(table: pa.Table) -> pa.RecordBatch:
        key, i, j, probe, block, fp = (table.column(c).to_numpy() for c in range(6))
        first = runs(table)
        split = first + np.add.reduceat((~probe).astype(np.int64), first)
        start, code = (key >> 40).astype(np.int64), fp.view(np.uint64)
        ends = [(np.zeros(0, np.int64),) * 2]
        for a, b in row_pairs(first, split, np.append(first[1:], len(key))):
            cross = (i[a] == j[a]) | (block[a] != block[b])  # a tile of two blocks pairs one with the other
            a, b = a[cross], b[cross]
            ok = close(code[a] ^ code[b], start[a])
            ends.append((a[ok], b[ok]))
        a, b = (np.concatenate(x) for x in zip(*ends))
        names, number = np.unique(fp, return_inverse=True)
        lead = leaders(number[a], number[b], len(names))
        moved = np.flatnonzero(lead != np.arange(len(names)))
        return pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[lead[moved]])], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def fingerprint_links(nodes: DataFrame) -> DataFrame:
    """(a, b) rows that connect all fingerprints of ``nodes`` (fp, distinct) within RADIUS bits of each other."""
    rows = key_rows(dealt_anew(nodes))  # a fingerprint has some seventy rows: many tasks make them
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.bool_and("probe").alias("only_probes"))
    pairs = counts.where((F.col("members") > 1) & ~F.col("only_probes")).select("key", "members")
    live = stored(rows.join(dealt_anew(pairs), "key"))
    blocks = F.ceil(F.col("members") / TILE).cast("int")
    placed = live.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "probe", "block", "fp")
    return group_links(tiles.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "probe")).distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    rows = stored(fingerprint_table(docs, id_col, text_col))
    known = rows.where(F.col("doc_id").isNotNull())
    nodes = stored(known.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    # an id with several texts links their fingerprints
    several = known.groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low < high")
    same = known.join(several, "doc_id").where("fp > low").select(F.col("low").alias("a"), F.col("fp").alias("b"))
    groups = stored(components(fingerprint_links(nodes).unionByName(same)))
    rooted = nodes.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    named = stored(rooted.join(dealt_anew(first), "root").select(F.col("fp").alias("code"), "component"))
    return rows.join(named, F.col("fp") == F.col("code"), "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))
