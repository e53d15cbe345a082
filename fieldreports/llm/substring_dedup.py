"""Removal of passages that an earlier document already holds (operator 4).

Suffix trees partitioned by prefix. The suffixes of all texts are split into groups
by prefixes of variable length, each group small enough for a task's memory; a
group's subtree is built from its sorted suffixes, and its deep internal nodes are
the repeats.

1. Prefixes of five words, of one suffix in about five: every 13 consecutive words
   select their five-word prefix with the smallest hash, so equal windows of two
   documents select equal prefixes. Prefixes of a single document are leaves of the
   tree and end here; that is most of them. The occurrences of the others are counted.
2. A prefix of at most ``GROUP_ROWS`` occurrences is a group. A document sends it one
   stretch per occurrence: the words of all windows that select the prefix there (13
   to 21 words, 32 bits each), which hold up to nine suffixes of the tree. In the
   group all suffixes are sorted; neighbours that share 13 words or more lie below one
   internal node of that depth, and all suffixes of a node but those of its first
   document are repeats.
3. Suffixes below a prefix with more occurrences are split by longer prefixes, of 13
   words. Such a group is one node; its rows are sorted by document and streamed.

Deeper internal nodes lie below those of 13 words, so the union of their windows is
the union of all maximal repeats of 13 words or more: :func:`repeated_passages`
returns its stretches.

Tasks combine before the shuffle: of equal stretches in one buffer (windows in step
3) only the first document's is sent to the group, the others are known to be
repeats. A passage in a third of all documents thus reaches its group once per buffer.
Which prefixes are split is told by a bit table of fixed size: a bit that stands for a
second prefix too only makes that one's group split as well. The texts are exchanged
once, by id and packed with zstandard; both later reads share that exchange.

Prefixes of five words travel as 64 bits, of 13 words as 95 bits; the other words of
a stretch as 32 bits each, so two windows that differ in one word are taken as equal
in one of four billion cases, and more words make it rarer.

Defined results: a null or empty text has no words and keeps nothing; a document
of fewer than 13 words loses nothing; a null ``doc_id`` is no smaller or larger
than another, so such a row neither loses nor takes anything; rows with the same
id do not remove each other's words; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldreports.llm.words import (
    Texts, Words, chunks, covered, hash_words, inside_text, mix, split_words, texts_of, window_hashes,
)

WINDOW = 13
PREFIX = 5
# A group holds at most so many stretches: 2 MB of them, at most 50 MB while its subtree is built.
GROUP_ROWS = 16_384
# Bits of the table of prefixes that are split (at most 524,288 words of 16 bytes).
SPLIT_BITS = 25
# Equal prefixes are combined within this many bytes of text before the shuffle.
BUFFER_BYTES = 16 << 20
# Rows of one Arrow batch that a task returns.
BATCH_ROWS = 50_000
# All windows of a stretch.
ALL = (1 << (WINDOW - PREFIX + 1)) - 1
_U = np.uint64


def stretches(grams: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the selected prefixes, the first window that selects each, and how many
    (consecutive) windows do. The smallest hash is selected, the last of equals."""
    at, span = np.flatnonzero(whole), WINDOW - PREFIX + 1
    if not len(at):
        return at, at, at
    least, pick = grams[: len(grams) - span + 1].copy(), np.zeros(len(grams) - span + 1, dtype=np.int64)
    for j in range(1, span):
        other = grams[j : j + len(least)]
        lower = other <= least
        least[lower] = other[lower]
        pick[lower] = j
    chosen = at + pick[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = chosen[1:] != chosen[:-1]
    first = np.flatnonzero(new)
    return chosen[first], at[first], np.diff(np.append(first, len(at)))


def contents(windows: np.ndarray, at: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Hash of each stretch and of where its prefix is: its first and last window hold all its words."""
    shape = (n * 16 + (at - first)).astype(np.uint64)
    return mix(windows[first] ^ mix(windows[first + n - 1] + shape))


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before in any key."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = False
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def _in_ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions start[i] to start[i] + size[i] - 1 of all i."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


def _of(value: np.ndarray, whose: np.ndarray) -> np.ndarray:
    return mix(value ^ mix(whose.astype(np.uint64)))


def _listed(lists: pa.Array, value: np.ndarray, whose: np.ndarray) -> np.ndarray:
    """Whether the list of row ``whose[i]`` holds ``value[i]``."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    return np.isin(_of(value, whose), _of(flat, row))


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Texts, pa.RecordBatch, int, int]]:
    """Rows with an id, at most BUFFER_BYTES (or one longer text) at a time."""
    for batch in batches:
        batch = batch.filter(batch.column(0).is_valid())
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for lo, hi, texts in chunks(texts_of(batch.column(1)), BUFFER_BYTES):
            yield ids[lo:hi], texts, batch, lo, hi


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, packed text); the text is compressed for the exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3, write_checksum=False)
        for batch in batches:
            texts = texts_of(batch.column(1))
            small = [packer.compress(texts.raw[a:b].tobytes()) for a, b in zip(texts.off[:-1], texts.off[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(small, pa.binary())], names=["doc_id", "packed"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, packed binary")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts again in the second column, at most BUFFER_BYTES (or one text) per batch."""
    reader = zstandard.ZstdDecompressor()
    for batch in batches:
        small, first, size = batch.column(1).to_pylist(), 0, 0
        sizes = [zstandard.frame_content_size(x) for x in small]
        for i in range(len(small) + 1):
            if i == len(small) or (i > first and size + sizes[i] > BUFFER_BYTES):
                if i > first:
                    part = batch.slice(first, i - first)
                    texts = pa.array([reader.decompress(x) if n else b"" for x, n in zip(small[first:i], sizes[first:i])], pa.large_binary())
                    columns = list(part.columns)
                    columns[1] = texts.cast(pa.large_string())
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", *part.schema.names[2:]])
                first, size = i, 0
            if i < len(small):
                size += sizes[i]


def prefix_rows(docs: DataFrame) -> DataFrame:
    """Selected prefixes: (route, doc, n occurrences) to be grouped by route, or (random route,
    doc, known) where the prefix is known to be shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, buffer, _, _, _ in _buffers(batches):
            keys, owners = [], []
            for lo, _, texts in chunks(buffer):
                words = split_words(texts)
                grams = window_hashes(hash_words(words), PREFIX)
                at, _, _ = stretches(grams, inside_text(words, WINDOW))
                keys.append(grams[at])
                owners.append(ids[lo + words.owner()[at]])
            if not keys:
                continue
            key, doc = np.concatenate(keys), np.concatenate(owners)
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            n = np.diff(np.append(np.flatnonzero(_changes(key)), len(key)))
            new = _changes(key, doc)
            key, doc = key[new], doc[new]
            first = _changes(key)
            # a key of several documents: all of them are known to share it
            several = np.zeros(len(key), dtype=bool)
            several[1:] = ~first[1:]
            several[:-1] |= ~first[1:]
            route = np.concatenate([key[first], _of(key[several], doc[several])])
            grouped = np.arange(len(route)) < len(n)
            known = np.concatenate([key[first], key[several]]).view(np.int64)
            counts = np.concatenate([n, np.zeros(len(route) - len(n), dtype=n.dtype)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(route.view(np.int64)), pa.array(np.concatenate([doc[first], doc[several]])),
                 pa.array(known, mask=grouped), pa.array(counts, mask=~grouped)],
                names=["route", "doc", "known", "n"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "route long, doc long, known long, n int")


def shared_prefixes(docs: DataFrame) -> DataFrame:
    """(doc, small, large): the prefixes of each document that others have too, those that are a
    group as they are and those whose suffixes are split by longer prefixes."""
    # read twice; both times all columns, so that Spark exchanges the rows once
    rows = prefix_rows(docs).repartition("route")
    group = Window.partitionBy("route")
    shared = rows.withColumns({"low": F.min("doc").over(group), "high": F.max("doc").over(group)}).where(
        "low < high AND n > 0 OR known IS NOT NULL").select("doc", F.coalesce("known", "route").alias("prefix"))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << SPLIT_BITS))
    large = rows.groupBy("route").agg(
        F.sum("n").alias("n"), F.max("doc").alias("doc"), F.count("known").alias("known"), F.max(place("route")).alias("place"),
    ).where((F.col("n") > GROUP_ROWS) & F.col("doc").isNotNull() & (F.col("known") == 0))
    table = large.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("bits"))
    marked = shared.withColumn("place", place("prefix")).join(
        F.broadcast(table), F.shiftright("place", 6) == F.col("word"), "left")
    split = F.coalesce(F.expr("shiftrightunsigned(bits, CAST(place & 63 AS INT)) & 1 = 1"), F.lit(False))
    return marked.groupBy("doc").agg(
        F.collect_list(F.when(~split, F.col("prefix"))).alias("small"), F.collect_list(F.when(split, F.col("prefix"))).alias("large"))


_ROWS = "route long, check int, doc long, id long, codes binary"


def _batches(route, check, doc, ids=None, codes=None, start=None, size=None) -> Iterator[pa.RecordBatch]:
    """Rows of ``_ROWS``; the codes of row i are ``codes[start[i]:start[i] + size[i]]``."""
    for lo in range(0, len(route), BATCH_ROWS):
        some = slice(lo, lo + BATCH_ROWS)
        n = len(route[some])
        if codes is None:
            packed_codes = pa.nulls(n, pa.binary())
        else:
            ends = np.concatenate(([0], np.cumsum(size[some]) * 4)).astype(np.int32)
            flat = codes[_in_ranges(start[some], size[some])]
            packed_codes = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(flat)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(route[some].view(np.int64)), pa.array(check[some].astype(np.int32)), pa.array(doc[some]),
             pa.nulls(n, pa.int64()) if ids is None else pa.array(ids[some].view(np.int64)), packed_codes],
            names=["route", "check", "doc", "id", "codes"])


def suffix_rows(joined: DataFrame) -> DataFrame:
    """The suffixes below the shared prefixes of (doc_id, packed, small, large), as rows of three kinds:

    * a stretch (route: its prefix, check: where the prefix is in it, id: its content, codes: its words);
    * a window of 13 words as a prefix of its own (route, check: its hash; neither id nor codes);
    * a known repeat (random route, id: the content and check: ``ALL``, or id: the window and check: 0).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _unpacked(b.filter(b.column(2).is_valid()) for b in batches):
            for ids, buffer, part, first_row, _ in _buffers(iter([batch])):
                found, codes, length, nodes = [], [], 0, []
                for lo, hi, texts in chunks(buffer):
                    words = split_words(texts)
                    h, owner = hash_words(words), words.owner()
                    grams, windows = window_hashes(h, PREFIX), window_hashes(h, WINDOW)
                    at, first, n = stretches(grams, inside_text(words, WINDOW))
                    rows = slice(first_row + lo, first_row + hi)
                    small = _listed(part.column(2)[rows], grams[at], owner[at])
                    s_at, s_first, s_n = at[small], first[small], n[small]
                    found.append((grams[s_at], contents(windows, s_at, s_first, s_n), ids[lo + owner[s_at]],
                                  s_at - s_first, s_first + length, s_n + WINDOW - 1))
                    codes.append((h >> _U(32)).astype(np.uint32))
                    length += len(h)
                    large = _listed(part.column(3)[rows], grams[at], owner[at])
                    near = _in_ranges(first[large], n[large])
                    nodes.append((windows[near], (window_hashes(mix(h), WINDOW)[near] >> _U(33)) if len(near) else near.astype(np.uint64),
                                  ids[lo + owner[near]]))
                if not found:
                    continue
                yield from _stretch_batches(*(np.concatenate(c) for c in zip(*found)), np.concatenate(codes))
                yield from _node_batches(*(np.concatenate(c) for c in zip(*nodes)))

    return joined.mapInArrow(run, _ROWS)


def _stretch_batches(route, content, doc, offset, start, size, codes) -> Iterator[pa.RecordBatch]:
    """Of equal stretches of a buffer the first document's; the others are known repeats."""
    order = np.lexsort((doc, route, content))
    order = order[_changes(content[order], route[order], doc[order])]
    first = _changes(content[order], route[order])
    lead, rest = order[first], order[~first]
    yield from _batches(route[lead], offset[lead], doc[lead], content[lead], codes, start[lead], size[lead])
    yield from _batches(_of(content[rest], doc[rest]), np.full(len(rest), ALL), doc[rest], content[rest])


def _node_batches(key, check, doc) -> Iterator[pa.RecordBatch]:
    """Of equal windows of a buffer the first document's; the others are known repeats."""
    order = np.lexsort((doc, check, key))
    order = order[_changes(key[order], check[order], doc[order])]
    first = _changes(key[order], check[order])
    lead, rest = order[first], order[~first]
    yield from _batches(key[lead], check[lead], doc[lead])
    yield from _batches(_of(key[rest], doc[rest]), np.zeros(len(rest)), doc[rest], key[rest])


def deep_repeats(group: np.ndarray, doc: np.ndarray, codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Per stretch the windows (a bit each) that a document with a smaller id in its group holds.

    ``codes`` holds the words of all stretches, ``size[i]`` of them of stretch i. The
    suffixes of 13 words or more are sorted within their group; runs of neighbours that
    share 13 words are the internal nodes of that depth, in the order of their documents.
    """
    n = size - WINDOW + 1
    owner = np.repeat(np.arange(len(n)), n)
    bit = _in_ranges(np.zeros(len(n), dtype=np.int64), n)
    begin = (np.cumsum(size) - size)[owner] + bit
    word = [codes[begin + j].astype(np.uint64) for j in range(WINDOW)]
    keys = [(a << _U(32)) | b for a, b in zip(word[0::2], word[1::2])] + word[WINDOW - 1 :]
    whose, within = doc[owner], group[owner]
    order = np.lexsort((whose, *reversed(keys), within))
    head = _changes(within[order], *(k[order] for k in keys))
    whose = whose[order]
    first = whose[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    marks = np.where(whose > first, 1 << bit[order], 0)
    return np.bincount(owner[order], weights=marks, minlength=len(n)).astype(np.int64)


def _words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words of all stretches of a binary column, and how many each has."""
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]].view(np.uint32)
    return flat, np.diff(ends) // 4


def subtrees(rows: DataFrame) -> DataFrame:
    """(doc, id, mask): the repeats among :func:`suffix_rows`. With a mask, the windows of the
    stretches with that content; without (0), the windows with that hash.

    Groups arrive one after another. Stretches of one prefix are held until the next prefix;
    of a window only its first document is.
    """

    def out(doc, ids, mask) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([doc, ids, mask], names=["doc", "id", "mask"])

    def grown(some: pa.Table) -> pa.RecordBatch:
        batch = some.combine_chunks().to_batches()[0]
        codes, size = _words_of(batch.column(4))
        mask = deep_repeats(batch.column(0).to_numpy(), batch.column(2).to_numpy(), codes, size)
        keep = pa.array(mask > 0)
        return out(batch.column(2).filter(keep), batch.column(3).filter(keep), pa.array(mask[mask > 0].astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, node = None, None
        for batch in batches:
            stretch, known = batch.column(4).is_valid(), batch.column(3).is_valid()
            some = batch.filter(pc.and_not(known, stretch))
            if len(some):
                yield out(some.column(2), some.column(3), some.column(1))
            some = batch.filter(pc.invert(known))
            if len(some):
                key, check, doc = (some.column(k).to_numpy() for k in range(3))
                head = _changes(key, check)
                first = doc[np.maximum.accumulate(np.where(head, np.arange(len(doc)), 0))]
                if node is not None and node[:2] == (key[0], check[0]):
                    upto = int(np.flatnonzero(np.append(head[1:], True))[0]) + 1
                    first[:upto] = node[2]
                node = (key[-1], check[-1], first[-1])
                keep = pa.array(doc > first)
                repeat = some.filter(keep)
                yield out(repeat.column(2), repeat.column(0), pa.array(np.zeros(len(repeat), dtype=np.int32)))
            some = batch.filter(stretch)
            if len(some):
                table = pa.Table.from_batches([some] if held is None else [*held.to_batches(), some])
                route = table.column(0).to_numpy()
                cut = int(np.searchsorted(route, route[-1]))
                if cut:
                    yield grown(table.slice(0, cut))
                held = table.slice(cut)
        if held is not None:
            yield grown(held)

    dealt = rows.repartition("route").sortWithinPartitions("route", "check", "doc")
    return dealt.mapInArrow(run, "doc long, id long, mask int")


def repeated_windows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts by id, (doc, removed): what of each document an earlier one holds, as :func:`subtrees` has it)."""
    texts, by_doc = packed(docs), shared_prefixes(docs)
    joined = texts.join(by_doc, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "packed", "small", "large")
    removed = subtrees(suffix_rows(joined))
    return texts, removed.groupBy("doc").agg(F.collect_list(F.struct("id", "mask")).alias("removed"))


def _repeat_starts(words: Words, lists: pa.Array) -> np.ndarray:
    """Where the windows begin that ``lists`` (one per text) name."""
    sizes = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    ids = pc.struct_field(flat, "id").to_numpy(zero_copy_only=False).view(np.uint64)
    mask = pc.struct_field(flat, "mask").to_numpy(zero_copy_only=False).astype(np.int64)
    named = _of(ids, np.repeat(np.arange(len(lists)), sizes))
    h, owner = hash_words(words), words.owner()
    grams, windows, whole = window_hashes(h, PREFIX), window_hashes(h, WINDOW), inside_text(words, WINDOW)
    some = sizes > 0
    # by window
    by_hash = np.flatnonzero(whole) if (mask == 0).any() else np.zeros(0, dtype=np.int64)
    by_hash = by_hash[some[owner[by_hash]]]
    starts = [by_hash[np.isin(_of(windows[by_hash], owner[by_hash]), named[mask == 0])]]
    # by stretch; a content that is named twice has the bits of both
    order = np.argsort(named[mask > 0], kind="stable")
    key, bits = named[mask > 0][order], mask[mask > 0][order]
    if len(key):
        heads = np.flatnonzero(_changes(key))
        key, bits = key[heads], np.bitwise_or.reduceat(bits, heads)
        at, first, n = stretches(grams, whole)
        use = some[owner[at]]
        at, first, n = at[use], first[use], n[use]
        mine = _of(contents(windows, at, first, n), owner[at])
        place = np.minimum(np.searchsorted(key, mine), len(key) - 1)
        got = np.where(key[place] == mine, bits[place], 0)
        starts += [first[(got >> k & 1 == 1) & (k < n)] + k for k in range(WINDOW - PREFIX + 1)]
    return np.concatenate(starts)


def _marked(column: pa.Array, removed: pa.Array) -> Iterator[tuple[bytes, np.ndarray | None]]:
    """Per text its bytes and, where it loses any words, which ones."""
    for lo, hi, texts in chunks(texts_of(column)):
        lists = removed.slice(lo, hi - lo)
        some = lists.is_valid().to_numpy(zero_copy_only=False)
        if some.any():
            words = split_words(texts)
            gone = covered(len(words), _repeat_starts(words, lists), WINDOW)
        for i in range(hi - lo):
            raw = texts.raw[texts.off[i] : texts.off[i + 1]].tobytes()
            yield raw, gone[words.at[i] : words.at[i + 1]] if some[i] else None


def _kept(column: pa.Array, removed: pa.Array) -> Iterator[tuple[list[bytes], int]]:
    """Per text the kept words and the number of removed ones."""
    for raw, lost in _marked(column, removed):
        found = raw.split()
        kept = found if lost is None else list(compress(found, ~lost))
        yield kept, len(found) - len(kept)


def _renamed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def substring_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256."""
    texts, removed = repeated_windows(_renamed(docs, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _unpacked(batches):
            n, gone, digest = [], [], []
            for kept, lost in _kept(batch.column(1), batch.column(2)):
                n.append(len(kept) + lost)
                gone.append(lost)
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    both = texts.join(removed, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "packed", "removed")
    return both.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the text that is left, its words joined by one space."""
    texts, removed = repeated_windows(_renamed(docs, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _unpacked(batches):
            kept = [b" ".join(words).decode() for words, _ in _kept(batch.column(1), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], names=["doc_id", "text"])

    both = texts.join(removed, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "packed", "removed")
    return both.mapInArrow(run, "doc_id long, text string")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length): the longest stretches of words, in word numbers from 0, that consist
    of windows an earlier document holds; every maximal repeat of 13 words or more lies in one."""
    texts, removed = repeated_windows(_renamed(docs, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _unpacked(b.filter(b.column(2).is_valid()) for b in batches):
            doc, start, length = [], [], []
            for key, (_, lost) in zip(batch.column(0).to_pylist(), _marked(batch.column(1), batch.column(2))):
                edge = np.flatnonzero(np.diff(np.concatenate(([0], lost.view(np.int8), [0]))))
                doc += [key] * (len(edge) // 2)
                start += edge[0::2].tolist()
                length += (edge[1::2] - edge[0::2]).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (doc, start, length)], names=["doc_id", "start", "length"])

    both = texts.join(removed, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "packed", "removed")
    return both.mapInArrow(run, "doc_id long, start long, length long")
