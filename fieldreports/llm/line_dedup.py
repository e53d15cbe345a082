"""Line dedup by a segment-partition edit join (operator 1).

A line (text between line feeds, without surrounding white space) of at least
``MIN_CHARS`` code points is removed where an earlier line - smaller doc_id, or
the same document further up - lies within edit distance ``TAU`` of it (equal
lines included). With ``blocks`` it also goes where the two lines differ in one
run of characters only (a word, a date, a number), however many edits that takes;
the run is at most a tenth of the longer line, or ten characters in one of 60 to 100
(a sixth in a shorter one). A shorter line that is not blank
goes only where an earlier line equals it. Lines are judged on the input, not on
what is left.

1. Occurrences of equal lines meet by a 128-bit hash; only different lines are
   compared.
2. Each line is cut into ``TAU + 1`` segments. Of two lines within the distance,
   one segment of the shorter is a substring of the longer, and only at a few
   positions that depend on the lengths. Segments and those substrings meet in
   groups (length, segment number, content).
   Lines that differ in one run share their first or their last characters, at
   least half of what is outside the run: with ``blocks`` a line also brings its
   beginning and its end, cut to lengths of a geometric grid.
3. Pairs of a group whose lengths and character counts allow the distance are
   verified by a bit-parallel automaton over the band of ``2 * TAU + 1`` diagonals.
   A line goes as soon as one earlier line is near it, so every line is compared with
   the earliest line of its group first, then with later and later ones, until one is
   near; the group returns one row for each line that goes.

Groups of more than ``TILE`` lines or ``TILE_CHARS`` characters are dealt into tiles
of two such blocks, so no task compares a whole hot group; pairs exist only as index
arrays inside a tile. A task emits the segments of equal lines once. The rows of one
key are sorted in one task to see whether different lines share it (sixteen bytes a
row, spilled to disk where they are many).

Defined results: a null text stays null with no lines; an empty text is one
empty line, and blank lines stay; rows with a null ``doc_id`` neither lose
lines nor take any; rows with the same id count as one position, so equal lines
at the same place of such rows are all kept or all removed; an empty table gives
an empty table. Other columns are not read by the report and kept unchanged by
:func:`dedup_lines`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldreports.llm.shared import dealt_anew, free_name, stored
from fieldreports.llm.words import mix
from fieldreports.operators.common import possible_members

TAU = 2
MIN_CHARS = 20
# Lengths of beginnings and ends, each a quarter above the one before.
GRID = np.unique((6 * 1.25 ** np.arange(120)).astype(np.int64))
TILE = 1024
TILE_CHARS = 1 << 22
BUCKETS = 32
PAIR_BATCH = 1 << 19
BATCH_CHARS = 1 << 20
# Bits of the table that holds back lines without a candidate id: at most 2 M words, 32 MB, broadcast at every size.
FILTER_BITS = 27
_BLANK = " \t\v\f\r"
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def lines_of(text: str | None, least: int | None = None) -> list[tuple[int, str]]:
    """(line number, stripped line) of the lines long enough to be compared with near ones, or of ``least`` characters."""
    least = MIN_CHARS if least is None else least
    out = []
    for k, line in enumerate((text or "").split("\n")):
        line = line.strip(_BLANK)
        if len(line) >= least:
            out.append((k, line))
    return out


def line_key(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))


def short_key(key: bytes) -> int:
    """First half of a line's hash, as a signed integer with the lowest bit free."""
    return int.from_bytes(key[:8], "little", signed=True) & ~1


# -- segments ---------------------------------------------------------------------

def segment_starts(n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(start, length) of each of the TAU + 1 segments of lines of ``n`` characters."""
    parts = TAU + 1
    small, rest = n // parts, n % parts
    out, at = [], np.zeros_like(n)
    for i in range(parts):
        size = small + (i >= parts - rest)
        out.append((at, size))
        at = at + size
    return out


def probes(n: np.ndarray) -> Iterator[tuple[np.ndarray, int, int, np.ndarray, np.ndarray]]:
    """(lines, length difference, segment, start, size) of the substrings that can equal a
    segment of a line of ``n - difference`` characters within the distance."""
    for less in range(TAU + 1):
        for i, (start, size) in enumerate(segment_starts(n - less)):
            low = np.maximum(start - i, start + less - (TAU - i))
            high = np.minimum(start + i, start + less + (TAU - i))
            low, high = np.maximum(low, 0), np.minimum(high, n - size)
            for step in range(2 * TAU + 1):
                at = low + step
                some = np.flatnonzero(at <= high)
                if len(some):
                    yield some, less, i, at[some], size[some]


def run_limit(n: np.ndarray) -> np.ndarray:
    """Greatest differing run where the longer line has ``n`` characters."""
    return np.maximum(n // 10, np.minimum(10, n // 6))


def block_size(n: np.ndarray) -> np.ndarray:
    """Greatest grid length that lines of ``n`` and fewer characters share at one end if one run differs."""
    return GRID[np.searchsorted(GRID, (n - run_limit(n) + 1) // 2, side="right") - 1]


def segment_rows(lines: list[str], ids: np.ndarray, blocks: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(group key, id) of all segments and probes; the lowest bit of the id marks a segment,
    with ``blocks`` that of the key a beginning or an end."""
    n = np.array([len(x) for x in lines], dtype=np.int64)
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    begin = np.cumsum(n) - n
    inside = np.arange(len(codes)) - np.repeat(begin, n)
    longest = int(n.max()) + 1
    power = np.cumprod(np.concatenate((np.ones(1, _U), np.full(longest, _BASE, _U))))
    back = np.cumprod(np.concatenate((np.ones(1, _U), np.full(longest, _INVERSE, _U))))
    total = np.concatenate((np.zeros(1, _U), np.cumsum(mix(codes + _U(1)) * power[inside], dtype=_U)))

    def content(line: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        s = begin[line] + at
        return (total[s + size] - total[s]) * back[at]

    def key(line, at, size, length, i):
        place = mix((length.astype(np.uint64) << _U(8)) + _U(i))
        return mix(content(line, at, size) ^ place)

    every = np.arange(len(lines))
    keys, owners = [], []
    for i, (start, size) in enumerate(segment_starts(n)):
        keys.append(key(every, start, size, n, i))
        owners.append(ids | 1)
    for some, less, i, at, size in probes(n):
        if less == 0:  # a segment row also probes its own place
            own = segment_starts(n[some])[i][0] == at
            some, at, size = some[~own], at[~own], size[~own]
        keys.append(key(some, at, size, n[some] - less, i))
        owners.append(ids[some])
    if blocks:
        keys = [k & ~_U(1) for k in keys]
        size, lowest = block_size(n), block_size(n - run_limit(n))
        while len(every):  # a line probes the sizes of the shorter lines that may be near
            for i, at in enumerate((np.zeros_like(every), n[every] - size[every])):
                keys.append(key(every, at, size[every], size[every], TAU + 1 + i) | _U(1))
                owners.append(ids[every] | (size[every] == block_size(n[every])))
            every = every[size[every] > lowest[every]]
            size[every] = GRID[np.searchsorted(GRID, size[every]) - 1]
    return np.concatenate(keys), np.concatenate(owners)


def occurrences(docs: DataFrame) -> DataFrame:
    """(line, doc, at): hash, document and line number of every line that is not blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owner, number = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for k, line in lines_of(text.as_py(), 1) if doc is not None else ():
                    keys.append(line_key(line))
                    owner.append(doc)
                    number.append(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(owner, pa.int64()), pa.array(number, pa.int32())],
                names=["line", "doc", "at"])

    return docs.select("doc_id", "text").mapInArrow(run, "line binary, doc long, at int")


def _fresh_lines(batch: pa.RecordBatch, seen: set[int]) -> Iterator[tuple[list[str], list[bytes]]]:
    """Judged lines not yet seen in this task, at most BATCH_CHARS (or one line) at a time."""
    lines, keys, size = [], [], 0
    for doc, text in zip(batch.column(0), batch.column(1)):
        for _, line in lines_of(text.as_py()) if doc.is_valid else ():
            key = line_key(line)
            if short_key(key) in seen:
                continue
            seen.add(short_key(key))
            if lines and size + len(line) > BATCH_CHARS:
                yield lines, keys
                lines, keys, size = [], [], 0
            lines.append(line)
            keys.append(key)
            size += len(line)
    if lines:
        yield lines, keys


def segments(docs: DataFrame, blocks: bool = False) -> DataFrame:
    """(key, id) rows of all lines of MIN_CHARS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for lines, keys in _fresh_lines(batch, seen):
                key, owner = segment_rows(lines, np.array([short_key(k) for k in keys], dtype=np.int64), blocks)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(owner)], names=["key", "id"])

    return docs.select("doc_id", "text").mapInArrow(run, "key long, id long")


def counts(line: str) -> bytes:
    """Characters by hash bucket, modulo 256."""
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    return np.bincount((mix(codes) >> _U(59)).astype(np.int64), minlength=BUCKETS).astype(np.uint8).tobytes()


def candidate_lines(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, line, text, counts) of the lines whose id is in ``wanted``, each once."""
    wanted = stored(wanted)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for lines, keys in _fresh_lines(batch, seen):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([short_key(k) for k in keys], pa.int64()), pa.array(keys, pa.binary()), pa.array(lines, pa.string())],
                    names=["id", "line", "text"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([counts(x) for x in batch.column(2).to_pylist()], pa.binary())],
                names=["id", "line", "text", "counts"])

    rows = docs.select("doc_id", "text").mapInArrow(spell, "id long, line binary, text string")
    some = possible_members(rows, ["id"], wanted, ["id"], FILTER_BITS)
    # inner, as a semi join would be pushed below the bit table; ``wanted`` has each id once
    return some.join(wanted, "id").dropDuplicates(["line"]).select("id", "line", "text").mapInArrow(
        count, "id long, line binary, text string, counts binary")


# -- pairs of a group -------------------------------------------------------------

def _run_pairs(first: np.ndarray, split: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of the runs [first, last): a row before ``split`` (segments) with one behind it (probes)."""
    left, width = split - first, last - split
    size = left * width
    at = 0
    while at < len(size):
        upto = max(at + 1, int(np.searchsorted(np.cumsum(size[at:]), PAIR_BATCH, side="right")) + at)
        n = size[at:upto]
        run = np.repeat(np.arange(at, upto), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = np.maximum(width[run], 1)
        yield first[run] + k // wide, split[run] + k % wide
        at = upto


def _close(a: np.ndarray, b: np.ndarray, length: np.ndarray, table: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """Whether lengths and counts of rows a and b allow the distance, or one differing run where row a is
    ``wide`` (an edit changes at most two counts)."""
    most = np.where(wide[a], run_limit(np.maximum(length[a], length[b])), TAU)
    ok = np.flatnonzero(np.abs(length[a] - length[b]) <= most)
    gap = table[a[ok]] - table[b[ok]]
    return ok[np.minimum(gap, -gap).sum(axis=1, dtype=np.int64) <= 2 * most[ok]]


def near_earlier(rows: DataFrame, blocks: bool = False) -> DataFrame:
    """(line): the lines that have a near earlier one among the rows (key, i, j, part, line, n, counts, text, doc, at)
    of their tile, sorted by (key, i, j, part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            start = _run_starts(held)
            if len(start) > 1:  # the last run may go on in the next batch
                yield _gone(held.slice(0, int(start[-1])), blocks)
                held = held.slice(int(start[-1]))
        if held is not None and held.num_rows:
            yield _gone(held, blocks)

    return rows.mapInArrow(run, "line binary")


def _run_starts(table: pa.Table) -> np.ndarray:
    key = np.stack([table.column(c).to_numpy() for c in (0, 1, 2)], axis=1)
    return np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1)))) if len(key) else np.zeros(0, np.int64)


def _gone(table: pa.Table, blocks: bool) -> pa.RecordBatch:
    key, part, length = (table.column(c).to_numpy() for c in (0, 3, 5))
    count = np.frombuffer(b"".join(table.column(6).to_pylist()), dtype=np.uint8).reshape(-1, BUCKETS)
    doc, at = table.column(8).to_numpy(), table.column(9).to_numpy()
    order = np.lexsort((at, doc))
    step = (doc[order][1:] != doc[order][:-1]) | (at[order][1:] != at[order][:-1])
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.concatenate(([0], np.cumsum(step)))  # equal for lines that begin at the same place
    names, row, number = np.unique(table.column(4).to_numpy(), return_index=True, return_inverse=True)
    place, text = place[row], table.column(7).take(pa.array(row)).to_pylist()
    gone = np.zeros(len(names), dtype=bool)
    first = _run_starts(table)
    # within a run the segment rows (part 0) come first
    split = first + np.add.reduceat((part == 0).astype(np.int64), first)
    wide = (key & 1 == 1) & blocks
    for a, b in _run_pairs(first, split, np.append(first[1:], len(key))):
        ok = _close(a, b, length, count, wide)
        x, y = number[a[ok]], number[b[ok]]
        late, early = np.where(place[x] > place[y], x, y), np.where(place[x] > place[y], y, x)
        _settle(late, early, place, text, gone, blocks)
    return pa.RecordBatch.from_arrays([pa.array(names[gone], pa.binary())], names=["line"])


def _settle(late: np.ndarray, early: np.ndarray, place: np.ndarray, text: list[str], gone: np.ndarray, blocks: bool) -> None:
    """Mark in ``gone`` the lines ``late`` near one of their ``early`` lines; a line's earliest candidate is tried first,
    then twice as many a round, until one is near."""
    use = np.flatnonzero((place[early] < place[late]) & ~gone[late])
    use = use[np.lexsort((place[early[use]], late[use]))]
    late, early = late[use], early[use]
    new = np.ones(len(late), dtype=bool)
    new[1:] = (late[1:] != late[:-1]) | (early[1:] != early[:-1])
    late, early = late[new], early[new]
    some = 1
    while len(late):
        rank = np.arange(len(late)) - np.searchsorted(late, late)
        now = np.flatnonzero(rank < some)
        good = near([text[k] for k in late[now]], [text[k] for k in early[now]], blocks)
        gone[late[now[good]]] = True
        left = (rank >= some) & ~gone[late]
        late, early, some = late[left], early[left], 2 * some


# -- verification -----------------------------------------------------------------

def within(left: list[str], right: list[str], tau: int = TAU) -> np.ndarray:
    """Whether the edit distance of each pair is at most ``tau``.

    An automaton over the band of diagonals -tau .. tau, for all pairs at once:
    bit d of ``state[e]`` says that the read prefix of the right line (i
    characters) and the first i + d - tau characters of the left one are within
    e edits.
    """
    n = np.array([len(x) for x in right])
    m = np.array([len(x) for x in left])
    if not len(n):
        return np.zeros(0, dtype=bool)
    width, longest = 2 * tau + 1, int(max(n.max(), m.max()))
    text = np.zeros((longest, len(n)), dtype=np.uint32)
    pattern = np.zeros((longest + 2 * tau + 1, len(n)), dtype=np.uint32)  # shifted by tau; 0 matches nothing
    for k, (x, y) in enumerate(zip(left, right)):
        pattern[tau : tau + m[k], k] = np.frombuffer(x.encode("utf-32-le", "surrogatepass"), dtype="<u4") + 1
        text[: n[k], k] = np.frombuffer(y.encode("utf-32-le", "surrogatepass"), dtype="<u4") + 1
    full = np.uint32((1 << width) - 1)

    def valid(i: int) -> np.ndarray:
        """Diagonals whose left prefix exists: 0 <= i + d - tau <= m."""
        top = np.clip(m - i + tau + 1, 0, width)
        low = max(0, tau - i)
        return ((np.uint32(1) << top.astype(np.uint32)) - np.uint32(1)) & np.uint32(full & ~np.uint32((1 << low) - 1))

    state = [np.full(len(n), ((1 << (e + 1)) - 1) << tau, dtype=np.uint32) & valid(0) for e in range(tau + 1)]
    good = np.zeros(len(n), dtype=bool)

    def finish(i: int) -> None:
        done = n == i
        if done.any():
            d = m - i + tau
            ok = done & (d >= 0) & (d < width)
            good[ok] = (state[tau][ok] >> d[ok].astype(np.uint32)) & 1 == 1

    finish(0)
    for i in range(longest):
        match = np.zeros(len(n), dtype=np.uint32)
        for d in range(width):
            match |= ((pattern[i + d] == text[i]) & (text[i] != 0)).astype(np.uint32) << np.uint32(d)
        limit, new = valid(i + 1), []
        for e in range(tau + 1):
            s = state[e] & match
            if e:
                s |= state[e - 1] | (state[e - 1] >> np.uint32(1)) | (new[e - 1] << np.uint32(1))
            new.append(s & limit)
        state = new
        finish(i + 1)
        if not state[tau].any():
            break
    return good


def one_run(x: str, y: str) -> bool:
    """Whether x and y differ in one run within :func:`run_limit`."""
    short, most = min(len(x), len(y)), max(len(x), len(y))
    a, b = (np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype="<u4") for s in (x, y))
    front, back = a[:short] != b[:short], a[len(x) - short:][::-1] != b[len(y) - short:][::-1]
    same = sum(int(d.argmax()) if d.any() else short for d in (front, back))
    return most - min(same, short) <= run_limit(most)


def near(x: list[str], y: list[str], blocks: bool = False) -> np.ndarray:
    """Whether the lines of each pair are within the distance, or with ``blocks`` differ in one run."""
    good = np.array([blocks and one_run(*p) for p in zip(x, y)], dtype=bool)
    order = sorted((k for k in range(len(x)) if not good[k] and abs(len(x[k]) - len(y[k])) <= TAU), key=lambda k: len(x[k]))
    at = 0
    while at < len(order):  # pairs of like length together, a bounded number of characters
        upto = at + 1
        while upto < len(order) and (upto - at + 1) * (len(x[order[upto]]) + TAU) <= BATCH_CHARS:
            upto += 1
        some = order[at:upto]
        good[some] = within([x[k] for k in some], [y[k] for k in some])
        at = upto
    return good


def near_lines(docs: DataFrame, first: DataFrame, blocks: bool = False) -> DataFrame:
    """(line): the lines near a different one that occurs earlier; ``first`` holds each line's first place."""
    group = Window.partitionBy("key")
    part = F.col("id").bitwiseAND(F.lit(1))
    line_id = F.col("id") - part
    rows = segments(docs, blocks).select("key", line_id.alias("id"), part.alias("segment")).withColumns({
        "low": F.min("id").over(group), "high": F.max("id").over(group), "any": F.max("segment").over(group),
    }).where("low < high AND any = 1")
    rows = stored(rows.groupBy("key", "id").agg(F.max("segment").alias("segment")))
    lines = candidate_lines(docs, rows.select("id").distinct())
    lines = stored(lines.join(first, "line").select("id", "line", "text", "counts", "first.doc", "first.at"))
    placed = stored(rows.join(lines.withColumn("n", F.length("text")), "id"))
    size = placed.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("chars"))
    size = size.select("key", F.ceil(F.greatest(F.col("members") / TILE, F.col("chars") / TILE_CHARS)).cast("int").alias("blocks"))
    placed = placed.join(dealt_anew(size), "key").withColumn("block", F.pmod(F.xxhash64("line"), F.col("blocks")).cast("int"))
    # segment rows of block i meet the rows of block j in the tile (key, i, j)
    # part 0: a segment row as such; part 1: any row in its role as a probe
    roles = placed.withColumn("part", F.explode(F.when(F.col("segment") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))))
    tiles = roles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.when(F.col("part") == 0, F.col("block")).otherwise(F.col("other")).alias("i"),
        F.when(F.col("part") == 0, F.col("other")).otherwise(F.col("block")).alias("j"),
        "part", "line", "n", "counts", "text", "doc", "at")
    dealt = tiles.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "part")
    return near_earlier(dealt, blocks).distinct()


# -- removal ----------------------------------------------------------------------

def removed_lines(docs: DataFrame, blocks: bool = False) -> DataFrame:
    """(doc, gone): the numbers of the lines to remove, for documents that lose any."""
    found = stored(occurrences(docs))
    first = stored(found.groupBy("line").agg(F.min(F.struct("doc", "at")).alias("first")))
    gone = near_lines(docs, first, blocks).withColumn("near", F.lit(True))
    known = stored(first.join(gone, "line", "left"))
    later = found.join(known, "line").where(F.col("near").isNotNull() | (F.struct("doc", "at") > F.col("first")))
    return later.groupBy("doc").agg(F.sort_array(F.collect_set("at")).alias("gone"))


def _without(text: str | None, gone: list[int] | None) -> str | None:
    if text is None or not gone:
        return text
    drop = set(gone)
    return "\n".join(line for k, line in enumerate(text.split("\n")) if k not in drop)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: bool = False) -> DataFrame:
    """``docs`` with the removed lines cut from the text; rows and other columns unchanged."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    names = list(docs.columns)
    doc, gone = free_name("doc", names), free_name("gone", names)
    both = docs.join(removed_lines(plain, blocks).withColumnsRenamed({"doc": doc, "gone": gone}),
                     F.col(id_col).cast("long") == F.col(doc), "left").drop(doc)
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()
            cut = pa.array([_without(t, g) for t, g in zip(texts, gone)], pa.string())
            yield pa.RecordBatch.from_arrays([cut if k == at else batch.column(k) for k in range(len(names))], names=names)

    return both.mapInArrow(run, docs.schema)


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed and the text that is left."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    both = plain.join(removed_lines(plain, blocks), F.col("doc_id") == F.col("doc"), "left").select("doc_id", "text", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            n = [t.count("\n") + 1 if t is not None else 0 for t in texts]
            lost = [len(g) if g and t is not None else 0 for t, g in zip(texts, gone)]
            cut = pa.array([_without(t, g) for t, g in zip(texts, gone)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(lost, pa.int64()), cut],
                names=["doc_id", "n_lines", "n_removed", "text"])

    return both.mapInArrow(run, "doc_id long, n_lines long, n_removed long, text string")
