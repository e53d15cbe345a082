"""Periodic runs of words, by a suffix automaton with link-cut access (operator 13).

A run is a stretch of consecutive words with smallest period q (words q apart are
equal) and at least ``max(least, times * q)`` words that no neighbouring word extends
keeping the period. A word is dropped if a run contains it behind its first q words.

The suffix automaton of a stretch of words has, in its tree of suffix links, a node for
every class of substrings that end at the same places. Words are appended one by one:
an access to the node of each new prefix recolours the path to the root with the new end,
so a node's colour is the last place where its substrings ended. The recoloured path
falls into segments of equal previous colour. The deepest node of a segment says how
long a suffix of the new prefix ended last at the segment's old end; where old and new
end are no further apart than that length, the two occurrences touch: a square, whose
period is their distance. Its first word is where the run begins, because the suffix
is the longest one, and the run is taken at the end where the next word breaks the
period, so each run appears once.

The tree is complete before the first access, so the preferred paths of the accesses are
kept as stacks of segments on its heavy paths, which need no rotations: an access takes a
logarithmic number of segments, amortised.

A word of a run occurs at least ``times`` times in it. Texts are therefore first cut, as
arrays and until nothing changes, at words that are rarer than that in their stretch;
the automaton sees the stretches of ``least`` words and more that are left, and no
run is lost. Its memory grows with the longest such stretch (some 700 bytes a word).

One pass, no shuffle: a row needs only its own text.

Defined results: a null text, or one without words, has no words and no runs (four nulls,
hashes of nothing); a null ``doc_id`` stays null; repeated rows are judged each on its own;
an empty table gives an empty table; very long texts are read whole. Only the id and text
columns are read (and those that :func:`periodic_runs` is told to rewrite by).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldreports.llm.words import NON_SPACE, Words, chunks, hash_words, joined, split_words, texts_of

LEAST = 6
TIMES = 4
SCHEMA = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "n_dropped long, runs_sha256 string, collapsed_sha256 string"
)
Run = tuple[int, int, int]  # start, length, period


def suffix_automaton(w: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(suffix link, longest length) of every state and the state of every prefix; state 0 is the root."""
    link, length, step, prefix = [-1], [0], [{}], []
    last = 0
    for word in w:
        new = len(link)
        link.append(0)
        length.append(length[last] + 1)
        step.append({})
        p = last
        while p >= 0 and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p >= 0:
            q = step[p][word]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(link)
                link.append(link[q])
                length.append(length[p] + 1)
                step.append(dict(step[q]))
                while p >= 0 and step[p].get(word) == q:
                    step[p][word] = copy
                    p = link[p]
                link[q] = link[new] = copy
        prefix.append(new)
        last = new
    return link, length, prefix


def heavy_paths(link: list[int], length: list[int]) -> tuple[list[int], list[int]]:
    """The top node of every node's heavy path, and the node's place on it."""
    order = np.argsort(np.array(length), kind="stable").tolist()  # parents before children
    size = [1] * len(link)
    for v in reversed(order[1:]):
        size[link[v]] += size[v]
    heavy = [-1] * len(link)
    for v in order[1:]:
        u = link[v]
        if heavy[u] < 0 or size[v] > size[heavy[u]]:
            heavy[u] = v
    top, place = list(range(len(link))), [0] * len(link)
    for v in order[1:]:
        u = link[v]
        if heavy[u] == v:
            top[v], place[v] = top[u], place[u] + 1
    return top, place


def stretch_runs(w: list[int], least: int = LEAST, times: int = TIMES) -> list[Run]:
    """All runs of a sequence of numbered words, by end."""
    link, length, prefix = suffix_automaton(w)
    top, place = heavy_paths(link, length)
    # per heavy path the segments of equal colour, the topmost last: (place and length of the deepest node, colour)
    paths: dict[int, list[tuple[int, int, int]]] = {}
    found, n = [], len(w)
    for end, node in enumerate(prefix):
        below = -1
        while node > 0:
            at, head = place[node], top[node]
            stack = paths.setdefault(head, [])
            topmost = stack[-1][2] if stack else -1
            while stack:
                deep, size, old = stack[-1]
                if deep <= at:
                    stack.pop()
                else:
                    size = length[node]  # only the upper part of this segment is recoloured
                period = end - old
                # a segment that goes on from the heavy path below was measured at its deepest node there
                if (old != below and period <= size and size + period >= max(least, times * period)
                        and (end + 1 == n or w[end + 1] != w[end + 1 - period])):
                    found.append((end + 1 - size - period, size + period, period))
                if deep >= at:
                    break
            stack.append((at, length[node], end))
            below, node = topmost, link[head]
    return found


def frequent_stretches(h: np.ndarray, owner: np.ndarray, least: int, times: int) -> list[tuple[int, int]]:
    """[first, last) stretches of ``least`` words or more of one text whose words all occur ``times`` times in the stretch."""
    at, part = np.arange(len(h)), owner
    while len(at):
        order = np.lexsort((h[at], part))
        key_h, key_p = h[at][order], part[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (key_h[1:] != key_h[:-1]) | (key_p[1:] != key_p[:-1])
        size = np.diff(np.append(np.flatnonzero(new), len(order)))
        often = np.empty(len(order), dtype=bool)
        often[order] = np.repeat(size >= times, size)
        kept, part = at[often], part[often]
        begins = np.ones(len(kept), dtype=bool)
        begins[1:] = (np.diff(kept) > 1) | (part[1:] != part[:-1])
        number = np.cumsum(begins) - 1
        long = np.bincount(number, minlength=1)[number] >= least if len(kept) else np.zeros(0, bool)
        kept, part = kept[long], number[long]
        if len(kept) == len(at):
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            return [(int(a), int(b)) for a, b in zip(at[first], at[np.append(first[1:], len(at)) - 1] + 1)]
        at = kept
    return []


def runs_of_texts(h: np.ndarray, at: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[list[Run]]:
    """Runs of each text (words ``h[at[i]:at[i+1]]``, as hashes), by start and period."""
    found: list[list[Run]] = [[] for _ in range(len(at) - 1)]
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for lo, hi in frequent_stretches(h, owner, least, times):
        doc = int(owner[lo])
        words = np.unique(h[lo:hi], return_inverse=True)[1].tolist()
        found[doc] += [(s + lo - int(at[doc]), n, q) for s, n, q in stretch_runs(words, least, times)]
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of ``n`` words no run holds behind its first period."""
    kept = np.ones(n, dtype=bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return kept


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """For a tenth of the ids, the original words that stand at the places of a text whose tail repeats; else None."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def _report(doc_id: list, words: Words, rewrite, least: int, times: int) -> Iterator[tuple]:
    text, start, end = joined(words)
    h, at = hash_words(words), words.at
    orders = {}
    for i, d in enumerate(doc_id):
        order = rewrite(d, int(at[i + 1] - at[i])) if rewrite else None
        if order is not None:
            orders[i] = order
            h[at[i] : at[i + 1]] = h[at[i] : at[i + 1]][order]
    for i, runs in enumerate(runs_of_texts(h, at, least, times)):
        lo, hi = int(at[i]), int(at[i + 1])
        left = kept_words(hi - lo, runs)
        if i not in orders and not runs:
            rest = text[start[lo] : end[hi - 1]] if hi > lo else b""
        else:
            which = (orders.get(i, np.arange(hi - lo))[left] + lo).tolist()
            rest = b" ".join([text[start[k] : end[k]] for k in which])
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        told = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        yield (doc_id[i], hi - lo, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
               int((~left).sum()), hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(rest).hexdigest())


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = LEAST, times: int = TIMES,
    rewrite: Callable[[int | None, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: n_words, n_runs, the longest run (ties: smallest start, then period), n_dropped, and
    hashes of all runs and of the text without dropped words. ``rewrite`` may give, for an id and its number of words, the
    words to put at the places 0, 1, ... before the search. ``times`` is at least 2."""
    if times < 2:
        raise ValueError("a run repeats at least twice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for lo, hi, texts in chunks(texts_of(batch.column(1))):
                rows += _report(ids[lo:hi], split_words(texts, NON_SPACE), rewrite, least, times)
            columns = list(zip(*rows)) or [[]] * 10
            kinds = [pa.int64()] * 8 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in SCHEMA.split(", ")])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def _collapse(text: str, h: np.ndarray, least: int, times: int) -> str:
    left = kept_words(len(h), runs_of_texts(h, np.array([0, len(h)]), least, times)[0])
    return text if left.all() else b" ".join(np.array(text.encode().split(), dtype=object)[left]).decode()


def collapse_runs(docs: DataFrame, text_col: str = "text", *, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` with the dropped words taken out; a changed text has one space between its words, other texts,
    rows and columns stay as they are."""
    names = docs.columns
    place = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old, new = batch.column(place).to_pylist(), []
            for lo, hi, texts in chunks(texts_of(batch.column(place))):
                words = split_words(texts, NON_SPACE)
                h = hash_words(words)
                new += [t if t is None else _collapse(t, h[words.at[i] : words.at[i + 1]], least, times)
                        for i, t in enumerate(old[lo:hi])]
            columns = [pa.array(new, pa.string()) if k == place else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)
