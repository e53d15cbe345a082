"""Secret scan with structural confirmation (operator 5).

Base patterns find assignments, access keys and long hex runs. Candidates that
look like encoded keys are then decoded, and only what has the structure of a
key is reported: PEM blocks and base64 or hex text whose DER lengths nest
exactly, SSH public keys whose fields fill the blob, encrypted PEM blocks whose
DEK-Info header names a cipher and an initial value, and signed or encrypted tokens
whose header is a JSON object naming an algorithm. Lines of equal width (the last
may be shorter) are joined before they are decoded; indents, quote marks and
continuation signs between them are passed over.

One pass, no shuffle. A null text counts as an empty one; texts are scanned
whole, each row on its own (repeated rows give repeated results); a null
``doc_id`` stays null; an empty table gives an empty table. Spans are offsets in
code points, end exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed patterns of the base kinds.
ASSIGN = re.compile(r"((?:(?ai:password|passwd|secret|token|api_?key)))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")
# Lower-cased text without any of these holds no assignment.
_KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,40})-----")
# A header line of a block, and a line that goes on with one. Possessive, so that no text is read twice.
HEADER = re.compile(r"(?:\s|\\[nr])*+[A-Za-z][A-Za-z0-9-]*+:[^\n\\]*+(?:\n|\\n)")
FOLDED = re.compile(r"[ \t]++[^\n\\]*+(?:\n|\\n)|\r?(?:\n|\\n)")
BLANK = re.compile(r"(?:\n|\\n)[ \t\r]*+(?:\n|\\n)")
_BODY = string.ascii_letters + string.digits + "+/=\\" + "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
DEK = re.compile(r"DEK-Info:\s*[A-Z0-9-]+,\s*[0-9A-Fa-f]{16,}")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
# What may stand between two lines of one wrapped key.
WRAP = re.compile(r"[\"',;\\ \t]*(?:\r?\n|\\n)[\"'>|#* \t]*")
# Three parts, five where the content is encrypted; parts may be empty.
JWT_PART = re.compile(r"[A-Za-z0-9_-]++")
JWT_REST = re.compile(r"\.[A-Za-z0-9_-]*+\.[A-Za-z0-9_-]*+")
# How an SSH blob begins, and more fields than any key or certificate has.
SSH_HEAD = re.compile(rb"\0\0\0[\x01-\x40](?:ssh|ecdsa|sk)-")
SSH_FIELDS = 32
_RUN = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_LONG_RUN = re.compile(r"[A-Za-z0-9+/_-]{40}")

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long"


def decoded(text: str) -> bytes | None:
    """Base64 (either alphabet, padding optional) or None."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_key(data: bytes) -> bool:
    """A DER sequence that fills ``data`` and holds what key encodings hold:
    nested elements whose lengths add up, among them an integer or an object
    identifier and at least 16 bytes of payload."""
    found = _elements(data, 0, len(data), 0)
    return bool(found) and len(found) > 2 and found[0][0] == 0x30 and found[0][2] == len(data) and any(
        tag in (0x02, 0x06) for tag, _, _ in found[1:]
    ) and any(tag in (0x02, 0x03, 0x04) and stop - start >= 16 for tag, start, stop in found[1:])


def _elements(data: bytes, at: int, end: int, depth: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, stop) of all elements in ``data[at:end]``, or None if lengths do not nest."""
    out: list[tuple[int, int, int]] = []
    while at < end:
        if end - at < 2 or depth > 8:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end:
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if at + size > end:
            return None
        out.append((tag, at, at + size))
        if tag in (0x30, 0x31, 0xA0, 0xA1):
            inner = _elements(data, at, at + size, depth + 1)
            if inner is None:
                return None
            out += inner
        at += size
    return out


def ssh_key(data: bytes) -> bool:
    """Length-prefixed fields that fill ``data``, the first naming a key type."""
    fields, at = [], 0
    while at + 4 <= len(data) and len(fields) <= SSH_FIELDS:
        size = int.from_bytes(data[at : at + 4], "big")
        if size > len(data) - at - 4:
            return False
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return at == len(data) and len(fields) >= 2 and re.match(rb"(ssh|ecdsa|sk)-[\w@.-]+$", fields[0]) is not None


def token_header(text: str) -> dict | None:
    """The JSON object that ``text`` encodes, if it names an algorithm."""
    try:
        head = json.loads(decoded(text) or b"")
    except (ValueError, UnicodeDecodeError, RecursionError):
        return None
    return head if isinstance(head, dict) and isinstance(head.get("alg"), str) else None


def tokens(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the tokens with a valid header."""
    at = 0
    while part := JWT_PART.search(text, at):
        at = part.end()
        start = text.find("eyJ", part.start(), at)
        rest = JWT_REST.match(text, at) if 0 <= start < at - 3 else None
        head = token_header(text[start:at]) if rest else None
        if head is not None:
            more = JWT_REST.match(text, rest.end()) if "enc" in head else None
            at = (more or rest).end()
            yield start, at


def pem_blocks(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, header lines, body) of the armoured blocks; neither part holds five dashes."""
    for m in BEGIN.finditer(text):
        stop = text.find("-----", m.end())
        mark = f"-----END {m[1]}-----"
        if not text.startswith(mark, stop):
            continue
        inner = text[m.end() : stop]
        least, at = len(inner.rstrip(_BODY)), 0
        first = HEADER.match(inner)
        if first and (gap := BLANK.search(inner, first.end() - 1)) and gap.end() < len(inner.rstrip()):
            least = max(least, gap.end())  # headers end with a blank line where there is one
        while at < least:
            line = HEADER.match(inner, at) or (FOLDED.match(inner, at) if at else None)
            if not line:
                break
            at = line.end()
        if at >= least and at < len(inner):
            yield m.start(), stop + len(mark), inner[:at], inner[at:]


def der_size(head: bytes) -> int:
    """Bytes of the DER sequence that begins with ``head``, 0 if none does."""
    if len(head) < 6 or head[0] != 0x30:
        return 0
    n = head[1] & 0x7F if head[1] & 0x80 else 0
    return 0 if n > 4 else 2 + n + (int.from_bytes(head[2 : 2 + n], "big") if n else head[1])


def wrapped_keys(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, kind index, end) of keys that go on over lines of equal width."""
    at = 0
    while m := BASE64.search(text, at):
        width, runs = m.end() - m.start(), [(m.start(), m.end())]
        while gap := WRAP.match(text, runs[-1][1]):
            line = _RUN.match(text, gap.end())
            if not line or line.end() - line.start() > width:
                break
            runs.append(line.span())
            if line.end() - line.start() < width:
                break
        at, k = m.end(), 0
        while k < len(runs) - 1:
            found = _wrapped(text, runs[k:])
            if found:
                yield runs[k][0], found[0], runs[k + found[1] - 1][1]
            k += found[1] if found else 1
        at = max(at, runs[max(k, 1) - 1][1])


def _wrapped(text: str, runs: list[tuple[int, int]]) -> tuple[int, int] | None:
    """(kind index, number of lines) of a key that starts with the first of ``runs``."""
    first = text[runs[0][0] : runs[0][1]]
    joined = lambda n: "".join(text[a:b] for a, b in runs[:n])
    hexed = re.fullmatch(r"30[0-9a-fA-F]+", first) is not None and len(first) % 2 == 0
    head = bytes.fromhex(first) if hexed else decoded(first[: len(first) // 4 * 4])
    if size := der_size(head or b""):
        chars = 2 * size if hexed else -(-4 * size // 3)
        n = -(-chars // len(first))
        if 1 < n <= len(runs):
            whole = joined(n)
            try:
                data = bytes.fromhex(whole) if hexed else decoded(whole)
            except ValueError:
                data = None
            if data and der_key(data):
                return 4, n
    if SSH_HEAD.match(head or b""):
        for n in (len(runs), len(runs) - 1):
            if n > 1 and _fields_fill(text, runs, n) and (data := decoded(joined(n))) and ssh_key(data):
                return 5, n
    return None


def _fields_fill(text: str, runs: list[tuple[int, int]], n: int) -> bool:
    """Whether length-prefixed fields fill the first ``n`` of ``runs``; reads the lengths only."""
    width = runs[0][1] - runs[0][0]
    last = text[runs[n - 1][0] : runs[n - 1][1]].rstrip("=")
    total, at, count = ((n - 1) * width + len(last)) * 3 // 4, 0, 0
    while at + 4 <= total and count <= SSH_FIELDS:
        char = at // 3 * 4  # eight characters hold the four bytes from here on
        lines = range(char // width, min((char + 7) // width, n - 1) + 1)
        piece = "".join(text[a:b] for a, b in (runs[i] for i in lines))[char % width :][:8]
        four = (decoded(piece) or b"")[at % 3 : at % 3 + 4]
        if len(four) < 4:
            return False
        at, count = at + 4 + int.from_bytes(four, "big"), count + 1
    return at == total


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base kinds."""
    out = []
    low = text.lower()
    if any(word in low for word in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGNED]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    # HEX needs its 32 characters to match at all, so a shorter run is never reported
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of candidates whose decoded structure is that of a key."""
    out = []
    if "-----BEGIN " in text:
        for start, end, head, lines in pem_blocks(text):
            body = decoded(re.sub(r"\\[nr]|\s", "", lines))
            if body and (der_key(body) or body.startswith(b"openssh-key-v1\0") or DEK.search(head)):
                out.append((start, 3, end))
    if _LONG_RUN.search(text):
        for m in BASE64.finditer(text):
            body = decoded(m[0])
            if body and der_key(body):
                out.append((m.start(), 4, m.end()))
            elif body and ssh_key(body):
                out.append((m.start(), 5, m.end()))
            elif re.fullmatch(r"[0-9a-fA-F]+", m[0]) and len(m[0]) % 2 == 0 and der_key(bytes.fromhex(m[0])):
                out.append((m.start(), 4, m.end()))
        # not again what a PEM block or a line of its own has shown
        known = list(out)
        out += [x for x in wrapped_keys(text) if not any(start < x[2] and x[0] < end for start, _, end in known)]
    if "eyJ" in text:
        out += [(start, 6, end) for start, end in tokens(text)]
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def scan(text: str | None) -> tuple[int, int, int, str, str, int]:
    """The result columns of one text."""
    base = base_spans(text or "")
    more = confirmed_spans(text or "")
    kinds = [kind for _, kind, _ in base]
    digest = hashlib.sha256(_joined(base).encode()).hexdigest()
    return kinds.count(0), kinds.count(1), kinds.count(2), digest, _joined(base + more), len(more)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, digest and all spans."""
    names = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed")
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(text.as_py()) for text in batch.column(1)]
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(c, type=t) for c, t in zip(cols, types))], names=list(names)
            )

    return docs.select(id_col, text_col).mapInArrow(run, SCHEMA)
