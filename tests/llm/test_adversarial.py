"""Texts that make backtracking or recursing patterns run away."""

import base64
import json
import time

import pytest

from fieldreports.llm import secrets
from test_native import rewrite
from test_secret_wrapped import KEY, field, found

M = 1 << 20


@pytest.mark.parametrize("text", [
    "-----BEGIN PRIVATE KEY-----\nProc-Type: 4\n" + "     indented line of words\n" * 12,
    "-----BEGIN PRIVATE KEY-----\nProc-Type: 4\n" + "     indented line of words here\n" * (M // 33),
    "-----BEGIN PRIVATE KEY-----\nx: y\n  " * (M // 36) + "-----END PRIVATE KEY-----",
    "-----BEGIN A-----\n" + " \n" * (M // 2),
    "-----BEGIN A-----\n" + "a:b\n" * (M // 4) + "abc\n-----END A-----",
    "eyJ" * (M // 3), "eyJ" * (M // 3) + ".a", "eyJ." * (M // 4), "A" * 64 + "\n", ("A" * 64 + "\n") * (M // 65),
    ("AAAAB3NzaC1yc2E" + "A" * 49 + "\n") * (M // 65), ("30820100" * 8 + "\n") * (M // 65), "secret" * (M // 6),
], ids=range(13))
def test_secret_scan_in_seconds(text):
    start = time.time()
    assert secrets.scan(text)[5] == 0
    assert time.time() - start < 20


def test_indented_block_with_headers():
    body = base64.encodebytes(KEY).decode().rstrip("\n").replace("\n", "\n    ")
    block = f"-----BEGIN RSA PRIVATE KEY-----\n    Note: a\n     folded line\n\n    {body}\n    -----END RSA PRIVATE KEY-----"
    assert [x[0] for x in found(block)] == ["pem"]
    # without a header line it is no block; its lines are still a wrapped key
    assert [x[0] for x in found(block.replace("Note: a\n", "no header\n"))] == ["der"]


def test_tokens_next_to_other_runs():
    head = base64.urlsafe_b64encode(json.dumps({"alg": "HS256"}).encode()).decode().rstrip("=")
    assert found(f"abc.{head}.e30.c2ln") == [("jwt", "4", str(4 + len(head) + 9))]
    assert found(f"x{head}.e30.c2ln {head}.e30") == [("jwt", "1", str(1 + len(head) + 9))]


def test_long_wrapped_ssh_key():
    key = field(b"ssh-ed25519") + field(bytes(range(250)) * 9)
    body = base64.b64encode(key).decode()
    text = "\n".join(body[i : i + 70] for i in range(0, len(body), 70))  # a width that is no multiple of four
    assert [x[0] for x in found(f"{text}\nend")] == ["ssh"]


@pytest.mark.parametrize("text", ["a@b" + ".c" * (M // 2), "a" * M + "@b.c", "a@" * (M // 2), "7" * M, "a.b@c.de " * 3000], ids=range(5))
def test_pseudonyms_of_long_texts(spark, text):
    start = time.time()
    got = rewrite(spark, [text, "x"])[0]
    assert len(got["text"]) == len(text) and got["n_mail"] == {"a@b": 1, "a.b": 3000}.get(text[:3], 0)
    assert time.time() - start < 120
