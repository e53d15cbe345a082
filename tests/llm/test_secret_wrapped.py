"""Operator 5: wrapped keys without armour, encrypted PEM blocks, tokens known by their header."""

import base64
import json

import pytest

from fieldreports.llm import secrets
from test_texts import der

KEY = der(0x30, der(0x02, b"\x00"), der(0x30, der(0x06, b"\x2a\x86\x48")), der(0x04, bytes(range(256)) * 2))


def found(text):
    return [tuple(x.split(":")) for x in secrets.scan(text)[4].split(",") if x.split(":")[0] in ("pem", "der", "ssh", "jwt")]


def field(b):
    return len(b).to_bytes(4, "big") + b


@pytest.mark.parametrize("width", [64, 76])
@pytest.mark.parametrize("key, kind", [(KEY, "der"), (field(b"ssh-rsa") + field(b"\x01\x00\x01") + field(bytes(range(255, 0, -1))), "ssh")])
@pytest.mark.parametrize("gap", ["\n", "\r\n", "\n    ", "\n> ", "\\\n"])
def test_wrapped_keys(width, key, kind, gap):
    body = base64.b64encode(key).decode()
    text = gap.join(body[i : i + width] for i in range(0, len(body), width))
    assert found(f"key: {text}\nnext line of words") == [(kind, "5", str(5 + len(text)))]
    assert found(f"key: {text[:-40]}\nnext") == []


def test_wrapped_hex_and_two_keys():
    text = "\n".join(KEY.hex()[i : i + 64] for i in range(0, 2 * len(KEY), 64))
    assert [x[0] for x in found(f"a\n{text}\n")] == ["der"]
    body = base64.b64encode(KEY).decode()
    block = "\n".join(body[i : i + 64] for i in range(0, len(body), 64))
    assert [x[0] for x in found(f"{block}\n\n{block}\n")] == ["der", "der"]
    assert [x[0] for x in found(f"-----BEGIN PRIVATE KEY-----\n{block}\n-----END PRIVATE KEY-----")] == ["pem"]


def test_encrypted_pem():
    body = base64.encodebytes(bytes(range(240))).decode()
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF\n\n"
    block = "-----BEGIN RSA PRIVATE KEY-----\n{}" + body + "-----END RSA PRIVATE KEY-----"
    assert [x[0] for x in found("x " + block.format(head))] == ["pem"]
    assert found(block.format("")) == [] and found(block.format("Proc-Type: 4,ENCRYPTED\n\n")) == []
    assert [x[0] for x in found(block.format(head).replace("\n", "\\n"))] == ["pem"]


def test_tokens_by_header():
    part = lambda x: base64.urlsafe_b64encode(x).decode().rstrip("=")
    head = part(json.dumps({"alg": "RS256", "zip": "DEF"}).encode())
    secret = part(json.dumps({"alg": "dir", "enc": "A256GCM"}).encode())
    signed, sealed = f"{head}.{part(bytes(range(99)))}.c2ln", f"{secret}..aXY.Y2lwaGVy.dGFn"
    assert found(f"t {signed} .") == [("jwt", "2", str(2 + len(signed)))]
    assert found(f"t {sealed}.") == [("jwt", "2", str(2 + len(sealed)))]
    assert found(f"{head}..c2ln.{signed}")[0][0] == "jwt"
    assert found(part(json.dumps({"typ": "x"}).encode()) + ".abc.def") == []
