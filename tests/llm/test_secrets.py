from __future__ import annotations

import base64
import hashlib
import json
import os
import re
from collections import Counter

import pytest

from streamlookup.llm import secret_scan as s


def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 + (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8)
    return bytes([tag]) + size + body


def integer(n):
    return der(2, b"\1" * n)


RSA = der(0x30, der(2, b"\0"), *[integer(n) for n in (64, 3, 64, 32, 32, 32, 32, 32)])
OID = der(6, b"\x2a\x86\x48\x86\xf7\x0d\1\1\1")
PKCS8 = der(0x30, der(2, b"\0"), der(0x30, OID, der(5)), der(4, RSA))
ENCRYPTED = der(0x30, der(0x30, OID, der(0x30, der(4, b"salt" * 2), der(2, b"\x08\0"))), der(4, b"c" * 64))
EC = der(0x30, der(2, b"\1"), der(4, b"k" * 32), der(0xA0, OID))
PUBLIC = der(0x30, der(0x30, OID, der(5)), der(3, b"\0" + RSA))


def string(data):
    return len(data).to_bytes(4) + data


OPENSSH = b"openssh-key-v1\0" + string(b"none") + string(b"none") + string(b"") + (1).to_bytes(4) + string(b"p" * 51) + string(b"k" * 144)


def b64(data):
    return base64.b64encode(data).decode()


def token(header):
    return ".".join(base64.urlsafe_b64encode(p).decode().rstrip("=") for p in (header, b'{"sub":"1"}', b"signature-bytes"))


KEYS = [("rsa_key", RSA), ("pkcs8_key", PKCS8), ("encrypted_key", ENCRYPTED), ("ec_key", EC), ("openssh_key", OPENSSH)]


@pytest.mark.parametrize("kind, data", KEYS)
def test_keys_are_confirmed(kind, data):
    lines = "\n".join(b64(data)[i : i + 64] for i in range(0, len(b64(data)), 64))
    for encoded in (b64(data), lines, lines.replace("\n", "\\n"), data.hex().upper()):
        text = f"before: {encoded}\n! after"
        found = [x for x in s.find_secrets(text) if x[2] in s.KEY_KINDS]
        assert found == [(8, 8 + len(encoded), kind)]


def armoured(size, end, line=64):
    """A PKCS#8 key of ``size`` bytes modulo 3 in lines, and where its base64 lies."""
    key = next(k for n in range(40, 90) if len(k := der(0x30, der(2, b"\0"), der(0x30, OID, der(5)), der(4, b"\2" * n))) % 3 == size)
    body = end.join(b64(key)[i : i + line] for i in range(0, len(b64(key)), line))
    head = f"-----BEGIN PRIVATE KEY-----{end}"
    return head + body + f"{end}-----END PRIVATE KEY-----{end}", (len(head), len(head) + len(body), "pkcs8_key")


@pytest.mark.parametrize("end", ["\n", "\r\n", "\\n", "\\r\\n", "\\\\n", "\n    ", ""])
@pytest.mark.parametrize("size", range(3))
def test_armoured_keys(size, end):
    text, span = armoured(size, end)
    assert s.find_secrets(text) == [span]
    before = "-" * 48 + "\n" + "Q" * 64 + "\n"
    a, b, kind = span
    assert s.find_secrets(before + text + text) == [(len(before) + a, len(before) + b, kind), (len(before + text) + a, len(before + text) + b, kind)]
    assert b64(PKCS8)[:40] not in s.redact(text, [span])


@pytest.mark.parametrize("kind, data", KEYS)
def test_words_behind_unpadded_keys(kind, data):
    encoded = b64(data).rstrip("=")
    for behind in ("\nWords follow", "\n-----END", "\\nnext", "\n" + "x" * 70):
        assert [x for x in s.find_secrets(encoded + behind) if x[2] in s.KEY_KINDS] == [(0, len(encoded), kind)]


@pytest.mark.parametrize("kind, data", KEYS)
def test_broken_keys_are_not(kind, data):
    for broken in (data[:-1], data + b"\0", data[:5] + bytes([data[5] ^ 0x55]) + data[6:], os.urandom(len(data))):
        assert s.key_kind(broken) is None
    assert s.key_kind(PUBLIC) is None and s.key_kind(b"") is None and s.key_kind(b"\x30\x80") is None


def test_signed_tokens():
    good = token(b'{"alg":"HS256","typ":"JWT"}')
    assert s.find_secrets(f"x {good} y") == [(2, 2 + len(good), "signed_token")]
    for header in (b'{"typ":"JWT"}', b'{"alg":5}', b'["alg"]', b'{"alg":', b'{"a":' + b"[" * 5000):
        assert not [x for x in s.find_secrets(token(header)) if x[2] == "signed_token"]


@pytest.mark.parametrize("before", ["service_account.", "my-cookie.session.", "v1.0.", "a.b.c.d.", "eyJhIjoxfQ.", "eeeeeeeee.eyJhbGci."])
@pytest.mark.parametrize("header", [b'{"alg":"HS256"}', b'{ "alg": "none"}', b'{\n "alg":"RS256"}', b'{\t"alg":"RS256"}'])
def test_signed_tokens_behind_dots(before, header):
    good = token(header)
    spans = [x for x in s.find_secrets(f"{before}{good}, then {before}{good}") if x[2] == "signed_token"]
    first = (len(before), len(before) + len(good), "signed_token")
    again = len(before + good) + 7 + len(before)
    assert spans == [first, (again, again + len(good), "signed_token")]
    assert good not in s.redact(before + good, [first])
    # A token inside a longer word is none.
    assert not [x for x in s.find_secrets("x" + good) if x[2] == "signed_token"]


def plain_spans(text):
    """The patterns by their definition: all matches, then the short ones dropped."""
    found = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text, re.I | re.A):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for i, (kind, pattern, least) in enumerate((("access", r"AKIA[A-Z0-9]+", 16), ("hex", r"[0-9a-f]+", 32)), 1):
        found += [(m.start(), i, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [x for *_, x in sorted(found)]


TEXTS = [
    "Token: secret: abcdefgh12", "TOKEN = 'abcd'", "api_key=\"0123456789\" apikey:zzzzzzzzz", "paſſword=12345678",
    "toKen=12345678 secret=ab.cd+ef/gh", "AKIAAKIA0000 AKIA123456789012 xAKIA12345678901", "f" * 32 + "g" + "a" * 31,
    "é😀 password = " + "0" * 40, "password\n=12345678", "secret  :  =12345678", "token=token=abcdefgh",
]


def test_patterns(sample):
    for text in TEXTS + [r["text"] for r in sample]:
        base = [x for x in s.find_secrets(text) if x[2] in s.BASE_KINDS]
        assert [f"{k}:{a}:{b}" for a, b, k in base] == plain_spans(text)


def test_redacted():
    text = f"a token=abcdefgh12 b {b64(PKCS8)} c"
    assert s.redact(text, s.find_secrets(text)) == "a [SECRET] b [SECRET] c"
    assert s.redact(None, []) is None


def test_documents(spark, odd_docs):
    docs, rows = odd_docs
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    rows = rows + [(100 + i, t) for i, t in enumerate(TEXTS)]
    found = s.scan_secrets(docs.select("doc_id", "text", "class").unionByName(extra, True)).collect()
    expected = Counter()
    for doc_id, text in rows:
        base = plain_spans(text or "")
        kinds = Counter(x.split(":")[0] for x in base)
        digest = hashlib.sha256(",".join(base).encode()).hexdigest()
        expected[doc_id, kinds["assign"], kinds["access"], kinds["hex"], digest] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in found) == expected


def test_redacting_keeps_rows_and_columns(odd_docs):
    docs, rows = odd_docs
    found = s.redact_secrets(docs)
    assert found.schema.names == docs.schema.names
    assert Counter(map(str, found.collect())) == Counter(map(str, docs.collect()))


def test_no_documents(no_docs):
    assert s.scan_secrets(no_docs).collect() == [] and s.redact_secrets(no_docs).collect() == []


def test_json_nesting_is_survived():
    assert json.loads('{"a":1}') and s.find_secrets("[" * 100_000) == []
