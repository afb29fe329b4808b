"""Secrets in texts: patterns, and keys that their own structure confirms.

The patterns (``assign``, ``access``, ``hex``) are reported as they match. Beyond
them, runs of base64 or hexadecimal digits are decoded, and reported only if what
comes out is a private key or a signed token by its structure: nested lengths that
add up to the last byte, the fields of a key encoding, a token's header.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlookup.llm.batches import map_slices

# The pattern kinds in the order in which they are listed.
BASE_KINDS = ("assign", "access", "hex")
# Kinds confirmed by structure, listed after them.
KEY_KINDS = ("rsa_key", "pkcs8_key", "encrypted_key", "ec_key", "openssh_key", "signed_token")
KINDS = (*BASE_KINDS, *KEY_KINDS)

REDACTED = "[SECRET]"

# What the three patterns match.
_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ASSIGN_LENGTH = 8
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")

# Candidates for decoding: lines of base64 with nothing but line ends and indents between
# them. A key begins with a line of 40 or more, as the DER or OpenSSH head is written.
_BASE64_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}(?:[\r\n]+[ \t]*[A-Za-z0-9+/_-]+)*")
_KEY_HEAD = re.compile(r"M[A-P]|b3BlbnNzaC1rZXktdjEA")
_FIRST_LINE = 40

# Line ends of texts inside strings, also of strings inside strings, and the lines around
# a key; neither is base64, though letters of them are.
_ESCAPE = re.compile(r"\\+[rn]")
_ARMOUR = re.compile(r"-----(?:BEGIN|END)[A-Z0-9 ]*-----")
_HEX_BYTES = re.compile(r"(?:[0-9A-Fa-f]{2}){24,}")
# Tokens, from every dotted part on, as other parts may stand before the header. A brace and a
# quote, blank or line end begin with these letters in base64.
_SIGNED = re.compile(r"e(?<![A-Za-z0-9_-]e)(?=([yw][A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*))")

_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30
_MAX_DEPTH = 16

Span = tuple[int, int, str]


def _values(data: bytes) -> list[tuple[int, bytes]] | None:
    """The values of a DER encoding, or None unless their lengths add up to its end."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data) or data[at] & 0x1F == 0x1F:
            return None
        tag, length = data[at], data[at + 1]
        at += 2
        if length >= 0x80:
            n = length & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            length = int.from_bytes(data[at : at + n])
            if length < 0x80 or (n > 1 and data[at] == 0):
                return None  # not the shortest form
            at += n
        if at + length > len(data):
            return None
        found.append((tag, data[at : at + length]))
        at += length
    return found


def _well_nested(values: list[tuple[int, bytes]], depth: int = 0) -> bool:
    if depth > _MAX_DEPTH:
        return False
    for tag, value in values:
        if tag in (_INTEGER, _OID) and not value:
            return False
        if tag & 0x20:
            inner = _values(value)
            if inner is None or not _well_nested(inner, depth + 1):
                return False
    return True


def der_key(data: bytes) -> str | None:
    """The kind of private key that a DER encoding is, if any."""
    outer = _values(data)
    if not outer or len(outer) != 1 or outer[0][0] != _SEQUENCE or not _well_nested(outer):
        return None
    fields = _values(outer[0][1])
    tags = [tag for tag, _ in fields]
    if tags[:1] == [_INTEGER]:
        version = fields[0][1]
        if version in (b"\0", b"\1") and len(tags) >= 9 and set(tags[:9]) == {_INTEGER}:
            return "rsa_key"
        if version == b"\1" and tags[1:2] == [_OCTETS] and 16 <= len(fields[1][1]) <= 66:
            return "ec_key"
        if version in (b"\0", b"\1") and tags[1:3] == [_SEQUENCE, _OCTETS] and _algorithm(fields[1][1]):
            return "pkcs8_key"
    # SEQUENCE { AlgorithmIdentifier with parameters, OCTET STRING }
    if tags == [_SEQUENCE, _OCTETS] and _algorithm(fields[0][1]) and len(fields[1][1]) >= 16:
        return "encrypted_key"
    return None


def _algorithm(data: bytes) -> bool:
    fields = _values(data)
    return bool(fields) and fields[0][0] == _OID


def _strings(data: bytes, n: int) -> tuple[list[bytes], int] | None:
    """``n`` strings with 4-byte lengths before them, and where they end."""
    found, at = [], 0
    for _ in range(n):
        length = int.from_bytes(data[at : at + 4])
        if at + 4 > len(data) or at + 4 + length > len(data):
            return None
        found.append(data[at + 4 : at + 4 + length])
        at += 4 + length
    return found, at


_OPENSSH = b"openssh-key-v1\0"


def openssh_key(data: bytes) -> str | None:
    """``openssh_key`` for the container of private keys, if its lengths add up."""
    if not data.startswith(_OPENSSH):
        return None
    data = data[len(_OPENSSH) :]
    head = _strings(data, 3)  # cipher, key derivation, its options
    if head is None or not head[0][0]:
        return None
    rest = data[head[1] :]
    keys = int.from_bytes(rest[:4])
    if len(rest) < 4 or not 1 <= keys <= 16:
        return None
    body = _strings(rest[4:], keys + 1)  # public keys, private part
    return "openssh_key" if body and body[1] == len(rest) - 4 and body[0][-1] else None


def _base64(text: str) -> bytes | None:
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except binascii.Error:
        return None


def key_kind(data: bytes) -> str | None:
    return der_key(data) or openssh_key(data)


def _part(text: str, start: int, end: int) -> bytes:
    """The bytes ``start`` to ``end`` of what base64 stands for, as far as it goes."""
    part = text[start // 3 * 4 : -(-end // 3) * 4]
    data = _base64(part[: len(part) - (len(part) % 4 == 1)]) or b""
    return data[start % 3 : start % 3 + end - start]


def _stated_length(text: str) -> int | None:
    """How many bytes the key is long with which base64 begins, as its head has it."""
    head = _part(text, 0, 6)
    if head[:1] == bytes([_SEQUENCE]) and len(head) == 6:
        n = head[1] & 0x7F if head[1] >= 0x80 else 0
        return 2 + n + int.from_bytes(head[2 : 2 + n]) if 1 <= n <= 4 else 2 + head[1] if not n else None
    at = len(_OPENSSH)
    if _part(text, 0, at) != _OPENSSH:
        return None
    left = 3  # cipher, key derivation, its options
    counted = False
    while left or not counted:
        field = _part(text, at, at + 4)
        if len(field) < 4:
            return None
        at += 4
        if left:
            at, left = at + int.from_bytes(field), left - 1
        else:
            left, counted = int.from_bytes(field) + 1, True  # public keys, private part
            if left > 17:
                return None
    return at


def _base64_keys(text: str) -> Iterator[Span]:
    """Keys in lines of base64. A key ends where its head says, at the end of a line;
    what lies on the lines before and behind is not part of it."""
    plain = _ESCAPE.sub(lambda m: "\n" * len(m[0]), text) if "\\" in text else text
    if "-----" in plain:
        plain = _ARMOUR.sub(lambda m: "." * len(m[0]), plain)
    for m in _BASE64.finditer(plain):
        lines = [x.span() for x in _BASE64_LINE.finditer(plain, *m.span())]
        joined, offsets = "".join([plain[a:b] for a, b in lines]), {}
        at = 0
        for i, (a, b) in enumerate(lines):
            offsets[at + b - a] = i
            at += b - a
        at = done = 0
        for a, b in lines:
            first, at = at, at + b - a
            if first < done or b - a < _FIRST_LINE or not _KEY_HEAD.match(plain, a):
                continue
            length = _stated_length(joined[first:])
            last = first - (-length * 4 // 3) if length else 0
            if last not in offsets:
                continue
            data = _base64(joined[first:last])
            if data is not None and (kind := key_kind(data)):
                end = lines[offsets[last]][1]
                padding = (first - last) % 4
                yield a, end + padding * plain.startswith("=" * padding, end), kind
                done = last


def _signed(token: str) -> bool:
    """Whether a token's first part is the header of a signed one: a JSON object
    that names its algorithm. Its second part has to decode as well."""
    header, body, _ = token.split(".")
    head, payload = _base64(header), _base64(body)
    if not head or not head.startswith(b"{") or payload is None:
        return False
    try:
        fields = json.loads(head)
    except (ValueError, RecursionError):
        return False
    return isinstance(fields, dict) and isinstance(fields.get("alg"), str)


def base_spans(text: str) -> Iterator[Span]:
    """What the patterns match: leftmost, not overlapping within a kind."""
    for m in _ASSIGN.finditer(text):
        if m.end(1) - m.start(1) >= _ASSIGN_LENGTH:
            yield m.start(), m.end(), "assign"
    for m in _ACCESS.finditer(text):
        yield m.start(), m.end(), "access"
    for m in _HEX.finditer(text):
        yield m.start(), m.end(), "hex"


def confirmed_spans(text: str) -> Iterator[Span]:
    """Keys and tokens that decode to what they must be."""
    yield from _base64_keys(text)
    for m in _HEX_BYTES.finditer(text):
        if kind := key_kind(bytes.fromhex(m[0])):
            yield m.start(), m.end(), kind
    if "." in text:
        done = 0
        for m in _SIGNED.finditer(text):
            if m.start() >= done and _signed(m[0] + m[1]):
                done = m.end(1)
                yield m.start(), done, "signed_token"


def find_secrets(text: str | None) -> list[Span]:
    """All spans ``(start, end, kind)`` in code points, by start, then as listed."""
    text = text or ""
    return sorted([*base_spans(text), *confirmed_spans(text)], key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with every stretch that spans cover replaced, once if they overlap."""
    parts, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], REDACTED]
        at = max(at, end)
    return text if not spans else "".join(parts) + text[at:]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


REPORT = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long, redacted string"
)


def scan_secrets(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """A row per document with the secrets in its whole text.

    ``docs`` has ``doc_id`` and ``text``, other columns are not read; a NULL text is
    empty, and has no span. ``spans`` is ``kind:start:end`` of all, ``base_sha256`` the
    hash of those of the patterns in that form (of the empty string without any).
    ``redacted`` is the text without them, NULL unless ``with_text``. Repeated rows have
    a row each; an empty table gives none. Nothing is shuffled.
    """

    def scan(doc_ids: list, texts: list) -> dict:
        found = [find_secrets(text) for text in texts]
        base = [[s for s in spans if s[2] in BASE_KINDS] for spans in found]
        counts = {f"n_{k}": [sum(s[2] == k for s in spans) for spans in base] for k in BASE_KINDS}
        return {
            "doc_id": doc_ids,
            **counts,
            "base_sha256": [hashlib.sha256(_joined(spans).encode()).hexdigest() for spans in base],
            "spans": [_joined(spans) for spans in found],
            "n_confirmed": [len(spans) - len(kept) for spans, kept in zip(found, base)],
            "redacted": [redact(t, s) if with_text else None for t, s in zip(texts, found)],
        }

    return map_slices(docs.select("doc_id", "text"), scan, REPORT)


def redact_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns, with every secret in ``text`` replaced."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text)

    def run(*columns: list) -> dict:
        found = dict(zip(names, columns))
        found[names[at]] = [redact(t, find_secrets(t)) for t in columns[at]]
        return found

    plain = docs.toDF(*names)
    return map_slices(plain, run, plain.schema).select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
