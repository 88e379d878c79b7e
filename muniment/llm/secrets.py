"""Secret scans: patterns for common forms, and structural confirmation of encoded keys and tokens.

A base64 or hex candidate is decoded and parsed before it is reported: as DER with nested lengths that fill their
parents exactly and the shape of a private key, as an OpenSSH or SSH wire key with the length-prefixed strings of a private key, or, for a token, as a JSON
header that names an algorithm and a JSON payload (signed), or parts of the right lengths (encrypted). Armoured keys may have header lines: a body that these
call encrypted is confirmed by its cipher and length, a PGP block by its packets. Base64 without armour is joined over its lines; hex digits may stand in pairs
with colons. What decodes to text is searched again, and again, until nothing decodes: the span is that of the outer candidate, the kind that of what it holds.
Public keys and certificates are no secrets.

Defined results: null and empty texts have no secrets; equal rows get equal results; an empty table gives an empty result.
Spans are in code points, the end exclusive, in order of start and then kind as listed in ``KINDS``.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

from pyspark.sql import DataFrame

from muniment.llm.common import map_texts, map_whole_rows

#: The first three are the base patterns; the rest are confirmed by their structure.
KINDS = ("assign", "access", "hex", "jwt", "pem", "der", "ssh")

ADDED = "spans array<struct<kind: string, start: int, end: int>>"

# The base patterns.
ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")

_CUES = (b"passw", b"secret", b"token", b"api_key", b"apikey")
_JWT = re.compile(rb"eyJ[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]*){2,4}")
_PEM = re.compile(rb"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY|PGP PRIVATE KEY BLOCK)-----((?:[^-]|-(?!----))*+)-----END \1-----")
_HEADER = re.compile(rb"[A-Za-z0-9-]+:(?:\s|$)")
_CHECKSUM = re.compile(rb"=[A-Za-z0-9+/]{4}")
_DEK = re.compile(rb"DEK-Info:\s*([A-Z0-9-]+),\s*([0-9A-Fa-f]+)")
_BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{40,}={0,2}")
#: Where a key may begin inside of a run, behind a sign that joins it to a name: DER, wire, OpenSSH, armour, token.
_INNER_START = re.compile(rb"(?<=[_/+-])(?:M[A-P]|AAAA|b3BlbnNzaC1r|LS0tLS1CRUdJTi|ZXlK)")
#: The first line of a key in base64 over several lines (DER sequence, wire string, OpenSSH magic), and lines after it.
_WRAPPED = re.compile(rb"(?<![A-Za-z0-9+/_=-])(?:M[A-P]|AAAA|b3BlbnNzaC1r|LS0tLS1CRUdJTi)[A-Za-z0-9+/_-]{8,}(?=[\x20\t]*(?:\r?\n|(?:\\r)?\\n))")
_NEXT_LINE = re.compile(rb"[\x20\t]*(?:\r?\n|(?:\\r)?\\n)[\x20\t]*([A-Za-z0-9+/_-]+)(={0,2})")
_HEX_RUN = re.compile(rb"[0-9a-fA-F]{48,}")
_COLON_HEX = re.compile(rb"(?<![0-9a-fA-F:])(?:[0-9a-fA-F]{2}:[\x20\t]*(?:\r?\n[\x20\t]*)?){23,}[0-9a-fA-F]{2}(?![0-9a-fA-F])")
_PLAIN = re.compile(rb"[\t\n\r\x20-\x7e]+")
# Strings in a private wire key, its name among them.
PRIVATE_STRINGS = {b"ssh-rsa": 7, b"ssh-dss": 6, b"ssh-ed25519": 3, b"ecdsa-sha2-nistp256": 4, b"ecdsa-sha2-nistp384": 4, b"ecdsa-sha2-nistp521": 4}
_HEX_KEY = re.compile(rb"(?:30[0-9a-f]{62,}|30[0-9A-F]{62,})")


def decode64(text: bytes) -> bytes | None:
    text = re.sub(rb"\s|\\n", b"", text).rstrip(b"=").translate(bytes.maketrans(b"-_", b"+/"))
    try:
        return base64.b64decode(text + b"=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _unhex(text: bytes) -> bytes:
    text = re.sub(rb"[:\s]", b"", text)
    return bytes.fromhex(text[: len(text) // 2 * 2].decode())


def der_tree(data: bytes, depth: int = 0) -> list | None:
    """(tag, children or bytes) of each element if the lengths fill ``data`` exactly, else None."""
    at, out = 0, []
    while at < len(data):
        if at + 2 > len(data) or depth > 12:
            return None
        tag, length = data[at], data[at + 1]
        at += 2
        if length & 0x80:
            n = length & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            length = int.from_bytes(data[at : at + n], "big")
            at += n
        if at + length > len(data):
            return None
        body = data[at : at + length]
        at += length
        if tag & 0x20:
            body = der_tree(body, depth + 1)
            if body is None:
                return None
        out.append((tag, body))
    return out


def is_der_key(data: bytes | None) -> bool:
    """A private key: a small version number and at least two more elements, or a cipher and the encrypted octets."""
    if not data or len(data) < 24 or data[0] != 0x30:
        return False
    tree = der_tree(data)
    if not tree or len(tree) != 1 or len(tree[0][1]) < 2:
        return False
    first, second, *more = tree[0][1]
    if first[0] == 0x02:  # two numbers alone are a public key, which has no version
        return len(first[1]) == 1 and first[1][0] <= 3 and (second[0] == 0x04 or bool(more))
    return first[0] == 0x30 and second[0] == 0x04 and bool(first[1]) and first[1][0][0] == 0x06


def is_ssh_key(data: bytes | None) -> bool:
    """OpenSSH private keys by their magic, private wire keys by a known algorithm and as many strings as it has, which fill the value exactly."""
    if not data:
        return False
    if data.startswith(b"openssh-key-v1\0"):
        return True
    at, fields = 0, []
    while at + 4 <= len(data):
        n = int.from_bytes(data[at : at + 4], "big")
        if n > len(data) - at - 4:
            return False
        fields.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return at == len(data) and bool(fields) and PRIVATE_STRINGS.get(fields[0]) == len(fields)


def is_pgp_key(data: bytes | None) -> bool:
    """Packets whose lengths fill the value exactly, a secret key of a known version first."""
    if not data:
        return False
    at, tags = 0, []
    while at < len(data):
        head = data[at]
        if not head & 0x80:
            return False
        at += 1
        tag, body, more = (head & 0x3F, b"", True) if head & 0x40 else (head >> 2 & 0xF, b"", False)
        if head & 0x40:
            while more:
                if at >= len(data):
                    return False
                first = data[at]
                if first < 192:
                    n, wide, more = first, 1, False
                elif first < 224:
                    n, wide, more = (first - 192 << 8) + int.from_bytes(data[at + 1 : at + 2], "big") + 192, 2, False
                elif first < 255:
                    n, wide = 1 << (first & 0x1F), 1  # a part; another length follows
                else:
                    n, wide, more = int.from_bytes(data[at + 1 : at + 5], "big"), 5, False
                if at + wide + n > len(data):
                    return False
                body = body or data[at + wide : at + wide + n]
                at += wide + n
        else:
            wide = (1, 2, 4, 0)[head & 3]
            n = int.from_bytes(data[at : at + wide], "big") if wide else len(data) - at
            if at + wide + n > len(data):
                return False
            body = data[at + wide : at + wide + n]
            at += wide + n
        if not tags and (tag not in (5, 7) or not body or not 2 <= body[0] <= 6):
            return False
        tags.append(tag)
    return bool(tags)


def is_armoured_key(label: bytes, inner: bytes) -> bool:
    """A body in armour: header lines first, then base64, for PGP with a checksum line."""
    lines = [x.strip() for x in re.sub(rb"(?:\\r)?\\n", b"\n", inner).split(b"\n")]
    while lines and not lines[0]:
        lines.pop(0)
    while lines and not lines[-1]:
        lines.pop()
    headers = []
    if lines and _HEADER.match(lines[0]):  # up to a blank line, or without one as long as lines are headers
        blank = lines.index(b"") if b"" in lines else next((i for i, x in enumerate(lines) if not _HEADER.match(x)), len(lines))
        headers, lines = lines[:blank], lines[blank:]
    if b"PGP" in label and lines and _CHECKSUM.fullmatch(lines[-1]):
        lines.pop()
    data = decode64(b"".join(lines))
    if b"PGP" in label:
        return is_pgp_key(data)
    if any(x.startswith(b"Proc-Type:") and b"ENCRYPTED" in x for x in headers):
        dek = next((m for x in headers if (m := _DEK.match(x))), None)
        size = len(dek[2]) // 2 if dek else 0  # the start value is as long as a cipher's block, or 8 bytes of salt
        return size in (8, 16) and len(dek[2]) % 2 == 0 and bool(data) and len(data) >= 24 and len(data) % size == 0
    return is_der_key(data) or is_ssh_key(data)


def wrapped_keys(text: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes of keys in base64 that go over several lines without armour.

    The lengths in the key tell where it ends; there a line, too, must end its base64.
    """
    found: list[tuple[str, int, int]] = []
    done = 0
    for m in _WRAPPED.finditer(text):
        if m.start() < done:
            continue
        want, head = None, decode64(m[0][: len(m[0]) // 4 * 4]) or b""
        armour = head.startswith(b"-----BEGIN")
        if head[:1] == b"\x30":
            wide = head[1] & 0x7F if head[1] & 0x80 else 0
            inner = 2 + wide
            if head[1] == 0x80 or wide > 4 or head[inner : inner + 1] not in (b"\x02", b"\x06", b"\x30"):
                continue
            want = inner + (int.from_bytes(head[2:inner], "big") if wide else head[1])
        elif not (armour or head.startswith(b"openssh-k") or re.match(rb"\0\0\0.(?:sk-)?(?:ssh|ecd)", head, re.S)):
            continue
        parts, ends, size, at = [m[0]], [], len(m[0]), m.end()
        while (want is None or size * 3 // 4 < want) and (line := _NEXT_LINE.match(text, at)):
            parts.append(line[1])
            size, at = size + len(line[1]), line.end()
            ends.append((size, at))
            if line[2]:
                break
        if not ends:
            continue
        if want is not None:
            if size * 3 // 4 == want and is_der_key(decode64(b"".join(parts))):
                found.append(("der", m.start(), at))
                done = at
            continue
        if armour:  # lines of text: the longest that decodes to a secret
            for n, end in reversed(ends):
                if kind := confirmed(decode64(b"".join(parts)[:n])):
                    found.append((kind, m.start(), end))
                    done = end
                    break
            continue
        sizes = {n * 3 // 4: end for n, end in ends if n % 4 != 1}
        data = decode64((b"".join(parts))[: max((n for n, _ in ends if n % 4 != 1), default=0)]) or b""
        end = max((sizes[n] for n in _ssh_ends(data) if n in sizes), default=None)
        if end is not None:
            found.append(("ssh", m.start(), end))
            done = end
    return found


def _ssh_ends(data: bytes) -> list[int]:
    """Where an OpenSSH or wire key in front of ``data`` may end: behind its private part, or behind a string."""
    magic = data.startswith(b"openssh-key-v1\0")
    at, fields, first, ends = 15 * magic, 0, b"", []
    left = None
    while at + 4 <= len(data):
        n = int.from_bytes(data[at : at + 4], "big")
        if magic and fields == 3 and left is None:  # the number of keys; as many public parts and one private part follow
            left, at = n + 1, at + 4
            continue
        if n > len(data) - at - 4:
            break
        first = first or data[at + 4 : at + 4 + n]
        at, fields = at + 4 + n, fields + 1
        if magic:
            left = None if left is None else left - 1
            if left == 0:
                return [at]
        elif fields == PRIVATE_STRINGS.get(first):
            ends.append(at)
    return ends


def is_token(text: bytes) -> bool:
    """A signed token: the header is a JSON object with an algorithm, the payload a JSON object."""
    header, payload, _ = text.split(b".", 2)
    try:
        head, body = (json.loads(decode64(x) or b"") for x in (header, payload))
    except (ValueError, UnicodeDecodeError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def is_encrypted_token(text: bytes) -> bool:
    """Five parts: a JSON header with an algorithm and a cipher, a key or none, a start value, what is encrypted, and its tag."""
    header, *parts = text.split(b".")
    try:
        head = json.loads(decode64(header) or b"")
    except (ValueError, UnicodeDecodeError, RecursionError):
        return False
    data = [decode64(p) for p in parts]
    if len(data) != 4 or None in data or not isinstance(head, dict):
        return False
    named = isinstance(head.get("alg"), str) and isinstance(head.get("enc"), str)
    return named and len(data[1]) in (12, 16) and len(data[2]) > 0 and len(data[3]) in (16, 24, 32)


def confirmed(data: bytes | None) -> str | None:
    """The kind of secret that decoded bytes are, or that their text holds."""
    if is_der_key(data):
        return "der"
    if is_ssh_key(data):
        return "ssh"
    if data and len(data) >= 30 and _PLAIN.fullmatch(data):
        # Each decoding is a quarter shorter at least, so this ends.
        return next((kind for kind, _, _ in structured(data)), None)
    return None


def structured(text: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes of what its structure confirms."""
    found: list[tuple[str, int, int]] = []
    if b"eyJ" in text:
        for m in _JWT.finditer(text):
            parts = m[0].split(b".")
            if len(parts) == 5 and is_encrypted_token(m[0]):
                found.append(("jwt", *m.span()))
            elif is_token(signed := b".".join(parts[:3])):
                found.append(("jwt", m.start(), m.start() + len(signed)))
    if b"-----BEGIN" in text:
        found += [("pem", *m.span()) for m in _PEM.finditer(text) if is_armoured_key(m[1], m[2])]
    inside = [(a, b) for _, a, b in found]
    found += [x for x in wrapped_keys(text) if not any(a <= x[1] and x[2] <= b for a, b in inside)]
    taken = [(a, b) for _, a, b in found]
    candidates = []
    for m in _BASE64.finditer(text):
        if any(48 <= c <= 57 for c in m[0]) or any(65 <= c <= 90 for c in m[0][1:]):  # not plain long words
            candidates.append((*m.span(), decode64))
            candidates += [(k.start(), m.end(), decode64) for k in _INNER_START.finditer(text, *m.span())]
    for m in _HEX_RUN.finditer(text):
        candidates += [(*span, _unhex) for span in sorted({m.span(), *(k.span() for k in _HEX_KEY.finditer(text, *m.span()))})]
    candidates += [(*m.span(), _unhex) for m in _COLON_HEX.finditer(text)]
    for start, end, decoded in candidates:
        if not any(a <= start and end <= b for a, b in taken) and (kind := confirmed(decoded(text[start:end]))):
            found.append((kind, start, end))
    return found


def find(text: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points."""
    found: list[tuple[str, int, int]] = []
    low = text.lower()
    if any(c in low for c in _CUES):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    if b"AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    found += structured(text)
    if found and not text.isascii():
        found = [(k, len(text[:a].decode("utf-8", "replace")), len(text[:b].decode("utf-8", "replace"))) for k, a, b in found]
    return sorted(set(found), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id and its secrets' spans. Map only."""
    return map_texts(docs, [id_col], text_col, ADDED, lambda: lambda texts: {"spans": [[{"kind": k, "start": a, "end": b} for k, a, b in find(t)] for t in texts]})


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by the kind of its first."""
    out, at, end = [], 0, -1
    for kind, a, b in spans:
        if a >= end:
            out += [text[at:a] if a > at else "", f"[{kind}]"]
            at = end = b
        elif b > end:
            at = end = b
    return "".join(out) + text[at:]


def mask_secrets(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """Whole rows; in texts with secrets these are replaced by their kind in brackets, and the length column follows. Map only."""

    def fn(texts: list[bytes]) -> dict:
        spans = [find(t) for t in texts]
        new = [masked(t.decode("utf-8", "replace"), s) if s else None for t, s in zip(texts, spans)]
        sizes = {length_col: [None if x is None else len(x) for x in new]} if length_col in docs_columns else {}
        return {"replace": {text_col: new, **sizes}}

    docs_columns = docs.columns
    return map_whole_rows(docs, text_col, lambda: fn)
