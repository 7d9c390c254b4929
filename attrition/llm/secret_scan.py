"""Secret scan: three textual patterns, and encoded keys and tokens that are reported only once their structure parses.

Candidates for the second kind are places whose first characters can begin a
private key or a signed token in base64 or hexadecimal. They are decoded, and
every nested length of the encoding has to fit exactly.
"""

from __future__ import annotations

import base64
import binascii
import contextlib
import json
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from attrition.llm.scratch import text_rows

# Fixed by the contract: kinds in this order, their patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE_KINDS = ["assign", "access", "hex"]
ADDED_KINDS = ["pem", "der", "openssh", "jwt"]
KINDS = BASE_KINDS + ADDED_KINDS

# A SEQUENCE whose first element is the INTEGER 0 or 1, by its three length forms.
_B = "[A-Za-z0-9+/]"
DER_BASE64 = re.compile(rf"M(?:[A-H]{_B}CAQ[AE]|I[E-H]{_B}AgE[AB]|I[I-L]{_B}{_B}[AQgw]IB[AQ])")
DER_HEX = re.compile(r"30(?:[0-7][0-9a-f]|81[0-9a-f]{2}|82[0-9a-f]{4})02010[01]", re.IGNORECASE)
# A SEQUENCE that begins with a SEQUENCE of an OBJECT IDENTIFIER, as encrypted PKCS #8 keys do.
_QUAD = "[AEIMQUYcgkosw048]"
LOCKED_BASE64 = re.compile(
    rf"M(?:[A-H]{_QUAD}w[A-Za-f][AQgw]Y|I[GH]{_B}M(?:[A-H]{_QUAD}G|I[GH]{_B}B)|I[I-L]{_B}{_B}[DTjz](?:[AB]{_B}Bg|CB{_B}[AQgw]Y))"
)
LOCKED_HEX = re.compile(
    r"30(?:[0-7][0-9a-f]|81[0-9a-f]{2}|82[0-9a-f]{4})30(?:[0-7][0-9a-f]|81[0-9a-f]{2})06", re.IGNORECASE
)
# Password-based encryption of PKCS #5 and PKCS #12; a hash with its algorithm has the same structure.
LOCKS = (b"\x2a\x86\x48\x86\xf7\x0d\x01\x05", b"\x2a\x86\x48\x86\xf7\x0d\x01\x0c\x01")
OPENSSH = b"openssh-key-v1\0"
OPENSSH_BASE64, OPENSSH_HEX = "b3BlbnNzaC1rZXktdjEA", OPENSSH.hex()
PEM = re.compile(r"-----(BEGIN|END) ((?:[A-Z0-9]+ ){0,4}PRIVATE KEY)-----")
PEM_BASE64 = "LS0tLS1CRUdJTi"  # "-----BEGIN " encoded once more
JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{6,})\.(eyJ[A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]{16,})")
# Bytes of a signature by the algorithm's name; RS and PS signatures are as long as the key.
SIGNATURE = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "ES256K": 64, "EdDSA": 64}
KEY_SIZES = {128, 192, 256, 384, 512, 1024}

SCHEMA = "doc_id long, spans array<struct<kind: string, start: long, end: long>>"


class Malformed(ValueError):
    """The bytes are not the encoding they looked like."""


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int]:
    """Tag, start and end of the contents of the element at ``at``, which has to lie before ``end``."""
    if at + 2 > end:
        raise Malformed
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        width = size & 0x7F
        if not 1 <= width <= 3 or at + width > end:
            raise Malformed
        size, at = int.from_bytes(data[at : at + width], "big"), at + width
        if size < 0x80 or size >> (8 * (width - 1)) == 0:
            raise Malformed
    if at + size > end:
        raise Malformed
    return tag, at, at + size


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]]:
    found = []
    while at < end:
        found.append(_element(data, at, end))
        at = found[-1][2]
    return found


def private_key(data: bytes) -> bool:
    """Whether ``data`` is one whole RSA, DSA, EC or PKCS #8 private key."""
    try:
        tag, start, end = _element(data, 0, len(data))
        if tag != 0x30 or end != len(data):
            return False
        parts = _elements(data, start, end)
        tags = [p[0] for p in parts]
        if tags[:1] != [0x02] or parts[0][2] - parts[0][1] != 1:
            return False
        if tags == [0x02] * 9:
            widths = [p[2] - p[1] for p in parts]
            return widths[1] >= 64 and widths[4] < widths[1] and widths[5] < widths[1]
        if tags == [0x02] * 6:
            p, q, g, y, x = (b - a for _, a, b in parts[1:])
            return data[parts[0][1]] == 0 and p >= 64 and 20 <= q <= 33 and g <= p and y <= p and x <= q
        if tags[1:3] == [0x30, 0x04] and all(t in (0xA0, 0xA1, 0x81) for t in tags[3:]):
            algorithm = _elements(data, parts[1][1], parts[1][2])
            return bool(algorithm) and algorithm[0][0] == 0x06 and parts[2][2] - parts[2][1] >= 16
        if tags[1:2] == [0x04] and tags[2:] and all(t in (0xA0, 0xA1) for t in tags[2:]):
            for _, a, b in parts[2:]:
                _elements(data, a, b)
            return 20 <= parts[1][2] - parts[1][1] <= 72
        return False
    except Malformed:
        return False


def openssh_length(data: bytes) -> int | None:
    """Bytes of the key container at the start of ``data``, if all its lengths fit."""
    at = len(OPENSSH)

    def text() -> bytes:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            raise Malformed
        at += 4 + size
        return data[at - size : at]

    try:
        cipher, kdf, _ = text(), text(), text()
        count, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        if not 1 <= count <= 16 or not cipher.isascii() or not kdf.isascii():
            return None
        for _ in range(count):
            kind = text()
            if int.from_bytes(kind[:4], "big") + 4 > len(kind):
                return None
        secret = text()
        return at if secret and len(secret) % 8 == 0 else None
    except Malformed:
        return None


def _gather(text: str, start: int, count: int, alphabet: re.Pattern) -> tuple[str, int] | None:
    """``count`` characters of an encoding from ``start`` on, over line ends, and where they end."""
    pieces, have, at = [], 0, start
    while have < count:
        piece = alphabet.match(text, at, at + count - have)
        if not piece:
            line = LINE_END.match(text, at)
            if not line or not have:
                return None
            at = line.end()
            if not alphabet.match(text, at, at + 1):
                return None
            continue
        pieces.append(piece.group())
        have, at = have + len(pieces[-1]), piece.end()
    return "".join(pieces), at


# Real line ends, and those written out in a string, also in one that is quoted again.
_EOL = r"(?:\r?\n|(?:\\{1,4}r)?\\{1,4}n)"
ESCAPED_END, EOL, LINE_END = re.compile(r"(?:\\{1,4}r)?\\{1,4}n"), re.compile(_EOL), re.compile(rf"[ \t]*{_EOL}[ \t]*")
BASE64_RUN, HEX_RUN = re.compile(r"[A-Za-z0-9+/]+"), re.compile(r"[0-9A-Fa-f]+")
OPENSSH_RUN = re.compile(rf"{_B}+(?:{_EOL}{_B}+)*")
BASE64_LINES = re.compile(rf"{_B}+(?:{LINE_END.pattern}{_B}+)*")


def _declared(data: bytes) -> int:
    """Bytes of the element whose header begins ``data``."""
    width = data[1] & 0x7F if data[1] >= 0x80 else 0
    return 2 + width + (int.from_bytes(data[2 : 2 + width], "big") if width else data[1])


def _der(text: str) -> Iterator[tuple[str, int, int]]:
    yield from _encoded(text, DER_BASE64, DER_HEX, private_key)
    yield from _encoded(text, LOCKED_BASE64, LOCKED_HEX, _is_locked)


def _encoded(text: str, in_base64: re.Pattern, in_hex: re.Pattern, confirm: Callable[[bytes], bool]) -> Iterator[tuple[str, int, int]]:
    done = 0
    for hit in in_base64.finditer(text):
        if hit.start() < done:
            continue
        size = _declared(base64.b64decode(hit.group()[:8].ljust(8, "A")))
        found = _gather(text, hit.start(), -(-size * 4 // 3), BASE64_RUN)
        if found and confirm(base64.b64decode(found[0] + "A" * (-len(found[0]) % 4))[:size]):
            done = found[1] + len(re.match("={0,2}", text[found[1] : found[1] + 2]).group())
            yield "der", hit.start(), done
    done = 0
    for hit in in_hex.finditer(text):
        if hit.start() < done:
            continue
        size = _declared(bytes.fromhex(hit.group()))
        found = _gather(text, hit.start(), 2 * size, HEX_RUN)
        if found and confirm(bytes.fromhex(found[0])):
            done = found[1]
            yield "der", hit.start(), done


def _openssh(text: str) -> Iterator[tuple[str, int, int]]:
    for mark, run, decode, per in ((OPENSSH_BASE64, OPENSSH_RUN, base64.b64decode, 4 / 3), (OPENSSH_HEX, HEX_RUN, bytes.fromhex, 2)):
        at = text.find(mark)
        while at >= 0:
            end, size = at + len(mark), None
            # The cipher's name is short: a look at its length spares reading a long run for each mark in it.
            name = EOL.sub("", run.match(text, at, at + 80).group())[:40]
            if int.from_bytes(decode(name)[len(OPENSSH) : len(OPENSSH) + 4], "big") <= 64:
                body = EOL.sub("", run.match(text, at).group())
                with contextlib.suppress(ValueError):
                    size = openssh_length(decode(body[: len(body) // 4 * 4]))
            if size:
                found = _gather(text, at, -int(-size * per // 1), BASE64_RUN if per < 2 else HEX_RUN)
                if found:
                    end = found[1]
                    yield "openssh", at, end
            at = text.find(mark, end)


def _pem(text: str) -> Iterator[tuple[str, int, int]]:
    opened = None
    for hit in PEM.finditer(text):
        if hit.group(1) == "BEGIN":
            opened = hit
            continue
        begun, opened = opened, None
        if begun is None or begun.group(2) != hit.group(2):
            continue
        body = ESCAPED_END.sub("\n", text[begun.end() : hit.start()])
        heads = re.match(r"\s*(?:[A-Za-z-]+: [^\n]*\n)*", body).group()
        try:
            data = base64.b64decode(re.sub(r"\s+", "", body[len(heads) :]), validate=True)
        except binascii.Error:
            continue
        locked = "ENCRYPTED" in heads and len(data) >= 16 and len(data) % 8 == 0
        wrapped = hit.group(2).startswith("ENCRYPTED") and _is_wrapped(data)
        if locked or wrapped or private_key(data) or (data.startswith(OPENSSH) and openssh_length(data) == len(data)):
            yield "pem", begun.start(), hit.end()


def _pem_again(text: str) -> Iterator[tuple[str, int, int]]:
    """Blocks in base64 text that begins with an encoded block's first mark."""
    at = text.find(PEM_BASE64)
    while at >= 0:
        run = BASE64_LINES.match(text, at)
        offsets, places = [0], [at]  # each line's first character without and with the line ends
        for line in LINE_END.finditer(text, at, run.end()):
            offsets.append(offsets[-1] + line.start() - places[-1])
            places.append(line.end())
        code, first, tried = LINE_END.sub("", run.group()), 0, set()
        while first >= 0 and len(tried) < 4:
            if first % 4 not in tried:
                tried.add(first % 4)
                part = code[first:]
                inner = base64.b64decode(part + "A" * (-len(part) % 4)).decode("latin-1")
                for _, a, b in _pem(inner):
                    b += len(re.match(r"(?:\r?\n)?", inner[b : b + 2]).group())
                    begin, last = first + a * 4 // 3, first - (-b * 4 // 3) - 1
                    if last >= len(code):
                        continue
                    begin, last = (places[(n := bisect_right(offsets, x) - 1)] + x - offsets[n] for x in (begin, last))
                    yield "pem", begin, last + 1 + len(re.match("={0,2}", text[last + 1 : last + 3]).group())
            first = code.find(PEM_BASE64, first + 1)
        at = text.find(PEM_BASE64, run.end())


def _is_locked(data: bytes) -> bool:
    """An encrypted PKCS #8 key by its algorithm."""
    if not _is_wrapped(data):
        return False
    try:
        _, start, end = _element(data, 0, len(data))
        _, start, end = _element(data, start, end)
        tag, start, end = _element(data, start, end)
    except Malformed:
        return False
    return tag == 0x06 and data[start:end].startswith(LOCKS)


def _is_wrapped(data: bytes) -> bool:
    """An encrypted PKCS #8 key: an algorithm and an octet string."""
    try:
        tag, start, end = _element(data, 0, len(data))
        return tag == 0x30 and end == len(data) and [e[0] for e in _elements(data, start, end)] == [0x30, 0x04]
    except Malformed:
        return False


def _url_decode(part: str) -> bytes:
    return base64.b64decode(part.replace("-", "+").replace("_", "/") + "=" * (-len(part) % 4), validate=True)


def _jwt(text: str) -> Iterator[tuple[str, int, int]]:
    for hit in JWT.finditer(text):
        try:
            head, body = (json.loads(_url_decode(hit.group(i))) for i in (1, 2))
            signature = _url_decode(hit.group(3))
        except (ValueError, RecursionError):
            continue
        name = head.get("alg") if isinstance(head, dict) else None
        if isinstance(name, str) and isinstance(body, dict):
            if len(signature) == SIGNATURE.get(name) or (name[:2] in ("RS", "PS") and len(signature) in KEY_SIZES):
                yield "jwt", hit.start(), hit.end()


def scan(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text, by start, then by the order of ``KINDS``; offsets are code points, ends exclusive."""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text)]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    if "-----BEGIN" in text:
        spans += _pem(text)
    if PEM_BASE64 in text:
        spans += _pem_again(text)
    blocks = [s for s in spans if s[0] == "pem"]
    inside = [*_der(text), *_openssh(text)]
    spans += [s for s in inside if not any(b[1] <= s[1] < b[2] for b in blocks)]
    if "eyJ" in text:
        spans += _jwt(text)
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        ids, texts = batch.columns
        rows = [[dict(zip(("kind", "start", "end"), s)) for s in scan(t.as_py() or "")] for t in texts]
        yield pa.RecordBatch.from_arrays([ids, pa.array(rows, pa.list_(span))], ["doc_id", "spans"])


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` for every row: the spans of its whole text, in order.

    Null and empty texts have no spans; repeated rows give repeated results; rows with a
    null id are scanned like others. Each row is judged alone, so nothing is shuffled.
    """
    picked = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text")
    text_rows(docs.sparkSession)
    return picked.mapInArrow(_scan_batches, SCHEMA)
