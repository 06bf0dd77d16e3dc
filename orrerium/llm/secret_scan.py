"""Secrets by structural confirmation.

Runs of hex digits and of base64 (over lines too) are decoded in every alignment, and each place of the bytes at which a
key may begin is parsed: ASN.1 key encodings whose nested lengths must fill their parents exactly, and OpenSSH keys by
their magic and length fields. A key so is found in either case of hex and wherever it stands within a run. Signed
tokens must have a JSON header that names an algorithm and a JSON body. Only what parses is added to the base spans, which
stay as they are. Every step takes time in proportion to the text.

Spans are `kind:start:end` in code points, end exclusive, by start, then kind as listed in KINDS.

Defined cases: a null or empty text has no spans; broken base64, wrong lengths and truncated structures add none, but for
an OpenSSH key whose header is whole: it reaches to the end of its line.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "pem", "key")

SEPARATOR = re.compile(r"[:=]")
NAMED = re.compile(r"(?:password|passwd|secret|token|api_?key)\Z", re.ASCII | re.IGNORECASE)
VALUE = re.compile(r"\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"[A-Za-z0-9_.-]+")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----((?:[A-Za-z0-9+/=\s]|\\[rn])++)-----END \1-----")
ANY_HEX = re.compile(r"[0-9A-Fa-f]{24,}")
#: Base64 on one line or on consecutive ones, and its lines.
BLOCK = re.compile(r"[A-Za-z0-9+/_-]{40,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)*+={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
STANDARD = str.maketrans("-_", "+/")
MAGIC = b"openssh-key-v1\0"
#: How a key begins in bytes: OpenSSH's magic, or a sequence of which the first member is a version or a sequence.
BEGINS = re.compile(rb"openssh-key-v1\0|\x30(?=(?:[\x0e-\x7f]|\x81.|\x82..|\x83...)(?:\x02\x01[\x00\x01]|\x30))", re.DOTALL)
#: Members that a sequence of a private key has at most.
MEMBERS = 12


def decoded(text: str) -> bytes:
    """Bytes of base64 or base64url text, or none if it isn't whole."""
    text = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        return b""
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def value_at(data, at: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the ASN.1 DER value at a place; None if it doesn't lie within the data."""
    if at + 2 > len(data):
        return None
    tag, size = data[at], data[at + 1]
    at += 2
    if size >= 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > len(data):
            return None
        size = int.from_bytes(data[at : at + n], "big")
        at += n
    return (tag, at, at + size) if at + size <= len(data) else None


def parts(data) -> list[tuple[int, memoryview]] | None:
    """Tags and contents of at most MEMBERS values that fill the data exactly; None if they don't."""
    data, out, at = memoryview(data), [], 0
    while at < len(data):
        value = value_at(data, at)
        if value is None or len(out) == MEMBERS:
            return None
        tag, start, at = value
        out.append((tag, data[start:at]))
    return out


INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def openssh_size(data) -> int | None:
    """Bytes of the OpenSSH key that the data begins with, as its length fields say; None if its header isn't whole."""
    at = len(MAGIC)
    for _ in range(3):  # cipher, key derivation and its options
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    if at + 4 > len(data) or not 1 <= (n := int.from_bytes(data[at : at + 4], "big")) <= 16:
        return None
    at += 4
    for _ in range(n + 1):  # the public keys and the private part
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at


def private_key(data) -> bool:
    """True for a PKCS#1, PKCS#8 (plain or encrypted) or SEC1 private key, or one in OpenSSH's format."""
    if bytes(data[: len(MAGIC)]) == MAGIC:
        return openssh_size(data) is not None
    outer = parts(data)
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    inner = parts(outer[0][1])
    if not inner:
        return False
    tags = [tag for tag, _ in inner]
    if tags[:9] == [INTEGER] * 9:
        return inner[0][1] in (b"\0", b"\1") and len(inner[1][1]) >= 32
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:
        algorithm = parts(inner[1][1])
        return inner[0][1] in (b"\0", b"\1") and bool(algorithm) and algorithm[0][0] == OID and len(inner[2][1]) >= 16
    if tags[:2] == [INTEGER, OCTETS]:
        return inner[0][1] == b"\1" and 16 <= len(inner[1][1]) <= 66
    if tags == [SEQUENCE, OCTETS]:
        algorithm = parts(inner[0][1])
        return bool(algorithm) and algorithm[0][0] == OID and len(inner[1][1]) >= 16
    return False


def keys_in(data: bytes) -> Iterator[tuple[int, int]]:
    """Start and end of each private key within bytes, wherever it begins; keys within keys too. The end of an OpenSSH key
    may lie beyond the data."""
    whole = memoryview(data)
    for m in BEGINS.finditer(data):
        at = m.start()
        if m[0] == MAGIC:
            if (size := openssh_size(whole[at:])) is not None:
                yield at, at + size
        elif (value := value_at(whole, at)) and private_key(whole[at : value[2]]):
            yield at, value[2]


def hex_keys(text: str) -> Iterator[tuple[int, int]]:
    for m in ANY_HEX.finditer(text):
        found, low = [], 0
        for shift in range(2):
            run = m[0][shift : shift + (len(m[0]) - shift) // 2 * 2]
            found += [(shift + 2 * a, min(shift + 2 * b, len(m[0]))) for a, b in keys_in(bytes.fromhex(run))]
        for start, end in sorted(found):
            if start >= low:
                low = end
                yield m.start() + start, m.start() + end


def encoded_keys(text: str) -> Iterator[tuple[int, int]]:
    """Spans of keys in base64, which may go over several lines and begin and end anywhere in them."""
    for m in BLOCK.finditer(text):
        lines = [x.span() for x in LINE.finditer(m[0])]
        whole = "".join(m[0][a:b] for a, b in lines).translate(STANDARD)
        begins = [0]  # of each line, in `whole`
        for a, b in lines:
            begins.append(begins[-1] + b - a)
        found, low = [], 0
        for shift in range(4):
            n = len(whole) - shift
            data = base64.b64decode(whole[shift:] + "A" * (-n % 4))[: n * 6 // 8]
            # Only every third byte begins where a character does; the other places are those of other alignments.
            found += [(shift + a // 3 * 4, shift + a // 3 * 4 + ((b - a) * 4 + 2) // 3) for a, b in keys_in(data) if a % 3 == 0]
        for start, end in sorted(found):
            if start < low:
                continue
            own = bisect.bisect_right(begins, start) - 1
            if end > len(whole):
                end = begins[own + 1]
            low, last = end, bisect.bisect_left(begins, end) - 1
            end = m.end() if end == len(whole) else m.start() + lines[last][0] + end - begins[last]
            yield m.start() + lines[own][0] + start - begins[own], end


def signed_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Runs of the tokens' alphabet are split at dots; three consecutive pieces are a token if the first two are JSON."""
    for m in TOKEN.finditer(text) if "eyJ" in text else ():
        pieces = m[0].split(".") if "eyJ" in m[0] else []
        at, i = m.start(), 0
        while i + 2 < len(pieces):
            start = next((k for k in dict.fromkeys((pieces[i].find("eyJ"), pieces[i].rfind("eyJ"))) if k >= 0 and is_header(pieces[i][k:])), None)
            n = 1
            if start is not None and pieces[i + 1] and isinstance(parsed(pieces[i + 1]), dict):
                n = 3
                yield at + start, at + sum(map(len, pieces[i : i + 3])) + 2
            at += sum(len(x) + 1 for x in pieces[i : i + n])
            i += n


def parsed(piece: str):
    try:
        return json.loads(decoded(piece))
    except (ValueError, RecursionError):
        return None


def is_header(piece: str) -> bool:
    head = parsed(piece) if len(piece) >= 14 else None  # as long as {"alg":""}
    return isinstance(head, dict) and isinstance(head.get("alg"), str)


def assignments(text: str) -> Iterator[tuple[int, int]]:
    """Starts at each separator and looks back for the name, so that the text is searched for two characters only."""
    low = 0
    for m in SEPARATOR.finditer(text):
        at = m.start()
        if at < low:
            continue
        end = at
        while end > low and text[end - 1] == " ":
            end -= 1
        if end > low and text[end - 1] in "\"'":
            end -= 1
        if end == low or text[end - 1] not in "dDtTnNyY":
            continue
        name = NAMED.search(text, max(low, end - 8), end)
        value = name and VALUE.match(text, at + 1)
        if value:
            low = value.end()
            if len(value[1]) >= 6:
                yield name.start(), low


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, place in KINDS, end) of every span, sorted."""
    found = [(start, 0, end) for start, end in assignments(text)]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    for m in HEX.finditer(text):
        found.append((m.start(), 2, m.end()))
    found += [(start, 5, end) for start, end in hex_keys(text)]
    found += [(start, 3, end) for start, end in signed_tokens(text)]
    taken = [m.span() for m in PEM.finditer(text) if private_key(decoded(re.sub(r"\\[rn]", "", m[2])))] if "-----BEGIN" in text else []
    found += [(start, 4, end) for start, end in taken]
    starts = [a for a, _ in taken]
    for start, end in encoded_keys(text):
        i = bisect.bisect_right(starts, start) - 1
        if i < 0 or start >= taken[i][1]:
            found.append((start, 5, end))
    return sorted(set(found))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


ADDED = "n_assign long, n_access long, n_hex long, n_confirmed long, base_sha256 string, spans string"


def find(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`key` and, for each row, the counts, the digest of the base spans and all spans."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for value in batch.column(1):
                spans = scan(value.as_py() or "")
                counts = [0] * len(KINDS)
                for _, kind, _ in spans:
                    counts[kind] += 1
                base = [s for s in spans if s[1] < len(BASE_KINDS)]
                row = (*counts[:3], sum(counts[3:]), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))
                for column, cell in zip(columns, row):
                    column.append(cell)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            names = ["key", "n_assign", "n_access", "n_hex", "n_confirmed", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=names)

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(scanned, f"key {rows.schema['key'].dataType.simpleString()}, {ADDED}").withColumnRenamed("key", key)
