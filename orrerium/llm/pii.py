"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors (at-signs, plus-signs, digits, schemes and identifier cues) in one pass over a
text. Deterministic parsers then expand each anchor to the boundaries of an email, address, card, phone, account or
credential, and validate it. No text is cut; a parser never runs twice over the same characters, so that time is linear.

Spans are `kind:start:end` in code points, end exclusive. The four base kinds are found leftmost and non-overlapping
within a kind, and a candidate that fails its validation is dropped without a second try inside it. Added by the method
are `account` (an identifier behind a cue in any case: an IBAN of its country's length and right checksum, a social
security number, a bank account), `login` (user and password before a host), `ipv6`, and `address` (a house number and
names before a kind of street, with what follows of a town and its code).

Defined cases: a null or empty text has no spans. Rows that repeat are scanned one by one and agree.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "login", "ipv6", "address")

#: Schemes, in either case, that may carry a login, and words that announce an account.
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "postgres://", "mysql://", "mongodb://", "redis://", "amqp://")
LONGEST = max(map(len, SCHEMES))
CUES = ("iban", "account", "acct", "ssn", "konto", "compte", "cuenta")
#: Kinds of street that end an address line.
STREETS = ("street", "avenue", "road", "lane", "drive", "boulevard")
#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22,
    "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30,
    "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31,
    "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = "0123456789"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
QUAD = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
RUN = re.compile(r"[0-9]++")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: The start of an IBAN; how far it reaches its country says.
IBAN = re.compile(r"[\s:#.]{0,4}([A-Z]{2}[0-9]{2})")
IBAN_REST = {n: re.compile(r"(?: ?[A-Z0-9]){%d}(?![A-Za-z0-9])" % (n - 4)) for n in sorted(set(IBAN_LENGTHS.values()))}
SSN = re.compile(r"[\s:#.]{0,4}(?!000|666|9)([0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![0-9-])")
ACCOUNT = re.compile(r"(?: ?(?:no|nr|number|num)\b)?[\s:#.]{1,4}([0-9]{6,17})(?![0-9A-Za-z])")
#: Neither run crosses the colon of the next scheme, so that no text is scanned again from anchor to anchor.
LOGIN = re.compile(r"([^\s:/@]++:[^\s:/@]++)@[A-Za-z0-9]")
IPV6 = re.compile(r"[0-9A-Fa-f:]*+(?:\.[0-9]++){0,3}+")
HEXES = frozenset("0123456789abcdefABCDEF")
#: What stands before a kind of street, at the end of LINE_BEFORE characters, and what may follow it.
HOUSE = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,6}[A-Za-z]? (?:[A-Z][A-Za-z'.-]{0,24} ){1,4}\Z")
LINE_BEFORE = 113
TOWN = re.compile(r"(?:,? (?:Apt|Suite|Unit) [0-9A-Za-z]{1,6}\b)?(?:, [A-Z][A-Za-z'.-]{0,24}(?: [A-Z][A-Za-z'.-]{0,24}){0,3}(?:,? [A-Z]{2} [0-9]{5}(?:-[0-9]{4})?\b)?)?")
#: ASCII letters to lower case; nothing changes its length.
FOLD = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for sign in ("@", "+"):
        out.add_word(sign, (sign, 1))
    for digit in DIGITS:
        out.add_word(digit, ("0", 1))
    out.add_word("://", ("://", 3))
    out.add_word(":", (":", 1))
    for cue in (*CUES, *STREETS):
        out.add_word(cue, (cue, len(cue)))
    out.make_automaton()
    return out


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit)
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def iban(text: str, at: int) -> tuple[int, int] | None:
    """The span of an IBAN behind a cue that ends at `at`, as long as its country's are, if its checksum is right."""
    head = IBAN.match(text, at)
    size = head and IBAN_LENGTHS.get(head[1][:2])
    rest = size and IBAN_REST[size].match(text, head.end())
    if not rest:
        return None
    plain = (rest[0] + head[1]).replace(" ", "")
    return (head.start(1), rest.end()) if int("".join(str(int(c, 36)) for c in plain)) % 97 == 1 else None


def ipv6(text: str, at: int, low: int) -> tuple[int, int]:
    """The run of hex digits, colons and a dotted tail around the colon at `at`, not before `low`."""
    start = at
    while start > low and text[start - 1] in HEXES and at - start < 5:
        start -= 1
    return start, IPV6.match(text, start).end()


def is_ipv6(run: str) -> bool:
    """An address of at least three groups; fewer are rather times, ratios or names in a program."""
    if len(run) > 45 or sum(map(bool, run.split(":"))) < 3:
        return False
    try:
        return bool(ipaddress.IPv6Address(run))
    except ValueError:
        return False


def only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def scan(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(place in KINDS, start, end) of every span, sorted."""
    found: list[tuple[int, int, int]] = []
    email_from = ip_from = card_from = account_from = ipv6_from = address_from = 0
    low = text.lower()
    if len(low) != len(text):  # a letter beyond ASCII became two
        low = text.translate(FOLD)
    for last, (anchor, width) in automaton.iter(low):
        at = last - width + 1
        if anchor == "0":
            if at >= ip_from:
                if m := QUAD.match(text, at):
                    ip_from = m.end()
                    if all(len(p) <= 3 or not p[:-3].strip("0") for p in m.groups()) and all(int(p[-3:]) <= 255 for p in m.groups()):
                        found.append((1, at, ip_from))
                else:
                    ip_from = RUN.match(text, at).end()
            if at >= card_from:
                if m := CHAIN.match(text, at):
                    card_from = m.end()
                    digits = only_digits(m[0])
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        found.append((2, at, card_from))
                else:
                    card_from = at + 1
        elif anchor == "@":
            start = at
            while start > email_from and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                email_from = m.end()
                found.append((0, start, email_from))
        elif anchor == "+":
            if (m := PHONE.match(text, at)) and 9 <= len(only_digits(m[0])) <= 15:
                found.append((3, at, m.end()))
        elif anchor == "://":
            if text[max(0, last + 1 - LONGEST) : last + 1].lower().endswith(SCHEMES) and (m := LOGIN.match(text, last + 1)):
                found.append((5, m.start(1), m.end(1)))
        elif anchor == ":":
            if at >= ipv6_from:
                start, end = ipv6(text, at, ipv6_from)
                ipv6_from = max(end, at + 1)
                run = text[start:end] if end - start <= 46 else ""
                run = run if run.endswith("::") else run.removesuffix(":")
                alone = not (start and (text[start - 1].isalnum() or text[start - 1] in ":.")) and not text[end : end + 1].isalnum()
                if run and alone and is_ipv6(run):
                    found.append((6, start, start + len(run)))
        elif anchor in STREETS:
            if at >= address_from and text[at].isupper() and not text[last + 1 : last + 2].isalnum() and (m := HOUSE.search(text[max(address_from, at - LINE_BEFORE) : at])):
                address_from = TOWN.match(text, last + 1).end()
                found.append((7, at - len(m[0]), address_from))
        elif last + 1 >= account_from and not (at and text[at - 1].isalnum()):
            if anchor == "iban":
                span = iban(text, last + 1)
            else:
                m = (SSN if anchor == "ssn" else ACCOUNT).match(text, last + 1)
                span = m and m.span(1)
            if span:
                found.append((4, *span))
                account_from = span[1]
    return sorted(set(found))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


ADDED = "n_email long, n_ip long, n_card long, n_phone long, n_added long, base_sha256 string, spans string"


def find(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`key` and, for each row, the counts, the digest of the base spans and all spans."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for value in batch.column(1):
                spans = scan(value.as_py() or "", automaton)
                counts = [0] * len(KINDS)
                for kind, _, _ in spans:
                    counts[kind] += 1
                base = [s for s in spans if s[0] < len(BASE_KINDS)]
                row = (*counts[:4], sum(counts[4:]), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))
                for column, cell in zip(columns, row):
                    column.append(cell)
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            names = ["key", "n_email", "n_ip", "n_card", "n_phone", "n_added", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=names)

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(scanned, f"key {rows.schema['key'].dataType.simpleString()}, {ADDED}").withColumnRenamed("key", key)
