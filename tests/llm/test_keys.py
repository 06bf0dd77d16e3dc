"""Keys in every form of hex and base64 that the scanner confirms."""

import base64
import time

import pytest

from orrerium.llm import secret_scan


def der(tag, content):
    n = len(content)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")) + content


RSA = der(0x30, der(0x02, b"\0") + b"".join(der(0x02, b"\x01" + bytes(range(n))) for n in (128, 3, 128, 64, 64, 64, 64, 64)))
string = lambda x: len(x).to_bytes(4, "big") + x
OPENSSH = b"openssh-key-v1\0" + string(b"none") + string(b"none") + string(b"") + (1).to_bytes(4, "big") + string(bytes(range(51))) + string(bytes(range(136)))


def keys(text):
    return [text[a:b] for a, k, b in secret_scan.scan(text) if secret_scan.KINDS[k] == "key"]


def wrapped(text, n, end="\n"):
    return end.join(text[i : i + n] for i in range(0, len(text), n))


@pytest.mark.parametrize("key", [RSA, OPENSSH])
def test_keys_in_hex_of_either_case(key):
    mixed = "".join(c.upper() if i % 3 else c for i, c in enumerate(key.hex()))
    for text in (key.hex(), key.hex().upper(), mixed):
        assert keys(f"see {text} end") == [text]
        assert keys(f"see {text[:-2]} end") == ([] if key is RSA else [text[:-2]])
    assert keys(f"A{key.hex()}") == [key.hex()]


@pytest.mark.parametrize("key", [RSA, OPENSSH])
@pytest.mark.parametrize("coded", [base64.b64encode(RSA).decode(), base64.b64encode(OPENSSH).decode()])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
def test_wrapped_and_joined_keys(key, coded, end):
    plain = base64.b64encode(key).decode()
    bare = plain.rstrip("=")
    for text in (plain, bare, wrapped(plain, 64, end), wrapped(plain, 76, end), wrapped(bare, 64, end)):
        for before in ("see ", "key=", "id_", "a-", "path/to/", "x" * 50 + "/"):
            assert keys(f"{before}{text}") == [text]
            assert keys(f"{before}{text}\nThen more follows") == [text]
            assert keys(f"{before}{text}\n{coded} x") == [text, coded]


def test_broken_keys_are_left():
    broken = bytearray(RSA)
    broken[5] ^= 0x40
    coded = base64.b64encode(bytes(broken)).decode()
    assert keys(coded) == keys(wrapped(coded, 64)) == keys(bytes(broken).hex().upper()) == []
    assert keys("M" * 5000) == keys("/M" * 5000) == keys("b3BlbnNzaC1rZXktdjEA" * 500) == []
    start = time.perf_counter()
    secret_scan.scan("/MIIE" * 100_000 + "\n" + "/b3BlbnNzaC1rZXktdjEA" * 20_000)
    assert time.perf_counter() - start < 20


def test_keys_stand_anywhere_in_a_run():
    coded = base64.b64encode(RSA).decode().rstrip("=")
    for n in range(9):
        assert keys(f"{'Z' * n}{coded}{'Z' * 30}") == [coded]
        assert keys(f"0x{'0' * n}{RSA.hex().upper()}{'0' * n}") == [RSA.hex().upper()]
    escaped = "-----BEGIN PRIVATE KEY-----\\n" + wrapped(base64.b64encode(RSA).decode(), 64, "\\n") + "\\n-----END PRIVATE KEY-----"
    assert [secret_scan.KINDS[k] for _, k, _ in secret_scan.scan(escaped)] == ["pem"]


def test_tokens_next_to_other_pieces():
    b64 = lambda x: base64.urlsafe_b64encode(x.encode()).decode().rstrip("=")
    token = f"{b64('{"alg":"HS256"}')}.{b64('{"sub":"a"}')}.c2lnbmF0dXJl"
    found = lambda t: [t[a:b] for a, k, b in secret_scan.scan(t) if secret_scan.KINDS[k] == "jwt"]
    for text in (token, f"a.b.{token}", f"x-{token}", f"{token}.", f"id_{token}.eyJ.z"):
        assert found(text) == [token]
    assert found(f"{token} {token}.{token}") == [token] * 3
    assert found("eyJ.eyJ.eyJ.a..b") == []


@pytest.mark.parametrize("piece", ["eyJ", "eyJ.", "-eyJ", "AKIA", "AKIA ", "M", "MIIE", "3082", "30820201", "-----BEGIN PRIVATE KEY-----", "a" * 39 + "\n", "token:", "token : ", "MIICXAIBAAKB\n", "MDAwMDAw"])
def test_time_is_linear(piece):
    def seconds(n):
        start = time.perf_counter()
        secret_scan.scan(piece * (n // len(piece)))
        return time.perf_counter() - start

    seconds(1 << 16)
    assert seconds(1 << 20) < 0.5 + 16 * 3 * seconds(1 << 16)
