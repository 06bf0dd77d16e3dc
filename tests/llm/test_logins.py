"""Logins of any length and either case of scheme."""

import time

from orrerium.llm import pii

AUTOMATON = pii._automaton()


def logins(text):
    return [text[a:b] for k, a, b in pii.scan(text, AUTOMATON) if pii.KINDS[k] == "login"]


def test_logins_of_any_length_and_case():
    for n in (1, 256, 257, 300, 100_000):
        assert logins(f"at postgres://user:{'t' * n}@host/x") == [f"user:{'t' * n}"]
        assert logins(f"at postgres://{'u' * n}:pw@host/x") == [f"{'u' * n}:pw"]
    for scheme in ("https", "HTTPS", "Https", "MongoDB", "xhttp"):
        assert logins(f"at {scheme}://user:pw@host") == ["user:pw"]
    assert logins("gopher://user:pw@host ://user:pw@host http://user@host http://u:p/@host") == []
    assert logins("http://a:bhttp://c:d@host") == ["c:d"]


def test_logins_take_linear_time():
    for piece in ("http://", "http://a:", "http://a:b", "://", "HTTP://" + "a" * 20):
        start = time.perf_counter()
        pii.scan(piece * (2_000_000 // len(piece)), AUTOMATON)
        assert time.perf_counter() - start < 20
