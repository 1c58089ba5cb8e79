"""op10 against regular expressions, and its automata against them too."""

import hashlib
import random
import re

from llm.automaton import Scanner, compile_rules
from llm.secrets import SecretScanner, find_secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(t):
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out, key=lambda x: (x[0], x[2]))


def texts():
    rng = random.Random(3)
    parts = ["password", "passwd", "Secret", "TOKEN", "api_key", "apikey", '"', "'", " ", "  ", ":", "=", "abc", "0123456789abcdef", "AKIA", "ABCDEFGH1234", "é", "漢", "ſecret", ".", "/", "\n", "xyz12345", "deadbeef" * 4]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)]


def test_base_spans():
    scanner = SecretScanner()
    found = 0
    for t in texts():
        got = [x for x in scanner.spans(t) if x[2] < 3]
        assert got == base(t), t
        found += len(got)
    assert found > 1000


def test_added_kinds():
    scanner = SecretScanner()
    key = "ghp_" + "a1B2" * 9
    jwt = "eyJhbGciOi.eyJzdWIiOi.abc-_123"
    t = f"é {key} and {jwt} and -----BEGIN RSA PRIVATE KEY----- xoxb-1234567890-abc ghp_short"
    kinds = [scanner.rules[k].kind for _, _, k in scanner.spans(t)]
    assert kinds == ["forge", "jwt", "private", "chat"]
    assert [t[s:e] for s, e, _ in scanner.spans(t)][:2] == [key, jwt]


def test_automaton_is_minimal_and_leftmost_longest():
    assert len(compile_rules([("a(b|c)*d|a(c|b)*d", False)]).masks) == 4  # start, inside, accepting, dead
    rng = random.Random(1)
    patterns = ["ab+c?", "[a-b]{2,3}c", "(ab|a)(c|bcd)", "b.?a"]
    scanner = Scanner([(p, "") for p in patterns])
    for _ in range(500):
        t = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 14)))
        for k, p in enumerate(patterns):
            want, at = [], 0
            while at <= len(t):
                ends = [e for e in range(len(t), at, -1) if re.fullmatch(p, t[at:e], re.S)]
                if ends:
                    want.append((at, ends[0]))
                at = ends[0] if ends else at + 1
            assert [(s, e) for r, s, e in scanner.scan(t.encode()) if r == k] == want


def test_rows(spark):
    rows = [(1, "token = abcdefgh1 é AKIA" + "B" * 16), (2, None), (3, ""), (4, "x" * 100_000 + " secret:abcdefghij"), (4, "x" * 100_000 + " secret:abcdefghij")]
    got = sorted(find_secrets(spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, spans string")).collect(), key=lambda r: r.doc_id)
    assert [(r.n_assign, r.n_access, r.n_hex) for r in got] == [(1, 1, 0), (0, 0, 0), (0, 0, 0), (1, 0, 0), (1, 0, 0)]
    assert got[0].spans == "assign:0:17,access:20:40" and got[0].base_sha256 == hashlib.sha256(got[0].spans.encode()).hexdigest()
    assert got[1].base_sha256 == hashlib.sha256(b"").hexdigest() and got[3].spans == "assign:100001:100018"
    assert find_secrets(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_a_match_that_is_not_kept_takes_its_place():
    scanner = Scanner([("a+b?", "a{3,}b?"), ("[ab]+", "")])
    assert scanner.scan(b"aab aaab aaa ab") == [(0, 4, 8), (0, 9, 12), (1, 0, 3), (1, 4, 8), (1, 9, 12), (1, 13, 15)]
    spans = SecretScanner().spans('password=api_key : "abcdefghij"')  # the first match takes the second's name
    assert spans == base('password=api_key : "abcdefghij"') == []


def test_megabytes():
    scanner = SecretScanner()
    for unit in ("a", "password=", "eyJa.", "AKIA", "-----BEGIN ", "ghp_", "0123456789abcdef"):
        text = unit * (1_000_000 // len(unit))
        assert [x for x in scanner.spans(text) if x[2] < 3] == base(text), unit
