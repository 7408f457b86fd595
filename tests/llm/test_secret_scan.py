import hashlib
import random
import re
import zlib

from clickloom.llm import secret_scan as s

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain(text):
    text, found = text or "", []
    for m in re.finditer(ASSIGN, text, re.I | re.A):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end(), "assign"))
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(a, e, k) for a, _, e, k in sorted(found)]


def base(text, search=s.automaton()):
    return [x for x in s.scan(text, search) if x[2] in s.KINDS[: s.BASE]]


def github(body):
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = s.DIGITS[d] + digits
    return f"ghp_{body}{digits}"


def test_base_equals_whole_text_expressions():
    rng = random.Random(1)
    parts = ["password", "Token", " = ", "=", ":", '"', "'", "abc123", "é", "😀", "AKIA", "ABCDEF0123456789ABCD", "deadbeef"]
    parts += ["0123456789abcdef", "api_key", "APIKEY", "secret", "x", " ", "\n", "K", "ſecret", "=a", "passwd", "akia"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert base(text) == plain(text), text


def test_hex_runs_of_every_length_and_place():
    for before in range(26):
        for size in (22, 23, 24, 25, 47, 48, 49):
            text = "z" * before + "a" * size + "g"
            assert base(text) == plain(text)


def test_checksums_decide():
    good = github("a1B2" * 7 + "zz")
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    found = s.scan(f"é {good} {bad} {good}x -----BEGIN RSA PRIVATE KEY-----", s.automaton())
    assert [k for _, _, k in found] == ["github", "private_key"] and found[0][:2] == (2, 42)


def test_report(frame, odd, nothing):
    texts = [(1, "é password = hunter22 token: ab"), (2, "AKIA" + "Z" * 16 + " " + "0f" * 12), (3, None)]
    rows = {r.doc_id: r for r in s.secret_report(frame(texts)).collect()}
    for i, t in texts:
        own = ",".join(f"{k}:{a}:{e}" for a, e, k in plain(t))
        assert rows[i].spans == own
        assert rows[i].base_sha256 == hashlib.sha256(own.encode()).hexdigest()
    assert (rows[1].n_assign, rows[2].n_access, rows[2].n_hex) == (1, 1, 1)
    assert s.secret_report(odd).count() == odd.count()
    assert s.secret_report(nothing).collect() == []
