import hashlib
import random
import re
import time

import pytest

from skyflow.llm import secret_scan

DIR = "/root/testdata/sf0.01"
ORDER = ["assign", "access", "hex"]


def plain_base(text):
    """The contract's patterns, tried at every place in turn."""
    names = ("password", "passwd", "secret", "token", "apikey", "api_key")
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    out, at = [], 0
    while at < len(text):
        ascii_low = "".join(c.lower() if c.isascii() else c for c in text[at : at + 8])
        end = next((at + len(n) for n in names if ascii_low.startswith(n)), None)
        hit = None
        if end:
            q = end + (text[end : end + 1] in ("'", '"') and end < len(text))
            while text[q : q + 1] == " ":
                q += 1
            if text[q : q + 1] in (":", "="):
                q += 1
                while text[q : q + 1] == " ":
                    q += 1
                q += text[q : q + 1] in ("'", '"') and q < len(text)
                r = q
                while r < len(text) and text[r] in value:
                    r += 1
                if r > q:
                    hit = r
                    if r - q >= 6:
                        out.append((at, "assign", r))
        at = hit or at + 1
    for kind, pattern, least in (("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m.group()) >= least]
    return sorted(out, key=lambda s: (s[0], ORDER.index(s[1])))


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


def test_fixed_patterns_against_a_plain_scan():
    r = random.Random(4)
    parts = ["password", "PassWd", "secret", "toKen", "api_key", "APIKEY", "paſſword", "toKen", '"', "'", " ", "=", ":", "abc123", "x", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "é", "\n", "-", "token=secret=abcdefgh", "token = token = abcdef "]
    for _ in range(3000):
        text = "".join(r.choices(parts, k=r.randint(0, 14)))
        assert joined(plain_base(text)) == ",".join(f"{k}:{a}:{b}" for a, b, k in secret_scan.secret_spans(text)[0]), text


@pytest.mark.parametrize(
    "text, found",
    [
        ('pwd = "hunter2-Xy9"', ["hunter2-Xy9"]),
        ('K = "abcD9f8e7"\nlogin(password=K)', ["abcD9f8e7"]),
        ("a = 'Xk29'\nb = a + 'pQ83z'\nclient_pwd = b", ["Xk29", "pQ83z"]),
        ('host="h.example"\nmid = "k7Tq"\ndb_pass = f"zz{mid}91Lm"', ["k7Tq", "91Lm"]),
        ('const key_a = "abcDEF12"; const dbPasswort: string = key_a', ["abcDEF12"]),
        ('{"private_key": "MIIEvQIBADANBgkqh"}', ["MIIEvQIBADANBgkqh"]),
        ("db_pass: S3cr3t!pass", ["S3cr3t!pass"]),
        ("mysql --pwd hG62hs82", ["hG62hs82"]),
        ("postgres://bob:hx82hsjA@host/db", ["hx82hsjA"]),
        ("<dbPwd>hy7623hs</dbPwd>", ["hy7623hs"]),
        ('<add key="SqlPwd" value="hsy62HS7"/>', ["hsy62HS7"]),
        ("x = 'old11AA'\npwd = x\nx = 'new22BB'", ["old11AA"]),
        ("A = B\nB = A\npwd = A", []),
        ('auth_key = "your-key-here"\npwd = "<enter it>"\npwd = "${PWD}"', []),
        ('pwd_file = "/etc/x.pem"\nkey = "value12345"\ncolour = "aB3dE6gH9"', []),
        ("the pass: nothing to see here, only prose with a key = sign", []),
    ],
)
def test_lexed_literals(text, found):
    base, every = secret_scan.secret_spans(text)
    assert [text[a:b] for a, b, k in every if k == "literal"] == found
    assert set(base) <= set(every)


def test_a_literal_in_a_fixed_span_is_not_repeated():
    text = 'password = "abcDEF123!"'  # the fixed pattern ends before the sign
    assert [k for _, _, k in secret_scan.secret_spans(text)[1]] == ["assign"]


def test_long_texts_take_linear_time():
    for unit in ("a", "password", 'x="', "<a>", "://a:", "a.b-", "k='\\", '"""', "k=k+", "pwd=a+", "-a ", "a:b=", "pw=`", "token=''+"):
        took = time.perf_counter()
        secret_scan.secret_spans("pwd=" + unit * (300_000 // len(unit)))
        assert time.perf_counter() - took < 10, unit


def test_every_document(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    want = {r.doc_id: plain_base(r.text or "") for r in docs.collect()}
    got = secret_scan.query(spark, DIR).collect()
    assert len(got) == docs.count() and sum(map(len, want.values())) > 0
    for r in got:
        base = want[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for _, k, _ in base) for kind in ORDER)
        assert set(filter(None, joined(base).split(","))) <= set(r.spans.split(","))


def test_rows_of_any_kind(spark):
    long = "word " * 200_000 + "pwd = 'hG62hs82'"
    rows = [(1, None, 0), (2, "", 0), (None, "pwd='hG62hs82'", 0), (4, long, 0), (4, long, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = sorted(((r.doc_id, r.n_literal, r.spans) for r in secret_scan.scan_secrets(df).collect()), key=str)
    assert got == sorted([(1, 0, ""), (2, 0, ""), (None, 1, "literal:5:13"), (4, 1, "literal:1000007:1000015"), (4, 1, "literal:1000007:1000015")], key=str)
    assert secret_scan.scan_secrets(df.limit(0)).collect() == []
