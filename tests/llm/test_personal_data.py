"""Personal data against the contract's patterns as they stand, and worked cases."""

import hashlib
import re
import time

import pytest
from hypothesis import given, settings, strategies as st

from scenlens.llm import personal_data as pd_
from tests.llm.fixtures import SCHEMA, no_documents, odd_documents

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_of(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }
            if ok[kind]:
                out.append((kind, *m.span()))
    return out


def base_found(text):
    return [s[:3] for s in pd_.find(text) if s.kind in pd_.BASE_KINDS]


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a@.-+1 2(é%", max_size=40))
def test_base_spans_equal_the_patterns(text):
    assert base_found(text) == base_of(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4111111111111111", "4111-1111 1111 1111", "a.b@c.de", "x@y", "1.2.3.4", "999.1.1.1", "001.2.3.0004", "+49 (30) 1234-567", " ", ".", "0", "@", "-"]), max_size=9))
def test_base_spans_of_made_up_texts(parts):
    text = "".join(parts)
    assert base_found(text) == base_of(text)


def test_checks():
    assert pd_.luhn("4111111111111111") and not pd_.luhn("4111111111111112")
    assert pd_.mod97("DE89370400440532013000") and pd_.mod97("GB82WEST12345698765432") and not pd_.mod97("GB82WEST12345698765431")


@pytest.mark.parametrize(
    "text, spans",
    [
        ("Konto: DE89 3704 0044 0532 0130 00 BIC", ["iban:7:34"]),
        ("DE89370400440532013000", ["iban:0:22"]),
        ("DE89370400440532013001", []),
        ("example DE89370400440532013000", []),
        ("account example DE89370400440532013000", ["iban:16:38"]),
        ("DE89370400440532013000x", []),
        ("ZZ89370400440532013000", []),
        ("SSN 123-45-6789", ["ssn:4:15"]),
        ("123-45-6789", []),
        ("ssn 666-45-6789, 123-00-6789, 123-45-0000, 912-45-6789", []),
        ('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', ["secret:9:49"]),
        ("24be64439e3e49cf46b2d7c90f3602a3d0b907ff", []),
        ("token " + "a" * 65, []),
        ("é\U0001f600 a@b.co", ["email:3:9"]),
    ],
)
def test_spans(text, spans):
    assert [f"{s.kind}:{s.start}:{s.end}" for s in pd_.find(text)] == spans


def test_context_moves_scores():
    scores = {t: pd_.find(t)[0].score for t in ("1.2.3.4", "server 1.2.3.4", "version 1.2.3.4", "x" * 60 + " server 1.2.3.4", "server " + "x" * 60 + " 1.2.3.4")}
    assert list(scores.values()) == [60, 90, 40, 90, 60]


def test_long_runs_take_linear_time():
    start = time.time()
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1" * 200_000, "+1" + " " * 400_000, "1 " * 200_000, "AA11" * 100_000, "1-" * 200_000, "a.@b." * 90_000):
        pd_.find(text)
    assert time.time() - start < 20


def test_odd_rows(spark):
    df = odd_documents(spark)
    more = [(700, "mail a@b.co, +1 (743) 555-3824, 152.143.123.131 and 4785380592391139"), (None, "a@b.co"), (700, "token " + "0af1" * 10), (701, "é" * 50_000 + " x@y.zz")]
    df = df.unionByName(spark.createDataFrame([(*r, None, None, 1, 1, 1, 1) for r in more], SCHEMA))
    rows, got = df.collect(), pd_.report(df).collect()

    def listed(spans):
        return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)

    want = []
    for r in rows:
        base = base_of(r.text or "")
        counts = [sum(b[0] == k for b in base) for k in pd_.BASE_KINDS]
        want.append((r.doc_id, *counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(s[:3] for s in pd_.find(r.text or ""))))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert next(r.spans for r in got if r.doc_id == 700 and r.n_email == 0) == "secret:6:46"
    texts = {(s["kind"], s["text"]) for r in pd_.spans(df).collect() for s in r.spans}
    assert ("phone", "+1 (743) 555-3824") in texts and ("email", "x@y.zz") in texts


def test_no_rows(spark):
    assert pd_.report(no_documents(spark)).collect() == []
