"""Personal data: patterns propose spans, checksums confirm them, words nearby move their score.

Kinds, in the order of reports: email, ip, card, phone, iban, ssn, secret. The first four are the base
kinds: what their pattern and check accept is always reported, whatever the score. The others are reported
where their score reaches ``THRESHOLD``:

- iban: two letters, two digits and up to 30 more, in the length of its country, confirmed by mod 97;
- ssn: three, two and four digits with hyphens, whose parts are in use; only where a word nearby speaks of it;
- secret: 32 to 64 hexadecimal digits, only where a word nearby says token, key, password or the like.

A score starts at the kind's own; one of the kind's words within ``NEAR`` code points on either side adds
``BOOST``, a word that speaks of examples takes ``PENALTY`` away. Words are runs of ASCII letters.

Every pattern takes linear time on any text: none is tried again inside a run that it has failed on.

Defined results: a null text is empty and has no spans. Positions are code points, the end exclusive. Each
row is searched on its own, repeated ones too. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scenlens.llm.common import ship

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret")
NEAR = 50
BOOST, PENALTY, THRESHOLD = 30, 20, 50

# The score of a confirmed span of each kind, and the words that support it.
SCORES = {"email": 90, "ip": 60, "card": 80, "phone": 60, "iban": 60, "ssn": 30, "secret": 30}
WORDS = {
    "email": "email mail contact",
    "ip": "ip address host server",
    "card": "card visa mastercard amex credit",
    "phone": "phone tel telephone mobile call fax",
    "iban": "iban account bank konto compte cuenta",
    "ssn": "ssn social security",
    "secret": "token key apikey secret password passwd credential",
}
AGAINST = "example sample dummy test placeholder version"

# Lengths of account numbers by country.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27,
    "HU": 28, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19,
    "SK": 24, "TR": 26,
}

SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:int,text:string>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.int32()), ("text", pa.string())]))

_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){12,}+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", re.ASCII)
_SSN = re.compile(r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", re.ASCII)
_SECRET = re.compile(r"\b[0-9a-f]{32,64}\b", re.ASCII)
_LOWER = re.compile("[a-z]+")
_UPPER_TO_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: int
    text: str


# Validators


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The ISO 7064 check of an account number without spaces: its letters are numbers from 10 on."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if c in string.digits)


def _card_ok(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def _ip_ok(text: str) -> bool:
    return all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in text.split(".")))


def _ssn_ok(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def account_of(text: str) -> str | None:
    """The start of a proposal that is an account number of its country's length, with its spaces, if there is one."""
    length, taken = IBAN_LENGTHS.get(text[:2]), 0
    for at, c in enumerate(text):
        taken += c != " "
        if taken == length:
            found = text[: at + 1]
            return found if mod97(found.replace(" ", "")) else None
    return None


# Proposals


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping matches: a local part reaches back from its @ as far as it can."""
    done, seen = 0, -1
    for m in _DOMAIN.finditer(text):
        at = m.start()
        lo = max(done, text.rfind("@", seen + 1, at) + 1, seen + 1)
        start = lo + len(text[lo:at].rstrip(_LOCAL))
        seen = at
        if start < at:
            done = m.end()
            yield start, done


def _matches(pattern: re.Pattern, ok: Callable[[str], bool]):
    def run(text: str) -> Iterator[tuple[int, int]]:
        for m in pattern.finditer(text):
            if ok(m.group()):
                yield m.span()

    return run


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        found = account_of(m.group())
        if found and not text[m.start() + len(found) : m.start() + len(found) + 1].isalnum():
            yield m.start(), m.start() + len(found)


_FINDERS = {
    "email": ("@", emails),
    "ip": (".", _matches(_IP, _ip_ok)),
    "card": ("", _matches(_CARD, _card_ok)),
    "phone": ("+", _matches(_PHONE, _phone_ok)),
    "iban": ("", ibans),
    "ssn": ("-", _matches(_SSN, _ssn_ok)),
    "secret": ("", _matches(_SECRET, lambda _: True)),
}
_WORDS = {k: frozenset(v.split()) for k, v in WORDS.items()}
_AGAINST = frozenset(AGAINST.split())


def score_of(text: str, kind: str, start: int, end: int) -> int:
    before, after = (x.translate(_UPPER_TO_LOWER) for x in (text[max(0, start - NEAR) : start], text[end : end + NEAR]))
    words = {*_LOWER.findall(before), *_LOWER.findall(after)}
    return SCORES[kind] + BOOST * bool(words & _WORDS[kind]) - PENALTY * bool(words & _AGAINST)


def find(text: str) -> list[Span]:
    """The spans of a text, by kind, then start."""
    out = []
    for kind, (needed, finder) in _FINDERS.items():
        if needed in text:
            for start, end in finder(text):
                score = score_of(text, kind, start, end)
                if kind in BASE_KINDS or score >= THRESHOLD:
                    out.append(Span(kind, start, end, score, text[start:end]))
    return out


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [[s._asdict() for s in find(t.as_py() or "")] for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, _SPAN)], ["doc_id", "spans"])


def spans(documents: DataFrame) -> DataFrame:
    """doc_id and the spans (kind, start, end, score, text) of each row of ``documents`` (doc_id, text)."""
    ship(documents.sparkSession)
    key = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(_found, f"doc_id {key}, spans {SPAN}")


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of(*kinds: str) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def report(documents: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans and a list of all spans, for each row."""
    return spans(documents).select(
        "doc_id",
        *[F.size(_of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_listed(_of(*BASE_KINDS)).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
