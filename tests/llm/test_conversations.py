"""Conversation repair against exhaustive search, and against itself in other segments."""

import hashlib
import itertools
import re
from collections import defaultdict

from hypothesis import given, settings, strategies as st

from scenlens.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, cost long, audit string"
FORM = re.compile(r"(s?(ua)+)?")
FORMS = ["", *[s + "ua" * k for k in range(1, 6) for s in ("", "s")]]


def exhaustive(codes):
    """The best (cost, audit) over all edits that give a form of some length."""

    @__import__("functools").cache
    def search(i, form):
        found = []
        if form:
            if form[0] in "ua":
                cost, audit = search(i, form[1:])
                found.append((cost + 5, "I" + audit))
        if i == len(codes):
            return min(found) if found else ((0, "") if not form else (10**6, "~"))
        cost, audit = search(i + 1, form)
        found.append((cost + 2, "D" + audit))
        c = codes[i]
        if c != "x" and form:
            extra = 5 if c.isupper() else 0
            cost, audit = search(i + 1, form[1:])
            if c.lower() == form[0]:
                found.append((cost + extra, "K" + audit))
            if form[0] in "ua":
                found.append((cost + extra + 1, "R" + audit))
        return min(found)

    return min(search(0, form) for form in FORMS if len(form) <= len(codes) + 3)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="suaoSUAOx", max_size=7))
def test_search_is_optimal(codes):
    assert cv.cheapest(codes) == exhaustive(codes)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="suaoSUAOx", max_size=60), st.integers(1, 9))
def test_any_cuts_give_the_same(codes, size):
    cuts = [codes[i : i + size] for i in range(0, len(codes), size)] or [""]
    table = cv.segment_table(cuts[0], True, len(cuts) == 1)
    for i, c in enumerate(cuts[1:], 1):
        table = cv.joined_tables(table, cv.segment_table(c, False, i == len(cuts) - 1))
    assert [e[2:] for e in table] == [cv.cheapest(codes)]


def test_long_segments_are_searched_fast():
    """Every place and phase is left by few nodes, also where all rows want another role."""
    import time

    start = time.time()
    for codes in ("u" * 256, "ou" * 128, "Ua" * 128, "sxaA" * 64):
        assert cv.cheapest(codes)
    assert time.time() - start < 5


def expected(rows):
    """Brute force over the rows of one conversation, in order."""
    blank = duplicate = truncated = 0
    seen, codes = set(), ""
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        code = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not bare:
            blank, code = blank + 1, "x"
        elif (role, text) in seen:
            duplicate, code = duplicate + 1, "x"
        elif bare[-1] not in ".!?":
            truncated, code = truncated + 1, code.upper()
        seen.add((role, text))
        codes += code
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit = exhaustive(codes)
    left, lines = list(rows), []
    for e in audit:
        last = lines[-1][:1] if lines else ""
        fresh = "assistant" if last == "u" else "user"
        if e == "I":
            lines.append(fresh + ":")
        else:
            role, text = left.pop(0)
            if e != "D":
                lines.append(f"{role if e == 'K' else fresh}:{text}")
    assert FORM.fullmatch("".join(x[0] for x in lines)) and not left
    return blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


ODD = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hi."), (1, 5, "user", "More?"), (1, 5, "user", "More?"),
    (2, None, "user", "No turn."), (2, 3, "tool", "x"), (2, 3, "assistant", "é\n."), (2, None, None, None),
    (3, None, "system", "only."), (None, 1, "user", "null id."), (None, 2, "assistant", "cut"),
    (4, 1, "", ""), (4, 2, "user", " \t"), (5, 1, "assistant", "a." * 40_000), (5, 2, "user", "b."), (5, 9, "assistant", "c.  \n"),
]


def test_odd_rows(spark):
    rows = [(*r, 1, "K") for r in ODD]
    df = spark.createDataFrame(rows, SCHEMA)
    groups = defaultdict(list)
    for c, t, role, text in sorted(ODD, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " ")):
        groups[c].append((" " if role is None else role, " " if text is None else text))
    for bits in (0, 1, cv.SEGMENT_BITS):
        got = {r.conv_id: r for r in cv.repair(df, bits).collect()}
        assert set(got) == set(groups)
        for c, turns in groups.items():
            r = got[c]
            assert (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) == expected(turns), (c, r)
    assert (got[1].gaps, got[2].gaps, got[3].gaps, got[5].gaps) == (2, 0, 0, 6)
    turns = cv.repaired_turns(df, spark.createDataFrame([(r.conv_id, r.audit) for r in got.values()], "conv_id long, audit string")).collect()
    for c, r in got.items():
        mine = sorted((t.position, f"{t.role}:{t.text}") for t in turns if t.conv_id == c)
        assert hashlib.sha256("\n".join(x for _, x in mine).encode()).hexdigest() == r.repaired_sha256


def test_one_conversation_with_most_rows(spark):
    rows = [(7, i, ("user", "assistant", "user")[i % 3], f"t{i % 90}" + "." * (i % 7 > 0)) for i in range(1500)]
    rows += [(i, 0, "user", "q?") for i in range(100, 400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    one = {r.conv_id: r for r in cv.repair(df, 12).collect()}
    cut = {r.conv_id: r for r in cv.repair(df, 4).collect()}
    assert one == cut and len(one) == 301
    codes, seen = "", set()
    for _, _, role, text in rows[:1500]:
        codes += "x" if (role, text) in seen else role[0] if text[-1] == "." else role[0].upper()
        seen.add((role, text))
    assert (one[7].cost, one[7].audit) == cv.cheapest(codes)


def test_damage_and_no_rows(spark):
    df = spark.createDataFrame([(*r, 1, "K") for r in ODD], SCHEMA)
    got = cv.repair_damaged(df).collect()
    assert sorted(str(r.conv_id) for r in got) == sorted({str(r[0]) for r in ODD})
    assert cv.repair_damaged(df.limit(0)).collect() == []
    lost = spark.range(400).selectExpr("id AS conv_id", "0L AS turn", "'user' AS role", "'q?' AS text")
    kept = {r.conv_id for r in cv.damage(lost).collect()}
    assert 0 < 400 - len(kept) < 100
    for r in cv.repair_damaged(lost).collect():
        if r.conv_id not in kept:
            assert (r.cost, r.audit, r.gaps, r.repaired_sha256) == (0, "", 0, hashlib.sha256(b"").hexdigest())
