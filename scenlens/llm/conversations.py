"""Conversation structure repair by depth-first branch and bound.

A sound conversation has the role initials ``(s?(ua)+)?``. A row may be kept, given the role user or
assistant, or deleted; a blank row and a repeated one must be deleted; an empty user or assistant row may be
put in anywhere. Of all cheapest edits, written as their initials in order, the ASCII-least ones win.

The search goes depth first over an explicit stack. A node is a place in the rows and a phase: nothing yet,
or the last role. Its bound is its cost and the least cost at which the rows behind it can be completed, a
suffix bound made backwards. Nodes whose bound is above the incumbent (cost, audit) go, and so do those that
the dominance table of their place and phase knows a better prefix for; when the stack is empty the
incumbent is proved. Prefixes of one node and cost never continue one another, so the better prefix stays
better whatever follows.

All rows are range-sorted by conversation, turn, role and text, so a conversation with a third of all rows
is spread over partitions. It is searched in segments of at most 2^``SEGMENT_BITS`` rows: a segment's table
holds the best edits from every phase to every phase, and tables join in pairs to the whole optimum,
whatever the cuts are. A conversation of one segment has one entry. Only the SHA-256 of a repaired
conversation is one stream by its nature; its task holds the audit and one batch of rows.

Defined results: a null role or text is one space; a null turn stands before all others; rows with a null
conv_id are one conversation. Rows with equal turns are ordered by role, then text. A role whose initial is
none of s, u, a can't be kept. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scenlens.llm.common import partitions, ship
from scenlens.operators.joins import left_join
from scenlens.sources.shared import staged

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
SEGMENT_BITS = 8
SPACES = " \t\n\x0b\x0c\r"

_PART_BITS = 33  # of monotonically_increasing_id(): the row's index in its partition
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_PHASES = (_START, _SYSTEM, _USER, _ASSISTANT)
_NEXT = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_END = -1  # the exit of a last segment
_NEVER = 1 << 40

TABLE = "array<struct<entry:int,exit:int,cost:bigint,audit:string>>"
_TABLE = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


# Search


def _kept(code: str, phase: int) -> int | None:
    """The phase after a row is kept; a code is its role's initial, upper-case for a truncated row, x for one to delete."""
    role = code.lower()
    if role == "s":
        return _SYSTEM if phase == _START else None
    if role == "u":
        return None if phase == _USER else _USER
    return _ASSISTANT if role == "a" and phase == _USER else None


def _moves(code: str, phase: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next phase) of the edits of a row."""
    out = [("D", DELETE, phase)]
    if code != "x":
        extra = TRUNCATED if code.isupper() else 0
        kept = _kept(code, phase)
        if kept is not None:
            out.append(("K", extra, kept))
        if kept != _NEXT[phase]:
            out.append(("R", REROLE + extra, _NEXT[phase]))
    return out


_MOVES = {(c, p): _moves(c, p) for c in "suaoSUAOx" for p in _PHASES}


def _suffix_bounds(codes: str, exit_: int) -> list[list[int]]:
    """For each place and phase the least cost of the rows from there on."""
    if exit_ == _END:
        last = [0, 2 * INSERT, INSERT, 0]
    else:
        last = [0 if p == exit_ else _NEVER for p in _PHASES]
    bounds = [last]
    for code in reversed(codes):
        after = bounds[-1]
        here = [min(cost + after[q] for _, cost, q in _MOVES[code, p]) for p in _PHASES]
        for _ in range(2):
            here = [min(here[p], INSERT + here[_NEXT[p]]) for p in _PHASES]
        bounds.append(here)
    return bounds[::-1]


def cheapest(codes: str, entry: int = _START, exit_: int = _END) -> tuple[int, str] | None:
    """Cost and audit of the best edits that lead from one phase to another, or to a sound end."""
    bounds, n = _suffix_bounds(codes, exit_), len(codes)
    best: tuple[int, str] | None = None
    seen: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, phase, cost, audit = stack.pop()
        bound = cost + bounds[i][phase]
        if bound >= _NEVER:
            continue
        if best and (bound > best[0] or (bound == best[0] and audit > best[1][: len(audit)])):
            continue
        known = seen.get((i, phase))
        if known and known <= (cost, audit):
            continue
        seen[i, phase] = cost, audit
        if i == n and (phase in (_START, _ASSISTANT) if exit_ == _END else phase == exit_):
            if best is None or (cost, audit) < best:
                best = cost, audit
            continue
        nodes = [(i + 1, q, cost + c, audit + name) for name, c, q in _MOVES[codes[i], phase]] if i < n else []
        if i < n or exit_ == _END:
            nodes.append((i, _NEXT[phase], cost + INSERT, audit + "I"))
        nodes.sort(key=lambda x: (x[2] + bounds[x[0]][x[1]], x[3]), reverse=True)  # the most promising one on top
        stack += nodes
    return best


@lru_cache(maxsize=1 << 14)
def segment_table(codes: str, first: bool, last: bool) -> tuple[tuple[int, int, int, str], ...]:
    out = []
    for entry in (_START,) if first else _PHASES:
        for exit_ in (_END,) if last else _PHASES:
            found = cheapest(codes, entry, exit_)
            if found:
                out.append((entry, exit_, *found))
    return tuple(out)


def joined_tables(left: tuple, right: tuple) -> tuple:
    """The table of two neighbouring segments."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for entry, middle, cost, audit in left:
        for start, exit_, more, rest in right:
            if middle == start:
                found = cost + more, audit + rest
                if (entry, exit_) not in best or found < best[entry, exit_]:
                    best[entry, exit_] = found
    return tuple((*k, *v) for k, v in best.items())


_LEGAL = ("su", "ua", "au")


def illegal_pairs(initials: str) -> int:
    return sum(initials[i : i + 2] not in _LEGAL for i in range(len(initials) - 1))


# Rows and their faults


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after the damage that the crc32 of ``conv_id:turn`` calls for."""
    conv_id, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv_id, F.lit(":"), turn)) % 20
    rows = conversations.select("conv_id", "turn", "role", "text", kind.alias("__kind")).filter("__kind <> 0")
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    k = F.col("__kind")
    return rows.select(
        "conv_id",
        "turn",
        F.when(k == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(k == 1, F.lit("")).when(k == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(k == 3, F.lit(2)).otherwise(F.lit(1)))).alias("__copy"),
    ).drop("__copy")


def _filled(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])


def facts(rows: DataFrame) -> DataFrame:
    """One small written row for each row, in order: conv_id, turn, row, initial, fault (of its own) and digest."""
    spark, tie = rows.sparkSession, "__tie"
    order = ["conv_id", "turn", "role", "text", tie]
    ranged = (
        _filled(rows).withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    )
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    sound = F.substring(bare, -1, 1).isin(".", "!", "?")
    initial = F.substring("role", 1, 1)
    return staged(
        ranged.select(
            "conv_id",
            "turn",
            F.monotonically_increasing_id().alias("row"),
            F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o")).alias("initial"),
            F.when(bare == "", F.lit("blank")).when(~sound, F.lit("truncated")).alias("fault"),
            F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))).alias("digest"),
        ),
        "turns",
    )


def judged(found: DataFrame) -> DataFrame:
    """Facts with the first fault of each row: blank, duplicate or truncated; written."""
    firsts = found.groupBy("conv_id", "digest").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.filter("n > 1").drop("n")
    known = left_join(found, firsts, ["conv_id", "digest"], null_keys=True, spread=True)
    again = (F.col("row") > F.col("first")) & ~F.col("fault").eqNullSafe(F.lit("blank"))
    fault = F.when(again, F.lit("duplicate")).otherwise(F.col("fault"))
    code = F.when(fault.isin("blank", "duplicate"), F.lit("x")).when(fault == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    return staged(known.select("conv_id", "turn", "row", "initial", fault.alias("fault"), code.alias("code")), "judged_turns")


def summaries(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, the counts of faults, and the first and last row of each conversation."""
    count = {f: F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")}
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return rows.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *count.values(), F.min("row").alias("first_row"), F.max("row").alias("last_row")
    )


def _ordered(c: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "initial", "code"))), lambda x: x[c]), "")


def segments(rows: DataFrame, ends: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """conv_id, part, at (the first row), first, last, codes and initials of runs of at most 2^bits rows."""
    chunk = F.shiftright(F.col("row"), bits)
    cut = rows.groupBy("conv_id", chunk.alias("chunk")).agg(
        F.min("row").alias("at"), F.max("row").alias("end"), _ordered("code").alias("codes"), _ordered("initial").alias("initials")
    )
    known = left_join(cut, ends, "conv_id", null_keys=True, spread=True)
    return known.select(
        "conv_id",
        F.shiftright("at", _PART_BITS).alias("part"),
        "at",
        (F.col("at") == F.col("first_row")).alias("first"),
        (F.col("end") == F.col("last_row")).alias("last"),
        "codes",
        "initials",
    )


def _rows_of(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _entries(tables: list[tuple]) -> pa.Array:
    return pa.array([[dict(zip(("entry", "exit", "cost", "audit"), e, strict=True)) for e in t] for t in tables], _TABLE)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        get = {n: batch.column(n).to_pylist() for n in ("first", "last", "codes", "initials")}
        tables = [segment_table(c, f, z) for c, f, z in zip(get["codes"], get["first"], get["last"], strict=True)]
        yield _rows_of(
            {
                "conv_id": batch.column("conv_id"),
                "part": batch.column("part"),
                "at": batch.column("at"),
                "illegal": pa.array([illegal_pairs(x) for x in get["initials"]], pa.int64()),
                "head": pa.array([x[:1] for x in get["initials"]], pa.string()),
                "tail": pa.array([x[-1:] for x in get["initials"]], pa.string()),
                "best": _entries(tables),
            }
        )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of neighbouring segments to one segment each; their tables are joined in pairs."""
    for batch in batches:
        out: dict[str, list] = {n: [] for n in ("at", "illegal", "head", "tail", "best")}
        for items in batch.column("items").to_pylist():
            links = sum(a["tail"] + b["head"] not in _LEGAL for a, b in zip(items, items[1:]))
            tables = [tuple(tuple(e[n] for n in ("entry", "exit", "cost", "audit")) for e in x["best"]) for x in items]
            while len(tables) > 1:
                pairs = [joined_tables(a, b) for a, b in zip(tables[::2], tables[1::2])]
                tables = pairs + tables[len(pairs) * 2 :]
            out["at"].append(items[0]["at"])
            out["illegal"].append(sum(x["illegal"] for x in items) + links)
            out["head"].append(items[0]["head"])
            out["tail"].append(items[-1]["tail"])
            out["best"].append(tables[0])
        kinds = {"at": pa.int64(), "illegal": pa.int64(), "head": pa.string(), "tail": pa.string()}
        columns = {n: pa.array(out[n], t) for n, t in kinds.items()}
        yield _rows_of({"conv_id": batch.column("conv_id"), "part": batch.column("part"), **columns, "best": _entries(out["best"])})


def repairs(rows: DataFrame, ends: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """conv_id, illegal, cost and audit of each conversation, from judged rows; written."""
    ship(rows.sparkSession)
    key = f"conv_id {dict(rows.dtypes)['conv_id']}"
    schema = f"{key}, part long, at long, illegal long, head string, tail string, best {TABLE}"
    cut = segments(rows, ends.select("conv_id", "first_row", "last_row"), bits).mapInArrow(_search, schema)
    items = F.array_sort(F.collect_list(F.struct("at", "illegal", "head", "tail", "best"))).alias("items")
    inside = cut.groupBy("conv_id", "part").agg(items).mapInArrow(_merge, schema)  # what one sorted partition holds
    across = inside.groupBy("conv_id", F.lit(0).cast("long").alias("part")).agg(items).mapInArrow(_merge, schema)
    best = F.col("best")[0]
    return staged(across.select("conv_id", "illegal", best["cost"].alias("cost"), best["audit"].alias("audit")), "repairs")


# The repaired rows


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple] | None]]:
    """For each row in turn what it becomes: (conversation's number, lines); lines None ends a conversation.

    A conversation is a row with its audit, then its rows in order.
    """
    number, audit, at, role, ids = -1, "", 0, "", []

    def put_in() -> list[tuple]:
        nonlocal at, role
        lines = []
        while audit[at : at + 1] == "I":
            role = "assistant" if role[:1] == "u" else "user"
            lines.append(("I", role, ""))
            at += 1
        return lines

    for batch in batches:
        columns = (batch.column(n).to_pylist() for n in ("conv_id", "audit", "role", "text"))
        for conv_id, edits, old, text in zip(*columns, strict=True):
            if edits is not None:
                if number >= 0:
                    yield ids[0], put_in()
                    yield ids[0], None
                number, audit, at, role, ids = number + 1, edits, 0, "", [conv_id]
                continue
            lines = put_in()
            edit = audit[at]
            at += 1
            if edit != "D":
                role = old if edit == "K" else "assistant" if role[:1] == "u" else "user"
                lines.append((edit, role, text))
            if lines:
                yield ids[0], lines
    if number >= 0:
        yield ids[0], put_in()
        yield ids[0], None


_FLUSH = 1000


def _turns(kind: pa.DataType):
    names = ["conv_id", "position", "edit", "role", "text"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        position = 0
        for conv_id, lines in _edited(batches):
            if lines is None:
                position = 0
                continue
            for line in lines:
                rows.append((conv_id, position, *line))
                position += 1
            if len(rows) >= _FLUSH:
                yield batch_of(rows)
                rows = []
        yield batch_of(rows)

    return run


def _digests(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        found: list[str] = []
        state, empty = hashlib.sha256(), True
        for conv_id, lines in _edited(batches):
            if lines is None:
                ids.append(conv_id)
                found.append(state.hexdigest())
                state, empty = hashlib.sha256(), True
                if len(ids) >= _FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])
                    ids, found = [], []
                continue
            for _, role, text in lines:
                state.update(f"{'' if empty else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                empty = False
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(found, pa.string())], ["conv_id", "repaired_sha256"])

    return run


def _streams(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, conversation by conversation."""
    blank = {"turn": dict(rows.dtypes)["turn"], "role": "string", "text": "string"}
    heads = audits.select("conv_id", F.lit(0).alias("kind"), "audit", *[F.lit(None).cast(t).alias(n) for n, t in blank.items()])
    bodies = _filled(rows).select("conv_id", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), *blank)
    order = ["conv_id", "kind", "turn", "role", "text"]
    return heads.unionByName(bodies).repartition(partitions(rows.sparkSession), "conv_id").sortWithinPartitions(*order).select("conv_id", "audit", "role", "text")


def _key_type(rows: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return dict(rows.dtypes)["conv_id"], to_arrow_type(rows.schema["conv_id"].dataType)


def repaired_turns(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id, position, edit (K, R or I), role and text of the repaired conversations."""
    ship(rows.sparkSession)
    key, kind = _key_type(rows)
    return _streams(rows, audits).mapInArrow(_turns(kind), f"conv_id {key}, position long, edit string, role string, text string")


def repaired_digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of the repaired ``role:text`` lines."""
    ship(rows.sparkSession)
    key, kind = _key_type(rows)
    return _streams(rows, audits).mapInArrow(_digests(kind), f"conv_id {key}, repaired_sha256 string")


def repair(rows: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """Faults, cheapest edits and the repaired text's digest of each conversation of ``rows`` (conv_id, turn, role, text)."""
    known = judged(facts(rows))
    ends = staged(summaries(known), "conversations")
    found = repairs(known, ends, bits)
    whole = left_join(ends.drop("first_row", "last_row"), found, "conv_id", null_keys=True)
    return left_join(whole, repaired_digests(rows, found.select("conv_id", "audit")), "conv_id", null_keys=True)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Damage the conversations, repair them, and report on every conversation, also those that lost all rows."""
    found = repair(damage(conversations))
    every = left_join(conversations.select("conv_id").distinct(), found, "conv_id", null_keys=True)
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return every.select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")
    )
