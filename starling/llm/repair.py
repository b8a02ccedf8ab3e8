"""Conversations repaired at least cost: depth-first branch and bound over edits of their turns.

A repaired conversation has the role initials ``(s?(ua)+)?``. Every turn is kept (cost 0), given the
role ``user`` or ``assistant`` (1) or deleted (2, the only way for a blank or repeated turn), and an
empty ``user`` or ``assistant`` turn can be put in anywhere (5); a truncated turn that stays adds 5.
The cheapest edits win, of equally cheap ones those whose initials (``audit``) come first in ASCII.

A conversation of any length is cut in pieces of at most ``block`` turns. A piece inside a
conversation is searched once for each state of the role grammar before and after it, and the pieces
are chained in order, four states at a time; nearly all conversations are one piece and need one
search. Equal turns are one row with a count from the first shuffle on, so a turn that occurs very
often is one row. Texts never pass through Python for the search.

Defined results: a NULL conversation id is an id like others; NULL roles and texts are one blank;
turns go by number, NULLs first, then by role and text; an empty table gives empty results; columns
beyond the four are ignored; texts may have any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import replicate
from .common import batch_of, stored

_BLANKS = " \t\n\x0b\x0c\r"

# States of the grammar, by what was put out last: nothing, a system turn, a user turn, a reply.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
# What a new role or a new turn is in each state, and what it takes to end there.
_NEEDED = "uuau"
_CLOSING = {0: (0, ""), 1: (10, "II"), 2: (5, "I"), 3: (0, "")}
_LEGAL = ("su", "ua", "au")
_CLEAN, _TRUNCATED, _MUST_GO = range(3)


# For the bounds, a system turn alone and a reply are one state: both want the user's turn next.
_RELAXED = (0, 1, 2, 1)
_RELAXED_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 1})
_NEVER = 1 << 60


def _suffix_bounds(
    turns: list[tuple[str, int]], leave: dict[int, tuple[int, str]]
) -> list[tuple[int, int, int]]:
    """What the turns from each place on cost at least, for each state of the relaxed grammar in
    which a conversation may as well end after its system turn."""
    ends = [_NEVER] * 3
    for state, (cost, _) in leave.items():
        ends[_RELAXED[state]] = min(ends[_RELAXED[state]], cost)
    bounds = [tuple(ends)]
    for initial, fault in reversed(turns):
        after = bounds[-1]
        stays = 5 if fault == _TRUNCATED else 0
        over = []
        for state, following in enumerate(_RELAXED_NEXT):
            cost = 2 + after[state]
            if fault != _MUST_GO:
                given = following["a" if state == 2 else "u"]
                cost = min(cost, 1 + stays + after[given])
                if initial in following:
                    cost = min(cost, stays + after[following[initial]])
            over.append(cost)
        # One or two insertions ahead of the turn; more lead back to a state for nothing.
        bounds.append((
            min(over[0], 5 + over[2], 10 + over[1]), min(over[1], 5 + over[2]),
            min(over[2], 5 + over[1]),
        ))
    bounds.reverse()
    return bounds


def cheapest_edits(
    turns: list[tuple[str, int]], entry: int = 0, leave: dict[int, tuple[int, str]] | None = None
) -> tuple[int, str] | None:
    """The least ``(cost, audit)`` over all edits of ``turns``, pairs of role initial and fault.

    The search starts in the state ``entry`` and may end in those of ``leave``, each with the cost
    and letters that closing it takes; None where no edits lead there. Prefixes lie on an explicit
    stack. One is given up when its cost and the bound of what is left cannot beat the incumbent, or
    when its place and state were reached by a lesser (cost, audit): whatever completes the one
    completes the other. The search ends when the stack is empty, which proves the incumbent best.
    """
    leave = _CLOSING if leave is None else leave
    bounds = _suffix_bounds(turns, leave)
    incumbent: tuple[int, str] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, "", 0, entry)]
    while stack:
        cost, audit, i, state = stack.pop()
        least = cost + bounds[i][_RELAXED[state]]
        if least >= _NEVER:
            continue
        if incumbent is not None:
            if (least, audit) > (incumbent[0], incumbent[1][: len(audit)]):
                continue
        known = reached.get((i, state))
        if known is not None and known <= (cost, audit):
            continue
        reached[i, state] = (cost, audit)
        if i == len(turns):
            if state in leave:
                end = (cost + leave[state][0], audit + leave[state][1])
                incumbent = end if incumbent is None else min(incumbent, end)
            continue
        initial, fault = turns[i]
        given = _NEXT[state][_NEEDED[state]]
        nodes = [(cost + 2, audit + "D", i + 1, state), (cost + 5, audit + "I", i, given)]
        if fault != _MUST_GO:
            stays = 5 if fault == _TRUNCATED else 0
            nodes.append((cost + 1 + stays, audit + "R", i + 1, given))
            if initial in _NEXT[state]:
                nodes.append((cost + stays, audit + "K", i + 1, _NEXT[state][initial]))
        # The most promising prefix comes off the stack first.
        nodes.sort(key=lambda node: (node[0] + bounds[node[2]][_RELAXED[node[3]]], node[1]), reverse=True)
        stack.extend(nodes)
    return incumbent


def _with_copies(audit: str, copies: list[int]) -> str:
    """The audit with a ``d`` for every further copy of a turn, right behind the turn's own letter.

    At each turn all audits get the same letters, so the least one stays the least.
    """
    if max(copies, default=1) == 1:
        return audit
    out, at = [], iter(copies)
    for letter in audit:
        out.append(letter if letter == "I" else letter + "d" * (next(at) - 1))
    return "".join(out)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with a defect in a fifth or so of the rows.

    By ``crc32("conv_id:turn") % 20``: 0 drops the row, 1 empties its text, 2 takes ``.!?`` out of
    it, 3 repeats it, 4 makes it the user's.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn"))) % 20
    rows = conversations.select(
        "conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"),
        kind.alias("kind"),
    ).where("kind <> 0")
    text = (
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       F.explode(times).alias("copy")).drop("copy")


def _turns(conversations: DataFrame) -> DataFrame:
    """Distinct turns with their number of copies and whether an earlier turn says the same.

    Only (conversation, role, text) found in several turns are compared; they are copied to where the
    turns lie if they measure little, and joined by a shuffle otherwise.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = conversations.select("conv_id", "turn", blank("role"), blank("text"))
    turns = stored(rows.groupBy("conv_id", "turn", "role", "text")
                   .agg(F.count(F.lit(1)).alias("copies")), "turns")
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    digest = F.sha2("text", 256)
    said = (
        turns.groupBy("conv_id", "role", digest.alias("digest"))
        .agg(F.min(when).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select(F.col("conv_id").alias("said_in"), F.col("role").alias("said_by"), "digest",
                F.col("first.known").alias("first_known"), F.col("first.turn").alias("first_turn"))
    )
    turns = turns.withColumn("said", digest)
    same = (F.col("conv_id").eqNullSafe(F.col("said_in")) & (F.col("role") == F.col("said_by"))
            & (F.col("said") == F.col("digest")))
    first = F.struct(F.col("first_known").alias("known"), F.col("first_turn").alias("turn"))
    met = turns.join(replicate(said), same, "left")
    return met.select(
        "conv_id", "turn", "role", "text", "copies",
        F.coalesce(F.col("digest").isNotNull() & (when > first), F.lit(False)).alias("said_before"),
    )


def _placed(conversations: DataFrame) -> DataFrame:
    """The distinct turns in order, over as many tasks as their size asks for: conversation, turn,
    role, text; with their slice, their place in it and their first fault."""
    end = F.right(F.rtrim(F.col("text"), F.lit(_BLANKS)), F.lit(1))
    fault = (
        F.when(end == "", "blank").when(F.col("said_before"), "duplicate")
        .when(~end.isin(".", "!", "?"), "truncated").otherwise("")
    )
    turns = stored(_turns(conversations).withColumn("fault", fault), "faults")
    start = F.substring("text", 1, 32)
    order = ["conv_id", "turn", "role"]
    # The start of a text ties as the text does, and is short enough to draw range boundaries from.
    sliced = turns.repartitionByRange(*order, start).sortWithinPartitions(*order, "text")
    number = F.monotonically_increasing_id()
    slice_, place = F.shiftright(number, 33), number.bitwiseAND(F.lit((1 << 33) - 1))
    return stored(sliced.withColumns({"slice": slice_, "place": place}), "placed")


_PIECE = pa.schema([
    ("slice", pa.int64()), ("block", pa.int64()), ("first", pa.int64()), ("turns", pa.int64()),
    ("initials", pa.string()), ("illegal", pa.int64()), ("whole", pa.bool_()),
    ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())),
])
_FAULTS = {"": _CLEAN, "truncated": _TRUNCATED, "blank": _MUST_GO, "duplicate": _MUST_GO}


def _piece(rows: list[tuple], whole: bool, block: int) -> dict:
    """One conversation's turns in a block, searched from the start to a proper end if they are all
    of it, else from every state to every state."""
    turns = [(row[3], _FAULTS[row[4]]) for row in rows]
    copies = [row[5] for row in rows]
    extra = 2 * (sum(copies) - len(copies))
    if whole:
        found = [cheapest_edits(turns)]
    else:
        found = [cheapest_edits(turns, a, {b: (0, "")}) for a in range(4) for b in range(4)]
    pairs = zip(turns, turns[1:])
    return {
        "slice": rows[0][0], "block": rows[0][1] // block, "first": rows[0][1], "turns": len(rows),
        # Initials may be empty or any character; one that is not legal anywhere is written "x".
        "initials": "".join(t[0] if t[0] in ("s", "u", "a") else "x" for t in (turns[0], turns[-1])),
        "illegal": sum(a[0] + b[0] not in _LEGAL for a, b in pairs) + sum(copies) - len(copies),
        "whole": whole,
        "costs": [None if f is None else f[0] + extra for f in found],
        "audits": [None if f is None else _with_copies(f[1], copies) for f in found],
    }


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _search(id_type: pa.DataType, size: int):
    schema = _PIECE.insert(0, pa.field("conv_id", id_type))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in groupby(_rows(batches), key=lambda row: (row[0], row[1] // size)):
            talks = [list(rows) for _, rows in groupby(block, key=lambda row: row[2])]
            # Only the first and last one of a block can go on in another block.
            pieces = [_piece(rows, 0 < i < len(talks) - 1, size) for i, rows in enumerate(talks)]
            ids = {"conv_id": [rows[0][2] for rows in talks]}
            yield batch_of(schema, {**{n: [p[n] for p in pieces] for n in _PIECE.names}, **ids})

    return search


_SOLVED = pa.schema([
    ("slice", pa.int64()), ("block", pa.int64()), ("first", pa.int64()), ("letters", pa.string()),
    ("before", pa.int64()), ("system", pa.bool_()), ("cost", pa.int64()), ("illegal", pa.int64()),
    ("audit", pa.string()),
])


def _put_out(letters: str) -> int:
    return len(letters) - letters.count("D") - letters.count("d")


def _chain(id_type: pa.DataType):
    schema = _SOLVED.insert(0, pa.field("conv_id", id_type))
    names = ["conv_id", "slice", "block", "first", "turns", "initials", "illegal", "whole", "costs",
             "audits"]

    def one(conv_id, pieces: Iterator[dict]) -> pa.RecordBatch:
        best, parts, illegal, last = {0: (0, "")}, [], 0, ""
        whole = None
        for piece in pieces:
            illegal += piece["illegal"] + bool(last and last + piece["initials"][0] not in _LEGAL)
            last = piece["initials"][1]
            parts.append((piece["slice"], piece["block"], piece["first"], piece["turns"]))
            if piece["whole"]:
                whole = (piece["costs"][0], piece["audits"][0])
                continue
            ways = [(a, b, piece["costs"][4 * a + b], piece["audits"][4 * a + b])
                    for a in best for b in range(4)]
            after: dict[int, tuple[int, str]] = {}
            for a, b, cost, audit in ways:
                if cost is not None:
                    way = (best[a][0] + cost, best[a][1] + audit)
                    after[b] = min(after.get(b, way), way)
            best = after
        cost, audit = whole or min(
            (c + _CLOSING[state][0], a + _CLOSING[state][1]) for state, (c, a) in best.items())
        out, at, before = {n: [] for n in schema.names}, 0, 0
        system = _put_out(audit) % 2 == 1
        for i, (slice_, block, first, turns) in enumerate(parts):
            end = at
            for _ in range(turns):  # insertions, the turn's own letter, its further copies
                while audit[end] == "I":
                    end += 1
                end += 1
                while end < len(audit) and audit[end] == "d":
                    end += 1
            final = i == len(parts) - 1
            letters = audit[at:] if final else audit[at:end]
            row = (conv_id, slice_, block, first, letters, before, system,
                   cost if final else None, illegal if final else None,
                   audit.replace("d", "D") if final else None)
            for name, value in zip(schema.names, row):
                out[name].append(value)
            before += _put_out(letters)
            at = end
        return batch_of(schema, out)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (dict(zip(names, row)) for row in _rows(batches))
        for conv_id, pieces in groupby(rows, key=lambda piece: piece["conv_id"]):
            yield one(conv_id, pieces)

    return chain


def _spark_type(schema: pa.Schema, id_type: str) -> str:
    from pyspark.sql.pandas.types import from_arrow_schema

    return ", ".join([f"conv_id {id_type}"] + [
        f"`{f.name}` {f.dataType.simpleString()}" for f in from_arrow_schema(schema)])


def _solved(placed: DataFrame, size: int) -> DataFrame:
    """A row per conversation and block: the letters of its turns, the number of turns put out
    before, whether a system turn opens the conversation; on the last one cost and audit as well."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = placed.schema["conv_id"].dataType
    id_type, id_name = to_arrow_type(kind), kind.simpleString()
    block = F.floor(F.col("place") / size)
    pieces = (
        placed.select("slice", "place", "conv_id", F.left("role", F.lit(1)).alias("initial"), "fault",
                      "copies")
        .repartition("slice", block).sortWithinPartitions("slice", "place")
        .mapInArrow(_search(id_type, size), _spark_type(_PIECE, id_name))
    )
    names = ["conv_id", "slice", "block", "first", "turns", "initials", "illegal", "whole", "costs",
             "audits"]
    return stored(
        pieces.select(*names).repartition("conv_id").sortWithinPartitions("conv_id", "slice", "block")
        .mapInArrow(_chain(id_type), _spark_type(_SOLVED, id_name)),
        "solved",
    )


def _role_at(index: Column) -> Column:
    """The role of the turn put out at ``index``, where it is a new or changed one."""
    return F.when((index - F.col("system").cast("int")) % 2 == 0, "user").otherwise("assistant")


def _messages(placed: DataFrame, solved: DataFrame, size: int) -> DataFrame:
    """``conv_id, index, edit, role, text``: the repaired conversations, a row per turn."""
    letters = F.regexp_extract_all(F.col("letters"), F.lit("I*[KRD]d*"), F.lit(0))
    parts = solved.select(
        F.col("conv_id").alias("of"), F.col("slice").alias("in_slice"), F.col("block"), "first",
        letters.alias("parts"), "before", "system",
    )
    same = (F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("in_slice"))
            & (F.floor(F.col("place") / size) == F.col("block")))
    at = (F.col("place") - F.col("first")).cast("int")
    earlier = F.array_join(F.slice("parts", F.lit(1), at), "")
    turns = placed.select("conv_id", "slice", "place", "role", "text").join(parts, same).select(
        "conv_id", "role", "text", "system", F.get("parts", at).alias("own"),
        (F.col("before") + F.length(F.translate(earlier, "Dd", ""))).alias("index"),
    )
    own = F.translate("own", "d", "")
    put_in = F.length(own) - 1
    insertion = lambda i: F.struct(
        i.alias("index"), F.lit("insert").alias("edit"), _role_at(i).alias("role"), F.lit("").alias("text"))
    changed = F.endswith(own, F.lit("R"))
    index = F.col("index") + put_in
    turn = F.struct(
        index.alias("index"), F.when(changed, "rerole").otherwise("keep").alias("edit"),
        F.when(changed, _role_at(index)).otherwise(F.col("role")).alias("role"), F.col("text").alias("text"))
    none = F.expr("cast(array() as array<struct<index: bigint, edit: string, role: string, text: string>>)")
    new = F.when(put_in > 0, F.transform(
        F.sequence(F.col("index"), index - 1), insertion)).otherwise(none)
    kept = F.when(F.endswith(own, F.lit("D")), none).otherwise(F.array(turn))
    edited = turns.select("conv_id", F.inline(F.concat(new, kept)))
    count = F.length(F.translate("letters", "Dd", ""))
    closing = F.length(F.regexp_extract("letters", "(I*)$", 1))
    ends = solved.where(F.col("audit").isNotNull() & F.endswith("letters", F.lit("I")))
    ends = ends.select("conv_id", "system", (F.col("before") + count - closing).alias("index"),
                       (F.col("before") + count - 1).alias("end"))
    last = ends.select("conv_id", F.inline(F.transform(F.sequence("index", "end"), insertion)))
    return edited.unionByName(last)


def repair(conversations: DataFrame, block: int = 256) -> tuple[DataFrame, DataFrame]:
    """``(report, messages)`` of ``conv_id, turn, role, text``.

    The report has a row per conversation: ``gaps`` in its turn numbers, turns that are ``blank``,
    ``duplicate`` or ``truncated`` (the first that holds), ``illegal`` neighbours, ``cost`` and
    ``audit`` of the repair. The messages are the repaired turns: ``conv_id, index, edit, role, text``.
    ``block`` is the number of turns searched at once; it does not change the result.
    """
    placed = _placed(conversations)
    solved = _solved(placed, block)
    fault = F.col("fault")
    total = lambda n: F.coalesce(F.sum(n), F.lit(0))
    # A further copy of a turn is a duplicate, of a blank one a blank one.
    copies = total(F.when(fault != "blank", F.col("copies") - 1))
    wide = lambda c: c.cast("decimal(38,0)")
    counts = placed.groupBy(F.col("conv_id").alias("of")).agg(
        F.coalesce(wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count_distinct("turn"), F.lit(0))
        .try_cast("bigint").alias("gaps"),
        total(F.when(fault == "blank", F.col("copies"))).alias("blank"),
        (total((fault == "duplicate").cast("int")) + copies).alias("duplicate"),
        total((fault == "truncated").cast("int")).alias("truncated"),
    )
    ends = solved.where("audit IS NOT NULL").select("conv_id", "illegal", "cost", "audit")
    report = ends.join(counts, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return report, _messages(placed, solved, block)


def message_digests(messages: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: of ``role:text`` of a conversation's turns, joined by line ends.

    The turns of a conversation run through one hash in order, as the digest asks for, one after the
    other: no conversation is held in memory.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = messages.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(kind)), ("repaired_sha256", pa.string())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {"conv_id": [], "repaired_sha256": []}
        for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
            digest, joint = hashlib.sha256(), ""
            for _, line in rows:
                digest.update((joint + line).encode("utf-8"))
                joint = "\n"
            out["conv_id"].append(conv_id)
            out["repaired_sha256"].append(digest.hexdigest())
            if len(out["conv_id"]) == 4096:
                yield batch_of(schema, out)
                out = {"conv_id": [], "repaired_sha256": []}
        yield batch_of(schema, out)

    lines = messages.select("conv_id", "index", F.concat_ws(":", "role", "text").alias("line"))
    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "index")
    return ordered.select("conv_id", "line").mapInArrow(
        digests, f"conv_id {kind.simpleString()}, repaired_sha256 string")


def repair_report(conversations: DataFrame, repaired: DataFrame, block: int = 256) -> DataFrame:
    """The report on ``repaired``, with the digest of every repaired conversation, for every
    conversation of ``conversations``; one without turns left has zeros and nothing to digest."""
    report, messages = repair(repaired, block)
    ids = conversations.select("conv_id").distinct()
    facts = report.withColumnRenamed("conv_id", "of")
    digests = message_digests(messages).withColumnRenamed("conv_id", "digest_of")
    joined = ids.join(facts, F.col("conv_id").eqNullSafe(F.col("of")), "left").join(
        digests, F.col("conv_id").eqNullSafe(F.col("digest_of")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
