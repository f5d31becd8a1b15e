"""Conversation structure repair: generalised LR over the role grammar with
weighted edits.

The grammar of role initials (s system, u user, a assistant) is

    Conversation -> (empty) | Turns        Turns -> Open a
    Open         -> u | s u | Turns u

After the reductions that follow a shift, a stack is empty or has one symbol above the bottom:
s, Open or Turns. These are the tops of the graph-structured stack. Every row is a choice of
actions: keep (shift its role), rerole to user or assistant, delete, and before each of them insert empty turns.
All stacks run at once; stacks with the same top merge and the one of minimum (cost, audit) stays,
linked to the node it came from. Costs and letters: keep K 0, rerole R 3, delete D 4, insert I 3.

Audits are never compared as strings: two stacks that consumed the same rows
have audits of which neither is a prefix of the other, so the order of the nodes (their
rank) decides before the letters of the next action do. A row costs a constant number of steps however long the
conversation is, and the links give the edits back.

How it runs. Conversations of at most ``LIMIT_ROWS`` rows and ``LIMIT_BYTES`` bytes are shuffled
once by id and repaired as a sorted stream. A longer one is spread: its rows are
numbered by a range sort, repeats are found by grouping role and text, and it is cut into
stretches of ``LIMIT_ROWS`` rows. A stretch, without the texts, is run from each of the four tops; its
4 x 4 costs and ranks are all that meets per conversation, and the chosen run of each stretch
gives the edits back to its rows. Both ways give the same result; only the digest of a long conversation
reads its rows in one task, as a stream (a hash of one text is sequential).

Cases. A null role or text counts as one space (an illegal initial; a blank text). Rows are taken by turn, null turns first, equal
turns by role and text. A null conversation id is a conversation. A row whose text has
no character but spaces is blank, one whose role and text came earlier is a duplicate (both must be
deleted), one whose last such character is not ``.!?`` is truncated (3 more unless deleted); the first fault that holds counts. Any role with initial s, u or a may be kept as it is. An empty
table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import rows_of
from ordermart.session import cut_lineage, discard_cut

#: Rows and bytes of a conversation that one task repairs whole; rows of a stretch of a longer one.
LIMIT_ROWS, LIMIT_BYTES = 10_000, 64_000_000
SALTS = 16
RUN, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Stack tops, and the top after shifting a terminal and the reductions that follow.
EMPTY, SYSTEM, OPEN, TURNS = TOPS = range(4)
SHIFT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): OPEN, (SYSTEM, "u"): OPEN, (TURNS, "u"): OPEN, (OPEN, "a"): TURNS}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
_BLANK = " \t\n\x0b\x0c\r"
_MESSAGES = "array<struct<edit:string,turn:bigint,role:string,text:string>>"
_STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
PIECES = f"conv_id long, part long, parts long, {_STATS}, audit string, messages {_MESSAGES}"


def inserted(top: int, n: int) -> tuple[int, list[str]]:
    """The top after inserting ``n`` turns, and their roles."""
    roles = []
    for _ in range(n):
        sign = "a" if top == OPEN else "u"
        top = SHIFT[top, sign]
        roles.append(ROLES[sign])
    return top, roles


@cache
def actions(initial: str, forced: bool, truncated: bool) -> tuple:
    """What a row can do: (top, next top, cost, letters), the least of each pair of tops."""
    best: dict = {}
    for top in TOPS:
        for n in range(3):
            at, _ = inserted(top, n)
            choices = [(DELETE, "D", at)]
            if not forced:
                more = TRUNCATED if truncated else 0
                if (at, initial) in SHIFT:
                    choices.append((RUN + more, "K", SHIFT[at, initial]))
                choices += [(REROLE + more, "R", SHIFT[at, r]) for r in ROLES if (at, r) in SHIFT]
            for cost, letter, to in choices:
                found = (n * INSERT + cost, "I" * n + letter)
                best[top, to] = min(best.get((top, to), found), found)
    return tuple((top, to, *found) for (top, to), found in best.items())


def step(nodes: dict, moves: Iterable[tuple]) -> tuple[dict, dict]:
    """One row for all stacks: nodes top -> (cost, rank). Equal tops merge; returns the new
    nodes and their links top -> (top before, letters)."""
    best: dict = {}
    for top, to, cost, letters in moves:
        node = nodes.get(top)
        if node is not None:
            found = (node[0] + cost, node[1], letters, top)
            if to not in best or found < best[to]:
                best[to] = found
    order = sorted((rank, letters, to) for to, (_, rank, letters, _) in best.items())
    return ({to: (best[to][0], i) for i, (_, _, to) in enumerate(order)},
            {to: (found[3], found[2]) for to, found in best.items()})


def parse(rows: Iterable[tuple], start: int = EMPTY) -> tuple[dict, list[dict]]:
    """Rows (initial, forced, truncated) from one top: the last nodes and the links of each row."""
    nodes, links = {start: (0, 0)}, []
    for row in rows:
        nodes, link = step(nodes, actions(*row))
        links.append(link)
    return nodes, links


def finish(nodes: dict) -> tuple[int, int, int]:
    """The cheapest accepted stack: (cost, top before the last inserts, number of these)."""
    cost, _, tail, top = min((cost + INSERT * n, rank, "I" * n, top) for top, (cost, rank) in nodes.items()
                             for n in range(3) if inserted(top, n)[0] in (EMPTY, TURNS))
    return cost, top, len(tail)


def edits(links: list[dict], end: int) -> list[tuple[int, str]]:
    """The way back from the last top: (top before, letters) of every row."""
    out = []
    for link in reversed(links):
        out.append(link[end])
        end = out[-1][0]
    return out[::-1]


def _messages(before: int, letters: str, turn, role: str, text: str) -> list[dict]:
    """The repaired rows of one row's letters."""
    top, roles = inserted(before, letters.count("I"))
    out = [{"edit": "I", "turn": None, "role": r, "text": ""} for r in roles]
    if letters[-1] == "R":
        role = ROLES["a" if top == OPEN else "u"]
    if letters[-1] != "D":
        out.append({"edit": letters[-1], "turn": turn, "role": role, "text": text})
    return out


def _tail(top: int, n: int) -> list[dict]:
    return [{"edit": "I", "turn": None, "role": r, "text": ""} for r in inserted(top, n)[1]]


def repair_one(rows: list[tuple]) -> tuple:
    """One conversation in order, rows (turn, role, text): (gaps, blank, duplicate, truncated, illegal, cost, audit, messages)."""
    seen, flags, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        solid = text.rstrip(_BLANK)
        fault = ("blank" if not solid else "duplicate" if (role, text) in seen else
                 "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        flags.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[0] + b[0] not in LEGAL for a, b in zip(flags, flags[1:]))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    nodes, links = parse(flags)
    cost, top, n = finish(nodes)
    way = edits(links, top)
    messages = [m for row, (before, letters) in zip(rows, way) for m in _messages(before, letters, *row)] + _tail(top, n)
    return gaps, *faults.values(), illegal, cost, "".join(x for _, x in way) + "I" * n, messages


_ARROW = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("parts", pa.int64()),
                    *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                    ("audit", pa.string()), ("messages", pa.list_(pa.struct(
                        [("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])))])


def _batched(rows: Iterator[tuple], schema: pa.Schema, weight) -> Iterator[pa.RecordBatch]:
    part, size = [], 0
    for row in rows:
        part.append(row)
        size += weight(row)
        if size > 2000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)
            part, size = [], 0
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def _runs(rows: Iterable[tuple], width: int) -> Iterator[tuple[tuple, list]]:
    """Sorted rows by their first ``width`` values: (key, rest of each row)."""
    key, group = None, []
    for row in rows:
        if row[:width] != key:
            if group:
                yield key, group
            key, group = row[:width], []
        group.append(row[width:])
    if group:
        yield key, group


def _repair_stream(batches):
    found = ((conv, 0, 1, *repair_one(rows)) for (conv,), rows in _runs(rows_of(batches, "conv_id", "turn", "role", "text"), 1))
    yield from _batched(found, _ARROW, lambda row: 1 + len(row[-1]))


def _sorted(df: DataFrame, *order: str, by: int = 1) -> DataFrame:
    return df.repartition(*order[:by]).sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in order))


_STRETCH = "conv_id long, stretch long, initials string, illegal long, costs array<int>, ranks array<int>"
_STRETCH_ARROW = pa.schema([("conv_id", pa.int64()), ("stretch", pa.int64()), ("initials", pa.string()), ("illegal", pa.int64()),
                            ("costs", pa.list_(pa.int32())), ("ranks", pa.list_(pa.int32()))])


def _measure(batches):
    """Stretches run from each top: 16 costs and ranks (start, end; -1: no way), and what joins them to their neighbours."""

    def one(key, rows):
        initials = [r[1] for r in rows]
        costs, ranks = [], []
        for start in TOPS:
            nodes, _ = parse((r[1:] for r in rows), start)
            costs += [nodes.get(t, (-1, -1))[0] for t in TOPS]
            ranks += [nodes.get(t, (-1, -1))[1] for t in TOPS]
        return (*key, initials[0] + "\n" + initials[-1], sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), costs, ranks)

    rows = _runs(rows_of(batches, "conv_id", "stretch", "at", "initial", "forced", "truncated"), 2)
    yield from _batched((one(*x) for x in rows), _STRETCH_ARROW, lambda _: 1)


_CHOSEN = "conv_id long, stretch long, top_in int, top_out int, tail int, cost long, illegal long"
_CHOSEN_ARROW = pa.schema([("conv_id", pa.int64()), ("stretch", pa.int64()), *((c, pa.int32()) for c in ("top_in", "top_out", "tail")),
                           ("cost", pa.int64()), ("illegal", pa.int64())])


def _choose(batches):
    """Stretches of a conversation in order: the run chosen in each, with the tail of inserts, cost and illegal pairs of all."""

    def one(conv, rows):
        nodes, links, illegal, last = {EMPTY: (0, 0)}, [], 0, None
        for _, initials, inside, costs, ranks in rows:
            moves = [(a, b, costs[4 * a + b], ranks[4 * a + b]) for a in TOPS for b in TOPS if costs[4 * a + b] >= 0]
            nodes, link = step(nodes, moves)
            links.append(link)
            a, b = initials.split("\n")
            illegal += inside + (last is not None and last + a not in LEGAL)
            last = b
        cost, top, tail = finish(nodes)
        way = [t for t, _ in edits(links, top)]
        return [(conv, row[0], a, b, tail if i == len(rows) - 1 else 0, cost, illegal)
                for i, (row, a, b) in enumerate(zip(rows, way, [*way[1:], top]))]

    rows = _runs(rows_of(batches, "conv_id", "stretch", "initials", "illegal", "costs", "ranks"), 1)
    yield from _batched((x for (conv,), group in rows for x in one(conv, group)), _CHOSEN_ARROW, lambda _: 1)


_EDIT = "at long, before int, letters string, top_out int, tail int"
_EDIT_ARROW = pa.schema([("at", pa.int64()), ("before", pa.int32()), ("letters", pa.string()), ("top_out", pa.int32()), ("tail", pa.int32())])


def _replay(batches):
    """The chosen run of each stretch: the letters of its rows; the tail goes with the last row."""

    def one(rows):
        top_in, top_out, tail = rows[0][:3]
        _, links = parse((r[4:] for r in rows), top_in)
        way = edits(links, top_out)
        for i, (row, (before, letters)) in enumerate(zip(rows, way)):
            yield row[3], before, letters, top_out, tail if i == len(rows) - 1 else 0

    rows = _runs(rows_of(batches, "conv_id", "stretch", "top_in", "top_out", "tail", "at", "initial", "forced", "truncated"), 2)
    yield from _batched((x for _, group in rows for x in one(group)), _EDIT_ARROW, lambda _: 1)


def _blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def _apply(batches):
    for batch in batches:
        out = []
        for conv, at, parts, turn, role, text, before, letters, top, tail, *stats in rows_of(
                [batch], "conv_id", "at", "parts", "turn", "role", "text", "before", "letters", "top_out", "tail",
                "gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
            out.append((conv, at, parts, *stats, letters + "I" * tail,
                        _messages(before, letters, turn, role, text) + _tail(top, tail)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ARROW)], schema=_ARROW)


def _repair_long(rows: DataFrame, limit_rows: int) -> DataFrame:
    """Conversations of any length, spread: a piece for each row."""
    fixed = cut_lineage(rows.withColumn("tie", F.monotonically_increasing_id()).withColumn(
        "print", F.sha2(F.concat_ws("\n", F.length("role"), "role", "text"), 256)))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "tie")]
    numbered = cut_lineage(fixed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "at", F.monotonically_increasing_id()).drop("tie"))
    discard_cut(fixed)
    salts, salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))), F.pmod("at", F.lit(SALTS)).cast("int").alias("salt")
    first = numbered.groupBy(F.col("conv_id").alias("of_conv"), F.col("print").alias("of_print")).agg(
        F.min("at").alias("first_at")).withColumn("of_salt", salts)
    slim = numbered.select("conv_id", "at", "turn", "print", F.substring("role", 1, 1).alias("initial"), _blank(F.col("text")).alias("blank"),
                           (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("open"), salt)
    flagged = slim.join(first, F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("print") == F.col("of_print"))
                        & (F.col("salt") == F.col("of_salt")))
    repeat = F.col("at") > F.col("first_at")
    flags = cut_lineage(flagged.select(
        "conv_id", F.expr(f"at div {int(limit_rows)}").alias("stretch"), "at", "turn", "initial",
        "blank", (~F.col("blank") & repeat).alias("duplicate"), (~F.col("blank") & ~repeat & F.col("open")).alias("truncated"),
        (F.col("blank") | repeat).alias("forced")))
    in_order = ("conv_id", "stretch", "at")
    measured = _sorted(flags, *in_order, by=2).mapInArrow(_measure, _STRETCH)
    chosen = cut_lineage(_sorted(measured, "conv_id", "stretch").mapInArrow(_choose, _CHOSEN))
    of = chosen.select(F.col("conv_id").alias("of_conv"), F.col("stretch").alias("of_stretch"), "top_in", "top_out", "tail")
    ways = _sorted(flags.join(of, F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("stretch") == F.col("of_stretch"))),
                   *in_order, by=2).mapInArrow(_replay, _EDIT)
    count = lambda c: F.count_if(F.col(c)).alias(c)
    stats = flags.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        count("blank"), count("duplicate"), count("truncated"), F.count(F.lit(1)).alias("parts"))
    total = chosen.groupBy(F.col("conv_id").alias("of_conv")).agg(F.max("illegal").alias("illegal"), F.max("cost").alias("cost"))
    whole = cut_lineage(stats.join(total, F.col("conv_id").eqNullSafe(F.col("of_conv"))).drop("of_conv").withColumnRenamed(
        "conv_id", "of_conv").withColumn("of_salt", salts))
    return numbered.select("conv_id", "at", "turn", "role", "text", salt).join(ways, "at").join(
        whole, F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("salt") == F.col("of_salt"))).mapInArrow(_apply, PIECES)


def repair(rows: DataFrame, limit_rows: int = LIMIT_ROWS, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """Repaired conversations of ``rows`` (conv_id, turn, role, text), as pieces in
    order: conv_id, part, parts, the counts and cost of the whole conversation (the
    same in all its pieces), audit and repaired messages (edit K, R or I, turn, role, text) of
    the piece. A conversation within the limits is one piece; a longer one has a
    piece per row."""
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    long = cut_lineage(rows.groupBy(F.col("conv_id").alias("of_conv")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text") + F.octet_length("role")).alias("size")).where(
        (F.col("n") > limit_rows) | (F.col("size") > limit_bytes)).select("of_conv"))
    some = not long.isEmpty()
    is_long = F.col("conv_id").eqNullSafe(F.col("of_conv"))
    short = rows.join(long, is_long, "left_anti") if some else rows
    pieces = _sorted(short, "conv_id", "turn", "role", "text").mapInArrow(_repair_stream, PIECES)
    if some:
        pieces = pieces.unionByName(_repair_long(rows.join(long, is_long, "left_semi"), limit_rows))
    return cut_lineage(pieces)


_DIGEST = f"conv_id long, {_STATS}, audit string, repaired_sha256 string"
_DIGEST_ARROW = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                           ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _digest_stream(batches):
    """Pieces in order -> a row per conversation; the hash follows the stream, no conversation is held."""
    key, sha, audit, stats, started = None, None, [], (), False
    schema = _DIGEST_ARROW

    def row():
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
            (*key, *stats, "".join(audit), sha.hexdigest()), schema)], schema=schema)

    for conv, part_audit, messages, *values in rows_of(batches, "conv_id", "audit", "messages", "gaps", "blank", "duplicate",
                                                       "truncated", "illegal", "cost"):
        if key != (conv,):
            if key is not None:
                yield row()
            key, sha, audit, stats, started = (conv,), hashlib.sha256(), [], values, False
        audit.append(part_audit)
        for m in messages:
            sha.update((("\n" if started else "") + f"{m['role']}:{m['text']}").encode())
            started = True
    if key is not None:
        yield row()


def digest(pieces: DataFrame) -> DataFrame:
    """A row per conversation: its counts, cost, whole audit and the SHA-256 of its repaired ``role:text`` lines."""
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
    whole = pieces.where(F.col("parts") == 1).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
    split = _sorted(pieces.where(F.col("parts") > 1), "conv_id", "part").mapInArrow(_digest_stream, _DIGEST)
    return whole.unionByName(split)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults by the crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its
    text, 2 removes ``.!?`` from it, 3 repeats it, 4 makes its role user. Nulls are one space (turn and id stay null)."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")
