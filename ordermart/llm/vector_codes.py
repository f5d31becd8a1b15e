"""Vector code compression (product codes): every part of a vector becomes the
index of its nearest codebook entry, with norm-of-sum bounds in place of most distances.

How it runs. Components are whole numbers (``floor(scale * x)``), so distances,
ties and means are exact. A vector row carries its state from round to round
through a table in the shared folder: its entry per part, an upper bound of the
distance to it and, per group of codebook entries, a lower bound of the distance to
the others; each bound has the stamp of the round it was measured in.

The codebooks of all rounds are kept (a few KB each, their size follows the parameters
only). A bound measured in round s holds in round t after it is moved by the true net
displacement ``|C_t[j] - C_s[j]|`` of the entry, the norm of the sum of its moves, which is never
more than the sum of the norms. A part is done when its upper bound stays under all
its lower bounds; else the one distance to its own entry is measured and the test
repeated; only groups that still fail are scanned again, exactly. The comparison is strict,
so an entry that ties is always scanned, and the lower index wins.

Sums and counts of the assigned parts leave each task as one row per codebook
cell, are added up in Spark, and the driver receives as many numbers as a codebook has. No row is
shuffled in the rounds. The error per label is pre-aggregated and joined back salted.

Cases. Rows whose vector is null or holds null, NaN or infinite components are
dropped. The dimension is that of the smallest id whose vector's length is a
positive multiple of ``parts``; vectors of another length are dropped as well. Null ids come after all ids in the choice of
starting entries, equal ids are ordered by their vectors; all are coded. Components
beyond +-2**25 after scaling are taken as +-2**25. With fewer kept rows than ``entries`` the
codebooks are that much smaller. Null labels are one label. An empty table gives an empty result. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.session import cut_lineage, discard_cut

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Groups of codebook entries that share a lower bound, and salts of the join of label totals.
GROUPS, SALTS = 2, 16
LIMIT = 2**25
_STATE = "x binary, code binary, upper binary, upper_at binary, lower binary, lower_at binary"
_FIELDS = ("x", "code", "upper", "upper_at", "lower", "lower_at")


class State(NamedTuple):
    """Bounds of n vectors: code (n, P); upper (n, P) and lower (n, P, G) with the rounds they were measured in."""

    code: np.ndarray
    upper: np.ndarray
    upper_at: np.ndarray
    lower: np.ndarray
    lower_at: np.ndarray


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances (n, K) of rows x (n, L) to entries c (K, L), int64."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * top * top * x.shape[1] < 2**53:  # products and sums are whole numbers that a double holds
        xf, cf = x.astype(np.float64), c.astype(np.float64)
        return ((xf * xf).sum(1)[:, None] - 2 * (xf @ cf.T) + (cf * cf).sum(1)).astype(np.int64)
    out = np.zeros((len(x), len(c)), np.int64)
    for j in range(x.shape[1]):
        out += np.square(x[:, j, None] - c[:, j])
    return out


def _own(x: np.ndarray, c: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Exact squared distance of each part to its entry: (n, P)."""
    return np.square(x - c[np.arange(c.shape[0]), code]).sum(2)


def _group_starts(entries: int, groups: int) -> np.ndarray:
    return np.arange(min(groups, entries)) * entries // min(groups, entries)


def _down(v: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(v).astype(np.float32), np.float32(-np.inf))


def _up(v: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(v).astype(np.float32), np.float32(np.inf))


def _least_others(d2: np.ndarray, code: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per group, the least squared distance to an entry other than the assigned one (inf: none): (n, G)."""
    d = d2.astype(np.float64)
    d[np.arange(len(d)), code] = np.inf
    return np.minimum.reduceat(d, starts, axis=1)


def first_scan(x: np.ndarray, c: np.ndarray, groups: int = GROUPS) -> State:
    """Measure all distances: x (n, P, L), codebooks c (P, K, L)."""
    n, parts = x.shape[:2]
    starts = _group_starts(c.shape[1], groups)
    code = np.empty((n, parts), np.uint8)
    upper, lower = np.empty((n, parts), np.float32), np.empty((n, parts, len(starts)), np.float32)
    for p in range(parts):
        d2 = squared(x[:, p], c[p])
        code[:, p] = best = d2.argmin(1)
        upper[:, p] = _up(d2[np.arange(n), best])
        lower[:, p] = _down(_least_others(d2, best, starts))
    return State(code, upper, np.zeros_like(code), lower, np.zeros(lower.shape, np.uint8))


def _moves(history: np.ndarray) -> np.ndarray:
    """Net displacement of every entry from each earlier round to the last: (rounds, P, K)."""
    return np.sqrt(np.square(history[:-1] - history[-1]).sum(3))


def _largest_moves(moves: np.ndarray, starts: np.ndarray):
    """Per group the largest net displacement, its entry, and the largest without that entry."""
    edges = [*starts.tolist(), moves.shape[2]]
    shape = (*moves.shape[:2], len(starts))
    first, which, second = np.zeros(shape), np.zeros(shape, np.int64), np.zeros(shape)
    for g, (a, b) in enumerate(zip(edges, edges[1:])):
        order = np.sort(moves[:, :, a:b], axis=2)
        first[:, :, g], which[:, :, g] = order[:, :, -1], a + moves[:, :, a:b].argmax(2)
        second[:, :, g] = order[:, :, -2] if b - a > 1 else 0
    return first, which, second


def next_scan(x: np.ndarray, history: np.ndarray, state: State) -> tuple[State, np.ndarray]:
    """Assign the parts to the last codebooks of ``history`` (rounds, P, K, L): the new
    state and the number of groups scanned per part (0: the bounds sufficed)."""
    now, c = len(history) - 1, history[-1]
    n, parts, groups = state.lower.shape
    starts = _group_starts(c.shape[1], groups)
    of_group = np.searchsorted(starts, np.arange(c.shape[1]), side="right") - 1
    moves = _moves(history)
    first, which, second = _largest_moves(moves, starts)
    code, scanned = state.code.astype(np.int64), np.zeros((n, parts), np.int64)
    p_of, g_of = np.arange(parts)[None, :], np.arange(groups)[None, None, :]
    upper = state.upper + moves[state.upper_at, p_of, code]
    at = state.lower_at, p_of[:, :, None], g_of
    lower = state.lower - np.where(which[at] == code[:, :, None], second[at], first[at])
    least = lower.min(2)
    rest = ~(upper * (1 + 1e-9) < least)
    out = State(state.code.copy(), *(a.copy() for a in state[1:]))
    for p in np.flatnonzero(rest.any(0)).tolist():
        rows = np.flatnonzero(rest[:, p])
        xp, old = x[rows, p], code[rows, p]
        own = np.square(xp - c[p, old]).sum(1)
        out.upper[rows, p], out.upper_at[rows, p] = _up(own), now
        fails = ~((np.sqrt(own) * (1 + 1e-9))[:, None] < lower[rows, p])
        best, entry = own.copy(), old.copy()
        for g, (a, b) in enumerate(zip(starts.tolist(), [*starts[1:].tolist(), c.shape[1]])):
            hit = np.flatnonzero(fails[:, g])
            if not len(hit):
                continue
            scanned[rows[hit], p] += 1
            d2 = squared(xp[hit], c[p, a:b])
            k = d2.argmin(1)
            d, k = d2[np.arange(len(hit)), k], k + a
            closer = (d < best[hit]) | ((d == best[hit]) & (k < entry[hit]))
            best[hit], entry[hit] = np.where(closer, d, best[hit]), np.where(closer, k, entry[hit])
        for g, (a, b) in enumerate(zip(starts.tolist(), [*starts[1:].tolist(), c.shape[1]])):
            hit = np.flatnonzero(fails[:, g])
            if len(hit):  # all but the new own entry
                d = squared(xp[hit], c[p, a:b]).astype(np.float64)
                mine = np.flatnonzero(of_group[entry[hit]] == g)
                d[mine, entry[hit][mine] - a] = np.inf
                out.lower[rows[hit], p, g], out.lower_at[rows[hit], p, g] = _down(d.min(1)), now
            # an unscanned group that gets the old entry back among its others
            back = np.flatnonzero(~fails[:, g] & (entry != old) & (of_group[old] == g))
            if len(back):
                out.lower[rows[back], p, g] = np.minimum(
                    np.nextafter(lower[rows[back], p, g].astype(np.float32), np.float32(-np.inf)), _down(own[back]))
                out.lower_at[rows[back], p, g] = now
        changed = entry != old
        out.code[rows[changed], p] = entry[changed]
        out.upper[rows[changed], p] = _up(best[changed])
    return out, scanned


def _rows_of_vectors(batch: pa.RecordBatch, dim: int, scale: int, parts: int) -> np.ndarray:
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    x = np.clip(np.floor(flat * scale), -LIMIT, LIMIT).astype(np.int64)
    return x.reshape(batch.num_rows, parts, dim // parts)


def _load(batch: pa.RecordBatch, parts: int, groups: int) -> tuple[np.ndarray, State]:
    def col(name, kind, *shape):
        return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(batch.num_rows, *shape)

    return col("x", np.int32, parts, -1).astype(np.int64), State(
        col("code", np.uint8, parts), col("upper", np.float32, parts), col("upper_at", np.uint8, parts),
        col("lower", np.float32, parts, groups), col("lower_at", np.uint8, parts, groups))


def _round(history: np.ndarray, dim: int, scale: int, groups: int, label_type: pa.DataType):
    """One round over a partition: state rows, then a row per codebook cell of the partition's sums."""
    parts, entries, length = history.shape[1:]
    groups = len(_group_starts(entries, groups))
    names = ["cell", "n", "total", "vec_id", "label", *_FIELDS]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), label_type, *[pa.binary()] * len(_FIELDS)]

    def run(batches):
        totals, counts = np.zeros((parts, entries, length), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if len(history) == 1:
                x = _rows_of_vectors(batch, dim, scale, parts)
                state = first_scan(x, history[0], groups)
            else:
                x, state = _load(batch, parts, groups)
                state, _ = next_scan(x, history, state)
            for p in range(parts):
                np.add.at(totals[p], state.code[:, p], x[:, p])
                counts[p] += np.bincount(state.code[:, p], minlength=entries)
            cols = [x.astype(np.int32), *state]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, kinds[0]), pa.nulls(n, kinds[1]), pa.nulls(n, kinds[2]), batch.column("vec_id"), batch.column("label"),
                 *(pa.array([row.tobytes() for row in a], pa.binary()) for a in cols)], names)
        cells = np.flatnonzero(np.repeat(counts.ravel(), length))
        if len(cells):
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells.astype(np.int32)), pa.array(np.repeat(counts.ravel(), length)[cells]),
                 pa.array(totals.ravel()[cells]), *(pa.nulls(len(cells), k) for k in kinds[3:])], names)

    return run


def _last(history: np.ndarray, groups: int):
    parts, entries = history.shape[1:3]
    groups = len(_group_starts(entries, groups))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, state = _load(batch, parts, groups)
            state, _ = next_scan(x, history, state)
            error = _own(x, history[-1], state.code.astype(np.int64)).sum(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.array([r.tobytes() for r in state.code], pa.binary()), pa.array(error)], ["vec_id", "label", "code", "error"])

    return run


def moved(codebooks: np.ndarray, cells: list) -> np.ndarray:
    """Codebooks whose entries are the floored means of their parts; unused ones stay. ``cells``: (cell, n, total)."""
    new = codebooks.copy().ravel()
    for cell, n, total in cells:
        new[cell] = total // n
    return new.reshape(codebooks.shape)


def codebooks_sha256(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(embeddings: DataFrame, vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: int = SCALE, groups: int = GROUPS) -> tuple[DataFrame, np.ndarray]:
    """Codes of all usable vectors, (vec_id, label, code binary, error long), and the final codebooks (P, K, L)."""
    if not 0 < entries <= 256 or rounds > 250:
        raise ValueError("a code is a byte: 1 to 256 entries, at most 250 rounds")
    spark = embeddings.sparkSession
    label_type = embeddings.schema["label"].dataType.simpleString()
    coded = f"vec_id long, label {label_type}, code binary, error long"
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                             F.col(vector_col).cast("array<double>").alias("vector")).where(
        F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))))
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector").asc()]
    head = rows.where((F.size("vector") > 0) & (F.size("vector") % parts == 0)).orderBy(*order).limit(1).collect()
    if not head:
        return spark.createDataFrame([], coded), np.zeros((parts, 0, 0), np.int64)
    dim = len(head[0]["vector"])
    rows = rows.where(F.size("vector") == dim)
    start = np.array([r["vector"] for r in rows.orderBy(*order).limit(entries).collect()], np.float64)
    start = np.clip(np.floor(start * scale), -LIMIT, LIMIT).astype(np.int64)
    history = start.reshape(len(start), parts, dim // parts).transpose(1, 0, 2)[None]
    arrow_label = rows.limit(0).select("label").toArrow().schema.field("label").type
    schema = f"cell int, n long, total long, vec_id long, label {label_type}, {_STATE}"
    state, before = rows, None
    for _ in range(rounds):
        table = cut_lineage(state.mapInArrow(_round(history, dim, scale, groups, arrow_label), schema))
        if before is not None:
            discard_cut(before)
        before = table
        cells = (table.where(F.col("cell").isNotNull()).groupBy("cell")
                 .agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())  # one row a codebook component
        history = np.concatenate([history, moved(history[-1], cells)[None]])
        state = table.where(F.col("cell").isNull()).select("vec_id", "label", *_FIELDS)
    if rounds == 0:
        table = cut_lineage(state.mapInArrow(_round(history, dim, scale, groups, arrow_label), schema))
        state = table.where(F.col("cell").isNull()).select("vec_id", "label", *_FIELDS)
        history = np.concatenate([history, history])
    out = cut_lineage(state.mapInArrow(_last(history, groups), coded))
    discard_cut(table)
    return out, history[-1]


def with_label_error(coded: DataFrame, salts: int = SALTS) -> DataFrame:
    """``coded`` with the sum of ``error`` over equal labels; a label in most rows is spread over ``salts`` keys."""
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error")).select(
        F.col("label").alias("of_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("of_salt"))
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)).cast("int"))
    return salted.join(totals, (F.col("salt") == F.col("of_salt")) & F.col("label").eqNullSafe(F.col("of_label")), "left").drop(
        "salt", "of_salt", "of_label")
