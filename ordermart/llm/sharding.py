"""Sharding: minimax contiguous partition of ordered atomic groups, in
built-in functions.

Rows with equal texts form a group that no shard may split. Groups are ordered
by the SHA-256 of their text; the partition into contiguous runs, one a shard,
has the smallest possible largest shard. That capacity is found by binary
search, a candidate being checked greedily: fill each shard while the next
group fits. The cuts are those of the greedy fill at that capacity. A group larger
than an equal share would force its capacity on all shards, so such groups
(fewer than the shards) get a shard each first, and the rest is partitioned.

How it runs. The sorted group sizes never reach the driver. It sees the sums
of at most 65,536 ranges of the order (hash prefixes) and, over those, brackets
the capacity: treating a range as one group can only need more capacity,
treating it as fluid only less. The ranges in which a cut may then lie, a few
per shard, are opened into 256 finer ones each, again and again until they are
single groups, when both views agree and the result is exact.

Slots number the rows of a shard from 0 in hash order. Ranges of the order
(split further by id where one has very many rows) are counted first, their
running total gives each its first slot, and rows are numbered inside their
range only, so no shard passes through one task. Repeated rows are counted
before any of this.

Cases. A null text is the empty text (size 1). Null and repeated ids are
allowed: equal rows take consecutive slots. With fewer groups than shards some
shards stay empty; an empty table gives an empty result. Other columns are
ignored by ``assign`` and kept by ``place``.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.common import id_key
from ordermart.session import cut_lineage, discard_cut

SHARDS = 16
#: Rows numbered together.
CELL_ROWS = 100_000
_FIRST, _STEP, _FULL = 4, 2, 32  # hex digits of a range: at first, more when opened, of a whole key


def group_key(text: Column) -> Column:
    return F.substring(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256), 1, _FULL)


def text_size(text: Column) -> Column:
    return F.octet_length(F.coalesce(text.cast("string"), F.lit(""))).cast("long") + 1


def _reach(items: list, ends: list[int], capacity: int, fluid: bool, shards: int) -> list[int]:
    """Greedy fill: after each shard, the first item (and if fluid, the amount) not yet placed.
    Returns the item index at each shard's end; the last is len(items) if all is placed."""
    out, at, done = [], 0, 0
    for _ in range(shards):
        limit = done + capacity
        at = bisect_right(ends, limit)
        done = ends[at - 1] if at else 0
        if at < len(items) and fluid and not items[at][2]:
            done = limit
        out.append(at)
        if at == len(items):
            break
    return out


def _least(items: list, ends: list[int], shards: int, fluid: bool) -> int:
    """Binary search of the smallest capacity whose greedy fill places all."""
    largest = max((s for _, s, single in items if single or not fluid), default=1)
    low, high = max(largest, 1), max(ends[-1], 1)
    while low < high:
        middle = (low + high) // 2
        if _reach(items, ends, middle, fluid, shards)[-1] == len(items):
            high = middle
        else:
            low = middle + 1
    return low


def _ranges(groups: DataFrame, digits: int) -> DataFrame:
    return groups.groupBy(F.substring("key", 1, digits).alias("range")).agg(
        F.sum("bytes").alias("bytes"), F.count("*").alias("n"))


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[list[str], int]:
    """(key, bytes) groups -> the least key of every shard but the first, and the capacity."""
    if shards < 2:
        return [], 0
    digits = _FIRST
    items = [(r["range"], r["bytes"], r["n"] == 1) for r in _ranges(groups, digits).collect()]  # at most 16**4
    items.sort()
    while items:
        ends = list(accumulate(s for _, s, _ in items))
        low, high = _least(items, ends, shards, True), _least(items, ends, shards, False)
        first, last = _reach(items, ends, low, False, shards), _reach(items, ends, high, True, shards)
        last += [len(items)] * (shards - len(last))
        first += [len(items)] * (shards - len(first))
        opened = {i for a, b in zip(first, last) for i in range(a, min(b, len(items) - 1) + 1) if not items[i][2]}
        if not opened:
            cuts = [items[i][0] for i in _reach(items, ends, high, False, shards) if i < len(items)]
            return cuts, high
        digits = min(digits + _STEP, _FULL)
        names = [items[i][0] for i in sorted(opened)]
        inside = F.lit(False)
        for size in sorted({len(n) for n in names}):
            inside = inside | F.substring("key", 1, size).isin([n for n in names if len(n) == size])
        finer = [(r["range"], r["bytes"], r["n"] == 1 or digits == _FULL)
                 for r in _ranges(groups.where(inside), digits).collect()]
        items = sorted([x for i, x in enumerate(items) if i not in opened] + finer)
    return [], 0


def shard_of(groups: DataFrame, shards: int = SHARDS) -> Column:
    """Column expression: the shard of column ``key``, for (key, bytes) groups."""
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    alone: list[str] = []
    for row in groups.orderBy(F.desc("bytes"), "key").limit(shards).collect():
        if len(alone) < shards - 1 and row["bytes"] * (shards - len(alone)) > total:
            alone.append(row["key"])
            total -= row["bytes"]
    rest = groups.where(~F.col("key").isin(alone)) if alone else groups
    cuts, _ = minimax_cuts(rest, shards - len(alone))
    shard = F.lit(len(alone))
    for cut in cuts:
        shard = shard + F.when(F.col("key") >= cut, 1).otherwise(0)
    for i, key in enumerate(alone):
        shard = F.when(F.col("key") == key, F.lit(i)).otherwise(shard)
    return shard.cast("int")


def assign(documents: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct (id, text): doc_id, key, size, text_crc32, n (rows it stands for),
    shard, and slot, the first of the n slots."""
    text = F.col(text_col)
    rows = cut_lineage(documents.select(
        F.col(id_col).cast("long").alias("doc_id"), group_key(text).alias("key"), text_size(text).alias("size"),
        F.crc32(F.coalesce(text.cast("string"), F.lit(""))).alias("text_crc32"))
        .groupBy("doc_id", "key", "size", "text_crc32").agg(F.count("*").alias("n")))
    groups = cut_lineage(rows.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("bytes")))
    placed = rows.withColumns({"shard": shard_of(groups, shards), "range": F.substring("key", 1, _FIRST)})
    discard_cut(groups)
    crowded = placed.groupBy("shard", "range").agg(F.ceil(F.count("*") / CELL_ROWS).alias("parts")).where("parts > 1")
    celled = placed.join(crowded, ["shard", "range"], "left").withColumn(
        "part", F.pmod(F.xxhash64("doc_id"), F.coalesce("parts", F.lit(1)))).drop("parts")
    cell = ["shard", "range", "part"]
    before = Window.partitionBy("shard").orderBy("range", "part")  # a row per range: bounded
    firsts = celled.groupBy(*cell).agg(F.sum("n").alias("rows")).select(
        *cell, (F.sum("rows").over(before) - F.col("rows")).alias("first"))
    inside = Window.partitionBy(*cell).orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    return (celled.withColumn("upto", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(firsts, cell)
            .select("doc_id", "key", "size", "text_crc32", "n", "shard", (F.col("first") + F.col("upto")).alias("slot")))


def manifest(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("k")
    return assign(documents, shards).select("*", each).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("slot") + F.col("k")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def place(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The documents with their shard and slot (other columns unchanged)."""
    keyed = documents.select(id_key(F.col("doc_id")).alias("doc_id"), "text")
    found = assign(keyed, shards).select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"),
                                         F.col("shard").alias("__shard"), F.col("slot").alias("__slot"))
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("__row"),
                            id_key(F.col("doc_id")).alias("__id"), group_key(F.col("text")).alias("__key"))
    joined = rows.join(found, ["__id", "__key"])
    same = Window.partitionBy("__id", "__key").orderBy(F.lit(0))  # as the join has dealt the rows
    numbered = joined.withColumn("__k", F.row_number().over(same) - 1)
    return numbered.select(
        *[F.col(f"__row.`{c}`") for c in documents.columns if c not in ("shard", "slot")],
        F.col("__shard").alias("shard"), (F.col("__slot") + F.col("__k")).alias("slot"))
