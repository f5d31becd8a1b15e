"""MinHash near-dedup: an inverted join on signature coordinates.

A document is the set of its distinct word shingles; two documents are linked
when the Jaccard similarity of their sets reaches a threshold.

How it runs. Documents with equal sets form one class (a grouped minimum, so a
class may hold any share of the rows); everything after works on classes.
Every class has a signature of ``coordinates`` minima under independent hash
functions and is posted under each (coordinate, value) pair. Values that
only one class has are skipped; a class left with fewer shared values than the
match threshold cannot match anything and drops out. Of the others only a
prefix is merged: with values ordered from rare to frequent, two classes that
agree in t coordinates must meet in the first ``shared - t + 1`` of both, so
very frequent values (a line that a third of the corpus shares) are
rarely merged at all. Within a posting list
1. every member is paired with one hub, the list's most central class, whose
   values are the most widely shared (at most one pair per posting, whatever the
   length; of a group of edited copies the unedited text is the hub);
2. pairs with enough colliding coordinates are confirmed on the full sets, and
   confirmed links are joined to components;
3. the members of lists of more than ``LONG`` that still lie in several components are posted a second time, each
   once whatever the number of such lists: under the rarest of ``FINE`` more coordinates that they share, by the
   same rule, or, sets of ``FINE`` shingles at most, under the rarest of the shingles. So members of a list that have
   only the list's value in common (pages of one template) drop out, and the others meet in shorter lists, of which
   the members are paired with a hub as in 1 and 2 (in lists of two, with each other);
4. in lists whose members still lie in several components, the members outside
   the list's largest component are compared with all of the list, in blocks
   of bounded size; two members of several such lists are compared in that of the least key only, so copies of
   one text, which share most of their lists, do not meet in each. First by signatures alone: collisions are counted, and only members of a pair across
   components that reaches the match threshold go on, with their texts; these pairs are confirmed on
   the full sets, and a block returns only links that join components it had not joined yet, fewer than it
   has members. Pairs inside one component need no check; no list is capped. A member is sent once for each block
   that its list compares it with; that is done in passes of about as many members as there are classes (``ROOM`` at
   least), and of ``ROOM_BYTES`` of text or four times the texts' size, so disk stays in proportion to the input.

Each job's shuffle files are deleted when it ends, not when the driver next collects its garbage.

Recall. The match threshold t is the largest with P(Binomial(coordinates,
threshold) < t) <= ``MISS``: a link at the similarity threshold itself is missed
with at most that probability in each posting, closer ones far less. Confirmation is exact.

Cases. Null, empty and word-less texts have no set: no link, kept. Rows with a
null id are never linked: component null, kept. Rows that repeat an id are
each judged on their own text; equal rows get equal results. Ties in
``doc_id`` do not matter, a component is named by its smallest id. An empty
table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import LOWER, Texts, compress_texts, decompress, id_key, mix64, rows_of, sliced, text_bytes
from ordermart.llm.components import components
from ordermart.session import cut_lineage, discard_cut, shuffles_deleted

COORDINATES = 32
MISS = 1e-6
#: Classes compared with each other at a time in step 4 (with their signatures about 80 KB).
BLOCK = 256
#: Members from which a list is posted a second time, and the further coordinates for it.
LONG, FINE = 2048, 96
#: Members sent to blocks in one pass of step 4, and bytes of their texts, on a small input.
ROOM, ROOM_BYTES = 1 << 18, 1 << 28


def _seeds(first: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix64(np.arange(first, first + 2 * n, dtype=np.uint64))
    return seeds[:n, None], seeds[n:, None] | np.uint64(1)


_HASHES, _FINE_HASHES = _seeds(1, COORDINATES), _seeds(1_000_001, FINE)


def match_threshold(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    p, below, t = percent / 100, 0.0, 0
    while t < coordinates:
        below += math.comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if below > miss:
            break
        t += 1
    return max(t, 1)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Per text the sorted 64-bit hashes of its distinct shingles (A-Z as a-z);
    a text of fewer words than ``size`` has its whole word sequence as the only one."""
    t = Texts(texts)
    starts, ends = t.words()
    h = t.hashes(starts, ends, LOWER)
    counts = np.bincount(t.owner(starts), minlength=len(texts))
    rolled = np.zeros(len(h), np.uint64)
    for k in range(min(size, len(h))):
        rolled[:len(h) - k] += mix64(h[k:] + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64))
    rolled = mix64(rolled)
    out, at = [], 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(rolled[at:at + n - size + 1]))
        else:
            out.append(np.array([xxhash.xxh3_64_intdigest(h[at:at + n].tobytes())] if n else [], np.uint64))
        at += n
    return out


def signature(shingles: np.ndarray, hashes: tuple[np.ndarray, np.ndarray] = _HASHES) -> np.ndarray:
    """Minima of the shingles under each hash function."""
    xor, odd = hashes
    least = np.full(len(xor), 2**64 - 1, np.uint64)
    for i in range(0, len(shingles), 4096):
        least = np.minimum(least, ((shingles[None, i:i + 4096] ^ xor) * odd).min(axis=1))
    return least


def _sign_fine(size: int, percent: int):
    """(cls, ztext) -> (cls, exact, need, keys) of the second posting: two sets that are linked share ``need`` of the
    keys. A small set is posted under its shingles (exact), a large one under further coordinates, one that may be
    linked to either kind under both."""
    t, coordinate = match_threshold(percent, FINE), mix64(np.arange(1, FINE + 1, dtype=np.uint64))
    schema = pa.schema([("cls", pa.binary()), ("exact", pa.bool_()), ("need", pa.int32()), ("keys", pa.list_(pa.int64()))])

    def sign(batches):
        for b in sliced(batches, "ztext", 1 << 20):
            out = []
            for cls, s in zip(b.column("cls").to_pylist(), shingle_sets([decompress(z) for z in b.column("ztext").to_pylist()], size)):
                if percent * len(s) <= 100 * FINE:  # the partner of a set of FINE shingles at most
                    out.append((cls, True, -(-percent * len(s) // 100), s.view(np.int64)))
                if len(s) > FINE:
                    out.append((cls, False, t, mix64(signature(s, _FINE_HASHES) ^ coordinate).view(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return sign


def _sign(size: int):
    schema = pa.schema([("doc_id", pa.int64()), ("id_key", pa.int64()), ("print", pa.int64()),
                        ("n_shingles", pa.int64()), ("cls", pa.binary()), ("sig", pa.list_(pa.int64()))])

    def sign(batches):
        for b in sliced(batches):
            sets = shingle_sets(b.column("text").to_pylist(), size)
            linked = [len(s) > 0 and i is not None for s, i in zip(sets, b.column("doc_id").to_pylist())]
            cls = [xxhash.xxh3_128_digest(s.tobytes()) if k else None for s, k in zip(sets, linked)]
            sig = [signature(s).view(np.int64) if k else None for s, k in zip(sets, linked)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("id_key"), b.column("print"),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array(cls, pa.binary()),
                 pa.array(sig, pa.list_(pa.int64()))], schema=schema)

    return sign


def _confirm(size: int, percent: int):
    """Pairs with both texts -> those whose full sets reach the threshold."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def confirm(batches):
        last = None
        for batch in batches:
            found = []
            for a, b, ta, tb in rows_of([batch], "a", "b", "ta", "tb"):
                if b != last:  # rows come sorted by b out of the join
                    last, (sb,) = b, shingle_sets([decompress(tb)], size)
                (sa,) = shingle_sets([decompress(ta)], size)
                both = len(np.intersect1d(sa, sb, assume_unique=True))
                if 100 * both >= percent * (len(sa) + len(sb) - both):
                    found.append((a, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], schema=schema)

    return confirm


def confirmed_links(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Exact check of (a, b) class pairs; ``texts``: cls, ztext."""
    with_a = pairs.join(texts.select(F.col("cls").alias("a"), F.col("ztext").alias("ta")), "a")
    with_b = with_a.join(texts.select(F.col("cls").alias("b"), F.col("ztext").alias("tb")), "b")
    return with_b.select("a", "b", "ta", "tb").mapInArrow(_confirm(size, percent), "a binary, b binary")


def _linked(rows: list, cols: list, ia: np.ndarray, ib: np.ndarray, percent: int) -> np.ndarray:
    """Exact verdict on the pairs (ia, ib) of two lists of shingle sets."""
    if len(ia) < 64:
        both = np.array([len(np.intersect1d(rows[i], cols[j], assume_unique=True)) for i, j in zip(ia, ib)], np.int64)
    else:  # many pairs: all intersections of the members involved as one matrix product
        ra, rb = np.unique(ia), np.unique(ib)
        common = np.intersect1d(np.unique(np.concatenate([rows[i] for i in ra])), np.unique(np.concatenate([cols[j] for j in rb])))

        def incidence(sets):
            out = np.zeros((len(sets), len(common)), np.float32)
            for k, x in enumerate(sets):
                at = np.searchsorted(common, x)
                out[k, at[common[np.minimum(at, len(common) - 1)] == x]] = 1 if len(common) else 0
            return out

        if not len(common):
            return np.zeros(len(ia), bool)
        product = incidence([rows[i] for i in ra]) @ incidence([cols[j] for j in rb]).T
        both = product[np.searchsorted(ra, ia), np.searchsorted(rb, ib)].astype(np.int64)
    na, nb = np.array([len(rows[i]) for i in ia]), np.array([len(cols[j]) for j in ib])
    return 100 * both >= percent * (na + nb - both)


def _met_before(key: int, rows: list, cols: list, ia: np.ndarray, ib: np.ndarray) -> np.ndarray:
    """Which pairs (ia, ib) also share a list of a smaller key than ``key``, where they are compared; ``rows``,
    ``cols``: the lists of each member."""
    rows, cols = ([np.array([k for k in x if k < key], np.int64) for x in side] for side in (rows, cols))
    common = np.intersect1d(np.concatenate(rows), np.concatenate(cols))
    if not len(common):
        return np.zeros(len(ia), bool)

    def incidence(sets):
        out = np.zeros((len(sets), len(common)), np.float32)
        for k, x in enumerate(sets):
            at = np.minimum(np.searchsorted(common, x), len(common) - 1)
            out[k, at[common[at] == x]] = 1
        return out

    return (incidence(rows) @ incidence(cols).T)[ia, ib] > 0


class _Sides:
    """The members of a block pair, and the pairs across components that may be links and share no list of a smaller key."""

    def __init__(self, key: int, query: list, data: list, t: int, percent: int):
        (self.ca, pa_, na, sa), (self.cb, pb, nb, sb) = (
            ([m["cls"] for m in side], [m["comp"] for m in side], np.array([m["n_shingles"] for m in side]),
             np.array([m["sig"] for m in side], np.int64)) for side in (query, data))
        number = {c: i for i, c in enumerate(dict.fromkeys([*pa_, *pb]))}
        self.la, self.lb = np.array([number[c] for c in pa_]), np.array([number[c] for c in pb])
        hits = np.zeros((len(self.ca), len(self.cb)), np.uint8)
        for k in range(COORDINATES):
            hits += sa[:, None, k] == sb[None, :, k]
        self.ia, self.ib = np.nonzero((hits >= t) & (self.la[:, None] != self.lb[None, :]) & (
            100 * np.minimum(na[:, None], nb[None, :]) >= percent * np.maximum(na[:, None], nb[None, :])))
        if len(self.ia):
            new = ~_met_before(key, [m["lists"] for m in query], [m["lists"] for m in data], self.ia, self.ib)
            self.ia, self.ib = self.ia[new], self.ib[new]
        self.components = len(number)


def _meeting(t: int, percent: int):
    """Block pairs of signatures -> the members that are in any pair worth confirming (side 0: of the query)."""
    schema = pa.schema([("key", pa.int64()), ("q", pa.int32()), ("d", pa.int32()), ("side", pa.int32()), ("cls", pa.binary())])

    def meeting(batches):
        for batch in batches:
            for key, q, d, query, data in rows_of([batch], "key", "q", "d", "query", "data"):
                found = _Sides(key, query, data, t, percent)
                out = [(key, q, d, side, members[i]["cls"])
                       for side, members, at in ((0, query, found.ia), (1, data, found.ib)) for i in np.unique(at)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return meeting


def _links_across(t: int, percent: int, size: int):
    """Block pairs (members outside the main component, members) with texts -> links that join components."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def links(batches):
        for key, query, data in rows_of(batches, "key", "query", "data"):
            pairs = _Sides(key, query, data, t, percent)
            ia, ib = pairs.ia, pairs.ib
            if not len(ia):
                continue
            sets = [dict(), dict()]
            for members, at, out in ((query, np.unique(ia), sets[0]), (data, np.unique(ib), sets[1])):
                for i, x in zip(at, shingle_sets([decompress(members[i]["ztext"]) for i in at], size)):
                    out[i] = x
            ok = _linked(*sets, ia, ib, percent)
            parent = list(range(pairs.components))

            def root(x):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            found = []
            for i, j in zip(ia[ok].tolist(), ib[ok].tolist()):
                x, y = root(pairs.la[i]), root(pairs.lb[j])
                if x != y:
                    parent[x] = y
                    found.append((pairs.ca[i], pairs.cb[j]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], schema=schema)

    return links


def open_lists(members: DataFrame) -> DataFrame:
    """Lists (of members cls, key, comp) that several components share: key, n, main component, and the
    numbers of blocks of the members outside it and of all."""
    return (members.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key")
            .agg(F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("top"), F.count("*").alias("comps"))
            .where("n > 2 and comps > 1")
            .select("key", "n", F.col("top.comp").alias("main"), (F.col("n") - F.col("top.n")).alias("outside"),
                    F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("queries"),
                    F.ceil(F.col("n") / BLOCK).cast("int").alias("datas")))


def _rarest(postings: DataFrame, by: list[str], need: Column) -> DataFrame:
    """Of the postings (``by``: cls and others; key) the rarest that several share, so many that any two which share
    ``need`` of them meet in one: cls, key, central (how many share the postings of ``by``, added up)."""
    shared = postings.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    own = postings.join(shared, "key").groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("df", "key"))).alias("s"))
    central = F.aggregate("s", F.lit(0).cast("long"), lambda total, x: total + x["df"])
    return (own.where(F.size("s") >= need)
            .select("cls", central.alias("central"), F.explode(F.slice("s", F.lit(1), F.size("s") - need + 1)).alias("p"))
            .select("cls", F.col("p.key").alias("key"), "central"))


def prefix_postings(classes: DataFrame, t: int) -> DataFrame:
    """(cls, key, central) of the coordinate values to merge, ``key`` standing
    for a (coordinate, value) pair: the rarest of a class's shared values.
    ``central``: how many classes share the class's values, added up."""
    postings = classes.select("cls", F.posexplode("sig").alias("c", "v")).select(
        "cls", F.xxhash64("c", "v").alias("key"))
    return _rarest(postings, ["cls"], F.lit(t))


def posted_again(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Members (cls, key, comp) of long lists in shorter ones, (cls, key, comp, central): under the rarest of the
    further keys that several of them share."""
    classes = members.select("cls", "comp").distinct()
    fine = cut_lineage(texts.select("cls", "ztext").join(classes, "cls", "left_semi").mapInArrow(
        _sign_fine(size, percent), "cls binary, exact boolean, need int, keys array<long>"))
    rare = _rarest(fine.select("cls", "exact", "need", F.explode("keys").alias("key")), ["cls", "exact", "need"], F.col("need"))
    out = cut_lineage(rare.join(classes, "cls").select("cls", "key", "comp", "central"))
    discard_cut(fine)
    return out


def hub_links(posted: DataFrame, signs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links of the members (cls, key, comp, central) of each list with its hub, if the two lie in different components."""
    hubs = posted.groupBy("key").agg(F.max(F.struct("central", "cls", "comp")).alias("hub")).select(
        "key", F.col("hub.cls").alias("a"), F.col("hub.comp").alias("in"))
    star = (posted.join(hubs, "key").where(F.col("comp") != F.col("in")).select("a", F.col("cls").alias("b")).distinct()
            .join(signs.select(F.col("cls").alias("a"), F.col("sig").alias("sa"), F.col("n_shingles").alias("na")), "a")
            .join(signs.select(F.col("cls").alias("b"), F.col("sig").alias("sb"), F.col("n_shingles").alias("nb")), "b"))
    hits = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda same: same))
    tried = cut_lineage(star.where(
        (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (hits >= match_threshold(percent))).select("a", "b"))
    links = cut_lineage(confirmed_links(tried, texts, size, percent))
    discard_cut(tried)
    return links


def with_components(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (cls, key) with the component that the labels (node, label) give; without one, the class is its own."""
    return members.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "key", F.coalesce("label", "cls").alias("comp"))


def links_across(members: DataFrame, lists: DataFrame, signs: DataFrame, texts: DataFrame, size: int, percent: int,
                 room: int, room_bytes: int) -> list[DataFrame]:
    """Links between the components of the members (cls, key, comp) of open lists, from all pairs of a list; a cut a pass."""
    t = match_threshold(percent)
    # a list's number: the longer, the smaller; lists of one number are made one, with one main component and one dealing
    numbered = lists.withColumn("number", F.pmod("key", F.lit(2**40)) - F.least("n", F.lit(2**22)) * F.lit(2**40))
    one = numbered.groupBy("number").agg(*(F.max(c).alias(c) for c in ("main", "queries", "datas")))
    placed = members.join(numbered.select("key", "number").join(one, "number"), "key").select(
        "cls", F.col("number").alias("key"), "comp", "main", "queries", "datas")
    own = placed.groupBy("cls").agg(F.first("comp").alias("comp"), F.array_sort(F.collect_set("key")).alias("lists"))  # at most its postings
    own = cut_lineage(own.join(signs, "cls"))
    opened = cut_lineage(placed.join(own.drop("comp"), "cls"))
    part = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    member = F.collect_list(F.struct("cls", "comp", "n_shingles", "sig", "lists"))
    sent = lists.agg(F.sum(F.col("outside") * F.col("datas") + F.col("n") * F.col("queries"))).first()[0] or 0
    passes, links = max(1, math.ceil(sent / room)), []
    for i in range(passes):
        here = F.pmod(F.xxhash64("key", "q", "d"), F.lit(passes)) == i
        queries = (opened.where("comp <> main").withColumns({"q": part("queries"), "d": F.explode(F.expr("sequence(0, datas - 1)"))})
                   .where(here).groupBy("key", "q", "d").agg(member.alias("query")))
        datas = (opened.withColumns({"d": part("datas"), "q": F.explode(F.expr("sequence(0, queries - 1)"))})
                 .where(here).groupBy("key", "q", "d").agg(member.alias("data")))
        met = queries.join(datas, ["key", "q", "d"]).mapInArrow(_meeting(t, percent), "key long, q int, d int, side int, cls binary")
        # a class with its text is joined once a pass, whatever the number of its block pairs
        places = cut_lineage(met.groupBy("cls").agg(F.collect_list(F.struct("key", "q", "d", "side")).alias("places")))
        moved = places.join(texts.select("cls", "zbytes"), "cls").agg(F.sum(F.size("places") * F.col("zbytes"))).first()[0] or 0
        steps = math.ceil(moved / room_bytes)
        for j in range(steps):
            now = F.filter("places", lambda p: F.pmod(F.xxhash64(p["d"], p["q"], p["key"]), F.lit(steps)) == j)
            with_text = F.struct("cls", "comp", "n_shingles", "sig", "lists", "ztext")
            pairs = (places.select("cls", now.alias("places")).where("size(places) > 0").join(own, "cls").join(texts, "cls")
                     .select(F.explode("places").alias("at"), with_text.alias("m")).groupBy("at.key", "at.q", "at.d").agg(
                F.collect_list(F.when(F.col("at.side") == 0, F.col("m"))).alias("query"),
                F.collect_list(F.when(F.col("at.side") == 1, F.col("m"))).alias("data")))  # nulls are left out: at most two blocks
            links.append(cut_lineage(pairs.select("key", "query", "data").mapInArrow(
                _links_across(t, percent, size), "a binary, b binary").distinct()))
        discard_cut(places)
    discard_cut(own, opened)
    return links


def near_duplicates(documents: DataFrame, size: int = 3, percent: int = 85,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, id_key, print (text fingerprint), n_shingles,
    class_id (hex of the set's fingerprint), component_id, kept."""
    with shuffles_deleted(documents.sparkSession):
        return _near_duplicates(documents, size, percent, id_col, text_col)


def _near_duplicates(documents: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    t = match_threshold(percent)
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), id_key(F.col(id_col)).alias("id_key"),
                            text_bytes(F.col(text_col)).alias("text")).withColumn("print", F.xxhash64("text"))
    signed = cut_lineage(docs.mapInArrow(
        _sign(size), "doc_id long, id_key long, print long, n_shingles long, cls binary, sig array<long>"))
    classes = cut_lineage(signed.where("cls is not null").groupBy("cls").agg(
        F.min(F.struct("id_key", "print")).alias("rep"), F.min("n_shingles").alias("n_shingles"),
        F.first("sig").alias("sig")))
    posted = cut_lineage(prefix_postings(classes, t))

    # signatures and texts of the classes that meet any other, one document each
    signs = cut_lineage(classes.join(posted.select("cls").distinct(), "cls", "left_semi").select("cls", "rep.*", "n_shingles", "sig"))
    texts = cut_lineage(compress_texts(docs.select("id_key", "print", "text"), "text")
                        .join(signs.select("cls", "id_key", "print"), ["id_key", "print"])
                        .select("cls", "ztext", F.length("ztext").cast("long").alias("zbytes")).dropDuplicates(["cls"]))
    known = signs.select("cls", "n_shingles", "sig")

    # 1, 2: each member with the hub of its list
    links = [hub_links(posted.withColumn("comp", F.col("cls")), known, texts, size, percent)]
    joined = components(links[0])

    # 3: long lists that several components share are posted again
    members = cut_lineage(with_components(posted.select("cls", "key"), joined))
    lists = cut_lineage(open_lists(members))
    if not lists.where(F.col("n") > LONG).isEmpty():
        again = posted_again(members.join(lists.where(F.col("n") > LONG).select("key"), "key", "left_semi"), texts, size, percent)
        links.append(hub_links(again, known, texts, size, percent))
        before = (joined, members, lists, again)
        joined = components(reduce(DataFrame.union, links))
        members = cut_lineage(with_components(
            members.join(lists.where(F.col("n") <= LONG).select("key"), "key", "left_semi").select("cls", "key").union(again.select("cls", "key")), joined))
        lists = cut_lineage(open_lists(members))
        discard_cut(*before)

    # 4: lists that several components share
    zbytes = texts.agg(F.sum("zbytes")).first()[0] or 0
    links += links_across(members, lists, known, texts, size, percent, max(ROOM, classes.count()), max(ROOM_BYTES, 4 * zbytes))
    labels = components(reduce(DataFrame.union, links))
    discard_cut(posted, signs, texts, joined, members, lists, *links)

    named = classes.select("cls", F.col("rep.id_key").alias("least")).join(
        labels.withColumnRenamed("node", "cls"), "cls", "left")
    by_label = named.where("label is not null").groupBy("label").agg(F.min("least").alias("component"))
    component = named.join(by_label, "label", "left").select("cls", F.coalesce("component", "least").alias("component"))
    out = signed.select("doc_id", "id_key", "print", "n_shingles", "cls").join(component, "cls", "left")
    return out.select(
        "doc_id", "id_key", "print", "n_shingles", F.lower(F.hex("cls")).alias("class_id"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"))


def keep_one_per_group(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents without all but the smallest id of each component, and
    without repeated rows; columns unchanged."""
    found = near_duplicates(documents, size, percent).where("kept").select(
        F.col("id_key").alias("__id"), F.col("print").alias("__print")).distinct()
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("__row"),
                            id_key(F.col("doc_id")).alias("__id"),
                            F.xxhash64(text_bytes(F.col("text"))).alias("__print"))
    return rows.join(found, ["__id", "__print"], "left_semi").dropDuplicates(["__id", "__print"]).select("__row.*")
