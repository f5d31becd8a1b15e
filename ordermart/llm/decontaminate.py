"""Benchmark decontamination: SimHash of item-sized windows, multi-index
Hamming blocks, then an exact weighted-shingle check.

Words are lower-cased and freed of outer marks; words of marks only are
skipped. Items come in size classes, window lengths 2^k and 3 * 2^k; an item's
probes are the SimHashes of its first and of its last words, as many as the
longest class of at most nine tenths of the item, so an edit at one end leaves
the other probe whole. SimHash sums, per bit, the word weights (length, at most
8) with the sign of the word hash's bit. The sums of all windows of 2^k words
are those of 2^(k-1) added to themselves shifted, so a fingerprint costs a few
vector additions whatever the window's length.

A fingerprint within ``RADIUS`` of a probe agrees with it in at least one of
``BLOCKS`` blocks up to ``RADIUS // BLOCKS`` bits (pigeonhole), so all values
that near to a probe's block are listed per block; a window none of whose
blocks is listed cannot be within the radius, the others are compared with the
probes listed there. Every window of every class at every word position is looked up: all
fingerprints within the radius are found. Candidates are then compared exactly: of all
spans of words, of any length, that share a word with a near window, the best one's multiset
of ``SHINGLE``-word shingles, a shingle weighing its characters, must have a weighted
Jaccard similarity to the item's of at least ``SIMILARITY``. Only spans of a weight that
this similarity allows need a look; the best one begins and ends with a shingle of the item,
so lost and gained words move its ends. A window must lie in the text as a whole.

All of it happens where the document is read: no shuffle, and no skew from a
passage that very many documents share. The benchmark is the query set: it is
worked through in passes of ``PASS_ITEMS`` items, each with an index of bounded
size (about 20 KB an item of a hundred words) sent to the tasks. Passes are jobs one after the other, each over the
stored documents and with its index alone in memory, so a task never holds more than one; each
stores the few rows that it found, and these are joined to the documents at the end. With one pass nothing is stored.

Cases. Null and empty texts match nothing; null, empty and word-less items match
nothing. Items of fewer than ``SHINGLE`` words are one shingle: all of it must
be there. Equal items each match. Null and repeated ids are allowed, each row is
judged on its own text. Empty tables give empty matches. Other columns are
carried along unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import LOWER, Texts, mix64, sliced, text_bytes
from ordermart.session import cut_lineage, discard_cut

SHINGLE = 5
SIMILARITY = 0.8
RADIUS, BLOCKS = 8, 3
PASS_ITEMS = 2000
_CUTS = ((0, 21), (21, 21), (42, 22))  # first bit and width of each block
_SIEVE = 20  # bits of a block that the first look-up uses
_SLICE = 256 << 10  # bytes of text worked on at a time
_ALNUM = np.zeros(256, bool)  # bytes of non-ASCII characters count as letters
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SIGNS = 2 * np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int16) - 1
MATCHES = "array<struct<item_id:bigint,start:int,n_words:int,similarity:double>>"
_ARROW_MATCHES = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("n_words", pa.int32()), ("similarity", pa.float64())]))
_MERGE = 32  # results of passes kept as tables of their own


def size_class(words: int) -> int:
    """The longest of 1, 2, 3, 4, 6, 8, 12, ... that is at most nine tenths of ``words`` (one at least)."""
    c = 1
    while _longer(c) <= 0.9 * words:
        c = _longer(c)
    return c


def _longer(c: int) -> int:
    return 2 * c if c == 1 else c // 2 * 3 if c & (c - 1) == 0 else c // 3 * 4


class Words:
    """Hashes, lengths and owners of a batch's words (without outer marks)."""

    def __init__(self, texts: list[bytes]):
        t = Texts(texts)
        starts, ends = t.words()
        alnum = _ALNUM[t.data]
        upto, places = np.append(0, np.cumsum(alnum)), np.append(np.flatnonzero(alnum), 0)
        a, b = upto[starts], upto[ends]
        a, b = a[b > a], b[b > a]
        starts, ends = places[a], places[b - 1] + 1
        self.hashes, self.sizes = t.hashes(starts, ends, LOWER), ends - starts
        self.owner = t.owner(starts)
        self.first = np.searchsorted(self.owner, np.arange(len(texts) + 1))  # words of text i: first[i]:first[i+1]

    def __len__(self) -> int:
        return len(self.hashes)

    def weights(self) -> np.ndarray:
        """Each word's weight with the sign of each bit of its hash."""
        signs = _SIGNS[mix64(self.hashes).view(np.uint8)].reshape(-1, 64)
        return signs * np.minimum(self.sizes, 8).astype(np.int16)[:, None]

    def simhashes(self, sizes: list[int]):
        """(size, fingerprints of the windows of that many words at every position), sizes ascending."""
        sums, n, half = self.weights(), 1, None  # sums of all windows of n and of n / 2 words
        for size in sizes:
            power = 1 << (size.bit_length() - 1)
            while n < power:
                if n == 2048:  # 4096 weights of 8 pass 16 bits
                    sums = sums.astype(np.int32)
                half, sums, n = sums, sums[n:] + sums[:-n], 2 * n
            total = sums if size == n else sums[:len(sums) - n // 2] + half[n:]
            yield size, np.packbits((total > 0).ravel()).view(np.uint64)


def _near(width: int, radius: int) -> np.ndarray:
    """All masks of ``width`` bits with at most ``radius`` ones."""
    out, ring = np.zeros(1, np.uint64), np.zeros(1, np.uint64)
    ones = np.uint64(1) << np.arange(width, dtype=np.uint64)
    for _ in range(radius):
        ring = np.unique(ring[:, None] | ones)
        out = np.union1d(out, ring)
    return out


def _block(prints: np.ndarray, cut: tuple[int, int]) -> np.ndarray:
    return prints >> np.uint64(cut[0]) & np.uint64((1 << cut[1]) - 1)


@dataclass
class SizeIndex:
    """The probes of one size class: per block the values near them, sorted, and whose they are."""

    size: int
    prints: np.ndarray
    items: np.ndarray  # number of the probe's item
    offsets: np.ndarray  # of the probe in its item, in words

    def __post_init__(self):
        self.values, self.probes, self.sieves = [], [], []
        for cut in _CUTS:
            near = _block(self.prints, cut)[:, None] ^ _near(cut[1], RADIUS // BLOCKS)
            probe = np.repeat(np.arange(len(self.prints)), near.shape[1])
            order = np.argsort(near.ravel(), kind="stable")
            self.values.append(near.ravel()[order])
            self.probes.append(probe[order])
            sieve = np.zeros(1 << _SIEVE, bool)
            sieve[(near & np.uint64((1 << _SIEVE) - 1)).ravel()] = True
            self.sieves.append(sieve)

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, probe) of all pairs within the radius."""
        found = []
        for cut, sieve, values, probes in zip(_CUTS, self.sieves, self.values, self.probes):
            block = _block(prints, cut)
            at = np.flatnonzero(sieve[block & np.uint64((1 << _SIEVE) - 1)])
            low, high = (np.searchsorted(values, block[at], side=s) for s in ("left", "right"))
            n = high - low
            position = np.repeat(at, n)
            probe = probes[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
            near = np.bitwise_count(prints[position] ^ self.prints[probe]) <= RADIUS
            found.append(np.stack([position[near], probe[near]], axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pairs[:, 0], pairs[:, 1]


def _rolled(hashes: np.ndarray, k: int) -> np.ndarray:
    """The shingle of ``k`` words at every word."""
    return sum(mix64(hashes[i:len(hashes) - k + 1 + i] + np.uint64(i + 1)) for i in range(k))


def _weights(sizes: np.ndarray, k: int) -> np.ndarray:
    return np.convolve(sizes, np.ones(k, np.int64), "valid")


def shingles(hashes: np.ndarray, sizes: np.ndarray) -> dict[int, int]:
    """Shingle -> its weight times its count."""
    k = min(SHINGLE, len(hashes))
    out: dict[int, int] = {}
    if k:
        for h, w in zip(_rolled(hashes, k).tolist(), _weights(sizes, k).tolist()):
            out[h] = out.get(h, 0) + w
    return out


def weighted_jaccard(a: dict[int, int], b: dict[int, int]) -> float:
    both = sum(min(w, b[h]) for h, w in a.items() if h in b)
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 0.0


def best_span(item: dict[int, int], k: int, hashes: np.ndarray, sizes: np.ndarray) -> tuple[float, int, int]:
    """(similarity, first word, words) of the span most similar to an item of
    ``k``-word shingles, the first of equals; similarity 0 if all are under ``SIMILARITY``."""
    best, total = (0.0, 0, 0), sum(item.values())
    if len(hashes) < k:
        return best
    rolled, weight = _rolled(hashes, k).tolist(), _weights(sizes, k)
    at = [j for j, h in enumerate(rolled) if h in item]  # a best span begins and ends with one of these
    own = weight[at]
    if own.sum() / total < SIMILARITY:
        return best
    before, places = [], {}  # a shingle counts while the occurrence its item's count before it is out of the span
    for j, w in zip(at, own.tolist()):
        earlier = places.setdefault(rolled[j], [])
        count = item[rolled[j]] // w
        before.append(earlier[-count] if len(earlier) >= count else -1)
        earlier.append(j)
    at, before = np.array(at), np.array(before)
    upto, shared = np.append(0, np.cumsum(weight)), np.append(0, np.cumsum(own))
    ends = upto[at + 1]
    stops = np.searchsorted(ends, upto[at] + total / SIMILARITY, side="right")
    for i in np.flatnonzero((shared[stops] - shared[:-1]) / total >= SIMILARITY).tolist():
        s, stop = at[i], stops[i]
        if (shared[stop] - shared[i]) / total <= best[0]:
            continue
        both = np.cumsum(np.where(before[i:stop] < s, own[i:stop], 0))
        similar = both / (total + ends[i:stop] - upto[s] - both)
        j = int(similar.argmax())
        if similar[j] >= SIMILARITY and similar[j] > best[0]:
            best = (float(similar[j]), int(s), int(at[i + j] - s + k))
    return best


@dataclass
class BenchmarkIndex:
    ids: list[int]
    sizes: list[int]
    shingles: list[dict[int, int]]
    classes: list[SizeIndex]


def build_index(items: list[tuple[int, bytes]]) -> BenchmarkIndex:
    words = Words([t for _, t in items])
    probes: dict[int, list] = {}
    sizes, sets = [], []
    for i in range(len(items)):
        a, b = words.first[i], words.first[i + 1]
        sizes.append(int(b - a))
        sets.append(shingles(words.hashes[a:b], words.sizes[a:b]))
        if b > a:
            c = size_class(int(b - a))
            probes.setdefault(c, []).extend((i, offset) for offset in sorted({0, int(b - a) - c}))
    classes = []
    for c, prints in words.simhashes(sorted(probes)):
        item, offset = (np.array(x) for x in zip(*probes[c]))
        classes.append(SizeIndex(c, prints[words.first[item] + offset], item, offset))
    return BenchmarkIndex([i for i, _ in items], sizes, sets, classes)


def find(texts: list[bytes], index: BenchmarkIndex) -> list[list[dict]]:
    """The matches of each text: best similarity per item, earliest start first."""
    words = Words(texts)
    out: list[dict] = [{} for _ in texts]
    if len(words):
        near: dict = {}  # (text, item) -> stretches of words that near windows cover
        fits = {c.size: c for c in index.classes if c.size <= len(words)}
        for size, prints in words.simhashes(sorted(fits)):
            at, probe = fits[size].within(prints)
            for p, item in zip(at.tolist(), fits[size].items[probe].tolist()):
                doc = int(words.owner[p])
                if p + size > words.first[doc + 1]:
                    continue  # the window runs over the text's end
                stretches = near.setdefault((doc, item), [])
                if stretches and p <= stretches[-1][1]:
                    stretches[-1][1] = p + size
                else:
                    stretches.append([p, p + size])
        upto = {k: np.append(0, np.cumsum(_weights(words.sizes, k)))
                for k in {min(SHINGLE, index.sizes[item]) for _, item in near}}  # weight of the shingles before each
        for (doc, item), stretches in near.items():
            a, b = int(words.first[doc]), int(words.first[doc + 1])
            k, most = min(SHINGLE, index.sizes[item]), sum(index.shingles[item].values()) / SIMILARITY
            if b - a < k:
                continue
            w = upto[k]
            for p, q in stretches:
                best = out[doc].get(item, (0.0, 0, 0))
                if best[0] == 1:
                    break
                # a span of at most that weight which ends after p, one which starts before q
                low = np.searchsorted(w, w[max(p - k + 1, a)] - most)
                high = np.searchsorted(w, w[min(q, len(w) - 1)] + most, side="right") + k - 1
                lo, hi = max(int(low), a), min(int(high), b)
                s, start, n = best_span(index.shingles[item], k, words.hashes[lo:hi], words.sizes[lo:hi])
                if s > best[0]:
                    out[doc][item] = (s, lo + start - a, n)
    return [[{"item_id": index.ids[i], "start": start, "n_words": n, "similarity": round(s, 6)}
             for i, (s, start, n) in sorted(found.items(), key=lambda x: (x[1][1], x[0]))] for found in out]


def _passes(benchmark: DataFrame):
    """The items in blocks of ``PASS_ITEMS``."""
    rows = benchmark.select(F.col("item_id").cast("long"), text_bytes(F.col("text"))).toLocalIterator()
    block = []
    for item, text in rows:
        block.append((item, bytes(text)))
        if len(block) == PASS_ITEMS:
            yield block
            block = []
    if block:
        yield block


def _matcher(index, all_rows: bool):
    """Batches of (row or key, text) -> (row or key, matches); without ``all_rows`` only rows with a match."""

    def matched(batches):
        for b in sliced(batches, limit=_SLICE):
            found = find(b.column("text").to_pylist(), index.value)
            kind = b.column("row")
            if not all_rows:
                kind = kind.filter(pa.array([bool(x) for x in found]))
                found = [x for x in found if x]
            if len(found):
                yield pa.RecordBatch.from_arrays([kind, pa.array(found, _ARROW_MATCHES)], ["row", "matches"])

    return matched


def matches(documents: DataFrame, benchmark: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``row``, the struct of the ``keep`` columns, and ``matches`` of every document."""
    keep = documents.columns if keep is None else keep
    context = documents.sparkSession.sparkContext
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    df = documents.select(row, text_bytes(F.col("text")).alias("text"))
    schema = f"row {df.schema['row'].dataType.simpleString()}, matches {MATCHES}"
    passes = _passes(benchmark)
    first, second = next(passes, []), next(passes, None)
    if second is None:
        return df.mapInArrow(_matcher(context.broadcast(build_index(first)), True), schema)  # bounded by PASS_ITEMS
    fixed = cut_lineage(df.withColumn("key", F.monotonically_increasing_id()))
    found = []
    for block in chain([first, second], passes):
        shared = context.broadcast(build_index(block))
        found.append(cut_lineage(fixed.select(F.col("key").alias("row"), "text").mapInArrow(
            _matcher(shared, False), f"row long, matches {MATCHES}")))
        shared.destroy()
        if len(found) == _MERGE:
            found = [_merged(found)]
    by_key = _merged(found).select(F.col("row").alias("key"), "matches")
    return fixed.select("key", "row").join(by_key, "key", "left").select(
        "row", F.coalesce("matches", F.array().cast(MATCHES)).alias("matches"))


def _merged(found: list[DataFrame]) -> DataFrame:
    """One table of the rows that several passes found."""
    rows = found[0]
    for other in found[1:]:
        rows = rows.union(other)
    out = cut_lineage(rows.groupBy("row").agg(F.flatten(F.collect_list("matches")).alias("matches")))
    discard_cut(*found)
    return out


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per (document, item) match: doc_id, item_id, start, n_words, similarity."""
    found = matches(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, ["doc_id"])
    return found.select("row.doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a match; columns unchanged."""
    return matches(documents, benchmark).where(F.size("matches") == 0).select("row.*")
