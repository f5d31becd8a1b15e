"""Secret scan: rule matches plus a sliding-window Shannon entropy, all in
built-in functions.

Positions. Spark returns all matches of a pattern but not where they are; the
pieces between them come from ``split`` with the same pattern, so the lengths
of pieces and matches alternate and their running sum gives every start
(code points, end exclusive). The running sum is folded in blocks of
``FOLD`` matches, so a text made of secrets costs n * sqrt(n)-like work
and not n^2. Texts without a match skip all of this.

Entropy. A candidate is a maximal run of ``[A-Za-z0-9+/_=-]`` of at least
``WINDOW`` characters. Its character class (hex, alphanumeric, one case with
joiners, base64) is the narrowest that holds all its characters; each class asks
for digits and letters and has its own threshold. Over a window of ``WINDOW`` characters the
entropy is ``log2 W - S / W`` with ``S = sum c log2 c`` over the characters'
counts c. The fold's state holds the counts of the window, packed in a few longs; a step
takes the leaving character's count down and the entering one's up and moves S by the
difference of their terms (whole numbers, so nothing drifts). No count is
recomputed and work is linear in the length of a candidate. A candidate whose best window reaches the threshold is a span of
kind ``entropy``, unless a rule's span already covers it. Windows that overlap a
match of ``ALLOW_WORDS`` or ``ALLOW_PARTS`` do not count: the others are those of the pieces between
the matches. Candidates that are harmless as a whole (``ALLOW``) are no spans.

Cases. Null and empty texts have no spans. Rows are independent: repeated rows
and null or repeated ids get their own, equal results; no column but id and
text is read. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base rules.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"  # maximal runs only
ASSIGN_CHARS, ACCESS_CHARS = 12, 18

# The entropy method.
WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
#: class -> (all characters, what it must contain, bits per character a window must reach)
CLASSES = {
    "hex": (r"^[0-9A-Fa-f]+$", (r"[0-9]", r"[A-Fa-f]"), 3.0),
    "alnum": (r"^[0-9A-Za-z]+$", (r"[0-9]", r"[A-Za-z]"), 3.5),
    "joined": (r"^([0-9a-z+/_=-]+|[0-9A-Z+/_=-]+)$", (r"[0-9]", r"[A-Za-z]"), 3.8),
    "base64": (r"^[0-9A-Za-z+/_=-]+$", (r"[0-9]", r"[a-z]", r"[A-Z]"), 3.7),
}
#: Candidates that match one of these are known to be harmless.
ALLOW = (
    r"(?i)^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$",  # UUID
    r"^[A-Za-z]++(?:[/_-][A-Za-z]++)*+[/_-]?[0-9]{0,4}$",  # words joined to a path or name
)
#: So are the parts of a candidate that match these: a word between joiners that holds such a name (looked
#: for from the word's start only, so once through the candidate); alphabets and fillers.
ALLOW_WORDS = r"(?i)(?<![0-9a-z])[0-9a-z]*?(?:example|sample|placeholder|changeme|dummy)[0-9a-z]*+"
ALLOW_PARTS = r"(?i) |0123456789|abcdefghij|(.)\1{5,}+"
#: Counts of a window: BITS each, PER_WORD in a long, of the characters + to z; terms c log2 c in units of 1 / ONE.
FIRST, LAST, BITS, PER_WORD, ONE = ord("+"), ord("z"), 5, 12, 2**40
KIND_ORDER = ("assign", "access", "hex", "entropy")
FOLD = 200
_SPANS = "array<struct<start:int,k:int,end:int,kind:string>>"


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _spans(text: Column, pattern: str, kind: str, keep) -> Column:
    """All spans of a pattern's matches that ``keep`` (match, text) accepts."""
    k = KIND_ORDER.index(kind)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    flags = keep(text, found)
    lengths = F.zip_with(F.split(text, pattern, -1), F.zip_with(found, flags, lambda m, f: F.struct(
        F.length(m).alias("len"), f.alias("ok"))), lambda gap, m: F.struct(
            F.length(gap).alias("gap"), m["len"].alias("len"), m["ok"].alias("ok")))
    start = lambda acc, x: acc["at"] + x["gap"]
    none = F.array().cast(_SPANS)

    def step(acc, x):
        span = F.struct(start(acc, x).alias("start"), F.lit(k).alias("k"), (start(acc, x) + x["len"]).alias("end"),
                        F.lit(kind).alias("kind"))
        return F.struct((start(acc, x) + F.coalesce(x["len"], F.lit(0))).alias("at"),
                        F.when(F.coalesce(x["ok"], F.lit(False)), F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))

    def fold(parts):
        def block(acc, i):
            inner = F.aggregate(F.slice(parts, i * FOLD + 1, F.lit(FOLD)),
                                F.struct(acc["at"].alias("at"), none.alias("spans")), step)
            return _let(inner, lambda x: F.struct(
                x["at"].alias("at"), F.concat(acc["parts"], F.array(x["spans"])).alias("parts")))

        blocks = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / FOLD).cast("int"))
        done = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("parts")), block)
        return F.flatten(done["parts"])

    return F.when(text.rlike(pattern), _let(lengths, fold)).otherwise(none)


def _word_of(code: Column) -> Column:
    """Where the count of a character is held: (number of the word, shift, one there)."""
    return _let(code - FIRST, lambda k: F.struct(
        F.floor(k / PER_WORD).cast("int").alias("word"), (k % PER_WORD * BITS).alias("shift"),
        F.call_function("shiftleft", F.lit(1).cast("long"), k % PER_WORD * BITS).alias("one")))


def window_entropy(s: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy, in bits per character, of any ``window`` (31 at
    most) consecutive characters of a string of candidate characters; null for
    shorter strings. A step costs the same however long the string is: the counts of the
    current window are carried, one is taken down and one up."""
    if not 1 < window < 2**BITS:
        raise ValueError(f"a window has 2 to {2**BITS - 1} characters")
    plog = [round(c * math.log2(c) * ONE) if c else 0 for c in range(window + 1)]
    gain = F.lit([b - a for a, b in zip(plog, plog[1:])])  # of S when a count goes from c to c + 1
    words = [f"w{j}" for j in range(-(-(LAST - FIRST + 1) // PER_WORD))]

    def count(counts, at):
        word = F.get(F.array(*(counts[w] for w in words)), at["word"])
        return F.call_function("shiftright", word, at["shift"]).bitwiseAND(F.lit(2**BITS - 1).cast("long")).cast("int")

    def changed(counts, at, sign):
        return [(counts[w] + F.when(at["word"] == j, sign * at["one"]).otherwise(F.lit(0).cast("long"))).alias(w)
                for j, w in enumerate(words)]

    def fold(places):
        def step(acc, i):
            came, gone = F.get(places, i), F.get(places, i - window)

            def add(x):
                total = x["s"] + F.get(gain, count(x, came))
                return _let(total, lambda t: F.struct(*changed(x, came, 1), t.alias("s"), F.when(
                    i >= window - 1, F.least(x["best"], t)).otherwise(x["best"]).alias("best")))

            without = F.when(gone.isNull(), acc).otherwise(F.struct(
                *changed(acc, gone, -1), (acc["s"] - F.get(gain, count(acc, gone) - 1)).alias("s"), acc["best"].alias("best")))
            return _let(without, add)

        zero = F.lit(0).cast("long")
        start = F.struct(*(zero.alias(w) for w in words), zero.alias("s"), F.lit(2**62).alias("best"))
        return F.aggregate(F.sequence(F.lit(0), F.size(places) - 1), start, step)["best"]

    least = _let(F.transform(F.split(s, ""), lambda c: _word_of(F.ascii(c))), fold)
    return F.when(F.length(s) >= window, F.round(F.lit(math.log2(window)) - least / (window * ONE), 6))


def is_secret_like(s: Column) -> Column:
    """The entropy method's verdict on one candidate string."""
    allowed = F.lit(False)
    for pattern in ALLOW:
        allowed = allowed | s.rlike(pattern)
    needed = F.lit(None).cast("double")
    for chars, parts, bits in reversed(list(CLASSES.values())):
        has = F.lit(True)
        for p in parts:
            has = has & s.rlike(p)
        needed = F.when(s.rlike(chars), F.when(has, F.lit(bits))).otherwise(needed)
    return F.when(allowed, F.lit(False)).otherwise(_let(needed, lambda n: F.when(
        n.isNull(), F.lit(False)).otherwise(F.exists(
            F.split(F.regexp_replace(s, ALLOW_WORDS, " "), ALLOW_PARTS, -1),
            lambda p: F.coalesce(window_entropy(p) >= n, F.lit(False))))))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, n_entropy, base_spans and
    all_spans (arrays of start, end, kind, ordered), spans (all, as text)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    value_long = lambda t, found: F.transform(
        F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_CHARS)
    t = F.col("text")
    df = documents.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    df = df.select(
        "doc_id",
        _spans(t, ASSIGN, "assign", value_long).alias("assign"),
        _spans(t, ACCESS, "access", lambda _, f: F.transform(f, lambda m: F.length(m) >= ACCESS_CHARS)).alias("access"),
        _spans(t, HEX, "hex", lambda _, f: F.transform(f, lambda m: F.lit(True))).alias("hex"),
        _spans(t, CANDIDATE, "entropy", lambda _, f: F.transform(f, is_secret_like)).alias("entropy"))
    df = df.withColumn("base_spans", F.array_sort(F.concat("assign", "access", "hex")))
    fresh = F.filter("entropy", lambda e: ~F.exists(
        "base_spans", lambda b: (b["start"] <= e["start"]) & (e["end"] <= b["end"])))
    df = df.withColumn("entropy", fresh)
    df = df.withColumn("all_spans", F.array_sort(F.concat("base_spans", "entropy")))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KIND_ORDER]
    return df.select("doc_id", *counts, "base_spans", "all_spans",
                     F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"),
                     _joined(F.col("all_spans")).alias("spans"))
