"""Quality rules with adaptive thresholds per language and source, in built-in
functions only.

Measures. Every text gives a few counts (words, symbols, repeated lines,
words in repeated 8-word windows, capitals). Windows are compared by 64-bit
hashes inside their text: a text whose window hashes are all distinct is
done; only others sort them to find the repeated positions.

Thresholds. Each measure becomes a whole number (per mille, or tenths of a
character), whose counts per (language, source, measure, value) are the
sketch: an equal-width quantile sketch with an error of one step. Sketches merge
by adding counts, in any order, so partial aggregation, a hot source and a
rerun all give the same sketch; those of a language are the sum over its
sources, those of the corpus the sum over languages. A group's fence is
``q75 + SPREAD * (q75 - q25) + slack`` of its documents that pass the base
rule; a group with fewer than ``MIN_GROUP`` such documents takes the fence of
its language, else of the corpus. The fences are joined back and a document
over any of them is not kept. The measures are written to the shared folder
once and feed both the sketch and the filter.

Cases. Null and empty texts have no words and fail the base rule. A null
language or source counts as the empty one. Ties with a fence pass. Rows are
judged one by one, so repeated rows get equal results. An empty table gives an
empty result. Columns other than id, text, language and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.session import cut_lineage

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
REPEAT_WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
MIN_GROUP = 50
SPREAD = 4
#: measure -> (slack added to its fence, largest value the sketch tells apart)
MEASURES = {
    "symbols_pm": (30, 1000),      # symbols per 1000 word characters
    "capitals_pm": (150, 1000),    # A-Z per 1000 word characters
    "word_tenths": (20, 10_000),   # mean word length in tenths of a character
    "dup_lines_pm": (150, 1000),   # repeated lines per 1000 lines
    "repeats_pm": (150, 1000),     # words in repeated windows per 1000 words
}


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def measure(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang, source and the counts of every row."""
    df = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    w = REPEAT_WINDOW
    df = df.select(
        "doc_id", "lang", "source",
        F.length(_without(F.col("text"), " \t\n\x0b\f\r")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(_without(F.col("text"), CAPITALS))).cast("long").alias("n_capitals"),
        lines.alias("lines"),
        F.transform(F.array_remove(F.split("text", SPACE, -1), ""), lambda x: F.xxhash64(x)).alias("h"))
    df = df.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols", "n_capitals",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("h").cast("long").alias("n_words"),
        F.when(F.size("h") >= w, F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("h") - w, F.lit(0))),
            lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(w)]))).alias("windows"))
    df = df.withColumn("windows", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.array_sort(
        F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    twice = F.filter("windows", lambda x, k: F.coalesce(
        (F.get("windows", k - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(
        (F.get("windows", k + 1)["h"] == x["h"]), F.lit(False)))
    df = df.withColumn("twice", F.array_sort(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        "twice", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, i: F.struct((i + w).alias("end"), (acc["n"] + i + w - F.greatest(acc["end"], i)).alias("n")))["n"]
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("windows", "twice")


def _shares(df: DataFrame) -> DataFrame:
    per = lambda n, total, scale: F.floor(
        F.col(n) * scale / F.greatest(F.col(total), F.lit(1))).cast("long")
    return df.withColumns({
        "symbols_pm": per("n_symbols", "word_chars", 1000), "capitals_pm": per("n_capitals", "word_chars", 1000),
        "word_tenths": per("word_chars", "n_words", 10), "dup_lines_pm": per("n_dup_lines", "n_lines", 1000),
        "repeats_pm": per("n_repeat_words", "n_words", 1000)})


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, value, n): the mergeable sketch of every group."""
    values = F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.least(F.col(m), F.lit(top)).alias("value"))
        for m, (_, top) in MEASURES.items()])).alias("v")
    return (measured.where("not base_failed").select("lang", "source", values)
            .groupBy("lang", "source", "v.measure", "v.value").agg(F.count("*").alias("n")))


def merge(sketch: DataFrame, *by: str) -> DataFrame:
    """Sketches of coarser groups."""
    return sketch.groupBy(*by, "measure", "value").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, *by: str) -> DataFrame:
    """One row per group with a fence per measure (null if under ``MIN_GROUP`` documents)."""
    group = Window.partitionBy(*by, "measure")
    ranked = sketch.withColumn("upto", F.sum("n").over(group.orderBy("value"))).withColumn(
        "total", F.sum("n").over(group))
    quantile = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("total"), F.col("value")))
    one = ranked.groupBy(*by, "measure").agg(quantile(1).alias("q25"), quantile(3).alias("q75"),
                                             F.max("total").alias("total"))
    fence = F.when(F.col("total") >= MIN_GROUP, F.col("q75") + SPREAD * (F.col("q75") - F.col("q25")))
    return one.groupBy(*by).agg(*[
        F.max(F.when(F.col("measure") == m, fence + slack)).alias(m) for m, (slack, _) in MEASURES.items()])


def judge(documents: DataFrame) -> DataFrame:
    """Every row's counts, base_failed, and kept (the joined fences' verdict)."""
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    measured = _shares(cut_lineage(measure(documents))).withColumn("base_failed", base_failed)
    sketch = cut_lineage(sketches(measured))
    by_lang = cut_lineage(merge(sketch, "lang"))
    own, lang = fences(sketch, "lang", "source"), fences(by_lang, "lang")
    corpus = fences(merge(by_lang)).first()  # one row of five numbers
    renamed = lambda df, tag: df.withColumnsRenamed({m: f"{tag}_{m}" for m in MEASURES})
    groups = renamed(own, "own").join(renamed(lang, "lang"), "lang", "left").select(
        "lang", "source", *[F.coalesce(f"own_{m}", f"lang_{m}", F.lit(corpus[m]).cast("long")).alias(f"max_{m}")
                            for m in MEASURES])
    # a stored table of known size: small, it is broadcast, and no hot group is shuffled into one task
    judged = measured.join(cut_lineage(groups), ["lang", "source"], "left")
    over = F.lit(False)
    for m in MEASURES:
        over = over | F.coalesce(F.col(m) > F.col(f"max_{m}"), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~over)
