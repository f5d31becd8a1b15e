"""Mixing sources to target weights by Poisson replication.

A source's target repetition rate is its share of the mixture times the size of the
mixture over its number of documents. A document is repeated as often as a
Poisson variable of that mean says, drawn by inverting the distribution at a
uniform number hashed from (seed, id): the count is the number of cumulative
probabilities that the uniform reaches. So a count depends on nothing but the
document, the rate and the seed, and a rerun or a lost task draws the same. Copies
are put in a global order by a hash of (seed, id, copy), a range-partitioned sort.

Weights. ``targets`` gives sources their weights (others get none); without it a
source weighs the square root of its number of documents, which evens out large
and small sources. ``size`` documents are expected in the mixture (default: as
many as there are).

The table of rates has a row per source. Up to ``BROADCAST_SOURCES`` of them
(counted) it is broadcast; beyond, it is joined by source like any table, where
a hot source is split at run time. The cumulative probabilities of a rate are
computed with the table, down to a tail below 2^-53, the uniform's resolution,
so no count is cut off.

Cases. A null source is a source of its own. A row with a null id is drawn by its
text's digest; otherwise texts are not looked at, they may be null or empty.
Repeated rows get equal counts and order keys. An
empty table, or weights that are all zero, give an empty mixture. Other columns
are kept unchanged by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.session import cut_lineage

SEED = 20240601
BROADCAST_SOURCES = 10_000
_HEX = 13  # hex digits of an md5 that make a uniform of 52 bits
_KEY_HEX = 15


def identity(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """What a document is drawn by: its id, or its text's digest where that is null."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("t"), F.md5(text)))


def hashed(digits: int, *parts: Column) -> Column:
    """A whole number of ``digits`` hex digits hashed from the seed and ``parts``."""
    digest = F.md5(F.concat_ws(":", F.lit(str(SEED)), *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def rates(documents: DataFrame, targets: dict[str, float] | None = None, size: int | None = None) -> DataFrame:
    """(source, n, rate): the mean number of copies of a document of each source."""
    counts = cut_lineage(documents.groupBy(F.col("source").cast("string").alias("source")).agg(F.count("*").alias("n")))
    if targets is None:
        weight = F.sqrt(F.col("n").cast("double"))
    else:
        weight = F.lit(0.0)
        for source, value in targets.items():
            weight = F.when(F.col("source") == source, F.lit(float(value))).otherwise(weight)
    weighed = counts.withColumn("weight", weight)
    total = weighed.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    expected = float(size if size is not None else total["n"] or 0)
    share = F.col("weight") / F.lit(float(total["weight"] or 0.0) or 1.0)
    return weighed.select("source", "n", (share * expected / F.col("n")).alias("rate"))


def cumulative(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of a Poisson variable, as an array, to a tail below 2^-53.
    Terms are kept in logarithms, so large rates do not underflow."""
    most = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    step = lambda acc, k: F.transform(F.array(acc["log"] + F.log(rate / k)), lambda log: F.struct(
        log.alias("log"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + F.exp(log))).alias("cdf")))[0]
    start = F.struct((-rate).alias("log"), F.array(F.exp(-rate)).alias("cdf"))
    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), most), start, step)["cdf"]).otherwise(F.array(F.lit(1.0)))


def mix(documents: DataFrame, targets: dict[str, float] | None = None, size: int | None = None,
        keep: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """The mixture in global order: ``row`` (struct of the ``keep`` columns), ``source``, ``copy`` (from 1), ``mix_key``."""
    spark = documents.sparkSession
    keep = documents.columns if keep is None else keep
    table = rates(documents, targets, size).select(F.col("source").alias("s"), cumulative(F.col("rate")).alias("cdf"))
    if table.count() <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                            F.col("source").cast("string").alias("source"), identity().alias("id"))
    drawn = rows.join(table, F.col("source").eqNullSafe(F.col("s"))).withColumn(
        "u", hashed(_HEX, F.col("id")) / F.lit(float(16**_HEX)))
    n = F.size(F.filter("cdf", lambda p: p <= F.col("u")))
    copies = (drawn.withColumn("n", n).where("n > 0")
              .select("row", "source", "id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
              .withColumn("mix_key", hashed(_KEY_HEX, F.lit("order"), F.col("id"), F.col("copy"))))
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # keys are uniform, so equal ranges of them are equal parts and no sample is needed
    part = F.floor(F.col("mix_key") / F.lit(float(16**_KEY_HEX)) * parts).cast("int")
    return copies.repartitionById(parts, part).sortWithinPartitions("mix_key", "id", "copy").drop("id")


def mixture(documents: DataFrame) -> DataFrame:
    """doc_id, source, copy, mix_key of every copy in the mixture."""
    return mix(documents, keep=["doc_id"]).select("row.doc_id", "source", "copy", "mix_key")


def replicate(documents: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The documents, each as often as drawn, in global order; columns unchanged."""
    return mix(documents, targets).select("row.*")


ORACLE = f"""
WITH s AS (SELECT source, count(*) AS n, sqrt(count(*)::DOUBLE) AS w FROM documents GROUP BY source),
t AS (SELECT sum(n)::DOUBLE AS n, sum(w) AS w FROM s),
r AS (SELECT s.source, s.w / t.w * t.n / s.n AS rate FROM s, t),
ks AS (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT + 1)) AS k FROM r),
c AS (SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1.0))) OVER (PARTITION BY source ORDER BY k) AS cdf
      FROM ks),
d AS (SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), 't' || md5(coalesce(text, ''))) AS id FROM documents),
u AS (SELECT *, CAST('0x' || substr(md5('{SEED}:' || id), 1, {_HEX}) AS BIGINT) / {float(16**_HEX)!r} AS u FROM d)
SELECT u.doc_id, u.source, CAST(c.k + 1 AS INTEGER) AS copy,
       CAST('0x' || substr(md5('{SEED}:order:' || id || ':' || (c.k + 1)), 1, {_KEY_HEX}) AS BIGINT) AS mix_key
FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source AND c.cdf <= u.u
"""
