"""Quality classifier: hashed word n-grams, logistic regression by
follow-the-regularised-leader (FTRL-proximal), scored as sparse dot products.

Features. A text is a sequence of tokens (runs of letters, digits, or other
marks). Its features are the token and its lower-case bigrams, and, since a
corpus never ends to bring new words, the n-grams (1 to 3) of the tokens'
shapes (capitals, capitalised, lower, digits, the marks themselves). All are
hashed to ``2**BITS`` coordinates; a coordinate's value is ``SCALE`` times its
share of the text's tokens, so the score is a sparse dot product: a gather of
weights over the text's hashed n-grams, averaged, through the logistic function.

Training. The labelled rows of smallest ``xxhash64(id)``, at most ``SAMPLE``
(a documented bound; the whole set if smaller), are turned into sparse vectors
in parallel and then stream, in a fixed order and ``EPOCHS`` times over,
through one task that keeps only the FTRL state (two numbers a coordinate).
The model, ``2**BITS`` floats and a bias, is what reaches the driver.

Cases. Null and empty texts have no tokens: their score is that of the bias.
Without labelled rows the model is zero and every score 0.5. Labels other than
0 and 1 are not learned from; of rows that share a labelled id the least
label and the least text are learned. Rows are scored one by one, so repeated
rows get equal scores; other columns never enter a score. An empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import LOWER, Texts, mix64, rows_of, sliced, text_bytes

BITS = 18
SAMPLE = 8000
EPOCHS = 3
SCALE = 16.0
ALPHA, BETA, L1, L2 = 0.3, 0.2, 0.02, 0.01
FOLDS, HELD_OUT = 5, 0
KEEP_FROM = 0.3
# Kinds of bytes; those of non-ASCII characters count as letters.
_SPACES, _LETTER, _DIGIT, _MARK = range(4)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACES
_KIND[48:58] = _DIGIT
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_CAPITAL, _SMALL = np.zeros(256, bool), np.zeros(256, bool)
_CAPITAL[65:91] = _SMALL[97:123] = True


def _salt(k: int) -> np.uint64:
    return np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hashed coordinate) of all n-grams, and each text's number of tokens."""
    t = Texts(texts)
    kind = _KIND[t.data]
    cut = np.zeros(len(kind), bool)
    cut[1:] = kind[1:] != kind[:-1]
    starts, ends = t.edges(kind != _SPACES, cut)
    word, first = t.hashes(starts, ends, LOWER), kind[starts]
    capital, small = (np.concatenate([[0], np.cumsum(x[t.data])]) for x in (_CAPITAL, _SMALL))
    capital, small = (x[ends] - x[starts] for x in (capital, small))
    # capitals AA, one capital A, capitalised Aa, other letters a, digits; marks are their own shape
    shape = np.select([first == _DIGIT, (capital > 0) & (small == 0) & (ends - starts > 1),
                       (capital > 0) & (small == 0), _CAPITAL[t.data[starts]]], [1, 2, 3, 4], 5).astype(np.uint64)
    shape = np.where(first == _MARK, word, mix64(shape))
    doc = t.owner(starts)
    two = doc[1:] == doc[:-1]
    three = two[1:] & two[:-1]
    pairs = shape[:-1] * _salt(3) + shape[1:] * _salt(5)
    grams = [word, (word[:-1] * _salt(7) + word[1:] * _salt(9))[two], shape + _salt(11), pairs[two],
             (pairs[:-1] * _salt(13) + shape[2:] * _salt(15))[three]]
    owner = np.concatenate([doc, doc[1:][two], doc, doc[1:][two], doc[2:][three]])
    at = (mix64(np.concatenate(grams)) >> np.uint64(64 - BITS)).astype(np.int64)
    return owner, at, np.bincount(doc, minlength=len(texts))


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        owner, at, n = ngrams(texts)
        sums = np.bincount(owner, self.weights[at], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(self.bias + SCALE * sums / np.maximum(n, 1), -50, 50)))


def ftrl(rows, bits: int = BITS) -> Model:
    """One pass of FTRL-proximal over (label, coordinates, values); the bias is unregularised."""
    z, n = np.zeros(2**bits + 1), np.zeros(2**bits + 1)
    bias = 2**bits

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[np.abs(zi) <= L1] = 0.0
        if at[-1] == bias:
            w[-1] = -zi[-1] / ((BETA + np.sqrt(n[bias])) / ALPHA)
        return w

    for y, at, x in rows:
        at, x = np.append(at, bias), np.append(x, 1.0)
        w = weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -50, 50)))
        g = (p - y) * x
        sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
        z[at] += g - sigma * w
        n[at] += g * g
    w = weights(np.arange(bias + 1))
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def fold(id_col: Column, folds: int) -> Column:
    return F.crc32(id_col.cast("string")) % folds


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """(key, y, text) of at most ``sample`` labelled documents outside the held-out fold."""
    ids = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
           .where(F.col("y").isin(0, 1) & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
           .groupBy("doc_id").agg(F.min("y").alias("y")).withColumn("key", F.xxhash64("doc_id"))
           .orderBy("key", "doc_id").limit(sample))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (docs.join(F.broadcast(ids), "doc_id")  # at most ``sample`` ids
            .groupBy("key", "doc_id", "y").agg(F.min("text").alias("text")).select("key", "y", "text"))


def train(sample: DataFrame, epochs: int = EPOCHS) -> Model:
    """(key, y, text) rows -> model."""
    vectors = pa.schema([("key", pa.int64()), ("y", pa.int32()), ("at", pa.binary()), ("x", pa.binary())])

    def vectorise(batches):
        for b in sliced(batches):
            out = []
            for key, y, text in rows_of([b], "key", "y", "text"):
                _, at, (n,) = ngrams([text])
                at, count = np.unique(at, return_counts=True)
                out.append((key, y, at.astype(np.int32).tobytes(), (SCALE * count / max(n, 1)).astype(np.float32).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), vectors)], schema=vectors)

    def learn(batches):
        model = ftrl((y, np.frombuffer(at, np.int32).astype(np.int64), np.frombuffer(x, np.float32).astype(float))
                     for y, at, x in rows_of(batches, "y", "at", "x"))
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()]), pa.array([model.bias])], ["w", "bias"])

    stream = (sample.select("key", "y", text_bytes(F.col("text")).alias("text"))
              .mapInArrow(vectorise, "key long, y int, at binary, x binary")
              .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
              .repartition(1).sortWithinPartitions("epoch", F.xxhash64("key", "epoch"), "key"))
    row = stream.mapInArrow(learn, "w binary, bias double").first()
    return Model(np.frombuffer(row["w"], np.float32), row["bias"]) if row else Model(np.zeros(2**BITS, np.float32), 0.0)


def score(documents: DataFrame, model: Model, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The ``keep`` columns of every row and its score."""
    keep = documents.columns if keep is None else keep
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                            text_bytes(F.col(f"`{text_col}`")).alias("text"))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # 2**BITS floats
    schema = rows.select("row").schema.add("score", "double")

    def scored(batches):
        for b in sliced(batches):
            found = shared.value.score(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(found, pa.float64())], ["row", "score"])

    return rows.mapInArrow(scored, schema)


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(labelled_sample(documents, labels))
    out = score(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, ["doc_id"])
    return out.select(
        "row.doc_id", F.coalesce(fold(F.col("row.doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject; columns unchanged."""
    model = train(labelled_sample(documents, labels))
    return score(documents, model).where(F.col("score") >= KEEP_FROM).select("row.*")
