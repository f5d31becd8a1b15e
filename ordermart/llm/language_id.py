"""Language ID: a linear-chain conditional random field that labels every word
of (possibly code-switched) text, trained here.

Features of a word, hashed to ``2**BITS`` rows of one weight per language:
byte n-grams of the lower-case word with boundary marks (those that touch a
mark are its prefixes and suffixes), the word itself, and membership in the
lexicon of frequent words learned for each language. Learned transitions say
how often a text goes over from one language to another. Forward-backward gives
each word's posterior over the languages; a text's language is that of the
largest mean posterior over its words with letters, and the mean its score.

Training. Of each language, the documents of smallest ``xxhash64(id)`` outside the
held-out fold that have a text, at most ``SAMPLE`` per language (a documented bound;
every language that has one is learned, however rare), give up to ``SEGMENTS`` runs of
``RUN`` words each. Each task passes on at most ``SAMPLE`` ids of a language. Runs of different documents are
put together to sequences that switch language, so transitions are learned from
switches too, and the likelihood is raised by AdaGrad steps in one task of
bounded input. The model (``2**BITS`` x languages floats) reaches the driver.

Scoring. A text is cut into sequences of ``STEPS`` words, all of it; the
sequences of a batch of documents run through forward-backward together, a
word position at a time. A word's scores are computed once per distinct word of
a batch.

Cases. ``und``, score 0: null text, no letter in it, or nothing to learn from.
Ties go to the first language in alphabetical order. Rows that share an id
count once in training (least language, then least text); every row is
predicted by its own text, so repeated rows get equal results. Language,
source, id and other columns never enter a prediction. An empty table gives
an empty result.
"""

from __future__ import annotations

import pickle
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.common import BYTES, LOWER, Texts, rows_of, sliced, text_bytes
from ordermart.llm.quality_classifier import fold

BITS = 17
SAMPLE = 750  # documents of each language; at most 1000, where Spark stops limiting ranks before the shuffle
SEGMENTS, RUN, RUNS_PER_SEQUENCE = 16, 8, 4
EPOCHS, BATCH, RATE, DECAY = 3, 64, 0.3, 1e-6
LEXICON = 200
STEPS = 64
SEQUENCES = 8192  # run through forward-backward together
FOLDS, HELD_OUT = 4, 2
NGRAMS = (2, 3, 4)


_LETTER = np.zeros(256, bool)  # bytes of non-ASCII characters count as letters
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_MARKED = np.array([int.from_bytes(xxhash.xxh3_64_digest(b"%d" % n)) | 1 for n in range(max(NGRAMS) + 1)], np.uint64)


class Vocabulary:
    """The distinct words of a batch of texts, without their outer marks and in
    lower case, and where they occur."""

    def __init__(self, texts: list[bytes]):
        t = Texts(texts)
        starts, ends = t.words()
        letters = _LETTER[t.data]
        upto = np.append(0, np.cumsum(letters))
        places = np.append(np.flatnonzero(letters), 0)
        a, b = upto[starts], upto[ends]
        starts, ends = np.where(b > a, places[a], starts), np.where(b > a, places[b - 1] + 1, starts)
        self.owner = t.owner(starts)
        hashes = t.hashes(starts, ends, LOWER)
        self.hashes, first, self.at = np.unique(hashes, return_index=True, return_inverse=True)
        self.starts, self.ends, self.data = starts[first], ends[first], t.data
        self.letters = self.ends > self.starts

    def __len__(self) -> int:
        return len(self.hashes)

    def features(self) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Offsets of the words in the arrays of n-gram rows (one array per n; row
        ``2**BITS`` where no n-gram starts) and each word's own row, all with
        the same value in a word: 1 / sqrt(its number of features)."""
        sizes = self.ends - self.starts + 2
        offsets = np.cumsum(sizes) - sizes
        place = np.arange(sizes.sum()) - np.repeat(offsets, sizes)
        source = np.repeat(self.starts, sizes) + place - 1
        text = _SMALL[self.data[np.clip(source, 0, max(len(self.data) - 1, 0))]] if len(self.data) else source.astype(np.uint8)
        text[offsets], text[offsets + sizes - 1] = ord("^"), ord("$")
        code = np.append(BYTES[text], np.zeros(max(NGRAMS), np.uint64))
        left = np.repeat(sizes, sizes) - place
        rows = []
        for n in NGRAMS:
            h = np.zeros(len(text), np.uint64)
            for k in range(n):
                h += code[k:k + len(text)] * _MARKED[k]
            h = (h * _MARKED[n]) >> np.uint64(64 - BITS)
            h[left < n] = 2**BITS
            rows.append(h.astype(np.int32))
        count = 1 + sum(np.maximum(sizes - n + 1, 0) for n in NGRAMS)
        return offsets, rows, (self.hashes >> np.uint64(64 - BITS)).astype(np.int32), 1 / np.sqrt(count)


@dataclass
class Crf:
    labels: list[str]
    weights: np.ndarray  # languages x (2**BITS + 1), the last always zero
    lexicon: np.ndarray  # sorted hashes of the lexicons' words
    in_lexicon: np.ndarray  # words of the lexicons x languages, 0 or 1
    lexicon_weights: np.ndarray  # languages x languages
    transitions: np.ndarray  # languages x languages, log scores

    def memberships(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(hashes), len(self.labels)), np.float32)
        if len(self.lexicon):
            at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
            known = self.lexicon[at] == hashes
            out[known] = self.in_lexicon[at[known]]
        return out

    def emissions(self, words: Vocabulary) -> np.ndarray:
        """Scores of each distinct word under each language; zero for a word without letters."""
        out = self.memberships(words.hashes) @ self.lexicon_weights
        offsets, rows, own, value = words.features()
        for k, w in enumerate(self.weights):
            total = w[own]
            for r in rows:
                total = total + np.add.reduceat(w[r], offsets)
            out[:, k] += total * value
        out[~words.letters] = 0
        return out


def forward_backward(scores: np.ndarray, real: np.ndarray, transitions: np.ndarray):
    """Posteriors of sequences x steps x languages (scores likewise; ``real``
    marks steps that exist, from the left) and the forward and backward messages."""
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    a = np.exp(transitions).astype(e.dtype)
    fwd, bwd = np.empty_like(e), np.ones_like(e)
    fwd[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, e.shape[1]):
        m = (fwd[:, t - 1] @ a) * e[:, t]
        m /= m.sum(axis=1, keepdims=True)
        fwd[:, t] = np.where(real[:, t, None], m, fwd[:, t - 1])
    for t in range(e.shape[1] - 2, -1, -1):
        m = (bwd[:, t + 1] * e[:, t + 1]) @ a.T
        m /= m.sum(axis=1, keepdims=True)
        bwd[:, t] = np.where(real[:, t + 1, None], m, 1)
    post = fwd * bwd
    return post / post.sum(axis=2, keepdims=True), fwd, bwd, e, a


def fit(runs: list[tuple[str, list[bytes]]]) -> Crf:
    """(language, words) runs, in a fixed order -> model."""
    labels = sorted({lang for lang, _ in runs})
    number, size = {lang: k for k, lang in enumerate(labels)}, len(labels)
    words = Vocabulary([b" ".join(w) for _, w in runs])
    gold_of = np.array([number[lang] for lang, _ in runs])[words.owner]
    counts = np.zeros((len(words), size))
    np.add.at(counts, (words.at, gold_of), 1)
    counts[~words.letters] = 0
    chosen = np.zeros((len(words), size), bool)
    for k in range(size):
        able = np.flatnonzero((counts[:, k] > 2) & (2 * counts[:, k] > counts.sum(axis=1)))
        chosen[able[np.lexsort((words.hashes[able], -counts[able, k]))[:LEXICON]], k] = True
    listed = chosen.any(axis=1)
    model = Crf(labels, np.zeros((size, 2**BITS + 1), np.float32), words.hashes[listed],
                chosen[listed].astype(np.float32), np.zeros((size, size), np.float32),
                np.zeros((size, size), np.float32))
    offsets, grams, own, value = words.features()
    owner = np.repeat(np.arange(len(words)), np.diff(np.append(offsets, len(grams[0]))))
    at = np.concatenate([*[owner] * len(grams), np.arange(len(words))])
    rows = np.concatenate([*grams, own])
    at, rows = at[rows < 2**BITS], rows[rows < 2**BITS]
    order = np.argsort(at, kind="stable")
    at, rows = at[order], rows[order]
    value = value[at]
    edges = np.searchsorted(at, np.arange(len(words) + 1))
    lex, silent = model.memberships(words.hashes), ~words.letters
    by_run = np.split(words.at, np.searchsorted(words.owner, np.arange(1, len(runs))))
    sums = [np.full(x.shape, 1e-6, np.float32) for x in (model.weights, model.lexicon_weights, model.transitions)]

    def ascend(param, seen, grad):
        seen += grad * grad
        param += RATE * (grad - DECAY * param) / np.sqrt(seen)

    steps = RUN * RUNS_PER_SEQUENCE
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        shuffled = rng.permutation(len(runs))
        flat = np.concatenate([by_run[i] for i in shuffled])
        spoken = np.concatenate([np.full(len(by_run[i]), number[runs[i][0]]) for i in shuffled])
        for start in range(0, len(flat), BATCH * steps):
            part = np.arange(start, min(start + BATCH * steps, len(flat)))
            n = -(-len(part) // steps)
            real = (np.arange(n * steps) < len(part)).reshape(n, steps)
            part = np.pad(part, (0, n * steps - len(part)), mode="edge")
            word, gold = flat[part].reshape(n, steps), spoken[part].reshape(n, steps)
            used, inverse = np.unique(word, return_inverse=True)
            inverse = inverse.reshape(n, steps)
            take = np.concatenate([np.arange(edges[u], edges[u + 1]) for u in used])
            local = np.repeat(np.arange(len(used)), edges[used + 1] - edges[used])
            scores = lex[used] @ model.lexicon_weights
            for k in range(size):
                scores[:, k] += np.bincount(local, model.weights[k, rows[take]] * value[take], minlength=len(used))
            scores[silent[used]] = 0
            post, fwd, bwd, e, a = forward_backward(scores[inverse].astype(np.float32), real, model.transitions)
            wrong = np.eye(size, dtype=np.float32)[gold] - post
            wrong[~real] = 0
            by_word = np.stack([np.bincount(inverse.ravel(), wrong[:, :, k].ravel(), minlength=len(used))
                                for k in range(size)], axis=1)
            by_word[silent[used]] = 0
            touched, back = np.unique(rows[take], return_inverse=True)
            grad = np.stack([np.bincount(back, by_word[local, k] * value[take], minlength=len(touched))
                             for k in range(size)]).astype(np.float32)
            pair = fwd[:, :-1, :, None] * a * (e[:, 1:] * bwd[:, 1:])[:, :, None, :]
            pair /= pair.sum(axis=(2, 3), keepdims=True)
            both = real[:, 1:]
            went = np.zeros((size, size))
            np.add.at(went, (gold[:, :-1][both], gold[:, 1:][both]), 1)
            w, seen = model.weights[:, touched], sums[0][:, touched]
            ascend(w, seen, grad)
            model.weights[:, touched], sums[0][:, touched] = w, seen
            ascend(model.lexicon_weights, sums[1], (lex[used].T @ by_word).astype(np.float32))
            ascend(model.transitions, sums[2], (went - pair[both].sum(axis=0)).astype(np.float32))
    return model


def predict(texts: list[bytes], model: Crf) -> list[tuple[str, float]]:
    """(language, score) of whole texts."""
    size = len(model.labels)
    words = Vocabulary(texts)
    if not size or not len(words):
        return [("und", 0.0)] * len(texts)
    emissions, at, owner = model.emissions(words), words.at, words.owner
    counts = np.bincount(owner, minlength=len(texts))
    per = -(-counts // STEPS)  # sequences per text
    place = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
    place += np.repeat((np.cumsum(per) - per) * STEPS, counts)
    sums = np.zeros((len(texts), size))
    for start in range(0, int(per.sum()), SEQUENCES):
        a, b = np.searchsorted(place, (start * STEPS, (start + SEQUENCES) * STEPS))
        n = min(SEQUENCES, int(per.sum()) - start)
        here = place[a:b] - start * STEPS
        scores, real = np.zeros((n * STEPS, size), np.float32), np.zeros(n * STEPS, bool)
        scores[here], real[here] = emissions[at[a:b]], True
        post = forward_backward(scores.reshape(n, STEPS, size), real.reshape(n, STEPS), model.transitions)[0]
        post = post.reshape(-1, size)[here] * words.letters[at[a:b]][:, None]
        for k in range(size):
            sums[:, k] += np.bincount(owner[a:b], post[:, k], minlength=len(texts))
    n = np.bincount(owner, words.letters[at], minlength=len(texts))
    mean = np.round(sums / np.maximum(n, 1)[:, None], 6)
    best = mean.argmax(axis=1)
    return [(model.labels[k], float(min(1.0, m[k]))) if c and has_letter(t) else ("und", 0.0)
            for k, m, c, t in zip(best, mean, n, texts)]


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace"))


def training_runs(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(key, part, lang, words) runs of at most ``sample`` documents of each language."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                            F.col("text").cast("string").alias("text"))
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()
                        & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    ids = usable.groupBy("doc_id").agg(F.min("lang").alias("lang")).withColumn("key", F.xxhash64("doc_id"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key", "doc_id"))
    ids = ids.withColumn("rank", rank).where(F.col("rank") <= sample).select("doc_id", "key")
    rows = usable.join(F.broadcast(ids), "doc_id").groupBy("key", "doc_id").agg(  # at most ``sample`` ids a language
        F.min(F.struct("lang", "text")).alias("d")).select("key", "d.lang", text_bytes(F.col("d.text")).alias("text"))

    def runs(batches):
        for b in batches:
            for key, lang, text in rows_of([b], "key", "lang", "text"):
                words = text.split()
                cuts = sorted(range(0, len(words), RUN), key=lambda i: xxhash.xxh3_64_intdigest(str(i).encode(), seed=key % 2**64))
                found = [(key, i, lang, words[i:i + RUN]) for i in cuts[:SEGMENTS]]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int32(), pa.string(), pa.list_(pa.binary())))],
                        ["key", "part", "lang", "words"])

    return rows.mapInArrow(runs, "key long, part int, lang string, words array<binary>")


def train(documents: DataFrame, sample: int = SAMPLE) -> Crf:
    def learn(batches):
        runs = [(lang, words) for lang, words in rows_of(batches, "lang", "words")]
        if runs:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(runs))], pa.binary())], ["model"])

    stream = training_runs(documents, sample).repartition(1).sortWithinPartitions(F.xxhash64("key", "part"), "key", "part")
    row = stream.select("lang", "words").mapInArrow(learn, "model binary").first()
    none = np.zeros((0, 0), np.float32)
    return pickle.loads(row["model"]) if row else Crf([], none, np.empty(0, np.uint64), none, none, none)


def identify(documents: DataFrame, model: Crf | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    model = train(documents) if model is None else model
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded: 2**BITS x languages

    def label(batches):
        for b in sliced(batches):
            found = predict(b.column("text").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                ["doc_id", "lang_pred", "score"])

    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(F.col(text_col)).alias("text"))
    return docs.mapInArrow(label, "doc_id long, lang_pred string, score double").select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")
