"""Toxicity: words as averages of character n-gram vectors, passages as averages of words, a linear softmax.

Vectors of hashed n-grams and the weights of the softmax are trained jointly with numpy, so that an
unseen spelling shares most vectors with the word it stands for. The unit is a passage of
``PASSAGE`` words, of which each different one counts once, as a line of one repeated word says no
more than the word; the average is always over ``PASSAGE`` places. A document scores as its most toxic passage. In training, all passages of a clean
document are clean; a toxic document first stands for all its passages, and after ``WARM`` rounds
only for the one that scores highest, as most of what it says may be harmless.

Training sees at most ``TRAIN_ROWS`` labelled documents of each label, taken by a hash of their ids and
never those that are held out; of a text of more than ``TRAIN_CHARS`` characters it sees ``STRETCHES``
evenly spread stretches with as many characters in all. The model is the same size whatever the input. Scoring reads every text whole, in one pass
without a shuffle, and keeps the scores of known words in a table of bounded size. Scores depend on
the text alone.

Defined results: a null or empty text has the score of a passage without words; a null id is not
held out; labels other than 0 and 1, labels of unknown documents and contradicting labels (they
count as toxic) do no harm; where training has no rows of one of the labels, every score is the
share of toxic ones, 0 without any, and likewise where no labelled text has a word; an empty table gives
an empty result; repeated rows each give a row; further columns are not read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.llm.common import slices

TRAIN_ROWS, TRAIN_CHARS, STRETCHES, PART_BYTES = 2000, 20_000, 20, 4_000_000
PASSAGE, GRAMS, BUCKETS, SIZE = 32, (3, 4, 5), 1 << 15, 8
ROUNDS, WARM, BATCH, RATE, STEPS = 6, 1, 256, 0.5, 400
TOXIC_FROM, KNOWN_WORDS = 0.3, 250_000

words_of = re.compile(r"[^\W_]+").findall


def grams(word: str) -> list[int]:
    """Buckets of a word's n-grams and of the word itself."""
    marked = f"<{word}>"
    parts = [marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)]
    return [zlib.crc32(p.encode()) % BUCKETS for p in (marked, *parts)]


class Model:
    """Vectors of n-grams (``vectors``), and the softmax (``weights``, ``bias``)."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.vectors, self.weights, self.bias = vectors, weights, bias

    @classmethod
    def constant(cls, share: float) -> Model:
        share = min(max(share, 1e-9), 1 - 1e-9)
        return cls(np.zeros((BUCKETS, SIZE), np.float32), np.zeros((SIZE, 2)), np.log([1 - share, share]))

    @classmethod
    def train(cls, texts: list[str], toxic: list[int], seed: int = 7) -> Model:
        toxic = np.array(toxic, np.int64)
        if len(set(toxic.tolist())) < 2:
            return cls.constant(float(toxic.mean()) if len(toxic) else 0.0)
        split = [words_of(t.lower()) for t in texts]
        if not any(split):
            return cls.constant(float(toxic.mean()))
        names = sorted(set().union(*split))
        number = {w: k for k, w in enumerate(names)}
        of_word = [np.array(grams(w)) for w in names]
        passages = [sorted({number[w] for w in ws[i : i + PASSAGE]}) for ws in split for i in range(0, len(ws), PASSAGE)]
        owner = np.repeat(np.arange(len(split)), [-(-len(ws) // PASSAGE) for ws in split])
        random = np.random.default_rng(seed)
        model = cls((random.random((BUCKETS, SIZE), np.float32) - 0.5) / SIZE, (random.random((SIZE, 2)) - 0.5), np.zeros(2))
        # A passage as n-grams with weights: an average over words of averages over n-grams.
        sizes = np.array([len(g) for g in of_word])
        flat = np.concatenate(of_word)
        first = np.cumsum(sizes) - sizes
        heat = np.full(BUCKETS, 1e-8)
        rounds = max(ROUNDS, -(-STEPS * BATCH // len(passages)))  # small samples take more rounds
        for turn in range(rounds):
            chosen = np.arange(len(passages))
            if turn >= WARM * rounds // ROUNDS:
                score = model._scores_of(passages, flat, first, sizes)
                order = np.lexsort((-score, owner))
                top = order[np.diff(owner[order], prepend=-1) > 0]
                clean = chosen[toxic[owner] == 0]
                chosen = np.concatenate([clean, top[toxic[owner[top]] == 1]])
            random.shuffle(chosen)
            share = max(1.0, float((toxic[owner[chosen]] == 0).sum()) / max(1, int((toxic[owner[chosen]] == 1).sum())))
            for start in range(0, len(chosen), BATCH):
                part = chosen[start : start + BATCH]
                # The rarer label weighs more, by the root of how much rarer it is.
                weight = np.where(toxic[owner[part]] == 1, share**0.5, 1.0)
                model._step([passages[k] for k in part], toxic[owner[part]], weight, flat, first, sizes, heat)
        return model

    @staticmethod
    def _entries(passages, flat, first, sizes):
        words = np.concatenate([np.array(p) for p in passages])
        count = np.array([len(p) for p in passages])
        row = np.repeat(np.arange(len(passages)), count)
        n = sizes[words]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        weight = 1.0 / np.repeat(n * PASSAGE, n)
        return flat[np.repeat(first[words], n) + inside], np.repeat(row, n), weight

    def _scores_of(self, passages, flat, first, sizes) -> np.ndarray:
        of_gram = self.gram_scores()
        scores = []
        for start in range(0, len(passages), 4096):
            gram, row, weight = self._entries(passages[start : start + 4096], flat, first, sizes)
            scores.append(np.bincount(row, of_gram[gram] * weight, len(passages[start : start + 4096])))
        return np.concatenate(scores)

    def _step(self, passages, toxic, weight, flat, first, sizes, heat) -> None:
        """One step down the gradient of the weighted log loss, with a rate by n-gram (Adagrad)."""
        gram, row, share = self._entries(passages, flat, first, sizes)
        used, place = np.unique(gram, return_inverse=True)
        vectors = self.vectors[used].astype(np.float64)
        mean = np.stack([np.bincount(row, vectors[place, k] * share, len(passages)) for k in range(SIZE)], axis=1)
        logit = mean @ self.weights + self.bias
        chance = np.exp(logit - logit.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        chance[np.arange(len(toxic)), toxic] -= 1
        error = chance * weight[:, None] / len(toxic)
        back = (error @ self.weights.T) * len(toxic)
        down = np.stack([np.bincount(place, back[row, k] * share, len(used)) for k in range(SIZE)], axis=1)
        self.weights -= RATE * (mean.T @ error)
        self.bias -= RATE * error.sum(axis=0)
        heat[used] += (down**2).mean(axis=1)
        self.vectors[used] -= (RATE * down / np.sqrt(heat[used])[:, None]).astype(np.float32)

    def gram_scores(self) -> np.ndarray:
        """By n-gram, how far it moves the log odds of toxic."""
        return self.vectors @ (self.weights[:, 1] - self.weights[:, 0])

    @property
    def start(self) -> float:
        return float(self.bias[1] - self.bias[0])


class Scorer(dict):
    """Scores of words, worked out when first asked for."""

    def __init__(self, model: Model):
        super().__init__()
        self.of_gram, self.start = model.gram_scores(), model.start

    def __missing__(self, word: str) -> float:
        score = self[word] = float(self.of_gram[grams(word)].mean())
        return score

    def scores(self, texts: list[str]) -> np.ndarray:
        if len(self) > KNOWN_WORDS:
            self.clear()
        found = np.empty(len(texts))
        for k, text in enumerate(texts):
            words = words_of(text.lower())
            parts = (set(words[i : i + PASSAGE]) for i in range(0, len(words), PASSAGE))
            found[k] = max((sum(map(self.__getitem__, part)) for part in parts), default=0.0) / PASSAGE + self.start
        return 1 / (1 + np.exp(-np.clip(found, -500, 500)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _bounded(text: Column) -> Column:
    """A text of at most TRAIN_CHARS characters, or stretches of it that come to as many."""
    size = TRAIN_CHARS // STRETCHES
    begins = F.transform(F.sequence(F.lit(0), F.lit(STRETCHES - 1)), lambda k: F.floor(k * (F.length(text) - size) / (STRETCHES - 1)).cast("int") + 1)
    spread = F.array_join(F.transform(begins, lambda begin: F.substr(text, begin, F.lit(size))), " ")
    return F.when(F.length(text) > TRAIN_CHARS, spread).otherwise(text)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Trains on at most ``rows`` documents of each label that are not held out."""
    labels = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    labels = labels.groupBy(F.col("doc_id").alias("labelled_id")).agg(F.max("toxic").alias("label"))
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    order = [F.xxhash64("labelled_id"), "labelled_id"]
    sample = []
    for label in (0, 1):
        ids = labels.filter(F.col("label") == label).orderBy(*order).limit(rows)
        # Not more ids than ``rows``: broadcast, and a document may repeat.
        found = texts.join(F.broadcast(ids), F.col("doc_id") == F.col("labelled_id"))
        found = found.select("doc_id", _bounded(F.col("text")).alias("text"), "label")
        sample += found.limit(rows).collect()
    sample.sort(key=lambda r: (str(r["doc_id"]), r["text"]))
    return Model.train([r["text"] for r in sample], [int(r["label"]) for r in sample])


_ready: dict[str, Scorer] = {}


def with_score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with one more column, ``_toxic_score``."""
    sent, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _ready:
            _ready.clear()
            _ready[key] = Scorer(sent.value)
        scorer = _ready[key]  # a worker's next task goes on with the words it knows
        for whole in batches:
            for batch in slices(whole, "text", PART_BYTES):
                texts = batch.column(batch.schema.names.index("text")).to_pylist()
                score = pa.array(scorer.scores([t or "" for t in texts]), pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.columns, score], [*batch.schema.names, "_toxic_score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_toxic_score", T.DoubleType())]))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each document."""
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_toxic_score").alias("score"),
        (F.col("_toxic_score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    return with_score(docs, fit(docs, labels)).filter(F.col("_toxic_score") < TOXIC_FROM).select(*docs.columns)
