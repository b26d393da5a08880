"""Quality: attention-based multiple-instance learning over passages.

A text is a bag of passages of ``PASSAGE`` words. Each passage is encoded by shares of byte classes
and of single ASCII marks, hashed byte pairs inside words, word lengths and repetition (words that
occurred earlier in the passage or in the text). Gated attention weighs the passages,

    a = softmax(w . (tanh(V h) * sigmoid(U h))),    score = sigmoid(c . sum(a h) + b),

and is learnt from the labels of whole texts, by Adam on the driver. The sample is bounded twice: by
``SAMPLE`` labelled texts outside the held-out fold, and by ``SAMPLE_BYTES`` of their encoded passages,
taken in the order of their hashes (a text that alone has more is left out). Training and scoring use
all passages of each text. Spark encodes the sampled texts and stores their bags; the driver reads
those within the bound, and a step's gradient is a sum over texts, ``CHUNK`` passages at once or one text.

Rows: null and empty texts are bags of one empty passage; repeated rows score alike; without
training texts of both labels the score is the smoothed share of label 1; an empty table gives an
empty result. Only ids and texts are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import remove_path, scratch_path
from .labels import Adam, label_slices, score_texts, sigmoid, training_texts, within
from .words import NOT_SPACE, Slice, split

FOLDS, HELD_OUT = 4, 2
SAMPLE = 6_000  # labelled texts
SAMPLE_BYTES = 128 << 20  # of their passages' features: 400 bytes a passage, about 300,000 of them
CHUNK = 8_192  # passages of a training step held at once, or those of one text
PASSAGE = 64  # words
PAIRS = 64  # buckets of byte pairs
HIDDEN = 16
EPOCHS, BATCH, RATE, DECAY = 60, 128, 0.01, 1e-4

# Byte classes: each ASCII mark on its own, then digits, upper case, lower case, other bytes.
_MARKS = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
_CLASS = np.full(256, len(_MARKS) + 3, np.int64)
_CLASS[_MARKS] = np.arange(len(_MARKS))
_CLASS[0x30:0x3A], _CLASS[0x41:0x5B], _CLASS[0x61:0x7B] = (len(_MARKS) + i for i in range(3))
CLASSES = len(_MARKS) + 4
WIDTH = CLASSES + PAIRS + 6
BAGS = "key bigint, size bigint, bag binary, label int"


def encode(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Each passage's features, and each text's first passage (one more at the end)."""
    w = split(s, NOT_SPACE)
    bags = np.maximum(1, -(-w.count // PASSAGE))
    first = np.concatenate(([0], np.cumsum(bags)))
    n = int(first[-1])
    inside = np.arange(len(w.row)) - w.first[:-1][w.row]
    passage = first[:-1][w.row] + inside // PASSAGE
    length = w.end - w.start
    at = np.repeat(w.start - (np.cumsum(length) - length), length) + np.arange(length.sum())
    owner, data = np.repeat(passage, length), s.data[at]
    size = np.maximum(1, np.bincount(owner, minlength=n))[:, None]
    count = np.bincount(passage, minlength=n)
    words = np.maximum(1, count)
    classes = np.bincount(owner * CLASSES + _CLASS[data], minlength=n * CLASSES).reshape(n, CLASSES) / size
    follows = np.flatnonzero((at[1:] == at[:-1] + 1) & (owner[1:] == owner[:-1]))
    pair = (data[follows].astype(np.int64) * 31 + data[follows + 1] * 131) * 2654435761 % (1 << 32) >> 26
    pairs = np.bincount(owner[follows] * PAIRS + pair, minlength=n * PAIRS).reshape(n, PAIRS) / size
    mean = np.bincount(passage, length, n) / words
    wide = np.sqrt(np.maximum(0, np.bincount(passage, length.astype(float) ** 2, n) / words - mean ** 2))
    again = lambda group: np.bincount(passage[_seen(group, w.hash)], minlength=n) / words
    more = np.stack([np.log1p(mean), np.log1p(wide), again(passage), again(w.row), np.log1p(count),
                     np.log1p(np.repeat(w.count, bags))], 1)
    return np.round(np.concatenate((np.sqrt(classes), np.sqrt(pairs), more), 1), 5).astype(np.float32), first


def _seen(group: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Indices of words that their group holds earlier."""
    order = np.lexsort((np.arange(len(group)), hashes, group))
    same = (group[order][1:] == group[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    return order[1:][same]


@dataclass
class Attention:
    centre: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, h: np.ndarray, first: np.ndarray):
        """Gate parts, attention of each passage, each bag's representation and score."""
        t, g = np.tanh(h @ self.p["V"]), sigmoid(h @ self.p["U"])
        e = (t * g) @ self.p["w"]
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        a = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
        a /= np.add.reduceat(a, first[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, first[:-1], 0)
        return t, g, a, bag, z, sigmoid(z @ self.p["c"] + self.p["b"])

    def score(self, s: Slice) -> np.ndarray:
        h, first = encode(s)
        return self.forward((h - self.centre) / self.scale, first)[-1]


def _bags(sample: DataFrame) -> DataFrame:
    """key (a hash of the text), size in bytes, bag (all passages) and label of each sampled text."""

    def run(batches):
        for batch in batches:
            for s, y in label_slices(batch):
                h, first = encode(s)
                bags = [h[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(s.lo, s.rows), pa.array([len(b) for b in bags], pa.int64()),
                     pa.array(bags, pa.binary()), pa.array(y.astype(np.int32))], ["key", "size", "bag", "label"])

    return sample.select("text", "label", F.xxhash64("text").alias("key")).mapInArrow(run, BAGS)


class Bags:
    """The sampled texts' passages; labels ``y`` and numbers of passages ``n``, in an order of the
    texts' own."""

    def __init__(self, rows: pa.Table):
        bags, labels = rows.column("bag").to_pylist(), rows.column("label").to_pylist()
        order = sorted(range(len(bags)), key=lambda i: (bags[i][:WIDTH * 4], sha256(bags[i]).digest(), labels[i]))
        self.bags = [np.frombuffer(bags[i], np.float32).reshape(-1, WIDTH) for i in order]
        self.y = np.array([labels[i] for i in order], np.float32)
        self.n = np.array([len(b) for b in self.bags], np.int64)

    def chunks(self, part):
        """Texts of ``part`` in groups of ``CHUNK`` passages at most, or one text, and their passages."""
        lo = 0
        while lo < len(part):
            sizes = np.cumsum(self.n[part[lo:]])
            hi = lo + max(1, int(np.searchsorted(sizes, CHUNK, "right")))
            yield part[lo:hi], np.concatenate([self.bags[i] for i in part[lo:hi]])
            lo = hi

    def spread(self) -> tuple[np.ndarray, np.ndarray]:
        """Mean and standard deviation of each feature over all passages."""
        every = np.arange(len(self.n))
        mean = sum(h.sum(0, np.float64) for _, h in self.chunks(every)) / self.n.sum()
        return mean, np.sqrt(sum(((h - mean) ** 2).sum(0) for _, h in self.chunks(every)) / self.n.sum())


def fit(sample: DataFrame) -> Attention:
    """The model of a sample (text, label)."""
    path = scratch_path(sample.sparkSession, "quality-bags")
    _bags(sample).write.parquet(path)
    stored = sample.sparkSession.read.schema(BAGS).parquet(path)
    try:
        return _learn(Bags(within(stored, SAMPLE_BYTES).select("bag", "label").toArrow()))
    finally:
        remove_path(sample.sparkSession, path)


def _learn(bags: Bags) -> Attention:
    y = bags.y
    random = np.random.default_rng(11)
    p = {"V": random.normal(0, 0.1, (WIDTH, HIDDEN)),
         "U": random.normal(0, 0.1, (WIDTH, HIDDEN)),
         "w": random.normal(0, 0.1, HIDDEN), "c": np.zeros(WIDTH),
         "b": np.array([np.log((y.sum() + 1) / (len(y) - y.sum() + 1))])}
    if not 0 < y.sum() < len(y):
        return Attention(np.zeros(WIDTH), np.ones(WIDTH), p)
    centre, scale = bags.spread()
    model = Attention(centre, scale + 0.01, p)
    adam = Adam(p, RATE)
    for _ in range(EPOCHS):
        order = random.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            part = order[lo:lo + BATCH]
            step = {k: DECAY * p[k] if k in "cVU" else np.zeros_like(p[k]) for k in p}
            for texts, h in bags.chunks(part):
                for k, g in _gradient(model, h, bags.n[texts], y[texts], len(part)).items():
                    step[k] += g
            adam.step(step)
    return model


def _gradient(model: Attention, h: np.ndarray, n: np.ndarray, y: np.ndarray, total: int) -> dict[str, np.ndarray]:
    """The part that whole texts of ``n`` passages have in a step of ``total`` texts."""
    p = model.p
    h = (h - model.centre) / model.scale
    first = np.concatenate(([0], np.cumsum(n)))
    t, g, a, bag, z, out = model.forward(h, first)
    e = (out - y) / total
    da = (h @ p["c"]) * e[bag]
    de = a * (da - np.add.reduceat(a * da, first[:-1])[bag])
    dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
    return {"b": e.sum(keepdims=True), "c": z.T @ e, "w": (t * g).T @ de, "V": h.T @ dt, "U": h.T @ dg}


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``; learnt from their labels."""
    sample = training_texts(docs, labels, "quality", FOLDS, HELD_OUT, SAMPLE)
    model = docs.sparkSession.sparkContext.broadcast(fit(sample))
    return score_texts(docs, lambda s: model.value.score(s), FOLDS, HELD_OUT, lower=False)
