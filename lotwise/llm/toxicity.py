"""Toxicity: a factorization machine over hashed terms.

Terms are the 64-bit hashes of a text's lower-cased words and of their first 4, 5 and 6 bytes (a
word's stem, whatever follows it), each once per text. A machine has a bias, a weight and ``RANK`` factors
per term, so pairs of terms that are harmless apart can weigh together. It has two layers:

* telling terms: Spark counts every term's clean and toxic texts over the whole training sample and
  ranks all terms of ``LEAST`` toxic texts or more by the log-likelihood ratio; the ``TERMS`` that tell
  most (``SURE`` at least) are kept;
* all terms, whatever they tell alone, hashed into 2**``SLOT_BITS`` slots, learnt on what the first layer
  leaves. This one finds pairs whose parts tell nothing. With some hundred toxic texts and some hundred
  thousand slots it can as well learn chance, so it is first learnt on three quarters of the sample and
  kept only if it lowers the loss of the last quarter by ``GAIN``.

Both are fitted by Adam on the driver: the first on at most ``SAMPLE`` labelled texts outside the held-out
fold, over a matrix of SAMPLE x TERMS bytes, of which a batch at a time is made numbers; the second on those of them whose slots fit into
``SLOT_BYTES``, in the order of their hashes. Scoring is a map over whole texts.

Rows: null and empty texts score as texts of no terms; repeated rows score alike; without a term
that tells toxic training texts, and without pairs that do, every score is 0; an empty table gives an empty result. Only ids and texts are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import dematerialize, materialize
from .labels import THRESHOLD, Adam, label_slices, score_texts, sigmoid, training_texts, within
from .rows import as_rows, map_rows, text_field
from .words import LETTERS_DIGITS, SMALL_SLICE, Slice, mix64, prefix_hashes, split, text_slices

FOLDS, HELD_OUT = 3, 1
SAMPLE = 10_000  # labelled texts
TERMS = 2_048
RANK = 8
STEMS = (4, 5, 6)  # bytes
EPOCHS, BATCH, RATE, DECAY = 30, 256, 0.02, 1e-4
SURE = 10.83  # least log-likelihood ratio of a term: chance alone gives it once in 1,000
LEAST = 2  # toxic training texts with a term; sampled texts with a slot
SLOT_BITS = 18
SLOT_BYTES = 24 << 20  # of the texts that the second layer learns from
STEPS = 240  # of the second layer
GAIN = 0.1  # share of the loss that it must take off

ROWS = "key bigint, size bigint, has binary, slots binary, label int"


def _terms(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, term) pairs of a slice."""
    w = split(s, LETTERS_DIGITS)
    long = [(w.end - w.start) > k for k in STEMS]
    rows = np.concatenate([w.row, *[w.row[m] for m in long]])
    hashes = np.concatenate([w.hash, *[mix64(prefix_hashes(s, w, k)[m] + np.uint64(k)) for k, m in zip(STEMS, long)]])
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def _known(s: Slice, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the pairs whose term is one of ``terms`` (sorted)."""
    rows, hashes = _terms(s)
    if not len(terms):
        return rows[:0], rows[:0]
    place = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    hit = terms[place] == hashes
    return rows[hit], place[hit]


def _slots(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, slot) pairs of a slice."""
    rows, hashes = _terms(s)
    pairs = np.unique(rows << SLOT_BITS | (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64))
    return pairs >> SLOT_BITS, pairs & (1 << SLOT_BITS) - 1


def _sums(rows: np.ndarray, at: np.ndarray, n: int, weight: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Linear and pair terms of each row, from its (row, place) pairs."""
    total = np.zeros(n) + np.bincount(rows, weight[at], n)
    for f in factors.T:
        one = np.bincount(rows, f[at], n)
        total += (one * one - np.bincount(rows, f[at] ** 2, n)) / 2
    return total


@dataclass
class Machine:
    """terms (sorted hashes), bias, weight and factors of each; the same of all slots, or None."""

    terms: np.ndarray
    bias: float
    weight: np.ndarray
    factors: np.ndarray
    slots: tuple[np.ndarray, np.ndarray] | None = None

    def score(self, s: Slice) -> np.ndarray:
        if not len(self.terms) and self.slots is None:
            return np.zeros(s.rows)
        total = self.bias + _sums(*_known(s, self.terms), s.rows, self.weight, self.factors)
        if self.slots is not None:
            total += _sums(*_slots(s), s.rows, *self.slots)
        return sigmoid(total)


def _term_counts(sample: DataFrame) -> DataFrame:
    """(term, clean, toxic): in how many clean and toxic texts each term of the sample is."""

    def run(batches):
        for batch in batches:
            for s, y in label_slices(batch, lower=True):
                rows, hashes = _terms(s)
                got, place = np.unique(hashes, return_inverse=True)
                toxic = np.bincount(place[y[rows] == 1], minlength=len(got))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got.view(np.int64)), pa.array(np.bincount(place, minlength=len(got)) - toxic), pa.array(toxic)],
                    ["term", "clean", "toxic"])

    return (sample.mapInArrow(run, "term bigint, clean bigint, toxic bigint").groupBy("term")
            .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))


def _telling(sample: DataFrame) -> np.ndarray:
    """The ``TERMS`` that tell toxic texts best, by the log-likelihood ratio."""
    toxic = (F.col("label") == 1).cast("bigint")
    n_clean, n_toxic = sample.agg(F.coalesce(F.sum(1 - toxic), F.lit(0)), F.coalesce(F.sum(toxic), F.lit(0))).first()
    total = float(n_clean + n_toxic)
    with_term = F.col("clean") + F.col("toxic")

    def share(count, of_term, of_label):
        return F.when(count > 0, count * F.log(count * total / (of_term * float(of_label)))).otherwise(0.0)

    ratio = 2 * sum((share(F.col("clean"), with_term, n_clean), share(F.col("toxic"), with_term, n_toxic),
                     share(n_clean - F.col("clean"), total - with_term, n_clean),
                     share(n_toxic - F.col("toxic"), total - with_term, n_toxic)), F.lit(0.0))
    got = (_term_counts(sample).where(F.col("toxic") >= LEAST).withColumn("ratio", F.round(ratio, 6))
           .where(F.col("ratio") >= SURE).orderBy(F.desc("ratio"), "term").limit(TERMS).select("term").toArrow())
    return np.sort(got.column("term").to_numpy().view(np.uint64))


@dataclass
class Sample:
    """Texts in an order of their own: which telling terms each has, and its label; the rows whose
    slots are held, and these."""

    has: np.ndarray
    y: np.ndarray
    rows: np.ndarray
    slots: list[np.ndarray]


def _collect(sample: DataFrame, terms: np.ndarray) -> Sample:
    def run(batches):
        for batch in batches:
            for s, y in label_slices(batch, lower=True):
                has = np.zeros((s.rows, len(terms)), bool)
                has[_known(s, terms)] = True
                rows, slots = _slots(s)
                cut = np.searchsorted(rows, np.arange(s.rows + 1))
                lists = [slots[a:b].astype("<u4").tobytes() for a, b in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(s.lo, s.rows), pa.array([len(x) for x in lists], pa.int64()),
                     pa.array([r.tobytes() for r in np.packbits(has, axis=1)], pa.binary()), pa.array(lists, pa.binary()),
                     pa.array(y.astype(np.int32))], ["key", "size", "has", "slots", "label"])

    stored = materialize(sample.select("text", "label", F.xxhash64("text").alias("key")).mapInArrow(run, ROWS), "toxicity-rows")
    texts = stored.select("key", "has", "label").toArrow()
    held = within(stored, SLOT_BYTES).select("key", "slots", "label").toArrow()
    dematerialize(stored)
    # Texts of one key are the same text: ordered by key and label, both tables have one order.
    order = np.lexsort((texts.column("label").to_numpy(), texts.column("key").to_numpy()))
    own = np.lexsort((held.column("label").to_numpy(), held.column("key").to_numpy()))
    key = texts.column("key").to_numpy()[order]
    has, slots = texts.column("has").combine_chunks(), held.column("slots").combine_chunks()
    bits = np.zeros((len(order), len(terms)), np.uint8)
    for i, row in enumerate(order.tolist()):
        bits[i] = np.unpackbits(np.frombuffer(has[row].as_buffer(), np.uint8))[:len(terms)]
    return Sample(bits, texts.column("label").to_numpy()[order].astype(np.float32),
                  np.flatnonzero(np.isin(key, held.column("key").to_numpy())),
                  [np.frombuffer(slots[row].as_buffer(), "<u4") for row in own.tolist()])


def _learn_terms(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Bias b, weights w and factors v of the telling terms (``x``: which text has which)."""
    random = np.random.default_rng(7)
    p = {"b": np.array([np.log((y.sum() + 1) / (len(y) - y.sum() + 1))], np.float32),
         "w": np.zeros(x.shape[1], np.float32),
         "v": random.normal(0, 0.01, (x.shape[1], RANK)).astype(np.float32)}
    adam = Adam(p, RATE)
    for _ in range(EPOCHS if x.shape[1] else 0):
        order = random.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            part = order[lo:lo + BATCH]
            xb = x[part].astype(np.float32)
            out, xv = _terms_out(p, xb)
            e = (sigmoid(out) - y[part]) / len(part)
            adam.step({"b": e.sum(keepdims=True), "w": xb.T @ e + DECAY * p["w"],
                       "v": xb.T @ (e[:, None] * xv) - (xb.T @ e)[:, None] * p["v"] + DECAY * p["v"]})
    return p


def _terms_out(p: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    xv = x @ p["v"]
    return p["b"] + x @ p["w"] + ((xv * xv).sum(1) - (x @ (p["v"] ** 2)).sum(1)) / 2, xv


def _terms_say(p: dict[str, np.ndarray], has: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """What the first layer says of the given texts, some at a time: all of them as numbers would cost the
    driver four times the matrix."""
    parts = [_terms_out(p, has[rows[lo:lo + BATCH]].astype(np.float32))[0] for lo in range(0, len(rows), BATCH)]
    return np.concatenate([np.zeros(0, np.float32), *parts])


def _learn_slots(slots: list[np.ndarray], offset: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and factors of all slots (0 for those in fewer than ``LEAST`` texts), given what the
    other layer says of each text."""
    size = np.array([len(x) for x in slots], np.int64)
    flat = np.concatenate([np.zeros(0, np.uint32), *slots])
    held = np.bincount(flat, minlength=1 << SLOT_BITS) >= LEAST
    number, m = (np.cumsum(held) - 1).astype(np.int32), int(held.sum())
    keep = held[flat]
    flat = number[flat[keep]]
    size = np.bincount(np.repeat(np.arange(len(y), dtype=np.int32), size)[keep], minlength=len(y))
    first = np.cumsum(size) - size
    random = np.random.default_rng(13)
    p = {"w": np.zeros(m, np.float32), "v": random.normal(0, 0.01, (m, RANK)).astype(np.float32)}
    adam, order = Adam(p, RATE), np.zeros(0, np.int64)
    for _ in range(STEPS if m else 0):
        if len(order) < min(BATCH, len(y)):
            order = random.permutation(len(y))
        part, order = order[:BATCH], order[BATCH:]
        n = size[part]
        at = flat[np.repeat(first[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        row, v = np.repeat(np.arange(len(part)), n), p["v"][at]
        total = np.stack([np.bincount(row, v[:, k], len(part)) for k in range(RANK)], 1)
        pairs = ((total * total).sum(1) - np.bincount(row, (v * v).sum(1), len(part))) / 2
        e = (sigmoid(offset[part] + np.bincount(row, p["w"][at], len(part)) + pairs) - y[part]) / len(part)
        pull = e[row][:, None] * (total[row] - v)
        adam.step({"w": np.bincount(at, e[row], m) + DECAY * p["w"],
                   "v": np.stack([np.bincount(at, pull[:, k], m) for k in range(RANK)], 1) + DECAY * p["v"]})
    weight, factors = np.zeros(1 << SLOT_BITS, np.float32), np.zeros((1 << SLOT_BITS, RANK), np.float32)
    weight[held], factors[held] = p["w"], p["v"]
    return weight, factors


def _slots_out(layer: tuple[np.ndarray, np.ndarray], slots: list[np.ndarray]) -> np.ndarray:
    return np.array([_sums(np.zeros(len(x), np.int64), x, 1, *layer)[0] for x in slots])


def _loss(out: np.ndarray, y: np.ndarray) -> float:
    p = sigmoid(out.astype(np.float64))
    return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))


def _pairs_help(sample: Sample) -> bool:
    """Whether the second layer, learnt on three quarters of the texts, lowers the loss of the others."""
    order = np.random.default_rng(17).permutation(len(sample.rows))
    test, learn = order[:len(order) // 4], order[len(order) // 4:]
    y = sample.y[sample.rows]
    if not all(0 < y[part].sum() < len(part) for part in (learn, test)):
        return False
    mine = np.ones(len(sample.y), bool)
    mine[sample.rows[test]] = False
    p = _learn_terms(sample.has[mine], sample.y[mine])
    out = _terms_say(p, sample.has, sample.rows)
    layer = _learn_slots([sample.slots[i] for i in learn], out[learn], y[learn])
    more = _slots_out(layer, [sample.slots[i] for i in test])
    return _loss(out[test] + more, y[test]) < (1 - GAIN) * _loss(out[test], y[test])


def fit(sample: DataFrame) -> Machine:
    """The machine of a sample (text, label)."""
    terms = _telling(sample)
    texts = _collect(sample, terms)
    pairs = _pairs_help(texts)
    if not len(terms) and not pairs:
        return Machine(np.zeros(0, np.uint64), 0.0, np.zeros(0), np.zeros((0, RANK)))
    p = _learn_terms(texts.has, texts.y)
    layer = _learn_slots(texts.slots, _terms_say(p, texts.has, texts.rows), texts.y[texts.rows]) if pairs else None
    return Machine(terms, float(p["b"][0]), p["w"].astype(float), p["v"].astype(float), layer)


def _machine(training: DataFrame, labels: DataFrame):
    sample = training_texts(training, labels, "toxic", FOLDS, HELD_OUT, SAMPLE)
    return training.sparkSession.sparkContext.broadcast(fit(sample))


def keep_clean(docs: DataFrame, labels: DataFrame, training: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    machine = _machine(training, labels)

    def work(batch: pa.RecordBatch):
        for s in text_slices(text_field(batch, "text"), lower=True, limit=SMALL_SLICE):
            yield s.lo, s.hi, [pa.array(machine.value.score(s) >= THRESHOLD)]

    return map_rows(as_rows(docs), "toxic boolean", work).where("NOT toxic").select("row.*")


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``; learnt from their labels."""
    machine = _machine(docs, labels)
    return score_texts(docs, lambda s: machine.value.score(s), FOLDS, HELD_OUT, lower=True)
