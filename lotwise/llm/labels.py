"""What the classifiers share: a bounded sample of labelled texts, and scores of whole tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .rows import quoted
from .words import SMALL_SLICE, Slice, text_slices

SCORES = "doc_id bigint, held_out boolean, score double, predicted int"
THRESHOLD = 0.7


def held_out(doc_id, folds: int, fold: int):
    """Whether crc32 of the id as text falls into the held-out fold; a null id does not."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(folds)) == fold, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, limit: int) -> DataFrame:
    """(text, label) of at most ``limit`` labelled documents outside the held-out fold, by the hash
    of their ids, stored: one text per id, the one of the least hash. An id labelled twice counts as 1
    if any of its labels is; null labels count as none. The list of sampled ids is broadcast; ``limit``
    bounds it."""
    chosen = (labels.select(F.col("doc_id").alias("sampled"), quoted(label).cast("int").alias("label"))
              .where(~held_out(F.col("sampled"), folds, fold) & F.col("sampled").isNotNull() & F.col("label").isNotNull())
              .groupBy("sampled").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("sampled"), "sampled").limit(limit))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("sampled"))
    one = rows.groupBy("sampled").agg(F.min_by(F.struct("text", "label"), F.xxhash64("text")).alias("row"))
    return materialize(one.select("row.text", "row.label"), f"labelled-{label}")


def within(stored: DataFrame, limit: int) -> DataFrame:
    """The rows (key, size, ..) that fit into ``limit`` bytes together, in the order of their keys."""
    fits = stored.where(F.col("size") <= limit)
    sizes = fits.select("key", "size").toArrow()  # as many rows as the sample has
    order = np.argsort(sizes.column("key").to_numpy())
    key, total = sizes.column("key").to_numpy()[order], np.cumsum(sizes.column("size").to_numpy()[order])
    if not len(key) or total[-1] <= limit:
        return fits
    cut = int(np.searchsorted(total, limit, "right"))  # the first that doesn't fit; equal keys stay out with it
    return fits.where(F.col("key") < int(key[cut]))


def label_slices(batch: pa.RecordBatch, **how):
    """Slices of the texts (column 0) with their labels (column 1)."""
    labels = batch.column(1).to_numpy(zero_copy_only=False)
    for s in text_slices(batch.column(0), limit=SMALL_SLICE, **how):
        yield s, labels[s.lo:s.hi]


def score_texts(docs: DataFrame, score: Callable[[Slice], np.ndarray], folds: int, fold: int,
                lower: bool) -> DataFrame:
    """``SCORES`` of every row; ``score`` maps a slice of texts to numbers from 0 to 1."""

    def run(batches):
        for batch in batches:
            for s in text_slices(batch.column(1), lower=lower, limit=SMALL_SLICE):
                p = np.clip(np.round(score(s).astype(np.float64), 6), 0.0, 1.0)  # whatever the slice
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.lo, s.rows), batch.column(2).slice(s.lo, s.rows), pa.array(p),
                     pa.array((p >= THRESHOLD).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"])

    ids = F.col("doc_id").cast("bigint")
    return docs.select(ids.alias("doc_id"), F.col("text").cast("string").alias("text"),
                       held_out(ids, folds, fold).alias("held_out")).mapInArrow(run, SCORES)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Adam:
    """Steps of Adam over named arrays, in place."""

    def __init__(self, parameters: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = parameters, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.v = {k: np.zeros_like(v) for k, v in parameters.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in gradients.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            rate = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
            self.p[k] -= rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)
