"""Document fingerprints: prefix polynomial hashes over code points.

``Prefix`` holds a text's prefix array of the polynomial hash modulo 2**64 over scattered code-point
values; any span's hash, and so any equality of spans, is a subtraction and a product, and the
longest common extension of two places is a binary search. A fingerprint is read off that array: the
length, the hash of the whole text; the hashes of its beginnings and of its ends, at the multiples of a
power of two (at most ``MARKS`` of each, ``SLOT_BITS`` bits); and a sketch: the hashes of all spans of
``SPAN`` code points (the whole text, if shorter) fall into ``SLOTS`` ranges, and each range keeps
``SLOT_BITS`` of its least.

Two fingerprints answer what their texts' arrays would: beginnings of one length are equal or not, so
the longest common one is found by binary search over the marks that both have, and so is the longest
common end. The likeness is the share of the longer text that these cover; texts whose common parts lie
at other places are as alike as the share of equal slots among those that either has filled, if that is
more. Equal texts have equal fingerprints and likeness 1.

``with_edits`` needs each document's successor in descending order of ids, across all tasks. Ids are
cut into blocks at percentiles (a fixed number of bounds), each block's greatest row is copied to
the block above it, and a block is streamed in order while one text is held. Texts are shuffled
once; what the driver gets is a row per block.

Rows: null text is empty; rows without an id come last; rows of one id follow one another by text;
the only document follows itself; two empty texts are alike (1); an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import BASE_WORD, GOLDEN, _powers, mix64

SPAN = 24  # code points
SLOTS = 64
SLOT_BITS = 32
MARKS = 64  # beginnings, and ends, of a text
EMPTY_SLOT = np.uint64((1 << SLOT_BITS) - 1)
NO_ID = -(2 ** 63)
EDIT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")


class Prefix:
    """Prefix hashes of a text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        self.n = len(codes)
        values = mix64((codes + np.uint64(1)) * np.uint64(GOLDEN))
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(values * _powers(BASE_WORD, self.n), out=self.sums[1:])
        self.back = _powers(pow(BASE_WORD, -1, 1 << 64), self.n + 1)

    def spans(self, start, stop):
        """Hashes of spans start:stop."""
        start, stop = np.atleast_1d(start), np.atleast_1d(stop)
        return mix64((self.sums[stop] - self.sums[start]) * self.back[start] + (stop - start).astype(np.uint64))

    def equal(self, a: int, b: int, length: int, other: Prefix | None = None) -> bool:
        """Whether ``length`` code points from ``a`` on equal those from ``b`` on (of ``other``)."""
        other = other or self
        if a + length > self.n or b + length > other.n:
            return False
        return bool((self.spans(a, a + length) == other.spans(b, b + length))[0])

    def extension(self, a: int, b: int, other: Prefix | None = None) -> int:
        """The longest common extension from ``a`` and ``b`` on."""
        other = other or self
        low, high = 0, min(self.n - a, other.n - b)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(a, b, middle, other) else (low, middle - 1)
        return low

    def sketch(self) -> np.ndarray:
        slots = np.full(SLOTS, EMPTY_SLOT, np.uint64)
        if self.n:
            start = np.arange(max(1, self.n - SPAN + 1))
            hashes = self.spans(start, np.minimum(start + SPAN, self.n))
            values = np.minimum((hashes << np.uint64(6)) >> np.uint64(64 - SLOT_BITS), EMPTY_SLOT - np.uint64(1))
            np.minimum.at(slots, (hashes >> np.uint64(58)).astype(np.int64), values)
        return slots

    def marks(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the beginnings and of the ends whose lengths are multiples of ``grid(n)``."""
        at = np.arange(1, self.n // grid(self.n) + 1) * grid(self.n)
        cut = np.uint64(64 - SLOT_BITS)
        return self.spans(np.zeros_like(at), at) >> cut, self.spans(self.n - at, np.full_like(at, self.n)) >> cut

    def fingerprint(self) -> Fingerprint:
        return Fingerprint(self.n, int(self.spans(0, self.n)[0]), self.sketch(), *self.marks())


def grid(n: int) -> int:
    """The least power of two of which ``MARKS`` steps reach over ``n`` code points."""
    return 1 << max(0, -(-n // MARKS) - 1).bit_length()


@dataclass
class Fingerprint:
    n: int
    whole: int
    slots: np.ndarray
    heads: np.ndarray
    tails: np.ndarray

    def __str__(self) -> str:
        parts = (x.astype(">u4").tobytes().hex() for x in (self.slots, self.heads, self.tails))
        return ":".join((f"{self.n:x}", f"{self.whole:016x}", *parts))

    @classmethod
    def read(cls, text: str) -> Fingerprint:
        n, whole, *parts = text.split(":")
        return cls(int(n, 16), int(whole, 16), *(np.frombuffer(bytes.fromhex(p), ">u4").astype(np.uint64) for p in parts))

    def likeness(self, other: Fingerprint) -> float:
        if (self.n, self.whole) == (other.n, other.whole):
            return 1.0
        step = max(grid(self.n), grid(other.n))
        covered = sum(longest(a, step // grid(self.n), b, step // grid(other.n))
                      for a, b in ((self.heads, other.heads), (self.tails, other.tails))) * step
        filled = (self.slots != EMPTY_SLOT) | (other.slots != EMPTY_SLOT)
        alike = float((self.slots == other.slots)[filled].mean()) if filled.any() else 0.0
        # Texts that differ are never wholly alike.
        return min(max(alike, covered / max(self.n, other.n, 1)), 1 - 1 / (2 * SLOTS))


def longest(a: np.ndarray, every_a: int, b: np.ndarray, every_b: int) -> int:
    """How many of the common marks are equal: those of longer beginnings differ once shorter ones do."""
    low, high = 0, min(len(a) // every_a, len(b) // every_b)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[middle * every_a - 1] == b[middle * every_b - 1] else (low, middle - 1)
    return low


def compare(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    return Fingerprint.read(a).likeness(Fingerprint.read(b))


def edited(text: str, after: str) -> str:
    """The last third of ``text`` replaced by as much of the start of ``after``."""
    k = len(text) // 3
    return text[:len(text) - k] + after[:k]


def _blocks(docs: DataFrame) -> tuple[list[int], DataFrame]:
    """Bounds of the blocks, and the rows with their block; higher blocks have lower ids."""
    spark = docs.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    at = F.percentile_approx("node", [i / n for i in range(1, n)], 10_000)
    bounds = sorted(set(docs.select("node").agg(at.alias("at")).first()["at"] or []))
    array = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def block(node):
        import pandas as pd

        return pd.Series(len(array) - np.searchsorted(array, node.to_numpy(), "left")).astype("int32")

    return bounds, docs.withColumn("block", block("node"))


def with_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``EDIT`` of each row: its fingerprint, that of its edited text, and likenesses."""
    docs = df.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("node"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    _, placed = _blocks(docs)
    tops = sorted((r["block"], r["top"]) for r in placed.groupBy("block").agg(F.max("node").alias("top")).collect())
    # The row that follows a block's last one is the first of the next block (after all: of the first).
    to = {top: tops[i - 1][0] for i, (_, top) in enumerate(tops)}
    goal = F.create_map(*[F.lit(x).cast(t) for k, v in to.items() for x, t in ((k, "bigint"), (v, "int"))]) if to else None
    own = F.struct("block", F.lit(False).alias("copy"))
    if goal is None:
        sent = placed.withColumn("to", own)
    else:
        copy = F.struct(F.element_at(goal, F.col("node")).alias("block"), F.lit(True).alias("copy"))
        sent = placed.withColumn("to", F.explode(F.filter(F.array(own, copy), lambda t: t["block"].isNotNull())))
    ordered = (sent.select(F.col("to.block").alias("block"), F.col("to.copy").alias("copy"), "node", "text")
               .repartition("block").sortWithinPartitions("block", "copy", F.desc("node"), "text"))
    names = [c.split()[0] for c in EDIT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def row(node, text, print_, after, after_print):
        new = edited(text, after)
        new_print = Prefix(new).fingerprint()
        return (None if node == NO_ID else node, len(text), hashlib.sha256(new.encode()).hexdigest(), str(print_),
                str(new_print), print_.likeness(new_print), print_.likeness(after_print))

    def run(batches):
        held = at = None  # the row before: id, text, fingerprint
        for batch in batches:
            done = []
            blocks, copies, nodes = (batch.column(i).to_pylist() for i in range(3))
            for i, (block, copy, node) in enumerate(zip(blocks, copies, nodes)):
                if block != at:
                    held, at = None, block
                elif held is None:
                    continue  # more copies of a block's end
                text = batch.column(3)[i].as_py()
                print_ = Prefix(text).fingerprint()
                if held is not None:
                    done.append(row(*held, text, print_))
                held = None if copy else (node, text, print_)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(types)], names)

    return ordered.mapInArrow(run, EDIT)
