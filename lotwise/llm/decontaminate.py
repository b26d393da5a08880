"""Benchmark decontamination: a prefix-filtered join of documents with the benchmark's windows.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words, but not none, is one
window. A window's tokens are its shingles. Its containment in a document asks for all of them, so
its necessary prefix is one token: the rarest, by counts over all documents. A document position
that holds a window's rarest shingle is a candidate; positional and length bounds drop those where
the window would start before or end after the document; the rest are verified word by word.

The benchmark is the stated query set. Its distinct pairs of a window and an item are dealt to blocks
of about ``BLOCK_WINDOWS`` by their hash, so what is broadcast at once has a fixed bound whatever the
benchmark's size and however many items share a window; with several blocks the rows pass through a
written table between them, and spans and items add up. Documents are never shuffled. Words are compared by 64-bit hashes, all words of a window each.

Rows: null text has no words and is clean; null item text has no windows; hits of items without
an id count as hit words, but name no item; repeated rows and items are judged alike; an empty
benchmark hits nothing; an empty table gives an empty result. Columns of the input ride along
in the struct ``row``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, remove_path, scratch_path
from .rows import as_rows, map_rows, text_field
from .words import BASE_WORD, LETTERS_DIGITS, SMALL_SLICE, grams, mix64, split, text_slices

WINDOW = 13  # words
SHINGLE = 3  # words of a token, or 1 in windows of fewer words
BLOCK_WINDOWS = 500_000  # (window, item) pairs broadcast at once: 13 hashes of 8 bytes each, 52 MB
SHARE = 20  # contaminated when SHARE * hit words >= words
FILTER_BITS = 22

RESULT = "n_words bigint, n_hit bigint, spans array<bigint>, items array<bigint>"


class Membership:
    """Positions of hashes in a sorted set; a bitmap answers most misses."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self.values >> np.uint64(64 - FILTER_BITS)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices into ``hashes`` that are members, and their places in the set."""
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - FILTER_BITS)])
        place = np.searchsorted(self.values, hashes[at])
        place[place == len(self.values)] = 0
        hit = self.values[place] == hashes[at] if len(self.values) else np.zeros(len(at), bool)
        return at[hit], place[hit]


def _expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each unit of each count: whose it is, and its number among them."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, words): the word hashes of each window of each item."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for s in text_slices(batch.column(1), lower=True):
                w = split(s, LETTERS_DIGITS)
                n = np.where(w.count > 0, np.maximum(w.count - window + 1, 1), 0)
                row, k = _expand(n)
                size = np.minimum(w.count, window)[row]
                owner, j = _expand(size)
                words = w.hash[(w.first[:-1][row] + k)[owner] + j].view(np.int64)
                offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(s.lo, s.rows).take(pa.array(row)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(words))], ["item", "words"])

    return (items.select(F.col(id_col).cast("bigint").alias("item"),
                         F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "item bigint, words array<bigint>"))


class Block:
    """One block of distinct windows: padded word hashes, lengths, items, and (from the corpus
    counts) each window's rarest shingle."""

    def __init__(self, rows: pa.Table, window: int):
        words = rows.column("words").combine_chunks()
        items = rows.column("items").combine_chunks()
        self.size = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        owner, j = _expand(self.size)
        self.words = np.zeros((len(self.size), window), np.uint64)
        self.words[owner, j] = words.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        self.n_items = items.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.items = items.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.shingle = np.where(self.size >= SHINGLE, SHINGLE, 1)
        # Shingles of each window: which window, at which word, hash.
        self.of, self.offset, hashes = [], [], []
        for k in (1, SHINGLE):
            rows_k = np.flatnonzero(self.shingle == k)
            own, off = _expand(self.size[rows_k] - k + 1)
            own = rows_k[own]
            self.of.append(own)
            self.offset.append(off)
            hashes.append(_window_shingles(self.words, own, off, k))
        self.of, self.offset = np.concatenate(self.of), np.concatenate(self.offset)
        self.hashes = np.concatenate(hashes)
        self.tokens = Membership(self.hashes)

    def order(self, counts: np.ndarray) -> None:
        """Keep each window's rarest shingle (ties: the least hash, then the first place)."""
        place = np.searchsorted(self.tokens.values, self.hashes)
        best = np.lexsort((self.offset, self.hashes, counts[place], self.of))
        head = np.ones(len(best), bool)
        head[1:] = self.of[best[1:]] != self.of[best[:-1]]
        best = best[head]
        key = self.hashes[best]
        order = np.argsort(key, kind="stable")
        self.of, self.offset = self.of[best][order], self.offset[best][order]
        self.tokens = Membership(key)
        self.first = np.searchsorted(key[order], np.append(self.tokens.values, 0))
        self.first[-1] = len(key)
        self.item_first = np.concatenate(([0], np.cumsum(self.n_items)))
        self.hashes = None


def _window_shingles(words: np.ndarray, own: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k``-word shingles at word ``off`` of window ``own``, as ``grams`` has them."""
    total = np.zeros(len(own), np.uint64)
    for j in range(k):
        total += words[own, off + j] * np.uint64(pow(BASE_WORD, j, 1 << 64))
    return mix64(total + np.uint64(k))


def _shingles(w, ks=(1, SHINGLE)):
    for k in ks:
        yield k, *grams(w, k)


def find_contamination(df: DataFrame, items: DataFrame, text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text",
                       window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``row`` (the input's columns), n_words, n_hit, hit items (ascending), hit spans (pairs of
    first word and end, maximal) and contaminated, for each row."""
    spark = df.sparkSession
    windows = benchmark_windows(items, item_col, item_text_col, window)
    pairs = windows.distinct()
    path = scratch_path(spark, "benchmark-windows")
    pairs.write.parquet(path)
    stored = spark.read.schema(pairs.schema).parquet(path)
    n_blocks = max(1, -(-stored.count() // block_windows))
    rows = as_rows(df)
    current = None
    for k in range(n_blocks):
        part = stored.where(F.pmod(F.xxhash64("words", "item"), F.lit(n_blocks)) == k)
        block = Block(part.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items")).toArrow(), window)
        block.order(_counts(rows, text_col, block))
        if current is not None:
            current = materialize(current, f"contamination-{k}")
        current = _match(rows if current is None else current, text_col, block, current is None)
    remove_path(spark, path)
    hit = F.col("n_hit")
    return current.select("row", "n_words", "n_hit", "items", "spans",
                          ((hit > 0) & (F.lit(SHARE) * hit >= F.col("n_words"))).alias("contaminated"))


def _counts(rows: DataFrame, text_col: str, block: Block) -> np.ndarray:
    """How often each token of the block occurs in all documents."""
    tokens = rows.sparkSession.sparkContext.broadcast(block.tokens)
    size = len(block.tokens.values)

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for s in text_slices(text_field(batch, text_col), lower=True, limit=SMALL_SLICE):
                w = split(s, LETTERS_DIGITS)
                for _, _, hashes in _shingles(w):
                    total += np.bincount(tokens.value.find(hashes)[1], minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["token", "n"])

    counted = (rows.mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")))
    got = counted.toArrow()
    out = np.zeros(size, np.int64)
    out[got.column("token").to_numpy()] = got.column("n").to_numpy()
    return out


def _match(rows: DataFrame, text_col: str, block: Block, first: bool) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def work(batch: pa.RecordBatch):
        b = shared.value
        for s in text_slices(text_field(batch, text_col), lower=True, limit=SMALL_SLICE):
            w = split(s, LETTERS_DIGITS)
            starts, which = [], []
            for k, at, hashes in _shingles(w):
                hit, token = b.tokens.find(hashes)
                owner, j = _expand(b.first[token + 1] - b.first[token])
                entry = b.first[token][owner] + j
                window, start = b.of[entry], at[hit][owner] - b.offset[entry]
                row = w.row[at[hit][owner]]
                fits = ((b.shingle[window] == k) & (start >= w.first[row])
                        & (start + b.size[window] <= w.first[row + 1]))
                start, window = start[fits], window[fits]
                for j in range(b.words.shape[1]):
                    if not len(start):
                        break
                    there = np.minimum(start + j, len(w.hash) - 1)
                    same = (j >= b.size[window]) | (w.hash[there] == b.words[window, j])
                    start, window = start[same], window[same]
                starts.append(start)
                which.append(window)
            start, window = np.concatenate(starts), np.concatenate(which)
            yield s.lo, s.hi, _found(batch, s, w, b, start, window, first)

    out = map_rows(rows.select("row") if first else rows, RESULT, work)
    return out


def _found(batch, s, w, b, start, window, first):
    """n_words, spans and items of each row, joined with those of earlier blocks."""
    cover = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + b.size[window], -1)
    owner, j = _expand(b.n_items[window])
    rows, items = w.row[start][owner], b.items[b.item_first[window][owner] + j]
    if not first:
        old_rows, old = _flat(batch.column(3), s)
        base = w.first[old_rows[::2]]
        np.add.at(cover, base + old[::2], 1)
        np.add.at(cover, base + old[1::2], -1)
        more_rows, more = _flat(batch.column(4), s)
        rows, items = np.concatenate((rows, more_rows)), np.concatenate((items, more))
    hit = np.cumsum(cover[:-1]) > 0
    edge = np.zeros(len(hit) + 1, bool)
    edge[w.first] = True
    before = np.concatenate(([False], hit[:-1])) if len(hit) else hit
    after = np.concatenate((hit[1:], [False])) if len(hit) else hit
    begin = np.flatnonzero(hit & (~before | edge[:-1]))
    end = np.flatnonzero(hit & (~after | edge[1:])) + 1
    base = w.first[:-1][w.row[begin]] if len(begin) else begin
    spans = np.stack((begin - base, end - base), 1).reshape(-1)
    offsets = 2 * np.searchsorted(begin, w.first)
    order = np.lexsort((items, rows))
    rows, items = rows[order], items[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (items[1:] != items[:-1])
    rows, items = rows[new], items[new]
    n_hit = np.diff(np.concatenate(([0], np.cumsum(hit)))[w.first])
    return [pa.array(w.count.astype(np.int64)), pa.array(n_hit.astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(spans.astype(np.int64))),
            pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(s.rows + 1)).astype(np.int32)),
                                     pa.array(items.astype(np.int64)))]


def _flat(column: pa.Array, s) -> tuple[np.ndarray, np.ndarray]:
    part = column.slice(s.lo, s.rows)
    sizes = part.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(s.rows), sizes), part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
