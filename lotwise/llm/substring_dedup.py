"""Substring de-duplication: rolling hashes of every fixed-length word window, counted in Spark.

A window's hash is read off a prefix array over the text's word hashes (a Rabin-Karp hash modulo
2**64), so all windows of a slice cost one vectorised pass. A window is a repeat where a document
with a smaller id holds the same hash; overlapping repeats merge into maximal removal intervals.

Most windows occur once, so the exchange runs in two steps, both exact. Each window names one
anchor, the least hash of its ``ANCHOR``-word grams: equal windows have equal anchors, and
neighbouring windows mostly share one. Step one exchanges anchors and keeps those in two documents
or more; step two exchanges only the windows with such an anchor and finds each one's smallest
document. Both documents of a repeat pass step one, so no repeat is lost. Texts cross the network
once; both steps join the same exchange.

Windows are equal when their 64-bit hashes are.

Answers come back by id and text hash, so a row's list holds the keys of one text, however many
rows share an id or have none. The id alone decides which documents are compared.

Rows: null text has no words; a text shorter than a window loses nothing; rows with the same id
count as one document, whose rows are no repeats of one another; rows without an id count as one
document after all others; an empty table gives an empty result. Only the id and text columns are
read; other columns, whatever their names, are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import (BLOCKS, LATER, SHARED, answer, bucket_bits, flat_lists, in_row,
                       map_slices, node_array, pack, NODE_NULL)
from .words import Slice, Words, grams, split, text_slices

WINDOW = 13  # words
ANCHOR = 5  # words of an anchor gram
RESULT = ("doc_id bigint, n_words bigint, n_removed bigint, "
          "removed array<struct<start:bigint,stop:bigint>>, kept_text string")


def _window_anchors(w: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows, and each one's anchor: the least gram hash inside it."""
    n = len(w.hash)
    at = np.flatnonzero(w.row[:n - window + 1] == w.row[window - 1:]) if n >= window else np.zeros(0, int)
    if not len(at):
        return at, np.zeros(0, np.uint64)
    where, hashes = grams(w, anchor)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    least[where] = hashes
    span, need = 1, window - anchor + 1  # least over `need` grams, by doubling
    while span < need:
        step = min(span, need - span)
        least = np.minimum(least, np.concatenate((least[step:], np.full(step, np.iinfo(np.uint64).max, np.uint64))))
        span += step
    return at, least[at]


def _kept(s: Slice, w: Words, gone: np.ndarray) -> pa.Array:
    """Each row's words that stay, joined by one space."""
    keep = np.flatnonzero(~gone)
    inside = np.zeros(len(s.data) + 1, np.int32)
    np.add.at(inside, w.start[keep], 1)
    np.add.at(inside, w.end[keep], -1)
    take = np.cumsum(inside[:-1]) > 0
    data = s.data.copy()
    followed = np.zeros(len(keep), bool)  # by another kept word of its row
    followed[:-1] = w.row[keep[1:]] == w.row[keep[:-1]]
    gaps = w.end[keep[followed]]
    data[gaps] = 0x20
    take[gaps] = True
    sizes = np.concatenate(([0], np.cumsum(take)))[s.offsets]
    return pa.LargeStringArray.from_buffers(
        s.rows, pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(data[take])).cast(pa.string())


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``RESULT``: per row, its words, those removed, the maximal removed intervals (in words) and
    the text that stays, its words joined by one space."""
    docs = df.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(NODE_NULL))).alias("node"),
                     F.col(text_col).cast("string").alias("text")).withColumn("part", F.hash("text"))
    bits = bucket_bits(df.sparkSession)

    def part_array(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(2).to_numpy(zero_copy_only=False)

    def anchors(batch: pa.RecordBatch):
        nodes, parts = node_array(batch.column(0)), part_array(batch)
        for s in text_slices(batch.column(1)):
            w = split(s)
            at, least = _window_anchors(w, window, anchor)
            row = w.row[at]
            new = np.ones(len(at), bool)
            new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
            yield pack(nodes[s.lo:s.hi][row[new]], parts[s.lo:s.hi][row[new]], least[new], bits, SHARED)

    def windows(batch: pa.RecordBatch):
        nodes, parts = node_array(batch.column(0)), part_array(batch)
        for s in text_slices(batch.column(1)):
            held_rows, held = flat_lists(batch.column(3), s.lo, s.hi)
            if not len(held):
                continue
            w = split(s)
            at, least = _window_anchors(w, window, anchor)
            hit = in_row(w.row[at], least, held_rows, held)
            _, hashes = grams(w, window)
            row = w.row[at[hit]]
            yield pack(nodes[s.lo:s.hi][row], parts[s.lo:s.hi][row], hashes[hit], bits, LATER)

    def results(batch: pa.RecordBatch):
        ids = batch.column(0)
        for s in text_slices(batch.column(1)):
            w = split(s)
            held_rows, held = flat_lists(batch.column(3), s.lo, s.hi)
            at, hashes = grams(w, window)
            hit = at[in_row(w.row[at], hashes, held_rows, held)]
            cover = np.zeros(len(w.hash) + 1, np.int64)
            np.add.at(cover, hit, 1)
            np.add.at(cover, hit + window, -1)
            gone = np.cumsum(cover[:-1]) > 0
            n_gone = np.concatenate(([0], np.cumsum(gone)))[w.first]
            part = ids.slice(s.lo, s.rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(node_array(part) == NODE_NULL, 0, node_array(part)), pa.int64(),
                          mask=node_array(part) == NODE_NULL),
                 pa.array(w.count.astype(np.int64)), pa.array(np.diff(n_gone).astype(np.int64)),
                 _intervals(w, gone), _kept(s, w, gone)],
                ["doc_id", "n_words", "n_removed", "removed", "kept_text"])

    def lists(answers: DataFrame) -> DataFrame:
        return answers.groupBy("node", "part").agg(F.collect_list("key").alias("keys"))

    def with_keys(answers: DataFrame) -> DataFrame:
        return docs.join(lists(answers), ["node", "part"], "left").select("node", "text", "part", "keys")

    shared = answer(map_slices(docs, BLOCKS, anchors), SHARED)
    later = answer(map_slices(with_keys(shared), BLOCKS, windows), LATER)
    return map_slices(with_keys(later), RESULT, results)


def _intervals(w: Words, gone: np.ndarray) -> pa.Array:
    """Maximal runs of removed words of each row, counted from its first word."""
    n = len(gone)
    starts_row = np.zeros(n + 1, bool)
    starts_row[w.first] = True
    before = np.concatenate(([False], gone[:-1])) if n else gone
    after = np.concatenate((gone[1:], [False])) if n else gone
    start = np.flatnonzero(gone & (~before | starts_row[:-1]))
    stop = np.flatnonzero(gone & (~after | starts_row[1:])) + 1
    base = w.first[:-1][w.row[start]] if len(start) else start
    offsets = np.searchsorted(start, w.first).astype(np.int32)
    fields = pa.StructArray.from_arrays(
        [pa.array((start - base).astype(np.int64)), pa.array((stop - base).astype(np.int64))],
        ["start", "stop"])
    return pa.ListArray.from_arrays(pa.array(offsets), fields)
