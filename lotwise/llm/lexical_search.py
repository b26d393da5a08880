"""Ranked lexical search over term owners that an item bundle visits one after another.

The terms of a bundle of items are dealt to ``OWNERS`` owners in ascending order of the documents
that hold them, an equal share of the postings each: the first owners hold rare terms, the last one
the commonest. Bundles travel: per block of documents, a bundle's sparse accumulators (item,
document, score so far) meet the next owner's posting lists of that block in a cogroup, get the
owner's integer contributions added, and go on to the next owner. Sums of integers don't depend on the
order. Rare terms come first, so few accumulators exist while they travel, and those that common terms
add to nearly every document arise at the last owner, which selects each block's best documents at
once. A window over the blocks' best gives the answer.

A block is a run of a task's documents, ``BLOCK_DOCS`` and about ``SLICE_BYTES`` of text at most (one
text at least), numbered when the posting lists are stored; its dense form in a task takes
8 * documents * items bytes, a few MB. No group depends on a key of the data, so repeated ids, copies
and common terms don't make a group larger. Items are dealt to bundles of about ``BUNDLE_ITEMS``
items and ``BUNDLE_BYTES`` of text; what is broadcast is one bundle's terms. Every bundle reads the
texts once.

Terms are compared by 64-bit hashes. A term's weight is computed once, on the driver, in doubles.

Rows: null and empty texts and texts without terms are not counted and not ranked; items without
terms or without matches have no rows; repeated documents are ranked each, equal scores by ascending
id, rows without an id last; repeated items are answered each; empty tables give an empty result.
Only ids and texts are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, remove_path, scratch_path
from .words import LETTERS_DIGITS, split, text_slices

BEST = 10  # documents an item
OWNERS = 4  # stages of the pipeline
BLOCK_DOCS = 1024
BUNDLE_ITEMS = 512
BUNDLE_BYTES = 4 << 20

POSTINGS = ("block bigint, term int, holders bigint, docs binary, counts binary, "
            "ids array<bigint>, lengths array<int>, n_docs bigint, n_terms bigint")
BUNDLES = "block bigint, ids array<bigint>, lengths array<int>, items binary, docs binary, scores binary"
FOUND = "item int, doc_id bigint, score bigint"


@dataclass
class Bundle:
    """Items' terms: sorted hashes, and the items that hold term t at ``first[t]:first[t + 1]``."""

    n_items: int
    terms: np.ndarray
    first: np.ndarray
    items: np.ndarray

    def holders(self, term: int) -> np.ndarray:
        return self.items[self.first[term]:self.first[term + 1]]


def bundle_terms(texts: pa.Array) -> Bundle:
    hashes, items = [], []
    for s in text_slices(texts, lower=True):
        w = split(s, LETTERS_DIGITS)
        hashes.append(w.hash)
        items.append(s.lo + w.row)
    term, item = np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate([np.zeros(0, np.int64), *items])
    order = np.lexsort((item, term))
    term, item = term[order], item[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (item[1:] != item[:-1])
    terms, first = np.unique(term[new], return_index=True)
    return Bundle(len(texts), terms, np.append(first, int(new.sum())), item[new].astype(np.uint16))


def _lists(values: np.ndarray) -> pa.Array:
    """One row that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def store_postings(docs: DataFrame, bundle, folder: str) -> DataFrame:
    """``POSTINGS`` of the (broadcast) bundle's terms: per block a row for each term that it holds,
    and one without a term that lists its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        terms = bundle.value.terms
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_DOCS):
                part = batch.slice(lo, BLOCK_DOCS)
                for s in text_slices(part.column(1), lower=True):
                    w = split(s, LETTERS_DIGITS)
                    if not len(w.hash):
                        continue
                    place = np.minimum(np.searchsorted(terms, w.hash), max(len(terms) - 1, 0))
                    hit = np.flatnonzero(terms[place] == w.hash) if len(terms) else np.zeros(0, np.int64)
                    key, count = np.unique(place[hit] * s.rows + w.row[hit], return_counts=True)
                    held, at = np.unique(key // s.rows, return_index=True)
                    ends = np.append(at[1:], len(key)).tolist()
                    rows, count = (key % s.rows).astype("<u2"), count.astype("<u4")
                    spans = list(zip(at.tolist(), ends))
                    n, lengths = len(held) + 1, w.count.astype(np.int32)
                    only_first = np.zeros(n + 1, np.int32)
                    only_first[1:] = s.rows
                    none = np.append(False, np.ones(n - 1, bool))
                    ids = part.column(0).slice(s.lo, s.rows)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(n, block)), pa.array(np.append(-1, held).astype(np.int32)),
                        pa.array(np.append(0, np.diff(np.append(at, len(key))))),
                        pa.array([b"", *(rows[a:b].tobytes() for a, b in spans)], pa.binary()),
                        pa.array([b"", *(count[a:b].tobytes() for a, b in spans)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(only_first), ids),
                        pa.ListArray.from_arrays(pa.array(only_first), pa.array(lengths)),
                        pa.array(np.append(int((lengths > 0).sum()), np.zeros(n - 1, np.int64)), mask=none),
                        pa.array(np.append(int(lengths.sum()), np.zeros(n - 1, np.int64)), mask=none),
                    ], [f.split()[0] for f in POSTINGS.split(", ")])
                    block += 1

    texts = docs.mapInArrow(run, POSTINGS)
    texts.write.parquet(folder)
    return docs.sparkSession.read.schema(POSTINGS).parquet(folder)


def term_weight(n_docs: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders + 1)))


def contributions(weight: int, count: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A term's part of the scores, from its counts in documents and their lengths."""
    m = 10 + 90 * length * n_docs // n_terms
    return weight * (1_000_000_000 * count // (1000 * count + 8 * m))


def _deal(holders: dict[int, int], owners: int) -> dict[int, int]:
    """Each term's owner: terms by ascending holders, an equal share of the postings each."""
    total, sofar, out = sum(holders.values()), 0, {}
    for term, n in sorted(holders.items(), key=lambda x: (x[1], x[0])):
        out[term] = min(owners - 1, sofar * owners // max(total, 1))
        sofar += n
    return out


def _owner_step(bundle, weights, n_docs: int, n_terms: int, best: int | None):
    """A cogroup step: the accumulators of a block's bundle with an owner's contributions; with
    ``best``, the block's best documents of each item instead."""

    def scores(left: pa.Table, right: pa.Table) -> np.ndarray:
        b, w = bundle.value, weights.value
        length = left.column("lengths").combine_chunks().flatten().to_numpy().astype(np.int64)
        total = np.zeros((b.n_items, len(length)), np.int64)
        item, doc, score = (np.frombuffer(left.column(c)[0].as_py(), kind)
                            for c, kind in (("items", "<u2"), ("docs", "<u2"), ("scores", "<i8")))
        total[item, doc] = score
        for term, docs, counts in zip(*(right.column(c).to_pylist() for c in ("term", "docs", "counts"))):
            doc = np.frombuffer(docs, "<u2")
            more = contributions(w[term], np.frombuffer(counts, "<u4").astype(np.int64), length[doc], n_docs, n_terms)
            total[b.holders(term)[:, None], doc] += more
        return total

    def carry(left: pa.Table, right: pa.Table) -> pa.Table:
        total = scores(left, right)
        item, doc = np.nonzero(total)
        packed = (item.astype("<u2"), doc.astype("<u2"), total[item, doc].astype("<i8"))
        arrays = [left.column(c) for c in ("block", "ids", "lengths")]
        return pa.Table.from_arrays([*arrays, *(pa.array([x.tobytes()], pa.binary()) for x in packed)],
                                    ["block", "ids", "lengths", "items", "docs", "scores"])

    def select(left: pa.Table, right: pa.Table) -> pa.Table:
        total = scores(left, right)
        ids = left.column("ids").combine_chunks().flatten()
        none = ids.is_null().to_numpy(zero_copy_only=False)
        number = ids.fill_null(0).to_numpy()
        items, docs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for item, row in enumerate(total):
            least = max(1, int(np.partition(row, -best)[-best])) if len(row) > best else 1
            doc = np.flatnonzero(row >= least)
            doc = doc[np.lexsort((number[doc], none[doc], -row[doc]))[:best]]
            items.append(np.full(len(doc), item))
            docs.append(doc)
        item, doc = np.concatenate(items), np.concatenate(docs)
        return pa.Table.from_arrays([pa.array(item.astype(np.int32)), ids.take(pa.array(doc)), pa.array(total[item, doc])],
                                    ["item", "doc_id", "score"])

    return carry if best is None else select


def _rank_bundle(docs: DataFrame, items: DataFrame, best: int) -> DataFrame:
    """(number, rank, doc_id, score) of a bundle of items (number, text)."""
    spark = docs.sparkSession
    asked = items.orderBy("number").toArrow()
    terms = bundle_terms(asked.column("text"))
    bundle = spark.sparkContext.broadcast(terms)
    folder = scratch_path(spark, "search-postings")
    postings = store_postings(docs, bundle, folder)
    n_docs, n_terms = postings.where("term < 0").agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    holders = {r.term: r.n for r in postings.where("term >= 0").groupBy("term").agg(F.sum("holders").alias("n")).collect()}
    owner = _deal(holders, OWNERS)
    weights = spark.sparkContext.broadcast({t: term_weight(n_docs, n) for t, n in holders.items()})
    owners = spark.createDataFrame(list(owner.items()), "term int, owner int")
    lists = (postings.where("term >= 0").select(F.col("block").alias("of"), "term", "docs", "counts")
             .join(F.broadcast(owners), "term"))
    nothing = F.lit(b"")
    state = postings.where("term < 0").select("block", "ids", "lengths", nothing.alias("items"), nothing.alias("docs"),
                                              nothing.alias("scores"))
    for k in range(OWNERS):
        last = k == OWNERS - 1
        step = _owner_step(bundle, weights, n_docs, n_terms, best if last else None)
        own = lists.where(F.col("owner") == k).select("of", "term", "docs", "counts")
        state = state.groupBy("block").cogroup(own.groupBy("of")).applyInArrow(step, FOUND if last else BUNDLES)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = state.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    numbers = spark.createDataFrame(list(enumerate(asked.column("number").to_pylist())), "item int, number bigint")
    found = materialize(ranked.join(F.broadcast(numbers), "item").select("number", "rank", "doc_id", "score"), "search-ranked")
    remove_path(spark, folder)
    return found


def rank_documents(docs: DataFrame, items: DataFrame, best: int = BEST, id_col: str = "doc_id", text_col: str = "text",
                   item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` highest-scoring documents of each item."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = materialize(items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
                        .withColumn("number", F.monotonically_increasing_id()), "search-items")
    n_items, n_bytes = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n = max(-(-n_items // BUNDLE_ITEMS), -(-n_bytes // BUNDLE_BYTES), 1)
    dealt = items.withColumn("bundle", F.pmod(F.xxhash64("number"), F.lit(n)))
    found = None
    for k in range(n):
        one = _rank_bundle(docs, dealt.where(F.col("bundle") == k).select("number", "text"), best)
        found = one if found is None else found.unionByName(one)
    return found.join(items.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_no,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), c AS (
  SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0
), t AS (
  SELECT row_no, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
  FROM (SELECT row_no, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY row_no, term
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), w AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM t, c WHERE term IN (SELECT term FROM q) GROUP BY term
), s AS (
  SELECT item_id, row_no, any_value(doc_id) AS doc_id,
         sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN w USING (term), c GROUP BY item_id, row_no
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""
