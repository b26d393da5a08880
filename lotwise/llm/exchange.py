"""Which keys occur in several nodes: a packed, hash-bucketed exchange of (node, part, key) pairs.

A node is a document: all rows of one id. A part is a 32-bit hash of a row's text. Nodes are what
is compared; answers go to the node and part, so that they come back to rows of one text and not to
all rows of the id. Parts of a node that meet in a hash only share their answers, which are the same
for all rows of a node.

A task turns a slice of documents into blocks, one row per bucket of keys, holding packed arrays
instead of a row per pair. A slice is combined before it is sent: a key held by many nodes of one
slice sends one pair, and the others are answered on the spot, so a key held by a third of all
documents reaches its bucket once per slice. Only the parts of one node each ask. Buckets grow in number with
``spark.sql.shuffle.partitions``; a task holds one bucket at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .words import mix64

SHARED = "shared"  # answers each pair whose key another node holds too
LATER = "later"  # answers each pair whose key a smaller node holds

BLOCKS = "bucket int, nodes binary, keys binary, states binary, parts binary"
ANSWERS = "node bigint, part int, key bigint"
ASK, WITNESS, ANSWERED = 0, 1, 2
NODE_NULL = np.int64(2**63 - 1)  # documents without an id count as one, after all others


def bucket_bits(spark: SparkSession) -> int:
    """Four buckets or more for each shuffle partition, as a power of two."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(6, (4 * n - 1).bit_length())


def _runs(keys: np.ndarray, nodes: np.ndarray, parts: np.ndarray):
    """Pairs by key, then node, then part; where each key's run starts; each pair's run."""
    order = np.lexsort((parts, nodes, keys))
    keys, nodes, parts = keys[order], nodes[order], parts[order]
    head = np.ones(len(keys), bool)
    head[1:] = keys[1:] != keys[:-1]
    return order, keys, nodes, parts, head, np.cumsum(head) - 1


def pack(nodes: np.ndarray, parts: np.ndarray, keys: np.ndarray, bits: int, mode: str) -> pa.RecordBatch | None:
    """Blocks of one slice's (node, part, key) pairs, combined by key."""
    if not len(keys):
        return None
    _, keys, nodes, parts, head, run = _runs(keys, nodes, parts)
    new = head.copy()
    new[1:] |= (nodes[1:] != nodes[:-1]) | (parts[1:] != parts[:-1])
    keys, nodes, parts, head, run = keys[new], nodes[new], parts[new], head[new], run[new]
    first = nodes == nodes[head][run]  # of the key's least node
    state = np.where(first, ASK, ANSWERED).astype(np.uint8)
    if mode == SHARED:  # a key of several nodes here is answered for all, and stays a witness
        held = np.bincount(run, ~first)[run] > 0
        state[held] = ANSWERED
        twice = head & held
        keys, nodes, parts = (np.concatenate((x, x[twice])) for x in (keys, nodes, parts))
        state = np.concatenate((state, np.full(twice.sum(), WITNESS, np.uint8)))
    # Answered pairs need no meeting: they are spread by row, so no hot key or node gathers them.
    by = np.where(state == ANSWERED, mix64(nodes.astype(np.uint64) ^ mix64(parts.astype(np.uint64))), keys)
    bucket = (by >> np.uint64(64 - bits)).astype(np.int32)
    order = np.lexsort((parts, nodes, bucket))
    bucket, keys, nodes, parts, state = bucket[order], keys[order], nodes[order], parts[order], state[order]
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    ends = np.append(cuts[1:], len(bucket))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cuts]),
         pa.array([_pack_nodes(nodes[a:b]) for a, b in zip(cuts, ends)], pa.binary()),
         pa.array([keys[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
         pa.array([state[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
         pa.array([parts[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())],
        ["bucket", "nodes", "keys", "states", "parts"])


def _pack_nodes(nodes: np.ndarray) -> bytes:
    """Ascending nodes as the first and 32-bit steps, or plainly where a step is too wide."""
    steps = np.diff(nodes.astype(np.uint64))
    if len(steps) and steps.max() >= 1 << 32:
        return b"\1" + nodes.tobytes()
    return b"\0" + nodes[:1].tobytes() + steps.astype(np.uint32).tobytes()


def _unpack_nodes(data: bytes) -> np.ndarray:
    if data[0]:
        return np.frombuffer(data, np.int64, offset=1)
    first = np.frombuffer(data, np.int64, 1, 1).astype(np.uint64)
    steps = np.frombuffer(data, np.uint32, offset=9).astype(np.uint64)
    return np.cumsum(np.concatenate((first, steps))).astype(np.int64)


def _answers(rows: list[tuple[bytes, bytes, bytes, bytes]], mode: str) -> pa.RecordBatch | None:
    """Answers of one bucket, each once."""
    nodes = np.concatenate([_unpack_nodes(r[0]) for r in rows])
    keys, state, parts = (np.concatenate([np.frombuffer(r[i], t) for r in rows])
                          for i, t in ((1, np.uint64), (2, np.uint8), (3, np.int32)))
    done = state == ANSWERED
    out = [(nodes[done], parts[done], keys[done])]
    nodes, parts, keys, state = nodes[~done], parts[~done], keys[~done], state[~done]
    if len(keys):
        order, keys, nodes, parts, head, run = _runs(keys, nodes, parts)
        state = state[order]
        if mode == SHARED:
            other = ~head
            other[1:] &= nodes[1:] != nodes[:-1]
            shared = np.bincount(run, other | (state == WITNESS)) > 0
            hit = shared[run] & (state == ASK)
        else:
            hit = nodes > nodes[head][run]
        out.append((nodes[hit], parts[hit], keys[hit]))
    n, p, k = (np.concatenate(x) for x in zip(*out))
    if not len(n):
        return None
    _, k, n, p, new, _ = _runs(k, n, p)  # copies of a row in several slices ask alike
    new[1:] |= (n[1:] != n[:-1]) | (p[1:] != p[:-1])
    return pa.RecordBatch.from_arrays([pa.array(n[new]), pa.array(p[new]), pa.array(k[new].view(np.int64))],
                                      ["node", "part", "key"])


def answer(blocks: DataFrame, mode: str) -> DataFrame:
    """(node, part, key) rows of the blocks: those whose key is held as ``mode`` says. A pair comes
    twice at most: answered in a slice, and by its bucket."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            buckets = batch.column(0).to_pylist()
            packed = [batch.column(i) for i in (1, 2, 3, 4)]
            for i, bucket in enumerate(buckets):
                if bucket != at and held:
                    if (out := _answers(held, mode)) is not None:
                        yield out
                    held = []
                at = bucket
                held.append(tuple(c[i].as_py() for c in packed))
        if held and (out := _answers(held, mode)) is not None:
            yield out

    return (blocks.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(reduce, ANSWERS))


def map_slices(df: DataFrame, schema: str, work: Callable) -> DataFrame:
    """``work(batch)`` yields record batches or None for each Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in work(batch):
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def node_array(column: pa.Array) -> np.ndarray:
    """Ids of a batch; null is ``NODE_NULL``."""
    return column.fill_null(int(NODE_NULL)).to_numpy(zero_copy_only=False).astype(np.int64)


def flat_lists(column: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``lo:hi`` of a list<int64> column (null: empty): each value's row, and the values."""
    part = column.slice(lo, hi - lo)
    sizes = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return np.repeat(np.arange(hi - lo), sizes), values


def in_row(rows: np.ndarray, keys: np.ndarray, held_rows: np.ndarray, held: np.ndarray) -> np.ndarray:
    """For each (row, key), whether that row's list holds that key (by a 64-bit code of both)."""
    if not len(held) or not len(keys):
        return np.zeros(len(keys), bool)
    code = lambda r, k: mix64(k ^ mix64((r + 1).astype(np.uint64)))
    return np.isin(code(rows, keys), code(held_rows, held))
