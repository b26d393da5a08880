"""Alignment of two tokenizers' tokens over the same bytes, by windows between white space.

Every text is encoded whole by both tokenizers; the ids of segments at whose ends neither tokenizer can
go on are kept, so a segment met before is not encoded again. Where both have a token that ends and the next token
of either is marked by a space, the text may be split: nothing overlaps across such an anchor. The
pieces between anchors are windows of token ids. How a window's tokens overlap depends on its two id
tuples alone, so a worker keeps one alignment per pair of tuples, and texts become short sequences of
window numbers.

A block is a run of a task's texts of about ``BLOCK_BYTES`` (one text at least), stored as one row:
its documents, their window sequences, each window's links, and how often the block links each id
pair. Spark sums these counts over all blocks, compares them per id of the second tokenizer (a
group has an entry per id of the first at most), and brings each pair's count back to the blocks that
hold it; there a document's figures are sums over its windows. Texts are read and encoded once.

Rows: null and empty texts, and texts that a tokenizer doesn't give back byte for byte, have no
tokens and get zeros and an empty string; texts of any length are aligned whole; repeated rows and
rows without an id are documents of their own; an empty table gives an empty result. Only id and
text are read.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .token_transducer import byte_alphabet
from .words import BASE_BYTE, BASE_WORD, GOLDEN, Slice, _byte_values, _span_hashes, mix64, text_slices

BLOCK_BYTES = 4 << 20  # of text
SLICE = 1 << 20  # bytes of text handled at once
RUN = 512  # segments encoded together
SEGMENTS = 200_000  # whose ids a worker keeps
WINDOWS = 200_000  # alignments after which a worker begins anew with its next block
SPACE_MARK = "▁"  # of sentencepiece

STORED = ("block bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
          "n_links array<bigint>, sha array<string>, n_windows array<int>, windows binary, held binary, links binary, "
          "pairs array<struct<pair: bigint, n: bigint>>")
STORED_NAMES = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "n_windows", "windows", "held", "links", "pairs"]
ALIGNED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
           "groups_sha256 string")


def _concat(parts: list, kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *parts]).astype(kind, copy=False)


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + size[0] - 1, start[1] .. and so on."""
    total = np.cumsum(size)
    return np.repeat(start - (total - size), size) + np.arange(total[-1] if len(total) else 0)


def joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    count = np.array([len(x) for x in lists], np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int32, int(count.sum())), count


def packed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, compressed by bytes of equal weight."""
    return struct.pack("<q", len(values)) + pa.compress(
        values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = struct.unpack_from("<q", data)[0]
    planes = pa.decompress(data[8:], 4 * n, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).reshape(-1).view("<u4")


class Vocabulary:
    """The bytes of each id, in one buffer."""

    def __init__(self, words: list[bytes]):
        self.size = np.array([len(w) for w in words], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(words), np.uint8)
        self.marked = np.array([w[:1] == b" " for w in words])

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[spans(self.start[ids], self.size[ids])]


class BytePairs:
    """A byte-level tokenizers file; strings of special tokens are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        alphabet = byte_alphabet()
        words = [b""] * self.tokenizer.get_vocab_size()
        for token, i in json.loads(open(path, encoding="utf-8").read())["model"]["vocab"].items():
            words[i] = bytes(alphabet[c] for c in token)
        self.vocabulary = Vocabulary(words)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return joined([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of segments, and the number of each one's. Segments that end in visible ASCII are
        encoded many at once: each begins with a space, where the one before it ends for certain."""
        plain = np.array(["!" <= t[-1] <= "~" for t in texts])
        count = np.zeros(len(texts), np.int64)
        together = list(compress(texts, plain))
        runs = ["".join(together[k:k + RUN]) for k in range(0, len(together), RUN)]
        ids, _ = self._ids(runs)
        own, count[~plain] = self._ids(list(compress(texts, ~plain)))
        ends = np.cumsum([len(t.encode()) for t in together])
        last = np.searchsorted(np.cumsum(self.vocabulary.size[ids]), ends) + 1 if len(together) else np.zeros(0, np.int64)
        count[plain] = np.diff(last, prepend=0)
        out = np.zeros(len(ids) + len(own), np.int32)
        from_runs = np.repeat(plain, count)
        out[from_runs], out[~from_runs] = ids, own
        return out, count


class Pieces:
    """A sentencepiece model with byte fallback, which puts a space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        words, names = [], [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        for i, piece in enumerate(names):
            words.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
                         else piece.replace(SPACE_MARK, " ").encode())
        if any(SPACE_MARK in piece.lstrip(SPACE_MARK) for piece in names):
            raise ValueError(f"{path}: pieces that go on after a space can't be encoded by segments")
        self.vocabulary = Vocabulary(words)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts that begin with the space that the model adds, and the number of each one's."""
        return joined(self.model.encode([t[1:] for t in texts], num_threads=1))


class Flat:
    """Lists of ids by number, in one growing array."""

    def __init__(self):
        self.size, self.n = np.zeros(1024, np.int64), 0
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0

    def extend(self, ids: np.ndarray, size: np.ndarray) -> None:
        total = len(ids)
        while self.n + len(size) > len(self.size):
            self.size = np.concatenate((self.size, np.zeros_like(self.size)))
        while self.used + total > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.size[self.n:self.n + len(size)] = size
        self.ids[self.used:self.used + total] = ids
        self.n, self.used = self.n + len(size), self.used + total
        self.start = np.cumsum(self.size[:self.n]) - self.size[:self.n]

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of these numbers joined, and the size of each."""
        size = self.size[numbers]
        return self.ids[spans(self.start[numbers], size)], size


def segment_starts(data: np.ndarray, text_start: np.ndarray) -> np.ndarray:
    """Where texts (each with a space before it) may be cut so that both tokenizers give the ids of
    the whole text: at a text's start, and before a space after a character known to be no space
    (ASCII above 0x20, two bytes from U+00C0, three from U+4000, four). There a piece of the split
    pattern ends whatever follows, and no sentencepiece piece goes on."""
    n = len(data)
    lead2, lead3, lead4 = (data >= 0xC3) & (data <= 0xDF), (data >= 0xE4) & (data <= 0xEF), data >= 0xF0
    solid = (data > 0x20) & (data < 0x80)  # the last byte of such a character
    for k, lead in ((1, lead2), (2, lead3), (3, lead4)):
        solid[k:] |= lead[:n - k]
    cut = np.zeros(n, bool)
    cut[1:] = solid[:-1] & (data[1:] == 0x20)
    cut[np.append(text_start[1:], n)[:len(text_start)] - 1] = False  # a last space alone would encode to nothing
    cut[text_start] = True
    return np.flatnonzero(cut)


class Tokens:
    """Ids of several texts in a row, with the bytes they start and end at."""

    def __init__(self, ids: np.ndarray, count: np.ndarray, vocabulary: Vocabulary):
        self.ids, self.count, self.vocabulary = ids, count, vocabulary
        size = vocabulary.size[ids]
        self.end = np.cumsum(size)
        self.start = self.end - size
        self.first = np.cumsum(count) - count


class Pair:
    """Both tokenizers, with the ids of segments of texts met before (``SEGMENTS`` at most)."""

    def __init__(self, path_a: str, path_b: str):
        self.sides = BytePairs(path_a), Pieces(path_b)
        self.names = [str(i) for i in range(max(len(x.vocabulary.size) for x in self.sides))]
        self.memo = Memo(self.names)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.good = np.zeros(0, bool)
        self.flat = Flat(), Flat()

    def _learn(self, segments: list[bytes]) -> None:
        texts, good = [x.decode() for x in segments], np.ones(len(segments), bool)
        want = np.frombuffer(b"".join(segments), np.uint8)
        size = np.array([len(x) for x in segments], np.int64)
        for side, flat in zip(self.sides, self.flat):
            ids, count = side.encode(texts)
            flat.extend(ids, count)
            good &= given_back(side.vocabulary, ids, count, want, size)
        self.good = np.concatenate((self.good, good))
        self.known.update(zip(segments, range(len(self.known), len(self.known) + len(segments))))

    def encode(self, s: Slice) -> tuple[np.ndarray, Tokens, Tokens]:
        """The texts of a slice whose tokens give back space and text, and their tokens."""
        rows = np.flatnonzero(np.diff(s.offsets))
        data = np.insert(s.data, s.offsets[rows], np.uint8(0x20))
        text_start = s.offsets[rows] + np.arange(len(rows))
        start = segment_starts(data, text_start)
        end = np.append(start[1:], len(data))
        _, at, which = np.unique(_span_hashes(_byte_values()[data], start, end, BASE_BYTE),
                                 return_index=True, return_inverse=True)
        raw = data.tobytes()
        segments = [raw[x:y] for x, y in zip(start[at].tolist(), end[at].tolist())]
        new = [x for x in segments if x not in self.known]
        if len(self.known) + len(new) > SEGMENTS:
            self._forget()
            new = segments
        if new:
            self._learn(new)
        number = np.fromiter(map(self.known.__getitem__, segments), np.int64, len(segments))[which]
        first = np.searchsorted(start, text_start)
        if len(rows):
            good = np.logical_and.reduceat(self.good[number], first)
            if not good.all():
                number = number[np.repeat(good, np.diff(np.append(first, len(number))))]
                rows, first = rows[good], np.diff(np.append(first, len(start)))[good]
                first = np.cumsum(first) - first
        tokens = []
        for side, flat in zip(self.sides, self.flat):
            ids, size = flat.take(number) if len(number) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
            count = np.add.reduceat(size, first) if len(rows) else np.zeros(0, np.int64)
            tokens.append(Tokens(ids, count, side.vocabulary))
        return rows, *tokens


def given_back(vocabulary: Vocabulary, ids: np.ndarray, count: np.ndarray, want: np.ndarray,
               size: np.ndarray) -> np.ndarray:
    """Which texts (none empty, ``size`` bytes of ``want`` each) their ``count`` ids' bytes make."""
    begin = np.cumsum(count) - count
    total = np.concatenate(([0], np.cumsum(vocabulary.size[ids])))
    good = total[begin + count] - total[begin] == size
    ids = ids[np.repeat(good, count)]
    have, want = vocabulary.joined(ids), want[np.repeat(good, size)]
    part = size[good]
    if len(part):
        good[good] = np.add.reduceat(have != want, np.cumsum(part) - part, dtype=np.int64) == 0
    return good


_LOADED: dict[tuple[str, str], Pair] = {}


def tokenizers(path_a: str, path_b: str) -> Pair:
    """One pair per worker process."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Pair(path_a, path_b)
    return _LOADED[path_a, path_b]


class Memo:
    """Alignments of windows by their id tuples, numbered in the order of learning."""

    def __init__(self, names: list[str]):
        self.names = names  # of ids, in decimal
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.text: list[str] = []  # of each window's groups
        self.n_groups = self.n_links = np.zeros(0, np.int64)
        self.links = np.zeros(0, np.int64)

    def windows(self, a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """The number of each window, and each text's first window."""
        n = int(a.end[-1])
        begins = np.zeros(n + 1, np.uint8)  # space-marked tokens or texts begin: 1 on either side
        ends = np.zeros(n + 1, np.uint8)  # tokens end
        for side, bit in ((a, 1), (b, 2)):
            mark = side.vocabulary.marked[side.ids]
            mark[side.first] = True
            begins[side.start[mark]] |= bit
            ends[side.end] |= bit
        first = [np.flatnonzero((begins == 3)[side.start]) for side in (a, b)]
        return self._numbers(a, b, *first, ends == 3), np.searchsorted(first[0], a.first)

    def _numbers(self, a: Tokens, b: Tokens, first_a, first_b, shared: np.ndarray) -> np.ndarray:
        spans_, hashes = [], []
        for side, first in ((a, first_a), (b, first_b)):
            end = np.append(first[1:], len(side.ids))
            spans_.append((first, end))
            hashes.append(_span_hashes(mix64((side.ids.astype(np.uint64) + np.uint64(1)) * np.uint64(GOLDEN)),
                                       first, end, BASE_WORD))
        _, at, which = np.unique(mix64(hashes[0] * np.uint64(GOLDEN)) ^ hashes[1], return_index=True, return_inverse=True)
        raw_a, raw_b = a.ids.tobytes(), b.ids.tobytes()
        cuts = [(4 * x[at]).tolist() for pair in spans_ for x in pair]
        keys = [raw_a[p:q] + b"|||" + raw_b[r:t] for p, q, r, t in zip(*cuts)]
        number = np.array([self.number.get(key, -1) for key in keys], np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            new = new[np.argsort(at[new])]  # in order of position
            number[new] = len(self.number) + np.arange(len(new))
            for i in new.tolist():
                self.number[keys[i]] = len(self.number)
            self._align(a, b, *[x[at[new]] for pair in spans_ for x in pair], shared)
        return number[which]

    def _align(self, a: Tokens, b: Tokens, a0, a1, b0, b1, shared: np.ndarray) -> None:
        """Groups and links of new windows, given by their first and last tokens, in ascending order."""
        ta, tb = spans(a0, a1 - a0), spans(b0, b1 - b0)
        lo = np.searchsorted(b.end[tb], a.start[ta], "right")
        n = np.searchsorted(b.start[tb], a.end[ta], "left") - lo
        mate = tb[spans(lo, n)]
        window = np.cumsum(a1 - a0) - (a1 - a0)
        self.links = np.concatenate((self.links, np.repeat(a.ids[ta].astype(np.int64), n) << 32 | b.ids[mate]))
        self.n_links = np.concatenate((self.n_links, np.add.reduceat(n, window)))
        # A group ends with each shared end; every window ends with one.
        in_window = np.add.reduceat(shared[a.end[ta]], window, dtype=np.int64)
        self.n_groups = np.concatenate((self.n_groups, in_window))
        cut_a, cut_b = ([0, *(np.flatnonzero(shared[t.end[x]]) + 1).tolist()] for t, x in ((a, ta), (b, tb)))
        text_a, text_b = (list(map(self.names.__getitem__, t.ids[x].tolist())) for t, x in ((a, ta), (b, tb)))
        groups = [",".join(text_a[x:y]) + "|" + ",".join(text_b[u:v])
                  for x, y, u, v in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]
        cut = [0, *np.cumsum(in_window).tolist()]
        self.text += [groups[x] if y == x + 1 else ";".join(groups[x:y]) for x, y in zip(cut, cut[1:])]


class Block:
    """Documents as sequences of the memo's windows."""

    def __init__(self, memo: Memo):
        self.memo = memo
        self.columns: dict[str, list] = {c: [] for c in ("n_a", "n_b", "n_groups", "n_links", "n_windows")}
        self.ids: list[pa.Array] = []
        self.sha: list[str] = []
        self.windows: list[np.ndarray] = []
        self.bytes = 0

    def add(self, s: Slice, ids: pa.Array, rows: np.ndarray, a: Tokens, b: Tokens) -> None:
        """The texts of a slice; ``rows`` of them have tokens."""
        self.bytes += len(s.data)
        self.ids.append(ids)
        count = {c: np.zeros(s.rows, np.int64) for c in self.columns}
        sha = [""] * s.rows
        if len(rows):
            number, first = self.memo.windows(a, b)
            count["n_a"][rows], count["n_b"][rows] = a.count, b.count
            count["n_windows"][rows] = np.diff(np.append(first, len(number)))
            count["n_groups"][rows] = np.add.reduceat(self.memo.n_groups[number], first)
            count["n_links"][rows] = np.add.reduceat(self.memo.n_links[number], first)
            self.windows.append(number.astype(np.uint32))
            text, cut = list(map(self.memo.text.__getitem__, number.tolist())), [*first.tolist(), len(number)]
            for row, x, y in zip(rows.tolist(), cut, cut[1:]):
                sha[row] = hashlib.sha256(";".join(text[x:y]).encode()).hexdigest()
        for c, x in count.items():
            self.columns[c].append(x)
        self.sha += sha

    def row(self, block: int) -> pa.RecordBatch:
        held, windows, times = np.unique(_concat(self.windows, np.uint32), return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")  # frequent windows get small numbers
        held, times, rank = held[order], times[order], np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        size = self.memo.n_links[held]
        start = np.cumsum(self.memo.n_links) - self.memo.n_links
        pairs, link = np.unique(self.memo.links[spans(start[held], size)], return_inverse=True)
        n = np.bincount(link, np.repeat(times, size), len(pairs)).astype(np.int64)  # less than 2**53

        def one(values) -> pa.Array:
            values = values if isinstance(values, pa.Array) else pa.array(values)
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        binary = [pa.array([packed(x)], pa.binary()) for x in (rank[windows], size, link)]
        counts = {c: _concat(x, np.int64) for c, x in self.columns.items()}
        return pa.RecordBatch.from_arrays(
            [pa.array([block]), one(pa.concat_arrays(self.ids)),
             *(one(counts[c]) for c in ("n_a", "n_b", "n_groups", "n_links")),
             one(pa.array(self.sha, pa.string())), one(counts["n_windows"].astype(np.int32)), *binary,
             one(pa.StructArray.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"]))],
            STORED_NAMES)


def store_alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``STORED``: the documents' alignments by block, written in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair = tokenizers(path_a, path_b)
        number, block = TaskContext.get().partitionId() << 32, Block(pair.memo)
        for batch in batches:
            for s in text_slices(batch.column(1), limit=SLICE):
                if block.bytes and block.bytes + len(s.data) > BLOCK_BYTES:
                    yield block.row(number)
                    if len(pair.memo.number) > WINDOWS:
                        pair.memo.forget()
                    number, block = number + 1, Block(pair.memo)
                block.add(s, batch.column(0).slice(s.lo, s.rows), *pair.encode(s))
        if block.ids:
            yield block.row(number)
        if len(pair.memo.number) > WINDOWS:
            pair.memo.forget()

    return materialize(docs.mapInArrow(run, STORED), "alignments")


def pair_counts(stored: DataFrame) -> DataFrame:
    """(pair, n, best): how many links hold an id pair, and whether no pair of its second id has more."""
    counts = stored.select(F.inline("pairs")).groupBy("pair").agg(F.sum("n").alias("n"))
    second = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))  # an entry per first id at most
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(second)).alias("best"))


def _figures(left: pa.Table, right: pa.Table) -> pa.Table:
    """``ALIGNED`` of a block, from its row and the corpus-wide counts of its pairs."""
    flat = {c: left.column(c).combine_chunks().flatten() for c in
            ("doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "n_windows")}
    windows, held, links = (unpacked(left.column(c)[0].as_py()) for c in ("windows", "held", "links"))
    first = np.append(0, np.cumsum(held, dtype=np.int64))
    at = right.column("pos").to_numpy()
    n, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    n[at], best[at] = right.column("n").to_numpy(), right.column("best").to_numpy()
    size = flat["n_windows"].to_numpy().astype(np.int64)
    begin = np.cumsum(size) - size
    out = []
    for value in (best, n):
        sums = np.concatenate(([0], np.cumsum(value[links])))
        per_window = sums[first[1:]] - sums[first[:-1]]
        total = np.concatenate(([0], np.cumsum(per_window[windows])))
        out.append(pa.array(total[begin + size] - total[begin]))
    return pa.Table.from_arrays([flat[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")] + out + [flat["sha"]],
                                [f.split()[0] for f in ALIGNED.split(", ")])


def align_tokenizers(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ALIGNED`` of every row: tokens of both kinds, groups, links, links whose id pair is the
    corpus-wide best of its second id, the sum of the links' corpus-wide counts, and the groups' hash."""
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    stored = store_alignments(docs, path_a, path_b)
    held = stored.select(F.col("block").alias("of"), F.posexplode("pairs.pair").alias("pos", "held"))
    counts = pair_counts(stored)
    answers = held.join(counts, F.col("held") == F.col("pair")).select("of", "pos", "n", "best")
    return stored.drop("pairs").groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_figures, ALIGNED)
