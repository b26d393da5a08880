"""Token ids in fixed-width bit-packed files with random access.

File: magic; blocks of ``BLOCK_IDS`` ids, each id in the ``bits`` the vocabulary needs, low bit
first, each block starting on a byte; the block offsets; the documents' ids, null marks and end
positions; a footer of fixed size that tells where all this lies. Reading ids ``a:b`` touches only
their blocks and unpacks them with numpy.

Writing: one range shuffle by id, then each task encodes its texts as they come and appends
blocks, holding one slice of texts and the index of its file. A task's file has a name of its own
per attempt; only files that the manifest (a table Spark commits) names count, so a lost executor
or a task that runs twice leaves no wrong file in use.

Encoding: a byte-level tokenizer file whose pattern splits texts into pieces before merging lets
texts be cut where a piece ends for certain, and each distinct cut be encoded once per slice and
kept (``CACHE_CUTS`` at most) for later ones; the ids are those of the whole text. With any other
tokenizer file whole texts are encoded.

Rows: null text is empty and yields the end id alone; rows without an id come last; rows with the
same id follow one another, ordered by text; an empty table gives files of no documents.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .words import BASE_BYTE, Slice, _byte_values, _span_hashes, text_slices

MAGIC = b"LWTOKEN1"
BLOCK_IDS = 4096  # a multiple of 8, so a full block is whole bytes
FOOTER = struct.Struct("<QQQQQII8s")  # ids, docs, at: block offsets, doc index, null marks; bits, block; magic
CACHE_CUTS = 600_000
RUN = 512  # cuts encoded together
SLICE = 1 << 20
READ_DOCS = 4096  # documents read back at once

MANIFEST = "shard int, path string, n_docs bigint, n_ids bigint"
READ_BACK = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file that every executor can reach."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


# ---- bit packing ---------------------------------------------------------------------------


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    planes = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(planes[:, :bits].reshape(-1), bitorder="little").tobytes()


def unpack_ids(data: bytes, n: int, bits: int) -> np.ndarray:
    flat = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[:n * bits].reshape(n, bits)
    planes = np.zeros((n, 32), np.uint8)
    planes[:, :bits] = flat
    return np.packbits(planes, axis=1, bitorder="little").reshape(-1).view("<u4")


# ---- encoding ------------------------------------------------------------------------------


class Encoder:
    """Texts to ids by a tokenizers file; one per worker process."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(open(path, encoding="utf-8").read())
        pre = spec.get("pre_tokenizer") or {}
        self.cuts = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                     and pre.get("use_regex", True) and not pre.get("add_prefix_space", True))
        # Bytes of each id: a byte-level token has a character per byte.
        added = {t["id"]: len(t["content"].encode()) for t in spec.get("added_tokens") or []}
        self.bytes = np.zeros(max(self.tokenizer.get_vocab_size(), 1 + max(added, default=0)), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = added.get(i, len(token))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.sizes = np.zeros(1024, np.int64)
        self.starts = np.zeros(1024, np.int64)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of these texts, and the number of each one's."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.array([len(x) for x in ids], np.int64)
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum())), size

    def _encode_cuts(self, cuts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same of cuts. Those that begin with a space and end in visible ASCII are encoded many at
        once, as a piece ends for certain between two of them."""
        plain = np.array([c[0] == 0x20 and 0x20 < c[-1] < 0x7F for c in cuts], bool)
        together = list(compress(cuts, plain))
        ids, _ = self._encode_all([b"".join(together[k:k + RUN]).decode() for k in range(0, len(together), RUN)])
        size = np.zeros(len(cuts), np.int64)
        own, size[~plain] = self._encode_all([c.decode() for c in compress(cuts, ~plain)])
        if together:
            last = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum([len(c) for c in together])) + 1
            size[plain] = np.diff(last, prepend=0)
        out, from_runs = np.zeros(len(ids) + len(own), np.uint32), np.repeat(plain, size)
        out[from_runs], out[~from_runs] = ids, own
        return out, size

    def _learn(self, cuts: list[bytes]) -> None:
        ids, size = self._encode_cuts(cuts)
        k, n = len(self.known), len(self.known) + len(cuts)
        while n > len(self.sizes):
            self.sizes = np.concatenate((self.sizes, np.zeros_like(self.sizes)))
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.known.update(zip(cuts, range(k, n)))
        self.sizes[k:n], self.starts[k:n] = size, self.used + np.cumsum(size) - size
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def encode(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice, and each text's number of ids."""
        if not self.cuts:
            texts = [bytes(s.data[a:b]).decode() for a, b in zip(s.offsets[:-1], s.offsets[1:])]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return (np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64))
        start = safe_cuts(s)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(s.rows, np.int64)
        end = np.append(start[1:], len(s.data))
        _, at, which = np.unique(_span_hashes(_byte_values()[s.data], start, end, BASE_BYTE),
                                 return_index=True, return_inverse=True)
        raw = s.data.tobytes()
        cuts = [raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())]
        new = [c for c in cuts if c not in self.known]
        if len(self.known) + len(new) > CACHE_CUTS:
            self._forget()
            new = cuts
        self._learn(new)
        cut = np.fromiter(map(self.known.__getitem__, cuts), np.int64, len(cuts))[which]
        sizes = self.sizes[cut]
        total = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.starts[cut] - (total - sizes), sizes) + np.arange(total[-1])]
        row = np.searchsorted(s.offsets, start, "right") - 1
        return ids, np.bincount(row, sizes, s.rows).astype(np.int64)


def safe_cuts(s: Slice) -> np.ndarray:
    """Byte positions where a text can be cut for a byte-level pattern without changing its pieces.

    A piece holding a non-space character never ends in a space, and no rule looks to the left. So
    it is safe to cut before a space or line break after a character known to be no space (ASCII
    above 0x20, or a two-byte one from U+00C0 on); after a lone line break before such a one; and
    before ``.`` or ``,`` after a letter.
    """
    d = s.data
    n = len(d)
    cut = np.zeros(n + 1, bool)
    cut[s.offsets] = True
    if n:
        lead = (d >= 0xC3) & (d <= 0xDF)
        plain = (d > 0x20) & (d < 0x80)
        solid_end = plain.copy()  # the last byte of a character known to be no space
        solid_end[1:] |= lead[:-1]
        solid_start = plain | lead
        letter = ((d | 0x20) >= 0x61) & ((d | 0x20) <= 0x7A)
        letter[1:] |= (d[:-1] == 0xC3) & (d[1:] != 0x97) & (d[1:] != 0xB7)
        inner = np.zeros(n, bool)
        line = d == 0x0A
        inner[1:] = (solid_end[:-1] & ((d[1:] == 0x20) | line[1:])
                     | letter[:-1] & ((d[1:] == 0x2E) | (d[1:] == 0x2C)))
        inner[2:] |= solid_end[:-2] & line[1:-1] & solid_start[2:]
        starts = np.zeros(n + 2, bool)  # a line break that begins a text isn't preceded by this text
        starts[s.offsets] = True
        after_line = np.zeros(n, bool)
        after_line[1:] = line[:-1] & starts[:n - 1]
        cut[:n] |= inner & ~after_line
    cut[n] = False
    return np.flatnonzero(cut)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---- files ---------------------------------------------------------------------------------


class FileWriter:
    """Appends documents' ids; holds less than a block of ids, and the index."""

    def __init__(self, sink, bits: int):
        self.sink, self.bits = sink, bits
        self.at = self.sink.write(MAGIC)
        self.rest = np.zeros(0, np.uint32)
        self.blocks, self.ids, self.ends, self.null = [], [], [], []
        self.n = 0

    def append(self, ids: np.ndarray, doc_ids: np.ndarray, null: np.ndarray, sizes: np.ndarray) -> None:
        self.ids.append(doc_ids)
        self.null.append(null)
        self.ends.append(self.n + np.cumsum(sizes))
        self.n += len(ids)
        ids = np.concatenate((self.rest, ids))
        whole = len(ids) // BLOCK_IDS * BLOCK_IDS
        if whole:
            size = BLOCK_IDS * self.bits // 8
            self.blocks.append(self.at + size * np.arange(whole // BLOCK_IDS))
            self.at += self.sink.write(pack_ids(ids[:whole], self.bits))
        self.rest = ids[whole:]

    def close(self) -> tuple[int, int]:
        """Writes what is left, the index and the footer; numbers of documents and ids."""
        if len(self.rest):
            self.blocks.append(np.array([self.at]))
            self.at += self.sink.write(pack_ids(self.rest, self.bits))
        join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
        ids, ends, null = join(self.ids, "<i8"), join(self.ends, "<i8"), join(self.null, "u1")
        blocks_at = self.at
        self.at += self.sink.write(join(self.blocks, "<i8").tobytes())
        docs_at = self.at
        self.at += self.sink.write(ids.tobytes() + ends.tobytes())
        null_at = self.at
        self.sink.write(null.tobytes())
        self.sink.write(FOOTER.pack(self.n, len(ids), blocks_at, docs_at, null_at, self.bits, BLOCK_IDS, MAGIC))
        self.sink.close()
        return len(ids), self.n


class FileReader:
    """Random access to one file."""

    def __init__(self, uri: str):
        fs, path = open_fs(uri)
        self.file = fs.open_input_file(path)
        end = self.file.size()
        (self.n_ids, self.n_docs, blocks_at, docs_at, null_at, self.bits, self.block,
         magic) = FOOTER.unpack(self._bytes(end - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token file")
        self.offsets = np.frombuffer(self._bytes(blocks_at, docs_at - blocks_at), "<i8")
        index = np.frombuffer(self._bytes(docs_at, null_at - docs_at), "<i8")
        self.doc_ids, self.ends = index[:self.n_docs], index[self.n_docs:]
        self.null = np.frombuffer(self._bytes(null_at, self.n_docs), "u1").astype(bool)

    def _bytes(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids ``a:b``, from the blocks they lie in."""
        if a >= b:
            return np.zeros(0, "<u4")
        first, last = a // self.block, (b - 1) // self.block
        n = min(self.n_ids, (last + 1) * self.block) - first * self.block
        data = self._bytes(int(self.offsets[first]), -(-n * self.bits // 8))
        return unpack_ids(data, n, self.bits)[a - first * self.block:b - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


# ---- jobs ----------------------------------------------------------------------------------


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def write_token_files(df: DataFrame, folder: str, tokenizer_path: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every text, appends ``end_id`` to each, and writes the files into ``folder`` in
    ascending id order. Returns the manifest: shard, path, documents, ids, in order of shards."""
    spark = df.sparkSession
    bits = bits_for(max(encoder(tokenizer_path).tokenizer.get_vocab_size(), end_id + 1))
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = [F.asc_nulls_last("doc_id"), F.xxhash64("text"), F.col("text")]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        shard = context.partitionId()
        fs, root = open_fs(folder)
        name = f"tokens-{shard:06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.bin"
        fs.create_dir(root, recursive=True)
        writer = FileWriter(fs.open_output_stream(f"{root}/{name}"), bits)
        enc = encoder(tokenizer_path)
        for batch in batches:
            ids = batch.column(0)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for s in text_slices(batch.column(1), limit=SLICE):
                tokens, sizes = enc.encode(s)
                ends = np.cumsum(sizes)
                writer.append(np.insert(tokens, ends, end_id), ids[s.lo:s.hi], null[s.lo:s.hi], sizes + 1)
        n_docs, n_ids = writer.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([n_docs]), pa.array([n_ids])],
            ["shard", "path", "n_docs", "n_ids"])

    manifest = f"{folder}/manifest"
    (docs.repartitionByRange(*order[:2]).sortWithinPartitions(*order).mapInArrow(write, MANIFEST)
     .write.parquet(manifest))
    return spark.read.schema(MANIFEST).parquet(manifest).where("n_docs > 0")


def read_documents(manifest: DataFrame) -> DataFrame:
    """``READ_BACK`` of each document, from the files: its id, the ids of all documents before it,
    its own number of ids, and the crc32 of them as little-endian unsigned 32-bit integers."""
    # One row per file: the window runs over the list of files, not over documents.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                f = FileReader(path)
                ends = np.concatenate(([0], f.ends))
                for lo in range(0, f.n_docs, READ_DOCS):
                    hi = min(lo + READ_DOCS, f.n_docs)
                    crc = np.empty(hi - lo, np.int64)
                    at = lo
                    while at < hi:  # about a million ids at once, one document at least
                        to = max(at + 1, int(np.searchsorted(ends, ends[at] + (1 << 20), "right")) - 1)
                        to = min(to, hi)
                        ids = f.ids(int(ends[at]), int(ends[to])).tobytes()
                        cut = (4 * (ends[at:to + 1] - ends[at])).tolist()
                        view = memoryview(ids)
                        crc[at - lo:to - lo] = [zlib.crc32(view[a:b]) for a, b in zip(cut[:-1], cut[1:])]
                        at = to
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(f.doc_ids[lo:hi], mask=f.null[lo:hi]), pa.array(base + ends[lo:hi]),
                         pa.array(np.diff(ends[lo:hi + 1])), pa.array(crc)],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    return files.select("path", "base").repartition(n).mapInArrow(read, READ_BACK)


def token_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "token-files")
