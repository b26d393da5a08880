"""Token counts by a tokenizer compiled to a finite-state transducer.

A byte-level BPE file is compiled to one deterministic transducer that reads a text's bytes and
annotates every transition with the tokens it emits. Its state has two parts:

* where the split pattern stands: no piece open, a piece of letters, of digits or of other
  characters, a run of white space (whose last character may belong to the next piece), or the
  start of a contraction;
* the merges inside the open piece. Encoding a prefix gives one last token for every position, and
  a token may follow another exactly if the two encode to themselves when joined. So the state holds,
  for each position from which some token may still reach further, the node of the token trie, the
  last token before the position and the tokens up to it, less those emitted already. A transition
  emits what all these positions have in common; the end of a piece emits the rest.

States and transitions are made when a text first needs them and kept in one table, which is begun anew
between two windows of symbols once ``STATES`` rows are nearly used, so a transition costs one look-up.

Texts are run in data-parallel chunks. All texts of a slice, each closed by an end symbol, are cut
into ``LANES`` chunks of equal length that advance in lockstep. A chunk's map sends states in which it
may be entered to states in which it is left and the emitted counts. At first a map knows one entry,
the state that the ``WARM`` symbols before it lead to; maps compose by a parallel prefix scan, and
where an entry that a predecessor leads to is missing from a map, the map is extended and the scan
repeated. So results are exact wherever chunks are cut, within words, characters and texts.

Rows: null and empty texts have no bytes and no tokens; texts of any length are counted whole;
repeated rows and rows without an id are counted as they come; an empty table gives an empty
result. Special tokens are found inside texts as the library finds them. Only id and text are read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Slice, text_slices

LIMIT = 1024  # tokens of a document that is not over the limit
LANES = 2048  # chunks that advance together
LEAST_CHUNK = 128  # symbols
WINDOW = LANES * 2048  # symbols run at once
WARM = 48  # symbols before a chunk that guess its entry
STATES = 1 << 18  # rows of the table
COLUMNS = 32  # columns of the table that are added at once
LETTER, NUMBER, SPACE, OTHER = range(4)
LEAD, END, SPECIAL = 256, 512, 513  # symbols: bytes, lead bytes by class, end of a text, special tokens
TEXT_END = 0xFF  # no byte of UTF-8

COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"

Config = tuple[tuple[int, int, int], ...]  # (trie node, token before it, tokens before it)


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for
    themselves, the others in ascending order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Merges:
    """The merges inside one piece, as configurations that read a byte each."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        alphabet = byte_alphabet()
        self.bytes = {i: bytes(alphabet[c] for c in t) for t, i in vocabulary.items()
                      if all(c in alphabet for c in t)}
        self.single = {b[0]: i for i, b in self.bytes.items() if len(b) == 1}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for k, merge in enumerate(merges):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.rank[vocabulary[a], vocabulary[b]] = (k, vocabulary[a + b])
        self.child: dict[int, int] = {}  # node * 256 + byte
        self.token, self.inner = [-1], [False]
        for i, word in self.bytes.items():
            if self.encode(word) != [i]:
                continue  # merges never end in this token
            node = 0
            for b in word:
                key = node << 8 | b
                self.inner[node] = True
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                node = self.child[key]
            self.token[node] = i
        self.forget()

    def forget(self) -> None:
        self.follows: dict[tuple[int, int], bool] = {}

    def encode(self, word: bytes) -> list[int]:
        ids = [self.single[b] for b in word]
        none = (len(self.rank), 0)
        while len(ids) > 1:
            (rank, made), at = min((self.rank.get(pair, none), k) for k, pair in enumerate(zip(ids, ids[1:])))
            if rank == len(self.rank):
                break
            ids[at:at + 2] = [made]
        return ids

    def may_follow(self, a: int, b: int) -> bool:
        known = self.follows.get((a, b))
        if known is None:
            known = self.follows[a, b] = a < 0 or self.encode(self.bytes[a] + self.bytes[b]) == [a, b]
        return known

    EMPTY: Config = ((0, -1, 0),)

    def read(self, config: Config, byte: int) -> tuple[Config, int]:
        """The next configuration, and the tokens that are certain by now."""
        open_, last = [], None
        for node, before, n in config:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            token = self.token[node]
            if last is None and token >= 0 and self.may_follow(before, token):
                last = (0, token, n + 1)
            if self.inner[node]:
                open_.append((node, before, n))
        open_.append(last)
        sure = min(n for _, _, n in open_)
        return tuple((node, before, n - sure) for node, before, n in open_), sure

    def read_all(self, config: Config, data: bytes) -> tuple[Config, int]:
        total = 0
        for b in data:
            config, n = self.read(config, b)
            total += n
        return config, total

    @staticmethod
    def rest(config: Config) -> int:
        """Tokens that the end of the piece makes certain."""
        return config[-1][2]


class Transducer:
    """A tokenizers file of byte-level BPE with the library's own split pattern."""

    # Where the pattern stands.
    FREE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, QUOTE = range(6)
    IN = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}
    # Fixed values of the split pattern: what follows the quote of a contraction.
    ONE, TWO = b"stmd", {b"r": b"e", b"v": b"e", b"l": b"l"}

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers

        spec = json.loads(open(path, encoding="utf-8").read())
        pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
        plain = all(not model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                               "fuse_unk", "byte_fallback", "ignore_merges"))
        added = spec.get("added_tokens") or []
        if (model.get("type") != "BPE" or not plain or spec.get("normalizer") or pre.get("type") != "ByteLevel"
                or not pre.get("use_regex", True) or pre.get("add_prefix_space", True)
                or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)):
            raise ValueError(f"{path}: only plain byte-level BPE can be compiled")
        names = sorted((t["content"].encode() for t in added), key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, names))) if names else None
        self.special_number = {name: k for k, name in enumerate(names)}
        self.pieces = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
        self.merges = Merges(model["vocab"], model["merges"])
        self.classes = np.full(0x110000, 0xFF, np.uint8)
        self.classes[:128] = OTHER
        self.classes[[*b" \t\n\v\f\r"]] = SPACE
        self.classes[[*b"0123456789"]] = NUMBER
        self.classes[[c for c in range(128) if chr(c).isalpha()]] = LETTER
        self._forget()

    def _forget(self) -> None:
        self.merges.forget()
        self.number: dict[tuple, int] = {}
        self.state: list[tuple] = []
        self.column = np.full(SPECIAL + len(self.special_number), -1, np.int64)
        self.symbol: list[int] = []
        self.table = np.full((1024, COLUMNS), -1, np.int32)
        self.start = self._state((self.FREE, None, b""))

    def _state(self, state: tuple) -> int:
        k = self.number.get(state)
        if k is None:
            k = self.number[state] = len(self.state)
            self.state.append(state)
            if k == len(self.table):
                self.table = np.concatenate((self.table, np.full_like(self.table, -1)))
        return k

    # -- transitions ---------------------------------------------------------------------

    def _begin(self, symbol: int) -> tuple[tuple, int]:
        """A piece that a character's first byte begins."""
        byte, kind = self._character(symbol)
        if kind == SPACE:
            return (self.IN_SPACE, self.merges.EMPTY, bytes([byte])), 0
        config, n = self.merges.read(self.merges.EMPTY, byte)
        return (self.QUOTE if byte == 0x27 else self.IN[kind], config, b""), n

    def _character(self, symbol: int) -> tuple[int, int]:
        """First byte and class of a character."""
        if symbol >= LEAD:
            return 0xC0 + (symbol - LEAD >> 2), symbol - LEAD & 3
        return symbol, int(self.classes[symbol])

    def _closed(self, state: tuple) -> int:
        """Tokens emitted when the open piece ends."""
        where, config, held = state
        if where == self.FREE:
            return 0
        n = 0
        if where == self.IN_SPACE or where == self.QUOTE and not held:
            config, n = self.merges.read_all(config, held)
        elif where == self.QUOTE:  # no contraction: the quote, then letters
            letters, more = self.merges.read_all(self.merges.EMPTY, held)
            n = more + self.merges.rest(letters)
        return n + self.merges.rest(config)

    def transition(self, state: tuple, symbol: int) -> tuple[tuple, int]:
        """The state after a symbol, and the tokens emitted."""
        where, config, held = state
        if symbol >= END:
            return (self.FREE, None, b""), self._closed(state) + (symbol > END)
        if 0x80 <= symbol < LEAD:  # a later byte of a character
            if where == self.FREE:  # only where a guess begins inside a character
                return state, 0
            if where == self.IN_SPACE:
                return (where, config, held + bytes([symbol])), 0
            config, n = self.merges.read(config, symbol)
            return (where, config, held), n
        if where == self.FREE:
            return self._begin(symbol)
        byte, kind = self._character(symbol)
        if where == self.QUOTE:
            if held:
                if byte == self.TWO[held][0]:
                    config, n = self.merges.read_all(config, held + bytes([byte]))
                    return (self.FREE, None, b""), n + self.merges.rest(config)
                emitted = self.merges.rest(config)
                config, n = self.merges.read_all(self.merges.EMPTY, held)
                state, more = self.transition((self.IN_LETTERS, config, b""), symbol)
                return state, emitted + n + more
            if byte in self.ONE:
                config, n = self.merges.read(config, byte)
                return (self.FREE, None, b""), n + self.merges.rest(config)
            if bytes([byte]) in self.TWO:
                return (where, config, bytes([byte])), 0
            where = self.IN_OTHERS
        if where == self.IN_SPACE:
            if kind == SPACE:
                config, n = self.merges.read_all(config, held)
                return (where, config, bytes([byte])), n
            emitted = self.merges.rest(config)
            if held == b" ":
                config, n = self.merges.read_all(self.merges.EMPTY, held + bytes([byte]))
                return (self.IN[kind], config, b""), emitted + n
            config, n = self.merges.read_all(self.merges.EMPTY, held)
            state, more = self._begin(symbol)
            return state, emitted + n + self.merges.rest(config) + more
        if self.IN.get(kind) == where:
            config, n = self.merges.read(config, byte)
            return (where, config, b""), n
        state, n = self._begin(symbol)
        return state, self.merges.rest(config) + n

    def _learn(self, states: np.ndarray, columns: np.ndarray) -> None:
        width = self.table.shape[1]
        for key in np.unique(states.astype(np.int64) * width + columns).tolist():
            state, column = divmod(key, width)
            after, n = self.transition(self.state[state], self.symbol[column])
            if n > 0xFF:
                raise ValueError("a transition emits more tokens than a byte can count")
            k = self._state(after)  # may move the table
            self.table[state, column] = k << 8 | n

    # -- symbols -------------------------------------------------------------------------

    def _class(self, code: int) -> int:
        """The class that the library's split pattern gives a character."""
        c = chr(code)
        for kind, friend in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(self.pieces(friend + c)) == 1:
                return kind
        return SPACE

    def symbols(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of a slice's texts, and the first one of each text."""
        data = np.insert(s.data, s.offsets[1:], np.uint8(TEXT_END))
        first = s.offsets[:-1] + np.arange(s.rows)
        symbol = data.astype(np.uint16)
        symbol[data == TEXT_END] = END
        at = np.flatnonzero((data >= 0xC0) & (data != TEXT_END))
        if len(at):
            lead = data[at].astype(np.int64)
            size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
            code = lead & (0x7F >> size)
            for k in (1, 2, 3):
                more = size > k
                code[more] = code[more] << 6 | data[at[more] + k] & 0x3F
            kind = self.classes[code]
            for c in np.unique(code[kind == 0xFF]).tolist():
                self.classes[c] = self._class(c)
            symbol[at] = LEAD + ((lead - 0xC0) << 2) + self.classes[code]
        if self.special is not None:
            keep = None
            for m in self.special.finditer(data.tobytes()):
                keep = np.ones(len(symbol), bool) if keep is None else keep
                symbol[m.start()] = SPECIAL + self.special_number[m.group()]
                keep[m.start() + 1:m.end()] = False
            if keep is not None:
                before = np.concatenate(([0], np.cumsum(keep)))
                symbol, first = symbol[keep], before[first]
        return symbol, first

    def _columns(self, symbol: np.ndarray) -> np.ndarray:
        for x in np.flatnonzero(np.bincount(symbol, minlength=len(self.column))).tolist():
            if self.column[x] < 0:
                self.column[x] = len(self.symbol)
                self.symbol.append(x)
        if (more := len(self.symbol) - self.table.shape[1]) > 0:
            more = -(-more // COLUMNS) * COLUMNS
            self.table = np.concatenate((self.table, np.full((len(self.table), more), -1, np.int32)), axis=1)
        return self.column[symbol]

    # -- runs ----------------------------------------------------------------------------

    def _advance(self, states: np.ndarray, columns: np.ndarray, emitted: np.ndarray | None = None) -> np.ndarray:
        """All lanes in lockstep: ``columns`` and ``emitted`` have a row for each step."""
        table, width = self.table.reshape(-1), self.table.shape[1]
        for k in range(len(columns)):
            at = states * width + columns[k]
            value = table[at]
            if value.min() < 0:
                new = np.flatnonzero(value < 0)
                self._learn(states[new], columns[k][new])
                table = self.table.reshape(-1)
                value = table[at]
            if emitted is not None:
                emitted[k] = value & 0xFF
            states = value >> 8
            states = states.astype(np.int64)
        return states

    def emitted(self, symbol: np.ndarray) -> np.ndarray:
        """The tokens that each symbol emits. The symbols hold whole texts, each with its end."""
        out, state = np.zeros(len(symbol), np.uint8), (self.FREE, None, b"")
        for lo in range(0, len(symbol), WINDOW):
            if len(self.state) > STATES * 9 // 10:
                self._forget()
            part = symbol[lo:lo + WINDOW]
            out[lo:lo + WINDOW], after = self._run(part, self._state(state))
            state = self.state[after]
        return out

    def _run(self, symbol: np.ndarray, state: int) -> tuple[np.ndarray, int]:
        """The tokens that each symbol emits from a state on, and the last chunk's exit (symbols
        that do not fill the chunks end with a text's end)."""
        size = max(LEAST_CHUNK, -(-len(symbol) // LANES))
        n = -(-len(symbol) // size)
        padded = np.full(n * size, END, symbol.dtype)
        padded[:len(symbol)] = symbol
        steps = np.ascontiguousarray(self._columns(padded).reshape(n, size).T)
        guess = np.full(n, self.start, np.int64)
        guess[0] = state
        if n > 1:
            guess[1:] = self._advance(guess[1:], np.ascontiguousarray(steps[size - WARM:, :-1]))
        counts = np.zeros((size, n), np.uint8)
        maps = ChunkMaps(guess, self._advance(guess, steps, counts))
        while True:
            chunk, entry = maps.missing()
            if not len(chunk):
                break
            maps.add(chunk, entry, self._advance(entry, np.ascontiguousarray(steps[:, chunk])))
        taken = maps.taken()
        again = np.flatnonzero(taken)  # chunks that are not entered as guessed
        if len(again):
            own = np.zeros((size, len(again)), np.uint8)
            self._advance(maps.entry[again, taken[again]], np.ascontiguousarray(steps[:, again]), own)
            counts[:, again] = own
        return counts.T.reshape(-1)[:len(symbol)], int(maps.exit[-1, taken[-1]])

    def count(self, s: Slice) -> np.ndarray:
        """Each text's number of tokens (every text has an end symbol, so none is left out)."""
        symbol, first = self.symbols(s)
        return np.add.reduceat(self.emitted(symbol), first, dtype=np.int64)


class ChunkMaps:
    """Partial maps of states, one per chunk: ``entry[c, k]`` leads to ``exit[c, k]``; entry 0 of the
    first chunk is the true one. -1 stands for no entry."""

    def __init__(self, entry: np.ndarray, exit: np.ndarray):
        self.entry, self.exit = entry[:, None], exit[:, None]

    def _links(self) -> np.ndarray:
        """Which entry of the next chunk each entry leads to (-1: missing or no entry)."""
        equal = (self.exit[:-1, :, None] == self.entry[1:, None, :]) & (self.entry[:-1, :, None] >= 0)
        return np.where(equal.any(2), equal.argmax(2), -1)

    def taken(self) -> np.ndarray:
        """The entry taken in each chunk, by a parallel prefix scan over compositions of the maps;
        -1 where the maps do not say."""
        links = self._links()
        n, width = links.shape
        # A column more that -1 points to and that stays.
        whole = np.concatenate((np.where(links < 0, width, links), np.full((n, 1), width)), axis=1)
        step = 1
        while step < n:
            whole = np.concatenate((whole[:step], np.take_along_axis(whole[step:], whole[:-step], axis=1)))
            step *= 2
        out = np.concatenate(([0], whole[:, 0]))
        return np.where(out == width, -1, out)

    def missing(self) -> tuple[np.ndarray, np.ndarray]:
        """(chunk, state): entries that a predecessor leads to and the map lacks; none once the maps
        say which entry is taken everywhere."""
        taken = self.taken()
        if (taken >= 0).all():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        links = self._links()
        chunk, k = np.nonzero((links < 0) & (self.entry[:-1] >= 0))
        pairs = np.unique(np.stack((chunk + 1, self.exit[chunk, k])), axis=1)
        return pairs[0], pairs[1]

    def add(self, chunk: np.ndarray, entry: np.ndarray, exit: np.ndarray) -> None:
        place = np.arange(len(chunk)) - np.searchsorted(chunk, chunk)  # chunks are ascending
        more = np.full((len(self.entry), int(place.max()) + 1), -1, np.int64)
        self.entry, self.exit = (np.concatenate((have, more), axis=1) for have in (self.entry, self.exit))
        width = self.entry.shape[1] - more.shape[1]
        self.entry[chunk, width + place] = entry
        self.exit[chunk, width + place] = exit


_COMPILED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The file's transducer; one per worker process."""
    if path not in _COMPILED:
        _COMPILED[path] = Transducer(path)
    return _COMPILED[path]


def count_tokens(df: DataFrame, tokenizer_path: str, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``COUNTS`` of every row: its bytes in UTF-8, its tokens, and whether they are over ``limit``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer_path)
        for batch in batches:
            for s in text_slices(batch.column(1)):
                n = machine.count(s)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.lo, s.rows), pa.array(np.diff(s.offsets).astype(np.int64)), pa.array(n),
                     pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(run, COUNTS)
