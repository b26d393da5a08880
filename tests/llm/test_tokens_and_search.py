"""Token counts, lexical search and tokenizer alignment against the libraries and brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lotwise.llm import alignment, lexical_search, token_transducer
from lotwise.llm.alignment import align_tokenizers
from lotwise.llm.lexical_search import rank_documents
from lotwise.llm.queries import tokenizer_path
from lotwise.llm.token_transducer import ChunkMaps, Transducer, byte_alphabet, count_tokens
from lotwise.llm.words import text_slices

DOCS = "doc_id bigint, text string, block bigint, n_tokens string, `row` int, `a.b` string, term int, score double"
EXTRA = (7, "x", 3, "dot", -1, 0.5)
PATH_A, PATH_B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")

ODD = ["", " ", "  ", "\n", "\n\nx", "don't we'll they've I'd 'real 're 'v 'l 'll's ''s '''t 'RE  'x\n\n foo\t bar  \n",
       "  x 　　y", "é à 日本語 テスト １２３ ٣ é x́", "x<|endoftext|>y <|endoftext|>", "<|endoftext|>",
       " '<|endoftext|>s", "'", "'r", "'r ", "'rx", "'r9", "'é", "-" * 300, " " * 300, "a" * 5000, "ß" * 999,
       "\U0001F600\U0001F600 👍🏽", "Ω≈ç√∫˜µ≤≥÷", "'l<|endoftext|>'ll", "\x00\x1f\x85z", "1٣a٣", "<|endoftext", "|>",
       "▁", "a▁b", "tail ", "tail  ", "<s> </s>", "\t\ttabs\t"]


def made(seed: int, n: int, alphabet: str, most: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, most))) for _ in range(n)]


def table(spark, texts, ids=None):
    rows = [(k if ids is None else ids[k], t, *EXTRA) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def counted(rows):
    return sorted(map(repr, rows))


# ---- token counts --------------------------------------------------------------------------


def library_counts(texts, special=True):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH_A)
    return [len(e.ids) for e in t.encode_batch_fast(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def machine():
    return Transducer(PATH_A)


def run(machine, texts):
    return np.concatenate([machine.count(s) for s in text_slices(pa.array(texts, pa.string()))]).tolist()


def test_counts_are_the_librarys(machine):
    texts = ODD + made(1, 4000, " 'stmdrevl\n\t0aé日!　́😀", 30)
    assert run(machine, texts) == library_counts(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), min_size=1, max_size=8))
def test_counts_of_any_text(machine, texts):
    assert run(machine, texts) == library_counts(texts)


def test_chunks_may_be_cut_anywhere(monkeypatch):
    """Tiny chunks, wrong guesses and a table that is begun anew give the same counts."""
    for name, value in (("LANES", 7), ("LEAST_CHUNK", 5), ("WINDOW", 7 * 33), ("WARM", 2), ("STATES", 500)):
        monkeypatch.setattr(token_transducer, name, value)
    texts = ODD + made(2, 300, " 'ablé日\n", 60)
    assert run(Transducer(PATH_A), texts) == library_counts(texts)


def test_transitions_emit_what_is_certain(machine):
    """Emitted counts never go back, and a text's are its tokens."""
    state, total = (machine.FREE, None, b""), 0
    for byte in b"certain's  things":
        state, n = machine.transition(state, byte)
        assert n >= 0
        total += n
    assert total + machine.transition(state, token_transducer.END)[1] == library_counts(["certain's  things"])[0]


def test_chunk_maps_compose():
    """The scan follows the true entry through all maps; a missing entry is named and can be added."""
    step = lambda c, s: (s * 3 + c) % 11
    entry = np.array([4, *[0] * 9])
    maps = ChunkMaps(entry, np.array([step(c, s) for c, s in enumerate(entry)]))
    rounds = 0
    while True:
        chunk, state = maps.missing()
        if not len(chunk):
            break
        maps.add(chunk, state, np.array([step(c, s) for c, s in zip(chunk, state)]))
        rounds += 1
    taken, s = maps.taken(), 4
    for c in range(10):
        assert maps.entry[c, taken[c]] == s
        s = step(c, s)
    assert rounds <= 9


def test_only_byte_level_files_compile():
    with pytest.raises(ValueError):
        Transducer(tokenizer_path("word_bpe_49k.json"))


def test_count_tokens(spark, empty):
    texts = ODD + [None, "same", "same", " ".join(made(3, 4000, "abcdef", 9))]
    ids = [None if k % 7 == 3 else k // 2 for k in range(len(texts))]
    got = count_tokens(table(spark, texts, ids), PATH_A)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len((t or "").encode()), n, n > 1024) for i, t, n in zip(ids, texts, library_counts([t or "" for t in texts]))]
    assert counted(tuple(r) for r in got.collect()) == counted(want)
    assert any(w[3] for w in want) and count_tokens(empty, PATH_A).count() == 0


# ---- lexical search ------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_ranking(docs, items, best=10):
    bags = [Counter(terms(t)) for _, t in docs]
    sizes = [sum(b.values()) for b in bags]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for (doc, _), bag, n in zip(docs, bags, sizes):
            score = 0
            for t in set(terms(text)) & set(bag):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * (100 - 90 + (90 * n * n_docs) // total)))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(found)[:best], 1)]
    return out


def corpus(n=400):
    r = random.Random(4)
    vocabulary = [f"w{k}" for k in range(60)] + ["Ünï", "日本", "x-y", "A1"]
    texts = [" ".join(r.choice(vocabulary) if r.random() < 0.7 else f"rare{r.randint(0, 300)}" for _ in range(r.randint(0, 40))) for _ in range(n)]
    texts += ["", None, "...", "w1 " * 3000, "w1 w2", "w1 w2", "W1 w2", "日本 ünï ÜNÏ"]
    return [(None if k % 97 == 5 else k // 2 if k > n else k, t) for k, t in enumerate(texts)]


def test_ranking(spark, monkeypatch):
    """Ties, repeated rows, rows without an id, bundles of few items and blocks of few documents."""
    monkeypatch.setattr(lexical_search, "BUNDLE_ITEMS", 4)
    docs = corpus()
    items = [(1, "w1 w2 w2 rare7"), (2, "W3, ünï! 日本"), (3, None), (4, ""), (None, "w5"), (5, "nowhere"), (6, "w1 w2"), (6, "w1 w2"),
             (7, "--"), (8, " ".join(t for t in [d[1] for d in docs[:30]] if t))]
    df = table(spark, [t for _, t in docs], [i for i, _ in docs])
    asked = spark.createDataFrame([(i, t, 3, 0.5) for i, t in items], "item_id bigint, text string, rank int, block double")
    got = rank_documents(df, asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = counted(brute_ranking(docs, items))
    assert counted(tuple(r) for r in got.collect()) == want
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 7)
    monkeypatch.setattr(lexical_search, "OWNERS", 2)
    assert counted(tuple(r) for r in rank_documents(df.repartition(5), asked).collect()) == want
    assert counted(tuple(r) for r in rank_documents(df, asked, best=2).collect()) == counted(brute_ranking(docs, items, 2))


def test_ranking_of_nothing(spark, empty):
    asked = spark.createDataFrame([(1, "w1"), (2, None)], "item_id bigint, text string")
    assert rank_documents(empty, asked).count() == 0
    assert rank_documents(table(spark, ["w1", "w2"]), asked.limit(0)).count() == 0
    assert rank_documents(table(spark, [None, "", ".."]), asked).count() == 0


def test_owners_are_dealt_by_rarity():
    holders = {k: k + 1 for k in range(100)}
    owner = lexical_search._deal(holders, 4)
    assert [owner[k] for k in range(100)] == sorted(owner.values()) and set(owner.values()) == {0, 1, 2, 3}
    load = Counter()
    for k, o in owner.items():
        load[o] += holders[k]
    assert max(load.values()) < 0.3 * sum(load.values())


# ---- alignment -----------------------------------------------------------------------------


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH_A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    alphabet, docs, counts = byte_alphabet(), [], Counter()

    def spans(parts):
        out, at = [], 0
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    for doc, text in rows:
        whole, pairs, groups, ids = (" " + (text or "")).encode(), [], [], ([], [])
        if text:
            ids = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            parts = ([bytes(alphabet[c] for c in t.id_to_token(i)) for i in ids[0]],
                     [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]])
            if b"".join(parts[0]) == b"".join(parts[1]) == whole:
                a, b = map(spans, parts)
                pairs = [(ids[0][i], ids[1][j]) for i, x in enumerate(a) for j, y in enumerate(b) if x[0] < y[1] and y[0] < x[1]]
                for end in sorted({e for _, e in a} & {e for _, e in b}):
                    begin = groups[-1][0] if groups else 0
                    groups.append((end, "|".join(",".join(str(i) for i, s in zip(side, at) if begin <= s[0] and s[1] <= end)
                                                 for side, at in zip(ids, (a, b)))))
            else:
                ids = ([], [])
        counts.update(pairs)
        docs.append((doc, len(ids[0]), len(ids[1]), pairs, ";".join(g for _, g in groups)))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(doc, a, b, g.count(";") + 1 if g else 0, len(p), sum(counts[x] == best[x[1]] for x in p), sum(counts[x] for x in p),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for doc, a, b, p, g in docs]


def test_alignment(spark, empty, monkeypatch):
    """Odd texts, repeated rows and rows without an id; small blocks and caches give the same."""
    texts = ODD[:19] + ["b" * 300] + ODD[21:] + made(6, 250, " ab'the\n\té日😀▁ <|endoftext|> \x00.", 40)
    texts += [None, "the same words", "the same words", "Plain English words, with marks. " * 40]
    ids = [None if k % 41 == 3 else k // 2 for k in range(len(texts))]
    want = counted(brute_alignment(list(zip(ids, texts))))
    df = table(spark, texts, ids)
    got = align_tokenizers(df, PATH_A, PATH_B)
    assert [c.split()[0] for c in alignment.ALIGNED.split(", ")] == got.columns
    assert counted(tuple(r) for r in got.collect()) == want
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 300)
    monkeypatch.setattr(alignment, "SLICE", 100)
    monkeypatch.setattr(alignment, "SEGMENTS", 50)
    monkeypatch.setattr(alignment, "WINDOWS", 20)
    assert counted(tuple(r) for r in align_tokenizers(df.repartition(5), PATH_A, PATH_B).collect()) == want
    assert align_tokenizers(empty, PATH_A, PATH_B).count() == 0


def test_windows_are_aligned_once():
    """A window met again, in whatever text, is looked up by its id tuples."""
    pair = alignment.Pair(PATH_A, PATH_B)
    block = alignment.Block(pair.memo)
    for texts in (["good words here", "good words there"], ["here good words there"]):
        for s in text_slices(pa.array(texts)):
            block.add(s, pa.array(range(s.rows)), *pair.encode(s))
    assert len(pair.memo.number) == 4 and sum(len(w) for w in block.windows) == 10
    windows = alignment.unpacked(block.row(0).column("windows")[0].as_py())
    assert len(windows) == 10 and len(set(windows.tolist())) == 4


def test_packed_numbers_round_trip():
    for values in ([], [0], [2 ** 32 - 1, 5, 70_000] * 99):
        assert alignment.unpacked(alignment.packed(np.array(values, np.int64))).tolist() == values
