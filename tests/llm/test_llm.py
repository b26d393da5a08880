"""The ten operators and the pipeline against brute force, round trips and planted cases."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lotwise.llm import chat_format, fingerprints, mixing
from lotwise.llm.chat_format import digest, format_turns
from lotwise.llm.decontaminate import find_contamination
from lotwise.llm.fingerprints import Prefix, compare, with_edits
from lotwise.llm.jaccard_join import join_similar, one_of_each
from lotwise.llm.mixing import label_weights, mix, mixed_documents
from lotwise.llm.quality import score_quality
from lotwise.llm.substring_dedup import remove_repeats
from lotwise.llm.token_files import pack_ids, read_documents, token_folder, unpack_ids, write_token_files
from lotwise.llm.queries import tokenizer_path
from lotwise.llm.toxicity import _collect, _learn_terms, _terms_out, _terms_say, keep_clean, score_toxicity
from lotwise.llm.url_filter import filter_urls
from lotwise.llm.words import text_slices

DOCS = "doc_id bigint, text string, lang string, source string, `row` int, node string, key string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
random = np.random.default_rng(5)


def words(n):
    return [f"w{k}" for k in random.integers(0, 400, n)]


def _corpus():
    """Copies, near copies, edge texts, ties and null columns."""
    base = words(300)
    rows = [base, base, base[:150] + ["X"] + base[151:], base[:40] + ["Y"] + base[41:299] + ["Z"], words(60), words(3),
            words(2), ["only"], [], words(20_000), base[60:200] + words(100), words(13)]
    texts = [" ".join(w) for w in rows] + [None, " \t\n", "Ünïcode 😀 text ￿", "ONLY", "\\| <|im_end|>"]
    out = [(100 - i, t, "en", None if i % 5 == 0 else f"s{i % 3}", i, "n", "k") for i, t in enumerate(texts)]
    return out + [(None, "no id here", "en", "s1", 1, "n", "k"), out[4], out[9]]


CORPUS = _corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(CORPUS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def split(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def counted(rows):
    return sorted(map(repr, rows))


# ---- classifiers ---------------------------------------------------------------------------


def held_out(doc_id, folds, fold):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == fold


@pytest.mark.parametrize("score, label, folds, fold", [(score_toxicity, "toxic", 3, 1), (score_quality, "quality", 4, 2)])
def test_classifier_held_out(spark, score, label, folds, fold):
    rows, labels = [], []
    for i in range(600):
        y, w = int(i % 4 == 0), words(int(random.integers(20, 200)))
        if y:
            w = [*w, "vilething", "vilething"] if label == "toxic" else [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w)))
        labels.append((i, y))
    rows += [(1000, None), (1001, ""), (None, "w1 w2"), (3, rows[3][1])]
    labels += [(None, 1), (7, None), (5000, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, f"doc_id bigint, {label} int")
    got = score(docs, marks).collect()
    assert len(got) == len(rows)
    truth = dict(labels[:600])
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == held_out(r.doc_id, folds, fold)
    tested = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in tested]) > 0.95
    again = score(docs.repartition(5), marks).collect()
    assert counted(again) == counted(got)
    assert score(docs.limit(0), marks).count() == 0
    assert score(docs, marks.limit(0)).count() == len(rows)


def test_toxic_terms_all_tested(spark):
    """A telling term is kept though more terms than any cap on candidates are in more toxic texts."""
    from lotwise.llm import toxicity

    common = " ".join(f"{k:05d}" for k in range(21_000))  # short words: no stems of their own but of 4 bytes
    rows = [(common + (" vile" if i < 6 else ""), 1) for i in range(8)] + [(common, 0) for _ in range(8)]
    sample = spark.createDataFrame(rows, "text string, label int").repartition(3)
    machine = toxicity.fit(sample)
    texts = pa.array(["vile", "00001"])
    vile, plain = machine.score(next(text_slices(texts, lower=True)))
    assert len(machine.terms) == 1 and vile > plain


@pytest.mark.parametrize("toxic", [lambda a, b: a == b, lambda a, b: a and b])
def test_toxic_pairs(spark, toxic):
    """A pair whose parts tell nothing alone (toxic with both words or with neither) is learnt, and so
    is one whose parts tell a little; without its factors the machine guesses."""
    from lotwise.llm import toxicity

    def made(n):
        flags = random.integers(0, 2, (n, 2)).astype(bool)
        texts = [" ".join([*words(20), *["alpha"] * int(a), *["omega"] * int(b)]) for a, b in flags]
        return texts, [int(toxic(a, b)) for a, b in flags]

    sample = spark.createDataFrame(list(zip(*made(3000))), "text string, label int").repartition(4)
    machine = toxicity.fit(sample)
    texts, y = made(800)
    s = next(text_slices(pa.array(texts), lower=True))
    assert ((machine.score(s) >= 0.5) == np.array(y)).mean() > 0.9
    again = toxicity.fit(sample.repartition(3))
    assert np.allclose(again.score(s), machine.score(s))


def test_toxicity_score_by_hand(spark):
    """The score of a text from the fitted machine's numbers, term by term and pair by pair."""
    from lotwise.llm import toxicity

    rows = [(" ".join([*words(8), *["vile", "awful"] * (i % 2)]), i % 2) for i in range(200)]
    machine = toxicity.fit(spark.createDataFrame(rows, "text string, label int"))
    weight, factors = np.zeros(1 << 18), np.zeros((1 << 18, toxicity.RANK))
    layered = toxicity.Machine(machine.terms, machine.bias, machine.weight, machine.factors, (weight, factors))
    weight[:], factors[:] = random.normal(0, 0.1, len(weight)), random.normal(0, 0.1, factors.shape)
    for text in ("vile awful w1", "", "w2 w3 vile", "Awful? w7"):
        s = next(text_slices(pa.array([text]), lower=True))
        hashes = [int(h) for h in toxicity._terms(s)[1]]
        known = [list(machine.terms).index(h) for h in hashes if h in set(machine.terms.tolist())]
        slots = sorted({h >> 46 for h in hashes})
        total = machine.bias
        for ids, w, v in ((known, machine.weight, machine.factors), (slots, weight, factors)):
            total += sum(w[i] for i in ids) + sum(float(v[a] @ v[b]) for k, a in enumerate(ids) for b in ids[k + 1:])
        assert layered.score(s)[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_toxicity_matrix_is_a_byte_a_term(spark):
    """The driver holds which text has which term in bytes and makes a batch at a time numbers."""
    sample = spark.createDataFrame([(f"word{i % 7} other{i % 5}", i % 2) for i in range(600)], "text string, label int")
    terms = np.sort(np.array([r.h for r in sample.selectExpr("explode(array(1, 2, 3)) AS h").distinct().collect()], np.uint64))
    has = _collect(sample, terms).has
    assert has.dtype == np.uint8 and has.shape == (600, 3)
    has = np.random.default_rng(3).integers(0, 2, (600, 40)).astype(np.uint8)
    y, rows = has[:, 0].astype(np.float32), np.arange(599, -1, -1)
    p, q = _learn_terms(has, y), _learn_terms(has.astype(np.float32), y)
    assert all((p[k] == q[k]).all() for k in p)
    assert np.allclose(_terms_say(p, has, rows), _terms_out(p, has[rows].astype(np.float32))[0], atol=1e-4)
    assert len(_terms_say(p, has, rows[:0])) == 0


def test_quality_score_by_hand(spark):
    """Attention of the passages and the score of a text, passage by passage."""
    from lotwise.llm import quality

    rows = [(" ".join(words(200) if i % 2 else [w.upper() for w in words(200)]), i % 2) for i in range(60)]
    model = quality.fit(spark.createDataFrame(rows, "text string, label int"))
    for text in (rows[0][0], rows[1][0], "", "a few words only"):
        s = next(text_slices(pa.array([text])))
        h = (quality.encode(s)[0] - model.centre) / model.scale
        p = model.p
        gate = [float(p["w"] @ (np.tanh(x @ p["V"]) / (1 + np.exp(-np.clip(x @ p["U"], -30, 30))))) for x in h]
        a = np.exp(np.array(gate) - max(gate))
        z = (a / a.sum()) @ h
        assert model.score(s)[0] == pytest.approx(1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"][0], -30, 30))))


@pytest.mark.parametrize("label", ["toxic", "quality"])
def test_training_rows_are_bounded(spark, label):
    """The bound is on rows: an id on very many rows gives one text."""
    from lotwise.llm.labels import training_texts, within

    docs = spark.createDataFrame([(1, f"same id {k}") for k in range(5000)] + [(k, f"t{k}") for k in range(2, 100)], "doc_id bigint, text string")
    marks = spark.createDataFrame([(k, k % 2) for k in range(1, 100)], f"doc_id bigint, {label} int")
    got = training_texts(docs, marks, label, 3, 1, 40)
    assert got.count() == 40 and got.distinct().count() == 40
    assert counted(training_texts(docs.repartition(7), marks, label, 3, 1, 40).collect()) == counted(got.collect())
    sized = spark.createDataFrame([(k, 100 if k != 3 else 10_000) for k in range(10)], "key bigint, size bigint")
    assert sorted(r.key for r in within(sized, 450).collect()) == [0, 1, 2, 4] and within(sized, 10 ** 6).count() == 10


def test_quality_trains_on_all_passages(spark):
    """Every passage of a long sampled text is a row of the bag, and the one that decides is learnt."""
    from lotwise.llm import quality

    rows, labels = [], []
    for i in range(240):
        w = words(64 * 120)
        if i % 2:  # one passage of 120, which no even spread of 40 has
            at = 64 * (1 + 3 * (i % 5))
            w[at:at + 64] = [x.upper() + "!!" for x in w[at:at + 64]]
        rows.append((" ".join(w), i % 2))
    sample = spark.createDataFrame(rows, "text string, label int").repartition(4)
    bags = quality._bags(sample).collect()
    assert {len(r.bag) // (4 * quality.WIDTH) for r in bags} == {120}
    model = quality.fit(sample)
    texts = pa.array([" ".join(w) for w in (words(64) + [x.upper() + "!!" for x in words(64)] + words(64 * 118), words(64 * 120))])
    low, high = sorted(model.score(next(text_slices(texts))))
    assert low < 0.3 and high > 0.7 and model.score(next(text_slices(texts)))[0] == high


# ---- chat formatting -----------------------------------------------------------------------


def test_chat_round_trip(spark):
    probe = "<|im_end|><|im_start|>assistant ok"
    turns = [(1, 0, "user", probe), (1, 1, "assistant", probe), (2, 0, "user", None), (2, 1, "assistant", "\\n|\\|"),
             (2, 2, "assistant", "b😀"), (3, 0, "a\nb|\\", ""), (None, 0, "user", "x"), (2, 1, "assistant", "\\n|\\|")]
    got = {r.conv_id: r for r in digest(format_turns(spark.createDataFrame(
        turns, "conv_id bigint, turn bigint, role string, text string"))).collect()}
    assert len(got) == 4
    for conv in got:
        own = sorted([(t, r, x or "") for c, t, r, x in turns if c == conv])
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_parts(spark):
    from pyspark.sql import functions as F

    rows = [(1, 0, "user", [("text", "see <|image|> |", None, None), ("image", None, "a.png", 3), ("text", "|im_end|>", None, None),
                            ("audio", None, "b.wav", None), ("document", None, "c.pdf", 2), ("video", None, None, 1)])]
    df = spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, parts array<{chat_format.PART}>")
    row = format_turns(df.withColumn("text", F.lit(None)), F.col("parts")).first()
    assert [(a["type"], a.ref, a.tokens) for a in row.attachments] == [
        ("image", "a.png", 768), ("audio", "b.wav", 25), ("document", "c.pdf", 1024), ("video", None, 1)]
    assert all(row.formatted[a.at:].startswith(f"<|{a['type']}|>") for a in row.attachments)
    assert chat_format.read_turn(row.formatted) == ("user", "see <|image|> ||im_end|>") and not row["mask"]


# ---- Jaccard join --------------------------------------------------------------------------


def shingles(text, k):
    w = split(lower(text))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def groups(rows, k, percent):
    sets = [shingles(r[1], k) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    return sets, [find(i) for i in range(len(rows))]


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_jaccard_join(spark, k, percent):
    rows = [r[:2] for r in CORPUS]
    base = words(200)
    for i in range(60):  # a chain of near copies, each drifting from the last
        base = list(base)
        base[random.integers(0, 200)] = f"new{i}"
        rows.append((1000 + i, " ".join(base)))
    common = words(120)
    rows += [(2000 + i, " ".join(common + words(40 + i))) for i in range(40)]  # a shared passage, no links
    rows += [(3000 + i, " ".join(words(n))) for i, n in enumerate([3, 4, 4, 5, 8, 9, 10, 11, 12])]
    rows += [(3100 + i, rows[-i - 1][1] + " w1") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets, root = groups(rows, k, percent)
    least = {g: min((r[0] for r, h in zip(rows, root) if h == g and r[0] is not None), default=None) for g in root}
    want = [(r[0], len(s), least[g]) for r, s, g in zip(rows, sets, root)]
    got = [tuple(r) for r in join_similar(df, size=k, percent=percent)
           .select("doc_id", "n_shingles", "component_id").collect()]
    assert counted(got) == counted(want)
    kept = [r.doc_id for r in one_of_each(df, size=k, percent=percent).collect()]
    assert counted(kept) == counted([least[g] for g in set(root)])


# ---- mixing --------------------------------------------------------------------------------


def test_mix(spark, docs):
    rows = CORPUS
    got = mix(docs).collect()
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(split(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while True:  # share, stop those above, reshare
        left = sum(sizes.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not above:
            break
        target |= {s: 3 * sizes[s] for s in above}
        open_ -= above
    target |= share
    assert len(got) == len(rows)
    for s in order:
        own = [r for r in got if r.source == s]
        assert own[0].target == pytest.approx(target[s]) and own[0].source_size == sizes[s]
        assert sum(r.taken for r in own) == pytest.approx(target[s], abs=1.01)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert counted(mix(docs.repartition(7)).collect()) == counted(got)
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(split(r.text)) for r in mixed.collect()) == sum(r.taken for r in got)


def test_mix_oracle(spark, tmp_path):
    import duckdb

    for name in ("documents", "labels"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    read = lambda n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet")
    got = mix(read("documents"), weights=label_weights(read("labels")))
    names = ("doc_id", "size", "source_size", "target", "taken")
    want = duckdb.sql(mixing.ORACLE_SQL).df()[list(names)].itertuples(index=False, name=None)
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(want)


def test_weights_by_id_are_not_broadcast(spark, tmp_path):
    """Copies of the labels' weights, one for each task that shares an id, grow with the documents."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    labels = [(1, 1), (1, 0), (1, 1), (1, 1), (2, None), (None, 1), (3, 1), (4, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels")  # files have a size
    weights = label_weights(spark.read.parquet(f"{tmp_path}/labels"))
    rows = spark.createDataFrame([(0, 1), (9, 1), (2, 2), (3, None), (4, 3), (5, 4), (6, 7)], "number bigint, doc_id bigint")
    spark.conf.set(name, "10m")
    try:
        got = mixing._weighed(rows, weights)
        plan = got._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        assert sorted((r.number, r.weight) for r in got.collect()) == [(0, 0.875), (2, 0.75), (3, 0.75), (4, 1), (5, 0.5), (6, 0.75), (9, 0.875)]
    finally:
        spark.conf.set(name, before)


def test_mix_rows_of_one_id(spark):
    """Rows that share an id, or have none, draw each for itself; any column names may come along."""
    rows = [(7, f"text {k % 500} a b c", "s0", k, 0.5, "x") for k in range(2000)]
    rows += [(None, "none at all", "s0", k, 0.5, "x") for k in range(500)]
    rows += [(k, "one two three four", "s1", k, 0.5, "x") for k in range(5000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, mix_id int, mix_weight double, `a.b` string")
    labels = spark.createDataFrame([(7, 1), (3, 0)], "doc_id bigint, quality int")
    got = mix(df, weights=label_weights(labels))
    one = got.where("source = 's1'").first()
    part = got.where("doc_id = 7").agg({"part": "sum"}).first()[0] / (5 * 2000)
    assert one.epochs >= 0 and got.count() == len(rows)
    budget = got.where("source = 's0'").selectExpr("sum(part) / sum(size)").first()[0]
    assert budget < 0.999 and abs(part - budget) < 0.2  # neither all nor none of one id's rows
    mixed = mixed_documents(df, weights=label_weights(labels))
    assert mixed.columns == df.columns and mixed.count() > 0
    assert counted(mix(df.repartition(5), weights=label_weights(labels)).collect()) == counted(got.collect())


# ---- token files ---------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 32])
def test_pack(bits):
    ids = random.integers(0, 1 << bits, 1000).astype(np.uint32)
    data = pack_ids(ids, bits)
    assert len(data) == -(-1000 * bits // 8) and (unpack_ids(data, 1000, bits) == ids).all()


def test_token_files(spark, docs):
    tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = tokenizers.path("byte_bpe_50k.json")
    got = sorted(read_documents(write_token_files(docs, token_folder(spark), path, 2)).collect(), key=lambda r: r.start)
    one, start = Tokenizer.from_file(path), 0
    assert [r.doc_id for r in got][:-1] == sorted(r.doc_id for r in got[:-1]) and got[-1].doc_id is None
    want = {}
    for r in CORPUS:
        ids = np.array([*one.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(r[0], set()).add((len(ids), zlib.crc32(ids.tobytes())))
    for r in got:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        start += r.n_tokens


# ---- substring de-duplication and decontamination ------------------------------------------


def test_substring(docs):
    rows = CORPUS
    first = {}
    for r in rows:
        w = split(r[1])
        for i in range(len(w) - 12):
            key = tuple(w[i:i + 13])
            first[key] = min(first.get(key, np.inf), np.inf if r[0] is None else r[0])
    want = []
    for r in rows:
        w, gone = split(r[1]), set()
        for i in range(len(w) - 12):
            if first[tuple(w[i:i + 13])] < (np.inf if r[0] is None else r[0]):
                gone |= set(range(i, i + 13))
        want.append((r[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(docs).collect()]
    assert counted(got) == counted(want)


def test_substring_rows_of_one_id(spark, monkeypatch):
    """Rows that share an id, or have none, get the keys of their own text and no more."""
    from pyspark.sql import functions as F

    from lotwise.llm import substring_dedup

    longest, seen = 60, []
    held = [words(longest) for _ in range(40)]
    rows = [(k, " ".join(w)) for k, w in enumerate(held)]
    rows += [(None, " ".join(w[10:])) for w in held] + [(500, " ".join(w[:40])) for w in held]
    rows += [(None, rows[50][1])] * 3 + [(500, "alone " * 5)]
    again = words(30)  # in rows of one id only, so no repeat
    rows += [(600, " ".join(again + words(k))) for k in range(5)]
    map_slices = substring_dedup.map_slices

    def watch(df, schema, work):
        if "keys" in df.columns:
            seen.append(df.agg(F.max(F.size("keys"))).first()[0])
        return map_slices(df, schema, work)

    monkeypatch.setattr(substring_dedup, "map_slices", watch)
    got = remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert len(seen) == 2 and max(seen) <= 2 * longest  # a key comes twice at most
    assert counted((r.doc_id, r.n_words, r.n_removed) for r in got) == counted(
        (k, len(split(t)), len(split(t)) if (k is None or k == 500) and "alone" not in t else 0) for k, t in rows)


def test_contamination(spark, docs):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    rows = CORPUS
    items = [(1, " ".join(split(rows[0][1])[20:50])), (2, "only"), (3, None), (4, ""), (5, rows[11][1]), (6, "w1 nowhere"),
             (7, rows[11][1]), (12, " ".join(split(rows[9][1])[500:520]))]
    windows = {}
    for k, text in items:
        w = pattern.findall(lower(text))
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).add(k)
    want = []
    for r in rows:
        w, hit, found = pattern.findall(lower(r[1])), set(), set()
        for i in range(len(w)):
            for n in {len(x) for x in windows}:
                if tuple(w[i:i + n]) in windows and i + n <= len(w):
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        want.append((r[0], len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for blocks in (500_000, 7):
        out = find_contamination(docs, bench, block_windows=blocks)
        got = [(r["row"].doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in out.collect()]
        assert counted(got) == counted(want)
    assert find_contamination(docs, bench.limit(0)).where("contaminated").count() == 0


# ---- fingerprints --------------------------------------------------------------------------


def test_prefix_spans():
    p, q = Prefix("abcabcabd"), Prefix("xabcabx")
    assert p.equal(0, 3, 3) and not p.equal(0, 6, 3) and p.extension(0, 3) == 5
    assert p.extension(0, 1, q) == 5 and p.extension(9, 0, q) == 0 and not p.equal(8, 0, 5)


def test_edits(spark, docs):
    rows = [(r[0], r[1] or "") for r in CORPUS]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = []
    for i, (k, text) in enumerate(rows):
        new = fingerprints.edited(text, rows[(i + 1) % len(rows)][1])
        want.append((k, len(text), hashlib.sha256(new.encode()).hexdigest()))
    got = with_edits(docs).collect()
    assert counted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == counted(want)
    prints = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert fingerprints.compare(r.fingerprint, r.edited_fingerprint) == r.near_edited
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[100] == prints[99] != prints[96]
    # A tail that is replaced leaves two thirds alike; what comes before or after a text does not matter.
    texts = ["".join(chr(97 + x) for x in random.integers(0, 26, n)) for n in (4000, 4000, 130)]
    near = lambda x, y: compare(str(Prefix(x).fingerprint()), str(Prefix(y).fingerprint()))
    assert 0.6 < near(texts[0], fingerprints.edited(texts[0], texts[1])) < 0.7 and near(texts[0], texts[1]) < 0.1
    assert near(texts[0], texts[0][:2000] + "#" + texts[0][2000:]) > 0.9 and near(texts[0], "#" + texts[0]) > 0.9
    assert near(texts[0], texts[0][:3500]) > 0.8 and near(texts[2], texts[2][:65]) >= 0.45 and near("", "") == 1 and near("", "a") == 0
    alone = with_edits(spark.createDataFrame([(1, "abcdef")], "doc_id bigint, text string")).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and alone.near_next == 1


# ---- URL filter ----------------------------------------------------------------------------


def test_urls(spark):
    cases = {"http://a.com/x": ("a.com", "/x", "com/", "allow"), "https://Sub.Example.COM/en/1?q#f": ("sub.example.com", "/en/1", "example.com/en/", "block"),
             "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
             "http://x.net/es/2": ("x.net", "/es/2", "net/es/", "block"), "http://x.net/fr/": ("x.net", "/fr/", "net/fr/", "block"),
             "x.net/fr/": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
             "http://notexample.org": ("notexample.org", "", None, "allow"), "http://com?x://y": ("com", "", None, "allow")}
    rows = [(i, u) for i, u in enumerate(cases)]
    got = {r.page_id: r for r in filter_urls(spark.createDataFrame(rows, "page_id bigint, url string")).collect()}
    for i, u in rows:
        assert (got[i].host, got[i].path, got[i]["rule"]) == cases[u][:3]
        if cases[u][2]:
            assert got[i].verdict == cases[u][3]


def test_mined_rules(spark):
    rows = [f"http://s{i}.net/fr/casino/{i}" for i in range(40)] + [f"http://s{i}.com/news/{i}" for i in range(60)]
    probes = ["http://z.org/casino/9", "http://z.org/news/9", "http://z.org/other"]
    df = spark.createDataFrame(list(enumerate(rows + probes)), "page_id bigint, url string")
    got = {r.page_id: r for r in filter_urls(df).collect()}
    assert [got[100 + i].verdict for i in range(3)] == ["block", "allow", "allow"] and got[100].mined == "p:casino"
    assert len(got) == 103 and filter_urls(df.where("page_id > 100")).count() == 2


def test_mined_rules_of_whole_urls(spark):
    """A signal behind many tokens, one in the query, and one that only four tokens together give."""
    far = "/".join("abcdefghijklmnopqrst")
    rows = [f"http://s{i}.net/fr/{far}/casino" for i in range(20)] + [f"http://s{i}.com/{far}/news" for i in range(20)]
    rows += [f"http://s{i}.net/fr/x?ad=pills" for i in range(20)] + [f"http://s{i}.com/x?ad=shoes" for i in range(20)]
    four = ["red", "green", "blue", "black"]
    rows += [f"http://s{i}.net/fr/{'/'.join(four)}" for i in range(20)]
    rows += [f"http://s{i}.com/{'/'.join(four[:k] + four[k + 1:])}" for i in range(5) for k in range(4)]
    probes = {f"http://z.org/{far}/casino": "block", f"http://z.org/{far}/other": "allow", "http://z.org/y?ad=pills": "block",
              "http://z.org/y?ad=shoes": "allow", "http://z.org/black/blue/green/red": "block", "http://z.org/red/green/blue": "allow"}
    df = spark.createDataFrame(list(enumerate(rows + list(probes))), "page_id bigint, url string")
    got = filter_urls(df).collect()
    verdicts = {r.page_id - len(rows): r.verdict for r in got if r.page_id >= len(rows)}
    assert [verdicts[i] for i in range(len(probes))] == list(probes.values())
    assert counted(filter_urls(df.repartition(5)).collect()) == counted(got)


def test_mined_rules_need_evidence(spark):
    """A host of a few blocked rows is no rule, however confident; one of many is."""
    rows = [f"http://www.rare.net/es/{'abc'[i]}" for i in range(3)] + [f"http://www.often.net/fr/{i}" for i in range(40)]
    rows += [f"http://www.s{'abcdefgh'[i % 8]}.com/x/{i}" for i in range(80)]
    probes = {"http://rare.org/": "allow", "http://often.org/": "block", "http://www.org/": "allow"}
    df = spark.createDataFrame(list(enumerate(rows + list(probes))), "page_id bigint, url string")
    got = {r.page_id - len(rows): r.verdict for r in filter_urls(df).collect()}
    assert [got[i] for i in range(len(probes))] == list(probes.values())


def test_mined_rules_brute_force(spark):
    """All rules of a small table by counting every combination of the labelled rows' tokens, and the
    verdicts that they give."""
    from itertools import combinations

    words = ["red", "green", "blue", "black", "white"]
    pick = lambda i: [w for k, w in enumerate(words) if (i * 7 + k * k) % (k + 2) == 0]
    rows = [f"http://{'xy'[i % 2]}{i}.{'net/fr' if len(pick(i)) > 2 or i % 11 == 0 else 'com'}/{'/'.join(pick(i))}" for i in range(90)]
    probes = [f"http://q.org/{'/'.join(c)}" for n in range(6) for c in combinations(words, n)]
    df = spark.createDataFrame(list(enumerate(rows + probes)), "page_id bigint, url string")
    sets = [({"h:" + x for x in url.split("/")[2].split(".")} | {"p:" + x for x in url.split("/")[3:] if x}) for url in rows + probes]
    blocked = [".net/fr" in url for url in rows]
    n, all_blocked = len(rows), sum(blocked)
    least = max(0.01 * n, 10)
    often = sorted(t for t in set.union(*sets[:n]) if sum(t in s for s in sets[:n]) >= least)
    rules = []
    for size in range(1, len(often) + 1):
        for c in combinations(often, size):
            held = [i for i in range(n) if set(c) <= sets[i]]
            k = sum(blocked[i] for i in held)
            if k < least or k / len(held) < 0.9:
                continue
            cells = ((k, len(held), all_blocked), (len(held) - k, len(held), n - all_blocked),
                     (all_blocked - k, n - len(held), all_blocked), (n - all_blocked - len(held) + k, n - len(held), n - all_blocked))
            if 2 * sum(x * np.log(x * n / (r * a)) for x, r, a in cells if x) >= 10.83:
                rules.append(set(c))
    assert rules
    got = {r.page_id: r for r in filter_urls(df).collect()}
    for i, (url, s) in enumerate(zip(rows + probes, sets)):
        if got[i]["rule"] is None:
            assert (got[i].verdict == "block") == any(r <= s for r in rules), (url, got[i].mined)


# ---- all together --------------------------------------------------------------------------


def test_empty_tables(spark, empty):
    assert join_similar(empty).count() == mix(empty).count() == mixed_documents(empty).count() == 0
    assert remove_repeats(empty).count() == with_edits(empty).count() == one_of_each(empty).count() == 0
    assert filter_urls(empty, "doc_id", "text").count() == 0
    turns = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert digest(format_turns(turns)).count() == 0
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert find_contamination(empty, items).count() == 0
    files = write_token_files(empty, token_folder(spark), tokenizer_path(), 2)
    assert read_documents(files).count() == 0
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int")
    assert keep_clean(empty, labels, empty).count() == 0 and keep_clean(empty, labels, empty).columns == empty.columns


def test_hot_conversation(spark):
    """One conversation with most turns: its digest is that of its turns in order."""
    turns = [(1, k, "user" if k % 2 else "assistant", f"text | {k} \\ <|im_end|>") for k in range(3000)] + [(2, 0, "user", "x")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").repartition(8)
    got = {r.conv_id: r for r in digest(format_turns(df)).collect()}
    whole = hashlib.sha256("".join(f"{r}\n{t}\n" for c, _, r, t in turns if c == 1).encode()).hexdigest()
    assert got[1].n_turns == 3000 and got[1].turns_sha256 == whole and got[2].n_turns == 1


def brute_contaminated(text, items, window=13):
    """The contract's rule: 20 * hit words >= words, of the words in occurrences of items' windows."""
    found = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    w, wanted = found(text), {}
    for item in items:
        iw = found(item)
        for i in range(max(1, len(iw) - window + 1) if iw else 0):
            piece = tuple(iw[i:i + window])
            wanted.setdefault(len(piece), set()).add(piece)
    hit = {i + k for n, pieces in wanted.items() for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in pieces for k in range(n)}
    return len(hit) > 0 and 20 * len(hit) >= len(w)


def test_pipeline(spark):
    """Each stage on what the one before kept, by brute force."""
    import corpus_pipeline as pipeline

    from lotwise.session import materialize

    sf = "/root/testdata/sf0.001"
    read = lambda t: spark.read.parquet(f"{sf}/{t}.parquet")
    docs = kept = read("documents")
    for name, stage in pipeline.STAGES[:-1]:
        before = kept
        kept = materialize(stage(spark, kept, sf), f"test-{name}")
        assert kept.columns == docs.columns
        ids = sorted(r.doc_id for r in kept.collect())
        rows = [(r.doc_id, r.text) for r in before.collect()]
        if name == "toxicity":
            assert ids == sorted(r.doc_id for r in score_toxicity(docs, read("labels")).collect() if not r.predicted)
        elif name == "jaccard_join":
            _, root = groups(rows, 5, 80)
            least = {}
            for r, g in zip(rows, root):
                least[g] = min(least.get(g, np.inf), r[0])
            assert ids == sorted(least.values())
        elif name == "decontamination":
            items = [r.text for r in read("benchmark").collect()]
            assert ids == sorted(d for d, t in rows if not brute_contaminated(t, items)) and len(ids) < len(rows)
        elif name == "mixing":
            taken = {r.doc_id: r.taken for r in mix(before, weights=label_weights(read("labels"))).collect()}
            words_of = {}
            for r in kept.collect():
                words_of[r.doc_id] = words_of.get(r.doc_id, 0) + len(split(r.text))
                assert r.n_chars == len(r.text or "")
            assert all(words_of.get(d, 0) == n for d, n in taken.items())
            whole = dict(rows)
            for r in kept.collect():  # copies are whole or the document's first words
                assert r.text == whole[r.doc_id] or split(r.text) == split(whole[r.doc_id])[:len(split(r.text))]
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    want = sorted((r.doc_id, zlib.crc32(np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4").tobytes())) for r in kept.collect())
    out = pipeline.run(spark, sf).orderBy("start").collect()
    assert sorted((r.doc_id, r.ids_crc32) for r in out) == want and out[0].start == 0
    assert [r.start for r in out] == [0, *np.cumsum([r.n_tokens for r in out])[:-1].tolist()]
