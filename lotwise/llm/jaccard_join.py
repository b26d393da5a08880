"""N-gram Jaccard join with adaptive multi-match prefixes.

A text's set has its distinct shingles, as 64-bit hashes in one global order: shingles not known to
be frequent first, the frequent ones by their counts. Two sets of similarity t share at least
ceil(t * n) shingles, so their prefixes of n - ceil(t * n) + l shingles share at least l. Each set
chooses its l (1 to ``MATCHES``) by the candidates it has to expect, the sum of the other holders of
its prefix's shingles over l; a pair must share min(l, l') prefix shingles before it is verified on
the whole sets. A set whose longer prefix has fewer than l shingles that others hold links with
nothing and leaves early.

The sets that stay are put in a second order, in which shingles that only one of them holds come first. These
are counted exactly, over the whole sets, among a share of all shingles that is half as large again as a
prefix (``SAMPLED``: those of the least hashes, so the head of the first order). A set of which more shingles
are its own than a prefix is long has a prefix that no other holds, and leaves without a pair: texts that
meet by chance, more often as the table grows, do; near copies hold few shingles alone.

Equal sets are one class, so copies cost no pairs. Large groups of near copies are joined through
stars first: each prefix shingle proposes, for all its holders, the class of least number and the
one most shared; these proposals are verified and joined into components. Then, per shingle, only
holders outside its main component meet the other holders, and only pairs in different components
are counted and verified, all of them. So no link between components is lost, and a group that is
connected already costs no pairs. Groups that share prefix shingles without being similar cost
their pairs; the order by rarity keeps common passages out of prefixes.

The list of frequent shingles is a hint for the order, of ``FREQUENT`` entries at most: any list
gives the same result. Verification joins pairs with sets, both ways by shuffles that AQE may split.

Rows: null and empty texts have the empty set and link with nothing; a text of fewer words than a
shingle is one shingle; repeated rows and rows of one id are rows of their own, in the component
their text is in; rows without an id get the least id of their component; an empty table gives an
empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import dematerialize, materialize
from .components import components
from .rows import as_rows
from .words import GOLDEN, SMALL_SLICE, Slice, grams, mix64, sequence_hashes, split, text_slices

SHINGLE = 3  # words
PERCENT = 90  # least similarity
MATCHES = 4  # greatest l
FREQUENT = 65_536  # shingles whose counts order them
SLOTS = 1 << 20  # hash slots of the rows whose texts are asked for
NO_ID = 2 ** 63 - 1  # rows without an id come after all others
OFTEN = 3  # documents of one slice that make a shingle frequent

WORD = r"[^\x20\x09-\x0D]"

SAMPLED = 1.5  # prefixes' lengths of shingles that are counted exactly

SETS = "doc_id bigint, text_hash bigint, node bigint, n_shingles bigint, sampled int, prefix array<bigint>"


def shingle_sets(s: Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, shingle) pairs of a slice, by row and hash."""
    w = split(s)
    at, hashes = grams(w, size)
    few = np.flatnonzero((w.count > 0) & (w.count < size))
    rows = np.concatenate((w.row[at], few))
    hashes = np.concatenate((hashes, sequence_hashes(w)[few]))
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def _identity(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit number of each row's set."""
    first = np.searchsorted(rows, np.arange(n + 1))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(hashes ^ np.uint64(GOLDEN)), dtype=np.uint64)))
    size = np.diff(first).astype(np.uint64)
    return mix64(total[first[1:]] - total[first[:-1]] + size).view(np.int64)


def _frequent(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles (sorted) that occur often, and their counts."""

    def run(batches):
        for batch in batches:
            for s in text_slices(batch.column(1), lower=True):
                got, n = np.unique(shingle_sets(s, size)[1], return_counts=True)
                often = n >= OFTEN
                yield pa.RecordBatch.from_arrays([pa.array(got[often].view(np.int64)), pa.array(n[often])], ["token", "n"])

    got = (docs.mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow())
    token = got.column("token").to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], got.column("n").to_numpy()[order]


def _prefix_sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``SETS``: number, size and head of each row's set: its longest prefix, or its ``sampled``
    shingles, which come first in it."""
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(docs, size))
    low = np.uint64(min((1 << 64) - 1, (int(SAMPLED * (100 - percent)) << 64) // 100))

    def run(batches):
        tokens, counts = frequent.value
        for batch in batches:
            for s in text_slices(batch.column(1), lower=True, limit=SMALL_SLICE):
                rows, hashes = shingle_sets(s, size)
                n = np.bincount(rows, minlength=s.rows)
                node = _identity(rows, hashes, s.rows)
                count = np.zeros(len(hashes), np.int64)
                if len(tokens):
                    place = np.minimum(np.searchsorted(tokens, hashes), len(tokens) - 1)
                    count = np.where(tokens[place] == hashes, counts[place], 0)
                order = np.lexsort((hashes, count, rows))
                rows, hashes = rows[order], hashes[order]
                inside = np.arange(len(rows)) - (np.cumsum(n) - n)[rows]
                sampled = np.bincount(rows[(count[order] == 0) & (hashes < low)], minlength=s.rows)
                length = np.minimum(n, np.maximum(n - -(-percent * n // 100) + MATCHES, sampled))
                keep = inside < length[rows]
                offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.lo, s.rows), batch.column(2).slice(s.lo, s.rows), pa.array(node), pa.array(n.astype(np.int64)),
                     pa.array(sampled.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[keep].view(np.int64)))],
                    ["doc_id", "text_hash", "node", "n_shingles", "sampled", "prefix"])

    return docs.mapInArrow(run, SETS)


def _held(rows: DataFrame, sizes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of prefix shingles (node, pos, token): those that several sets hold, with ``rank`` among a
    set's held ones and the set's ``n`` and ``sampled``; and (node, l, shared) of the sets that may
    link with any."""
    n = F.col("n")
    held = rows.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("pos"))  # a prefix at most
    rows = rows.join(held, "token").withColumn("rank", rank).join(sizes, "node")
    base = n - F.ceil(n * percent / F.lit(100))
    # Each l's shared shingles and expected candidates.
    sums = rows.groupBy("node", "n").agg(*[x for k in range(1, MATCHES + 1) for x in (
        F.sum((F.col("pos") < base + F.least(F.lit(k), "rank")).cast("int")).alias(f"shared{k}"),
        F.sum(F.when(F.col("pos") < base + F.least(F.lit(k), "rank"), F.col("df") - 1).otherwise(0)).alias(f"cost{k}"))])
    # Similar sets share ceil(t * n) shingles, so l is no greater.
    most = F.ceil(n * percent / F.lit(100)).cast("int")
    alive = [F.col(f"shared{k}") >= F.least(F.lit(k), most) for k in range(1, MATCHES + 1)]
    best = F.array_min(F.array(*[F.struct((F.col(f"cost{k}") / k).alias("cost"), F.lit(k).alias("l"))
                                 for k in range(1, MATCHES + 1)]))
    chosen = (sums.where(alive[0] & alive[1] & alive[2] & alive[3])
              .select("node", F.least(best["l"], most).alias("l"), F.col("shared1").alias("shared")))
    return rows, chosen


def _own_shingles(classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, own): how many of the sampled shingles of each set of ``nodes`` no other of them holds."""
    low = classes.join(nodes, "node", "left_semi").select("node", F.explode(F.slice("prefix", 1, F.col("sampled"))).alias("token"))
    holders = low.groupBy("token").agg(F.count("*").alias("k"), F.min("node").alias("node")).where("k = 1")
    return holders.groupBy("node").agg(F.count("*").alias("own"))


def _prefix_tokens(classes: DataFrame, percent: int) -> DataFrame:
    """(token, pos, rank, node, n, l, shared): prefix shingles that several classes hold, up to each
    class's own prefix, of the classes that may link with any; rank counts a class's held shingles,
    pos is a lower bound of the place in the second order."""
    n = F.col("n")
    base = n - F.ceil(n * percent / F.lit(100))
    sizes = classes.select("node", "n", "sampled")
    longest = F.slice("prefix", 1, (base + MATCHES).cast("int"))
    rows, alive = _held(classes.select("node", F.posexplode(longest).alias("pos", "token")), sizes, percent)
    first = rows = materialize(rows.join(alive.select("node"), "node", "left_semi").where(F.col("pos") < base + F.least(F.lit(MATCHES), "rank")),
                       "jaccard-held")
    own = _own_shingles(classes, rows.select("node").distinct())
    # Held shingles are nobody's own. Of those before one, at most the sampled ones that are not held
    # are the set's own; the set's other own ones move before it.
    earlier = Window.partitionBy("node").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    sampled_held = F.coalesce(F.sum((F.col("pos") < F.col("sampled")).cast("int")).over(earlier), F.lit(0))
    rows = rows.withColumn("passed", F.least("pos", "sampled") - sampled_held).join(own, "node", "left")
    moved = F.col("pos") + F.greatest(F.coalesce("own", F.lit(0)) - F.col("passed"), F.lit(0))
    rows = rows.withColumn("pos", moved.cast("int")).where(F.col("pos") < base + MATCHES)
    rows, chosen = _held(rows.select("node", "pos", "token"), sizes, percent)
    out = materialize(rows.join(chosen, "node").where(F.col("pos") < base + F.least("l", "rank")).select(
        "token", "pos", "rank", "node", "n", "l", "shared"), "jaccard-tokens")
    dematerialize(first)
    return out


def _may_match(a: str, b: str, percent: int):
    """Whether a shingle shared by sets ``a`` and ``b`` (prefixes of column names) counts for the pair.

    Similar sets share o = ceil(t * (n + n') / (1 + t)) shingles at least. Their l-th common shingle
    has o - l common ones after it, so the first l lie before n - o + l in the one set and before
    n' - o + l in the other. A shingle before them that no other prefix holds is not common, so the
    r-th held one of a set is at most the r-th common one and lies before n - o + r. Only shingles
    inside these bounds are counted."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    need = F.least(f"{a}l", f"{b}l", f"{a}rank", f"{b}rank")
    overlap = F.ceil((n + m) * percent / F.lit(100 + percent))
    return ((F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m))
            & (F.col(f"{a}pos") < n - overlap + need) & (F.col(f"{b}pos") < m - overlap + need))


def _proposals(tokens: DataFrame, percent: int) -> DataFrame:
    """Each holder of a shingle with two centres of it."""
    centre = F.struct("node", "n", "l", "pos", "rank")
    stars = tokens.groupBy("token").agg(F.min(centre).alias("x"), F.max_by(centre, F.struct("shared", "node")).alias("y"))
    stars = stars.select("token", F.explode(F.array_distinct(F.array("x", "y"))).alias("c"))
    pairs = tokens.join(stars, "token").where((F.col("c.node") != F.col("node")) & _may_match("", "c.", percent))
    return _matched(pairs, F.col("node"), F.col("c.node"), F.least("l", "c.l"))


def _matched(pairs: DataFrame, x, y, need) -> DataFrame:
    """The pairs that met at as many prefix shingles as they must."""
    return (pairs.groupBy(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
            .agg(F.count("*").alias("matches"), F.min(need).alias("need"))
            .where("matches >= need").select("a", "b"))


def _remaining(tokens: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """All pairs in different components that share as many prefix shingles as they must."""
    rows = tokens.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = rows.groupBy("token", "root").agg(F.count("*").alias("k"))
    main = (parts.groupBy("token").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.count("*").alias("roots"))
            .where("roots > 1"))
    rows = rows.join(main, "token").withColumn("minor", F.col("root") != F.col("main"))
    a = rows.where("minor").select("token", *[F.col(c).alias(f"a_{c}") for c in ("node", "n", "l", "pos", "rank", "root")])
    met = a.join(rows, "token").where(
        (F.col("a_root") != F.col("root")) & (~F.col("minor") | (F.col("a_node") < F.col("node")))
        & _may_match("a_", "", percent))
    return _matched(met, F.col("a_node"), F.col("node"), F.least("a_l", "l"))


def _whole_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """(node, hashes) of the classes in ``pairs``, from the text of one row each.

    Before texts are shuffled, a broadcast of the ``SLOTS`` hash slots in use drops most rows that
    no pair asks for; the join after it is exact."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = classes.join(nodes, "node", "left_semi").select(F.col("first.*"), "node")
    slot = F.pmod(F.xxhash64("id", "text_hash"), F.lit(SLOTS))
    slots = wanted.select(slot.alias("slot")).distinct()
    texts = (docs.withColumn("slot", slot).join(F.broadcast(slots), "slot", "left_semi")
             .select("id", "text_hash", "text").join(wanted.hint("merge"), ["id", "text_hash"])
             .dropDuplicates(["id", "text_hash"]).select("node", "text"))

    def run(batches):
        for batch in batches:
            wanted = batch.column(0).to_numpy(zero_copy_only=False)
            for s in text_slices(batch.column(1), lower=True, limit=SMALL_SLICE):
                rows, hashes = shingle_sets(s, size)
                first = np.searchsorted(rows, np.arange(s.rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(wanted[s.lo:s.hi]),
                     pa.array([hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())],
                    ["node", "hashes"])

    return texts.mapInArrow(run, "node bigint, hashes binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    joined = (pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("left")), "a")
              .join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("right")), "b")
              .select("a", "b", "left", "right"))

    def run(batches):
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (left, right))
                place = np.minimum(np.searchsorted(x, y), len(x) - 1)
                both = int((x[place] == y).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, "a bigint, b bigint")


def _links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    whole = materialize(_whole_sets(docs, classes, pairs, size), "jaccard-whole")
    links = materialize(_verified(pairs, whole, percent), "jaccard-links")
    dematerialize(whole, pairs)
    return links


def join_similar(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                 percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, class_id (rows of equal sets) and component (its
    number) of every row; the last two are null for empty sets."""
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumns({"text_hash": F.xxhash64("text"), "id": F.coalesce("doc_id", F.lit(NO_ID))})
    heads = sets = materialize(_prefix_sets(docs.select("doc_id", "text", "text_hash"), size, percent), "jaccard-heads")
    classes = materialize(sets.where("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"),
        F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text_hash")).alias("first"), F.first("n_shingles").alias("n"),
        F.first("sampled").alias("sampled"), F.first("prefix").alias("prefix")), "jaccard-classes")
    sets = materialize(sets.select("doc_id", "text_hash", "node", "n_shingles"), "jaccard-sets")
    dematerialize(heads)
    tokens = _prefix_tokens(classes, percent)
    whole, classes = classes, materialize(classes.select("node", "doc_id", "first"), "jaccard-first")
    dematerialize(whole)
    proposed = materialize(_proposals(tokens, percent), "jaccard-proposed")
    seeds = _links(docs, classes, proposed, size, percent)
    remaining = materialize(_remaining(tokens, components(seeds), percent), "jaccard-remaining")
    dematerialize(tokens)
    rest = _links(docs, classes, remaining, size, percent)
    roots = components(seeds.union(rest))
    named = classes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = named.select("node", "root").join(least, "root").select("node", "root", "component_id")
    own = F.col("n_shingles") == 0
    return sets.join(found, "node", "left").select(
        "doc_id", "text_hash", "n_shingles", F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(~own, F.col("node")).alias("class_id"), F.when(~own, F.col("root")).alias("component"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``df`` that stay when each component keeps one document, that of the least id
    (ties: of the least text hash). Rows with empty sets all stay. Columns are those of ``df``."""
    rows = as_rows(df).select("row", F.coalesce(F.col("row").getField(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"),
                              F.xxhash64(F.col("row").getField(text_col).cast("string")).alias("hash"),
                              F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit("")).rlike(WORD).alias("words"))
    found = join_similar(df, id_col, text_col, **how).where("component IS NOT NULL")
    # A null id comes after all others.
    first = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.col("text_hash").alias("hash"))
    stay = found.groupBy("component").agg(F.min(first).alias("stay")).select("stay.id", "stay.hash")
    # Rows of one id and text are in one component: one of them stays, where the join has brought them.
    kept = rows.where("words").join(stay, ["id", "hash"]).dropDuplicates(["id", "hash"])
    return kept.select("row").union(rows.where("NOT words").select("row")).select("row.*")
