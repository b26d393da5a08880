"""Mixing sources to target weights: Efraimidis-Spirakis sampling by DataFrame functions alone.

Sources in code-point order (null last) weigh ``WEIGHTS`` in turn and share all words; a target
stops at ``MAX_EPOCHS`` times its source's size and the excess is reshared by weight until none is
above. With the sources sorted by limit / weight, the level that shares the rest after the first k
stop rises while sources stop and falls afterwards, so the final level is its greatest value.

Complete epochs of a source come first: floor(target / size) copies of every document. The rest is
a sample without replacement: documents in order of the exponential key -ln(u) / quality weight,
prefix-summed up to the budget; the document at the edge is taken in part. u comes from a hash of
the row's id, text and place among equal rows, so every row draws for itself and reruns agree.

The texts are read once: a narrow table of ids, sizes and hashes is stored, and all that follows is
done on it. A source's prefix sums run over ranges of the key, of about ``RANGE_ROWS`` rows even if one
source has all: sums per range, prefix sums over the ranges, then prefix sums inside each range. No
task gathers a source, an id or a group of equal rows: places among equal rows are counted per input
partition, with prefix sums over the partitions, and the join with weights by id deals an id's rows to
``SALTS`` tasks (the weights, which grow with the documents, are never sent to the driver). One task sorts the list of sources (a row each). Where the input's columns are asked
for, they meet the decisions in one last join by row number.

Rows: null text has no words; null quality weighs ``UNKNOWN``; repeated rows are documents of their
own; ties of the key go by id, size and text hash; a source without words has target 0; an empty
table gives an empty result. The input's columns ride along in the struct ``row``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .rows import as_rows

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
RANGE_ROWS = 1024  # rows of a range of the key, about, if one source has all
SALTS = 8  # tasks that share the rows of one id
WORD = r"[^\x20\x09-\x0D]+"
GOOD, UNKNOWN, BAD = 1.0, 0.75, 0.5  # quality weights of labels 1, none, 0


def label_weights(labels: DataFrame) -> DataFrame:
    """(mix_id, mix_weight): the quality weight of each labelled id, from its mean label."""
    mean = labels.groupBy(F.col("doc_id").alias("mix_id")).agg(F.avg("quality").alias("mix_q"))
    weight = F.coalesce(F.lit(BAD) + F.lit(GOOD - BAD) * F.col("mix_q"), F.lit(UNKNOWN))
    return mean.select("mix_id", weight.alias("mix_weight"))


def targets(sizes: DataFrame) -> DataFrame:
    """``source``, ``source_size`` to these and ``target``; a row per source."""
    order = Window.orderBy(F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS)))
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (place + 1).cast("int")))
    weighed = weighed.withColumn("limit", MAX_EPOCHS * F.col("source_size"))
    fill = (Window.orderBy(F.col("limit") / F.col("weight"), F.asc_nulls_last("source"))
            .rowsBetween(Window.unboundedPreceding, -1))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(fill), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(fill), F.lit(0))
    level = weighed.withColumn("level", left.cast("double") / weights.cast("double"))
    return level.select("source", "source_size", F.least(
        F.col("limit").cast("double"),
        F.max("level").over(everything) * F.col("weight")).alias("target"))


def sampling_key(doc_id, digest, place, weight):
    """-ln(u) / weight, u uniform in (0, 1) by a hash of the id, the text's digest and the row's place
    among equal rows."""
    seed = F.concat_ws(":", F.lit("mix"), F.coalesce(doc_id.cast("string"), F.lit("null")), digest, place.cast("string"))
    u = (F.conv(F.substring(F.md5(seed), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(u) / weight


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` and each one's ``place`` among rows of equal id, source and text, by row number."""
    same = F.xxhash64("doc_id", "source", "digest")
    rows = rows.withColumns({"same": same, "part": F.shiftright("number", 33)})  # the partition it was read in
    earlier = Window.partitionBy("same").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("same", "part").agg(F.count("*").alias("n")).select(
        "same", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("same", "part").orderBy("number")) - 1
    rows = rows.withColumn("inside", inside).join(before, ["same", "part"])
    return rows.withColumn("place", F.col("before") + F.col("inside")).drop("same", "part", "before", "inside")


def _weighed(rows: DataFrame, weights: DataFrame | None) -> DataFrame:
    if weights is None:
        return rows.withColumn("weight", F.coalesce("own_weight", F.lit(UNKNOWN)))
    salt = F.pmod("number", F.lit(SALTS)).cast("int")
    spread = weights.select(F.col("mix_id").alias("weight_id"), F.col("mix_weight").alias("weight"),
                            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("weight_salt"))
    on = (F.col("doc_id") == F.col("weight_id")) & (salt == F.col("weight_salt"))
    # The size of the labels' files says little of the weights' copies: a broadcast planned from it fills the driver.
    rows = rows.join(spread.hint("merge"), on, "left").drop("weight_id", "weight_salt")
    return rows.withColumn("weight", F.coalesce("weight", F.lit(UNKNOWN)))


def _decided(rows: DataFrame, weights: DataFrame | None) -> DataFrame:
    """number, doc_id, source, size, source_size, target, epochs and part of stored ``rows``."""
    docs = _weighed(_placed(rows), weights)
    docs = docs.withColumn("key", sampling_key(F.col("doc_id"), F.col("digest"), F.col("place"),
                                               F.greatest("weight", F.lit(1e-6))))
    # The key's own distribution function spreads the ranges evenly (for weight 1).
    ranges = max(1, -(-rows.count() // RANGE_ROWS))
    bucket = F.least(F.floor((1 - F.exp(-F.col("key"))) * ranges), F.lit(ranges - 1)).cast("bigint")
    docs = docs.select("number", "doc_id", "source", "size", "digest", "key", bucket.alias("bucket"))
    sums = docs.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    goals = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    bases = bases.alias("b").join(goals.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source"))).select(
        F.col("b.source").alias("b_source"), F.col("bucket").alias("b_bucket"), "base", "source_size", "target")
    placed = docs.join(bases, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    inside = (Window.partitionBy("source", "bucket").orderBy("key", F.asc_nulls_first("doc_id"), "size", "digest", "number")
              .rowsBetween(Window.unboundedPreceding, -1))
    before = F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    budget = F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("bigint")
    part = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), budget - F.col("before")))
    out = placed.withColumn("before", before).withColumn("epochs", epochs).withColumn("part", part)
    return out.select("number", "doc_id", "source", "size", "source_size", "target", "epochs", "part")


def mix(df: DataFrame, weight_col: str | None = None, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", carry: bool = False, weights: DataFrame | None = None) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, epochs (complete copies), part
    (words of the fractional copy) and taken; with ``carry`` the input's columns as ``row``.
    ``weights`` (mix_id, mix_weight) gives weights by id, ``weight_col`` a column of the input."""
    text = F.col("row").getField(text_col).cast("string")
    own = F.lit(1.0) if weight_col is None else F.col("row").getField(weight_col).cast("double")
    rows = materialize(as_rows(df).select(
        F.monotonically_increasing_id().alias("number"), F.col("row").getField(id_col).alias("doc_id"),
        F.col("row").getField(source_col).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("digest"), own.alias("own_weight"),
        *(["row"] if carry else [])), "mix-rows")
    out = _decided(rows.drop("row"), weights)
    out = out.withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))
    if carry:  # one row each on both sides
        out = out.join(rows.select(F.col("number").alias("carried"), "row"), F.col("number") == F.col("carried")).drop("carried")
    return out.drop("number")


def mixed_documents(df: DataFrame, weight_col: str | None = None, **names) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the input's columns. The
    document at a budget's edge comes once with as many of its words as the budget has left, one
    space between them; documents without words stay once."""
    text_col = names.get("text_col", "text")
    out = mix(df, weight_col, carry=True, **names)
    copies = F.when(F.col("size") == 0, 1).otherwise(F.col("epochs") + (F.col("part") > 0).cast("int")).cast("int")
    # A taken document has one copy at least, so the generator drops the others.
    out = out.select("row", "size", "epochs", "part", F.posexplode(F.array_repeat(F.lit(True), copies)).alias("copy", "taken"))
    cut = (F.col("copy") == F.col("epochs")) & (F.col("part") < F.col("size"))
    whole = F.col("row").getField(text_col)
    words = F.regexp_extract_all(whole.cast("string"), F.lit(WORD), F.lit(0))
    text = F.when(cut, F.array_join(F.slice(words, 1, F.col("part").cast("int")), " ")).otherwise(whole)
    return out.select(*[(text if c == text_col else F.col("row").getField(c)).alias(c)
                        for c in df.columns if c != weight_col])


ORACLE_SQL = r"""
WITH r AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(text, '')) AS digest
  FROM documents
), n AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, source, digest) - 1 AS place FROM r
), d AS (
  SELECT doc_id, source, size, digest,
         -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || digest || ':' || place), 1, 12))::BIGINT::DOUBLE
              + 0.5) / 281474976710656.0) / coalesce(0.5 + 0.5 * q, 0.75) AS key
  FROM n LEFT JOIN (SELECT doc_id, avg(quality) AS q FROM labels GROUP BY doc_id) USING (doc_id)
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s
), f AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER b, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level
  FROM w WINDOW b AS (ORDER BY 3 * source_size / weight::DOUBLE, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, max(level) OVER () * weight) AS target FROM f
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS epochs,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size, d.digest
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target - epochs * source_size)::BIGINT - before)))::BIGINT AS taken
FROM p
"""
