"""URL filter: host rules first, then association rules that Spark's FP-growth mines.

The pages a host rule judges are the labelled rows. A labelled URL is the set of all its tokens
(host labels, words of path, query and fragment; digits read as one token) and its verdict;
FP-growth finds the frequent combinations, and those that imply ``block`` with ``MIN_CONFIDENCE``
are kept, of any length, if no subset of the same combination implies it as surely. Support is a share
and a number of rows: a combination must be in ``MIN_SUPPORT`` of the labelled rows and in
``MIN_ROWS`` of them, and more of its rows must be blocked than chance makes (a log-likelihood ratio of
``SURE`` at least), so that single hosts of a small table are no rules.

Spark counts the tokens of all labelled rows; one below the least support can be in no frequent
combination and is left out. Tokens that occur in exactly the same labelled rows stand for one
another in every rule, so they are mined as one item, their kind: a part that many URLs repeat is
one item and not 2**tokens combinations. A URL has a kind when it has any of its tokens.

A rule lies under its rarest kind, its anchor. Kinds are broadcast: there are at most (mean tokens
of a labelled row) / MIN_SUPPORT frequent tokens. Rules have no such bound; they are joined to the
distinct sets of kinds by anchor. The pages' tokens are made once and stored.

Rows: null, empty or URLs without ``://`` have an empty host and path, fit no rule and are allowed;
repeated rows are judged alike; without labelled rows nothing is blocked by the method; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Host and path of each rule, and its verdict.
HOST_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
MIN_SUPPORT = 0.01  # share of the labelled rows
MIN_CONFIDENCE = 0.9
MIN_ROWS = 10  # labelled rows of a rule
SURE = 10.83  # least log-likelihood ratio of a rule: chance alone gives it once in 1,000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_rule(host: Column, path: Column, rules=HOST_RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def query_and_fragment(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1), F.regexp_extract(rest, r"(?s)^[^#]*#(.*)$", 1)


def tokens(host: Column, path: Column, query: Column, fragment: Column) -> Column:
    """Distinct tokens of a URL: ``h:`` host labels, ``p:``, ``q:`` and ``f:`` words of path, query
    and fragment."""
    def words(mark: str, text: Column) -> Column:
        parts = F.split(F.regexp_replace(text, "[0-9]+", "0"), r"[^\p{L}0-]+")
        return F.transform(F.filter(parts, lambda t: t != ""), lambda t: F.concat(F.lit(mark), t))

    labels = F.filter(F.split(host, r"\."), lambda t: t != "")
    return F.array_distinct(F.concat(F.transform(labels, lambda t: F.concat(F.lit("h:"), t)),
                                     words("p:", path), words("q:", query), words("f:", fragment)))


def least_rows(n: int) -> float:
    """Rows that a frequent combination of ``n`` labelled rows has at least."""
    return max(MIN_SUPPORT * n, MIN_ROWS)


def likelihood_ratio(blocked: Column, rows: Column, all_blocked: int, n: int) -> Column:
    """Of the hypothesis that a combination's rows are blocked as often as the others: twice the log of
    how much better its own share fits the two-by-two table."""
    table = ((blocked, rows, all_blocked), (rows - blocked, rows, n - all_blocked),
             (all_blocked - blocked, n - rows, all_blocked), (n - all_blocked - rows + blocked, n - rows, n - all_blocked))
    cells = [F.when(x > 0, x * F.log(x * n / (r * c))).otherwise(0.0) for x, r, c in table]
    return 2 * (cells[0] + cells[1] + cells[2] + cells[3])


def token_kinds(labelled: DataFrame, n: int) -> DataFrame:
    """(token, kind) of the tokens in the least support of the ``n`` labelled rows; a kind has the tokens
    of exactly the same rows, by two 64-bit hashes of their sets, and the least one's name."""
    sets = labelled.groupBy("tokens").agg(F.count("*").alias("rows"))
    counts = (sets.select("rows", F.xxhash64("tokens").alias("a"), F.xxhash64(F.lit(1), "tokens").alias("b"),
                          F.explode("tokens").alias("token"))
              .groupBy("token").agg(F.sum("rows").alias("rows"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
              .where(F.col("rows") >= least_rows(n)))
    kinds = counts.groupBy("rows", "a", "b").agg(F.collect_list("token").alias("own"))
    return kinds.select(F.explode("own").alias("token"), F.array_min("own").alias("kind"))


def _fitting(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(kinds, rule) for each set of ``sets`` (distinct ``kinds``) and each rule it has all items of."""
    held = rules.select("anchor", F.struct("confidence", "items").alias("rule"))
    return (sets.select("kinds", F.explode("kinds").alias("anchor")).join(held, "anchor")
            .where(F.size(F.array_except("rule.items", "kinds")) == 0).select("kinds", "rule"))


def mine_rules(labelled: DataFrame, n: int) -> DataFrame:
    """(anchor, items, confidence) of the rules that block, from ``kinds`` and ``verdict`` of ``n`` rows."""
    all_blocked = labelled.where("verdict = 'block'").count()
    mark = F.when(F.col("verdict") == "block", F.array(F.lit("="))).otherwise(F.array().cast("array<string>"))
    items = labelled.select(F.concat(mark, "kinds").alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, least_rows(n) / n), minConfidence=MIN_CONFIDENCE).fit(items)
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("item"), F.col("freq"))
    blocked = F.round(F.col("support") * n).cast("double")
    rows = F.round(F.col("support") * n / F.col("confidence")).cast("double")
    rules = (model.associationRules.where(F.col("consequent")[0] == "=")
             .where((rows >= MIN_ROWS) & (likelihood_ratio(blocked, rows, all_blocked, n) >= SURE))
             .select(F.array_sort("antecedent").alias("items"), "confidence"))
    # A rule one of whose parts blocks as surely adds nothing. Most are beaten by a part that lacks
    # one item or has one: look those up by equality; then meet the few left by anchor.
    parts = rules.select("items", "confidence", F.explode(F.array_union(
        F.transform("items", lambda t: F.array_except("items", F.array(t))),
        F.transform("items", lambda t: F.array(t)))).alias("part"))
    better = rules.select(F.col("items").alias("part"), F.col("confidence").alias("sure"))
    beaten = parts.where(F.col("part") != F.col("items")).join(better, "part").where("sure >= confidence").select("items")
    left = rules.join(beaten, "items", "left_anti")
    rarest = left.select("items", "confidence", F.explode("items").alias("item")).join(single, "item")
    left = materialize(rarest.groupBy("items", "confidence").agg(F.min_by("item", F.struct("freq", "item")).alias("anchor")),
                       "url-rules")
    own = left.select(F.col("items").alias("kinds"), F.col("confidence").alias("own"))
    beaten = (_fitting(left.select(F.col("items").alias("kinds")), left).join(own, "kinds")
              .where((F.col("rule.items") != F.col("kinds")) & (F.col("rule.confidence") >= F.col("own")))
              .select(F.col("kinds").alias("items")))
    return left.join(beaten, "items", "left_anti")


def filter_urls(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=HOST_RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and ``mined``: the mined rule that blocks (null: none)."""
    spark = df.sparkSession
    host, path = host_and_path(F.col("url"))
    query, fragment = query_and_fragment(F.col("url"))
    pages = (df.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
             .select("page_id", host.alias("host"), path.alias("path"),
                     F.coalesce(query, F.lit("")).alias("query"), F.coalesce(fragment, F.lit("")).alias("fragment")))
    rule, verdict = host_rule(F.col("host"), F.col("path"), rules)
    judged = materialize(pages.withColumns({"rule": rule, "verdict": verdict, "tokens": tokens(
        F.col("host"), F.col("path"), F.col("query"), F.col("fragment"))}).drop("query", "fragment"), "url-tokens")
    labelled = judged.where("verdict IS NOT NULL")
    n = labelled.count()
    if n:
        kinds = materialize(token_kinds(labelled, n), "url-kinds")
    else:
        kinds = spark.createDataFrame([], "token string, kind string")
    # One row holds the kind of each frequent token (see the bound above).
    whole = kinds.agg(F.map_from_entries(F.collect_list(F.struct("token", "kind"))).alias("kind_of"), F.lit(1).alias("one"))
    known = F.filter("tokens", lambda t: F.map_contains_key("kind_of", t))
    judged = (judged.withColumn("one", F.lit(1)).join(F.broadcast(whole), "one", "left").withColumn("tokens", known)
              .withColumn("kinds", F.array_sort(F.array_distinct(F.transform("tokens", lambda t: F.element_at("kind_of", t))))))
    if n:
        index = materialize(mine_rules(judged.where("verdict IS NOT NULL").select("kinds", "verdict"), n), "url-index")
    else:
        index = spark.createDataFrame([], "items array<string>, confidence double, anchor string")
    # Only the surest rules of a set can be its best.
    fits = _fitting(judged.where("verdict IS NULL").select("kinds").distinct(), index)
    sure = fits.groupBy("kinds").agg(F.max("rule.confidence").alias("sure"))
    found = (fits.join(sure, "kinds").where(F.col("rule.confidence") == F.col("sure"))
             .groupBy("kinds").agg(F.collect_list("rule").alias("found")))
    # The hash in the key gives both sides a shuffle of their own, so a set that very many pages have
    # can be split.
    same = F.xxhash64("kinds")
    out = (judged.withColumn("same", same).join(found.withColumn("same", same), ["kinds", "same"], "left")
           .withColumn("found", F.when(F.col("verdict").isNull(), F.col("found"))))
    # A rule in the URL's own tokens, the last of each kind.
    named = F.transform("found", lambda r: F.struct(r["confidence"].alias("confidence"), F.array_sort(F.transform(
        r["items"], lambda k: F.array_max(F.filter("tokens", lambda t: F.element_at("kind_of", t) == k)))).alias("items")))
    out = out.withColumn("best", F.array_max(named))
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("verdict", F.when(F.col("best").isNotNull(), "block").otherwise("allow")).alias("verdict"),
                      F.array_join(F.col("best.items"), " ").alias("mined"))
