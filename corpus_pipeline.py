"""A training corpus from ``documents``: toxic ones go, one of each group of near copies stays,
contaminated ones go, the sources are mixed, and the mix is written as token files.

Each stage's rows are written as Parquet and read back as the next one's documents. The classifier
learns from the labelled rows of the whole table, whatever the stage's own input holds.

Rows, by stage. Toxicity: null and empty texts score as texts without terms; extra columns stay. Near
copies: of a group, the row of the least id stays (rows without an id after all others, then the least
text hash); texts without words all stay. Decontamination: texts without words are clean. Mixing:
documents of a source without a name are a source of their own; texts without words stay once; a document
cut at a budget's edge has its first words. Token files: null text yields the end id alone; rows without
an id come last. Repeated rows are documents of their own in all but the second stage, and an empty
table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.decontaminate import find_contamination
from lotwise.llm.jaccard_join import one_of_each
from lotwise.llm.mixing import label_weights, mixed_documents
from lotwise.llm.queries import END_ID, tokenizer_path
from lotwise.llm.token_files import read_documents, token_folder, write_token_files
from lotwise.llm.toxicity import keep_clean
from lotwise.session import bound_batches, materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bound_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, _table(spark, sf_dir, "labels"), _table(spark, sf_dir, "documents"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies share 80% of their five-word shingles."""
    bound_batches(spark)
    return one_of_each(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return find_contamination(docs, _table(spark, sf_dir, "benchmark")).where("NOT contaminated").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; n_chars is that of the text taken."""
    mixed = mixed_documents(docs, weights=label_weights(_table(spark, sf_dir, "labels")))
    return mixed.withColumn("n_chars", F.length("text").cast("bigint"))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return read_documents(write_token_files(docs, token_folder(spark), tokenizer_path(), END_ID))


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

ORACLE_SQL = None  # a trained model decides in the first stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
