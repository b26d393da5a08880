"""The registered queries of the subpackage: each applies its operator, with the parameters of
production, to a whole table and derives the contract's columns from the operator's result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import bound_batches
from . import lexical_search, mixing
from .alignment import align_tokenizers
from .chat_format import digest, format_turns
from .decontaminate import find_contamination
from .fingerprints import with_edits
from .jaccard_join import join_similar
from .oracles import ORACLES
from .quality import score_quality
from .substring_dedup import remove_repeats
from .token_files import read_documents, token_folder, write_token_files
from .token_transducer import count_tokens
from .toxicity import score_toxicity
from .url_filter import filter_urls

Query = Callable[[SparkSession, str], DataFrame]


END_ID = 2  # of a document, in token files


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bound_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark, sf_dir):
    return score_toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op2_quality(spark, sf_dir):
    return score_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op3_chat_format(spark, sf_dir):
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)],
                                 "conv_id bigint, turn bigint, role string, text string")
    return digest(format_turns(turns.unionByName(more)))


def op4_jaccard_join(spark, sf_dir):
    out = join_similar(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")


def op5_mixing(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    weights = mixing.label_weights(_read(spark, sf_dir, "labels"))
    return mixing.mix(docs, weights=weights).select("doc_id", "size", "source_size", "target", "taken")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_token_files(spark, sf_dir):
    files = write_token_files(_read(spark, sf_dir, "documents"), token_folder(spark), tokenizer_path(), END_ID)
    return read_documents(files)


def op7_substring_dedup(spark, sf_dir):
    out = remove_repeats(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_fingerprints(spark, sf_dir):
    return with_edits(_read(spark, sf_dir, "documents"))


def op9_url_filter(spark, sf_dir):
    return filter_urls(_read(spark, sf_dir, "pages"))


def op10_decontamination(spark, sf_dir):
    out = find_contamination(_read(spark, sf_dir, "documents").select("doc_id", "text"),
                             _read(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return out.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                      F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"), "contaminated")


def op11_token_counts(spark, sf_dir):
    return count_tokens(_read(spark, sf_dir, "documents"), tokenizer_path())


def op12_lexical_search(spark, sf_dir):
    return lexical_search.rank_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op13_token_alignment(spark, sf_dir):
    return align_tokenizers(_read(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_chat_format": op3_chat_format,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_mixing": op5_mixing,
    "op6_token_files": op6_token_files,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_fingerprints": op8_fingerprints,
    "op9_url_filter": op9_url_filter,
    "op10_decontamination": op10_decontamination,
    "op11_token_counts": op11_token_counts,
    "op12_lexical_search": op12_lexical_search,
    "op13_token_alignment": op13_token_alignment,
}

__all__ = ["QUERIES", "ORACLES", "END_ID", "tokenizer_path"]
