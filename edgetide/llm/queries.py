"""The registered queries of this subpackage: name -> function of (session, table folder)."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgetide.llm.brown import score_documents
from edgetide.llm.contamination import find_contamination
from edgetide.llm.embeddings import near_duplicate_vectors
from edgetide.llm.language import identify
from edgetide.llm.minhash import near_duplicates
from edgetide.llm.mixing import mix_documents
from edgetide.llm.packing import pack_documents
from edgetide.llm.pii import KINDS, find_personal_data, spans_text
from edgetide.llm.prefix_trie import conversation_trie
from edgetide.llm.quality import judge_documents
from edgetide.llm.runs import periodic_runs
from edgetide.llm.sharding import shard_documents
from edgetide.llm.simple8b import round_trip

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_pivot_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir))


def op4_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_documents(spark, sf_dir))


def op5_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir))


def op6_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_documents(spark, sf_dir))


def op7_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(_documents(spark, sf_dir))

    def count(kind: int, name: str):
        # the function has one argument: a second one, even a default, would be the element's place
        of_kind = F.filter("base", lambda x: x["kind"] == kind)
        return F.size(of_kind).cast("bigint").alias(f"n_{name}")

    counts = [count(kind, name) for kind, name in enumerate(KINDS[:4])]
    digest = F.sha2(spans_text(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, spans_text(F.col("spans")).alias("spans"))


def op8_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(_documents(spark, sf_dir)).drop("left")


def op9_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_documents(spark, sf_dir))


def op10_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(_documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op11_euler_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations, a row for each node; see ``conversation_trie``."""
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document shares with the benchmark; ``n_near_items`` counts proximity matches."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_contamination(_documents(spark, sf_dir), benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        F.col("n_near").alias("n_near_items"),
    )


def op13_square_catchers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every text, after the rewriting that the ids ask for; see ``periodic_runs``."""
    return periodic_runs(_documents(spark, sf_dir))


def registered() -> dict[str, Query]:
    return {
        "op1_pivot_permutation": op1_pivot_permutation,
        "op2_lpt_shards": op2_lpt_shards,
        "op3_bounded_packing": op3_bounded_packing,
        "op4_simple8b": op4_simple8b,
        "op5_bottom_k": op5_bottom_k,
        "op6_brown_classes": op6_brown_classes,
        "op7_boosted_pii": op7_boosted_pii,
        "op8_line_cleaning": op8_line_cleaning,
        "op9_kneser_ney_language": op9_kneser_ney_language,
        "op10_pivotal_mix": op10_pivotal_mix,
        "op11_euler_trie": op11_euler_trie,
        "op12_positional_index": op12_positional_index,
        "op13_square_catchers": op13_square_catchers,
    }

