"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.decontamination import judge_documents
from tallyhouse.llm.exact_dedup import exact_duplicates
from tallyhouse.llm.language_id import identify
from tallyhouse.llm.ngram_join import near_duplicate_classes
from tallyhouse.llm.packing import pack
from tallyhouse.llm.prefix_trie import prefix_trie
from tallyhouse.llm.quality_cnn import quality_scores
from tallyhouse.llm.spelling_variants import spelling_variants
from tallyhouse.llm.substring_dedup import remove_repeats
from tallyhouse.llm.topk_search import top_k
from tallyhouse.llm.url_filter import ALLOW, BLOCK, host_and_path, judge_urls
from tallyhouse.llm.warc import derivatives, responses
from tallyhouse.llm.wordpiece import token_counts
from tallyhouse.llm.work_tables import reach_workers

Query = Callable[[SparkSession, str], DataFrame]

#: The rules that the url query judges by (host, path, verdict).
RULES = [
    ("com", "/", ALLOW),
    ("example.com", "/en/", BLOCK),
    ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK),
    ("net", "/fr/", BLOCK),
]


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{path}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, path: str) -> DataFrame:
    return near_duplicate_classes(table(spark, path, "documents")).drop("row_id", "component")


def op2_decontamination(spark: SparkSession, path: str) -> DataFrame:
    judged = judge_documents(table(spark, path, "documents"), table(spark, path, "benchmark"))
    ids = F.sha2(F.array_join("items", ","), 256)
    return judged.withColumn("items_sha256", ids).drop("row_id", "items")


def op3_warc_derivatives(spark: SparkSession, path: str) -> DataFrame:
    """Metadata and conversion records of every page's response record."""
    records = responses(table(spark, path, "pages"))
    return derivatives(records, id_column="page_id").drop("record")


def op4_quality_cnn(spark: SparkSession, path: str) -> DataFrame:
    return quality_scores(table(spark, path, "documents"), table(spark, path, "labels"))


def op5_substring_dedup(spark: SparkSession, path: str) -> DataFrame:
    return remove_repeats(table(spark, path, "documents")).drop("row_id", "removed")


def op6_language_id(spark: SparkSession, path: str) -> DataFrame:
    """Language of every page, with text likelihoods from all documents."""
    pages = table(spark, path, "pages").withColumnRenamed("url", "url_text")
    host, _ = host_and_path(F.col("url_text"))
    rows = pages.select(
        F.col("page_id").alias("row_id"),
        F.col("html").alias("text"),
        host.alias("host"),
        F.lit(None).cast("string").alias("declared"),
    )
    judged = identify(rows, table(spark, path, "documents"), markup=True)
    return judged.select(
        F.col("row_id").alias("page_id"), "host", "declared", "n_pairs", "text_language", "language", "probability"
    )


def op7_maxscore_search(spark: SparkSession, path: str) -> DataFrame:
    vectors = table(spark, path, "embeddings")
    return top_k(vectors, F.col("vec_id") % 100 == 0)


def op8_token_counts(spark: SparkSession, path: str) -> DataFrame:
    return token_counts(table(spark, path, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op9_url_filter(spark: SparkSession, path: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, path, "pages"), rules)


def op10_best_fit_packing(spark: SparkSession, path: str) -> DataFrame:
    return pack(table(spark, path, "documents"), tokenizer_file("word_bpe_49k.json"))


def op11_spelling_variants(spark: SparkSession, path: str) -> DataFrame:
    return spelling_variants(table(spark, path, "documents"))


def op12_prefix_trie(spark: SparkSession, path: str) -> DataFrame:
    return prefix_trie(table(spark, path, "conversations"))


def op13_exact_dedup(spark: SparkSession, path: str) -> DataFrame:
    return exact_duplicates(table(spark, path, "documents"))


def llm_queries() -> dict[str, Query]:
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op2_decontamination": op2_decontamination,
        "op3_warc_derivatives": op3_warc_derivatives,
        "op4_quality_cnn": op4_quality_cnn,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_language_id": op6_language_id,
        "op7_maxscore_search": op7_maxscore_search,
        "op8_token_counts": op8_token_counts,
        "op9_url_filter": op9_url_filter,
        "op10_best_fit_packing": op10_best_fit_packing,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_exact_dedup": op13_exact_dedup,
    }
