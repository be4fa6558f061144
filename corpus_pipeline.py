"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, directory of the tables) and returns a frame that is written as Parquet and
reread as the next stage's docs. All but the last return the columns of documents. Rows keep whatever
further columns they have. A null or empty text is rejected by the first stage, as it has no language.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.decontamination import judge_documents
from tallyhouse.llm.language_id import identify
from tallyhouse.llm.ngram_join import near_duplicate_classes
from tallyhouse.llm.packing import pack
from tallyhouse.llm.queries import table, tokenizer_file
from tallyhouse.llm.substring_dedup import remove_repeats
from tallyhouse.llm.work_tables import WorkTables

#: Tells rows apart by id and text, as the operators' row_id does.
KEY, CHANGE = "pipeline_row", "pipeline_change"
#: A language has to be at least so probable.
LEAST_PROBABILITY = 0.5

#: The near-duplicate classes, the hashes of windows and the tokens of a text are not expressible in SQL.
ORACLE_SQL = None


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(KEY, F.xxhash64("doc_id", "text"))


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """docs without the rows of the rejected row ids; a small list is broadcast, a long one shuffled."""
    gone = rejected.select(F.col("row_id").alias(KEY)).distinct()
    return _keyed(docs).join(gone, KEY, "left_anti").drop(KEY)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those of which no language is probable enough. The declared
    language is the column lang, the host is the source."""
    rows = docs.select(
        F.xxhash64("doc_id", "text").alias("row_id"),
        "text",
        F.col("source").alias("host"),
        F.col("lang").alias("declared"),
    )
    judged = identify(rows, docs, markup=False)
    rejected = judged.where((F.col("n_pairs") == 0) | (F.col("probability") < LEAST_PROBABILITY))
    return _without(docs, WorkTables(spark, "pipeline").keep(rejected.select("row_id"), "no-language"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each component the document with the smallest id, and one row of it."""
    work = WorkTables(spark, "pipeline")
    classes = near_duplicate_classes(docs).where(F.col("component").isNotNull())
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_id")
    kept = classes.groupBy("component").agg(F.min(place).alias("kept"), F.count("*").alias("n"))
    rejected = (
        classes.join(kept.where(F.col("n") > 1), "component")
        .where(F.col("row_id") != F.col("kept.row_id"))
        .select("row_id")
    )
    left = _without(docs, work.keep(rejected, "near-duplicates"))
    same = classes.groupBy("row_id").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    same = work.keep(same.select("row_id"), "equal-rows")
    if same.isEmpty():
        return left
    equal = same.select(F.col("row_id").alias(KEY))
    once = _keyed(left).join(equal, KEY, "left_semi").dropDuplicates([KEY]).drop(KEY)
    return _without(left, same).unionByName(once)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages out of the texts; documents of which no word is left go."""
    cut = remove_repeats(docs, with_text=True).where(F.col("n_removed") > 0)
    some_left = F.col("n_removed") < F.col("n_words")
    changed = cut.dropDuplicates(["row_id"]).select(
        F.col("row_id").alias(KEY), F.struct("kept_text", some_left.alias("some_left")).alias(CHANGE)
    )
    changed = WorkTables(spark, "pipeline").keep(changed, "changed")
    same = F.col(CHANGE).isNull()
    joined = _keyed(docs).join(changed, KEY, "left").where(same | F.col(f"{CHANGE}.some_left"))
    new = {"text": F.when(same, F.col("text")).otherwise(F.col(f"{CHANGE}.kept_text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(same, F.col("n_chars")).otherwise(F.length(new["text"]).cast(kind))
    return joined.select([new.get(c, F.col(c)).alias(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold passages of the benchmark."""
    judged = judge_documents(docs, table(spark, sf_dir, "benchmark"))
    rejected = judged.where("contaminated").select("row_id")
    return _without(docs, WorkTables(spark, "pipeline").keep(rejected, "contaminated"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their places in sequences."""
    return pack(docs, tokenizer_file("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", decontaminate),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents."""
    work = WorkTables(spark, "corpus-pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
