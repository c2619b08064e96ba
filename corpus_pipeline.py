"""The corpus pipeline: five stages over ``documents``, each calling one operator of prismtab.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last keep the columns of ``documents``.  ``run`` writes every stage's result
to the shared checkpoint folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismtab.llm import decontaminate, language, pieces, simhash, substrings
from prismtab.session import cut_lineage

#: the vocabulary file of the last stage
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an accepted language: no text without letters, none that looks like no language."""
    found = language.identify(docs, "text", F.col("lang"), F.col("source"), label="lang")
    return found.where("accepted").select(docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group (a missing doc_id comes last, then the text's hash decides)."""
    keyed = docs.withColumn("__key", F.struct(F.isnull("doc_id").alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("hash")))
    found = simhash.near_duplicates(keyed, "__key", "text", shingle=4, distance=4)
    first = found.where(F.col("key") == F.col("component")).select(F.col("key").alias("__key")).distinct()
    return keyed.join(first, "__key", "leftsemi").dropDuplicates(["__key"]).select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated 50-word windows; documents of which nothing is left go.  Other texts stay as they are."""
    left = substrings.remove_repeats(docs, "doc_id", "text", size=50)
    left = left.where("n_removed = 0 or n_removed < n_words")
    left = left.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")))
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    found = decontaminate.overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("matches") == 0).select(docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, texts untouched, with their piece ids and ``decoded``, the text that the ids give back (U+2581 as a space)."""
    coded = pieces.encode(docs, PIECES, decoded="decoded")
    kept = [c for c in docs.columns if c not in ("n_ids", "ids", "decoded")]
    return coded.select(*kept, F.size("ids").cast("long").alias("n_ids"), "ids", "decoded")


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: character models, fingerprints and piece ids are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
