"""Corpus pipeline over the documents table.

``STAGES`` are applied in order; each is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuescope.llm import mixing, pieces, simhash, substring, toxicity
from valuescope.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold (operator 4)."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of every SimHash group (operator 2)."""
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the sentence spans an earlier document has (operator 3), n_chars to match."""
    cut = substring.dedup(docs)
    return cut.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it (operator 8)."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, ids, lossless): sampled piece ids of every text (operator 7)."""
    return pieces.round_trip(docs).select("doc_id", "n_pieces", "ids", "lossless")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("mixing sources", mix_sources),
    ("sentencepiece", encode_pieces),
]

# A learned score, a transitive closure and seeded sampling: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, f"stage{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
