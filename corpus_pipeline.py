"""Corpus preparation: stages over documents, each written as Parquet and read again by the next.

Toxic documents go, one document of each near-duplicate group stays, passages that an earlier document holds are cut,
documents with benchmark passages go, and what is left is encoded. Every stage reads only its predecessor's rows (and
``labels`` or ``benchmark`` of ``sf_dir``); all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm import bpe, decontaminate, simhash, substring_dedup, toxicity
from candela.llm.common import stored
from candela.llm.queries import TOKENIZER, table, toxicity_fold


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches 0.3 go; labels are learnt from the rows not held out."""
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=toxicity_fold)
    return toxicity.drop_toxic(docs, weights)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprints (three-word shingles, two bits) the document with the smallest id stays."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in 13-word windows that start in a document of smaller id go; a text that loses words becomes its kept
    words joined by one space (an empty text if none is kept), and its n_chars follows."""
    out = substring_dedup.remove_repeats(docs, window=13)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a 10-word window of a benchmark item go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, their number, and digests of the ids and of the text decoded from them."""
    return bpe.round_trip(docs, TOKENIZER, with_ids=True, block_bytes=8 << 20)


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_duplicates), ("substring_dedup", cut_repeats),
          ("benchmark_decontamination", drop_contaminated), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


#: The first stage is a learnt model, which SQL cannot state; tests hold every stage against a plain version.
ORACLE_SQL = None
ENTRY = {"pipeline": (run, ORACLE_SQL)}
