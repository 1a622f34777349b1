"""A training corpus in five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet in the cluster's shared folder and reads it again for the next.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.llm import decontaminate, packing, quality_cnn, secrets, simhash
from braidwork.llm.registry import tokenizer_path
from braidwork.llm.staging import free_name, stage

#: No stage but decontamination and packing can be told in SQL; the stages are
#: tested against brute force instead.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from ``labels``, does not reject."""
    net = quality_cnn.train(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    return quality_cnn.with_score(docs, net, out=score).where(F.col(score) >= quality_cnn.CUT).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies: texts whose
    sets of five-word shingles have a similarity of 0.8 or more."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; ``n_chars`` follows a changed text."""
    was, now = free_name(docs, "was"), F.crc32(F.col("text").cast("binary"))
    masked = secrets.redact(docs.withColumn(was, now))
    changed = ~F.col(was).eqNullSafe(now)
    return masked.select(*[F.when(changed, F.char_length("text").cast("long")).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality classifier", quality), ("SimHash near-dedup", near_duplicates), ("benchmark decontamination", decontamination), ("secret scans", secret_scan), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
