"""Four-line sequence records from text files that Spark may split anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sequence as seq
from ..operators.staged import settle


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, name, seq, qual); gzip or plain.

    Lines are numbered within each block of a file, blocks are counted, and a running
    sum over a file's blocks (one row each) gives every line its number; records are
    the groups of four."""
    lines = spark.read.text(path).select("value", F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("at"))
    lines = settle(lines)
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    number = F.col("at") - F.col("first") + F.col("before")
    numbered = lines.join(blocks.withColumn("before", before), ["file", "block"]).select("file", "value", F.floor(number / 4).alias("record"), (number % 4).alias("line"))
    part = lambda k: F.max(F.when(F.col("line") == k, F.col("value")))
    return numbered.groupBy("file", "record").agg(F.substring(part(0), 2, 1 << 30).alias("name"), part(1).alias("seq"), part(3).alias("qual"))


def paired(one: DataFrame, two: DataFrame) -> DataFrame:
    """Mates joined on the name before the first space."""
    key = F.split_part("name", F.lit(" "), F.lit(1)).alias("qname")
    return one.select(key, F.col("seq").alias("seq1"), F.col("qual").alias("qual1")).join(two.select(key, F.col("seq").alias("seq2"), F.col("qual").alias("qual2")), "qname")


def quality_yield(reads: DataFrame, by: list[str], cutoff: int = 30) -> DataFrame:
    """(by, reads, bases, good, share) of bases of at least ``cutoff``."""
    good = seq.bases_at_least(F.col("qual"), cutoff)
    out = reads.groupBy(*by).agg(F.count("*").alias("reads"), F.sum(F.length("qual")).alias("bases"), F.sum(good).alias("good"))
    return out.withColumn("share", F.try_divide("good", "bases"))


def demultiplex(reads: DataFrame, samples: DataFrame, index: str = "index") -> DataFrame:
    """``reads`` with ``sample``: that of an equal index, or of the only one at a single change; else null."""
    known = samples.select(F.col("index").alias("_i"), "sample")
    cand = reads.select(index).distinct()
    near = cand.select(index, F.explode(F.concat(F.array(F.col(index)), seq.neighbours(F.col(index)))).alias("_i"))
    hit = near.join(known, "_i").withColumn("_d", (F.col("_i") != F.col(index)).cast("int"))
    best = hit.groupBy(index).agg(F.min("_d").alias("d"), F.count_if(F.col("_d") == 1).alias("n1"), F.min_by("sample", "_d").alias("sample"))
    return reads.join(best.where("d = 0 or n1 = 1").select(index, "sample"), index, "left")
