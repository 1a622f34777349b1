"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; sorted by rank
over the source's size, all sources run evenly through one sequence, and cutting it
into equal runs gives every shard the mixture of the whole.

No source, however hot, is ever in one task: ranks come from a range partitioning
on (source, hash) and a running sum over the partitions' counts, positions from one
more on the fractional rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import free_name, stage

SEED = 1


def _numbered(df: DataFrame, label: str) -> DataFrame:
    """``df``, sorted within range partitions, with its partition and its place there."""
    low = (1 << 33) - 1
    return stage(df.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit(low))), label)


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, source, shard, slot): one row for each row.

    Shards differ in rows by one at most; slots run without gaps from 0.  Size is the
    text's UTF-8 bytes (null: none) plus 16.  Rows with a null source form a source
    of their own; null ids and repeated rows are rows like others, told apart by
    their texts' hashes and then by chance alone.  An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("source"),
        F.xxhash64(F.lit(seed), F.col(id_col), text).alias("_draw"),
    )
    key = ["source", "_draw", "doc_id"]
    ranked = _numbered(rows.repartitionByRange(*key).sortWithinPartitions(*key), "by-source")
    # A row for each source and partition; a source's window holds a row for each partition at most.
    counts = ranked.groupBy("source", "_part").agg(F.count("*").alias("n"), F.min("_at").alias("first"))
    over = Window.partitionBy("source").orderBy("_part")
    ahead = counts.select("source", "_part", (F.sum("n").over(over) - F.col("n") - F.col("first")).alias("shift"), F.sum("n").over(Window.partitionBy("source")).alias("of"))
    share = ((F.col("_at") + F.col("shift") + 0.5) / F.col("of")).alias("share")
    mixed = ranked.join(ahead, ["source", "_part"]).select("doc_id", "size", "text_crc32", "source", "_draw", share)
    order = ["share", "_draw", "source", "doc_id"]
    placed = _numbered(mixed.repartitionByRange(*order).sortWithinPartitions(*order), "mixed")
    # One number for each partition.
    parts = sorted((r["_part"], r["n"]) for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect())
    total, before = 0, []
    for part, n in parts:
        before.append((part, total))
        total += n
    first = placed.sparkSession.createDataFrame(before, "_part long, _before long")
    at = F.col("_at") + F.col("_before")
    shard = F.expr(f"(_at + _before) * {shards} div {max(total, 1)}")
    # The first position of shard s is the least p with p * shards >= s * total.
    start = F.expr(f"(shard * {total} + {shards} - 1) div {shards}")
    out = placed.join(F.broadcast(first), "_part").select("doc_id", "size", "text_crc32", "source", at.alias("_p"), shard.alias("shard"))
    return out.select("doc_id", "size", "text_crc32", F.when(F.col("source") != "", F.expr("substr(source, 2)")).alias("source"), F.col("shard").cast("int").alias("shard"), (F.col("_p") - start).cast("long").alias("slot"))


def write_shards(docs: DataFrame, assigned: DataFrame, folder: str, id_col: str = "doc_id") -> None:
    """The rows of ``docs`` in a folder for each shard, the files' rows in slot order.

    Ids must be unique; a null id is told like any other.  Rows are dealt out by ranges
    of (shard, slot), so a shard is as many files as its size asks for.  The added
    columns are ``shard`` and ``slot``, with underscores before them where ``docs`` has
    such columns itself."""
    key, shard, slot = free_name(docs, "id"), free_name(docs, "shard"), free_name(docs, "slot")
    places = assigned.select(F.col("doc_id").alias(key), F.col("shard").alias(shard), F.col("slot").alias(slot))
    keyed = docs.join(places, docs[id_col].eqNullSafe(places[key])).drop(key)
    keyed.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(folder)
