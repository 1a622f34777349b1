"""Neighbour graphs and communities."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .communities import Rounds
from .neighbours import nearest  # noqa: F401  part of this module's interface
from .ranks import ranked
from .staged import settle


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(modularity) of a labelling of an undirected graph; each row is an edge."""
    a = edges.join(labels.select(F.col("node").alias("src"), F.col("community").alias("cs")), "src")
    a = a.join(labels.select(F.col("node").alias("dst"), F.col("community").alias("cd")), "dst")
    ends = a.select(F.explode(F.array("cs", "cd")).alias("c"), (F.col("cs") == F.col("cd")).cast("int").alias("inn")).groupBy("c").agg(F.count("*").alias("tot"), F.sum("inn").alias("inn"))
    return ends.agg((F.sum("inn") / F.sum("tot") - F.sum(F.col("tot") * F.col("tot")) / (F.sum("tot") * F.sum("tot"))).alias("modularity"))


def symmetric(edges: DataFrame) -> DataFrame:
    """(src, dst, w) in both directions, equal edges added up; loops count in both."""
    w = F.col("w") if "w" in edges.columns else F.lit(1)
    one = edges.select("src", "dst", w.alias("w"))
    return one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def renumbered(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges over 0 to n - 1, (node, number)): nodes numbered in their own order."""
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    names = ranked(nodes, F.col("node"), out="number").withColumn("number", F.col("number") - 1)
    named = edges.join(names.select(F.col("node").alias("src"), F.col("number").alias("_s")), "src").join(names.select(F.col("node").alias("dst"), F.col("number").alias("_d")), "dst")
    return named.select(F.col("_s").alias("src"), F.col("_d").alias("dst"), *[c for c in edges.columns if c not in ("src", "dst")]), names


def contracted(both: DataFrame, labels: DataFrame) -> DataFrame:
    """The graph of the communities: weights between them added, those inside as loops."""
    a = both.join(labels.select(F.col("node").alias("src"), F.col("community").alias("_s")), "src")
    a = a.join(labels.select(F.col("node").alias("dst"), F.col("community").alias("_d")), "dst")
    return a.groupBy(F.col("_s").alias("src"), F.col("_d").alias("dst")).agg(F.sum("w").alias("w"))


def weighted_modularity(both: DataFrame, labels: DataFrame) -> float:
    """Modularity of a labelling of a ``symmetric`` graph."""
    c = contracted(both, labels)
    per = c.groupBy("src").agg(F.sum("w").alias("tot"), F.sum(F.when(F.col("src") == F.col("dst"), F.col("w")).otherwise(0)).alias("inn"))
    return per.agg((F.sum("inn") / F.sum("tot") - F.sum(F.col("tot") * F.col("tot")) / F.pow(F.sum("tot"), F.lit(2))).alias("q")).first()["q"] or 0.0


def moved(both: DataFrame, epsilon: float) -> tuple[DataFrame, float]:
    """(labels, modularity) after local moves, until two rounds gain ``epsilon`` at most.

    Half of the nodes, by a hash of node and round, may move in a round, which breaks the
    swaps that moving all at once would cause.  The best labelling met is returned, so a
    round never costs anything.  The rounds are those of ``communities.Rounds``."""
    rounds = Rounds(both)
    best, found, idle, r = rounds.modularity(0), 0, 0, 0
    while idle < 2:
        r += 1
        now = rounds.modularity(r)
        idle = 0 if now > best + epsilon else idle + 1
        if now > best:
            best, found = now, r
    return rounds.labels(found), best


def hierarchy(edges: DataFrame, epsilon: float = 1e-6) -> list[DataFrame]:
    """[(node, community)] of every level: local moves, contraction of the communities,
    and again on what is left, until a level gains ``epsilon`` at most."""
    both, levels, before = settle(symmetric(edges)), [], None
    while True:
        labels, q = moved(both, epsilon)
        if before is not None and q <= before + epsilon:
            return levels
        if levels:
            inner = labels.select(F.col("node").alias("community"), F.col("community").alias("_to"))
            levels.append(settle(levels[-1].join(inner, "community").select("node", F.col("_to").alias("community"))))
        else:
            levels.append(labels)
        both, before = settle(contracted(both, labels)), q


def communities(edges: DataFrame, epsilon: float = 1e-6) -> DataFrame:
    """(node, community): the last level of ``hierarchy``; a graph without edges has none."""
    return hierarchy(edges, epsilon)[-1]


def neighbour_count(n: int, least: int, a: float = -230, b: float = 120) -> int:
    """How many neighbours a graph of ``n`` points takes: more for larger ones, below n."""
    return max(1, min(n - 1, max(least, round(a + b * math.log10(n))))) if n > 1 else 0


def batch_mixing(edges: DataFrame, batches: DataFrame) -> DataFrame:
    """(score): the mean, over points, of the share of neighbours in the point's own
    batch over that batch's share of all points; 1 where batches are mixed."""
    share = batches.groupBy("batch").agg(F.count("*").alias("_n")).join(F.broadcast(batches.agg(F.count("*").alias("_all")))).select("batch", (F.col("_n") / F.col("_all")).alias("_share"))
    named = edges.join(batches.select(F.col("node").alias("src"), "batch"), "src").join(batches.select(F.col("node").alias("dst"), F.col("batch").alias("_other")), "dst")
    per = named.groupBy("src", "batch").agg(F.avg((F.col("batch") == F.col("_other")).cast("double")).alias("_same"))
    return per.join(share, "batch").agg(F.avg(F.col("_same") / F.col("_share")).alias("score"))
