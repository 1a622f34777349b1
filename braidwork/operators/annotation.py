"""Peaks and genes: nearest starts, promoter and distal calls, base content and motifs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .intervals import BIN, overlap_join
from .scan import running
from .staged import settle

#: A peak from 1000 before to 100 behind a start is its promoter; one within 200000 is distal to it.
BEFORE, BEHIND, FAR = 1000, 100, 200_000


def nearest_starts(peaks: DataFrame, starts: DataFrame) -> DataFrame:
    """(contig, start, end, gene, distance): the nearest starts of each peak, ties all listed.

    The distance is 0 where they overlap, else bases between plus one, negative
    upstream of the start with regard to its strand."""
    sites = starts.select("contig", F.col("start").alias("_t")).distinct()
    p = settle(peaks.select("contig", "start", "end"))
    kind = "struct<contig:string,start:bigint,end:bigint>"
    rows = p.select("contig", F.col("start").alias("_p"), F.lit(None).cast("long").alias("_t"), F.struct("contig", "start", "end").cast(kind).alias("_k"))
    mark = sites.select("contig", F.col("_t").alias("_p"), "_t", F.lit(None).cast(kind).alias("_k"))
    tie = [F.col("_t").asc_nulls_last()]
    low = running(rows.unionByName(mark), ["contig"], "_p", F.col("_t"), "near", "max", then=tie).where("_k is not null").select("_k", "near")
    # from the peak's last base on, the next start; inside the peak, any start
    ends = p.select("contig", F.col("start").alias("_p"), F.lit(None).cast("long").alias("_t"), F.struct("contig", "start", "end").cast(kind).alias("_k"))
    high = running(ends.unionByName(mark), ["contig"], "_p", F.col("_t"), "near", "min", then=tie, down=True).where("_k is not null").select("_k", "near")
    gap = F.when(F.col("near") < F.col("start"), F.col("start") - F.col("near")).when(F.col("near") >= F.col("end"), F.col("near") - F.col("end") + 1).otherwise(0)
    first = low.unionByName(high).where("near is not null").select("_k.*", "near").withColumn("gap", gap).distinct()
    inside = overlap_join(p.withColumnRenamed("end", "stop"), starts.select("contig", "start", "end"), touching=False, bin_width=BIN).select("contig", "start", F.col("stop").alias("end"), F.col("r_start").alias("near"), F.lit(0).cast("long").alias("gap")).distinct()
    every = settle(first.unionByName(inside).distinct())
    least = every.groupBy("contig", "start", "end").agg(F.min("gap").alias("gap"))
    best = every.join(least, ["contig", "start", "end", "gap"])
    g = starts.select("contig", F.col("start").alias("near"), F.col("name").alias("gene"), "strand")
    ahead = (F.col("near") > F.col("start")) == (F.col("strand") != "-")
    return best.join(g, ["contig", "near"]).select("contig", "start", "end", "gene", F.when(F.col("gap") == 0, 0).when(ahead, -F.col("gap")).otherwise(F.col("gap")).cast("long").alias("distance"))


def annotate(peaks: DataFrame, starts: DataFrame, transcripts: DataFrame | None = None) -> DataFrame:
    """(contig, start, end, gene, distance, kind): promoter, distal or intergenic.

    A gene counts once per distance and kind, and a promoter's gene isn't distal too;
    transcripts that a peak overlaps make it distal at 0, if it has no other tie to
    the gene.  Peaks without any are intergenic, with null gene and distance."""
    key = ["contig", "start", "end"]
    peaks = settle(peaks.select("contig", "start", "end"))
    near = nearest_starts(peaks, starts)
    promoter = F.col("distance").between(-BEFORE, BEHIND)
    kind = F.when(promoter, "promoter").when(F.abs("distance") <= FAR, "distal")
    called = near.withColumn("kind", kind).where("kind is not null").distinct()
    first = called.groupBy(*key, "gene").agg(F.bool_or(F.col("kind") == "promoter").alias("p"))
    called = settle(called.join(first, [*key, "gene"]).where("kind = 'promoter' or not p").drop("p"))
    if transcripts is not None:
        body = overlap_join(peaks.withColumnRenamed("end", "stop"), transcripts.select("contig", "start", "end", "name"), touching=False, bin_width=BIN)
        body = body.select("contig", "start", F.col("stop").alias("end"), F.col("r_name").alias("gene")).distinct().join(called, [*key, "gene"], "left_anti")
        called = called.unionByName(body.withColumns({"distance": F.lit(0).cast("long"), "kind": F.lit("distal")}).select(called.columns))
    rest = peaks.select(*key).join(called, key, "left_anti")
    return called.unionByName(rest.select(*key, F.lit(None).cast(called.schema["gene"].dataType).alias("gene"), F.lit(None).cast("long").alias("distance"), F.lit("intergenic").alias("kind")).select(called.columns))


def collapsed(annotated: DataFrame) -> DataFrame:
    """One row for each peak: genes, distances and kinds joined by semicolons, sorted as strings."""
    text = F.struct(F.coalesce("gene", F.lit("")).alias("g"), F.coalesce(F.col("distance").cast("string"), F.lit("")).alias("d"), F.col("kind").alias("k"))
    rows = F.array_sort(F.collect_set(text))
    one = lambda f: F.array_join(F.transform("rows", lambda r: r[f]), ";")
    return annotated.groupBy("contig", "start", "end").agg(rows.alias("rows")).select("contig", "start", "end", one("g").alias("genes"), one("d").alias("distances"), one("k").alias("kinds"))


def gc_bins(peaks: DataFrame, gc: str, quantiles: int = 25, low: float = 0.33, high: float = 0.7) -> DataFrame:
    """``peaks`` with ``gc_bin``: how many of the distinct quantile bounds inside [low, high) lie at or below the content."""
    bounds = peaks.agg(F.percentile_approx(gc, [k / quantiles for k in range(1, quantiles)], 1_000_000).alias("q"))
    cut = bounds.select(F.array_sort(F.array_distinct(F.filter("q", lambda x: (x >= low) & (x < high)))).alias("cuts"))
    return peaks.join(F.broadcast(cut)).withColumn("gc_bin", F.size(F.filter("cuts", lambda c: c <= F.col(gc)))).drop("cuts")


def log_odds(counts: np.ndarray, background: np.ndarray, pseudo: float = 1.0) -> np.ndarray:
    """(4, width) log2 odds of a motif's base counts against the background."""
    p = (counts + pseudo * background[:, None]) / (counts.sum(0) + pseudo)
    return np.log2(p / background[:, None])


def score_cutoff(odds: np.ndarray, background: np.ndarray, p_value: float, steps: int = 1000) -> float:
    """The least score that random sequence reaches with at most ``p_value`` (exact on a grid of scores)."""
    low = odds.min(0).sum()
    unit = max((odds.max(0).sum() - low) / steps, 1e-12)
    whole = np.floor((odds - odds.min(0)) / unit).astype(int)
    dist = np.ones(1)
    for col in whole.T:
        new = np.zeros(len(dist) + col.max())
        for b in range(4):
            new[col[b] : col[b] + len(dist)] += background[b] * dist
        dist = new
    tail = np.cumsum(dist[::-1])[::-1]
    ok = np.flatnonzero(tail <= p_value)
    return float(low + unit * ok[0]) if len(ok) else float("inf")


def scan_motifs(sequences: DataFrame, motifs: dict[str, np.ndarray], p_value: float = 1e-4, background: tuple[float, ...] = (0.25, 0.25, 0.25, 0.25)) -> DataFrame:
    """(id, motif, at, strand, score) of every place in (id, seq) that fits a motif.

    ``motifs`` are base counts, rows A, C, G and T; they are a bounded set that goes
    with the tasks.  Both strands are scanned; places with other letters never fit."""
    bg = np.array(background)
    ready = {}
    for name, counts in motifs.items():
        odds = log_odds(np.asarray(counts, float), bg)
        ready[name] = (odds, odds[::-1, ::-1], score_cutoff(odds, bg, p_value))

    def run(pdfs):
        code = np.full(256, 4)
        for k, (x, y) in enumerate(("Aa", "Cc", "Gg", "Tt")):
            code[ord(x)] = code[ord(y)] = k
        for pdf in pdfs:
            rows = []
            for i, s in zip(pdf["id"], pdf["seq"]):
                c = code[np.frombuffer((s or "").encode(), np.uint8)]
                for name, (fore, back, cut) in ready.items():
                    w = fore.shape[1]
                    if len(c) < w:
                        continue
                    view = np.lib.stride_tricks.sliding_window_view(c, w)
                    for strand, m in (("+", fore), ("-", back)):
                        padded = np.vstack([m, np.full(w, -np.inf)])
                        score = padded[view, np.arange(w)].sum(1)
                        rows += [(i, name, int(k), strand, float(score[k])) for k in np.flatnonzero(score >= cut)]
            yield pd.DataFrame(rows, columns=["id", "motif", "at", "strand", "score"])

    return sequences.select(F.col("id").cast("long").alias("id"), "seq").mapInPandas(run, "id long, motif string, at int, strand string, score double")
