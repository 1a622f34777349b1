"""Fragments: cut sites, peaks, counts per barcode, duplicates and adjacency."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import BIN, depth, merge, overlap_join, point_join
from .ranks import ranked

#: Half of the window that each cut site counts in, and the gap that peaks bridge.
HALF_WINDOW, PEAK_GAP = 200, 500


def cut_sites(fragments: DataFrame) -> DataFrame:
    """(contig, barcode, pos): both ends of every fragment."""
    return fragments.select("contig", "barcode", F.explode(F.array("start", "stop")).alias("pos"))


def windowed_depth(fragments: DataFrame, half: int = HALF_WINDOW, length: int | None = None) -> DataFrame:
    """Step function of cut sites within ``half`` of each position, clipped to the contig."""
    end = F.col("pos") + half + 1
    sites = cut_sites(fragments).select("contig", F.greatest(F.lit(0), F.col("pos") - half).alias("start"), (F.least(end, F.lit(length)) if length else end).alias("end"))
    return depth(sites)


def depth_histogram(steps: DataFrame) -> DataFrame:
    """(depth, bases) without zero."""
    return steps.where("depth > 0").groupBy("depth").agg(F.sum(F.col("next_pos") - F.col("pos")).alias("bases"))


def bedgraph(steps: DataFrame, least: int = 1) -> DataFrame:
    """Runs of equal depth; gaps of zero depth separate runs."""
    return steps.where(F.col("depth") >= least).select("contig", F.col("pos").alias("start"), F.col("next_pos").alias("end"), "depth")


def call_peaks(steps: DataFrame, threshold: int, gap: int = PEAK_GAP) -> DataFrame:
    """Runs of at least ``threshold``, united over gaps."""
    high = steps.where(F.col("depth") >= threshold).select("contig", F.col("pos").alias("start"), F.col("next_pos").alias("end"))
    return merge(high, gap)


def peak_matrix(fragments: DataFrame, peaks: DataFrame) -> DataFrame:
    """(barcode, contig, start, end, n): cut sites of each barcode in each peak."""
    hits = point_join(cut_sites(fragments), peaks, bin_width=BIN)
    return hits.groupBy("barcode", "contig", F.col("r_start").alias("start"), F.col("r_end").alias("end")).agg(F.count("*").alias("n"))


def barcode_counts(fragments: DataFrame) -> DataFrame:
    return fragments.groupBy("barcode").agg(F.count("*").alias("unique_fragments"), F.sum("dup").alias("total_fragments"))


def classify(reads: DataFrame, mapq: Column, mate_mapq: Column, mito: Column, chimeric: Column, duplicate: Column) -> DataFrame:
    """``reads`` with ``class``; the order of the rules matters."""
    return reads.withColumn("class", F.when(F.least(mapq, mate_mapq) <= 30, "lowmapq").when(mito, "mitochondrial").when(chimeric, "chimeric").when(duplicate, "duplicate").otherwise("passed_filters"))


def targeting(fragments: DataFrame, tracks: dict[str, DataFrame]) -> DataFrame:
    """(barcode, n, one count for each track) of fragments that overlap the track.

    All tracks are one tagged table, so the fragments meet them in one join.  A track's
    regions are united first, so they lie apart, and a fragment counts with the first of
    them that it meets: pairs are added up where they arise, without telling them apart."""
    tagged = None
    for name, regions in tracks.items():
        rows = merge(regions.select("contig", "start", "end"), 0).withColumn("_track", F.lit(name))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    tagged = tagged.withColumn("_before", F.lag("end").over(Window.partitionBy("_track", "contig").orderBy("start")))
    met = overlap_join(fragments.select("contig", "start", "stop", "barcode"), tagged, "inner", bin_width=BIN)
    first = met.where(F.col("r__before").isNull() | (F.col("r__before") < F.col("start")))
    hits = first.groupBy("barcode").agg(*[F.count_if(F.col("r__track") == name).alias(name) for name in tracks])
    return fragments.groupBy("barcode").agg(F.count("*").alias("n")).join(hits, "barcode", "left").fillna(0, list(tracks))


def covered_bases(fragments: DataFrame, pad: int, length: int) -> DataFrame:
    """(barcode, covered) after padding; intervals that only touch are not united."""
    padded = fragments.select("contig", "barcode", F.greatest(F.col("start") - pad, F.lit(0)).alias("start"), F.least(F.col("stop") + pad, F.lit(length)).alias("end"))
    return merge(padded, 0, closed=False, key=["barcode", "contig"]).groupBy("barcode").agg(F.sum(F.col("end") - F.col("start")).alias("covered"))


def insert_sizes(fragments: DataFrame, most: int = 1000) -> DataFrame:
    """(barcode, size, n); all larger sizes count as ``most`` + 1."""
    size = F.least(F.col("stop") - F.col("start"), F.lit(most + 1)).alias("size")
    return fragments.groupBy("barcode", size).agg(F.count("*").alias("n"))


def relative_positions(points: DataFrame, sites: DataFrame, reach: int, bin_width: int = BIN) -> DataFrame:
    """(offset, n) of points around site centres, turned by strand.

    Equal points, and equal sites, are counted first; a task then has the counts of one
    stretch of a contig and adds up, for its sites, the counts around them.  No pair of
    a point and a site is a row, so crowded places cost no more than the distinct sites."""
    stretch = lambda c: F.floor(c / bin_width)
    p = points.select("contig", F.col("pos").cast("long").alias("at")).where("at >= 0").groupBy("contig", "at").agg(F.count("*").alias("n"))
    p = p.select("contig", stretch(F.col("at")).alias("_bin"), "at", F.lit(0).alias("kind"), "n")
    # a site turned by its strand is of kind 2, others of 1
    kind = F.when(F.col("strand") == "-", 2).otherwise(1).alias("kind")
    c = sites.select("contig", F.col("start").cast("long").alias("at"), kind).where(F.col("at") >= -reach).groupBy("contig", "at", "kind").agg(F.count("*").alias("n"))
    bins = F.sequence(stretch(F.greatest(F.col("at") - reach, F.lit(0))), stretch(F.col("at") + reach))
    c = c.select("contig", F.explode(bins).alias("_bin"), "at", "kind", "n")
    width = 2 * reach + 1

    def around(pdf: pd.DataFrame) -> pd.DataFrame:
        first = int(pdf["_bin"].iloc[0]) * bin_width - 2 * reach  # room on both sides for sites just outside
        at, kind, n = (pdf["at"].to_numpy() - first), pdf["kind"].to_numpy(), pdf["n"].to_numpy()
        here = np.zeros(bin_width + 4 * reach, np.int64)
        here[at[kind == 0]] = n[kind == 0]
        windows = np.lib.stride_tricks.sliding_window_view(here, width)
        total = np.zeros(width, np.int64)
        for k in (1, 2):
            middle, times = at[kind == k] - reach, n[kind == k]
            found = np.zeros(width, np.int64)
            for lo in range(0, len(middle), 256):
                found += times[lo : lo + 256] @ windows[middle[lo : lo + 256]]
            total += found if k == 1 else found[::-1]
        met = np.flatnonzero(total)
        return pd.DataFrame({"offset": met - reach, "n": total[met]})

    both = p.unionByName(c).where("contig is not null and _bin is not null")
    return both.groupBy("contig", "_bin").applyInPandas(around, "offset long, n long").groupBy("offset").agg(F.sum("n").alias("n"))


def adjacency(fragments: DataFrame) -> DataFrame:
    """(barcode, other, n): how often a fragment of one ends where one of the other starts.

    Places are counted per barcode first, so a crowded place meets as barcodes, not as fragments."""
    ends = fragments.groupBy("contig", F.col("stop").alias("at"), "barcode").agg(F.count("*").alias("n"))
    starts = fragments.groupBy("contig", F.col("start").alias("at"), F.col("barcode").alias("other")).agg(F.count("*").alias("m"))
    pairs = ends.join(starts, ["contig", "at"]).where("barcode <> other")
    return pairs.groupBy("barcode", "other").agg(F.sum(F.col("n") * F.col("m")).alias("n"))


def nearest_partner(pairs: DataFrame) -> DataFrame:
    """(barcode, other): the partner of most links, the smaller name on ties."""
    return pairs.where("n > 0").groupBy("barcode").agg(F.min_by("other", F.struct((-F.col("n")).alias("n"), "other")).alias("other"))


def mutual_partners(pairs: DataFrame) -> DataFrame:
    """Pairs that are each other's nearest partner, the smaller name first."""
    near = nearest_partner(pairs)
    back = near.select(F.col("barcode").alias("other"), F.col("other").alias("barcode"))
    return near.join(back, ["barcode", "other"]).where("barcode < other")


def representatives(reads: DataFrame, key: list[str], barcode: str = "barcode", name: str = "qname") -> DataFrame:
    """One read of each footprint: the most common barcode's (smaller name on ties), least read name; with the group's size."""
    counts = reads.groupBy(*key, barcode).agg(F.count("*").alias("_n"), F.min(name).alias("_first"))
    return counts.groupBy(*key).agg(F.sum("_n").alias("copies"), F.min_by(F.struct(barcode, "_first"), F.struct((-F.col("_n")).alias("n"), barcode)).alias("r")).select(*key, f"r.{barcode}", F.col("r._first").alias(name), "copies")


def duplicate_histogram(fragments: DataFrame) -> DataFrame:
    """(barcode, dup, n), and the bulk under a null barcode."""
    return fragments.groupingSets([["barcode", "dup"], ["dup"]], "barcode", "dup").agg(F.count("*").alias("n"))


def downsample_curve(histogram: DataFrame, rates: list[float]) -> DataFrame:
    """(rate, total, distinct) expected when keeping each read with a probability."""
    r = F.explode(F.array(*[F.lit(x) for x in rates])).alias("rate")
    return histogram.select("dup", "n", r).groupBy("rate").agg((F.first("rate") * F.sum(F.col("n") * F.col("dup"))).alias("total"), F.sum(F.col("n") * (1 - F.pow(1 - F.col("rate"), F.col("dup")))).alias("distinct"))


def first_reason(lists: list[tuple[str, DataFrame]], key: list[str]) -> DataFrame:
    """Union of exclusion lists; of a key's reasons the earliest list's counts."""
    out = None
    for k, (reason, df) in enumerate(lists):
        rows = df.select(*key, F.lit(reason).alias("reason"), F.lit(k).alias("_k"))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy(*key).agg(F.min_by("reason", "_k").alias("reason"))


def knee(counts: DataFrame, value: str) -> DataFrame:
    """``counts`` with ``rank`` by descending value; ties by name."""
    return ranked(counts, F.col(value).desc(), F.col("barcode"))
