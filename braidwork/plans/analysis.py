"""Whole analyses as plans of operators: counting, putting libraries together, analysing again."""

from __future__ import annotations

import csv
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import fragments as fr
from ..operators import cellcalling, graph, inference, intervals, matrix, metrics, models, reduce
from ..operators.staged import settle


@dataclass(frozen=True)
class Parameters:
    """What a user may tune.  Fixed values: the names and defaults are part of the file format."""

    dim_reduce: str = "lsa"
    tsne_perplexity: int = 30
    tsne_max_dims: int = 2
    tsne_input_pcs: int = 15
    tsne_max_iter: int = 1000
    tsne_stop_lying_iter: int = 250
    tsne_mom_switch_iter: int = 250
    tsne_theta: float = 0.5
    random_seed: int = 0
    max_clusters: int = 10
    neighbor_a: float = -230.0
    neighbor_b: float = 120.0
    graphclust_neighbors: int = 0
    num_comps: int = 15
    num_dr_bcs: int | None = None
    num_dr_features: int | None = None
    num_analysis_bcs: int | None = None


def parse_parameters(text: str) -> Parameters:
    """Lines of name,value; comments and blank lines are skipped, unknown and repeated names refused."""
    known = {f.name: f.type for f in fields(Parameters)}
    found: dict = {}
    lines = [x for x in text.splitlines() if x.strip() and not x.startswith("#")]
    for row in csv.reader(lines):
        if len(row) != 2:
            raise ValueError(f"two columns are needed: {row}")
        name, value = row[0].strip().lower(), row[1].strip()
        if name not in known or name in found:
            raise ValueError(f"{'repeated' if name in found else 'unknown'} parameter: {name}")
        kind = str if known[name] == "str" else float if known[name] == "float" else int
        found[name] = kind(value)
    return replace(Parameters(), **found)


def coordinates(counts: DataFrame) -> DataFrame:
    """Peak by barcode counts with stable numbers: (feature_id, barcode_id, value), from names' hashes."""
    return counts.select(F.xxhash64("contig", "start", "end").alias("feature_id"), F.xxhash64("barcode").alias("barcode_id"), F.col("n").alias("value"))


def count(fragments: DataFrame, peaks: DataFrame | None = None, whitelist: int = cellcalling.WHITELIST, excluded: DataFrame | None = None, force: int | None = None) -> dict[str, DataFrame]:
    """Peaks, cells and the peak by cell counts of one library.

    Cells are called by a fit to the barcodes' fragments in peaks, less what stray
    fragments add; ``excluded`` (barcode) can't be cells, ``force`` asks for so many."""
    peaks = settle(inference.call_peaks(fragments) if peaks is None else peaks)
    targeted = settle(intervals.overlap_join(fragments, peaks, "left_semi").groupBy("barcode").agg(F.count("*").alias("n")).withColumn("species", F.lit("")))
    barred = None if excluded is None else excluded.select(F.lit("").alias("species"), "barcode")
    cells, summary = cellcalling.call(targeted, fragments.count(), whitelist, barred, None if force is None else {"default": force})
    cells = settle(cells.select("barcode"))
    counts = fr.peak_matrix(fragments.join(cells, "barcode", "left_semi"), peaks)
    return {"peaks": peaks, "cells": cells, "counts": counts, "calling": summary.get("", {})}


def differential(counts: DataFrame, labels: DataFrame, covariates: DataFrame | None = None) -> DataFrame:
    """Each cluster of (barcode_id, label) against the rest: negative binomial regressions on
    depth and ``covariates`` (barcode_id, more), with each feature's own dispersion.

    (feature_id, label, log2_ratio, z, p_value, adjusted)."""
    m = settle(counts.join(labels.select("barcode_id"), "barcode_id", "left_semi"))
    moments = matrix.moments(m, "feature_id", labels.count())
    own = settle(moments.select("feature_id", F.greatest((F.col("var") - F.col("mean")) / (F.col("mean") * F.col("mean")), F.lit(1e-4)).alias("alpha")))
    extra = () if covariates is None else tuple(c for c in covariates.columns if c != "barcode_id")
    named = labels.select("barcode_id", "label") if covariates is None else labels.select("barcode_id", "label").join(covariates, "barcode_id")
    return inference.clusters_against_rest(m, settle(named), dispersions=own, covariates=extra)


def analyse(counts: DataFrame, p: Parameters) -> dict[str, DataFrame]:
    """Reduction, k-means for 2 to ``max_clusters``, graph clusters and their differential
    features, of a count matrix (feature_id, barcode_id, value).

    Vectors of lsa and plsa are brought to length one before they are clustered.  The
    tsne parameters have no effect, and ``num_dr_bcs`` and ``num_dr_features`` none on plsa."""
    m = matrix.above_threshold(counts, 0)
    if p.num_analysis_bcs is not None:
        m = matrix.select(m, _some(m, p.num_analysis_bcs, p.random_seed), "barcode_id")
    m = settle(m)
    how = {"features": p.num_dr_features, "fit_on": None if p.num_dr_bcs is None else settle(_some(m, p.num_dr_bcs, p.random_seed))}
    kinds = {"lsa": lambda: reduce.lsa(m, p.num_comps, seed=p.random_seed, **how), "pca": lambda: reduce.pca(m, p.num_comps, seed=p.random_seed, **how), "plsa": lambda: reduce.plsa(m, p.num_comps, seed=p.random_seed).withColumnRenamed("topics", "score")}
    if p.dim_reduce not in kinds:
        raise ValueError(f"no such reduction: {p.dim_reduce}")
    scores = settle(kinds[p.dim_reduce]())
    points = scores if p.dim_reduce == "pca" else settle(scores.withColumn("score", _unit(F.col("score"))))
    out = {"scores": scores}
    for k in range(2, p.max_clusters + 1):
        out[f"kmeans_{k}_clusters"] = models.kmeans(points, k, seed=p.random_seed + 1)
    near = graph.neighbour_count(points.count(), p.graphclust_neighbors, p.neighbor_a, p.neighbor_b)
    if near:
        edges = settle(graph.nearest(points, "barcode_id", "score", near).select("src", "dst"))
        found = graph.communities(edges).withColumnRenamed("node", "barcode_id")
        out["graphclust"] = settle(matrix.relabel_by_size(found, "barcode_id", "community"))
        out["differential"] = differential(m, out["graphclust"])
    return out


def _some(m: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` barcodes in the order of a seeded hash, which is as good as drawn."""
    return m.select("barcode_id").distinct().orderBy(F.xxhash64("barcode_id", F.lit(seed)), "barcode_id").limit(n)


def _unit(v):
    """A vector at length one; one of zeros becomes one of equal numbers."""
    moved = F.transform(v, lambda x: x + F.lit(1e-120))
    top = F.array_max(F.transform(moved, lambda x: F.abs(x)))  # squares of 1e-120 would vanish
    even = F.transform(moved, lambda x: x / top)
    return F.transform(even, lambda x: x / F.sqrt(F.aggregate(even, F.lit(0.0), lambda a, b: a + b * b)))


def aggregate(fragments: DataFrame, cells: DataFrame, kind: str | None = "unique", seed: int = 0) -> dict[str, DataFrame]:
    """Libraries (a column ``library``) at equal depth as one, with peaks called anew."""
    rates = metrics.library_depth(fragments, cells, kind or "unique")
    return count(metrics.combined(fragments, rates, kind, seed))
