"""Motifs in peaks by classes of G and C content.

Peaks fall into bins of their content; each bin has a background of its own, the same
for both strands, and each motif a score cutoff for each bin, worked out once.  Hits
become a motif by peak matrix, and with peak by barcode counts a motif by barcode one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import matrix
from .annotation import log_odds
from .staged import settle

#: Quantiles of the content that bound the bins, and the range in which bounds may lie.
BINS, LOW, HIGH = 25, 0.33, 0.7
#: The chance that a random place reaches a motif's cutoff.
P_VALUE = 1e-7
BASES = "ACGT"
#: Letters that are scanned at once, or those of one peak.
TOGETHER = 1 << 18
_HITS = "id long, motif string, at int, strand string, score double"


def base_counts(peaks: DataFrame, seq: str = "seq") -> DataFrame:
    """``peaks`` with ``a``, ``c``, ``g`` and ``t`` counts in either case and the content
    ``gc`` of all letters."""
    upper = F.upper(F.coalesce(F.col(seq), F.lit("")))
    counted = peaks.withColumns({b.lower(): F.length(upper) - F.length(F.replace(upper, F.lit(b), F.lit(""))) for b in BASES})
    return counted.withColumn("gc", F.coalesce(F.try_divide(F.col("g") + F.col("c"), F.length(upper)), F.lit(0.0)))


def binned(peaks: DataFrame, bins: int = BINS, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Peaks with counts and ``gc_bin``: how many bounds lie at or below the content.

    Bounds are the distinct exact quantiles of the content inside [low, high)."""
    counted = base_counts(peaks)
    # Contents are shares of short lengths, so distinct ones are few.
    cuts = counted.agg(F.percentile("gc", [k / bins for k in range(1, bins)]).alias("q"))
    cuts = cuts.select(F.array_sort(F.array_distinct(F.filter("q", lambda x: (x >= low) & (x < high)))).alias("_cuts"))
    return counted.join(F.broadcast(cuts)).withColumn("gc_bin", F.size(F.filter("_cuts", lambda c: c <= F.col("gc")))).drop("_cuts")


def backgrounds(peaks: DataFrame, pseudo: float = 1.0) -> DataFrame:
    """(gc_bin, peaks, at, cg): chances of A (and T) and of C (and G) in each bin of ``binned``."""
    s = peaks.groupBy("gc_bin").agg(F.count("*").alias("peaks"), *[F.sum(b).alias(b) for b in "acgt"])
    share = lambda x, y: ((F.col(x) + F.col(y)) / 2 + pseudo) / (F.col("a") + F.col("c") + F.col("g") + F.col("t") + 4 * pseudo)
    return s.select("gc_bin", "peaks", share("a", "t").alias("at"), share("c", "g").alias("cg"))


def whole_cutoff(whole: np.ndarray, background: np.ndarray, p_value: float) -> int:
    """The least sum of whole scores that random sequence reaches with at most ``p_value``."""
    low, dist = whole.min(0), np.ones(1)
    for col in (whole - low).T:
        new = np.zeros(len(dist) + col.max())
        for b in range(4):
            new[col[b] : col[b] + len(dist)] += background[b] * dist
        dist = new
    tail = np.cumsum(dist[::-1])[::-1]
    ok = np.flatnonzero(tail <= p_value * (1 + 1e-12))
    return int(low.sum() + (ok[0] if len(ok) else len(dist)))


class Scanner:
    """Log odds of both strands and cutoffs of every motif against one background.

    Odds count in whole thousandths, so that a cutoff's chance is exact."""

    def __init__(self, motifs: dict[str, np.ndarray], at: float, cg: float, p_value: float, pseudo: float):
        background = np.array([at, cg, cg, at])
        self.background = background / background.sum()
        self.ready = []
        for name, counts in motifs.items():
            whole = np.rint(1000 * log_odds(np.asarray(counts, float), self.background, pseudo)).astype(np.int64)
            pad = lambda m: np.vstack([m, np.full(m.shape[1], -(1 << 40))])  # noqa: E731  other letters never fit
            self.ready.append((name, pad(whole), pad(whole[::-1, ::-1]), whole_cutoff(whole, self.background, p_value)))

    def hits(self, seq: np.ndarray):
        """(motif, strand, places, scores) of each motif and strand that fits somewhere."""
        for name, fore, back, cut in self.ready:
            width = fore.shape[1]
            if len(seq) < width:
                continue
            for strand, m in (("+", fore), ("-", back)):
                score = np.zeros(len(seq) - width + 1, np.int64)
                for j in range(width):
                    score += m[seq[j : j + len(score)], j]
                at = np.flatnonzero(score >= cut)
                if len(at):
                    yield name, strand, at, score[at] / 1000


_CODE = np.full(256, 4, np.int8)
for _k, _b in enumerate(BASES):
    _CODE[ord(_b)] = _CODE[ord(_b.lower())] = _k


def laid(peaks: pd.DataFrame, scanner: Scanner):
    """Frames of hits of (id, seq) peaks laid end to end, a letter that never fits between them."""
    ids, seqs = peaks["id"].to_numpy(), [(seq or "").encode() for seq in peaks["seq"]]
    ends = np.cumsum([len(seq) + 1 for seq in seqs])
    lo = 0
    while lo < len(seqs):
        past = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, past + TOGETHER, side="right")))
        starts = np.concatenate([[0], ends[lo : hi - 1] - past])
        for name, strand, at, score in scanner.hits(_CODE[np.frombuffer(b" ".join(seqs[lo:hi]), np.uint8)]):
            of = np.searchsorted(starts, at, side="right") - 1
            yield pd.DataFrame({"id": ids[lo + of], "motif": name, "at": (at - starts[of]).astype(np.int32), "strand": strand, "score": score})
        lo = hi


def scan(peaks: DataFrame, motifs: dict[str, np.ndarray], p_value: float = P_VALUE, pseudo: float = 1.0) -> DataFrame:
    """(id, motif, at, strand, score): where (id, seq, gc_bin, ...) of ``binned`` fits a motif.

    ``motifs`` are base counts, rows A, C, G and T, a bounded set.  Peaks are scanned
    where they are: a bin's scores are worked out once in a task, when it is first met,
    and its peaks are laid end to end."""
    known = {r["gc_bin"]: (r["at"], r["cg"]) for r in backgrounds(peaks, pseudo).collect()}  # a row for each bin
    shared = peaks.sparkSession.sparkContext.broadcast((motifs, known))

    def run(pdfs):
        (motifs, known), ready = shared.value, {}
        for pdf in pdfs:
            for gc, own in pdf.groupby("gc_bin", sort=False):
                if gc not in ready:
                    ready[gc] = Scanner(motifs, *known[gc], p_value, pseudo)
                yield from laid(own, ready[gc])

    return peaks.select(F.col("id").cast("long").alias("id"), "seq", "gc_bin").mapInPandas(run, _HITS)


def hits_matrix(hits: DataFrame, motifs: list[str], binary: bool = True) -> DataFrame:
    """(motif_id, feature_id, weight): motifs by peaks, numbered in the order of ``motifs``;
    1 where there is a hit, or how many there are."""
    names = hits.sparkSession.createDataFrame([(n, k) for k, n in enumerate(motifs)], "motif string, motif_id long")
    per = hits.groupBy("motif", F.col("id").alias("feature_id")).agg(F.count("*").alias("n"))
    weight = F.lit(1).cast("long") if binary else F.col("n")
    return per.join(F.broadcast(names), "motif").select("motif_id", "feature_id", weight.alias("weight"))


def formatted(hits: DataFrame, peaks: DataFrame, form: str = "bed") -> DataFrame:
    """A scan's result in one of five shapes; ``peaks`` has (id, contig, start, ...).

    bed: (contig, start, end, motif, score, strand, id) of every hit, needs ``width`` in
    ``hits``; motif: (motif, n); position: (id, motif, positions) in order; count: (id,
    motif, n); binary: (id, motif)."""
    if form == "motif":
        return hits.groupBy("motif").agg(F.count("*").alias("n"))
    if form == "count":
        return hits.groupBy("id", "motif").agg(F.count("*").alias("n"))
    if form == "binary":
        return hits.select("id", "motif").distinct()
    if form == "position":
        return hits.groupBy("id", "motif").agg(F.array_sort(F.collect_list("at")).alias("positions"))
    if form == "bed":
        placed = hits.join(peaks.select("id", "contig", "start"), "id")
        return placed.select("contig", (F.col("start") + F.col("at")).alias("start"), (F.col("start") + F.col("at") + F.col("width")).alias("end"), "motif", "score", "strand", "id")
    raise ValueError(f"no such form: {form}")


def with_width(hits: DataFrame, motifs: dict[str, np.ndarray]) -> DataFrame:
    """Hits with the ``width`` of their motif."""
    width = hits.sparkSession.createDataFrame([(n, int(np.asarray(c).shape[1])) for n, c in motifs.items()], "motif string, width int")
    return hits.join(F.broadcast(width), "motif")


def motif_counts(peaks: DataFrame, counts: DataFrame, motifs: dict[str, np.ndarray], p_value: float = P_VALUE, bins: int = BINS) -> dict[str, DataFrame]:
    """The whole path over (id, seq) peaks, whose ids are the features of ``counts``.

    ``peaks`` with their bins, ``hits``, ``counts`` (motif_id, barcode_id, value), and
    ``deviations`` of each motif's counts from their median."""
    classes = settle(binned(peaks, bins))
    hits = settle(scan(classes, motifs, p_value))
    m = settle(matrix.matmul(hits_matrix(hits, list(motifs)), counts, "motif_id"))
    return {"peaks": classes, "hits": hits, "counts": m, "deviations": matrix.mad_zscore(m, "motif_id")}
