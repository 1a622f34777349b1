"""Which barcodes are cells: two negative binomials in the histogram of targeted counts.

All that reaches the driver is a histogram for each species, one row for each distinct
count; thresholds of every kind come from it, and barcodes are only filtered.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import stats

#: Barcodes of a species that can be cells; distinct counts that a fit needs; odds of a cell.
MOST_CELLS, LEAST_COUNTS, ODDS = 20_000, 10, 20.0
#: What every barcode gets of all fragments by contamination, and at least.
STRAY, LEAST_SHIFT = 0.02, 5
#: Barcodes of the usual whitelist.
WHITELIST = 737_280


def shift_of(fragments: int, whitelist: int) -> int:
    """Counts that a barcode of ``whitelist`` has without a cell."""
    return max(LEAST_SHIFT, int(fragments * STRAY / whitelist))


def start_of(k: np.ndarray, w: np.ndarray, share: float = 0.01) -> float:
    """The largest count below which ``share`` of the reads lie, but not the first or last count."""
    reads = np.cumsum(k * w) / max((k * w).sum(), 1)
    under = k[reads <= share]
    return float(np.clip(under[-1] if len(under) else k[1], k[1], k[-2]))


def fit(k: np.ndarray, w: np.ndarray, start: float | None = None, rounds: int = 250, eps: float = 1e-6) -> dict | None:
    """Noise and signal of a histogram of ``w`` barcodes with ``k`` counts, dispersions by
    largest likelihood; None if one of the two is empty at the start."""
    signal = (k > (start_of(k, w) if start is None else start)).astype(float)
    if not signal.any() or signal.all():
        return None
    last = None
    for _ in range(rounds):
        parts = []
        for share in (1 - signal, signal):
            own = w * share
            n = max(own.sum(), 1e-300)
            parts.append((n, max((own * k).sum() / n, 1e-9), stats.nb_dispersion(k, own)))
        if parts[0][1] > parts[1][1]:
            parts.reverse()
        (n0, m0, a0), (n1, m1, a1) = parts
        now = np.array([m0, a0, m1, a1, n0 / (n0 + n1)])
        if last is not None and (np.abs(last - now) <= eps * now).all():
            break
        last = now
        odds = _log_odds(k, now)
        signal = 1 / (1 + np.exp(np.clip(-odds, -700, 700)))
    return dict(zip(("noise_mean", "noise_dispersion", "signal_mean", "signal_dispersion", "fraction_noise"), now.tolist()))


def _log_odds(k: np.ndarray, p) -> np.ndarray:
    m0, a0, m1, a1, noise = p
    log = lambda x: math.log(max(x, 1e-300))
    return stats.log_nb_pmf(k, m1, a1) + log(1 - noise) - stats.log_nb_pmf(k, m0, a0) - log(noise)


def threshold(found: dict, odds: float = ODDS) -> int:
    """The first count, from the noise's mean and the signal's lowest thousandth upwards,
    that is ``odds`` times likelier signal; the signal's mean where none is."""
    m1, a1 = found["signal_mean"], found["signal_dispersion"]
    top = int(m1)
    k = np.arange(top + 1, dtype=float)
    below = np.cumsum(np.exp(stats.log_nb_pmf(k, m1, a1)))
    least = max(int(found["noise_mean"]), int(np.searchsorted(below, 0.001)))
    k = np.arange(least, top + 1, dtype=float)
    good = k[_log_odds(k, tuple(found.values())[:5]) >= math.log(odds)] if len(k) else k
    return int(good[0]) if len(good) else max(least, top)


def goodness(k: np.ndarray, w: np.ndarray, found: dict) -> float:
    """The largest distance between the histogram and the fitted distribution function."""
    noise = found["fraction_noise"]
    cdf = np.array([noise * stats.nb_cdf(x, found["noise_mean"], found["noise_dispersion"]) + (1 - noise) * stats.nb_cdf(x, found["signal_mean"], found["signal_dispersion"]) for x in k])
    seen = np.cumsum(w) / w.sum()
    return float(max(np.abs(seen - cdf).max(), np.abs(np.concatenate([[0], seen[:-1]]) - cdf).max()))


def forced_threshold(k: np.ndarray, w: np.ndarray, cells: int) -> int | None:
    """The count of the ``cells``-th largest barcode of those above zero."""
    some = k > 0
    if not some.any():
        return None
    k, w = k[some][::-1], w[some][::-1]
    return int(k[min(int(np.searchsorted(np.cumsum(w), cells)), len(k) - 1)])


def _histograms(counts: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    h = counts.groupBy("species", "n").agg(F.count("*").alias("w")).toPandas().sort_values("n")
    return {s: (g["n"].to_numpy(float), g["w"].to_numpy(float)) for s, g in h.groupby("species")}


def call(counts: DataFrame, fragments: int, whitelist: int = WHITELIST, excluded: DataFrame | None = None, force: dict[str, int] | None = None, refit: bool = False) -> tuple[DataFrame, dict[str, dict]]:
    """(cells, summary) of targeted counts (species, barcode, n).

    ``fragments`` and ``whitelist`` give what stray fragments add to every barcode; it is
    taken off before the fit.  ``excluded`` (species, barcode) can't be cells.  ``force``
    names how many cells a species has ("default": any other), all that tie with the
    last included; more than MOST_CELLS, asked for or found, are brought down to the
    threshold of that many.  A species of under LEAST_COUNTS distinct counts has no
    cells.  ``refit`` fits two species again over barcodes that reach a threshold of
    either, which leaves out the common noise, and takes the larger threshold.

    cells: (species, barcode, n); summary: by species, what was fitted and found."""
    kept = counts if excluded is None else counts.join(excluded.select("species", "barcode").distinct(), ["species", "barcode"], "left_anti")
    shift, summary, force = shift_of(fragments, whitelist), {}, force or {}
    names = [r["species"] for r in counts.select("species").distinct().orderBy("species").collect()]  # species are few
    plain = _histograms(kept.where(F.col("n") >= shift))
    for s in names:
        k, w = plain.get(s, (np.empty(0), np.empty(0)))
        k = k - shift
        asked = force.get(s, force.get("default"))
        if asked is not None and asked <= 0:
            raise ValueError("the number of cells must be positive")
        asked = None if asked is None else min(asked, MOST_CELLS)
        found = {"cell_threshold": None, "estimated_cells_present": 0}
        if len(k) >= LEAST_COUNTS:
            if asked is None and (params := fit(k, w)):
                found |= params | {"goodness_of_fit": goodness(k, w, params), "estimated_cells_present": int((1 - params["fraction_noise"]) * w.sum())}
                found["cell_threshold"] = threshold(params) + shift
                if w[k + shift >= found["cell_threshold"]].sum() > MOST_CELLS:
                    asked = MOST_CELLS
            if asked is not None and (least := forced_threshold(k, w, asked)) is not None:
                found["cell_threshold"] = least + shift
        summary[s] = found
    cut = {s: f["cell_threshold"] for s, f in summary.items() if f["cell_threshold"] is not None}
    if refit and not force and len(cut) == len(names) == 2:
        reach = F.create_map(*[F.lit(x) for p in cut.items() for x in p])[F.col("species")]
        above = kept.where(F.col("n") >= reach).select("barcode").distinct()
        for s, (k, w) in _histograms(kept.join(above, "barcode", "left_semi")).items():
            again = fit(k, w, cut[s]) if len(k) >= LEAST_COUNTS else None
            if again:
                cut[s] = summary[s]["cell_threshold"] = max(cut[s], threshold(again))
    if not cut:
        cells = kept.limit(0).select("species", "barcode", "n")
    else:
        reach = F.create_map(*[F.lit(x) for p in cut.items() for x in p])[F.col("species")]
        cells = kept.where(F.col("n") >= reach).select("species", "barcode", "n")
    n = {r["species"]: r["cells"] for r in cells.groupBy("species").agg(F.count("*").alias("cells")).collect()}
    for s in names:
        summary[s]["cells_detected"] = n.get(s, 0)
    return cells, summary
