"""Periods in the sizes of fragments: the twist of the helix and the nucleosome.

Sizes become one histogram in Spark; its spectrum, over ranges of sizes with a straight
line taken off, is searched for peaks that persist over wavelets of many widths.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The largest size with a bin of its own.
LARGEST = 1000
#: Ranges of sizes, the period looked for, and how far from it a peak may lie.
TWIST, NUCLEOSOME = (range(50, 401), 12.0, 5.0), (range(150, 701), 180.0, 30.0)
WIDTHS = np.arange(1, 25)


def size_histogram(fragments: DataFrame, largest: int = LARGEST) -> np.ndarray:
    """Counts of sizes 1 to ``largest``."""
    size = F.col("stop") - F.col("start")
    h = fragments.where((size >= 1) & (size <= largest)).groupBy(size.alias("size")).agg(F.count("*").alias("n")).collect()  # a row for each size
    out = np.zeros(largest)
    for r in h:
        out[r["size"] - 1] = r["n"]
    return out


def wavelet(n: int, width: float) -> np.ndarray:
    """``n`` points of the negative second derivative of a Gaussian."""
    x = (np.arange(n) - (n - 1) / 2) / width
    return 2 / (np.sqrt(3 * width) * np.pi**0.25) * (1 - x * x) * np.exp(-x * x / 2)


def transformed(y: np.ndarray, widths=WIDTHS) -> np.ndarray:
    """(widths, points): ``y`` seen through wavelets of each width."""
    return np.stack([np.convolve(y, wavelet(min(10 * int(w), len(y)), float(w))[::-1], mode="same") for w in widths])


def _tops(row: np.ndarray, reach: int) -> np.ndarray:
    """Places that exceed all others within ``reach``."""
    n, best = len(row), np.ones(len(row), bool)
    for k in range(1, reach + 1):
        left, right = row[np.maximum(np.arange(n) - k, 0)], row[np.minimum(np.arange(n) + k, n - 1)]
        best &= (row > left) & (row > right)
    return np.flatnonzero(best)


def ridges(seen: np.ndarray, widths=WIDTHS) -> list[list[tuple[int, int]]]:
    """Lines of maxima, each [(row, place)] from the widest wavelet down.

    A maximum joins the line that last was nearest, within a quarter of its width; a
    line that finds none in two rows running ends."""
    steps, done, alive = [_tops(row, int(max(1, np.ceil(w)))) for row, w in zip(seen, widths)], [], []
    for k in range(len(widths) - 1, -1, -1):
        free = set(steps[k].tolist())
        for line in alive:
            near = min(free, key=lambda p: abs(p - line[-1][1]), default=None)
            if near is not None and abs(near - line[-1][1]) <= max(1, widths[k] / 4):
                line.append((k, near))
                free.discard(near)
        done += [x for x in alive if x[-1][0] - k > 2]
        alive = [x for x in alive if x[-1][0] - k <= 2] + [[(k, p)] for p in sorted(free)]
    return done + alive


def peaks(y: np.ndarray, widths=WIDTHS, least_snr: float = 1.0, noise: float = 10.0) -> np.ndarray:
    """Places of peaks: ridges over a quarter of the widths whose narrowest response
    stands out from the low percentile of those around."""
    seen = transformed(y, widths)
    span = int(np.ceil(len(y) / 20))
    floor = [np.percentile(np.abs(seen[0][max(p - span // 2, 0) : p + span // 2 + 1]), noise) for p in range(len(y))]
    found = [x for x in ridges(seen, widths) if len(x) >= np.ceil(len(widths) / 4)]
    return np.unique([x[-1][1] for x in found if abs(seen[x[-1]]) >= least_snr * floor[x[-1][1]]]).astype(int)


def sharpened(y: np.ndarray, x: np.ndarray, frequency: float, step: float) -> float:
    """The period around a line of the spectrum that fits best, as a wave on a cubic."""
    z = (x - x.mean()) / (x[-1] - x[0])
    base = np.stack([z**k for k in range(4)], 1)

    def rest(f):
        a = np.hstack([base, np.cos(2 * np.pi * f * x)[:, None], np.sin(2 * np.pi * f * x)[:, None]])
        return float(((y - a @ np.linalg.lstsq(a, y, rcond=None)[0]) ** 2).sum())

    tried = np.linspace(max(frequency - 0.75 * step, 0.25 * step), frequency + 0.75 * step, 61)
    return float(1 / min(tried, key=rest))


def period(counts: np.ndarray, sizes: range, target: float, most: float) -> float | None:
    """The period nearest to ``target`` among the spectrum's peaks, if within ``most`` of it.

    A peak's place between two lines of the spectrum is sharpened by a fit."""
    x = np.array(sizes, float)
    y = counts[np.array(sizes) - 1]
    if not y.any():
        return None
    y = y - np.polyval(np.polyfit(x, y, 1), x)
    power, step = np.abs(np.fft.rfft(y)), 1 / len(x)

    def climbed(p):
        """The top of the slope on which a ridge ends."""
        while True:
            best = max(range(max(p - 1, 0), min(p + 2, len(power))), key=lambda q: power[q])
            if best == p:
                return p
            p = best

    found = [sharpened(counts[np.array(sizes) - 1], x, p * step, step) for p in sorted({climbed(int(p)) for p in peaks(power)} - {0})]
    best = min(found, key=lambda v: abs(v - target), default=None)
    return best if best is not None and abs(best - target) <= most else None


def periods(fragments: DataFrame) -> DataFrame:
    """(twist, nucleosome): the two periods, null where there is no peak near."""
    counts = size_histogram(fragments)
    return fragments.sparkSession.createDataFrame([(period(counts, *TWIST), period(counts, *NUCLEOSOME))], "twist double, nucleosome double")
