"""Statistical helpers: columns, small aggregates and numpy kernels for grouped maps."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def effective_diversity(c: Column) -> Column:
    return F.try_divide(F.pow(F.sum(c), F.lit(2.0)), F.sum(c * c))


def entropy(p: Column) -> Column:
    return F.sum(F.when(p > 0, -p * F.log2(p)).otherwise(0.0))


def kl_divergence(p: Column, q: Column) -> Column:
    return F.sum(F.when(p > 0, p * F.log2(p / q)).otherwise(0.0))


def bhattacharyya(p: Column, q: Column) -> Column:
    return F.sum(F.sqrt(p * q))


def cosine_distance(a: Column, b: Column) -> Column:
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0), lambda acc, z: acc + z)

    return 1 - dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def nx(lengths: DataFrame, length: str, fraction: float) -> DataFrame:
    """The largest length such that lengths of at least it make up ``fraction`` of all.

    Equal lengths are counted first, so the running sum is over distinct lengths."""
    from ..operators.ranks import folded, ordered

    h = lengths.groupBy(length).agg(F.sum(length).alias("s"))
    total = h.agg(F.sum("s").alias("t"))
    run = folded(ordered(h, F.col(length).desc()), F.col("s"), "c")
    return run.join(F.broadcast(total)).where(F.col("c") >= fraction * F.col("t")).agg(F.max(length).alias("nx"))


def bh_adjust(p: DataFrame, key: str, value: str) -> DataFrame:
    """``p`` with ``adjusted``: step-up false discovery rates; null values have none.

    Equal p-values are one row in the running aggregates and share their result."""
    from ..operators.ranks import folded, ordered

    groups = p.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_n"))
    down = folded(ordered(groups, F.col(value).desc()), F.col("_n"), "_down")  # how many are at least as large
    total = down.agg(F.sum("_n").alias("_total"))
    q = down.join(F.broadcast(total)).withColumn("_q", F.col(value) * F.col("_total") / (F.col("_total") - F.col("_down") + F.col("_n")))
    q = folded(q.select(value, "_q", "_part", "_at"), F.col("_q"), "_least", "min")
    return p.join(q.select(value, F.least("_least", F.lit(1.0)).alias("adjusted")), value, "left")


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """(rho): correlation of average ranks."""
    from ..operators.ranks import folded, ordered

    def ranked(x):
        g = folded(ordered(df.groupBy(x).agg(F.count("*").alias("_same")), F.col(x)), F.col("_same"), "_to")
        return g.select(x, (F.col("_to") - (F.col("_same") - 1) / 2.0).alias(f"rank_{x}"))

    both = df.join(ranked(a), a).join(ranked(b), b)
    return both.agg(F.corr(f"rank_{a}", f"rank_{b}").alias("rho"))


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    """(r): correlation; rows with a null are left out."""
    return df.agg(F.corr(a, b).alias("r"))


def good_turing(counts: list[int], frequencies: list[int]) -> tuple[np.ndarray, float]:
    """(expected share of one item of each count, share of the unseen): simple Good-Turing."""
    r, n = np.asarray(counts, float), np.asarray(frequencies, float)
    total = (r * n).sum()
    unseen = (n[0] if len(r) and r[0] == 1 else 0.0) / total
    before, after = np.concatenate([[0], r[:-1]]), np.concatenate([r[1:], [2 * r[-1] - (r[-2] if len(r) > 1 else 0)]])
    z = 2 * n / (after - before)
    slope = np.polyfit(np.log(r), np.log(z), 1)[0] if len(r) > 1 else -1.0
    if slope > -1:
        raise ValueError(f"the frequencies fall too slowly (slope {slope:.3f}) for Good-Turing smoothing")
    smooth = r * (1 + 1 / r) ** (slope + 1)
    at = {int(k): v for k, v in zip(r, n)}
    out, by_curve = np.zeros(len(r)), False
    for k, x in enumerate(r):
        y = smooth[k]
        nxt = at.get(int(x) + 1)
        if not by_curve and nxt:
            turing = (x + 1) * nxt / n[k]
            sd = math.sqrt((x + 1) ** 2 * nxt / n[k] ** 2 * (1 + nxt / n[k]))
            if abs(turing - y) > 1.65 * sd:
                out[k] = turing
                continue
        by_curve = True
        out[k] = y
    return (1 - unseen) * out / (out * n).sum(), unseen


def lgamma(x) -> np.ndarray:
    """The log of the gamma function of positive numbers, by Stirling's series from 8 upwards."""
    x = np.array(x, float)
    down = np.zeros(x.shape)
    low = x < 8
    if low.any():
        y = x[low]
        product = np.ones(y.shape)
        for _ in range(8):
            small = y < 8
            product = np.where(small, product * y, product)
            y = np.where(small, y + 1, y)
        x[low], down[low] = y, np.log(product)
    r = 1 / (x * x)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r * (1 / 1188 - r * 691 / 360360))))) / x
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series - down


def digamma(x) -> np.ndarray:
    """The derivative of ``lgamma`` at positive numbers, by its series from 10 upwards."""
    x = np.array(x, float)
    down = np.zeros(x.shape)
    for _ in range(10):
        low = x < 10
        down = down + np.where(low, 1 / x, 0.0)
        x = np.where(low, x + 1, x)
    r = 1 / (x * x)
    return np.log(x) - 0.5 / x - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r / 132)))) - down


def nb_dispersion(values: np.ndarray, weights: np.ndarray, least: float = 1e-6, most: float = 1e6) -> float:
    """The dispersion of largest likelihood of a negative binomial histogram.

    The score in the size r = 1 / dispersion is a sum of digammas over distinct counts;
    its root is bracketed on a logarithmic scale.  Counts that vary no more than
    Poisson ones have none, and give ``least``."""
    n = weights.sum()
    if n <= 0:
        return least
    mean = (weights * values).sum() / n
    if mean <= 0 or (weights * (values - mean) ** 2).sum() / n <= mean:
        return least
    score = lambda r: (weights * (digamma(values + r) - digamma(np.full(1, r)))).sum() / n + math.log(r / (r + mean))
    low, high = math.log(1 / most), math.log(1 / least)  # the score falls through zero between them
    if score(math.exp(high)) >= 0:
        return least
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if score(math.exp(mid)) > 0 else (low, mid)
    return math.exp(-(low + high) / 2)


def nb_cdf(k: float, mu: float, phi: float) -> float:
    """The chance of at most ``k`` counts."""
    r = 1 / phi
    return incomplete_beta(r, k + 1.0, r / (r + mu)) if k >= 0 else 0.0


def log_nb_pmf(k: np.ndarray, mu: float, phi: float) -> np.ndarray:
    """Log probabilities of a negative binomial with mean ``mu`` and dispersion ``phi``."""
    r = 1 / phi
    k = np.asarray(k, float)
    return lgamma(k + r) - lgamma(k + 1.0) - math.lgamma(r) + r * math.log(r / (r + mu)) + k * math.log(mu / (r + mu))


def fit_two_nb(values: np.ndarray, weights: np.ndarray, cut: float, rounds: int = 250, eps: float = 1e-6) -> dict:
    """A mixture of two negative binomials fitted to a histogram by expectation-maximisation."""
    resp = np.where(values > cut, 1.0, 0.0)
    params, last = None, None
    for _ in range(rounds):
        parts = []
        for share in (1 - resp, resp):
            w = weights * share
            n = max(w.sum(), 1e-12)
            mu = max((w * values).sum() / n, 1e-6)
            var = (w * (values - mu) ** 2).sum() / n
            parts.append((mu, max(1e-6, (var - mu) / mu**2), n))
        (m0, a0, n0), (m1, a1, n1) = parts
        frac = n1 / (n0 + n1)
        l0 = log_nb_pmf(values, m0, a0) + math.log(max(1 - frac, 1e-300))
        l1 = log_nb_pmf(values, m1, a1) + math.log(max(frac, 1e-300))
        top = np.maximum(l0, l1)
        p0, p1 = np.exp(l0 - top), np.exp(l1 - top)
        resp = p1 / (p0 + p1)
        params = np.array([m0, a0, m1, a1, frac])
        if last is not None and np.all(np.abs(params - last) <= eps * np.maximum(np.abs(last), 1e-12)):
            break
        last = params
    return dict(zip(("mu_noise", "alpha_noise", "mu_signal", "alpha_signal", "signal_share"), params.tolist()))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 10_000):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + top * d, 1 + top / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            out *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return front * out


def student_sf(t: float, df: float) -> float:
    """The chance that a Student t variable exceeds ``t``."""
    half = incomplete_beta(df / 2, 0.5, df / (df + t * t)) / 2
    return half if t >= 0 else 1 - half
