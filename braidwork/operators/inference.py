"""Tests and fits on grouped counts; aggregates by Spark, small kernels per group."""

from __future__ import annotations

import math
import warnings

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import stats
from .staged import settle

#: Counts that a simulated walk adds at once.
WALK = 1 << 20

#: Depth at which a site counts as enriched where there is too little data to fit.
DEFAULT_DEPTH = 15


def log_choose(n, k):
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """The chance of a table no likelier than [[a, b], [c, d]] with its margins."""
    n1, n2, m = a + b, c + d, a + c
    total = log_choose(n1 + n2, m)
    logp = lambda x: log_choose(n1, x) + log_choose(n2, m - x) - total
    here = logp(a)
    return min(1.0, sum(math.exp(p) for x in range(max(0, m - n2), min(n1, m) + 1) if (p := logp(x)) <= here + 1e-7))


def presence_test(m: DataFrame, groups: DataFrame) -> DataFrame:
    """(feature_id, in_a, in_b, log2_ratio, p_value): Fisher's test on how many barcodes of each group have the feature."""
    n = {r["in_group"]: r["n"] for r in groups.groupBy("in_group").agg(F.count("*").alias("n")).collect()}
    na, nb = n.get(True, 0), n.get(False, 0)
    per = m.where("value > 0").join(groups, "barcode_id").groupBy("feature_id").agg(F.count_if("in_group").alias("in_a"), F.count_if(~F.col("in_group")).alias("in_b"))

    @F.pandas_udf("double")
    def p(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([fisher_two_sided(x, y, na - x, nb - y) for x, y in zip(a, b)], dtype="float64")

    ratio = F.log2((F.col("in_a") + 1) * (nb + 2) / F.lit(float(na + 2)) / (F.col("in_b") + 1))
    per = settle(per)
    kinds = per.select("in_a", "in_b").distinct().withColumn("p_value", p("in_a", "in_b"))  # far fewer than features
    return per.join(kinds, ["in_a", "in_b"]).select("feature_id", "in_a", "in_b", ratio.alias("log2_ratio"), "p_value")


def size_factors(m: DataFrame) -> DataFrame:
    """(barcode_id, factor): counts over their median."""
    s = m.groupBy("barcode_id").agg(F.sum("value").alias("s"))
    med = s.agg(F.percentile("s", F.lit(0.5)).alias("med"))
    return s.join(F.broadcast(med)).select("barcode_id", (F.col("s") / F.col("med")).alias("factor"))


def shrunk_dispersions(m: DataFrame, quantile: float = 0.995) -> DataFrame:
    """(feature_id, mean, var, phi): method-of-moments dispersions drawn to a high quantile of themselves.

    Zeros have no rows: sums over entries and the number of barcodes give the moments."""
    f = size_factors(m)
    t = f.agg(F.count("*").alias("n"), F.sum(1 / F.col("factor")).alias("inv"))
    x = F.col("value") / F.col("factor")
    s = m.join(f, "barcode_id").groupBy("feature_id").agg(F.sum(x).alias("s"), F.sum(x * x).alias("q")).join(F.broadcast(t))
    g = s.select("feature_id", "n", "inv", (F.col("s") / F.col("n")).alias("mean"), (F.col("q") / F.col("n") - F.pow(F.col("s") / F.col("n"), 2)).alias("var")).where("var > 0")
    raw = F.greatest(F.lit(0.0), (F.col("n") * F.col("var") - F.col("mean") * F.col("inv")) / (F.pow("mean", F.lit(2)) * F.col("inv")))
    g = g.withColumn("raw", raw)
    a = g.agg(F.percentile("raw", F.lit(quantile)).alias("zeta"), F.avg("raw").alias("avg"), F.count("*").alias("k"), F.sum("raw").alias("s1"), F.sum(F.col("raw") * F.col("raw")).alias("s2"))
    around = lambda c: F.col("s2") - 2 * c * F.col("s1") + F.col("k") * c * c
    a = a.select("zeta", F.coalesce(F.try_divide(around(F.col("avg")) / (F.col("k") - 1), around(F.col("zeta")) / (F.col("k") - 2)), F.lit(1.0)).alias("delta"))
    return g.join(F.broadcast(a)).select("feature_id", "mean", "var", ((1 - F.col("delta")) * F.col("raw") + F.col("delta") * F.col("zeta")).alias("phi"))


#: Features whose regressions are solved together, and rows of the design at a time.
TOGETHER, DESIGNS = 256, 8192
#: Distinct (group, depth, covariates) rows, at most: they are the same for all features and are broadcast.
MOST_DESIGNS = 1 << 18


def count_regressions(y: np.ndarray, x: np.ndarray, w: np.ndarray, alpha: np.ndarray, rounds: int = 200, eps: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, covariances) of log-link negative binomial fits of many features.

    ``y`` (features, rows) holds sums of counts over the ``w`` barcodes of each design
    row of ``x``; as the score is linear in the counts, no more is needed.  Scoring
    steps go on until each feature's coefficients stand still, or until what a step
    would gain is nothing (a group without counts has no finite coefficient)."""
    n, p = len(y), x.shape[1]
    beta = np.zeros((n, p))
    rate = (y.sum(1) / w.sum())[:, None]
    start, weight = np.log(np.maximum((y + rate * w) / (2 * w), 1e-9)), w * x.T  # a fit to halfway between the counts and their mean
    beta = np.linalg.solve(weight @ x + 1e-10 * np.eye(p), (weight @ start.T)).T
    ridge, going, info = 1e-10 * np.eye(p), np.arange(n), np.zeros((n, p, p))
    outer = (x[:, :, None] * x[:, None, :]).reshape(len(x), p * p)
    for _ in range(rounds):
        a, score, now = alpha[going][:, None], np.zeros((len(going), p)), np.zeros((len(going), p * p))
        for lo in range(0, len(x), DESIGNS):
            at = slice(lo, lo + DESIGNS)
            mu = np.exp(np.clip(beta[going] @ x[at].T, -30, 30))
            over = 1 + a * mu
            score += ((y[going, at] - w[at] * mu) / over) @ x[at]
            now += (w[at] * mu / over) @ outer[at]
        now = now.reshape(-1, p, p) + ridge
        step = np.linalg.solve(now, score[:, :, None])[:, :, 0]
        gain = (step * score).sum(1)
        info[going] = now
        beta[going] += step * np.minimum(1, 4 / np.maximum(np.abs(step).max(1), 1e-300))[:, None]
        going = going[(np.abs(step).max(1) >= eps) & (gain >= 1e-10)]
        if not len(going):
            break
    return beta, np.linalg.inv(info)


def glm_test(m: DataFrame, groups: DataFrame, alpha: float = 1e-4, dispersions: DataFrame | None = None, covariates: tuple[str, ...] = ()) -> DataFrame:
    """(feature_id, log2_ratio, z, p_value, adjusted): a count regression per feature on
    group, log depth and ``covariates`` (numeric columns of ``groups``), and a one-sided
    Wald test of the groups' difference.

    ``alpha``: 1e-4 for nearly Poisson counts, 1 for geometric ones; ``dispersions``
    (feature_id, alpha) gives a feature its own.  Barcodes of equal group, depth and
    covariates are one row of the design, which is broadcast; there are as many at most
    as called cells, and more than MOST_DESIGNS is an error.  A feature is sent as its
    sums in the rows where it was seen, and TOGETHER features are solved at once.
    """
    depth = m.groupBy("barcode_id").agg(F.sum("value").alias("depth")).join(groups, "barcode_id")
    named = [F.col(c).cast("double").alias(f"_c{k}") for k, c in enumerate(covariates)]
    rows = settle(depth.select("barcode_id", F.col("in_group").cast("int").alias("_g"), F.col("depth").alias("_d"), *named))
    by = ["_g", "_d", *[f"_c{k}" for k in range(len(covariates))]]
    design = rows.groupBy(*by).agg(F.count("*").alias("_w"), F.min("barcode_id").alias("_row"))
    found = design.limit(MOST_DESIGNS + 1).toPandas()
    if len(found) > MOST_DESIGNS:
        raise ValueError(f"over {MOST_DESIGNS} different (group, depth, covariates): select cells first, or round the covariates")
    found = found.sort_values("_row").reset_index(drop=True)
    g = found["_g"].to_numpy(float)
    x = np.column_stack([g, 1 - g, np.log(found["_d"].to_numpy(float)), *[found[c].to_numpy(float) for c in by[2:]]])
    centre = x[:, 2:].mean(0) if len(x) else 0
    x[:, 2:] -= centre  # the intercepts take this up, their difference stays
    w = found["_w"].to_numpy(float)
    spark = m.sparkSession
    shared, free = spark.sparkContext.broadcast((x, w)), w.sum() - x.shape[1]
    place = spark.createDataFrame(pd.DataFrame({"_row": found["_row"], "_p": np.arange(len(found), dtype=np.int32)}), "_row long, _p int")
    place = design.select(*by, F.col("_row")).join(place, "_row")
    at = settle(rows.join(place, by).select("barcode_id", "_p"))
    sums = m.join(at, "barcode_id").groupBy("feature_id", "_p").agg(F.sum("value").cast("double").alias("y"))
    sums = sums.groupBy("feature_id").agg(F.collect_list(F.struct("_p", "y")).alias("s"))  # a row of the design at most once
    sums = sums.join(dispersions.select("feature_id", F.col("alpha").cast("double").alias("alpha")), "feature_id") if dispersions is not None else sums.withColumn("alpha", F.lit(float(alpha)))
    out = "feature_id long, log2_ratio double, z double, p_value double"

    def run(pdfs):
        x, w = shared.value
        for pdf in pdfs:
            for lo in range(0, len(pdf), TOGETHER):
                part = pdf.iloc[lo : lo + TOGETHER]
                y = np.zeros((len(part), len(x)))
                for k, s in enumerate(part["s"]):
                    y[k, [r["_p"] for r in s]] = [r["y"] for r in s]
                beta, var = count_regressions(y, x, w, part["alpha"].to_numpy(float))
                z = (beta[:, 0] - beta[:, 1]) / np.sqrt(np.maximum(var[:, 0, 0] + var[:, 1, 1] - 2 * var[:, 0, 1], 1e-300))
                p = [stats.student_sf(abs(v), free) if free > 0 else 1.0 for v in z]
                yield pd.DataFrame({"feature_id": part["feature_id"].to_numpy(), "log2_ratio": (beta[:, 0] - beta[:, 1]) / math.log(2), "z": z, "p_value": p})

    tested = settle(sums.select("feature_id", "s", "alpha").mapInPandas(run, out))
    return stats.bh_adjust(tested, "feature_id", "p_value").select("feature_id", "log2_ratio", "z", "p_value", "adjusted")


def clusters_against_rest(m: DataFrame, labels: DataFrame, test=glm_test, **how) -> DataFrame:
    """``test`` of each cluster of (barcode_id, label) against all others, with ``label``.

    Each cluster is tested by itself, so any test of this module will do; of two
    clusters' Wald tests the second is the first with its signs turned, with one less
    its one-sided p-values."""
    names = sorted(r["label"] for r in labels.select("label").distinct().collect())  # clusters are few
    turn = test is glm_test and len(names) == 2
    out = None
    for name in names[:1] if turn else names:
        one = test(m, labels.select("barcode_id", (F.col("label") == F.lit(name)).alias("in_group"), *how.get("covariates", ())), **how).withColumn("label", F.lit(name))
        out = one if out is None else out.unionByName(one)
    if turn:
        turned = out.withColumns({"label": F.lit(names[1]), "log2_ratio": -F.col("log2_ratio"), "z": -F.col("z"), "p_value": 1 - F.col("p_value"), "adjusted": 1 - F.col("adjusted")})
        out = out.unionByName(turned)
    return out


def nb_log_pmf(k: np.ndarray, mu: float, phi: float) -> np.ndarray:
    """Log probabilities of counts with a mean and a dispersion (Poisson where that is 0)."""
    return stats.log_nb_pmf(k, mu, phi) if phi > 0 else k * math.log(mu) - mu - stats.lgamma(k + 1.0)


def exact_nb_test(a: int, b: int, size_a: float, size_b: float, mu: float, phi: float) -> float:
    """The chance, given a + b, of a split no likelier than the one seen, where the sums
    are negative binomial with means ``mu`` times the groups' sizes.

    Splits are looked at in slices, so memory doesn't grow with the sums."""

    def logs(k):
        return nb_log_pmf(k, size_a * mu, phi / size_a) + nb_log_pmf(a + b - k, size_b * mu, phi / size_b)

    here = float(logs(np.array([float(a)]))[0])
    total, tail, top = 0.0, 0.0, -np.inf
    for lo in range(0, a + b + 1, WALK):
        logp = logs(np.arange(lo, min(lo + WALK, a + b + 1), dtype=float))
        new = max(top, float(logp.max()))
        scale = math.exp(top - new) if top > -np.inf else 0.0
        p = np.exp(logp - new)
        total, tail, top = total * scale + p.sum(), tail * scale + p[logp <= here + 1e-9].sum(), new
    return float(min(1.0, tail / total))


def asymptotic_nb_test(a: int, b: int, size_a: float, size_b: float, mu: float, phi: float) -> float:
    """The same for large sums: the share of the first is nearly beta distributed."""
    alpha = size_a * mu / (1 + phi * mu)
    beta = size_b / size_a * alpha
    total = a + b
    median = alpha / (alpha + beta)
    x = (a + 0.5) / total if a / total < median else (a - 0.5) / total
    low = stats.incomplete_beta(alpha, beta, min(max(x, 0.0), 1.0))
    return float(min(1.0, 2 * min(low, 1 - low)))


#: Above this sum in both groups the large-sample form is used.
BIG = 900


def sum_test(m: DataFrame, groups: DataFrame, big: int = BIG) -> DataFrame:
    """(feature_id, sum_a, sum_b, log2_ratio, p_value, adjusted): exact tests of two groups' sums.

    Means and shrunk dispersions come from both groups, sizes from the barcodes' size
    factors; only features that were seen, and whose variance isn't zero, are tested."""
    m = m.join(groups, "barcode_id").select("feature_id", "barcode_id", "value", "in_group")
    kept = m.drop("in_group")
    phi = shrunk_dispersions(kept).select("feature_id", "mean", "phi")
    sizes = size_factors(kept).join(groups, "barcode_id").agg(F.sum(F.when(F.col("in_group"), F.col("factor"))).alias("size_a"), F.sum(F.when(~F.col("in_group"), F.col("factor"))).alias("size_b"))
    sums = m.groupBy("feature_id").agg(F.sum(F.when(F.col("in_group"), F.col("value")).otherwise(0)).alias("sum_a"), F.sum(F.when(~F.col("in_group"), F.col("value")).otherwise(0)).alias("sum_b"))
    rows = sums.join(phi, "feature_id").join(F.broadcast(sizes))

    @F.pandas_udf("double")
    def p(a: pd.Series, b: pd.Series, size_a: pd.Series, size_b: pd.Series, mean: pd.Series, phi: pd.Series) -> pd.Series:
        one = lambda x, y, *r: (asymptotic_nb_test if min(x, y) > big else exact_nb_test)(int(x), int(y), *r)
        return pd.Series([one(*r) for r in zip(a, b, size_a, size_b, mean, phi)], dtype="float64")

    ratio = F.log2((1 + F.col("sum_a")) / (1 + F.col("size_a"))) - F.log2((1 + F.col("sum_b")) / (1 + F.col("size_b")))
    found = settle(rows.select("feature_id", "sum_a", "sum_b", ratio.alias("log2_ratio"), p("sum_a", "sum_b", "size_a", "size_b", "mean", "phi").alias("p_value")))
    return stats.bh_adjust(found, "feature_id", "p_value").select("feature_id", "sum_a", "sum_b", "log2_ratio", "p_value", "adjusted")


def depth_mixture(histogram: dict[int, int], rounds: int = 500, eps: float = 1e-6) -> dict | None:
    """Three parts of a depth histogram: near-zero (geometric), background (negative binomial), signal (geometric).

    None where there are fewer than 30 depths or 100000 sites."""
    if len(histogram) < 30 or sum(histogram.values()) < 1e5:
        return None
    k = np.array(sorted(histogram), float)
    w = np.array([histogram[int(x)] for x in k], float)
    high = k > DEFAULT_DEPTH
    share = np.cumsum(k[high] * w[high]) / (k[high] * w[high]).sum()
    under = k[high][share <= 0.25]
    cut = under[-1] if len(under) else k[high][min(1, high.sum() - 1)]
    resp = np.stack([k <= DEFAULT_DEPTH, (k > DEFAULT_DEPTH) & (k <= cut), k > cut]).astype(float)
    last = None
    for _ in range(rounds):
        rw = resp * w
        n = np.maximum(rw.sum(1), 1e-12)
        mean = (rw * k).sum(1) / n
        var = (rw[1] * (k - mean[1]) ** 2).sum() / n[1]
        geo = 1 / np.maximum(mean[[0, 2]], 1 + 1e-9)
        disp = max(1e-6, (var - mean[1]) / mean[1] ** 2)
        part = n / n.sum()
        if geo[0] < geo[1]:
            geo, part = geo[::-1], part[[2, 1, 0]]
        now = np.array([*geo, mean[1], disp, *part])
        if last is not None and (np.abs(now - last) <= eps * np.abs(now)).all():
            break
        last = now
        logs = np.stack([np.log(geo[0]) + (k - 1) * np.log1p(-geo[0]), stats.log_nb_pmf(k, mean[1], disp), np.log(geo[1]) + (k - 1) * np.log1p(-geo[1])]) + np.log(np.maximum(part, 1e-300))[:, None]
        resp = np.exp(logs - logs.max(0))
        resp /= resp.sum(0)
    return {"zero": geo[0], "signal": geo[1], "mean": mean[1], "dispersion": disp, "share_zero": part[0], "share_background": part[1]}


def depth_threshold(fit: dict | None, odds: float = 0.2, most: int = 1000) -> int:
    """The largest depth, looking down from ``most``, at which signal does not reach the odds."""
    if fit is None:
        return DEFAULT_DEPTH
    k = np.arange(most, dtype=float)
    log = lambda x: math.log(max(x, 1e-300))
    signal = log(1 - fit["share_zero"] - fit["share_background"]) + log(fit["signal"]) + k * math.log1p(-fit["signal"])
    zero = log(fit["share_zero"]) + log(fit["zero"]) + k * math.log1p(-min(fit["zero"], 1 - 1e-12))
    back = log(fit["share_background"]) + stats.log_nb_pmf(k, fit["mean"], fit["dispersion"])
    low = np.flatnonzero(signal - np.logaddexp(zero, back) < math.log(odds))
    return int(low[-1]) if len(low) else 0


def call_peaks(fragments: DataFrame, odds: float = 0.2) -> DataFrame:
    """Peaks at the fitted threshold; only the depth histogram reaches the driver."""
    from . import fragments as fr

    steps = fr.windowed_depth(fragments)
    h = {r["depth"]: r["bases"] for r in fr.depth_histogram(steps).collect()}
    return fr.call_peaks(steps, depth_threshold(depth_mixture(h), odds))


def two_pool_fit(total: np.ndarray, unique: np.ndarray, rounds: int = 300) -> np.ndarray:
    """(size of pool 1, size of pool 2, share of pool 1) by damped least squares; NaN if the pools aren't told apart."""

    def model(p):
        a, b, f = p
        return a * (1 - np.exp(-total * f / a)) + b * (1 - np.exp(-total * (1 - f) / b))

    p, damp = np.array([unique.max() / 2, unique.max() / 2, 0.1]), 1e-2
    err = ((model(p) - unique) ** 2).sum()
    for _ in range(rounds):
        step = np.maximum(np.abs(p) * 1e-6, 1e-9)
        j = np.stack([(model(p + np.eye(3)[i] * step[i]) - model(p)) / step[i] for i in range(3)], 1)
        h = j.T @ j
        new = p + np.linalg.lstsq(h + damp * np.diag(np.diag(h) + 1e-12), j.T @ (unique - model(p)), rcond=None)[0]
        new = np.array([max(new[0], 1e-3), max(new[1], 1e-3), min(max(new[2], 0.0), 1.0)])
        e = ((model(new) - unique) ** 2).sum()
        if e < err:
            done = err - e <= 1e-12 * err
            p, err, damp = new, e, damp / 3
            if done:
                break
        else:
            damp *= 4
            if damp > 1e12:
                break
    return p if np.isfinite(err) else np.full(3, np.nan)


def background_profile(m: DataFrame, background: DataFrame, smooth: bool = True) -> DataFrame:
    """(feature_id, p) of a background's counts, over all features that ``m`` has.

    ``smooth``: by Good-Turing, from the histogram of sums (one row for each distinct sum
    reaches the driver); features that the background lacks share what is left for the
    unseen.  Where its frequencies fall too slowly for that, a warning is given and the
    plain shares are taken, as without ``smooth``."""
    sums = background.groupBy("feature_id").agg(F.sum("value").cast("long").alias("s")).where("s > 0")
    plain = lambda: sums.join(F.broadcast(sums.agg(F.sum("s").alias("t")))).select("feature_id", (F.col("s") / F.col("t")).alias("p"))
    if not smooth:
        return plain()
    sums = settle(sums)
    h = sums.groupBy("s").agg(F.count("*").alias("n")).orderBy("s").collect()
    try:
        share, unseen = stats.good_turing([r["s"] for r in h], [r["n"] for r in h])
    except ValueError as why:
        warnings.warn(str(why), stacklevel=2)
        return plain()
    other = settle(m.where("value > 0").select("feature_id").distinct().join(sums.select("feature_id"), "feature_id", "left_anti"))
    missing = other.count()
    scale = 1.0 if missing else 1 / (1 - unseen)
    named = m.sparkSession.createDataFrame([(r["s"], float(v * scale)) for r, v in zip(h, share)], "s long, p double")
    seen = sums.join(F.broadcast(named), "s").select("feature_id", "p")
    return seen.unionByName(other.withColumn("p", F.lit(unseen / missing))) if missing and unseen > 0 else seen


def ambient_p_values(m: DataFrame, background: DataFrame, draws: int = 1000, seed: int = 0, smooth: bool = True) -> DataFrame:
    """(barcode_id, total, p_value): how often a draw from the background profile is less likely than the barcode.

    A draw is a walk that adds one count at a time and is read at every distinct total,
    so all totals share ``draws`` walks, which are dealt over the tasks.  Barcodes meet
    the draws of their total in a join that adaptive execution can split."""
    p = settle(background_profile(m, background, smooth))

    @F.pandas_udf("double")
    def lgam(v: pd.Series) -> pd.Series:
        return v.map(lambda x: math.lgamma(x + 1))

    like = settle(m.join(p, "feature_id").groupBy("barcode_id").agg(F.sum("value").alias("total"), F.sum(F.col("value") * F.log("p") - lgam("value")).alias("ll")).withColumn("ll", F.col("ll") + lgam("total")))
    profile = np.array([r["p"] for r in p.orderBy("feature_id").select("p").collect()])  # one number per feature of the profile
    totals = np.array(sorted(r["total"] for r in like.select("total").distinct().collect()), np.int64)

    def run(pdfs):
        edges, lp = np.cumsum(profile), np.log(profile)
        edges /= edges[-1]
        for pdf in pdfs:
            for k in pdf["id"]:
                g, seen, at, done = np.random.default_rng([seed, int(k)]), np.zeros(len(profile), np.int64), 0.0, 0
                while done < (totals[-1] if len(totals) else 0):
                    n = int(min(WALK, totals[-1] - done))
                    x = np.searchsorted(edges, g.random(n), side="right")
                    order = np.argsort(x, kind="stable")
                    first = np.searchsorted(x[order], x[order])
                    times = np.empty(n, np.int64)
                    times[order] = np.arange(n) - first
                    times += seen[x] + 1
                    seen += np.bincount(x, minlength=len(seen))
                    # one more count of a feature that has c - 1: the chance grows by p / c, times the new total
                    path = at + np.cumsum(lp[x] - np.log(times) + np.log(np.arange(done + 1, done + n + 1)))
                    stops = totals[(totals > done) & (totals <= done + n)]
                    yield pd.DataFrame({"total": stops, "sim": path[stops - done - 1]})
                    at, done = path[-1], done + n

    spark = m.sparkSession
    walks = spark.range(0, draws, 1, min(draws, 4 * spark.sparkContext.defaultParallelism)).mapInPandas(run, "total long, sim double")
    sims = walks.groupBy("total").agg(F.collect_list("sim").alias("sims"))
    low = F.size(F.filter("sims", lambda x: x < F.col("ll") + 1e-9))
    return like.join(sims, "total").select("barcode_id", "total", ((1 + low) / F.lit(1.0 + draws)).alias("p_value"))
