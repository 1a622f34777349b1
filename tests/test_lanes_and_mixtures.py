"""Copies on lanes, periods, mixtures, resampling and spread samples."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from braidwork.operators import intervals, lanes, mixtures, periodicity

# --- lanes


@pytest.mark.parametrize("radius", [40.0, 300.0])
def test_near_earlier_by_all_pairs(spark, radius):
    r = np.random.default_rng(1)
    rows = [(int(g), int(x), int(y), f"n{k:04d}") for k, (g, x, y) in enumerate(zip(r.integers(0, 4, 700), r.integers(0, 2000, 700), r.integers(0, 2000, 700)))]
    rows += [(9, 50, 50, f"z{k:03d}") for k in range(80)]  # one crowded place
    got = {x["name"] for x in lanes.near_earlier(spark.createDataFrame(rows, "g int, x long, y long, name string"), ["g"], "x", "y", "name", radius).collect()}
    want = {b[3] for b in rows for a in rows if a[0] == b[0] and a[3] < b[3] and (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 < radius**2}
    assert got == want and len(got) > 79


def test_lane_copies_and_layouts(spark):
    name = lambda lane, swath, tile, x, y: f"M:r:FC:{lane}:1{swath}{tile}:{x}:{y}"
    rows = [("d", n) for n in (name(1, 1, 1, 10, 10), name(1, 1, 1, 15, 10), name(1, 2, 1, 10, 10), name(2, 1, 1, 12, 10), "odd")]
    rows += [("e", name(1, 1, 2, 900_000, 900_000)), ("e", name(1, 1, 2, 880_000, 900_000)), ("f", None)]
    df = spark.createDataFrame(rows, "pos string, qname string")
    size = {x["lane"]: (x["width"], x["height"], x["swaths"], x["tiles"]) for x in lanes.layouts(lanes.positions(df)).collect()}
    assert size == {"1": (900_000, 900_000, 2, 2), "2": (12, 10, 1, 1)}
    got = {x["pos"]: (x["copies"], x["optical"], x["diffusion"]) for x in lanes.lane_copies(df, ["pos"]).collect()}
    # 25,000 around a point covers under a fortieth of lane 1, where the two of "e" are 20,000 apart
    assert got == {"d": (5, 1, 1), "e": (2, 0, 1), "f": (1, 0, 0)}


# --- periods


@pytest.mark.parametrize("twist,nucleosome", [(10.4, 185.0), (11.5, 170.0)])
def test_planted_periods(twist, nucleosome):
    size = np.arange(1, 1001)
    counts = 5000 * np.exp(-size / 250) + 120 * np.exp(-size / 300) * np.cos(2 * np.pi * size / twist) + 900 * np.exp(-size / 400) * np.cos(2 * np.pi * (size - 180) / nucleosome)
    noisy = np.random.default_rng(0).poisson(np.maximum(counts, 0)).astype(float)
    assert periodicity.period(noisy, *periodicity.TWIST) == pytest.approx(twist, rel=0.02)
    assert periodicity.period(noisy, *periodicity.NUCLEOSOME) == pytest.approx(nucleosome, rel=0.02)


def test_no_period(spark):
    assert periodicity.period(np.zeros(1000), *periodicity.TWIST) is None
    none = spark.createDataFrame([], "start long, stop long")
    assert periodicity.periods(none).first() == (None, None)
    f = spark.createDataFrame([(0, 5), (3, 8), (0, 2000), (4, 4)], "start long, stop long")
    assert periodicity.size_histogram(f)[4] == 2 and periodicity.size_histogram(f).sum() == 2


def test_peaks_of_the_wavelet_search():
    x = np.arange(400)
    y = sum(h * np.exp(-((x - at) ** 2) / (2 * w * w)) for at, w, h in ((60, 4, 5), (180, 8, 3), (300, 5, 8))) + np.random.default_rng(3).normal(0, 0.05, 400)
    found = periodicity.peaks(y)
    assert all(np.abs(found - at).min() <= 3 for at in (60, 180, 300))
    assert len(periodicity.peaks(np.zeros(400))) == 0


# --- mixtures


def test_mixtures_of_groups(spark):
    r = np.random.default_rng(2)
    rows, true = [], {}
    for g in range(6):
        low, high = r.poisson(1.0, 400), r.poisson(30 * (g + 1), 25 * (g + 1))
        rows += [(f"g{g}", f"{g}-{k}", int(v)) for k, v in enumerate([*low, *high])]
        true[f"g{g}"] = {f"{g}-{k}" for k in range(400, 400 + len(high))}
    rows += [("one", f"o{k}", 3) for k in range(5)] + [("none", "n", 0)]
    df = spark.createDataFrame(rows, "guide string, cell string, n long").repartition(4)
    fit = {x["guide"]: x for x in mixtures.grouped_mixtures(df, "guide", "n").collect()}
    assert set(fit) == set(true) | {"one"} and fit["one"]["least"] is None
    found = mixtures.present(df, "guide", "n").cache()
    for g, cells in true.items():
        assert len({x["cell"] for x in found.where(F.col("guide") == g).collect()} ^ cells) <= 2
        # the share is of the cells that have the guide at all
        some = sum(v > 0 for q, _, v in rows if q == g)
        assert fit[g]["share_high"] == pytest.approx(len(cells) / some, rel=0.1)
    calls = {x["cell"]: (x["n"], x["guides"]) for x in mixtures.calls_by_cell(spark.createDataFrame([("c", "b"), ("c", "a"), ("d", "a")], "cell string, guide string"), "cell", "guide").collect()}
    assert calls == {"c": (2, "a|b"), "d": (1, "a")}


def test_many_starts_beat_a_poor_one():
    r = np.random.default_rng(4)
    x, w = np.unique(np.round(np.concatenate([r.normal(0, 1, 5000), r.normal(12, 1, 40)]), 2), return_counts=True)
    fit = mixtures.best_mixture(x, w.astype(float))
    assert fit[1] == pytest.approx(12, abs=0.6) and fit[3] == pytest.approx(40 / 5040, rel=0.1)


def test_efficiency_of_perturbations(spark):
    rows = [(f, b, 10 if f else (2 if b % 3 == 1 else 8)) for b in range(60) for f in range(3)]
    m = spark.createDataFrame(rows, "feature_id long, barcode_id long, value long")
    groups = spark.createDataFrame([(b, ("none", "hit", "other")[b % 3]) for b in range(60)], "barcode_id long, perturbation string")
    targets = spark.createDataFrame([("hit", 0), ("other", 0), ("absent", 0)], "perturbation string, feature_id long")
    got = {x["perturbation"]: x for x in mixtures.efficiency(m, groups, targets, "none").collect()}
    assert set(got) == {"hit", "other"} and got["other"]["log2_ratio"] == pytest.approx(0)
    assert got["hit"]["log2_ratio"] == pytest.approx(math.log2((1e4 * 2 / 22 + 1) / (1e4 * 8 / 28 + 1)))
    assert mixtures.efficiency(m, groups, targets, "none", least_cells=21).count() == 0


# --- resampling


def test_bootstrap_interval_against_numpy(spark):
    r = np.random.default_rng(5)
    a, b = r.poisson(400, 900), r.poisson(3, 900)
    a[500:] = r.poisson(3, 400)
    b[500:] = r.poisson(350, 400)
    both = r.choice(900, 60, replace=False)
    a[both], b[both] = 390, 360
    got = mixtures.bootstrap_multiplets(spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "c0 long, c1 long"), 600).first()

    def inferred(x, y):
        t0, t1 = np.percentile(x[x > y], 10), np.percentile(y[y > x], 10)
        two = (x >= t0) & (y >= t1)
        n1, n0, n = (~two & (y > x)).sum(), (~two & (y <= x)).sum(), two.sum()
        return n, min(n / (2 * n0 * n1 / (n0 + n1) ** 2), n + n0 + n1)

    assert (got["observed"], got["inferred"]) == pytest.approx(inferred(a, b))
    draws = [inferred(a[k], b[k])[1] for k in (r.choice(900, 900) for _ in range(600))]
    assert got["mean"] == pytest.approx(np.mean(draws), rel=0.05)
    assert (got["low"], got["high"]) == pytest.approx(tuple(np.percentile(draws, [2.5, 97.5])), rel=0.05)
    assert mixtures.bootstrap_multiplets(spark.createDataFrame([], "c0 long, c1 long"), 10).first()["inferred"] == 0


def test_bootstrap_refuses_too_many_pairs(spark, monkeypatch):
    monkeypatch.setattr(mixtures, "MOST_PAIRS", 3)
    with pytest.raises(ValueError, match="over 3 different"):
        mixtures.bootstrap_multiplets(spark.createDataFrame([(k, k) for k in range(9)], "c0 long, c1 long"))


# --- spread samples


def test_spread_sample_favours_sparse_places(spark):
    r = np.random.default_rng(6)
    x = np.concatenate([r.normal(1000, 60, 4000), r.uniform(1, 5000, 200)])
    y = np.concatenate([r.normal(1000, 60, 4000), r.uniform(1, 5000, 200)])
    df = spark.createDataFrame([(k, float(abs(p)), float(abs(q))) for k, (p, q) in enumerate(zip(x, y))], "id long, x double, y double").repartition(3)
    got = {p["id"] for p in mixtures.spread_sample(df, 300, "x", "y", "id").collect()}
    assert len(got) == 300
    # the weights by all pairs of grid cells
    z = [np.round((np.log2(np.abs(v) + 1) - np.log2(np.abs(v) + 1).mean()) / np.log2(np.abs(v) + 1).std() / 0.01) for v in (x, y)]
    cells = np.unique(np.stack(z, 1), axis=0)
    near = (((cells[:, None] - cells[None]) ** 2).sum(2) <= 100).sum(1)
    weight = 1 / near
    at = {tuple(c): w for c, w in zip(cells, weight)}
    drawn = np.array([at[z[0][k], z[1][k]] for k in got])
    r2 = np.random.default_rng(7)
    want = np.mean([weight[r2.choice(len(cells), 300, replace=False, p=weight / weight.sum())].mean() for _ in range(30)])
    assert drawn.mean() == pytest.approx(want, rel=0.1) and len({(z[0][k], z[1][k]) for k in got}) == 300
    whole = mixtures.spread_sample(df, 4100, "x", "y", "id")
    assert whole.count() == 4100 and len({(z[0][p["id"]], z[1][p["id"]]) for p in whole.collect()}) == len(cells)
    assert mixtures.spread_sample(df, 9999, "x", "y", "id").count() == 4200


def test_tiles(spark):
    got = intervals.tiled(spark.createDataFrame([("a", 25), ("b", 10), ("c", 0)], "contig string, length long"), 10, 3)
    assert sorted(map(tuple, got.collect())) == [("a", 0, 13), ("a", 10, 23), ("a", 20, 25), ("b", 0, 10)]
