"""Registered queries do the operators' whole job; operators against brute force on small fixtures."""

import math
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from braidwork.operators import graph, inference, reduce
from braidwork.plans import catalog
from braidwork.plans.fixtures import derived

SF = "/root/testdata/sf0.001"


def test_glm_takes_every_feature(spark):
    m = derived(spark, SF, "coo")
    got = {r["feature_id"]: (r["log2_ratio"], r["z"]) for r in catalog.queries()["glm_features"](spark, SF).collect()}
    entries = [tuple(r) for r in m.select("feature_id", "barcode_id", "value").collect()]
    assert set(got) == {f for f, _, _ in entries}
    depth = {}
    for _, b, v in entries:
        depth[b] = depth.get(b, 0) + v
    codes = sorted(depth)
    g = np.array([b % 2 == 0 for b in codes], float)
    x = np.stack([g, 1 - g, [math.log(depth[b]) for b in codes]], 1)
    for f in sorted(got)[50:60]:
        y = np.zeros(len(codes))
        for e in entries:
            if e[0] == f:
                y[codes.index(e[1])] = e[2]
        if min(y[g == 1].sum(), y[g == 0].sum()) == 0:
            continue  # no finite fit
        beta = np.array([math.log(y.mean())] * 2 + [0.0])
        for _ in range(300):
            mu = np.exp(x @ beta)
            k = mu / (1 + 1e-4 * mu)
            beta = beta + np.linalg.solve(x.T @ (k[:, None] * x) + 1e-10 * np.eye(3), x.T @ (k * (y - mu) / mu))
        assert got[f][0] == pytest.approx((beta[0] - beta[1]) / math.log(2), abs=1e-3)


@pytest.mark.parametrize("name, module, call", [("ambient_barcodes", inference, "ambient_p_values"), ("plsa_topics", reduce, "plsa")])
def test_whole_matrix_and_defaults(spark, monkeypatch, name, module, call):
    given = {}
    monkeypatch.setattr(module, call, lambda m, *a, **how: given.update(m=m, how=how))
    catalog.queries()[name](spark, SF)
    coo = derived(spark, SF, "coo")
    cols = ["feature_id", "barcode_id", "value"]
    assert given["how"] == {} and given["m"].select(cols).exceptAll(coo.select(cols)).count() == 0 and given["m"].count() == coo.count()


def test_ambient_against_all_outcomes(spark, monkeypatch):
    monkeypatch.setattr(inference, "WALK", 3)
    background = spark.createDataFrame([(0, 0, 5), (1, 0, 3), (2, 0, 2)], "feature_id long, barcode_id long, value long")
    cells = [(b, c) for b, c in enumerate(c for c in product(range(6), repeat=3) if 1 <= sum(c) <= 5)]
    m = spark.createDataFrame([(f, b, v) for b, c in cells for f, v in enumerate(c) if v], "feature_id long, barcode_id long, value long")
    got = {r["barcode_id"]: r["p_value"] for r in inference.ambient_p_values(m, background, draws=4000, smooth=False).collect()}
    chance = {c: math.factorial(sum(c)) * math.prod(p**v / math.factorial(v) for p, v in zip((0.5, 0.3, 0.2), c)) for _, c in cells}
    assert set(got) == {b for b, _ in cells}
    for b, c in cells:
        want = sum(q for o, q in chance.items() if sum(o) == sum(c) and q <= chance[c] * (1 + 1e-9))
        assert got[b] == pytest.approx(want, abs=5 * math.sqrt(want * (1 - want) / 4000) + 1e-3)


def test_smoothed_background(spark):
    """The unseen features share what Good-Turing leaves; the whole is one."""
    n = [1] * 120 + [2] * 40 + [3] * 24 + [4] * 13 + [5] * 15 + [6] * 5 + [7] * 11 + [20, 31, 50]
    background = spark.createDataFrame([(f, 0, v) for f, v in enumerate(n)], "feature_id long, barcode_id long, value long")
    m = background.unionByName(spark.createDataFrame([(1000 + k, 1, 2) for k in range(10)], background.schema))
    p = {r["feature_id"]: r["p"] for r in inference.background_profile(m, background).collect()}
    assert set(p) == set(range(len(n))) | set(range(1000, 1010)) and sum(p.values()) == pytest.approx(1)
    assert sum(p[1000 + k] for k in range(10)) == pytest.approx(120 / sum(n)) and p[0] < 1 / sum(n)
    alone = inference.background_profile(background, background).agg(F.sum("p")).first()[0]
    assert alone == pytest.approx(1)
    flat = spark.createDataFrame([(f, 0, 1 + f % 3) for f in range(90)], background.schema)
    with pytest.warns(UserWarning, match="too slowly"):
        got = inference.background_profile(flat, flat).agg(F.min("p"), F.max("p")).first()
    assert tuple(got) == pytest.approx((1 / 180, 3 / 180))
    assert inference.ambient_p_values(m, background, draws=20).count() == 2


@pytest.mark.parametrize("block", [2048, 90])
def test_nearest_among_equal_vectors(spark, block):
    r = np.random.default_rng(4)
    some = r.normal(size=8)
    vectors = [some.tolist() if i < 50 else r.normal(size=8).tolist() for i in range(400)]
    keys = r.permutation(400).tolist()
    df = spark.createDataFrame(list(zip(keys, vectors)), "key long, v array<double>")
    got = {}
    for e in graph.nearest(df, "key", "v", 3, block).collect():
        got.setdefault(e["src"], []).append((e["distance"], e["dst"]))
    x = np.array(vectors)
    for i, key in enumerate(keys):
        d = np.sqrt(((x[i] - x) ** 2).sum(1))
        want = sorted((d[j], keys[j]) for j in range(400) if j != i)[:3]
        assert [j for _, j in sorted(got[key])] == [j for _, j in want]


@pytest.fixture(scope="module")
def planted(spark):
    """Counts of 1200 features in 300 cells of two kinds, of which 60 differ twofold."""
    r = np.random.default_rng(12)
    base = 40 / np.arange(1, 1201) ** 0.7 + 0.8
    up, down = base.copy(), base.copy()
    chosen = r.choice(1200, 60, replace=False)
    up[chosen[:30]] *= 2.5
    down[chosen[30:]] *= 2.5
    depth = r.uniform(0.7, 1.4, 300)
    mean = np.where(np.arange(300)[:, None] % 2 == 0, up, down) * depth[:, None]
    y = r.negative_binomial(10, 10 / (10 + mean))  # dispersion 0.1
    b, f = np.nonzero(y)
    rows = list(zip(f.tolist(), b.tolist(), y[b, f].tolist()))
    m = spark.createDataFrame(rows, "feature_id long, barcode_id long, value long").repartition(4).cache()
    return m, m.select("barcode_id").distinct().withColumn("in_group", F.col("barcode_id") % 2 == 0), set(chosen[:30].tolist()), set(chosen[30:].tolist())


def gates(found, up, down, level, least=0.94):
    called = {(r["feature_id"], r["log2_ratio"] > 0) for r in found if r["adjusted"] < level}
    true = {(f, True) for f in up} | {(f, False) for f in down}
    assert len(called & true) >= least * len(true), "sensitivity"
    assert len(called & true) >= least * len(called), "positive predictive value"


def test_wald_test_finds_what_was_planted(planted):
    m, groups, up, down = planted
    # The p-values are one-sided, so half the level gives the same rate.
    gates(inference.glm_test(m, groups, alpha=0.1).collect(), up, down, 0.025)


def test_sum_test_finds_what_was_planted(planted):
    m, groups, up, down = planted
    gates(inference.sum_test(m, groups).collect(), up, down, 0.05)


def test_clusters_against_rest(spark):
    m = spark.createDataFrame([(f, b, 1 + (f == b % 3) * 6 + (f * b) % 2) for f in range(6) for b in range(45)], "feature_id long, barcode_id long, value long")
    labels = m.select("barcode_id").distinct().withColumn("label", (F.col("barcode_id") % 3).cast("int"))
    got = inference.clusters_against_rest(m, labels).collect()
    assert len(got) == 18
    for k in range(3):
        assert max((r for r in got if r["label"] == k), key=lambda r: r["z"])["feature_id"] == k
    sums = inference.clusters_against_rest(m, labels.withColumn("label", F.col("label") % 2), test=inference.sum_test).collect()
    assert len(sums) == 12
    p = {(r["feature_id"], r["label"]): r for r in sums}
    assert all(p[f, 1]["p_value"] == pytest.approx(p[f, 0]["p_value"]) and p[f, 1]["log2_ratio"] == pytest.approx(-p[f, 0]["log2_ratio"]) for f in range(6))
    two = inference.clusters_against_rest(m, labels.withColumn("label", F.col("label") % 2)).collect()
    by = {(r["feature_id"], r["label"]): r for r in two}
    assert all(by[f, 1]["p_value"] == pytest.approx(1 - by[f, 0]["p_value"]) and by[f, 1]["z"] == -by[f, 0]["z"] for f in range(6))


def test_regression_recovers_known_coefficients():
    r = np.random.default_rng(3)
    g = (np.arange(100_000) < 30_000).astype(float)
    mean = np.where(g > 0, 2.5, 0.9)
    y = r.negative_binomial(10, 10 / (10 + mean)).astype(float)
    beta, var = inference.count_regressions(y[None], np.stack([g, 1 - g], 1), np.ones(len(y)), np.array([0.1]))
    assert np.exp(beta[0]) == pytest.approx([2.5, 0.9], rel=0.02)
    # sums over equal barcodes tell as much
    sums = np.array([[y[g == 1].sum(), y[g == 0].sum()]])
    again, same = inference.count_regressions(sums, np.eye(2), np.array([30_000.0, 70_000.0]), np.array([0.1]))
    assert again == pytest.approx(beta, abs=1e-6) and same == pytest.approx(var, rel=1e-4)


def test_regression_of_a_group_without_counts():
    y = np.array([[0.0, 50.0], [0.0, 0.0], [3.0, 4.0]])
    beta, var = inference.count_regressions(y, np.eye(2), np.array([40.0, 40.0]), np.full(3, 0.1))
    assert np.isfinite(beta).all() and np.isfinite(var).all() and beta[0, 0] < -15
    assert np.exp(beta[2]) == pytest.approx([3 / 40, 0.1], rel=1e-6)


def test_covariates_take_up_what_they_explain(spark):
    """Groups that differ in a covariate alone show no difference once it is known."""
    r = np.random.default_rng(9)
    gc = np.concatenate([r.normal(0.4, 0.05, 150), r.normal(0.5, 0.05, 150)])
    slope = np.where((np.arange(80) >= 6) & (np.arange(80) < 18), np.where(np.arange(80) % 2, 8.0, -8.0), 0.0)
    true = np.where(np.arange(80) < 6, 1.2, 0.0)
    mean = 5 * np.exp(slope * (gc[:, None] - 0.45) + true * (np.arange(300)[:, None] >= 150))
    y = r.poisson(mean)
    b, f = np.nonzero(y)
    m = spark.createDataFrame(list(zip(f.tolist(), b.tolist(), y[b, f].tolist())), "feature_id long, barcode_id long, value long")
    groups = spark.createDataFrame([(k, k >= 150, float(gc[k])) for k in range(300)], "barcode_id long, in_group boolean, gc double")
    with_gc = {x["feature_id"]: x for x in inference.glm_test(m, groups, covariates=("gc",)).collect()}
    without = {x["feature_id"]: x for x in inference.glm_test(m, groups).collect()}
    steep = [k for k in range(6, 80) if slope[k]]
    assert sum(without[k]["adjusted"] < 0.025 for k in steep) > 0.8 * len(steep)
    assert all(with_gc[k]["adjusted"] < 0.025 and with_gc[k]["log2_ratio"] > 0.8 for k in range(6))
    assert np.mean([abs(with_gc[k]["log2_ratio"]) for k in steep]) < 0.4 * np.mean([abs(without[k]["log2_ratio"]) for k in steep])


def test_design_that_is_too_large_is_refused(planted, monkeypatch):
    monkeypatch.setattr(inference, "MOST_DESIGNS", 10)
    with pytest.raises(ValueError, match="over 10 different"):
        inference.glm_test(planted[0], planted[1])


def test_exact_and_large_sample_tests_agree(monkeypatch):
    for a, b in ((2000, 2200), (2000, 2000), (1500, 1000)):
        args = (a, b, 100.0, 100.0, (a + b) / 200, 0.05)
        assert inference.asymptotic_nb_test(*args) == pytest.approx(inference.exact_nb_test(*args), rel=0.1, abs=2e-3)
    whole = inference.exact_nb_test(3, 4000, 40.0, 90.0, 30.0, 0.2)
    monkeypatch.setattr(inference, "WALK", 100)  # in slices
    assert inference.exact_nb_test(3, 4000, 40.0, 90.0, 30.0, 0.2) == pytest.approx(whole)
    # without dispersion the split is binomial
    want = sum(math.comb(12, k) for k in range(13) if math.comb(12, k) <= math.comb(12, 2)) / 2**12
    assert inference.exact_nb_test(2, 10, 5.0, 5.0, 1.2, 0.0) == pytest.approx(want)


def test_fisher_against_all_tables(spark):
    for a, b, c, d in ((3, 7, 8, 2), (0, 5, 5, 0), (4, 4, 4, 4), (1, 9, 0, 10)):
        n, m = a + b, a + c
        chance = lambda x: math.comb(n, x) * math.comb(c + d, m - x) / math.comb(n + c + d, m)
        want = sum(chance(x) for x in range(max(0, m - c - d), min(n, m) + 1) if chance(x) <= chance(a) * (1 + 1e-9))
        assert inference.fisher_two_sided(a, b, c, d) == pytest.approx(want)


@pytest.mark.parametrize("t, df, want", [(0, 5, 0.5), (1, 1, 0.25), (2, 10, 0.036694), (-2, 10, 0.963306), (3.5, 200, 0.000286)])
def test_student_tail(t, df, want):
    from braidwork.functions import stats

    assert stats.student_sf(t, df) == pytest.approx(want, abs=2e-6)


def test_good_turing_refuses_flat_frequencies():
    from braidwork.functions import stats

    with pytest.raises(ValueError):
        stats.good_turing([1, 2, 3, 4], [10, 11, 12, 14])


def test_communities_of_cliques_in_a_ring(spark):
    """Thirty cliques of five, each tied to the next: the first level finds the cliques,
    later ones unite neighbours, and each level gains modularity."""
    edges = [(5 * c + i, 5 * c + j) for c in range(30) for i in range(5) for j in range(i)] + [(5 * c, (5 * c + 5) % 150) for c in range(30)]
    df = spark.createDataFrame(edges, "src long, dst long")
    both, levels = graph.symmetric(df), graph.hierarchy(df)
    gained = [graph.weighted_modularity(both, level) for level in levels]
    assert gained == sorted(gained) and gained[-1] > 0.85
    got = {r["node"]: r["community"] for r in levels[-1].collect()}
    assert len(got) == 150 and all(len({got[5 * c + i] for i in range(5)}) == 1 for c in range(30))
    assert graph.communities(df.limit(0)).count() == 0


def test_neighbour_count():
    assert [graph.neighbour_count(n, 10) for n in (1, 5, 100, 1000, 100_000)] == [0, 4, 10, 130, 370]


def test_ranks_over_many_ranges(spark):
    from braidwork.operators.ranks import folded, ordered, ranked

    r = np.random.default_rng(5)
    values = r.integers(0, 50, 3000).tolist()
    df = spark.createDataFrame(list(enumerate(values)), "k long, v long").repartition(7)
    got = {x["k"]: x["rank"] for x in ranked(df, F.col("v").desc(), F.col("k")).collect()}
    assert [k for k, _ in sorted(got.items(), key=lambda x: x[1])] == [k for k, _ in sorted(enumerate(values), key=lambda x: (-x[1], x[0]))]
    least = folded(ordered(df, "k"), F.col("v"), "m", "min").collect()
    assert {x["k"]: x["m"] for x in least} == {k: int(m) for k, m in enumerate(np.minimum.accumulate(values))}
    assert ranked(df.limit(0), "k").count() == 0


def test_inferred_doublets():
    from braidwork.operators import cells

    assert cells.inferred_doublets(0, 100, 0) == 0
    # with equal shares half of the doublets show
    assert abs(cells.inferred_doublets(40, 500, 500) - 80) <= 2


def random_matrix(spark, rows=60, cols=40):
    """A count matrix of ``rows`` barcodes with a few strong directions, as a table and as an array."""
    r = np.random.default_rng(11)
    dense = r.poisson(0.2 + 3 * (r.random((rows, 4)) < 0.3) @ (r.random((4, cols)) * (r.random((4, cols)) < 0.5)))
    dense[dense.sum(1) == 0, 0] = 1
    at = [(int(f), int(b), int(dense[b, f])) for b, f in zip(*np.nonzero(dense))]
    return spark.createDataFrame(at, "feature_id long, barcode_id long, value long"), dense


def same_up_to_sign(got, want, tolerance):
    got = got * np.where((got * want).sum(0) < 0, -1, 1)
    assert np.abs(got - want).max() <= tolerance * np.abs(want).max()


def scores_of(df, rows):
    by = {x["barcode_id"]: x["score"] for x in df.collect()}
    return np.array([by[b] for b in range(rows)])


@pytest.mark.parametrize("small", [0, 512])
def test_lsa_against_dense_decomposition(spark, monkeypatch, small):
    monkeypatch.setattr(reduce, "SMALL", small)
    m, dense = random_matrix(spark)
    x = dense * (np.log(len(dense) + 1) - np.log1p((dense > 0).sum(0)))
    u, d, _ = np.linalg.svd(x, full_matrices=False)
    same_up_to_sign(scores_of(reduce.lsa(m, 4, tolerance=1e-7), 60), (u * d)[:, :4], 1e-4)


@pytest.mark.parametrize("small", [0, 512])
def test_pca_against_dense_decomposition(spark, monkeypatch, small):
    monkeypatch.setattr(reduce, "SMALL", small)
    m, dense = random_matrix(spark)
    sums = dense.sum(1)
    x = np.log2(1 + dense * (np.median(sums) / sums)[:, None])
    x = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)
    u, d, _ = np.linalg.svd(x, full_matrices=False)
    same_up_to_sign(scores_of(reduce.pca(m, 4, tolerance=1e-7), 60), (u * d)[:, :4], 1e-4)


@pytest.mark.parametrize("small", [0, 512])
def test_reduction_of_low_rank_and_of_nothing(spark, monkeypatch, small):
    monkeypatch.setattr(reduce, "SMALL", small)
    # two kinds of barcodes: rank two, whatever is asked for
    rows = [(f, b, 1 + (f * (b % 2)) % 3) for b in range(12) for f in range(5) if (b + f) % 4]
    m = spark.createDataFrame([(f, b % 2 + 2 * k, v) for k in range(6) for f, b, v in rows if b < 2], "feature_id long, barcode_id long, value long")
    got = reduce.lsa(m, 4).collect()
    assert {len(x["score"]) for x in got} <= {1, 2} and len(got) == 12
    assert reduce.lsa(m.where("value < 0"), 4).count() == reduce.pca(m.where("value < 0"), 4).count() == reduce.plsa(m.where("value < 0"), 3).count() == 0


def test_reduction_fitted_on_a_part_takes_all_barcodes(spark):
    m, dense = random_matrix(spark)
    got = reduce.pca(m, 3, features=20, fit_on=m.where("barcode_id < 30").select("barcode_id"))
    assert got.count() == 60 and {len(x["score"]) for x in got.collect()} == {3}


def test_topics_against_dense_rounds(spark):
    m, dense = random_matrix(spark, 20, 12)
    got = {x["barcode_id"]: x["topics"] for x in reduce.plsa(m, 3, tolerance=0.1).collect()}
    start = spark.range(20).select("id", F.array(*[1.0 + F.pmod(F.xxhash64("id", F.lit(3 + j)), F.lit(1000)) / 1000.0 for j in range(3)]).alias("p")).collect()
    p = np.array([x["p"] for x in sorted(start)])
    have = dense.sum(0) > 0
    w, d, n = p[:12][have], p, dense[:, have]
    w, d = w / w.sum(0), d / d.sum(1, keepdims=True)
    for r in range(3000):
        z = n / np.maximum(d @ w.T, 1e-300)
        w, new = w * (z.T @ d), d * (z @ w)
        w, new = w / w.sum(0), new / new.sum(1, keepdims=True)
        change, d = np.abs(new - d).sum(1).max(), new
        if r >= 10 and change < 0.1:
            break
    assert np.abs(np.array([got[b] for b in range(20)]) - d).max() < 1e-6
