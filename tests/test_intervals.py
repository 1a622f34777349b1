"""Interval operators against plain Python, edges and partition counts included."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from braidwork.operators import fragments, intervals, matrix, models
from braidwork.operators.scan import following, running

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
piece = st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 60), st.integers(1, 30)).map(lambda t: (t[0], t[1], t[1] + t[2]))
pieces = st.lists(piece, min_size=1, max_size=15)


def table(spark, rows, end="end"):
    return spark.createDataFrame(rows, f"contig string, start long, {end} long")


def bases(rows):
    return {(c, p) for c, s, e in rows for p in range(s, e)}


@QUICK
@given(pieces, pieces)
def test_overlap_joins(spark, left, right):
    a, b = table(spark, left, "stop"), table(spark, right)
    for touching in (True, False):
        hit = lambda x: any(r[0] == x[0] and (r[2] >= x[1] if touching else r[2] > x[1]) and r[1] < x[2] for r in right)
        semi = sorted(map(tuple, intervals.overlap_join(a, b, "left_semi", touching, bin_width=16).collect()))
        anti = sorted(map(tuple, intervals.overlap_join(a, b, "left_anti", touching, bin_width=16).collect()))
        assert semi == sorted(x for x in left if hit(x))
        assert anti == sorted(x for x in left if not hit(x))


@QUICK
@given(pieces, pieces)
def test_set_operations(spark, left, right):
    a, b = table(spark, left), table(spark, right)
    got = lambda df: [tuple(r[c] for c in ("contig", "start", "end")) for r in df.collect()]
    both, less, one = got(intervals.intersect(a, b)), got(intervals.subtract(a, b)), got(intervals.merge(a))
    assert bases(both) == bases(left) & bases(right)
    assert bases(less) == bases(left) - bases(right)
    assert bases(one) == bases(left)
    for rows in (both, less, one):  # disjoint and apart
        assert sum(e - s for _, s, e in rows) == len(bases(rows))
        rows.sort()
        assert all(x[0] != y[0] or x[2] < y[1] for x, y in zip(rows, rows[1:]))


@QUICK
@given(pieces)
def test_depth(spark, rows):
    got = intervals.depth(table(spark, rows)).collect()
    at = {(r["contig"], p): r["depth"] for r in got for p in range(r["pos"], r["next_pos"]) if r["depth"]}
    want = {}
    for c, s, e in rows:
        for p in range(s, e):
            want[c, p] = want.get((c, p), 0) + 1
    assert at == want


@pytest.mark.parametrize("how", ["sum", "max", "min"])
@pytest.mark.parametrize("before", [True, False])
@pytest.mark.parametrize("down", [True, False])
def test_running_crosses_bins(spark, how, before, down):
    r = random.Random(3)
    rows = [("k", p, r.randint(-9, 9)) for p in r.sample(range(100), 40)]
    got = running(spark.createDataFrame(rows, "k string, pos long, v long").repartition(5), ["k"], "pos", F.col("v"), "out", how, before, down=down, width=10)
    fold = {"sum": sum, "max": max, "min": min}[how]
    for x in got.collect():
        seen = [v for _, p, v in rows if (p > x["pos"] if down else p < x["pos"])] + ([] if before else [x["v"]])
        assert x["out"] == (fold(seen) if seen else (0 if how == "sum" else None))


def test_following(spark):
    df = spark.createDataFrame([("k", 1), ("k", 30), ("k", 200)], "k string, pos long")
    assert {r["pos"]: r["n"] for r in following(df, ["k"], "pos", "n", width=10).collect()} == {1: 30, 30: 200, 200: None}


@QUICK
@given(pieces, st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 90)), min_size=1, max_size=12))
def test_points(spark, regions, points):
    p = spark.createDataFrame(points, "contig string, pos long")
    got = intervals.point_join(p, table(spark, regions), bin_width=16)
    assert got.count() == sum(r[0] == c and r[1] <= x < r[2] for c, x in points for r in regions)
    near = {(r["contig"], r["pos"]): r["distance"] for r in intervals.nearest_distance(p, table(spark, regions)).collect()}
    for c, x in points:
        assert near[c, x] == min((abs(r[1] - x) for r in regions if r[0] == c), default=None)


def test_peaks_bridge_gaps(spark):
    f = spark.createDataFrame([("a", 1000, 1100, "x", 1), ("a", 1050, 2000, "y", 1)], "contig string, start long, stop long, barcode string, dup long")
    peaks = fragments.call_peaks(fragments.windowed_depth(f), 2)
    assert [tuple(r) for r in peaks.select("start", "end").collect()] == [(850, 1251)]  # where two of the sites at 1000, 1050 and 1100 reach
    assert fragments.peak_matrix(f, peaks).agg(F.sum("n")).first()[0] == 3


def test_empty_tables(spark):
    none = table(spark, [])
    for df in (intervals.merge(none), intervals.depth(none), intervals.intersect(none, none), intervals.subtract(none, none)):
        assert df.count() == 0
    assert models.cell_calls(spark.createDataFrame([], "barcode string, n long")).count() == 0


def test_dispersion_and_planted_difference(spark):
    r = random.Random(5)
    rows = [(f, b, 1 + (r.randint(8, 12) if f < 5 and b % 2 == 0 else r.randint(0, 3))) for f in range(40) for b in range(60)]
    m = spark.createDataFrame(rows, "feature_id long, barcode_id long, value long")
    groups = m.select("barcode_id").distinct().withColumn("in_group", F.col("barcode_id") % 2 == 0)
    top = [x["feature_id"] for x in models.differential(m, groups).orderBy(F.desc("z")).limit(5).collect()]
    assert sorted(top) == [0, 1, 2, 3, 4]
    z = matrix.normalised_dispersion(matrix.moments(m, "feature_id", 60), bins=4)
    assert z.count() == 40


odd = st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-90, 90)), st.one_of(st.none(), st.integers(-90, 90)))


@QUICK
@given(st.lists(odd, min_size=1, max_size=25), st.lists(odd, min_size=1, max_size=25))
def test_fitted_bins_of_odd_intervals(spark, left, right):
    """Empty, inverted, negative, repeated and null intervals; bins that fit the sizes or are given."""
    a, b = table(spark, left, "stop"), table(spark, right)
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    full = lambda x: None not in x
    for wide in (None, 16):
        for touching in (True, False):
            want = [(*x, *r[1:]) for x in left for r in right if full(x) and full(r) and x[0] == r[0] and (r[2] >= x[1] if touching else r[2] > x[1]) and r[1] < x[2]]
            got = intervals.overlap_join(a, b, touching=touching, bin_width=wide)
            assert got.columns == ["contig", "start", "stop", "r_start", "r_end"] and order(got.collect()) == order(want)
        want = [(x[0], x[1], *r[1:]) for x in left for r in right if full(x[:2]) and full(r) and x[0] == r[0] and r[1] <= x[1] < r[2]]
        assert order(intervals.point_join(a.select("contig", F.col("start").alias("pos")), b, bin_width=wide).collect()) == order(want)
