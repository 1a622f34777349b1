"""Neighbours, batch correction, motifs, complexity and cell calls against brute force and planted truth."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from braidwork.functions import stats
from braidwork.operators import batches, cellcalling, complexity, graph, inference, motifs, neighbours
from braidwork.sources import readers

# --- neighbours


def table_of(spark, keys, x):
    return spark.createDataFrame([(int(k), v.tolist()) for k, v in zip(keys, x)], "key long, v array<double>").repartition(3)


def brute(q, qk, x, xk, k, own):
    d = np.sqrt(((q[:, None] - x[None]) ** 2).sum(2))
    return {int(a): [int(xk[j]) for j in np.lexsort((xk, row)) if not (own and xk[j] == a)][:k] for a, row in zip(qk, d)}


def gathered(edges):
    out = {}
    for e in edges.orderBy("src", "distance", "dst").collect():
        out.setdefault(e["src"], []).append(e["dst"])
    return out


@pytest.fixture(scope="module")
def clustered():
    r = np.random.default_rng(0)
    middle = r.normal(size=(30, 6)) * 6
    x = np.concatenate([middle[i % 30] + r.normal(size=(1, 6)) * 0.5 for i in range(1500)])
    x[100:160] = x[100]  # ties
    return r.permutation(1500), x


def test_nearest_by_brute_force_with_few_pairs(spark, clustered):
    keys, x = clustered
    df = table_of(spark, keys, x)
    assert gathered(neighbours.nearest(df, "key", "v", 5, block=50)) == brute(x, keys, x, keys, 5, True)
    layout = neighbours.Layout(neighbours._flagged(df, "key", "v", neighbours.ASKS | neighbours.GIVEN), 5, 50, False)
    n = layout.blocks.count()
    pairs = layout.pairs().count()
    assert n >= 30 and pairs < n * n / 3, (pairs, n)


def test_nearest_across_two_sets(spark, clustered):
    keys, x = clustered
    a, b = keys < 700, keys >= 600  # a hundred keys stand in both
    got = neighbours.nearest_across(table_of(spark, keys[a], x[a]), table_of(spark, keys[b], x[b]), "key", "v", 4, block=60)
    assert gathered(got) == brute(x[a], keys[a], x[b], keys[b], 4, False)


def test_nearest_with_few_or_none(spark):
    df = table_of(spark, [1, 2, 3], np.array([[0.0, 0], [1, 0], [5, 0]]))
    assert gathered(neighbours.nearest(df, "key", "v", 10)) == {1: [2, 3], 2: [1, 3], 3: [2, 1]}
    assert neighbours.nearest(df.limit(0), "key", "v", 2).count() == 0
    assert neighbours.nearest_across(df, df.limit(0), "key", "v", 2).count() == 0
    assert neighbours.nearest_across(df.limit(0), df, "key", "v", 2).count() == 0
    holes = df.withColumn("v", F.when(F.col("key") > 1, F.col("v")))
    assert gathered(neighbours.nearest(holes, "key", "v", 1)) == {2: [3], 3: [2]}


def test_partners_in_several_runs(spark, clustered, monkeypatch):
    monkeypatch.setattr(neighbours, "PARTNERS", 2)
    keys, x = clustered[0][:300], clustered[1][:300]
    assert gathered(neighbours.nearest(table_of(spark, keys, x), "key", "v", 7, block=20)) == brute(x, keys, x, keys, 7, True)


# --- batches


def test_planted_shift_is_removed(spark):
    r = np.random.default_rng(1)
    middle = r.normal(size=(5, 6)) * 4
    x = middle[np.arange(300) % 5] + r.normal(size=(300, 6)) * 0.4
    batch = np.arange(300) // 5 % 2
    x[batch == 1] += 0.9
    df = spark.createDataFrame([(k, v.tolist(), f"b{b}") for k, (v, b) in enumerate(zip(x, batch))], "key long, v array<double>, b string")
    moved = batches.correct_batches(df, "key", "v", "b", k=10, sigma=1.0, block=64).cache()

    def score(rows):
        edges = graph.nearest(rows, "key", "v", 15).select("src", "dst")
        return graph.batch_mixing(edges, rows.select(F.col("key").alias("node"), F.col("b").alias("batch"))).first()[0]

    assert moved.count() == 300 and abs(score(moved) - 1) < 0.25 < 0.6 < abs(score(df) - 1)
    got = {k: np.array(v) for k, v, _ in moved.collect()}
    assert all(np.array_equal(got[k], x[k]) for k in np.flatnonzero(batch == 0))
    # the same by whole matrices
    cur, ref = x[batch == 1], x[batch == 0]
    d = ((cur[:, None] - ref[None]) ** 2).sum(2)
    near, back = np.argsort(d, 1)[:, :10], np.argsort(d, 0)[:10].T
    pairs = [(i, j) for i in range(len(cur)) for j in near[i] if i in back[j]]
    i, j = (np.array(p) for p in zip(*pairs))
    w = np.exp(-0.5 * ((cur[:, None] - cur[i][None]) ** 2).sum(2))
    want = cur + w @ (ref[j] - cur[i]) / w.sum(1)[:, None]
    assert np.abs(np.stack([got[k] for k in np.flatnonzero(batch == 1)]) - want).max() < 1e-9


def test_far_points_still_have_a_mean():
    mean = batches.Mean(np.arange(2), np.array([[0.0], [500.0]]), 1.0)
    for y, s in ((1.0, 5.0), (3.0, 7.0)):
        mean.meet(np.array([[y]]), np.ones(1), np.array([[s]]))
    w = math.exp(-0.5 * 1), math.exp(-0.5 * 9)
    assert mean.sum[0, 0] / mean.weight[0] == pytest.approx((5 * w[0] + 7 * w[1]) / sum(w))
    assert mean.sum[1, 0] / mean.weight[1] == pytest.approx(7.0)


def test_without_pairs_nothing_moves(spark):
    df = table_of(spark, [1, 2], np.array([[0.0, 1.0], [2.0, 3.0]]))
    got = batches.correct(df, df.limit(0), "key", "v")
    assert sorted(map(tuple, got.collect())) == [(1, [0.0, 1.0]), (2, [2.0, 3.0])]
    assert batches.correct_batches(df.withColumn("b", F.lit(1)), "key", "v", "b").count() == 2


# --- motifs


def brute_hits(seqs, bins, backgrounds, p_value):
    out = set()
    for i, seq in seqs:
        at, cg = backgrounds[bins[i]]
        bg = np.array([at, cg, cg, at])
        for name, counts in MOTIFS.items():
            odds = [[round(1000 * math.log2((counts[b][j] + bg[b]) / (counts[:, j].sum() + 1) / bg[b])) for j in range(counts.shape[1])] for b in range(4)]
            w = counts.shape[1]
            # the exact chance of every score, by all words
            words = [("", 0, 1.0)]
            for j in range(w):
                words = [(s + "ACGT"[b], v + odds[b][j], c * bg[b]) for s, v, c in words for b in range(4)]
            score = {s: v for s, v, _ in words}
            cut = min((v for _, v, _ in words if sum(c for _, u, c in words if u >= v) <= p_value), default=math.inf)
            flip = str.maketrans("ACGT", "TGCA")
            for k in range(len(seq) - w + 1):
                word = seq[k : k + w].upper()
                if set(word) <= set("ACGT"):
                    for strand, s in (("+", word), ("-", word[::-1].translate(flip))):
                        if score[s] >= cut:
                            out.add((i, name, k, strand))
    return out


MOTIFS = {"a": np.array([[8, 0, 0, 1], [0, 9, 1, 7], [1, 0, 8, 1], [0, 0, 0, 0]]), "b": np.array([[0, 9, 0], [1, 0, 9], [9, 0, 0], [0, 1, 1]])}


def test_motif_scan_by_brute_force(spark):
    r = np.random.default_rng(3)
    seqs = [(k, "".join("N" if r.random() < 0.02 else r.choice(list("GCgc" if r.random() < 0.2 + k / 70 else "ATat")) for _ in range(60))) for k in range(40)] + [(90, ""), (91, "AC"), (92, None)]
    df = spark.createDataFrame(seqs, "id long, seq string")
    classes = motifs.binned(df, 6).cache()
    bins = {x["id"]: x["gc_bin"] for x in classes.collect()}
    assert len(set(bins.values())) >= 3
    back = {x["gc_bin"]: (x["at"], x["cg"]) for x in motifs.backgrounds(classes).collect()}
    for b, (at, cg) in back.items():
        text = "".join(s or "" for k, s in seqs if bins[k] == b).upper()
        n = sum(c in "ACGT" for c in text)
        assert at == pytest.approx((sum(c in "AT" for c in text) / 2 + 1) / (n + 4)) and cg == pytest.approx((sum(c in "CG" for c in text) / 2 + 1) / (n + 4))
    got = motifs.scan(classes, MOTIFS, 0.02).cache()
    found = {(x["id"], x["motif"], x["at"], x["strand"]) for x in got.collect()}
    want = brute_hits([(k, s or "") for k, s in seqs], bins, back, 0.02)
    assert len(want) > 50 and found == want
    places = df.selectExpr("id", "concat('chr', id % 2) as contig", "id * 100 as start")
    shapes = {f: motifs.formatted(motifs.with_width(got, MOTIFS), places, f) for f in ("bed", "motif", "position", "count", "binary")}
    assert shapes["bed"].count() == shapes["motif"].agg(F.sum("n")).first()[0] == shapes["count"].agg(F.sum("n")).first()[0] == len(found)
    assert shapes["position"].count() == shapes["binary"].count() == len({f[:2] for f in found})
    bed = shapes["bed"].first()
    assert bed["end"] - bed["start"] in (3, 4) and bed["start"] // 100 == bed["id"]
    m = {(x["motif_id"], x["feature_id"]): x["weight"] for x in motifs.hits_matrix(got, list(MOTIFS), binary=False).collect()}
    assert m == {(list(MOTIFS).index(n), i): sum(f[:2] == (i, n) for f in found) for i, n in {f[:2] for f in found}}
    with pytest.raises(ValueError, match="no such form"):
        motifs.formatted(got, places, "x")


# --- complexity


def test_curves_and_depths(spark):
    rows = [(b, 1 + (k * 7 + b) % 4) for b in range(3) for k in range(40 * (b + 1))]
    f = spark.createDataFrame(rows, "barcode long, dup int")
    got = {(x["barcode"], round(x["rate"], 6)): (x["total"], x["unique"]) for x in complexity.curves(f, ["barcode"], (0.25, 0.5)).collect()}
    for b in range(3):
        own = [d for c, d in rows if c == b]
        for rate in (0.25, 0.5, 1.0):
            assert got[b, rate] == pytest.approx((rate * sum(own), sum(1 - (1 - rate) ** d for d in own)))
    read = {(x["barcode"], x["depth"]): x["unique"] for x in complexity.matched(f, spark.createDataFrame([(0,), (2,)], "barcode long"), (10.0, 60.0, 200.0), rates=(0.25, 0.5)).collect()}
    assert set(read) == {(0, 10.0), (0, 60.0), (2, 10.0), (2, 60.0), (2, 200.0)}  # the small cell has no 200 reads
    for (b, depth), unique in read.items():
        t, u = zip(*[got[b, r] for r in (0.25, 0.5, 1.0)])
        k = 0 if depth < t[1] else 1
        assert unique == pytest.approx(u[k] + (depth - t[k]) / (t[k + 1] - t[k]) * (u[k + 1] - u[k]))


def test_planted_pools():
    total = np.linspace(1, 200_000, 100)
    unique = 60_000 * (1 - np.exp(-total * 0.7 / 60_000)) + 4_000 * (1 - np.exp(-total * 0.3 / 4_000))
    fit = complexity.pools(total, unique)
    sizes = sorted((fit["estimated_complexity1"], fit["estimated_complexity2"]))
    assert sizes == pytest.approx([4_000, 60_000], rel=0.02) and fit["estimated_complexity"] == pytest.approx(64_000, rel=0.02)
    # a straight line tells nothing about the size
    assert math.isnan(complexity.pools(total, total * 0.9)["fraction_pool1"])
    assert complexity.pools(np.empty(0), np.empty(0))["estimated_complexity"] == 0


def test_complexity_summary(spark):
    r = np.random.default_rng(5)
    rows = [(f"b{b}", int(d)) for b in range(6) for d in r.geometric(0.4, 3000 + 100 * b)]
    f = spark.createDataFrame(rows, "barcode string, dup int")
    cells = spark.createDataFrame([("x" if b < 3 else "y", f"b{b}") for b in range(6)], "species string, barcode string")
    got = complexity.summary(f, cells, 240_000, (10_000, 30_000, 90_000))
    mean = np.mean([sum(d for c, d in rows if c == f"b{b}") for b in range(3)])
    assert 10_000 < 2 * mean < 30_000
    assert {k for k in got if "RPC" in k} == {f"median_per_cell_unique_fragments_at_{n}_{w}_{s}" for n, w in ((10_000, "HQ_RPC"), (10_000, "RRPC"), (30_000, "RRPC")) for s in "xy"}
    assert complexity.summary(f, cells.limit(0), 10) == {}
    assert complexity.bulk(f.limit(0))["total"] is None and len(complexity.bulk(f)["total"]) == 101


# --- cell calls


@pytest.mark.parametrize("x", [1e-3, 0.3, 1.0, 2.5, 9.999, 10.0, 400.0])
def test_digamma(x):
    h = 1e-4 * x
    assert stats.digamma(np.array([x]))[0] == pytest.approx((math.lgamma(x + h) - math.lgamma(x - h)) / (2 * h), rel=1e-5, abs=1e-6)


@pytest.mark.parametrize("mean,alpha", [(4.0, 0.5), (300.0, 0.05), (20.0, 2.0)])
def test_dispersion_of_largest_likelihood(mean, alpha):
    r = np.random.default_rng(2)
    k, w = np.unique(r.negative_binomial(1 / alpha, 1 / (1 + alpha * mean), 20_000), return_counts=True)
    got = stats.nb_dispersion(k.astype(float), w.astype(float))
    assert got == pytest.approx(alpha, rel=0.05)
    like = lambda a: (w * stats.log_nb_pmf(k, (k * w).sum() / w.sum(), a)).sum()
    assert like(got) >= max(like(got * 1.02), like(got * 0.98))


def test_no_dispersion_and_cdf():
    assert stats.nb_dispersion(np.array([3.0]), np.array([10.0])) == 1e-6
    assert stats.nb_dispersion(np.array([0.0]), np.array([10.0])) == 1e-6
    p = np.exp(stats.log_nb_pmf(np.arange(30.0), 7.0, 0.3))
    assert [stats.nb_cdf(k, 7.0, 0.3) for k in (-1, 0, 5, 29)] == pytest.approx([0, p[0], p[:6].sum(), p.sum()])


def planted_counts(spark, species=("h",), seed=7):
    r, rows, true = np.random.default_rng(seed), [], {}
    for s in species:
        n = np.concatenate([r.negative_binomial(2, 2 / (2 + 8.0), 4000), r.negative_binomial(6, 6 / (6 + 900.0), 250)]) + 5
        rows += [(s, f"{s}{k}", int(v)) for k, v in enumerate(n)]
        true[s] = {f"{s}{k}" for k in range(4000, 4250)}
    return spark.createDataFrame(rows, "species string, barcode string, n long").cache(), true


def test_cells_are_found(spark):
    counts, true = planted_counts(spark)
    cells, summary = cellcalling.call(counts, 1000, 1000)
    got, s = {x["barcode"] for x in cells.collect()}, summary["h"]
    assert len(got ^ true["h"]) <= 3 and s["cells_detected"] == len(got)
    assert s["noise_mean"] == pytest.approx(8, rel=0.1) and s["signal_mean"] == pytest.approx(900, rel=0.1)
    assert s["noise_dispersion"] == pytest.approx(0.5, rel=0.15) and s["signal_dispersion"] == pytest.approx(1 / 6, rel=0.3)
    assert s["goodness_of_fit"] < 0.1 and abs(s["estimated_cells_present"] - 250) < 5


def test_cells_forced_excluded_and_capped(spark, monkeypatch):
    counts, true = planted_counts(spark)
    n = {x["barcode"]: x["n"] for x in counts.collect()}
    cells, summary = cellcalling.call(counts, 1000, 1000, force={"default": 40})
    least = sorted(n.values())[-40]
    assert {x["barcode"] for x in cells.collect()} == {b for b, v in n.items() if v >= least} and summary["h"]["cell_threshold"] == least
    some = sorted(true["h"])[:20]
    left = cellcalling.call(counts, 1000, 1000, excluded=spark.createDataFrame([("h", b) for b in some], "species string, barcode string"))[0]
    assert not {x["barcode"] for x in left.collect()} & set(some)
    monkeypatch.setattr(cellcalling, "MOST_CELLS", 100)
    assert 100 <= cellcalling.call(counts, 1000, 1000)[1]["h"]["cells_detected"] <= 105
    assert cellcalling.call(counts, 1000, 1000, force={"h": 5000})[1]["h"]["cells_detected"] <= 105
    with pytest.raises(ValueError, match="positive"):
        cellcalling.call(counts, 1000, 1000, force={"h": 0})


def test_cells_of_two_species_and_of_nothing(spark):
    counts, true = planted_counts(spark, ("h", "m"))
    cells, summary = cellcalling.call(counts, 1000, 1000, refit=True)
    for s in "hm":
        assert len({x["barcode"] for x in cells.where(F.col("species") == s).collect()} ^ true[s]) <= 8
    flat = spark.createDataFrame([("h", f"b{k}", 6 + k % 3) for k in range(50)], "species string, barcode string, n long")
    cells, summary = cellcalling.call(flat, 100, 1000)
    assert cells.count() == 0 and summary["h"]["cell_threshold"] is None and summary["h"]["cells_detected"] == 0
    assert cellcalling.call(flat.limit(0), 0)[1] == {}


def test_threshold_falls_back_on_the_signal(spark):
    """No count is likely enough to be signal: the signal's mean is the threshold, not infinity."""
    found = {"noise_mean": 50.0, "noise_dispersion": 0.5, "signal_mean": 60.0, "signal_dispersion": 0.5, "fraction_noise": 0.9}
    assert cellcalling.threshold(found) == 60


# --- files


def test_size_line_of_single_ids(spark, tmp_path):
    m = spark.createDataFrame([(0, 0, 5), (0, 1, 2)], "feature_id long, barcode_id long, value long")
    readers.write_mex(m, str(tmp_path / "m"))
    text = "\n".join(p.read_text() for p in sorted((tmp_path / "m/matrix").glob("part-*")))
    assert text.split("\n")[1] == "1 2 2"
    assert sorted(map(tuple, readers.read_mex(spark, str(tmp_path / "m/matrix")).collect())) == [(0, 0, 5), (0, 1, 2)]
    readers.write_mex(m.limit(0), str(tmp_path / "e"))
    assert readers.read_mex(spark, str(tmp_path / "e/matrix")).count() == 0


def test_shared_exons_and_escapes(spark, tmp_path):
    row = lambda kind, at, text: f"c\ts\t{kind}\t{at}\t{at + 5}\t.\t+\t.\t{text}"
    lines = [row("gene", 1, "ID=g1;Name=A%2CB"), row("mRNA", 1, "ID=t1;Parent=g1"), row("mRNA", 1, "ID=t%3B2;Parent=g1"), row("exon", 2, "Parent=t1,t%3B2"), row("gene", 50, "ID=g+2")]
    (tmp_path / "x.gff3").write_text("##gff-version 3\n" + "\n".join(lines) + "\n")
    got = sorted(x["value"].split("\t")[8] for x in readers.gff3_to_gtf(spark, str(tmp_path / "x.gff3")).collect() if "\texon\t" in x["value"])
    assert got == ['gene_id "g1"; transcript_id "t1"; gene_name "A,B";', 'gene_id "g1"; transcript_id "t;2"; gene_name "A,B";']
    genes = [x["value"].split("\t")[8] for x in readers.gff3_to_gtf(spark, str(tmp_path / "x.gff3")).collect() if "\tgene\t" in x["value"]]
    assert 'gene_id "g+2"; gene_name "g+2";' in genes


def test_variants_written_and_read_again(spark, tmp_path):
    text = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\nc2\t7\trs1\tA\tC,G\t30\tPASS\tDP=3;DB\nc1\t9\t.\tAT\tA\t.\t.\t.\nc1\t2\t.\tA\tT\t2.5\tq1;q2\tAF=0.5\n"
    (tmp_path / "v.vcf").write_text(text)
    rows = readers.read_vcf(spark, str(tmp_path / "v.vcf"))
    readers.write_vcf(rows, str(tmp_path / "out"), [("c2", 100), ("c1", 50)])
    got = "\n".join(p.read_text().strip() for p in sorted((tmp_path / "out").glob("part-*")) if p.read_text().strip()).split("\n")
    assert got[:3] == ["##fileformat=VCFv4.2", "##contig=<ID=c2,length=100>", "##contig=<ID=c1,length=50>"]
    body = text.strip().split("\n")[2:]
    assert got[4:] == [body[0], body[2], body[1]]
    assert sorted(map(str, readers.read_vcf(spark, str(tmp_path / "out")).collect())) == sorted(map(str, rows.collect()))


def test_small_tables_written(spark, tmp_path):
    readers.write_motifs(spark.createDataFrame([(1, "M2", "b"), (0, "M1", "a")], "feature_id long, id string, name string"), str(tmp_path / "m"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "m").glob("part-*"))) == "M1\ta\nM2\tb\n"
    readers.write_row({"x": 1, "y": float("nan"), "z": None, "w": "a,b"}, spark, str(tmp_path / "r"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "r").glob("part-*"))) == 'x,y,z,w\n1,,,"a,b"\n'
