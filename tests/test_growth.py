"""Steps whose work must not grow faster than their input, and what they must still give."""

import random
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from braidwork.operators import fragments as fr
from braidwork.operators import barcodes, communities, contigs, graph, intervals, lanes, motifs, neighbours, topics


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_positions_around_sites_make_no_pairs(spark):
    """30,000 points on 20,000 equal sites would be 600 million pairs; both are counted first."""
    points = [("a", p) for p in (0, 3, 3, 16380, 16390, 16400, 32768, 40000)] + [(None, 5), ("b", 7)]
    sites = [("a", s, t) for s, t in ((0, "+"), (2, "-"), (16384, "-"), (16384, "+"), (16384, "+"), (32760, None), (60000, "+"))] + [("c", 7, "+")]
    p, s = spark.createDataFrame(points, "contig string, pos long"), spark.createDataFrame(sites, "contig string, start long, strand string")
    want = Counter()
    for contig, at in points:
        for other, start, strand in sites:
            if contig == other and contig and max(start - 20, 0) <= at <= start + 20:
                want[start - at if strand == "-" else at - start] += 1
    assert {r["offset"]: r["n"] for r in fr.relative_positions(p, s, 20).collect()} == dict(want)
    crowd = spark.range(30_000).select(F.lit("a").alias("contig"), F.lit(100).cast("long").alias("pos"))
    same = spark.range(20_000).select(F.lit("a").alias("contig"), F.lit(90).cast("long").alias("start"), F.lit("+").alias("strand"))
    got = fr.relative_positions(crowd, same, 20)
    assert "Join" not in plan(got)
    assert [tuple(r) for r in got.collect()] == [(10, 600_000_000)]


def shuffled(spark, run):
    """What ``run`` gives, and the rows that it shuffles."""

    def rows():
        store, gate = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
        stages = store.stageList(None, False, False, gate.new_array(gate.jvm.double, 0), None)
        return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))

    before = rows()
    return run(), rows() - before


def test_lane_copies_shuffle_no_copy_of_each_read(spark):
    """Reads of one crowded place were repeated for 24 cells; only the first of a cell looks around."""
    x = F.when(F.col("id") < 5990, 100_000).otherwise(100_000 + 60 * (F.col("id") - 5990)).cast("string")
    reads = spark.range(6000).select(F.lit("d").alias("pos"), F.concat(F.lit("M:r:FC:1:1"), F.lpad((1 + F.col("id") % 5).cast("string"), 2, "1"), F.lit(":"), x, F.lit(":900000")).alias("qname"), "id")
    # names of their own in every read, as they carry the place alone: a leading machine number
    reads = reads.select("pos", F.concat(F.lit("A"), F.col("id").cast("string"), F.substring("qname", 2, 99)).alias("qname"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large for it
    try:
        got, rows = shuffled(spark, lambda: [tuple(r) for r in lanes.lane_copies(reads, ["pos"], diffusion=100.0).collect()])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert got[0][1] == 6000 and got[0][2] >= 5985
    assert rows < 12 * 6000


def test_merge_of_equal_intervals(spark):
    """Equal intervals stay in one island, whichever of them is read first."""
    rows = spark.range(0, 60_000, numPartitions=8).select((F.col("id") % 3).cast("string").alias("contig"), (F.col("id") * 7919 % 997 * 10).alias("start"))
    rows = rows.withColumn("end", F.col("start") + 3 + F.xxhash64("start") % 3)
    for k, closed in ((0, False), (0, True), (1, False)):
        want = [tuple(r) for r in intervals.merge(rows.distinct(), k, closed).orderBy("contig", "start").collect()]
        assert [tuple(r) for r in intervals.merge(rows, k, closed).orderBy("contig", "start").collect()] == want
    # both orders of two equal rows
    order = []
    held = intervals.running

    def seen(df, key, pos, value, out, how="max", before=False, then=None, down=False, **more):
        order.append(then)
        return held(df, key, pos, value, out, how, before, then, down, **more)

    intervals.running = seen
    try:
        intervals.merge(rows)
    finally:
        intervals.running = held
    assert len(order[1]) == 2  # the end, and the fresh one of equal rows first


def test_barcodes_near_meet_half_way(spark):
    """Two changes of each of 300 sequences are 338,400 rows; both sides make one change instead."""
    r = random.Random(3)
    draw = lambda n, letters: ["".join(r.choice(letters) for _ in range(n)) for _ in range(300)]
    listed = sorted({*draw(16, "ACGT"), *("AAAAAAAA" + x for x in draw(8, "AC"))})
    seqs = sorted({*("AAAAAAAA" + x for x in draw(8, "ACN"))}) + [listed[0], listed[0][:5] + "x" + listed[0][6:], "N" + listed[1][1:], "A"]
    seqs = sorted(set(seqs))
    a, b = spark.createDataFrame([(s,) for s in seqs], "seq string"), spark.createDataFrame([(x,) for x in listed], "barcode string")
    got, rows = shuffled(spark, lambda: barcodes.near(a, b).select("seq", "cand", "k", barcodes.changed(F.col("seq"), F.col("code")).alias("made")).collect())
    far = lambda x, y: sum(p != q for p, q in zip(x, y)) if len(x) == len(y) else 99
    assert sorted((g["seq"], g["cand"], g["k"]) for g in got) == sorted((s, c, far(s, c)) for s in seqs for c in listed if 0 < far(s, c) <= 2)
    assert all(g["made"] == g["cand"] for g in got) and len(got) > 900
    assert rows < 100 * (len(seqs) + len(listed))


def test_neighbours_shuffle_as_the_vectors_do(spark):
    """Where no pair of 60 blocks can be left out, a block was sent to 60 others; it goes to 24 teams at most."""
    x = np.random.default_rng(4).normal(size=(1200, 64))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "key long, v array<double>")

    def written():
        store, gate = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
        stages = store.stageList(None, False, False, gate.new_array(gate.jvm.double, 0), None)
        return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))

    before = written()
    got = neighbours.nearest(df, "key", "v", 3, block=20).orderBy("src", "distance", "dst").collect()
    taken = written() - before
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    assert [(r["src"], r["dst"]) for r in got] == [(k, int(j)) for k in range(1200) for j in np.argsort(d[k])[:3]]
    assert taken < neighbours.TEAMS * 1200 * 64 * 8


def test_motifs_pass_once_over_many_peaks(spark, monkeypatch):
    """Each peak was scanned by itself; laid end to end, none fits across two of them."""
    r = random.Random(5)
    seqs = ["".join(r.choice("ACGTN") for _ in range(r.randrange(12))) for _ in range(300)] + [None, "", "ACG", "T"]
    scanner = motifs.Scanner({"m": np.array([[9, 0, 0], [0, 9, 0], [0, 0, 9], [0, 0, 0]]), "w": np.array([[5, 1], [1, 5], [1, 1], [1, 1]])}, 0.25, 0.25, 0.1, 1.0)
    want = sorted((k, n, int(p), t, float(v)) for k, q in enumerate(seqs) for n, t, at, sc in scanner.hits(motifs._CODE[np.frombuffer((q or "").encode(), np.uint8)]) for p, v in zip(at, sc))
    peaks, asked, held = pd.DataFrame({"id": range(len(seqs)), "seq": seqs}), [], scanner.hits
    monkeypatch.setattr(scanner, "hits", lambda q: asked.append(len(q)) or held(q))
    for together, passes in ((motifs.TOGETHER, 1), (40, 100)):
        asked.clear()
        monkeypatch.setattr(motifs, "TOGETHER", together)
        got = pd.concat(motifs.laid(peaks, scanner))
        assert sorted(got.itertuples(index=False, name=None)) == want and len(want) > 50
        assert len(asked) <= passes


def test_rows_on_primary_contigs_stay_where_they_are(spark):
    """Rows were shuffled by contig, so that one task had all rows of a contig."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "c1").when(F.col("id") % 3 == 1, "c2").alias("contig"), "id")
    genome = spark.createDataFrame([("c1", "a", True, False), ("c2", "a", False, False)], "contig string, species string, is_primary boolean, is_sex boolean")
    for run, want in ((lambda: contigs.on_primary(rows, genome).count(), 1000), (lambda: contigs.with_primary(rows, genome).where("is_primary").count(), 1000)):
        got, moved = shuffled(spark, run)
        assert got == want and moved < 100


def test_rounds_of_moves_in_blocks(spark, monkeypatch):
    """A round was a dozen joins and a table of its own; now eight rounds are one job, or 64 where one block holds the graph."""
    r = random.Random(6)
    pairs = [(a, (a + r.randrange(7)) % 90, r.randrange(1, 4)) for a in range(90) for _ in range(4)]
    both = graph.symmetric(spark.createDataFrame(pairs, "src long, dst long, w long"))
    links = [tuple(x) for x in both.collect()]
    degree = Counter()
    for a, _, w in links:
        degree[a] += w
    m2, at = sum(degree.values()), {a: a for a in degree}
    free = [{x["id"] for x in spark.range(90).where(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(2)) == 0).collect()} for k in range(10)]
    want = []
    for k in range(11):
        tot = Counter()
        for a, c in at.items():
            tot[c] += degree[a]
        want.append((dict(at), sum(w for a, b, w in links if at[a] == at[b]) / m2 - sum(t * t for t in tot.values()) / m2**2))
        if k < 10:
            near = {a: Counter({at[a]: 0}) for a in at}
            for a, b, w in links:
                if a != b:
                    near[a][at[b]] += w
            score = lambda a, c: round(near[a][c] - (tot[c] - degree[a] * (c == at[a])) * degree[a] / m2, 9)
            at = {a: max(near[a], key=lambda c: (score(a, c), c == at[a], -c)) if a in free[k] else at[a] for a in at}
    for edges, blocks in ((communities.EDGES, 1), (100, 6)):
        monkeypatch.setattr(communities, "EDGES", edges)
        rounds = communities.Rounds(both)
        assert min(rounds.blocks, 6) == blocks
        assert [rounds.modularity(k) for k in range(11)] == [q for _, q in want] and len(rounds.jobs) == (1 if blocks == 1 else 2)
        assert {x["node"]: x["community"] for x in rounds.labels(10).collect()} == want[10][0]
    ids = [0, 1, -5, 2**62, 12345]
    got = spark.createDataFrame([(k,) for k in ids], "id long").select("id", F.xxhash64("id").alias("h"), F.xxhash64("id", F.lit(7)).alias("r")).collect()
    assert [communities.hashed(np.array([x["id"]]))[0] for x in got] == [x["h"] for x in got] and [communities.hashed(np.array([x["id"]]), 7)[0] for x in got] == [x["r"] for x in got]


def test_topic_rounds_shuffle_sums_and_no_entries(spark, monkeypatch):
    """Every entry was joined and shuffled twice in each round; blocks of features keep theirs."""
    r = np.random.default_rng(8)
    dense = r.poisson(1.0, (150, 40)) * r.integers(1, 4, (150, 1))
    m = spark.createDataFrame([(f, b, int(dense[f, b])) for f in range(150) for b in range(40) if dense[f, b]], "feature_id long, barcode_id long, value long")
    start = spark.range(150).select(F.array(*[1.0 + F.pmod(F.xxhash64("id", F.lit(3 + j)), F.lit(1000)) / 1000.0 for j in range(3)]).alias("p"), "id").orderBy("id").collect()
    p = np.array([x["p"] for x in start])
    w, d = p / p.sum(0), p[:40] / p[:40].sum(1, keepdims=True)
    want, change = [], []
    for _ in range(16):
        z = dense / np.maximum(w @ d.T, 1e-300)
        w, new = w * (z @ d), d * (z.T @ w)
        w, new = w / w.sum(0), new / new.sum(1, keepdims=True)
        change.append(np.abs(new - d).sum(1).max())
        d = new
        want.append(d)
    for entries, barcodes, blocks, owners in ((topics.ENTRIES, 4096, 1, 1), (500, 15, 8, 3)):
        monkeypatch.setattr(topics, "ENTRIES", entries)
        monkeypatch.setattr(topics, "BARCODES", barcodes)
        rounds = topics.Rounds(m, 3, 3)
        assert (min(rounds.blocks, 8), rounds.owners) == (blocks, owners)
        got, moved = shuffled(spark, lambda: [rounds.changed(k) for k in range(1, 17)])
        assert np.allclose(got, change, atol=1e-9) and moved < 16 * m.count()
        have = {x["barcode_id"]: x["p"] for x in rounds.topics(13).collect()}
        have = np.array([have[b] for b in range(40)])
        assert len(have) == 40 and np.abs(have / have.sum(1, keepdims=True) - want[12]).max() < 1e-9


def test_joins_compare_few_pairs_beside_those_they_report(spark, monkeypatch):
    """In bins of 16384, all rows of a dense place were compared with all regions there; columns of a row were computed for each pair."""
    r = random.Random(9)
    spans = [("a", s, s + r.randrange(200, 900)) for s in (r.randrange(16000) for _ in range(1500))] + [("a", -70000, 90000), ("b", 5, 6)]
    rows = [("a", s, s + r.randrange(20, 400), k) for k, s in enumerate(r.randrange(16000) for _ in range(300))] + [("b", 5, 5, 300), ("c", 5, 9, 301)]
    regions, left = spark.createDataFrame(spans, "contig string, start long, end long"), spark.createDataFrame(rows, "contig string, start long, stop long, k long")
    points, sides, held = left.select("contig", F.col("start").alias("pos"), "k"), [], type(left).join
    monkeypatch.setattr(type(left), "join", lambda self, other, *how: sides.append((self, other)) or held(self, other, *how))
    for run, want in (
        (lambda: intervals.point_join(points, regions), sum(c == x and s <= p < e for c, p, _, _ in rows for x, s, e in spans)),
        (lambda: intervals.overlap_join(left, regions), sum(c == x and e >= p and s < q for c, p, q, _ in rows for x, s, e in spans)),
    ):
        sides.clear()
        got = run()
        asked, compared = list(sides), 0
        for a, b in asked:
            keys = [("_asked", "_level"), ("_cell", "_bin")] if "_asked" in a.columns else [("_bin", "r_bin")]
            other = "r_contig" if "r_contig" in b.columns else "contig"
            own = "contig" if other == "r_contig" else "r_contig"
            at, of = a.groupBy(own, *[k for k, _ in keys]).count().toPandas(), b.groupBy(other, *[k for _, k in keys]).count().toPandas()
            both = at.merge(of, left_on=[own, *[k for k, _ in keys]], right_on=[other, *[k for _, k in keys]])
            compared += int((both["count_x"] * both["count_y"]).sum())
        assert got.count() == want > 9000 and compared < 3 * want
        assert "Repartition" in plan(got)


def dense(r) -> tuple[list, list]:
    """Rows and regions of one place, copies, empty, inverted and null ones among them."""
    spans = [("a", s, s + r.randrange(200, 900)) for s in (r.randrange(3000) for _ in range(600))] + [("a", 1500, 1500)] * 3 + [("a", 900, 1200)] * 70
    spans += [("a", -5000, 9000), ("a", 20, 10), ("a", None, 5), ("a", 5, None), (None, 0, 3000), ("b", 5, 6)]
    rows = [("a", s, s + r.randrange(1, 300), k) for k, s in enumerate(r.randrange(-50, 3500) for _ in range(120))]
    return rows + [("a", 1000, 1100, 120)] * 2 + [("a", 1000, 1000, 121), ("a", 1000, 900, 122), ("a", None, 5, 123), ("a", 1000, None, 124), (None, 0, 9, 125), ("b", 5, 5, 126), ("c", 5, 9, 127)], spans


def look_ups(a, b) -> int:
    """How many rows of ``b`` the rows of ``a`` find in an inner join of dense regions."""
    at, of = a.groupBy("contig", "_asked", "_cell").count().toPandas().dropna(), b.groupBy("r_contig", "_level", "_bin").count().toPandas().dropna()
    both = at.merge(of, left_on=["contig", "_asked", "_cell"], right_on=["r_contig", "_level", "_bin"])
    return int((both["count_x"] * both["count_y"]).sum())


def test_a_point_finds_lists_of_regions(spark, monkeypatch):
    """A point looked each region of its bin up by itself, and each look-up cost more than the pair."""
    rows, spans = dense(random.Random(11))
    points = spark.createDataFrame(rows, "contig string, start long, stop long, k long").select("contig", F.col("start").alias("pos"), "k")
    regions, sides, held = spark.createDataFrame(spans, "contig string, start long, end long"), [], type(points).join
    want = Counter((c, p, k, s, e) for c, p, _, k in rows for x, s, e in spans if None not in (c, p, x, s, e) and c == x and s <= p < e)
    monkeypatch.setattr(type(points), "join", lambda self, other, *how: sides.append((self, other)) or held(self, other, *how))
    assert Counter(map(tuple, intervals.point_join(points, regions).collect())) == want
    ((a, b),) = sides
    assert look_ups(a, b) * 8 < want.total() and want.total() > 9000
    for listed, most in ((3, len(spans)), (3, len(spans) - 1)):  # sent to all, or shuffled
        monkeypatch.setattr(intervals, "LISTED", listed)
        monkeypatch.setattr(intervals, "BROADCAST", most)
        got = intervals.point_join(points, regions)
        assert ("strategy=broadcast" in plan(got)) == (most == len(spans)) and Counter(map(tuple, got.collect())) == want


def test_an_overlap_is_one_join_and_finds_lists_of_regions(spark, monkeypatch):
    """Rows were read and shuffled once for each of two joins, and looked each region up by itself."""
    rows, spans = dense(random.Random(12))
    left, regions = spark.createDataFrame(rows, "contig string, start long, stop long, k long"), spark.createDataFrame(spans, "contig string, start long, end long")
    sides, held = [], type(left).join
    monkeypatch.setattr(type(left), "join", lambda self, other, *how: sides.append((self, other)) or held(self, other, *how))
    for touching in (True, False):
        want = Counter((*row, s, e) for row in rows for x, s, e in spans if None not in (*row, x, s, e) and row[0] == x and (e >= row[1] if touching else e > row[1]) and s < row[2])
        for listed, most in ((64, len(spans)), (3, len(spans) - 1)):
            monkeypatch.setattr(intervals, "LISTED", listed, raising=False)
            monkeypatch.setattr(intervals, "BROADCAST", most, raising=False)
            sides.clear()
            got = intervals.overlap_join(left, regions, touching=touching)
            ((a, b),) = sides
            assert plan(got).count("Repartition") == 1 and ("strategy=broadcast" in plan(got)) == (most == len(spans))
            assert Counter(map(tuple, got.collect())) == want and want.total() > 9000
            assert listed == 3 or look_ups(a, b) * 8 < want.total()
