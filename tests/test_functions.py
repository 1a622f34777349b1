import math

import pytest
from pyspark.sql import functions as F

from braidwork.functions import sequence as seq
from braidwork.functions import stats
from braidwork.sources import readers


def one(spark, col, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(col.alias("x")).first()["x"]


def test_sequences(spark):
    assert one(spark, seq.reverse_complement(F.col("s")), s="ACGTNRy") == "rYNACGT"
    assert one(spark, seq.mask(F.col("s"), 2, 4), s="ACGTAC") == "NNGTNN"
    assert one(spark, seq.hamming(F.col("a"), F.col("b")), a="ACGT", b="AGG") == 2
    assert one(spark, seq.library_suffix(F.col("s")), s="ACGT-3") == 3
    assert one(spark, seq.library_suffix(F.col("s")), s="ACGT") is None
    assert one(spark, seq.two_bit(F.col("s")), s="ACGT") == 0b00011011
    assert len(set(one(spark, seq.neighbours(F.col("s")), s="ACG"))) == 9
    assert one(spark, seq.bases_at_least(F.col("q"), 30), q="I?!") == 2
    assert one(spark, seq.expected_errors(F.col("q")), q="+5") == pytest.approx(0.1 + 0.01)
    assert one(spark, seq.relative_position(F.lit(10), F.lit(21), F.lit("-"), F.lit(17))) == -2


@pytest.mark.parametrize("begin,end", [(0, 1), (0, 1 << 14), (100, 1 << 20), ((1 << 17) - 1, (1 << 17) + 1), (0, 1 << 29)])
def test_reg2bin(spark, begin, end):
    last, want = end - 1, 0
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if begin >> shift == last >> shift:
            want = first + (begin >> shift)
            break
    assert one(spark, seq.reg2bin(F.lit(begin), F.lit(end))) == want


@pytest.mark.parametrize("url,good", [("http://foo.com/blah_blah", True), ("https://www.example.com:8080/p?q=1", True), ("ftp://localhost/x", True), ("http://10.0.0.1", True), ("foo.com", False), ("http://", False), ("/a/b", False), ("http:// x.com", False)])
def test_urls(spark, url, good):
    assert one(spark, seq.is_url(F.col("u")), u=url) is good


def test_cigar(spark):
    df = spark.createDataFrame([([(4, 2), (0, 2), (1, 1), (2, 3), (0, 1)],)], "c array<struct<op:int,len:int>>")
    assert df.select(seq.cigar_offsets(F.col("c"))).first()[0] == [None, None, 0, 1, None, 5]


def test_good_turing_sums_to_one():
    r, n = [1, 2, 3, 4, 5, 7, 10, 12, 26], [32, 20, 10, 3, 1, 2, 1, 1, 2]
    share, unseen = stats.good_turing(r, n)
    assert math.isclose(sum(s * k for s, k in zip(share, n)) + unseen, 1.0)
    assert all(b > a for a, b in zip(share, share[1:]))


def test_mixture_recovers_plants():
    import numpy as np

    g = np.random.default_rng(0)
    v, w = np.unique(np.concatenate([g.poisson(5, 3000), g.poisson(60, 1000)]), return_counts=True)
    fit = stats.fit_two_nb(v.astype(float), w.astype(float), 30)
    assert fit["mu_noise"] == pytest.approx(5, rel=0.1) and fit["mu_signal"] == pytest.approx(60, rel=0.1)


def test_lgamma():
    import numpy as np

    x = [1e-3, 0.5, 1, 1.5, 2, 7.999, 8, 33.3, 1e4, 1e9]
    assert stats.lgamma(np.array(x)) == pytest.approx([math.lgamma(v) for v in x], rel=1e-13, abs=1e-13)
    assert stats.lgamma(np.empty(0)).shape == (0,)


def test_readers(spark, tmp_path):
    (tmp_path / "f.tsv").write_text("# x\nchr1\t5\t9\tAC-1\t2\nchr2\t7\t8\tGT-1\t1\n")
    assert [tuple(r) for r in readers.read_fragments(spark, str(tmp_path / "f.tsv"), "chr2").collect()] == [("chr2", 7, 8, "GT-1", 1)]
    (tmp_path / "b.bed").write_text("track x\n\nchr1\t5\t9\tn\t0\t?\nchr1\t0\t2\tm\t0\t-\n")
    assert sorted(map(tuple, readers.read_bed(spark, str(tmp_path / "b.bed"), 3).collect())) == [("chr1", 0, 5, "m", "-"), ("chr1", 2, 12, "n", None)]
    (tmp_path / "w.txt").write_text("AC\n#x\nAC\nGT\n")
    assert readers.read_whitelist(spark, str(tmp_path / "w.txt")).count() == 2
    (tmp_path / "c.csv").write_text("hg,AC-1,null,GT-1\nmm,\n")
    assert sorted(map(tuple, readers.read_cell_barcodes(spark, str(tmp_path / "c.csv")).collect())) == [("hg", "AC-1"), ("hg", "GT-1")]
    (tmp_path / "m.mtx").write_text("%%MatrixMarket\n%x\n3 2 2\n1 1 5\n3 2 7\n")
    assert sorted(map(tuple, readers.read_mex(spark, str(tmp_path / "m.mtx")).collect())) == [(0, 0, 5), (2, 1, 7)]
    (tmp_path / "g.gtf").write_text('#c\nchr1\tx\ttranscript\t11\t20\t.\t-\t.\tgene_id "a"; gene_name "b";\n')
    assert [tuple(r) for r in readers.transcription_starts(readers.read_gtf(spark, str(tmp_path / "g.gtf"))).collect()] == [("chr1", 19, 20, "b", "-")]
    (tmp_path / "a.csv").write_text("library_id,fragments,cells\na,f,c\na,f,c\n")
    with pytest.raises(ValueError, match="repeated"):
        readers.read_aggregation(spark, str(tmp_path / "a.csv"))


def test_streams_give_what_batches_give(spark, tmp_path):
    from braidwork.streaming import windows

    src = "/root/testdata/sf0.001/events.parquet"
    batch = spark.read.parquet(src)
    batch.repartition(1).write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    q = windows.tumbling(live).writeStream.outputMode("complete").format("memory").queryName("hours").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        q.processAllAvailable()
        assert sorted(map(tuple, spark.table("hours").collect())) == sorted(map(tuple, windows.tumbling(batch).collect()))
    finally:
        q.stop()
