import gzip
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from braidwork.operators import metrics
from braidwork.plans import analysis
from braidwork.plans.fixtures import derived
from braidwork.sources import fastq

ROOT = Path(__file__).resolve().parent.parent


def test_parameters():
    p = analysis.parse_parameters("# c\nnum_comps, 7\n\nDIM_REDUCE,pca\ntsne_theta,0.25\n")
    assert (p.num_comps, p.dim_reduce, p.tsne_theta, p.max_clusters) == (7, "pca", 0.25, 10)
    for bad in ("a,1", "num_comps,1\nnum_comps,2", "num_comps,x", "num_comps"):
        with pytest.raises(ValueError):
            analysis.parse_parameters(bad)


@pytest.mark.parametrize("packed", [True, False])
def test_fastq_splits_anywhere(spark, tmp_path, packed):
    text = "".join(f"@r{k} x\n{'ACGT'[k % 4] * 5}\n+\n@III{'!' if k % 2 else 'I'}\n" for k in range(500))
    (tmp_path / ("r.fastq.gz" if packed else "r.fastq")).write_bytes(gzip.compress(text.encode()) if packed else text.encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = fastq.read_fastq(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r["name"], r["seq"], r["qual"]) for r in got) == sorted((f"r{k} x", "ACGT"[k % 4] * 5, "@III" + ("!" if k % 2 else "I")) for k in range(500))


def test_yield_and_demultiplex(spark):
    reads = spark.createDataFrame([(1, "ACGT", "II!"), (2, "ACGA", "III"), (3, "TTTT", "!!!"), (4, "ACCC", "I")], "id long, index string, qual string")
    y = fastq.quality_yield(reads.withColumn("s", F.lit(1)), ["s"]).first()
    assert (y["reads"], y["bases"], y["good"]) == (4, 10, 6)
    samples = spark.createDataFrame([("ACGT", "a"), ("ACCA", "b")], "index string, sample string")
    got = {r["id"]: r["sample"] for r in fastq.demultiplex(reads, samples).collect()}
    assert got == {1: "a", 2: None, 3: None, 4: "b"}  # 2 is one change from both


def test_registry(spark):
    v = metrics.long(spark.createDataFrame([(0.5, float("nan"), 3)], "a double, b double, c int"))
    r = spark.createDataFrame([("a", "gt", 0.2, 0.6), ("b", "exists", None, None), ("c", "lt", 2.0, 1.0)], "key string, rule string, acceptable double, targeted double")
    assert {x["key"]: x["status"] for x in metrics.judged(v, r).collect()} == {"a": "warn", "b": "error", "c": "error"}
    assert {x["key"]: x["value"] for x in metrics.last_wins([v, v.where("key = 'a'").withColumn("value", F.lit(9.0))]).collect()}["a"] == 9.0


def test_count_and_analyse(spark):
    f = derived(spark, "/root/testdata/sf0.001", "frag")
    got = analysis.count(f)
    assert got["peaks"].count() > 0
    total = got["counts"].agg(F.sum("n")).first()[0] or 0
    both = f.join(got["cells"], "barcode", "left_semi")
    inside = both.select("contig", F.explode(F.array("start", "stop")).alias("p")).join(got["peaks"].withColumnRenamed("contig", "c"), (F.col("contig") == F.col("c")) & (F.col("p") >= F.col("start")) & (F.col("p") < F.col("end"))).count()
    assert total == inside
    m = derived(spark, "/root/testdata/sf0.001", "coo")
    some = analysis.analyse(m, analysis.Parameters(dim_reduce="pca", num_comps=2, max_clusters=2, num_analysis_bcs=50, num_dr_bcs=30, num_dr_features=100, graphclust_neighbors=5))
    assert some["scores"].count() == some["graphclust"].count() == 50 and some["graphclust"].agg(F.min("label")).first()[0] == 1
    assert some["kmeans_2_clusters"].select("label").distinct().count() == 2


def test_libraries_come_to_equal_depth(spark):
    f = derived(spark, "/root/testdata/sf0.001", "frag").withColumn("library", (F.col("start") % 3 == 0).cast("int") + 1)
    cells = f.select("library", "barcode").distinct()
    rates = metrics.library_depth(f, cells, "unique")
    assert rates.agg(F.max("rate")).first()[0] == 1.0
    thin = metrics.combined(f, rates, "unique")
    by = {r["g"]: r["n"] for r in thin.groupBy(F.split_part("barcode", F.lit("-"), F.lit(2)).alias("g")).agg(F.count("*").alias("n")).collect()}
    assert set(by) == {"1", "2"} and 0.7 < by["1"] / by["2"] < 1.5
    assert metrics.combined(f, rates, None).count() == f.count()
    assert metrics.combined(f, rates, "total").agg(F.sum("dup")).first()[0] < f.agg(F.sum("dup")).first()[0]


def test_works_without_the_corpus_part(tmp_path):
    shutil.copytree(ROOT / "braidwork", tmp_path / "braidwork", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'peak_matrix' in q and 'peak_matrix' in o and not any(k.startswith('op') or k == 'pipeline' for k in q if k[2:3].isdigit() or k == 'pipeline')"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
