"""Every stage of the pipeline on small tables, against plain Python where it can be told."""

import random

import pytest
from test_operators import SECRET, brute_hits, brute_similar, prose

import corpus_pipeline
from braidwork.llm import quality_cnn


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r, top = random.Random(21), str(tmp_path_factory.mktemp("sf"))
    rows = [(k, prose(r, 80), "en", f"s{k % 4}", 0) for k in range(80)]
    rows += [(k, " | ".join(prose(r, 60).split()), "en", "s1", 0) for k in range(80, 120)]
    rows += [(120, rows[0][1], "en", "s0", 0), (121, rows[1][1] + " token=abcdefgh12", "en", "s0", 0), (122, "user=bob " + SECRET[:40] + " " + prose(r, 50), "en", "s0", 0), (123, None, None, None, None)]
    rows = [(*x[:4], len(x[1] or "")) for x in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame([(k, int(k < 80), 0) for k in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    spark.createDataFrame([(1, " ".join(rows[7][1].split()[10:30]))], "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    return top


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    steps = dict(corpus_pipeline.STAGES)
    good = steps["quality classifier"](spark, docs, folder).cache()
    ids = {x["doc_id"] for x in good.collect()}
    assert good.columns == docs.columns
    assert len(ids & set(range(80))) >= 76 and len(ids & set(range(80, 120))) <= 2

    rest = steps["SimHash near-dedup"](spark, good, folder).cache()
    rows = good.collect()
    label = brute_similar([x["text"] for x in rows], 0.8)
    want = {min(x["doc_id"] for x, k in zip(rows, label) if k == j) for j in set(label)}
    assert {x["doc_id"] for x in rest.collect()} == want and rest.columns == docs.columns

    bench = [tuple(x) for x in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = steps["benchmark decontamination"](spark, rest, folder).cache()
    assert {x["doc_id"] for x in clean.collect()} == {x["doc_id"] for x in rest.collect() if not brute_hits(x["text"], bench)[1]}
    assert 7 not in {x["doc_id"] for x in clean.collect()}

    safe = steps["secret scans"](spark, clean, folder).cache()
    assert safe.columns == docs.columns and safe.count() == clean.count()
    texts = {x["doc_id"]: x for x in safe.collect()}
    before = {x["doc_id"]: x for x in clean.collect()}
    for k, x in texts.items():
        assert "abcdefgh12" not in (x["text"] or "") and SECRET[:40] not in (x["text"] or "")
        assert x["text"] == before[k]["text"] or x["n_chars"] == len(x["text"])

    pieces = steps["packing"](spark, safe, folder)
    assert {x["doc_id"] for x in pieces.collect()} == set(texts)


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 60
    assert quality_cnn.CUT == 0.3
