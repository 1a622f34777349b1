"""Files as users have them: repeated attributes, round trips, conversions."""

import gzip

import pytest

from braidwork.sources import readers

GTF = """#!genome-build x
chr1\ta\tgene\t11\t20\t.\t-\t.\tgene_id "g1"; gene_name "b"; tag "basic"; tag "CCDS";
chr1\ta\ttranscript\t11\t20\t.\t-\t.\tgene_id "g1"; transcript_id "t1"; gene_name "b"; level 2;
"""
GFF = """##gff-version 3
chr1\ta\tgene\t11\t20\t.\t-\t.\tID=g1;Name=b;tag=x
chr1\ta\tmRNA\t11\t20\t.\t-\t.\tID=t1;Parent=g1
chr1\ta\texon\t11\t15\t.\t-\t.\tID=e1;Parent=t1
"""
VCF = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO
chr1\t11\trs1\tA\tC,G\t50.5\tPASS\tDP=3;DB
chr1\t21\t.\tAT\tA\t.\t.\t.
chr2\t11\t.\tA\tC\t10\tq10;s50\tDP=4
"""


def write(path, text):
    path.write_text(text)
    return str(path)


def test_gtf_with_repeated_keys(spark, tmp_path):
    rows = readers.read_gtf(spark, write(tmp_path / "a.gtf", GTF)).collect()
    assert rows[0]["all_attributes"]["tag"] == ["basic", "CCDS"] and rows[0]["attributes"]["tag"] == "basic"
    assert rows[1]["attributes"]["level"] == "2" and (rows[1]["start"], rows[1]["end"]) == (10, 20)


def test_format_is_told(spark, tmp_path):
    assert readers.gene_format(spark, write(tmp_path / "a.gtf", GTF)) == "gtf"
    assert readers.gene_format(spark, write(tmp_path / "a.gff3", GFF)) == "gff3"
    with pytest.raises(ValueError):
        readers.gene_format(spark, write(tmp_path / "both.txt", GTF + GFF))


def test_gff3_to_gtf(spark, tmp_path):
    rows = [r["value"].split("\t") for r in readers.gff3_to_gtf(spark, write(tmp_path / "a.gff3", GFF)).collect()]
    got = {r[2]: r[8] for r in rows}
    assert got == {"gene": 'gene_id "g1"; gene_name "b";', "mRNA": 'gene_id "g1"; transcript_id "t1"; gene_name "b";', "exon": 'gene_id "g1"; transcript_id "t1"; gene_name "b";'}


@pytest.mark.parametrize("parts", [1, 3])
def test_mex_round_trip(spark, tmp_path, parts):
    entries = [(0, 0, 5), (2, 1, 7), (3, 0, 1)]
    m = spark.createDataFrame(entries, "feature_id long, barcode_id long, value long").repartition(parts)
    features = spark.createDataFrame([(k, f"chr1:{k}-{k + 9}") for k in range(5)], "feature_id long, id string")
    barcodes = spark.createDataFrame([(0, "AA-1"), (1, "CC-1")], "barcode_id long, barcode string")
    readers.write_mex(m, str(tmp_path / "m"), features, barcodes)
    assert sorted(map(tuple, readers.read_mex(spark, str(tmp_path / "m/matrix")).collect())) == entries
    text = "".join(p.read_text() for p in sorted((tmp_path / "m/matrix").glob("part-*")))
    assert text.split("\n")[:2] == [readers.MEX_HEAD, "5 2 3"] and len(text.split()) == 5 + 3 + 9
    # The same as one compressed file.
    with gzip.open(tmp_path / "one.mtx.gz", "wt") as f:
        f.write(text)
    assert sorted(map(tuple, readers.read_mex(spark, str(tmp_path / "one.mtx.gz")).collect())) == entries
    assert [r["value"] for r in spark.read.text(str(tmp_path / "m/barcodes")).collect()] == ["AA-1", "CC-1"]
    readers.write_mex(m.limit(0), str(tmp_path / "empty"))
    assert readers.read_mex(spark, str(tmp_path / "empty/matrix")).count() == 0


def test_dense_and_peaks(spark, tmp_path):
    m = spark.createDataFrame([(0, 0, 5), (2, 1, 7)], "feature_id long, barcode_id long, value long")
    readers.write_dense(m, str(tmp_path / "d"), [0, 1])
    assert [tuple(r) for r in readers.read_csvs(spark, [str(tmp_path / "d")]).collect()] == [("0", "5", "0"), ("2", "0", "7")]
    features = spark.createDataFrame([(1, "chrUn:x:5-9"), (0, "chr1:0-10")], "feature_id long, id string")
    readers.write_peaks(features, str(tmp_path / "p"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "p")).collect()] == ["chr1\t0\t10", "chrUn:x\t5\t9"]


def test_insert_sizes(spark, tmp_path):
    path = write(tmp_path / "i.csv", "Barcode,1,2,3,>3\na,1,0,2,5\nb,0,4,0,1\n")
    some = spark.createDataFrame([("a",)], "barcode string")
    assert [tuple(r) for r in readers.read_insert_sizes(spark, path, range(2, 4), some).collect()] == [("a", "2", 0), ("a", "3", 2)]
    assert readers.read_insert_sizes(spark, path).count() == 8


def test_variants(spark, tmp_path):
    rows = readers.read_vcf(spark, write(tmp_path / "a.vcf", VCF))
    first, second, third = rows.collect()
    assert (first["pos"], first["alts"], first["qual"], first["filters"]) == (10, ["C", "G"], 50.5, ["PASS"]) and [tuple(x) for x in first["info"]] == [("DP", "3"), ("DB", "true")]
    assert second["id"] is None and second["info"] is None and third["filters"] == ["q10", "s50"]
    assert readers.read_vcf(spark, str(tmp_path / "a.vcf"), "chr1", 15, 30).count() == 1
    other = rows.where("pos = 10")
    assert readers.shared_variants(rows, other).count() == 2 and readers.other_variants(rows, other).count() == 1
    regions = spark.createDataFrame([("chr1", 21, 30)], "contig string, start long, end long")
    assert [r["pos"] for r in readers.variants_in(rows, regions).collect()] == [20]


def test_reference_definitions(spark):
    from braidwork.sources import checks

    lengths = spark.createDataFrame([("hs_1", 10), ("hs_2", 0), ("mm_1", 5), ("mm_1", 5), ("x", 3)], "contig string, length long")
    faults = checks.contig_faults(lengths, ["hs_1", "hs_2", "hs_1", "gone"], ["mm_1", "hs_1"], ["hs_", "mm_"])
    assert set(faults) == {"contig gone is not in the sequence", "contig hs_1 is in two lists", "contig hs_1 is named again", "contig mm_1 stands 2 times in the sequence", "contig hs_2 has no bases", "contig x is of no or of several species"}
    assert checks.contig_faults(lengths.where("contig = 'hs_1'"), ["hs_1"]) == []


def test_sequence_files_of_both_layouts(spark, tmp_path):
    from braidwork.sources import checks

    names = ["a_S1_L001_R1_001.fastq.gz", "a_S1_L001_R3_001.fastq.gz", "b_c_S2_R1_002.fastq", "b_c_S2_R3_002.fastq", "read-RA_si-ACGT_lane-003-chunk-004.fastq.gz", "notes.txt", "odd.fastq"]
    for n in names:
        (tmp_path / n).write_text("@r\n")
    files = checks.sequence_files(spark, str(tmp_path)).cache()
    got = {r["path"].rsplit("/", 1)[1]: tuple(r)[1:] for r in files.collect()}
    assert got == {
        names[0]: ("sample", "a", "1", "R1", 1, 1), names[1]: ("sample", "a", "1", "R3", 1, 1), names[2]: ("sample", "b_c", "2", "R1", None, 2),
        names[3]: ("sample", "b_c", "2", "R3", None, 2), names[4]: ("preprocess", None, "ACGT", "RA", 3, 4),
    }
    sets = checks.read_sets(files.where("layout = 'sample'")).collect()
    assert {r["sample"]: sorted(r["paths"]) for r in sets} == {"a": ["R1", "R3"], "b_c": ["R1", "R3"]}
    assert checks.read_sets(files, ("RA",), samples=["ACGT"], lanes=[3]).count() == 1
    with pytest.raises(ValueError, match="lack a read kind"):
        checks.read_sets(files.where("read <> 'R3' and layout = 'sample'"))
