"""Readers and writers of the interval formats, on Spark's own sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAGMENT = "contig string, start long, stop long, barcode string, dup int"


def read_fragments(spark: SparkSession, path: str, contig: str | None = None) -> DataFrame:
    """Tab-separated fragments (plain or gzip); one contig only if asked for."""
    rows = spark.read.schema(FRAGMENT).option("sep", "\t").option("comment", "#").csv(path)
    return rows if contig is None else rows.where(F.col("contig") == contig)


def write_fragments(df: DataFrame, path: str) -> None:
    """Parquet by contig, sorted, so that a contig's scan prunes the others."""
    df.repartition("contig", F.floor(F.col("start") / (1 << 22))).sortWithinPartitions("contig", "start", "stop").write.partitionBy("contig").parquet(path)


def read_bed(spark: SparkSession, path: str, pad: int = 0) -> DataFrame:
    """(contig, start, end, name, strand); header and blank lines are skipped, odd strands are null."""
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^(browser|track|#)") & (F.trim("value") != ""))
    f = F.split("value", "\t")
    strand = F.get(f, F.lit(5))
    return lines.select(
        F.get(f, F.lit(0)).alias("contig"), F.greatest(F.get(f, F.lit(1)).cast("long") - pad, F.lit(0)).alias("start"), (F.get(f, F.lit(2)).cast("long") + pad).alias("end"), F.get(f, F.lit(3)).alias("name"), F.when(strand.isin("+", "-"), strand).alias("strand")
    )


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(~F.col("value").contains("#") & (F.trim("value") != "")).select(F.trim("value").alias("barcode")).distinct()


def read_cell_barcodes(spark: SparkSession, path: str) -> DataFrame:
    """(species, barcode) of lines ``species,barcode,barcode,...``."""
    f = F.split("value", ",")
    rows = spark.read.text(path).select(F.get(f, F.lit(0)).alias("species"), F.explode(F.slice(f, F.lit(2), F.greatest(F.size(f) - 1, F.lit(0)))).alias("barcode"))
    return rows.where(~F.col("barcode").isin("", "null"))


MEX_HEAD = "%%MatrixMarket matrix coordinate integer general"


def _size_line(lines: DataFrame):
    """(file, at) of the size line: the first line behind the comments of the headed part.

    One pass: of each file the places of its header and of its first plain line."""
    at = lines.groupBy("file").agg(F.min(F.when(F.col("value").startswith("%%MatrixMarket"), F.col("at"))).alias("head"), F.min(F.when(~F.col("value").startswith("%"), F.col("at"))).alias("at"))
    return at.where("head is not null and at is not null").select("file", "at").first()


def read_mex(spark: SparkSession, path: str) -> DataFrame:
    """(feature_id, barcode_id, value) with ids from 0, of a Matrix Market file or folder.

    The size line, three numbers like an entry, is the first after the comments of the
    part that begins with the header; parts without a header hold entries alone."""
    meta = "_metadata"
    lines = spark.read.text(path).select("value", F.col(f"{meta}.file_path").alias("file"), F.monotonically_increasing_id().alias("at")).where(F.trim("value") != "")
    size = _size_line(lines)
    rows = lines.where(~F.col("value").startswith("%"))
    rows = rows.where(~((F.col("file") == size["file"]) & (F.col("at") == size["at"]))) if size else rows
    f = F.split(F.trim("value"), "[ \t]+")
    return rows.select((F.get(f, F.lit(0)).cast("long") - 1).alias("feature_id"), (F.get(f, F.lit(1)).cast("long") - 1).alias("barcode_id"), F.get(f, F.lit(2)).cast("long").alias("value"))


def write_mex(m: DataFrame, path: str, features: DataFrame | None = None, barcodes: DataFrame | None = None) -> None:
    """A Matrix Market text in parts below ``path``/matrix: the first has the header and
    the size, the others entries, so the parts one after another are the file.

    ``features`` (feature_id, more) and ``barcodes`` (barcode_id, barcode) give the shape
    and are written in order beside it; without them the largest ids do."""
    largest = m.agg(F.max("feature_id").alias("feature_id"), F.max("barcode_id").alias("barcode_id")).first()
    count = lambda t, c: t.count() if t is not None else 0 if largest[c] is None else largest[c] + 1
    shape = (count(features, "feature_id"), count(barcodes, "barcode_id"), m.count())
    head = m.sparkSession.createDataFrame([(f"{MEX_HEAD}\n{shape[0]} {shape[1]} {shape[2]}",)], "value string").coalesce(1)
    entries = m.sortWithinPartitions("barcode_id", "feature_id").select(F.concat_ws(" ", F.col("feature_id") + 1, F.col("barcode_id") + 1, F.col("value")).alias("value"))
    head.unionByName(entries).write.text(f"{path}/matrix")
    for table, key, name in ((features, "feature_id", "features"), (barcodes, "barcode_id", "barcodes")):
        if table is not None:
            table.orderBy(key).drop(key).write.option("sep", "\t").csv(f"{path}/{name}")


def write_dense(m: DataFrame, path: str, barcodes: list) -> None:
    """Features by the named barcodes as CSV with a header, absent entries zero."""
    m.groupBy("feature_id").pivot("barcode_id", barcodes).agg(F.sum("value")).fillna(0).orderBy("feature_id").write.option("header", True).csv(path)


def region_columns(name) -> list:
    """contig, start and end of ``contig:start-end``."""
    part = lambda k: F.regexp_extract(name, r"^(.*):(\d+)-(\d+)$", k)
    return [part(1).alias("contig"), part(2).cast("long").alias("start"), part(3).cast("long").alias("end")]


def write_peaks(features: DataFrame, path: str) -> None:
    """Features named ``contig:start-end`` as BED rows, in feature order."""
    features.orderBy("feature_id").select(*region_columns(F.col("id"))).write.option("sep", "\t").csv(path)


def read_csvs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several CSV files with the same header as one table."""
    return spark.read.option("header", True).option("enforceSchema", False).csv(paths)


def read_insert_sizes(spark: SparkSession, path: str, sizes: range | None = None, barcodes: DataFrame | None = None) -> DataFrame:
    """(barcode, size, n) of the wide table with a column for each size; columns and rows as asked for."""
    wide = spark.read.option("header", True).csv(path)
    named = [c for c in wide.columns[1:] if sizes is None or (c.isdigit() and int(c) in sizes)]
    if barcodes is not None:
        wide = wide.join(barcodes.select(F.col("barcode").alias(wide.columns[0])), wide.columns[0], "left_semi")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("size"), F.col(f"`{c}`").cast("long").alias("n")) for c in named])).alias("e")
    return wide.select(F.col(wide.columns[0]).alias("barcode"), cells).select("barcode", "e.size", "e.n")


def read_aggregation(spark: SparkSession, path: str, required: tuple[str, ...] = ("library_id", "fragments", "cells"), barred: tuple[str, ...] = ("batch",)) -> DataFrame:
    """The libraries of an aggregation table; raises ValueError for what is wrong with it."""
    df = spark.read.option("header", True).csv(path)
    names = [c.strip().lower() for c in df.columns]
    df = df.toDF(*names)
    if missing := [c for c in required if c not in names]:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    if wrong := [c for c in barred if c in names]:
        raise ValueError(f"columns are not allowed: {', '.join(wrong)}")
    bad = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required], (F.count("*") - F.count_distinct("library_id")).alias("_again")).first()
    if empty := [c for c in required if bad[c]]:
        raise ValueError(f"values are missing: {', '.join(empty)}")
    if bad["_again"]:
        raise ValueError("library_id has repeated values")
    return df


_PAIR = r'([A-Za-z0-9_]+)[ =]+"?([^";]+)"?'


def attributes(text):
    """A map from each attribute of a GTF or GFF3 row to its values, in order.

    Keys may repeat (``tag "basic"; tag "CCDS";``)."""
    keys, values = (F.regexp_extract_all(text, F.lit(_PAIR), F.lit(k)) for k in (1, 2))
    distinct = F.array_distinct(keys)
    return F.map_from_arrays(distinct, F.transform(distinct, lambda k: F.transform(F.filter(F.arrays_zip(keys.alias("k"), values.alias("v")), lambda e: e["k"] == k), lambda e: F.trim(e["v"]))))


def _gene_rows(spark: SparkSession, path: str):
    f = F.split("value", "\t")
    return spark.read.text(path).where(~F.col("value").startswith("#") & (F.size(f) >= 9)), f


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """(contig, feature, start, end, strand, attributes, all_attributes); starts from 0.

    ``attributes`` has the first value of each key, ``all_attributes`` all of them."""
    lines, f = _gene_rows(spark, path)
    rows = lines.select(F.get(f, F.lit(0)).alias("contig"), F.get(f, F.lit(2)).alias("feature"), (F.get(f, F.lit(3)).cast("long") - 1).alias("start"), F.get(f, F.lit(4)).cast("long").alias("end"), F.get(f, F.lit(6)).alias("strand"), attributes(F.get(f, F.lit(8))).alias("all_attributes"))
    return rows.withColumn("attributes", F.transform_values("all_attributes", lambda _, v: F.get(v, F.lit(0))))


def gene_format(spark: SparkSession, path: str, first: int = 100) -> str:
    """"gff3" or "gtf", by how the first rows write their attributes; an error if they differ."""
    lines, f = _gene_rows(spark, path)
    seen = lines.limit(first).agg(F.count("*").alias("n"), F.count_if(F.get(f, F.lit(8)).rlike(r"^\s*\w+=")).alias("gff")).first()
    if not seen["n"] or seen["gff"] not in (0, seen["n"]):
        raise ValueError(f"{path} is neither GTF nor GFF3")
    return "gff3" if seen["gff"] else "gtf"


def gff3_to_gtf(spark: SparkSession, path: str) -> DataFrame:
    """(value): GTF rows of a GFF3 file.

    A record's gene is itself or its parent's; ``Name`` becomes gene_name on genes, and
    ``ID`` and ``Parent`` become transcript_id and gene_id on what they name.  A record
    of several parents (an exon that transcripts share) gives a row for each of them;
    values are decoded after they are split at commas, and a double quote becomes single."""
    lines, f = _gene_rows(spark, path)
    plain = lambda c: F.translate(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), '"', "'")
    told = lambda c: F.coalesce(plain(c), c)  # noqa: E731  a stray percent sign stays as it is
    first = lambda k: F.get(F.col("a")[k], F.lit(0))
    rows = lines.select(*[F.get(f, F.lit(k)).alias(f"c{k}") for k in range(8)], attributes(F.get(f, F.lit(8))).alias("a"))
    parents = F.explode_outer(F.split(first("Parent"), ",")).alias("parent")
    rows = rows.select(*[f"c{k}" for k in range(8)], first("ID").alias("id"), first("Name").alias("name"), parents)
    rows = rows.withColumns({c: told(F.col(c)) for c in ("id", "name", "parent")})
    genes = rows.where("c2 = 'gene'").select(F.col("id").alias("g"), F.coalesce("name", "id").alias("gene_name"))
    parts = rows.where("c2 in ('transcript', 'mRNA')").select(F.col("id").alias("t"), F.col("parent").alias("of"))
    joined = rows.join(parts, rows["parent"] == parts["t"], "left")
    gene = F.when(F.col("c2") == "gene", F.col("id")).when(F.col("c2").isin("transcript", "mRNA"), F.col("parent")).otherwise(F.col("of"))
    made = F.when(F.col("c2").isin("transcript", "mRNA"), F.col("id")).when(F.col("c2") != "gene", F.col("parent"))
    named = joined.withColumns({"gene": gene, "made": made}).join(genes, F.col("gene") == F.col("g"), "left")
    pair = lambda k, c: F.when(c.isNotNull(), F.concat(F.lit(f'{k} "'), c, F.lit('";')))
    text = F.concat_ws(" ", pair("gene_id", F.col("gene")), pair("transcript_id", F.col("made")), pair("gene_name", F.col("gene_name")))
    return named.select(F.concat_ws("\t", *[f"c{k}" for k in range(8)], text).alias("value"))


def read_vcf(spark: SparkSession, path: str, contig: str | None = None, start: int = 0, end: int | None = None) -> DataFrame:
    """(contig, pos, id, ref, alts, qual, filters, info) with positions from 0, of a locus if asked for."""
    f = F.split("value", "\t")
    at = lambda k: F.get(f, F.lit(k))
    blank = lambda c: F.when(c != ".", c)
    info = F.transform(F.split(at(7), ";"), lambda e: F.struct(F.split_part(e, F.lit("="), F.lit(1)).alias("k"), F.when(F.contains(e, F.lit("=")), F.substring_index(e, "=", -1)).otherwise("true").alias("v")))
    rows = spark.read.text(path).where(~F.col("value").startswith("#") & (F.size(f) >= 8)).select(
        at(0).alias("contig"), (at(1).cast("long") - 1).alias("pos"), blank(at(2)).alias("id"), at(3).alias("ref"), F.split(at(4), ",").alias("alts"), blank(at(5)).cast("double").alias("qual"), F.split(blank(at(6)), ";").alias("filters"), F.when(at(7) != ".", info).alias("info")
    )
    if contig is None:
        return rows
    return rows.where((F.col("contig") == contig) & (F.col("pos") >= start) & (F.col("pos") < end if end is not None else F.lit(True)))


def write_vcf(rows: DataFrame, path: str, contigs: list[tuple[str, int]] = ()) -> None:
    """Rows as ``read_vcf`` gives them, as text below ``path``: the first part has the
    header, and parts one after another, by their names, are the file in order.

    ``contigs`` (name, length) are told in the header and lay down the order; contigs
    that aren't among them follow by name."""
    order = {n: k for k, (n, _) in enumerate(contigs)}
    place = F.coalesce(F.create_map(*[F.lit(x) for p in order.items() for x in p])[F.col("contig")], F.lit(len(order))) if order else F.lit(0)
    or_dot = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("."))
    entry = lambda e: F.when(e["v"] == "true", e["k"]).otherwise(F.concat(e["k"], F.lit("="), e["v"]))
    whole = F.col("qual") == F.floor("qual")
    qual = F.when(whole, F.col("qual").cast("long").cast("string")).otherwise(F.col("qual").cast("string"))
    fields = [F.col("contig"), (F.col("pos") + 1).cast("string"), or_dot(F.col("id")), F.col("ref"), F.concat_ws(",", "alts"), or_dot(qual), or_dot(F.concat_ws(";", "filters")), or_dot(F.concat_ws(";", F.transform("info", entry)))]
    head = ["##fileformat=VCFv4.2", *[f"##contig=<ID={n},length={m}>" for n, m in contigs], "#" + "\t".join(("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"))]
    top = rows.sparkSession.createDataFrame([(-1, "", -1, "\n".join(head))], "place int, contig string, pos long, value string")
    body = rows.select(place.cast("int").alias("place"), "contig", F.col("pos").cast("long").alias("pos"), F.concat_ws("\t", *fields).alias("value"))
    top.unionByName(body).orderBy("place", "contig", "pos", "value").select("value").write.text(path)


def write_motifs(features: DataFrame, path: str) -> None:
    """(feature_id, id, name) as lines of id and name, in feature order."""
    features.orderBy("feature_id").select("id", "name").write.option("sep", "\t").csv(path)


def write_row(values: dict, spark: SparkSession, path: str) -> None:
    """A dictionary as CSV of a header and one row; missing values and NaN are empty."""
    text = lambda v: None if v is None or v != v else str(v)
    names = [f"_{k}" for k in range(len(values))]
    row = spark.createDataFrame([tuple(text(v) for v in values.values())], ", ".join(f"{n} string" for n in names))
    row.toDF(*values).coalesce(1).write.option("header", True).csv(path)


VARIANT = ["contig", "pos", "ref", "alts"]


def shared_variants(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` that ``b`` has as well."""
    return a.join(b.select(*VARIANT).distinct(), VARIANT, "left_semi")


def other_variants(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` that ``b`` lacks."""
    return a.join(b.select(*VARIANT).distinct(), VARIANT, "left_anti")


def variants_in(a: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows of ``a`` inside any region."""
    from ..operators.intervals import overlap_join

    spans = a.withColumns({"start": F.col("pos"), "stop": F.col("pos") + F.length("ref")})
    return overlap_join(spans, regions, "left_semi", touching=False).drop("start", "stop")


def transcription_starts(gtf: DataFrame) -> DataFrame:
    """One-base intervals where transcripts start: the first base on +, the last on -."""
    t = gtf.where(F.col("feature").isin("transcript", "mRNA"))
    at = F.when(F.col("strand") == "-", F.col("end") - 1).otherwise(F.col("start"))
    return t.select("contig", at.alias("start"), (at + 1).alias("end"), F.col("attributes")["gene_name"].alias("name"), "strand")
