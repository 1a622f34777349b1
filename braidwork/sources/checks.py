"""What is wrong with inputs: every fault is a row, found in one pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scan import running


def region_faults(regions: DataFrame, contigs: DataFrame) -> DataFrame:
    """(contig, start, end, fault) of regions against (contig, length).

    Faults: "columns" (a null), "empty" (no base), "negative", "contig" (none of that
    name), "beyond" (past its end) and "overlap" (with a region that begins before it, or
    with another of the same start); a region may have several.  Rows without faults
    have none.  Regions that overlap are found by a running maximum of ends."""
    known = regions.select("contig", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    rules = {"columns": F.col("contig").isNull() | F.col("start").isNull() | F.col("end").isNull(), "empty": F.col("end") <= F.col("start"), "negative": F.col("start") < 0}
    named = known.join(F.broadcast(contigs.select(F.col("contig").alias("_c"), F.col("length").cast("long").alias("_n"))), F.col("contig") == F.col("_c"), "left")
    rules |= {"contig": F.col("contig").isNotNull() & F.col("_n").isNull(), "beyond": F.col("end") > F.col("_n")}
    told = F.explode(F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))).alias("fault")
    alone = named.select("contig", "start", "end", told)
    sound = known.where("contig is not null and start is not null and end > start")
    seen = running(sound, ["contig"], "start", F.col("end"), "_before", "max", before=True)
    # of those that share a start, which one comes first is of no account: what lies before them all, and their number
    same = seen.groupBy("contig", "start").agg(F.min("_before").alias("_all"), F.count("*").alias("_same"))
    over = seen.join(same, ["contig", "start"]).where((F.col("_all") > F.col("start")) | (F.col("_same") > 1))
    return alone.unionByName(over.select("contig", "start", "end", F.lit("overlap").alias("fault")))


def fragment_faults(fragments: DataFrame, contigs: DataFrame, groups: int | None = 1) -> DataFrame:
    """(fault, n, example) of fragments: "contig", "beyond", "empty", "copies" (fewer than
    one), "barcode" (not letters, a dash and a number), and "groups" if barcodes come from
    more than ``groups`` gel-bead groups.  An empty result means none."""
    named = fragments.join(F.broadcast(contigs.select(F.col("contig").alias("_c"), F.col("length").alias("_n"))), F.col("contig") == F.col("_c"), "left")
    rules = {"contig": F.col("_n").isNull(), "beyond": F.col("stop") > F.col("_n"), "empty": F.col("stop") <= F.col("start"), "copies": F.coalesce(F.col("dup") < 1, F.lit(True)), "barcode": ~F.coalesce(F.col("barcode").rlike("^[ACGTN0-9BC]+-[0-9]+$"), F.lit(False))}
    told = F.explode(F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))).alias("fault")
    example = F.concat_ws(":", "contig", "start", "stop", "barcode")
    found = named.select(told, example.alias("example")).groupBy("fault").agg(F.count("*").alias("n"), F.min("example").alias("example"))
    if groups is None:
        return found
    many = fragments.agg(F.count_distinct(F.substring_index("barcode", "-", -1)).alias("n")).where(F.col("n") > groups)
    return found.unionByName(many.select(F.lit("groups").alias("fault"), "n", F.lit(None).cast("string").alias("example")))


def contig_faults(lengths: DataFrame, primary: list[str], other: list[str] = (), prefixes: list[str] = ()) -> list[str]:
    """What is wrong with a reference's definitions, against (contig, length) of its sequence.

    Primary contigs must be there and have bases, none may be in two lists, names may not
    repeat, and with several species each name must begin with just one of the prefixes."""
    known = {r["contig"]: (r["n"], r["length"]) for r in lengths.groupBy("contig").agg(F.count("*").alias("n"), F.max("length").alias("length")).collect()}  # a row for each contig
    faults = [] if primary else ["no primary contig is named"]
    faults += [f"contig {c} is not in the sequence" for c in [*primary, *other] if c not in known]
    faults += [f"contig {c} is in two lists" for c in sorted(set(primary) & set(other))]
    faults += [f"contig {c} is named again" for names in (primary, other) for c in sorted({c for c in names if list(names).count(c) > 1})]
    faults += [f"contig {c} stands {n} times in the sequence" for c, (n, _) in sorted(known.items()) if n > 1]
    faults += [f"contig {c} has no bases" for c in primary if c in known and not known[c][1]]
    if len(prefixes) > 1:
        faults += [f"contig {c} is of no or of several species" for c in sorted(known) if sum(c.startswith(p) for p in prefixes) != 1]
    return faults


def sequence_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, layout, sample, index, read, lane, chunk) of the sequence files below a folder.

    Fixed name forms: "read-<kind>_si-<index>_lane-<n>-chunk-<n>" (layout ``preprocess``) and
    "<sample>_S<n>_L<lane>_<read>_<chunk>" with or without the lane (layout ``sample``), each
    followed by .fastq, .fq or their gzip forms.  Only names are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.f*q*").load(folder).select("path")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    first, second = r"^read-([A-Z0-9]{2})_si-([^_]+)_lane-(\d+)-chunk-(\d+)[^/]*\.f(?:ast)?q(?:\.gz)?$", r"^(.+)_S(\d+)(?:_L(\d{3}))?_([RI]\d)_(\d{3})\.f(?:ast)?q(?:\.gz)?$"
    part = lambda form, k: F.nullif(F.regexp_extract(name, form, k), F.lit(""))
    layout = F.when(name.rlike(first), "preprocess").when(name.rlike(second), "sample")
    of = lambda a, b: F.when(name.rlike(first), a).when(name.rlike(second), b)
    none = F.lit(None).cast("string")
    found = files.select("path", layout.alias("layout"), of(none, part(second, 1)).alias("sample"), of(part(first, 2), part(second, 2)).alias("index"), of(part(first, 1), part(second, 4)).alias("read"), of(part(first, 3), part(second, 3)).cast("int").alias("lane"), of(part(first, 4), part(second, 5)).cast("int").alias("chunk"))
    return found.where("layout is not null")


def read_sets(files: DataFrame, needed: tuple[str, ...] = ("R1", "R3"), samples: list[str] | None = None, lanes: list[int] | None = None) -> DataFrame:
    """(layout, sample, index, lane, chunk, paths): files that belong together, ``paths`` from
    read kind to path; of the samples and lanes asked for.  A set that lacks a needed kind
    is an error, as its reads would be lost."""
    some = files
    if samples is not None:
        some = some.where(F.col("sample").isin(samples) | F.col("index").isin(samples))
    if lanes is not None:
        some = some.where(F.col("lane").isin(lanes))
    sets = some.groupBy("layout", "sample", "index", "lane", "chunk").agg(F.map_from_entries(F.collect_list(F.struct("read", "path"))).alias("paths"))
    lacking = sets.where(~F.forall(F.array(*[F.lit(k) for k in needed]), lambda k: F.map_contains_key("paths", k))).first() if needed else None
    if lacking:
        raise ValueError(f"files of {lacking['sample'] or lacking['index']}, lane {lacking['lane']}, chunk {lacking['chunk']} lack a read kind of {', '.join(needed)}")
    return sets
