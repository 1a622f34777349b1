"""Column functions on barcodes, sequences, qualities and read names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bases with ambiguity codes, and their complements in the same order.
BASES = "ACGTNRYSWKMBDHVacgtnryswkmbdhv"
COMPLEMENTS = "TGCANYRSWMKVHDBtgcanyrswmkvhdb"


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, BASES, COMPLEMENTS))


def mask(seq: Column, start: int, end: int) -> Column:
    """N outside [start, end)."""
    kept = F.substring(seq, start + 1, max(0, end - start))
    return F.concat(F.repeat(F.lit("N"), F.least(F.lit(start), F.length(seq))), kept, F.repeat(F.lit("N"), F.greatest(F.length(seq) - end, F.lit(0))))


def gc_fraction(seq: Column) -> Column:
    """Share of G and C among the bases and Ns; null where there are none."""
    return F.try_divide(F.regexp_count(seq, F.lit("[GCgc]")), F.regexp_count(seq, F.lit("[ACGTNacgtn]")))


def hamming(a: Column, b: Column) -> Column:
    """Mismatches over the common length plus the difference of the lengths."""
    short = F.least(F.length(a), F.length(b))
    same = F.zip_with(F.split(F.substring(a, F.lit(1), short), ""), F.split(F.substring(b, F.lit(1), short), ""), lambda x, y: (x != y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda acc, x: acc + x) + F.abs(F.length(a) - F.length(b))


def library_suffix(barcode: Column) -> Column:
    """The part behind the dash as a number, null if there is none."""
    return F.when(F.size(F.split(barcode, "-")) == 2, F.split_part(barcode, F.lit("-"), F.lit(2)).try_cast("int"))


def split_barcode(barcode: Column) -> Column:
    """struct(part_a, part_c, part_b) of 7, 2 and 7 bases."""
    return F.struct(F.substring(barcode, 1, 7).alias("part_a"), F.substring(barcode, 8, 2).alias("part_c"), F.substring(barcode, 10, 7).alias("part_b"))


def merge_barcode(a: Column, c: Column, b: Column, group: Column | None = None) -> Column:
    whole = F.concat(a, c, b)
    return whole if group is None else F.when(group.isNull(), whole).otherwise(F.concat(whole, F.lit("-"), group.cast("string")))


def qualities(qual: Column) -> Column:
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)


def bases_at_least(qual: Column, cutoff: int) -> Column:
    return F.size(F.filter(qualities(qual), lambda q: q >= cutoff))


def expected_errors(qual: Column) -> Column:
    return F.aggregate(qualities(qual), F.lit(0.0), lambda acc, q: acc + F.pow(F.lit(10.0), -q / 10))


def is_homopolymer(seq: Column) -> Column:
    return seq.rlike(r"^(A+|C+|G+|T+)$")


def is_unambiguous(seq: Column) -> Column:
    return seq.rlike("^[ACGT]+$")


def two_bit(seq: Column) -> Column:
    """Up to 31 bases as a number, two bits each, the first highest."""
    code = F.translate(seq, "ACGT", "0123")
    return F.aggregate(F.filter(F.split(code, ""), lambda c: c != ""), F.lit(0).cast("long"), lambda acc, c: acc * 4 + c.cast("long"))


def reg2bin(start: Column, end: Column) -> Column:
    """The smallest bin of the six-level genome binning scheme that holds [start, end)."""
    last, out = end - 1, F.lit(0)
    # First bin number and shift of each level, coarse to fine.
    for first, shift in ((1, 26), (9, 23), (73, 20), (585, 17), (4681, 14)):
        same = F.shiftright(start, shift) == F.shiftright(last, shift)
        out = F.when(same, F.shiftright(start, shift) + first).otherwise(out)
    return out


def read_position(name: Column) -> Column:
    """struct(flowcell, lane, tile, x, y) of a colon-separated read name."""
    part = F.split(name, ":")
    return F.struct(F.get(part, F.lit(2)).alias("flowcell"), *[F.get(part, F.lit(k)).try_cast("int").alias(n) for k, n in ((3, "lane"), (4, "tile"), (5, "x"), (6, "y"))])


def is_url(text: Column) -> Column:
    """An http, https or ftp address with a host name, address or localhost, port and path optional."""
    host = r"(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+(?:[a-z]{2,}\.?)|localhost|\d{1,3}(?:\.\d{1,3}){3}"
    return F.coalesce(text.rlike(rf"(?i)^(?:https?|ftps?)://(?:{host})(?::\d+)?(?:/?|[/?]\S+)$"), F.lit(False))


def relative_position(start: Column, end: Column, strand: Column, point: Column) -> Column:
    """Distance from a region's middle, turned by strand; the width is end - start - 1."""
    at = (point - start) - F.floor((end - start - 1) / 2)
    return F.when(strand == "-", -at).otherwise(at)


def cigar_offsets(cigar: Column) -> Column:
    """For each read base its reference offset, null for insertions and soft clips.

    ``cigar`` is an array of struct(op, len) with ops 0 match, 1 insertion, 2
    deletion, 3 skip, 4 soft clip, 7 equal and 8 different."""
    start = F.struct(F.lit(0).alias("ref"), F.array().cast("array<int>").alias("out"))

    def step(acc, c):
        ahead = F.when(c["op"].isin(0, 2, 3, 7, 8), c["len"]).otherwise(0)
        none = F.array_repeat(F.lit(None).cast("int"), c["len"])
        here = F.when(c["len"] > 0, F.transform(F.sequence(F.lit(0), F.greatest(c["len"] - 1, F.lit(0))), lambda k: acc["ref"] + k)).otherwise(F.array().cast("array<int>"))
        more = F.when(c["op"].isin(0, 7, 8), here).when(c["op"].isin(1, 4), none).otherwise(F.array().cast("array<int>"))
        return F.struct((acc["ref"] + ahead).alias("ref"), F.concat(acc["out"], more).alias("out"))

    return F.aggregate(cigar, start, step, lambda acc: acc["out"])


def changes(seq: Column, after: Column | None = None, letters: str = "ACGT") -> Column:
    """All sequences at one substitution behind place ``after``, as structs (at, seq)."""
    first = F.lit(1) if after is None else after + 1
    at = F.filter(F.sequence(F.lit(1), F.length(seq)), lambda k: k >= first)
    others = lambda k: F.filter(F.array(*[F.lit(b) for b in letters]), lambda b: b != F.substring(seq, k, F.lit(1)))
    put = lambda k, b: F.concat(F.substring(seq, F.lit(1), k - 1), b, F.substring(seq, k + 1, F.length(seq)))
    return F.flatten(F.transform(at, lambda k: F.transform(others(k), lambda b: F.struct(k.alias("at"), put(k, b).alias("seq")))))


def neighbours(seq: Column) -> Column:
    """All sequences at one substitution, the sequence itself left out."""
    return F.transform(changes(seq), lambda c: c["seq"])


def all_sequences(spark, length: int):
    """(seq): all 4 ** length sequences, made by the executors."""
    digit = lambda k: F.get(F.array(*[F.lit(b) for b in "ACGT"]), (F.expr(f"id div {4**k}") % 4).cast("int"))
    return spark.range(4**length).select(F.concat(*[digit(k) for k in reversed(range(length))]).alias("seq"))


def clustering_key(kind: str, parameter: int | None = None) -> str:
    """The name of a clustering."""
    return f"{kind}_{parameter}_clusters" if parameter is not None else kind


def parse_clustering_key(key: str) -> tuple[str, int | None]:
    parts = key.split("_")
    return (parts[0], int(parts[1])) if len(parts) == 3 and parts[2] == "clusters" else (key, None)


def even_slices(n: int, parts: int) -> list[tuple[int, int]]:
    """The bounds of ``parts`` runs of nearly equal size; empty ones are left out."""
    edges = [n * k // parts for k in range(parts + 1)]
    return [(a, b) for a, b in zip(edges, edges[1:]) if b > a]
