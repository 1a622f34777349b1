"""Contigs as a dimension: which are primary, whose they are, and what reads on them count.

A contig table has a row per contig: contig, length, species, is_primary, is_sex, in
reference order by ``idx``.  It is a genome's, so it is small; its primary ones are
broadcast, as a join that shuffles rows by contig puts a whole contig into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Mates further apart than this are chimeric; reads of at least this quality are sure.
FAR, SURE = 5000, 30
#: Gene types that annotations keep, as fixed values.
GENE_TYPES = ("protein_coding", "TR_V_gene", "TR_D_gene", "TR_J_gene", "TR_C_gene", "IG_V_gene", "IG_D_gene", "IG_J_gene", "IG_C_gene")


def primary(contigs: DataFrame, species: str | None = None, sex: bool = False) -> DataFrame:
    """Primary contigs, of one species if named; sex chromosomes only if asked for."""
    keep = F.col("is_primary") & (F.lit(sex) | ~F.col("is_sex"))
    return contigs.where(keep & (F.col("species") == species) if species is not None else keep)


def on_primary(rows: DataFrame, contigs: DataFrame, **which) -> DataFrame:
    """``rows`` on primary contigs."""
    return rows.join(F.broadcast(primary(contigs, **which).select("contig")), "contig", "left_semi")


def with_primary(rows: DataFrame, contigs: DataFrame, **which) -> DataFrame:
    """``rows`` with ``is_primary``; false on contigs that aren't listed."""
    listed = primary(contigs, **which).select("contig", F.lit(True).alias("is_primary"))
    return rows.join(F.broadcast(listed), "contig", "left").withColumn("is_primary", F.coalesce("is_primary", F.lit(False)))


def species_of(contig: Column, species: list[str]) -> Column:
    """The species whose name and an underscore start the contig; empty with one species, null if none fits."""
    if len(species) < 2:
        return F.lit("")
    return F.coalesce(*[F.when(F.startswith(contig, F.lit(f"{s}_")), s) for s in species])


def without_species(contig: Column, species: list[str]) -> Column:
    """The name without the species before it."""
    return F.coalesce(*[F.when(F.startswith(contig, F.lit(f"{s}_")), F.substring(contig, len(s) + 2, 1 << 20)) for s in species], contig)


def clean_name(contig: Column, known: list[str]) -> Column:
    """The name by which a contig is known: as it is, with or without "chr", M for MT
    and the reverse; null if none is known."""
    bare = F.regexp_replace(contig, "^chr", "")
    other = F.when(bare == "M", "MT").when(bare == "MT", "M").otherwise(bare)
    forms = [contig, bare, F.concat(F.lit("chr"), bare), other, F.concat(F.lit("chr"), other)]
    return F.coalesce(*[F.when(f.isin(*known), f) for f in forms])


def cleaned(rows: DataFrame, known: list[str]) -> DataFrame:
    """``rows`` under known names; rows on other contigs go."""
    return rows.withColumn("contig", clean_name(F.col("contig"), known)).where("contig is not null")


def unseen(rows: DataFrame, contigs: DataFrame) -> DataFrame:
    """Contigs of the table that no row is on."""
    return contigs.join(rows.select("contig").distinct(), "contig", "left_anti").select("contig")


def in_order(rows: DataFrame, contigs: DataFrame) -> DataFrame:
    """``rows`` with ``idx``, the contig's place in the reference, to sort by."""
    return rows.join(contigs.select("contig", "idx"), "contig")


def offsets(contigs: DataFrame) -> DataFrame:
    """(contig, offset): bases before each contig; the window holds a row per contig."""
    ahead = F.sum("length").over(Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, -1))
    return contigs.select("contig", F.coalesce(ahead, F.lit(0)).alias("offset"))


def global_position(rows: DataFrame, contigs: DataFrame, pos: str) -> DataFrame:
    """``rows`` with ``global_pos``: the position counted over all contigs, modulo 2**31 - 1."""
    return rows.join(offsets(contigs), "contig").withColumn("global_pos", (F.col(pos) + F.col("offset")) % ((1 << 31) - 1)).drop("offset")


def chimeric(contig: Column, mate_contig: Column, pos: Column, mate_pos: Column, reverse: Column, mate_reverse: Column, far: int = FAR) -> Column:
    """Mates on two contigs, far apart, on one strand, or turned away from each other."""
    away = F.when(reverse, pos < mate_pos).otherwise(pos > mate_pos)
    return (contig != mate_contig) | (F.abs(pos - mate_pos) > far) | (reverse == mate_reverse) | away


def stringent(mapq: Column, secondary: Column, barcode: Column, cigar_operations: Column, distance: Column, least: int, need_barcode: bool = True) -> Column:
    """Sure, primary, in one piece, far enough from the mate, and with a barcode if need be."""
    sure = (mapq >= SURE) & ~secondary & (cigar_operations == 1) & (F.abs(distance) >= least)
    return sure & barcode.isNotNull() if need_barcode else sure


def valid_transcripts(records: DataFrame, contigs: DataFrame) -> DataFrame:
    """Transcript records on known contigs, without the second copy of shared regions."""
    rows = records.where(F.col("type").isin("transcript", "mRNA") & ~F.coalesce(F.col("transcript_id").endswith("_PAR_Y"), F.lit(False)))
    return rows.join(contigs.select("contig"), "contig", "left_semi")


def routed(elements: DataFrame) -> DataFrame:
    """Regulatory elements with ``track``: promoter, ctcf, or enhancer for all others."""
    name = F.lower("element")
    return elements.withColumn("track", F.when(F.contains(name, F.lit("promoter")), "promoter").when(F.contains(name, F.lit("ctcf")), "ctcf").otherwise("enhancer"))


def kept_gene_types(sites: DataFrame) -> DataFrame:
    """Sites of the gene types that annotations keep; all, typed ".", if no type is given."""
    if "gene_type" not in sites.columns:
        return sites.withColumn("gene_type", F.lit("."))
    return sites.where(F.col("gene_type").isin(*GENE_TYPES))
