"""Barcodes as cells: counters, scores, thresholds and the calls made from them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The per-barcode mapping counters, in their order.
COUNTERS = ("total", "duplicate", "chimeric", "unmapped", "lowmapq", "mitochondrial", "passed_filters")


def mapping_counters(reads: DataFrame, kind: str = "class", barcode: str = "barcode") -> DataFrame:
    """(barcode, the seven counters) of read pairs that ``fragments.classify`` told apart."""
    counts = [F.count("*").alias("total")] + [F.count_if(F.col(kind) == c).alias(c) for c in COUNTERS[1:]]
    return reads.groupBy(barcode).agg(*counts)


def added(counters: DataFrame, key: str = "barcode") -> DataFrame:
    """Counters of several parts of a library added up."""
    names = [c for c in counters.columns if c != key]
    return counters.groupBy(key).agg(*[F.sum(c).alias(c) for c in names])


def site_score(profile: DataFrame, reach: int = 1000) -> DataFrame:
    """(score): the largest over the least non-zero count of offsets within ``reach``."""
    near = profile.where(F.abs("offset") <= reach)
    return near.agg(F.try_divide(F.max("n"), F.min(F.when(F.col("n") > 0, F.col("n")))).alias("score"))


def footprint_score(profile: DataFrame, left: int = -23, right: int = 34, centre: int = -3) -> DataFrame:
    """(score): what two flanks stand above the centre, in shares of the highest count."""
    at = lambda x: F.coalesce(F.max(F.when(F.col("offset") == x, F.col("n"))), F.lit(0))
    return profile.agg(F.try_divide(at(left) + at(right) - at(centre), F.max("n")).alias("score"))


def sensitivity(cells: DataFrame, value: str, is_cell: str) -> DataFrame:
    """(is_cell, mean, median, least, deviation) of barcodes that are cells and that aren't."""
    v = F.col(value)
    return cells.groupBy(F.col(is_cell).alias("is_cell")).agg(F.avg(v).alias("mean"), F.percentile(v, F.lit(0.5)).alias("median"), F.min(v).alias("least"), F.stddev_pop(v).alias("deviation"))


def observed_doublets(calls: DataFrame) -> DataFrame:
    """(calls, doublets, rate) of (species, barcode): a doublet is a barcode called twice."""
    out = calls.agg(F.count("*").alias("calls"), (F.count("*") - F.count_distinct("barcode")).alias("doublets"))
    return out.withColumn("rate", F.try_divide("doublets", F.col("calls") - F.col("doublets")))


def inferred_doublets(observed: int, first: int, second: int) -> int:
    """The likeliest number of doublets of all kinds, of which only those of two species
    show: with shares p and q of the species a doublet shows with probability 2pq."""
    cells = first + second - observed
    if not cells or not first or not second:
        return 0
    shown = 2 * (first / (first + second)) * (second / (first + second))
    chance = lambda n: math.lgamma(n + 1) - math.lgamma(observed + 1) - math.lgamma(n - observed + 1) + observed * math.log(shown) + (n - observed) * math.log(1 - shown)
    return max(range(observed, cells + 1), key=chance)


def purity(own: Column, other: Column) -> Column:
    """The median share of a barcode's own species."""
    return F.percentile(F.try_divide(own, own + other), F.lit(0.5))


def fractions(df: DataFrame, shares: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` with a column for each name: the first over the second column, null over zero."""
    return df.withColumns({name: F.try_divide(F.col(a), F.col(b)) for name, (a, b) in shares.items()})


# --- which barcodes are cells


def depth_shift(counts: DataFrame, whitelist: int, value: str = "n") -> int:
    """What stray fragments give every barcode: 2 % of all over the whitelist, 5 at least."""
    total = counts.agg(F.sum(value)).first()[0] or 0
    return max(5, int(total * 0.02 / whitelist))


def shifted(counts: DataFrame, shift: int, value: str = "n") -> DataFrame:
    """Barcodes that hold more than the shift, less the shift."""
    return counts.where(F.col(value) > shift).withColumn(value, F.col(value) - shift)


def forced(counts: DataFrame, cells: int, value: str = "n") -> DataFrame:
    """The ``cells`` largest barcodes, and all that tie with the last of them."""
    cut = counts.where(F.col(value) > 0).orderBy(F.desc(value)).limit(cells).agg(F.min(value).alias("_cut"))
    return counts.join(F.broadcast(cut), F.col(value) >= F.col("_cut")).drop("_cut")


def by_magnitude(counts: DataFrame, recovered: int, value: str = "n", quantile: float = 0.99, share: float = 0.1) -> DataFrame:
    """Barcodes of at least ``share`` of a high quantile of the ``recovered`` largest."""
    top = counts.orderBy(F.desc(value)).limit(recovered)
    cut = top.agg(F.greatest(F.lit(1.0), F.round(F.percentile(value, F.lit(quantile)) * share)).alias("_cut"))
    return counts.join(F.broadcast(cut), F.col(value) >= F.col("_cut")).drop("_cut")


def largest(counts: DataFrame, cutoff: int, value: str = "n", key: str = "barcode") -> DataFrame:
    """The ``cutoff`` largest barcodes that aren't empty; ties by name."""
    return counts.where(F.col(value) > 0).orderBy(F.desc(value), key).limit(cutoff)


def listed(counts: DataFrame, cells: DataFrame, key: str = "barcode") -> DataFrame:
    """Barcodes of a given list."""
    return counts.join(cells.select(key).distinct(), key, "left_semi")


def called(counts: DataFrame, threshold: int, excluded: DataFrame | None = None, whitelist: int = 1, most: int = 20_000, force: int | None = None) -> DataFrame:
    """(barcode, n, is_cell): a barcode is a cell if, less the shift, it reaches the
    threshold (or is among ``force`` largest), isn't excluded, and is among ``most``."""
    shift = depth_shift(counts, whitelist)
    left = shifted(counts, shift)
    if excluded is not None:
        left = left.join(excluded.select("barcode"), "barcode", "left_anti")
    cells = forced(left, force) if force else largest(left.where(F.col("n") >= threshold), most)
    return counts.join(cells.select("barcode", F.lit(True).alias("is_cell")), "barcode", "left").withColumn("is_cell", F.coalesce("is_cell", F.lit(False)))


def bead_candidates(counts: DataFrame, group: Column, least: int = 250, most: int = 15_000) -> DataFrame:
    """The ``most`` largest barcodes of each group of those with over ``least`` fragments."""
    over = Window.partitionBy("_group").orderBy(F.desc("n"), "barcode")
    ranked = counts.where(F.col("n") > least).withColumn("_group", group).withColumn("_rank", F.row_number().over(over))
    return ranked.where(F.col("_rank") <= most).drop("_group", "_rank")


def cell_barcodes(singlecell: DataFrame, species: list[str]) -> DataFrame:
    """(species, barcode) of the barcodes marked as cells."""
    flags = F.explode(F.array(*[F.when(F.col(f"is_{s}_cell_barcode") == 1, s) for s in species])).alias("species")
    return singlecell.select("barcode", flags).where("species is not null").select("species", "barcode")


def cell_names(cells: DataFrame) -> DataFrame:
    """(barcode, cell): ``<species>_cell_<i>`` by name order within a species; a
    barcode of several species has their names joined by an underscore.

    Numbers come from a window within species, over cells alone (20,000 of each)."""
    named = cells.withColumn("_i", F.row_number().over(Window.partitionBy("species").orderBy("barcode")) - 1)
    name = F.concat("species", F.lit("_cell_"), F.col("_i").cast("string"))
    return named.groupBy("barcode").agg(F.array_join(F.array_sort(F.collect_list(name)), "_").alias("cell"))


def bead_metrics(cells: DataFrame, excluded: DataFrame) -> DataFrame:
    """(cells, excluded, rate): barcodes left out as second barcodes of a bead, of all."""
    n = cells.select("barcode").distinct().agg(F.count("*").alias("cells"))
    gone = excluded.select("barcode").distinct().agg(F.count("*").alias("excluded"))
    return n.join(F.broadcast(gone)).withColumn("rate", F.try_divide("excluded", F.col("cells") + F.col("excluded")))


def call_metrics(calls: DataFrame) -> DataFrame:
    """(metric, value): cells and their fragments by species, names suffixed by it."""
    per = calls.where("is_cell").groupBy("species").agg(F.count("*").cast("double").alias("cells"), F.sum("n").cast("double").alias("fragments"), F.percentile("n", F.lit(0.5)).alias("median_fragments"))
    kinds = ("cells", "fragments", "median_fragments")
    return per.select(F.explode(F.array(*[F.struct(F.concat_ws("_", F.lit(k), F.nullif("species", F.lit(""))).alias("metric"), F.col(k).alias("value")) for k in kinds])).alias("m")).select("m.*")


def united(parts: list[tuple[int, DataFrame]]) -> DataFrame:
    """(species, barcode) of several libraries, each barcode under its library's number."""
    out = None
    for number, cells in parts:
        rows = cells.select("species", F.concat(F.regexp_replace("barcode", "-[0-9]+$", ""), F.lit(f"-{number}")).alias("barcode"))
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def format_problems(singlecell: DataFrame, species: list[str], whitelist: DataFrame | None = None, groups: int | None = 1) -> DataFrame:
    """(problem, n) of a per-barcode table: missing columns, values that are no flags,
    unknown barcodes, too many groups; empty if it is in order."""
    spark = singlecell.sparkSession
    need = ["barcode", *[f"is_{s}_cell_barcode" for s in species]]
    missing = [(f"missing column {c}", 1) for c in need if c not in singlecell.columns]
    if missing:
        return spark.createDataFrame(missing, "problem string, n long")
    rows = singlecell.where("barcode <> 'NO_BARCODE'")
    checks = [rows.where(~F.col(c).isin(0, 1) | F.col(c).isNull()).agg(F.lit(f"no flag in {c}").alias("problem"), F.count("*").alias("n")) for c in need[1:]]
    checks.append(rows.groupBy("barcode").agg(F.count("*").alias("k")).where("k > 1").agg(F.lit("repeated barcode").alias("problem"), F.count("*").alias("n")))
    if whitelist is not None:
        bare = rows.select(F.regexp_replace("barcode", "-[0-9]+$", "").alias("barcode"))
        checks.append(bare.join(whitelist.select("barcode"), "barcode", "left_anti").agg(F.lit("unknown barcode").alias("problem"), F.count("*").alias("n")))
    if groups is not None:
        seen = rows.agg(F.count_distinct(F.regexp_extract("barcode", "-([0-9]+)$", 1)).alias("n"))
        checks.append(seen.where(F.col("n") > groups).select(F.lit("too many groups").alias("problem"), "n"))
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.where("n > 0")


# --- sampling


def keep_rate(requested: float | None, available: float) -> float:
    """The share of what is available that gives what is requested, 1 at most."""
    return 1.0 if requested is None or not available else min(1.0, requested / available)


def random_cells(cells: DataFrame, n: int, seed: int, key: str = "barcode") -> DataFrame:
    """``n`` cells without replacement, the same for a seed whatever the partitions."""
    return cells.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)


def sampling_plan(libraries: DataFrame, depths: list[int]) -> DataFrame:
    """(library, depth, rate) of (library, reads, cells): the rate that gives a library
    each depth of reads per cell; depths that it doesn't reach are left out."""
    each = libraries.select("library", F.explode(F.array(*[F.lit(x) for x in depths])).alias("depth"), F.try_divide("reads", "cells").alias("_have"))
    return each.where(F.col("depth") <= F.col("_have")).select("library", "depth", (F.col("depth") / F.col("_have")).alias("rate"))


# --- barcodes as read


def whitelist_share(barcodes: DataFrame, whitelist: DataFrame) -> DataFrame:
    """(reads, on_list, share) of (barcode, n)."""
    known = whitelist.select("barcode", F.lit(True).alias("_known"))
    return barcodes.join(known, "barcode", "left").agg(F.sum("n").alias("reads"), F.sum(F.when(F.col("_known"), F.col("n")).otherwise(0)).alias("on_list")).withColumn("share", F.try_divide("on_list", "reads"))


def reads_reversed(barcodes: DataFrame, whitelist: DataFrame, reverse_complement, threshold: float = 0.5) -> bool:
    """Whether barcodes of (barcode, n) are read from the other strand: by the share of
    hits that only the reverse complement has; without a hit, unless all hold an N."""
    ahead = whitelist_share(barcodes, whitelist).first()["on_list"] or 0
    back = whitelist_share(barcodes.withColumn("barcode", reverse_complement("barcode")), whitelist).first()["on_list"] or 0
    if ahead:
        return back >= threshold * (back + ahead)
    return bool(back) or barcodes.where(~F.contains("barcode", F.lit("N"))).limit(1).count() > 0


def barcode_quality(reads: DataFrame, corrected: DataFrame, whitelist: DataFrame) -> DataFrame:
    """(reads, exact, corrected, exact_share, corrected_share) of (barcode, n) and the
    pairs (barcode, corrected) that correction gave."""
    known = whitelist.select("barcode", F.lit(True).alias("_known"))
    mended = corrected.select("barcode", F.lit(True).alias("_mended"))
    n = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    exact = F.coalesce("_known", F.lit(False))
    out = reads.join(known, "barcode", "left").join(mended, "barcode", "left").agg(F.sum("n").alias("reads"), n(exact).alias("exact"), n(~exact & F.coalesce("_mended", F.lit(False))).alias("corrected"))
    return out.withColumns({"exact_share": F.try_divide("exact", "reads"), "corrected_share": F.try_divide("corrected", "reads")})
