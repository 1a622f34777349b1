"""Interval relations: joins, merges, set operations and nearest neighbours.

Intervals are half-open, (contig, start, end).  Joins meet on (contig, bin): the
interval side is repeated for the bins that it touches, so the join is an equality
join that Spark can shuffle, and split where a bin is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scan import following, running

BIN = 16384
#: Regions in a list of a bin, and regions whose lists are broadcast in an inner join; more are shuffled.
LISTED, BROADCAST = 64, 1_000_000


def _spread(df: DataFrame, start: Column, last: Column, bin_width: int) -> DataFrame:
    """A row for each bin from ``start`` to ``last``, both included."""
    return df.withColumn("_bin", F.explode(F.sequence(F.floor(start / bin_width), F.floor(F.greatest(last, start) / bin_width))))


def _laid(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly, their columns computed: a broadcast join that follows reads them
    for each pair, and would compute them for each pair and keep the split of the files."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _level(first: Column, last: Column) -> Column:
    """The size of bins, as a power of two, for a span: from a quarter of it to the whole;
    null if it holds no position."""
    return F.when(last >= first, (F.floor(F.log2(last - first + 1) / 2) * 2).cast("int"))


def _sized(spans: DataFrame, first: Column, last: Column) -> DataFrame:
    """``spans`` that hold a position, with the size of their bins."""
    held = spans.withColumns({"_first": first.cast("long"), "_last": last.cast("long")}).where("_last >= _first")
    return held.withColumn("_level", _level(F.col("_first"), F.col("_last")))


def _listed(spans: DataFrame, contig: str) -> DataFrame:
    """``spans`` (_level, _bin, _first, _last) of a bin in lists by their begin, of at most
    ``LISTED`` each, so that a full bin is several; a list lies from _low to _high."""
    cell = [contig, "_level", "_bin"]
    own = [c for c in spans.columns if c not in (*cell, "_first", "_last")]
    place = F.row_number().over(Window.partitionBy(*cell).orderBy("_first"))
    lists = spans.withColumn("_list", F.floor((place - 1) / LISTED)).groupBy(*cell, "_list")
    return lists.agg(F.min("_first").alias("_low"), F.max("_last").alias("_high"), F.collect_list(F.struct(*own)).alias("_spans")).drop("_list")


def _sizes(spans: DataFrame) -> Column:
    """The sizes of bins that there are, at most 32."""
    return spans.agg(F.collect_set("_level")).scalar()


def _holding(spans: DataFrame) -> DataFrame:
    """Sized ``spans`` in the bins that they touch, five at most."""
    return spans.withColumn("_bin", F.expr("explode(sequence(shiftright(_first, _level), shiftright(_last, _level)))"))


def _met(asked: DataFrame, spans: DataFrame, regions: DataFrame, rule: Column, out: list[str]) -> DataFrame:
    """Columns ``out`` of the pairs that keep ``rule``, of rows that ask in a bin (_asked, _cell)
    from _from to _to and of the spans (r_contig) of ``regions`` there.  A row finds lists and
    goes through them in place, so a pair that isn't reported costs a comparison, no look-up."""
    met = (F.col("contig") == F.col("r_contig")) & (F.col("_asked") == F.col("_level")) & (F.col("_cell") == F.col("_bin"))
    lists = _listed(spans, "r_contig")
    # Spark's estimate would rather sort all that is asked than send a hundred megabytes of lists.
    lists = F.broadcast(lists) if regions.count() <= BROADCAST else lists
    near = asked.join(lists, met & (F.col("_from") <= F.col("_high")) & (F.col("_to") >= F.col("_low")))
    return near.select(*asked.columns, F.inline("_spans")).where(rule).select(*out)


def point_join(points: DataFrame, regions: DataFrame, pos: str = "pos", how: str = "inner", bin_width: int | None = None) -> DataFrame:
    """Points with the regions that contain them (start <= pos < end).

    ``how``: inner, left_semi or left_anti.  With regions that overlap each other a
    point meets all that contain it.  Without ``bin_width``, bins of an inner join fit the
    regions, which are read twice for it; regions that lie apart don't need that."""
    if how == "inner" and bin_width is None:
        r = _sized(regions.withColumnsRenamed({c: f"r_{c}" for c in regions.columns}), F.col("r_start"), F.col("r_end") - 1)
        # A point asks once for each size of bins.
        at, rule = F.col(pos).cast("long"), (F.col(pos) >= F.col("r_start")) & (F.col(pos) < F.col("r_end"))
        asked = _laid(points).withColumns({"_from": at, "_to": at}).withColumn("_asked", F.explode(_sizes(r))).withColumn("_cell", F.expr("shiftright(_from, _asked)"))
        return _met(asked, _holding(r), regions, rule, [*points.columns, *[f"r_{c}" for c in regions.columns if c != "contig"]])
    bin_width = bin_width or BIN
    r = _spread(regions.withColumnsRenamed({c: f"r_{c}" for c in regions.columns}), F.col("r_start"), F.col("r_end") - 1, bin_width).withColumnRenamed("_bin", "r_bin")
    p = points.withColumn("_bin", F.floor(F.col(pos) / bin_width))
    met = (F.col("contig") == F.col("r_contig")) & (F.col("_bin") == F.col("r_bin")) & (F.col(pos) >= F.col("r_start")) & (F.col(pos) < F.col("r_end"))
    return p.join(r, met, how).drop("_bin", "r_bin", "r_contig")


def overlap_join(left: DataFrame, right: DataFrame, how: str = "inner", touching: bool = True, end: str = "stop", bin_width: int | None = None) -> DataFrame:
    """Rows of ``left`` (contig, start, ``end``) with the regions that they overlap.

    ``touching``: a region that ends where the row starts counts too.  Semi and anti
    joins answer whether any region overlaps.  Without ``bin_width``, bins of an inner join
    fit both sides, which are read twice for it; regions that lie apart don't need that."""
    if how == "inner" and bin_width is None:
        # Either the row starts inside the region, or the region inside the row.  For the first
        # a row asks once for each size of the regions' bins, for the second in the bins that
        # it touches itself, of sizes below zero there; a region is in all sizes of these.
        r = right.withColumnsRenamed({c: f"r_{c}" for c in right.columns})
        inside = _sized(r, F.col("r_start"), F.col("r_end") if touching else F.col("r_end") - 1)
        around = (F.col("start") + 1, F.col(end) - 1)
        at = F.col("r_start").cast("long")
        begins = r.withColumns({"_first": at, "_last": at}).withColumn("_size", F.explode(_sizes(_sized(left, *around))))
        begins = begins.select(*r.columns, "_first", "_last", F.expr("-1 - _size").alias("_level"), F.expr("shiftright(_first, _size)").alias("_bin"))
        asked = _laid(left).withColumns({"_few": _sizes(inside), "_start": F.col("start").cast("long"), "_last": F.col(end).cast("long") - 1})
        asked = asked.withColumn("_own", _level(F.col("_start") + 1, F.col("_last")))
        asked = asked.withColumn("_n", F.expr("size(_few) + coalesce(cast(shiftright(_last, _own) - shiftright(_start + 1, _own) as int) + 1, 0)"))
        # An inner explode, or a filter, would go below the exchange and compute all that again.
        asked = asked.withColumn("_k", F.expr("explode_outer(if(_n > 0, sequence(0, _n - 1), null))")).withColumn("_first", F.expr("_k < size(_few)"))
        asked = asked.select(
            *left.columns,
            F.expr("if(_first, get(_few, _k), -1 - _own)").alias("_asked"),
            F.expr("if(_first, shiftright(_start, get(_few, _k)), shiftright(_start + 1, _own) + _k - size(_few))").alias("_cell"),
            F.expr("if(_first, _start, _start + 1)").alias("_from"),
            F.expr("if(_first, _start, _last)").alias("_to"),
        )
        near = (F.col("r_end") >= F.col("start")) if touching else (F.col("r_end") > F.col("start"))
        rule = near & (F.col("r_start") < F.col(end)) & ((F.col("_asked") >= 0) == (F.col("r_start") <= F.col("start")))
        return _met(asked, _holding(inside).unionByName(begins), right, rule, [*left.columns, *[f"r_{c}" for c in right.columns if c != "contig"]])
    bin_width = bin_width or BIN
    r = _spread(right.withColumnsRenamed({c: f"r_{c}" for c in right.columns}), F.col("r_start"), F.col("r_end"), bin_width).withColumnRenamed("_bin", "r_bin")
    near = (F.col("r_end") >= F.col("start")) if touching else (F.col("r_end") > F.col("start"))
    met = (F.col("contig") == F.col("r_contig")) & near & (F.col("r_start") < F.col(end))
    if how == "inner":
        # A pair shares several bins; it counts in the first that both touch.
        first = F.greatest(F.floor(F.col("start") / bin_width), F.floor(F.col("r_start") / bin_width))
        rows = _spread(left, F.col("start"), F.col(end) - 1, bin_width)
        return rows.join(r, met & (F.col("_bin") == F.col("r_bin")) & (F.col("_bin") == first), "inner").drop("_bin", "r_bin", "r_contig")
    one = F.floor(F.col("start") / bin_width) == F.floor((F.col(end) - 1) / bin_width)
    # Rows inside one bin need nothing more.  The few others are told apart by all their
    # columns, equal ones counted, so no number of theirs depends on the order of reading.
    if how not in ("left_semi", "left_anti"):
        raise ValueError(f"no such join: {how}")
    narrow = left.where(one).withColumn("_bin", F.floor(F.col("start") / bin_width)).join(r, met & (F.col("_bin") == F.col("r_bin")), how).drop("_bin")
    wide = left.where(~one).groupBy(*left.columns).agg(F.count("*").alias("_copies"))
    bins = _spread(wide, F.col("start"), F.col(end) - 1, bin_width).join(r, met & (F.col("_bin") == F.col("r_bin")), how)
    if how == "left_semi":
        found = bins.drop("_bin").distinct()
    else:
        # A row is clear if it is in all the bins that it touches.
        whole = F.floor((F.col(end) - 1) / bin_width) - F.floor(F.col("start") / bin_width) + 1
        found = bins.groupBy(*left.columns, "_copies").agg(F.count("*").alias("_n")).where(F.col("_n") == whole).drop("_n")
    return narrow.unionByName(found.withColumn("_copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*left.columns))


def merge(df: DataFrame, gap: int = 0, closed: bool = True, key: list[str] | None = None, end: str = "end") -> DataFrame:
    """Intervals united where they overlap or lie within ``gap``.

    ``closed``: also where one begins just ``gap`` after another's end."""
    key = key or ["contig"]
    seen = running(df.select(*key, "start", F.col(end).alias("end")), key, "start", F.col("end"), "_last", "max", before=True, then=["end"])
    fresh = F.col("_last").isNull() | ((F.col("start") - gap > F.col("_last")) if closed else (F.col("start") - gap >= F.col("_last")))
    # Of equal intervals the fresh one comes first, or the others would count with the island before.
    islands = running(seen.withColumn("_new", fresh.cast("int")), key, "start", F.col("_new"), "_island", "sum", then=["end", F.desc("_new")])
    return islands.groupBy(*key, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def depth(df: DataFrame, value: Column | None = None, key: list[str] | None = None) -> DataFrame:
    """(key, pos, next_pos, depth): how many intervals cover each run of positions.

    A step function; no row per position is ever made."""
    key = key or ["contig"]
    v = F.lit(1) if value is None else value
    steps = df.select(*key, F.explode(F.array(F.struct(F.col("start").alias("pos"), v.alias("d")), F.struct(F.col("end").alias("pos"), (-v).alias("d")))).alias("e"))
    steps = steps.groupBy(*key, F.col("e.pos").alias("pos")).agg(F.sum("e.d").alias("d")).where("d <> 0")
    risen = running(steps, key, "pos", F.col("d"), "depth", "sum")
    return following(risen, key, "pos", "next_pos").where("next_pos is not null").select(*key, "pos", "next_pos", F.col("depth").cast("long").alias("depth"))


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Positions in both sets, as merged intervals."""
    return _combine(a, b, "a > 0 and b > 0")


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    """Positions of ``a`` outside ``b``, as merged intervals."""
    return _combine(a, b, "a > 0 and b = 0")


def _combine(a: DataFrame, b: DataFrame, rule: str) -> DataFrame:
    # Both depths run in one pass: b weighs so much that the digits don't mix.
    big = 1 << 40
    both = a.select("contig", "start", "end", F.lit(1).cast("long").alias("w")).unionByName(b.select("contig", "start", "end", F.lit(big).alias("w")))
    d = depth(both, F.col("w")).select("contig", F.col("pos").alias("start"), F.col("next_pos").alias("end"), F.expr(f"depth % {big}").alias("a"), F.expr(f"depth div {big}").alias("b"))
    return merge(d.where(rule))


def nearest_distance(points: DataFrame, targets: DataFrame, pos: str = "pos", target: str = "start") -> DataFrame:
    """``points`` with ``distance`` to the nearest target on its contig (null if none)."""
    cols = points.columns
    rows = points.select(F.lit(None).cast("long").alias("_t"), F.col(pos).alias("_p"), "contig", F.struct(*cols).alias("_row"))
    marks = targets.select(F.col(target).cast("long").alias("_t"), F.col(target).cast("long").alias("_p"), "contig").distinct().withColumn("_row", F.lit(None).cast(rows.schema["_row"].dataType))
    both = rows.unionByName(marks)
    # A target at the same place comes first from either side.
    tie = [F.col("_t").asc_nulls_last()]
    both = running(both, ["contig"], "_p", F.col("_t"), "_low", "max", then=tie)
    both = running(both, ["contig"], "_p", F.col("_t"), "_high", "min", then=tie, down=True)
    found = both.where("_row is not null")
    return found.select("_row.*", F.least(F.col("_p") - F.col("_low"), F.col("_high") - F.col("_p")).alias("distance"))


def total_size(df: DataFrame) -> DataFrame:
    return df.agg(F.sum(F.col("end") - F.col("start")).alias("bases"))


def tiled(contigs: DataFrame, step: int, overlap: int = 0) -> DataFrame:
    """(contig, start, end): windows of (contig, length) every ``step`` bases, each going on
    for ``overlap`` bases into the next, the last cut at the contig's end."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length").cast("long") - 1, F.lit(step).cast("long"))).alias("start")
    return contigs.where("length > 0").select("contig", "length", starts).select("contig", "start", F.least(F.col("start") + step + overlap, F.col("length").cast("long")).alias("end"))
