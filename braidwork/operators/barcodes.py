"""Barcodes: whitelist histograms, error correction, exclusions and multiplets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequence as seq


def whitelist_histogram(reads: DataFrame, whitelist: DataFrame) -> DataFrame:
    """(barcode, n): reads of each listed barcode, none included; unlisted ones under null."""
    counts = reads.groupBy(F.col("barcode").alias("_b")).agg(F.count("*").alias("n"))
    listed = whitelist.select("barcode").distinct()
    known = listed.join(counts, F.col("barcode") == F.col("_b"), "left").select("barcode", F.coalesce("n", F.lit(0)).alias("n"))
    other = counts.join(listed, F.col("_b") == F.col("barcode"), "left_anti").agg(F.lit(None).cast("string").alias("barcode"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return known.unionByName(other)


#: Bits of a change in a number that tells all changes of a sequence: 13 of the place, 7 of the letter.
BITS, MOST = 20, 3


def _change(at: Column, letter: Column) -> Column:
    return at.cast("long") * 128 + F.ascii(letter)


def _at(code: Column, k: int) -> Column:
    """The place of the k-th last change of ``code``, 0 if there are fewer."""
    return F.shiftright(code, BITS * k + 7).bitwiseAND(F.lit((1 << (BITS - 7)) - 1)).cast("int")


def changed(seq_: Column, code: Column) -> Column:
    """The sequence with the changes of ``code`` made."""
    out = seq_
    for k in range(MOST):
        letter = F.char(F.shiftright(code, BITS * k).bitwiseAND(F.lit(127)))
        out = F.when(_at(code, k) > 0, F.concat(F.substring(out, F.lit(1), _at(code, k) - 1), letter, F.substring(out, _at(code, k) + 1, F.length(out)))).otherwise(out)
    return out


def near(seqs: DataFrame, whitelist: DataFrame, most: int = 2) -> DataFrame:
    """(seq, cand, k, code, and what else the whitelist holds): listed barcodes at 1 to
    ``most`` substitutions of each distinct sequence; ``code`` tells the ``k`` changes.

    Both sides meet half way: the first changes are made to the sequence, the last to the
    listed barcode, so with two changes some 50 rows for each take the place of 1128 for a
    sequence.  The places of the first lie before the others, so a pair meets once."""
    if most > MOST:
        raise ValueError(f"at most {MOST} changes")
    # Few sequences and barcodes make many neighbours, so they are dealt out whatever their size.
    parts = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = seqs.select("seq").where("seq is not null").distinct().repartition(parts, "seq")
    usual = F.col("seq").rlike("^[ACGTN]+$")
    start = lambda df: df.select("seq", F.lit(0).alias("at"), F.lit(0).alias("k"), F.lit(0).cast("long").alias("code"), F.col("seq").alias("mid"))

    def forward(rows, times):
        out = None
        for _ in range(times):  # each change lies behind the one before, so no set of changes comes twice
            step = rows.select("seq", "k", "code", F.explode(seq.changes(F.col("mid"), F.col("at"))).alias("c"))
            rows = step.select("seq", F.col("c.at").alias("at"), (F.col("k") + 1).alias("k"), (F.col("code") * (1 << BITS) + _change(F.col("c.at"), F.substring("c.seq", F.col("c.at"), F.lit(1)))).alias("code"), F.col("c.seq").alias("mid"))
            out = rows if out is None else out.unionByName(rows)
        return out

    more = [c for c in whitelist.columns if c != "barcode"]
    listed = whitelist.select(F.col("barcode").alias("cand"), *more).repartition(parts, "cand")
    back = listed.select("cand", *more, F.lit(0).alias("from"), F.lit(0).alias("last"), F.lit(0).alias("j"), F.lit(0).cast("long").alias("tail"), F.col("cand").alias("mid"))
    ends = back
    for _ in range(most // 2):
        step = back.select("cand", *more, "from", "j", "tail", F.col("mid").alias("was"), F.explode(seq.changes(F.col("mid"), F.col("last"), "ACGTN")).alias("c"))
        old = F.substring("was", F.col("c.at"), F.lit(1))
        step = step.where(old.isin(*"ACGT"))
        back = step.select("cand", *more, F.when(F.col("j") == 0, F.col("c.at")).otherwise(F.col("from")).alias("from"), F.col("c.at").alias("last"), (F.col("j") + 1).alias("j"), (F.col("tail") * (1 << BITS) + _change(F.col("c.at"), old)).alias("tail"), F.col("c.seq").alias("mid"))
        ends = ends.unionByName(back)
    met = forward(start(one.where(usual)), -(-most // 2)).join(ends, "mid").where("(k = j or k = j + 1) and (j = 0 or at < `from`)")
    moved = F.col("code") * F.element_at(F.array(*[F.lit(1 << BITS * j).cast("long") for j in range(most // 2 + 1)]), F.col("j") + 1) + F.col("tail")
    met = met.where(F.col("k") + F.col("j") <= most).select("seq", "cand", (F.col("k") + F.col("j")).alias("k"), moved.alias("code"), *more)
    # Letters beyond these can't be guessed from the listed side; their sequences make all changes.
    odd = forward(start(one.where(~usual)), most).join(listed, F.col("mid") == F.col("cand")).select("seq", "cand", "k", "code", *more)
    return met.unionByName(odd)


def correct(reads: DataFrame, whitelist: DataFrame, threshold: float = 0.975, most: int = 2) -> DataFrame:
    """``reads`` (id, seq, qual) with ``barcode``, null where no listed one is likely enough.

    A listed sequence whose qualities all exceed 24 stands.  Else the listed ones at
    up to ``most`` changes compete: each weighs its prior times the chance of the
    changes, qualities held between 3 and 40.  A sequence that differs by unread bases
    alone has no candidate."""
    listed = whitelist.select(F.col("barcode").alias("seq"), "prior")
    sure = F.forall(seq.qualities(F.col("qual")), lambda q: q > 24)
    none = F.lit(0).cast("long").alias("code")
    own = reads.join(listed, "seq").select("id", none, F.col("prior").cast("double").alias("w"), sure.alias("sure"))
    doubtful = reads.join(own.where("sure").select("id"), "id", "left_anti")
    found = near(doubtful, whitelist.select("barcode", "prior"), most).where(F.col("k") > F.regexp_count("seq", F.lit("N"))).select("seq", "code", "prior")
    found = found.repartition(int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions")), "seq")
    held = F.transform(seq.qualities(F.col("qual")), lambda q: F.greatest(F.least(q, F.lit(40)), F.lit(3)))
    pairs = doubtful.select("id", "seq", held.alias("_held")).join(found, "seq")
    lost = sum((F.coalesce(F.get("_held", _at(F.col("code"), k) - 1), F.lit(0)) for k in range(most)), F.lit(0))
    others = pairs.select("id", "code", (F.col("prior") * F.pow(F.lit(10.0), -lost / 10)).alias("w"))
    every = own.where("not sure").select("id", "code", "w").unionByName(others)
    if threshold >= 0.5:  # what holds more than half has no tie, so numbers do
        best = every.groupBy("id").agg(F.max_by("code", "w").alias("code"), (F.max("w") / F.sum("w")).alias("p"))
    else:
        named = every.join(reads.select("id", "seq"), "id").withColumn("cand", changed(F.col("seq"), F.col("code")))
        best = named.groupBy("id").agg(F.max_by("code", F.struct("w", "cand")).alias("code"), (F.max("w") / F.sum("w")).alias("p"))
    stands = best.where(F.col("p") > threshold).select("id", "code").unionByName(own.where("sure").select("id", "code"))
    return reads.join(stands, "id", "left").withColumn("barcode", F.when(F.col("code").isNotNull(), changed(F.col("seq"), F.col("code")))).drop("code")


def correct_umis(counts: DataFrame, key: list[str]) -> DataFrame:
    """(key, umi, n, corrected): each tag moves to its best neighbour at one change, if that has more reads
    (or as many and a smaller name); others stay."""
    cand = counts.select(*key, "umi", "n", F.explode(seq.neighbours(F.col("umi"))).alias("to"))
    there = counts.select(*key, F.col("umi").alias("to"), F.col("n").alias("m"))
    better = cand.join(there, [*key, "to"]).where("m > n or (m = n and to < umi)")
    best = better.groupBy(*key, "umi").agg(F.min_by("to", F.struct((-F.col("m")).alias("m"), "to")).alias("best"))
    return counts.join(best, [*key, "umi"], "left").select(*key, "umi", "n", F.coalesce("best", "umi").alias("corrected"))


def low_targeting(counts: DataFrame, share: float) -> DataFrame:
    """Barcodes whose targeted share is below that of the padded targets in the genome."""
    return counts.where(F.col("targeted") / F.col("n") < share)


def linkage(fragments: DataFrame, a: Column, c: Column, b: Column) -> DataFrame:
    """(minor, major, n): fragment ends of one barcode that meet starts of another, its own kind included,
    for barcodes that share part c and part a or part b."""
    ends = fragments.groupBy("contig", F.col("stop").alias("at"), F.col("barcode").alias("major")).agg(F.count("*").alias("x"))
    starts = fragments.groupBy("contig", F.col("start").alias("at"), F.col("barcode").alias("minor")).agg(F.count("*").alias("y"))
    p = fragments.select("barcode").distinct().select("barcode", a.alias("a"), c.alias("c"), b.alias("b"))
    one = ends.join(p.select(F.col("barcode").alias("major"), F.col("a").alias("a1"), F.col("c"), F.col("b").alias("b1")), "major")
    two = starts.join(p.select(F.col("barcode").alias("minor"), F.col("a").alias("a2"), F.col("c"), F.col("b").alias("b2")), "minor")
    met = one.join(two, ["contig", "at", "c"]).where("a1 = a2 or b1 = b2")
    return met.groupBy("minor", "major").agg(F.sum(F.col("x") * F.col("y")).alias("n"))


def multiplets(links: DataFrame, counts: DataFrame, least: int = 100, factor: float = 0.4) -> DataFrame:
    """(minor, major): barcodes whose links to another exceed ``factor`` times those to themselves.

    The strongest major counts, the smaller name on ties; of two that name each other
    the larger barcode stays; a major that is a minor itself hands over its own major."""
    own = links.where("minor = major").select("minor", F.col("n").alias("own"))
    big = counts.where(F.col("n") >= least).select(F.col("barcode").alias("major"))
    hit = links.where("minor <> major").join(big, "major", "left_semi").join(own, "minor", "left").where(F.col("n") > factor * F.coalesce("own", F.lit(0)))
    best = hit.groupBy("minor").agg(F.min_by("major", F.struct((-F.col("n")).alias("n"), "major")).alias("major"))
    size = counts.select("barcode", "n")
    back = best.select(F.col("minor").alias("major"), F.col("major").alias("minor"), F.lit(1).alias("mutual"))
    j = best.join(back, ["minor", "major"], "left").join(size.select(F.col("barcode").alias("minor"), F.col("n").alias("n_minor")), "minor", "left").join(size.select(F.col("barcode").alias("major"), F.col("n").alias("n_major")), "major", "left")
    keep = F.col("mutual").isNull() | (F.col("n_minor") < F.col("n_major")) | ((F.col("n_minor") == F.col("n_major")) & (F.col("minor") > F.col("major")))
    one_way = j.where(keep).select("minor", "major")
    up = one_way.select(F.col("minor").alias("major"), F.col("major").alias("top"))
    return one_way.join(up, "major", "left").select("minor", F.coalesce("top", "major").alias("major"))


def lot_of(histogram: DataFrame, lots: DataFrame, width: int = 7, least_share: float = 0.95, least_reads: int = 1000) -> DataFrame:
    """(lot, share, reads, confident) of the lot that most barcodes' first bases name."""
    part = histogram.groupBy(F.substring("barcode", 1, width).alias("part")).agg(F.sum("n").alias("n"))
    per = part.join(lots, "part").groupBy("lot").agg(F.sum("n").alias("n"))
    top = per.agg(F.max_by("lot", F.struct("n", "lot")).alias("lot"), (F.max("n") / F.sum("n")).alias("share"), F.sum("n").alias("reads"))
    return top.withColumn("confident", (F.col("share") >= least_share) & (F.col("reads") >= least_reads))


def split_indices(reads: DataFrame, index: str, mass: float = 0.9, factor: float = 250, least: int = 20) -> DataFrame:
    """(index, n, common): sample indices told into common and rare.

    Common are those of at least ``least`` reads and at least the median of the ones
    that make up ``mass`` of the reads, divided by ``factor``."""
    h = reads.groupBy(index).agg(F.count("*").alias("n"))
    total = h.agg(F.sum("n").alias("t"))
    # running sums over distinct counts, of which there are few
    c = h.groupBy("n").agg((F.first("n") * F.count("*")).alias("s"), F.count("*").alias("k"))
    run = c.withColumn("ahead", F.sum("s").over(Window.orderBy(F.desc("n"))) - F.col("s"))
    top = run.join(F.broadcast(total)).where(F.col("ahead") < mass * F.col("t"))
    cut = top.agg(F.greatest(F.percentile("n", F.lit(0.5), F.col("k")) / factor, F.lit(float(least))).alias("cut"))
    return h.join(F.broadcast(cut)).select(index, "n", (F.col("n") >= F.col("cut")).alias("common"))
