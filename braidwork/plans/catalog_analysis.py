"""Named queries: neighbours across sets, batch correction, motifs, complexity and cell calls."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import batches, cellcalling, complexity, motifs, neighbours
from .catalog import _SEQ, _seqs, frag, query, rounded, table
from .fixtures import cte

_E = "e as (select vec_id, embedding::double[] as v from embeddings)"


# --- neighbours and batches


@query(f"""with {_E}, p as (select a.vec_id as src, b.vec_id as dst, list_distance(a.v, b.v) as dist from e a, e b where a.vec_id % 3 = 0 and b.vec_id % 3 <> 0)
select src, dst, round(dist, 4) as distance from p qualify row_number() over (partition by src order by dist, dst) <= 4""")
def neighbours_across(spark, d):
    e = table(spark, d, "embeddings")
    return rounded(neighbours.nearest_across(e.where("vec_id % 3 = 0"), e.where("vec_id % 3 <> 0"), "vec_id", "embedding", 4), "distance", digits=4)


#: The odd vectors lie 0.05 further in each direction; the even ones are at least as many.
_B = "b as (select vec_id, vec_id % 2 as batch, case when vec_id % 2 = 1 then list_transform(embedding::double[], lambda x: x + 0.05) else embedding::double[] end as v from embeddings)"
_MUTUAL = f"""{_B}, o as (select batch from b group by 1 order by count(*) desc, batch), cur as (select * from b where batch = (select batch from o offset 1 limit 1)), ref as (select * from b where batch = (select batch from o limit 1)),
x as (select c.vec_id as a, r.vec_id as b, list_distance(c.v, r.v) as dist from cur c, ref r),
m as (select a, b from (select a, b, row_number() over (partition by a order by dist, b) as i, row_number() over (partition by b order by dist, a) as j from x) where i <= 20 and j <= 20)"""


def shifted_batches(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), (F.col("vec_id") % 2).alias("batch"))
    return e.withColumn("v", F.when(F.col("batch") == 1, F.transform("v", lambda x: x + 0.05)).otherwise(F.col("v")))


@query(f"with {_MUTUAL} select a, b from m")
def mutual_pairs(spark, d):
    b = shifted_batches(spark, d)
    first = b.groupBy("batch").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "batch").first()["batch"]
    return batches.mutual_pairs(b.where(F.col("batch") != first), b.where(F.col("batch") == first), "vec_id", "v", 20)


@query(f"""with {_MUTUAL}, w as (select c.vec_id, m.a, m.b, exp(-0.5 * list_sum(list_transform(list_zip(c.v, p.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) as w from cur c, m join cur p on p.vec_id = m.a),
d as (select a, b, generate_subscripts(p.v, 1) as i, unnest(r.v) - unnest(p.v) as x from m join cur p on p.vec_id = a join ref r on r.vec_id = b),
s as (select vec_id, i, sum(w * x) / sum(w) as x from w join d using (a, b) group by 1, 2), n as (select vec_id, list(x order by i) as s from s group by 1)
select vec_id, batch, round(list_sum(case when s is null then v else list_transform(list_zip(v, s), lambda z: z[1] + z[2]) end), 4) as total from b left join n using (vec_id)""")
def corrected_batches(spark, d):
    moved = batches.correct_batches(shifted_batches(spark, d), "vec_id", "v", "batch")
    return rounded(moved.select("vec_id", "batch", F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("total")), "total", digits=4)


# --- motifs


_CLASSES = f"""q as ({_SEQ.format(s='varchar')}), g as (select id, seq, len(regexp_replace(seq, '[^GC]', '', 'g')) / len(seq) as gc from q),
c as (select list_sort(list_distinct(list_filter(quantile_cont(gc, [k / 25 for k in range(1, 25)]), lambda x: x >= 0.33 and x < 0.7))) as cuts from g),
b as (select id, seq, gc, len(list_filter(cuts, lambda x: x <= gc))::int as gc_bin from g, c)"""


@query(f"""with {_CLASSES}, n as (select gc_bin, count(*) as peaks, sum(len(regexp_replace(seq, '[^AT]', '', 'g'))) as n_at, sum(len(regexp_replace(seq, '[^CG]', '', 'g'))) as n_cg from b group by 1)
select gc_bin, peaks, round((n_at / 2 + 1) / (n_at + n_cg + 4), 8) as "at", round((n_cg / 2 + 1) / (n_at + n_cg + 4), 8) as cg from n""")
def motif_backgrounds(spark, d):
    return rounded(motifs.backgrounds(motifs.binned(_seqs(spark, d))), "at", "cg", digits=8)


#: Base counts of two motifs.
MOTIFS = {"m1": np.array([[8, 0, 0, 1, 8], [0, 9, 1, 7, 0], [1, 0, 8, 1, 1], [0, 0, 0, 0, 0]]), "m2": np.array([[0, 9, 0, 0], [1, 0, 9, 0], [9, 0, 0, 1], [0, 1, 1, 9]])}


@query()
def motif_hits(spark, d):
    return rounded(motifs.scan(motifs.binned(_seqs(spark, d)), MOTIFS, 5e-3), "score")


@query()
def motif_deviations(spark, d):
    """Motifs by barcodes from parts' sequences and the counts of parts."""
    from .fixtures import derived

    found = motifs.motif_counts(_seqs(spark, d), derived(spark, d, "coo"), MOTIFS, 5e-3)
    return rounded(found["deviations"], "z", digits=5)


# --- complexity


_RATES = "r as (select unnest(list_append([1e-5 + k * (0.99 - 1e-5) / 99 for k in range(100)], 1.0))::double as rate)"
_CURVES = f"{cte('frag')}, {_RATES}, h as (select contig, barcode, dup, count(*) as n from frag group by 1, 2, 3), c as (select contig, barcode, rate, rate * sum(n * dup) as total, sum(n * (1 - pow(1 - rate, dup))) as u from h, r group by 1, 2, 3)"


@query(f"""with {_CURVES} select contig, round(rate, 6) as rate, round(avg(total), 4) as mean_total, round(median(total), 4) as median_total, round(median(u), 4) as "unique" from c group by contig, rate""")
def complexity_curves(spark, d):
    per = complexity.curves(frag(spark, d), ["contig", "barcode"])
    return rounded(complexity.typical(per, ["contig"]), "mean_total", "median_total", "unique", digits=4).withColumn("rate", F.round("rate", 6))


@query(f"""with {_CURVES}, s as (select contig, barcode, total as t0, u as u0, lead(total) over w as t1, lead(u) over w as u1, lag(total) over w is null as first, lead(total, 2) over w is null as last from c window w as (partition by contig, barcode order by total)),
d as (select unnest([5, 20, 60]::double[]) as depth)
select contig, barcode, depth, round((depth - t0) / (t1 - t0) * (u1 - u0) + u0, 4) as "unique" from s, d where t1 is not null and (first or depth >= t0) and (depth < t1 or (last and depth <= t1))""")
def fragments_at_depths(spark, d):
    per = complexity.curves(frag(spark, d), ["contig", "barcode"])
    return rounded(complexity.at_depths(per, ["contig", "barcode"], (5.0, 20.0, 60.0)), "unique", digits=4)


# --- cell calls


@query()
def fitted_cells(spark, d):
    """Cells by the fitted mixture: orders by customer stand for fragments by barcode."""
    o = table(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 2).cast("string").alias("species"), F.col("l_partkey").cast("string").alias("barcode")).agg(F.count("*").alias("n"))
    total = o.agg(F.sum("n")).first()[0] or 0
    return cellcalling.call(o, total)[0]
