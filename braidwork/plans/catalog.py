"""Named queries over the test tables, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sequence as seq
from ..functions import stats
from ..operators import fragments as fr
from ..operators import graph, intervals, matrix, models, reduce
from ..streaming import windows
from .fixtures import DEPTH_SQL, PEAKS_SQL, cte, derived

LENGTH = 1_000_000
_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def frag(spark, d):
    return derived(spark, d, "frag")


def peaks_of(spark, d):
    return fr.call_peaks(fr.windowed_depth(frag(spark, d)), 30)


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- scans, projections and filters


@query(f"with {cte('frag')} select contig, start, stop, barcode, dup from frag")
def fragment_scan(spark, d):
    return frag(spark, d)


@query(f"with {cte('frag')} select contig, start, stop, barcode, dup from frag where contig = 'chr2'")
def contig_scan(spark, d):
    return frag(spark, d).where("contig = 'chr2'")


@query(f"with {cte('frag')} select contig, start, count(*) as n, count(distinct barcode) as barcodes, min(stop) as first_stop, max(stop) as last_stop from frag group by 1, 2")
def grouped_starts(spark, d):
    return frag(spark, d).groupBy("contig", "start").agg(F.count("*").alias("n"), F.count_distinct("barcode").alias("barcodes"), F.min("stop").alias("first_stop"), F.max("stop").alias("last_stop"))


@query(f"""with {cte('reads')} select class, count(*) as n from (select case when least(mapq, mapq) <= 30 then 'lowmapq' when ref_id = 4 then 'mitochondrial'
  when abs(mate_pos - pos) > 2 then 'chimeric' when qname % 7 = 0 then 'duplicate' else 'passed_filters' end as class from reads) group by 1""")
def classify_fragments(spark, d):
    r = derived(spark, d, "reads")
    return fr.classify(r, F.col("mapq"), F.col("mapq"), F.col("ref_id") == 4, F.abs(F.col("mate_pos") - F.col("pos")) > 2, F.col("qname") % 7 == 0).groupBy("class").agg(F.count("*").alias("n"))


@query(f"with {cte('frag')} select contig, greatest(start + 4, 0) as start, least(stop - 5, {LENGTH}) as stop, barcode from frag where start + 4 < stop - 5")
def adjusted_fragments(spark, d):
    f = frag(spark, d).where("start + 4 < stop - 5")
    return f.select("contig", F.greatest(F.col("start") + 4, F.lit(0)).alias("start"), F.least(F.col("stop") - 5, F.lit(LENGTH)).alias("stop"), "barcode")


@query(f"with {cte('coo')} select feature_id, barcode_id, value from coo where barcode_id in (select distinct c_custkey % 211 from customer where c_mktsegment = 'BUILDING')")
def select_barcodes(spark, d):
    ids = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select((F.col("c_custkey") % 211).alias("barcode_id"))
    return matrix.select(derived(spark, d, "coo"), ids, "barcode_id")


@query(f"""with {cte('coo')}, b as (select barcode_id from coo group by 1 having sum(value) > 20), m as (select * from coo where barcode_id in (select * from b)),
f as (select feature_id from m group by 1 having sum(value) > 20) select feature_id, barcode_id, value from m where feature_id in (select * from f)""")
def above_threshold(spark, d):
    return matrix.above_threshold(derived(spark, d, "coo"), 20)


@query(f"with {cte('coo')} select barcode_id, sum(case when feature_id % 3 = 0 then value else 0 end)::bigint as masked, count(case when value >= 2 and feature_id % 3 = 0 then 1 end) as at_least_two from coo group by 1")
def masked_sums(spark, d):
    m = derived(spark, d, "coo")
    return m.groupBy("barcode_id").agg(F.sum(F.when(F.col("feature_id") % 3 == 0, F.col("value")).otherwise(0)).alias("masked"), F.count_if((F.col("value") >= 2) & (F.col("feature_id") % 3 == 0)).alias("at_least_two"))


@query(f"with {cte('coo')} select feature_id, barcode_id, value from coo where barcode_id in (select barcode_id from coo where value > 1 group by 1)")
def prune_barcodes(spark, d):
    m = derived(spark, d, "coo")
    return matrix.select(m, m.where("value > 1"), "barcode_id")


# --- interval joins

_OVER = "exists (select 1 from track t where t.contig = f.contig and t.\"end\" >= f.start and t.start < f.stop)"


@query(f"with {cte('frag', 'track')} select contig, start, stop, barcode, dup from frag f where {_OVER}")
def overlap_semi(spark, d):
    return intervals.overlap_join(frag(spark, d), derived(spark, d, "track"), "left_semi")


@query(f"with {cte('frag', 'track')} select contig, start, stop, barcode, dup from frag f where not {_OVER}")
def overlap_anti(spark, d):
    return intervals.overlap_join(frag(spark, d), derived(spark, d, "track"), "left_anti")


@query(f"""with {cte('frag', 'track')} select f.contig, f.start, f.stop, f.barcode, t.start as r_start, t."end" as r_end, t.track as r_track
from frag f join track t on t.contig = f.contig and t."end" >= f.start and t.start < f.stop""")
def overlap_inner(spark, d):
    return intervals.overlap_join(frag(spark, d).drop("dup"), derived(spark, d, "track"))


@query(f"""with {cte('frag', 'track')} select f.contig, f.start as pos, f.barcode, t.start as r_start, t."end" as r_end, t.track as r_track
from frag f join track t on t.contig = f.contig and f.start >= t.start and f.start < t."end" """)
def point_join(spark, d):
    return intervals.point_join(frag(spark, d).select("contig", F.col("start").alias("pos"), "barcode"), derived(spark, d, "track"))


@query(f"""with {cte('frag', 'tss')}, b as (select f.contig, f.start as pos, f.barcode, f.stop, (select max(t.start) from tss t where t.contig = f.contig and t.start <= f.start) as lo,
  (select min(t.start) from tss t where t.contig = f.contig and t.start >= f.start) as hi from frag f) select contig, pos, barcode, stop, least(pos - lo, hi - pos) as distance from b""")
def nearest_region(spark, d):
    f = frag(spark, d).select("contig", F.col("start").alias("pos"), "barcode", "stop")
    return intervals.nearest_distance(f, derived(spark, d, "tss"))


# --- coverage and peaks


@query(f"with {cte('frag')}, {DEPTH_SQL} select depth::bigint as depth, sum(next_pos - pos)::bigint as bases from steps where depth > 0 group by 1")
def depth_histogram(spark, d):
    return fr.depth_histogram(fr.windowed_depth(frag(spark, d)))


@query(f"with {cte('frag')}, {DEPTH_SQL} select contig, pos as start, next_pos as \"end\", depth::bigint as depth from steps where depth >= 10")
def coverage_bedgraph(spark, d):
    return fr.bedgraph(fr.windowed_depth(frag(spark, d)), 10)


@query(f"with {cte('frag')}, {DEPTH_SQL}, {PEAKS_SQL} select contig, start, \"end\" from peaks")
def call_peaks_fixed(spark, d):
    return peaks_of(spark, d)


@query(f"""with {cte('frag')}, {DEPTH_SQL}, {PEAKS_SQL}, cut as (select contig, barcode, unnest([start, stop]) as p from frag)
select barcode, k.contig, k.start, k."end", count(*) as n from cut c join peaks k on k.contig = c.contig and c.p >= k.start and c.p < k."end" group by all""")
def peak_matrix(spark, d):
    return fr.peak_matrix(frag(spark, d), peaks_of(spark, d))


@query(f"""with {cte('frag')}, {DEPTH_SQL}, {PEAKS_SQL}, cut as (select contig, barcode, unnest([start, stop]) as p from frag)
select barcode, sum(1)::bigint as total from cut c join peaks k on k.contig = c.contig and c.p >= k.start and c.p < k."end" group by 1 order by 2 desc, 1 limit 20""")
def top_peak_barcodes(spark, d):
    m = fr.peak_matrix(frag(spark, d), peaks_of(spark, d))
    return m.groupBy("barcode").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "barcode").limit(20)


@query(f"with {cte('frag')}, {DEPTH_SQL}, {PEAKS_SQL} select sum(least(\"end\", {LENGTH}) - start)::bigint as bases, count(*) as peaks from peaks")
def bases_in_peaks(spark, d):
    return peaks_of(spark, d).agg(F.sum(F.least("end", F.lit(LENGTH)) - F.col("start")).alias("bases"), F.count("*").alias("peaks"))


# --- counts per barcode


@query(f"with {cte('frag')} select barcode, count(*) as unique_fragments, sum(dup)::bigint as total_fragments from frag group by 1")
def barcode_counts(spark, d):
    return fr.barcode_counts(frag(spark, d))


@query(f"""with {cte('frag', 'track')} select barcode, count(*) as n, """ + ", ".join(f"count(case when {_OVER.replace('t.contig', f'''t.track = 'track{k}' and t.contig''')} then 1 end) as track{k}" for k in range(4)) + " from frag f group by 1")
def targeting_counts(spark, d):
    t = derived(spark, d, "track")
    return fr.targeting(frag(spark, d), {f"track{k}": t.where(f"track = 'track{k}'").drop("track") for k in range(4)})


@query(f"""with {cte('frag', 'track')}, b as (select barcode, count(*) as n, count(case when {_OVER} then 1 end) as k from frag f group by 1)
select round(sum(k) / sum(n), 6) as overall, round(avg(k / n), 6) as mean, round(median(k / n), 6) as median, round(min(k / n), 6) as least, round(stddev_pop(k / n), 6) as spread from b""")
def targeting_fractions(spark, d):
    b = fr.targeting(frag(spark, d), {"k": derived(spark, d, "track").drop("track")})
    x = F.col("k") / F.col("n")
    out = b.agg((F.sum("k") / F.sum("n")).alias("overall"), F.avg(x).alias("mean"), F.percentile(x, F.lit(0.5)).alias("median"), F.min(x).alias("least"), F.stddev_pop(x).alias("spread"))
    return rounded(out, *out.columns)


def _covered_sql(pad: int) -> str:
    return f"""with {cte('frag')}, p as (select contig, barcode, greatest(start - {pad}, 0) as s, least(stop + {pad}, {LENGTH}) as e from frag),
fl as (select *, case when s < max(e) over (partition by barcode, contig order by s, e rows between unbounded preceding and 1 preceding) then 0 else 1 end as f from p),
g as (select *, sum(f) over (partition by barcode, contig order by s, e rows unbounded preceding) as g from fl),
i as (select barcode, contig, g, max(e) - min(s) as n from g group by all) select barcode, sum(n)::bigint as covered from i group by 1"""


@query(_covered_sql(0))
def covered_bases_by_barcode(spark, d):
    return fr.covered_bases(frag(spark, d), 0, LENGTH)


@query(_covered_sql(1000))
def covered_bases_padded(spark, d):
    return fr.covered_bases(frag(spark, d), 1000, LENGTH)


@query(f"with {cte('frag')} select barcode, least(stop - start, 401) as size, count(*) as n from frag group by 1, 2")
def insert_size_hist(spark, d):
    return fr.insert_sizes(frag(spark, d), 400)


@query(f"with {cte('frag')} select barcode, round(count(case when stop - start < 147 then 1 end) / count(*), 6) as short, round(count(case when stop - start between 147 and 294 then 1 end) / count(*), 6) as mono from frag group by 1")
def insert_size_fractions(spark, d):
    size = F.col("stop") - F.col("start")
    return rounded(frag(spark, d).groupBy("barcode").agg((F.count_if(size < 147) / F.count("*")).alias("short"), (F.count_if(size.between(147, 294)) / F.count("*")).alias("mono")), "short", "mono")


@query(f"""with {cte('frag', 'tss')}, p as (select contig, unnest([start, stop]) as p from frag)
select case when strand = '-' then t.start - p else p - t.start end as "offset", count(*) as n from p join tss t on t.contig = p.contig and p >= greatest(t.start - 250, 0) and p <= t.start + 250 group by 1""")
def tss_profile(spark, d):
    return fr.relative_positions(fr.cut_sites(frag(spark, d)), derived(spark, d, "tss").select("contig", "start", "strand"), 250)


@query(f"with {cte('frag')} select barcode, dup, count(*) as n from frag group by grouping sets ((barcode, dup), (dup))")
def duplicate_histogram(spark, d):
    return fr.duplicate_histogram(frag(spark, d))


@query(f"""with {cte('frag')}, h as (select dup, count(*) as n from frag group by 1), r as (select unnest([0.1, 0.25, 0.5, 0.75, 1.0]::double[]) as rate)
select rate, round(rate * sum(n * dup), 4) as total, round(sum(n * (1 - pow(1 - rate, dup))), 4) as "distinct" from h, r group by 1""")
def downsample_curve(spark, d):
    h = frag(spark, d).groupBy("dup").agg(F.count("*").alias("n"))
    return rounded(fr.downsample_curve(h, [0.1, 0.25, 0.5, 0.75, 1.0]), "total", "distinct", digits=4)


@query(f"""with {cte('frag')}, e as (select contig, stop as place, barcode, count(*) as n from frag group by all), s as (select contig, start as place, barcode as other, count(*) as m from frag group by all)
select barcode, other, sum(n * m)::bigint as n from e join s using (contig, place) where barcode <> other group by 1, 2""")
def adjacency_links(spark, d):
    return fr.adjacency(frag(spark, d))


@query(f"""with {cte('frag')}, e as (select contig, stop as place, barcode, count(*) as n from frag group by all), s as (select contig, start as place, barcode as other, count(*) as m from frag group by all),
p as (select barcode, other, sum(n * m) as n from e join s using (contig, place) where barcode <> other group by 1, 2),
b as (select barcode, other from p qualify row_number() over (partition by barcode order by n desc, other) = 1)
select x.barcode, x.other from b x join b y on x.barcode = y.other and x.other = y.barcode where x.barcode < x.other""")
def mutual_partners(spark, d):
    return fr.mutual_partners(fr.adjacency(frag(spark, d)))


@query(f"""with {cte('reads')}, c as (select ref_id, pos, mate_ref_id, mate_pos, barcode, count(*) as n, min(qname) as q from reads group by all),
t as (select ref_id, pos, mate_ref_id, mate_pos, sum(n)::bigint as copies from c group by all)
select ref_id, pos, mate_ref_id, mate_pos, barcode, q as qname, copies from c join t using (ref_id, pos, mate_ref_id, mate_pos) qualify row_number() over (partition by ref_id, pos, mate_ref_id, mate_pos order by n desc, barcode) = 1""")
def dup_group_representative(spark, d):
    return fr.representatives(derived(spark, d, "reads"), ["ref_id", "pos", "mate_ref_id", "mate_pos"])


@query(f"""with {cte('frag')}, c as (select barcode, count(*) as n from frag group by 1) select barcode, n, row_number() over (order by n desc, barcode) as rank from c""")
def knee_ranks(spark, d):
    return fr.knee(frag(spark, d).groupBy("barcode").agg(F.count("*").alias("n")), "n").withColumn("rank", F.col("rank").cast("long"))


@query(f"""with {cte('frag')}, c as (select barcode, count(*) as n from frag group by 1), t as (select *, sum(n) over (order by n) as run, sum(n) over () as total from c) select max(n) as threshold from t where run <= 0.25 * total""")
def cumulative_threshold(spark, d):
    c = frag(spark, d).groupBy("barcode").agg(F.count("*").alias("n")).groupBy("n").agg((F.count("*") * F.first("n")).alias("s"))
    total = c.agg(F.sum("s").alias("total"))
    run = c.withColumn("run", F.sum("s").over(Window.orderBy("n"))).join(F.broadcast(total))
    return run.where("run <= 0.25 * total").agg(F.max("n").alias("threshold"))


@query("""select c_custkey as barcode, coalesce(n, 0) as n, coalesce(total, 0) as total, coalesce(s_name, 'None') as cell_id from customer
left join (select o_custkey, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1) o on o_custkey = c_custkey left join supplier on s_suppkey = c_custkey""")
def singlecell_merge(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("barcode")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("barcode"), F.col("s_name").alias("cell_id"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("barcode"))
    return c.join(o, "barcode", "left").join(s, "barcode", "left").fillna({"n": 0, "total": 0.0, "cell_id": "None"})


@query("""select nation as species, key as barcode, reason from (select c_nationkey as nation, c_custkey as key, 'balance' as reason, 0 as k from customer where c_acctbal < 0 union all
select c_nationkey, c_custkey, 'segment', 1 from customer where c_mktsegment = 'MACHINERY' union all select s_nationkey, s_suppkey, 'supplier', 2 from supplier) qualify row_number() over (partition by nation, key order by k) = 1""")
def merged_exclusions(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("species"), F.col("c_custkey").alias("barcode"), "c_acctbal", "c_mktsegment")
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("species"), F.col("s_suppkey").alias("barcode"))
    return fr.first_reason([("balance", c.where("c_acctbal < 0")), ("segment", c.where("c_mktsegment = 'MACHINERY'")), ("supplier", s)], ["species", "barcode"])


@query(f"""with {cte('frag')}, c as (select right(barcode, 1) as lib, barcode, contig, count(*) as n from frag group by all), m as (select contig as library_id, median(n) as med from c group by 1)
select library_id, round(med, 6) as med, round((select min(med) from m) / med, 6) as rate from m""")
def library_rates(spark, d):
    m = frag(spark, d).groupBy("barcode", F.col("contig").alias("library_id")).agg(F.count("*").alias("n")).groupBy("library_id").agg(F.percentile("n", F.lit(0.5)).alias("med"))
    least = m.agg(F.min("med").alias("least"))
    return rounded(m.join(F.broadcast(least)).select("library_id", "med", (F.col("least") / F.col("med")).alias("rate")), "med", "rate")


@query(f"with {cte('frag')} select contig, start, stop, barcode, dup from frag where (start * 7919 + stop * 104729) % 1000 < 250")
def subsample_fragments(spark, d):
    return frag(spark, d).where("(start * 7919 + stop * 104729) % 1000 < 250")


# --- set operations on intervals

_A = "a as (select contig, start as s, \"end\" as e from track where track in ('track0','track1')), b as (select contig, start as s, \"end\" as e from track where track in ('track2','track3'))"


def _sweep_sql(rule: str) -> str:
    return f"""with {cte('track')}, {_A},
ev as (select contig, unnest([s, e]) as pos, unnest([1, -1]) as da, unnest([0, 0]) as db from a union all select contig, unnest([s, e]), unnest([0, 0]), unnest([1, -1]) from b),
ag as (select contig, pos, sum(da) as da, sum(db) as db from ev group by 1, 2),
st as (select contig, pos as s, lead(pos) over w as e, sum(da) over w as a, sum(db) over w as b from ag window w as (partition by contig order by pos)),
k as (select contig, s, e from st where e is not null and {rule}),
fl as (select *, case when s <= max(e) over (partition by contig order by s rows between unbounded preceding and 1 preceding) then 0 else 1 end as f from k),
g as (select *, sum(f) over (partition by contig order by s rows unbounded preceding) as g from fl) select contig, min(s) as start, max(e) as "end" from g group by contig, g"""


def _sides(spark, d):
    t = derived(spark, d, "track")
    return t.where("track in ('track0','track1')").drop("track"), t.where("track in ('track2','track3')").drop("track")


@query(_sweep_sql("a > 0 or b > 0"))
def bed_merge(spark, d):
    a, b = _sides(spark, d)
    return intervals.merge(a.unionByName(b))


@query(_sweep_sql("a > 0 and b > 0"))
def bed_intersect(spark, d):
    return intervals.intersect(*_sides(spark, d))


@query(_sweep_sql("a > 0 and b = 0"))
def bed_subtract(spark, d):
    return intervals.subtract(*_sides(spark, d))


@query(f"with {cte('track')} select count(*) as n, sum(\"end\" - start)::bigint as bases from track")
def total_region_size(spark, d):
    t = derived(spark, d, "track")
    return t.agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("bases"))


@query(f"with {cte('frag')} select distinct contig, start, stop from frag")
def sort_unique_bed(spark, d):
    return frag(spark, d).select("contig", "start", "stop").distinct().orderBy("contig", "start", "stop")


@query(f"""with {cte('frag')}, c as (select contig, max(stop) as n from frag group by 1), w as (select contig, n, unnest(range(0, n, 100000)) as start from c)
select contig, start, least(start + 110000, n) as "end" from w""")
def tiling_windows(spark, d):
    lengths = frag(spark, d).groupBy("contig").agg(F.max("stop").alias("length"))
    return intervals.tiled(lengths, 100_000, 10_000)


# --- matrices


@query(f"with {cte('coo')} select feature_id, sum(value)::bigint as total, count(case when value > 0 then 1 end) as nonzero from coo group by 1")
def counts_per_feature(spark, d):
    return matrix.axis_summary(derived(spark, d, "coo"), "feature_id")


@query(f"with {cte('coo')} select barcode_id, sum(value)::bigint as total, count(case when value > 0 then 1 end) as nonzero from coo group by 1")
def counts_per_barcode(spark, d):
    return matrix.axis_summary(derived(spark, d, "coo"), "barcode_id")


@query(f"with {cte('coo')} select feature_id, round(sum(value) / 211, 6) as mean, round(sum(value * value) / 211 - (sum(value) / 211) * (sum(value) / 211), 6) as var from coo group by 1")
def feature_moments(spark, d):
    return rounded(matrix.moments(derived(spark, d, "coo"), "feature_id", 211), "mean", "var")


@query(f"with {cte('coo')}, s as (select barcode_id, sum(value)::bigint as total from coo group by 1) select barcode_id, total from s qualify rank() over (order by total desc) <= 25")
def top_barcodes_with_ties(spark, d):
    return matrix.top_with_ties(derived(spark, d, "coo"), 25)


@query(f"with {cte('coo')} select feature_id, barcode_id, sum(value)::bigint as value from (select * from coo union all select * from coo where feature_id % 2 = 0) group by 1, 2")
def merge_matrices(spark, d):
    m = derived(spark, d, "coo")
    return matrix.merge_add(m, m.where("feature_id % 2 = 0"))


@query(f"with {cte('coo')}, s as (select barcode_id, sum(value) as s from coo group by 1), k as (select greatest(median(s), 1) as med from s) select feature_id, barcode_id, round(value * (med / s), 6) as value from coo join s using (barcode_id), k")
def depth_normalise(spark, d):
    return rounded(matrix.depth_normalise(derived(spark, d, "coo")), "value")


@query(f"with {cte('coo')}, w as (select feature_id, ln(212.0::double) - ln(count(*) + 1.0::double) as w from coo group by 1) select feature_id, barcode_id, round(value * w, 6) as value from coo join w using (feature_id)")
def idf_matrix(spark, d):
    return rounded(matrix.idf(derived(spark, d, "coo"), 211), "value")


_HITS = "hits as (select p_partkey as feature_id, p_size % 10 as motif, 1 as weight from part)"


@query(f"with {cte('coo')}, {_HITS} select motif, barcode_id, sum(weight * value)::bigint as value from hits join coo using (feature_id) group by 1, 2")
def tf_matmul(spark, d):
    hits = table(spark, d, "part").select(F.col("p_partkey").alias("feature_id"), (F.col("p_size") % 10).alias("motif"), F.lit(1).alias("weight"))
    return matrix.matmul(hits, derived(spark, d, "coo"), "motif")


@query(f"with {cte('coo')}, n as (select barcode_id, sqrt(sum(value * value)) as n from coo group by 1) select feature_id, barcode_id, round(value / n, 6) as value from coo join n using (barcode_id)")
def l2_normalise(spark, d):
    return rounded(matrix.l2_normalise(derived(spark, d, "coo")), "value")


@query(f"""with {cte('coo')}, {_HITS}, t as (select motif, barcode_id, sum(weight * value) as value from hits join coo using (feature_id) group by 1, 2),
m as (select motif, median(value) as med from t group by 1), v as (select t.*, med, abs(value - med) as dev from t join m using (motif)), q as (select motif, median(dev) as mad from v group by 1)
select motif, barcode_id, case when mad <> 0 then round((value - med) * 0.6745 / mad, 6) end as z from v join q using (motif)""")
def mad_zscore(spark, d):
    hits = table(spark, d, "part").select(F.col("p_partkey").alias("feature_id"), (F.col("p_size") % 10).alias("motif"), F.lit(1).alias("weight"))
    t = matrix.matmul(hits, derived(spark, d, "coo"), "motif")
    return rounded(matrix.mad_zscore(t, "motif"), "z").drop("value")


@query(f"""with {cte('coo')}, s as (select feature_id, barcode_id % 6 as label, sum(value) as value from coo group by 1, 2), t as (select feature_id, sum(value) as t from s group by 1)
select feature_id, label, round(value / (t + 1e-28), 6) as value from s join t using (feature_id)""")
def reduce_columns(spark, d):
    m = derived(spark, d, "coo")
    labels = m.select("barcode_id").distinct().withColumn("label", F.col("barcode_id") % 6)
    return rounded(matrix.reduce_columns(m, labels, "label"), "value")


@query("with s as (select p_brand, count(*) as n from part group by 1), r as (select p_brand, row_number() over (order by n desc, p_brand) as label from s) select p_partkey as key, label from part join r using (p_brand)")
def relabel_by_size(spark, d):
    return matrix.relabel_by_size(table(spark, d, "part").select(F.col("p_partkey").alias("key"), "p_brand"), "key", "p_brand")


# --- statistics


@query("with p as (select l_orderkey * 10 + l_linenumber as key, ((l_partkey * 7919 + l_suppkey) % 9973 + 1) / 10000.0::double as p from lineitem), r as (select *, rank() over (order by p) + count(*) over (partition by p) - 1 as rk, count(*) over () as n from p) select key, p, round(least(min(p * n / rk) over (order by p desc), 1.0), 8) as adjusted from r")
def bh_adjust(spark, d):
    p = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"), (((F.col("l_partkey") * 7919 + F.col("l_suppkey")) % 9973 + 1) / F.lit(10000.0)).alias("p"))
    return rounded(stats.bh_adjust(p, "key", "p"), "adjusted", digits=8).select("key", "p", "adjusted")


@query(f"with {cte('frag')}, c as (select contig, barcode, count(*) as n from frag group by 1, 2) select contig, round(pow(sum(n), 2) / sum(n * n), 6) as diversity from c group by 1")
def effective_diversity(spark, d):
    c = frag(spark, d).groupBy("contig", "barcode").agg(F.count("*").alias("n"))
    return rounded(c.groupBy("contig").agg(stats.effective_diversity(F.col("n")).alias("diversity")), "diversity")


@query(f"with {cte('frag')}, h as (select stop - start as len, sum(stop - start) as s from frag group by 1), c as (select *, sum(s) over (order by len desc) as c, sum(s) over () as t from h) select max(len) as nx from c where c >= 0.5 * t")
def nx50(spark, d):
    return stats.nx(frag(spark, d).select((F.col("stop") - F.col("start")).alias("len")), "len", 0.5)


@query(f"""with {cte('frag')}, c as (select barcode, count(*) as n, sum(stop - start) as len from frag group by 1), r as (select rank() over (order by n) + (count(*) over (partition by n) - 1) / 2.0 as a, rank() over (order by len) + (count(*) over (partition by len) - 1) / 2.0 as b from c)
select round(corr(a, b), 6) as rho from r""")
def spearman(spark, d):
    c = frag(spark, d).groupBy("barcode").agg(F.count("*").alias("n"), F.sum(F.col("stop") - F.col("start")).alias("len"))
    return rounded(stats.spearman(c, "n", "len"), "rho")


@query(f"with {cte('frag')}, c as (select contig, barcode, count(*) as n from frag group by 1, 2), p as (select contig, n / sum(n) over (partition by contig) as p from c) select contig, round(-sum(p * log2(p)), 6) as entropy from p group by 1")
def entropy(spark, d):
    c = frag(spark, d).groupBy("contig", "barcode").agg(F.count("*").alias("n"))
    t = c.groupBy("contig").agg(F.sum("n").alias("t"))
    return rounded(c.join(t, "contig").groupBy("contig").agg(stats.entropy(F.col("n") / F.col("t")).alias("entropy")), "entropy")


@query(f"with {cte('frag')} select contig, count(*) as n, round(avg(stop - start), 6) as mean, round(var_samp(stop - start), 4) as var, round(quantile_cont(stop - start, 0.25), 6) as q1, round(quantile_cont(stop - start, 0.5), 6) as q2, round(quantile_cont(stop - start, 0.75), 6) as q3 from frag group by 1")
def length_statistics(spark, d):
    x = F.col("stop") - F.col("start")
    out = frag(spark, d).groupBy("contig").agg(F.count("*").alias("n"), F.avg(x).alias("mean"), F.var_samp(x).alias("var"), *[F.percentile(x, F.lit(q)).alias(f"q{k}") for k, q in ((1, 0.25), (2, 0.5), (3, 0.75))])
    return rounded(rounded(out, "mean", "q1", "q2", "q3"), "var", digits=4)


@query(f"""with {cte('frag')}, b as (select barcode, count(case when contig = 'chr1' then 1 end) as c0, count(case when contig = 'chr2' then 1 end) as c1 from frag group by 1),
t as (select quantile_cont(c0, 0.1) filter (where c0 >= c1) as t0, quantile_cont(c1, 0.1) filter (where c1 > c0) as t1 from b)
select barcode, c0, c1, case when c0 >= t0 and c1 >= t1 then 'multiplet' when c0 >= c1 then 'first' else 'second' end as call from b, t""")
def classify_genomes(spark, d):
    b = frag(spark, d).groupBy("barcode").agg(F.count_if(F.col("contig") == "chr1").alias("c0"), F.count_if(F.col("contig") == "chr2").alias("c1"))
    return models.classify_two(b)


# --- sequences: bases are made from numbers by translation

_SEQ = "select p_partkey as id, translate(lpad(cast((p_partkey * 104729 + 7919) % 100000000 as {s}), 16, '0123456789'), '0123456789', 'ACGTACGTAC') as seq from part"


def _seqs(spark, d):
    n = ((F.col("p_partkey") * 104729 + 7919) % 100000000).cast("string")
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.translate(F.lpad(n, 16, "0123456789"), "0123456789", "ACGTACGTAC").alias("seq"))


@query(f"with q as ({_SEQ.format(s='varchar')}) select id, reverse(translate(seq, 'ACGT', 'TGCA')) as rc from q")
def revcomp(spark, d):
    return _seqs(spark, d).select("id", seq.reverse_complement(F.col("seq")).alias("rc"))


@query(f"with q as ({_SEQ.format(s='varchar')}) select id, round(len(regexp_replace(seq, '[^GC]', '', 'g')) / len(seq), 6) as gc from q")
def gc_content(spark, d):
    return rounded(_seqs(spark, d).select("id", seq.gc_fraction(F.col("seq")).alias("gc")), "gc")


@query(f"with q as ({_SEQ.format(s='varchar')}) select id, substr(seq, 1, 7) as part_a, substr(seq, 8, 2) as part_c, substr(seq, 10, 7) as part_b from q")
def barcode_parts(spark, d):
    return _seqs(spark, d).select("id", seq.split_barcode(F.col("seq")).alias("p")).select("id", "p.*")


@query(f"""with q as ({_SEQ.format(s='varchar')}), w as (select distinct seq from q where id % 3 = 0), n as (select id, seq, unnest(range(1, 17)) as k from q where id % 3 <> 0),
c as (select id, seq, substr(seq, 1, k - 1) || b || substr(seq, k + 1) as cand from n, (select unnest(['A','C','G','T']) as b) where b <> substr(seq, k, 1))
select id, c.seq, cand from c join w on w.seq = cand""")
def barcode_neighbours(spark, d):
    q = _seqs(spark, d)
    known = q.where("id % 3 = 0").select(F.col("seq").alias("cand")).distinct()
    return q.where("id % 3 <> 0").select("id", "seq", F.explode(seq.neighbours(F.col("seq"))).alias("cand")).join(known, "cand")


@query(f"with q as ({_SEQ.format(s='varchar')}) select id, list_sum([case when substr(seq, i, 1) <> substr(reverse(seq), i, 1) then 1 else 0 end for i in range(1, 17)])::int as distance from q")
def hamming_distance(spark, d):
    return _seqs(spark, d).select("id", seq.hamming(F.col("seq"), F.reverse("seq")).alias("distance"))


# --- vectors and graphs


@query("select vec_id, round(1 - list_dot_product(embedding::double[], q::double[]) / sqrt(list_dot_product(embedding::double[], embedding::double[]) * list_dot_product(q::double[], q::double[])), 5) as distance from embeddings, (select embedding as q from embeddings where vec_id = 0)")
def cosine_to_first(spark, d):
    e = table(spark, d, "embeddings")
    first = e.where("vec_id = 0").select(F.col("embedding").alias("q"))
    return rounded(e.join(F.broadcast(first)).select("vec_id", stats.cosine_distance(F.col("embedding"), F.col("q")).alias("distance")), "distance", digits=5)


@query("""with e as (select vec_id, embedding::double[] as v from embeddings), p as (select a.vec_id as src, b.vec_id as dst, list_distance(a.v, b.v) as dist from e a, e b where a.vec_id <> b.vec_id)
select src, dst, round(dist, 4) as distance from p qualify row_number() over (partition by src order by dist, dst) <= 5""")
def knn_edges(spark, d):
    return rounded(graph.nearest(table(spark, d, "embeddings"), "vec_id", "embedding", 5), "distance", digits=4)


@query("""with e as (select vec_id, embedding::double[] as v from embeddings), p as (select a.vec_id as src, b.vec_id as dst, list_distance(a.v, b.v) as dist from e a, e b where a.vec_id <> b.vec_id),
k as (select src, dst from p qualify row_number() over (partition by src order by dist, dst) <= 5), l as (select src, dst, a.label as ls, b.label as ld from k join embeddings a on a.vec_id = src join embeddings b on b.vec_id = dst),
u as (select ls as s, ld as d from l), m as (select count(*) * 2.0 as m2 from u), t as (select s as c, count(*) as tot from (select s from u union all select d as s from u) group by 1), i as (select s as c, 2 * count(*) as inn from u where s = d group by 1)
select round(sum(coalesce(inn, 0) / m2 - (tot / m2) * (tot / m2)), 6) as modularity from t left join i using (c), m""")
def label_modularity(spark, d):
    e = table(spark, d, "embeddings")
    edges = graph.nearest(e, "vec_id", "embedding", 5).select("src", "dst")
    return rounded(graph.modularity(edges, e.select(F.col("vec_id").alias("node"), F.col("label").alias("community"))), "modularity")


@query()
def louvain_labels(spark, d):
    e = table(spark, d, "embeddings")
    return graph.communities(graph.nearest(e, "vec_id", "embedding", 5).select("src", "dst"))


@query()
def pca_projection(spark, d):
    return reduce.pca(derived(spark, d, "coo"), 5)


@query()
def kmeans_labels(spark, d):
    return models.kmeans(reduce.pca(derived(spark, d, "coo"), 5), 4)


@query()
def cell_mixture(spark, d):
    return models.cell_calls(frag(spark, d).groupBy("barcode").agg(F.count("*").alias("n")))


@query()
def differential_features(spark, d):
    m = derived(spark, d, "coo")
    return models.differential(m, m.select("barcode_id").distinct().withColumn("in_group", F.col("barcode_id") % 2 == 0))


# --- time windows on events: position plays the part of event time


@query("select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n from events group by 1, 2")
def tumbling_counts(spark, d):
    return windows.tumbling(table(spark, d, "events"))


@query("""with s as (select user_id, ts, case when ts < lag(ts) over (partition by user_id order by ts) + interval '30 minutes' then 0 else 1 end as f from events),
g as (select *, sum(f) over (partition by user_id order by ts rows unbounded preceding) as g from s) select user_id, min(ts) as start, count(*) as n from g group by user_id, g""")
def session_counts(spark, d):
    return windows.sessions(table(spark, d, "events"))


def queries() -> dict:
    from . import catalog_analysis, catalog_cells, catalog_lanes, catalog_models  # noqa: F401  they register their own

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import catalog_analysis, catalog_cells, catalog_lanes, catalog_models  # noqa: F401

    return dict(_SQL)
