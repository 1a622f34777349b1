"""Named queries: copies on lanes, periods, mixtures of groups, resampling and spread samples,
and set operations on fixtures dense enough to meet."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequence as seq
from ..operators import barcodes, cells, intervals, lanes, mixtures, periodicity
from ..operators import fragments as fr
from ..sources import checks
from .catalog import _SEQ, _seqs, _sweep_sql, frag, query, rounded, table
from .fixtures import cte, derived

# --- copies on lanes: reads lie on a coarse raster with a little noise

_LANES = """r as (select l_partkey % 300 as pos, 'FC' as flowcell, l_suppkey % 2 + 1 as lane, 1 + l_orderkey % 2 as swath, 1 + l_suppkey % 12 as tile,
  l_orderkey % 10 * 20000 + l_linenumber * 23 as x, l_partkey % 7 * 30000 + l_orderkey % 5 * 11 as y from lineitem),
n as (select *, concat('M:r:FC:', lane, ':1', swath, tile, ':', x, ':', y) as qname from r),
e as (select lane, max(x) as w, max(y) as h, max(swath) as s, max(tile) as t from n group by 1),
p as (select n.pos, n.lane, qname, (swath - 1) * w + x as lx, (tile - 1) * h + y as ly, pi() * 625e6 / (w * h * s * t) < 0.025 as wide from n join e using (lane))"""


def raster_reads(spark, d):
    lane, swath, tile = F.col("l_suppkey") % 2 + 1, 1 + F.col("l_orderkey") % 2, 1 + F.col("l_suppkey") % 12
    x = F.col("l_orderkey") % 10 * 20000 + F.col("l_linenumber") * 23
    y = F.col("l_partkey") % 7 * 30000 + F.col("l_orderkey") % 5 * 11
    name = F.concat(F.lit("M:r:FC:"), lane, F.lit(":1"), swath, tile, F.lit(":"), x, F.lit(":"), y)
    return table(spark, d, "lineitem").select((F.col("l_partkey") % 300).alias("pos"), name.alias("qname"))


def _near(radius: str, rule: str = "true") -> str:
    return f"""select pos, count(*) as k from (select distinct pos, lane, qname, copy from (select *, row_number() over (partition by pos, lane, qname) as copy from p) b
  where {rule} and exists (select 1 from p a where a.pos = b.pos and a.lane = b.lane and a.qname < b.qname and pow(a.lx - b.lx, 2) + pow(a.ly - b.ly, 2) < {radius})) group by 1"""


@query(f"""with {_LANES}, o as ({_near('10000')}), f as ({_near('625e6', 'wide')}), c as (select pos, count(*) as copies from p group by 1)
select pos, copies, coalesce(o.k, 0) as optical, coalesce(f.k, 0) as diffusion from c left join o using (pos) left join f using (pos)""")
def lane_copies(spark, d):
    return lanes.lane_copies(raster_reads(spark, d), ["pos"])


@query(f"with {_LANES} select 'FC' as flowcell, lane::varchar as lane, w as width, h as height, s as swaths, t as tiles from e")
def lane_layouts(spark, d):
    return lanes.layouts(lanes.positions(raster_reads(spark, d)))


# --- periods, mixtures, resampling


@query()
def insert_periods(spark, d):
    return periodicity.periods(frag(spark, d))


@query()
def guide_mixtures(spark, d):
    """Suppliers stand for guides, the parts that each delivers for cells."""
    counts = table(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 10).alias("guide"), "l_partkey").agg(F.sum("l_quantity").cast("long").alias("n"))
    return rounded(mixtures.grouped_mixtures(counts, "guide", "n"), "mean_low", "mean_high", "variance", "share_high", digits=5)


@query(f"""with {cte('coo')}, d as (select barcode_id, sum(value) as d from coo group by 1), g as (select barcode_id, d, 'p' || (barcode_id % 5) as p from d), n as (select p, count(*) as cells from g group by 1),
t as (select 'p' || k as p, f as feature_id from (select unnest(range(1, 5)) as k), (select unnest([3, 7, 11, 19]) as f)), s as (select p, feature_id, sum(1e4 * value / d) as s from coo join g using (barcode_id) group by 1, 2),
o as (select t.p, t.feature_id, cells, coalesce(s.s, 0) / cells as mean, coalesce(c.s, 0) / (select cells from n where p = 'p0') as mean_control from t join n on n.p = t.p left join s on s.p = t.p and s.feature_id = t.feature_id left join s c on c.p = 'p0' and c.feature_id = t.feature_id where cells >= 10)
select p as perturbation, feature_id, cells, round(mean, 5) as mean, round(mean_control, 5) as mean_control, round(log2((mean + 1) / (mean_control + 1)), 6) as log2_ratio from o""")
def perturbation_efficiency(spark, d):
    m = derived(spark, d, "coo")
    groups = m.select("barcode_id").distinct().withColumn("perturbation", F.concat(F.lit("p"), F.col("barcode_id") % 5))
    targets = spark.createDataFrame([(f"p{k}", f) for k in range(1, 5) for f in (3, 7, 11, 19)], "perturbation string, feature_id long")
    return rounded(rounded(mixtures.efficiency(m, groups, targets, "p0"), "mean", "mean_control", digits=5), "log2_ratio")


@query()
def multiplet_bootstrap(spark, d):
    own = frag(spark, d).groupBy("barcode").agg(F.count_if(F.col("contig") == "chr1").alias("c0"), F.count_if(F.col("contig") == "chr2").alias("c1"))
    return mixtures.bootstrap_multiplets(own)


@query()
def spread_points(spark, d):
    return mixtures.spread_sample(table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice"), 150, "p_size", "p_retailprice", "p_partkey")


# --- barcodes as read, lots, random cells

_READ = f"q as ({_SEQ.format(s='varchar')}), c as (select reverse(translate(seq, 'ACGT', 'TGCA')) as barcode, count(*) as n from q group by 1), w as (select distinct seq as barcode from q where id % 3 = 0)"


@query(f"with {_READ}, a as (select coalesce(sum(n), 0) as n from c where barcode in (select barcode from w)), b as (select coalesce(sum(n), 0) as n from c where reverse(translate(barcode, 'ACGT', 'TGCA')) in (select barcode from w)) select case when a.n > 0 then b.n >= 0.5 * (a.n + b.n) else b.n > 0 end as reversed from a, b")
def barcodes_reversed(spark, d):
    q = _seqs(spark, d)
    read = q.groupBy(seq.reverse_complement(F.col("seq")).alias("barcode")).agg(F.count("*").alias("n"))
    found = cells.reads_reversed(read, q.where("id % 3 = 0").select(F.col("seq").alias("barcode")), lambda c: seq.reverse_complement(F.col(c)))
    return spark.createDataFrame([(found,)], "reversed boolean")


@query(f"""with q as ({_SEQ.format(s='varchar')}), h as (select seq, 1 + id % 5 as n from q), l as (select distinct substr(seq, 1, 7) as part, 'lot' || (ascii(substr(seq, 3, 1)) % 3) as lot from q),
p as (select lot, sum(n)::bigint as n from h join l on substr(seq, 1, 7) = part group by 1), t as (select lot, n / (select sum(n) from p) as share, (select sum(n) from p)::bigint as reads from p order by n desc, lot desc limit 1)
select lot, round(share, 6) as share, reads, share >= 0.95 and reads >= 1000 as confident from t""")
def barcode_lot(spark, d):
    q = _seqs(spark, d)
    lots = q.select(F.substring("seq", 1, 7).alias("part"), F.concat(F.lit("lot"), F.ascii(F.substring("seq", 3, 1)) % 3).alias("lot")).distinct()
    return rounded(barcodes.lot_of(q.select(F.col("seq").alias("barcode"), (1 + F.col("id") % 5).alias("n")), lots), "share")


# --- relations on fixtures in which intervals and barcodes do meet


def _wide(sql: str) -> str:
    return sql.replace('start as s, "end" as e', 'greatest(start - 20000, 0) as s, "end" + 20000 as e')


def wide_sides(spark, d):
    t = derived(spark, d, "track").withColumns({"start": F.greatest(F.col("start") - 20_000, F.lit(0)), "end": F.col("end") + 20_000})
    return t.where("track in ('track0','track1')").drop("track"), t.where("track in ('track2','track3')").drop("track")


@query(_wide(_sweep_sql("a > 0 and b > 0")))
def wide_intersect(spark, d):
    return intervals.intersect(*wide_sides(spark, d))


_COARSE = "c as (select contig, start // 2000 as start, stop // 2000 as stop, 'B' || (l % 40) as barcode from (select *, cast(substr(barcode, 3, 4) as int) as l from frag))"


@query(f"""with {cte('frag')}, {_COARSE}, e as (select contig, stop as place, barcode, count(*) as n from c group by all), s as (select contig, start as place, barcode as other, count(*) as m from c group by all),
p as (select barcode, other, sum(n * m) as n from e join s using (contig, place) where barcode <> other group by 1, 2),
b as (select barcode, other from p qualify row_number() over (partition by barcode order by n desc, other) = 1)
select x.barcode, x.other from b x join b y on x.barcode = y.other and x.other = y.barcode where x.barcode < x.other""")
def coarse_partners(spark, d):
    f = frag(spark, d).select("contig", F.floor(F.col("start") / 2000).alias("start"), F.floor(F.col("stop") / 2000).alias("stop"), F.concat(F.lit("B"), F.substring("barcode", 3, 4).cast("int") % 40).alias("barcode"))
    return fr.mutual_partners(fr.adjacency(f))


# --- faults of inputs

_FAULTY = """t as (select contig, case when start % 7 = 0 then start - 900000 else start end as start, case when start % 11 = 0 then start else "end" + 40000 end as "end" from track),
n as (select contig, 900000::bigint as length from track where contig <> 'chr5' group by 1)"""


@query(f"""with {cte('track')}, {_FAULTY}, s as (select row_number() over () as k, * from t where "end" > start), o as (select contig, start, "end" from s where exists (select 1 from s x where x.contig = s.contig and x.k <> s.k and (x.start = s.start or (x.start < s.start and x."end" > s.start))))
select contig, start, "end", 'empty' as fault from t where "end" <= start union all select contig, start, "end", 'negative' from t where start < 0
union all select contig, start, "end", 'contig' from t where contig = 'chr5' union all select contig, start, "end", 'beyond' from t where contig <> 'chr5' and "end" > 900000 union all select contig, start, "end", 'overlap' from o""")
def region_faults(spark, d):
    t = derived(spark, d, "track")
    bad = t.select("contig", F.when(F.col("start") % 7 == 0, F.col("start") - 900_000).otherwise(F.col("start")).alias("start"), F.when(F.col("start") % 11 == 0, F.col("start")).otherwise(F.col("end") + 40_000).alias("end"))
    lengths = t.where("contig <> 'chr5'").groupBy("contig").agg(F.lit(900_000).alias("length"))
    return checks.region_faults(bad, lengths)


@query(f"""with {cte('frag')}, x as (select *, case when dup = 3 then 0 else dup end as d from frag), e as (select *, concat_ws(':', contig, start, stop, barcode) as example from x)
select 'contig' as fault, count(*) as n, min(example) as example from e where contig = 'chr5' union all select 'beyond', count(*), min(example) from e where contig <> 'chr5' and stop > 900000 union all select 'copies', count(*), min(example) from e where d < 1""")
def fragment_faults(spark, d):
    f = frag(spark, d)
    lengths = f.where("contig <> 'chr5'").groupBy("contig").agg(F.lit(900_000).alias("length"))
    return checks.fragment_faults(f.withColumn("dup", F.when(F.col("dup") == 3, 0).otherwise(F.col("dup"))), lengths)
