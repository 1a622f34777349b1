"""More named queries: barcodes, annotation, inference, reduction and run metrics."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import sequence as seq
from ..functions import stats
from ..operators import annotation, barcodes, graph, inference, intervals, matrix, reduce
from ..streaming import windows
from .catalog import _SEQ, LENGTH, _seqs, frag, peaks_of, query, rounded, table
from .fixtures import DEPTH_SQL, PEAKS_SQL, cte, derived

_Q = f"q as ({_SEQ.format(s='varchar')})"
_DIST = "list_sum([case when substr({a}, i, 1) <> substr({b}, i, 1) then 1 else 0 end for i in range(1, 17)])"


# --- barcodes


@query(f"with {_Q}, w as (select distinct seq as barcode from q where id % 3 = 0), c as (select seq, count(*) as n from q group by 1) select barcode, coalesce(n, 0) as n from w left join c on seq = barcode union all select null, coalesce(sum(n), 0)::bigint from c where seq not in (select barcode from w)")
def whitelist_histogram(spark, d):
    q = _seqs(spark, d)
    return barcodes.whitelist_histogram(q.select(F.col("seq").alias("barcode")), q.where("id % 3 = 0").select(F.col("seq").alias("barcode")))


@query(f"""with {_Q}, w as (select seq as cand, min(1 + id % 5) as prior from q where id % 3 = 0 group by 1), r as (select id, seq, 3 + id % 36 as qv from q),
sure as (select r.id, seq as cand from r join w on w.cand = r.seq where qv > 24),
x as (select r.id, w.cand, prior * pow(10.0::double, -least(greatest(qv, 3), 40) * {_DIST.format(a='r.seq', b='w.cand')} / 10.0) as w, {_DIST.format(a='r.seq', b='w.cand')} as k from r, w where r.id not in (select id from sure)),
b as (select id, arg_max(cand, row(w, cand)) as cand, max(w) / sum(w) as p from x where k <= 2 group by 1)
select r.id, r.seq, coalesce(s.cand, case when p > 0.975 then b.cand end) as barcode from r left join sure s using (id) left join b using (id)""")
def barcode_correction(spark, d):
    q = _seqs(spark, d)
    wl = q.where("id % 3 = 0").groupBy(F.col("seq").alias("barcode")).agg(F.min(1 + F.col("id") % 5).alias("prior"))
    reads = q.withColumn("qual", F.repeat(F.char(33 + 3 + F.col("id") % 36), F.lit(16)))
    return barcodes.correct(reads, wl).select("id", "seq", "barcode")


@query(f"""with {_Q}, u as (select id % 3 as gene, substr(seq, 13, 4) as umi, count(*) as n from q group by 1, 2),
c as (select u.gene, u.umi, v.umi as t, v.n as m from u join u v on u.gene = v.gene and {_DIST.format(a='u.umi', b='v.umi')} = 1 where v.n > u.n or (v.n = u.n and v.umi < u.umi)),
b as (select gene, umi, t from c qualify row_number() over (partition by gene, umi order by m desc, t) = 1) select gene, umi, n, coalesce(t, umi) as corrected from u left join b using (gene, umi)""")
def umi_correction(spark, d):
    u = _seqs(spark, d).groupBy((F.col("id") % 3).alias("gene"), F.substring("seq", 13, 4).alias("umi")).agg(F.count("*").alias("n"))
    return barcodes.correct_umis(u, ["gene"])


_PARTS = "substr(barcode, 3, 2) as a, substr(barcode, 5, 1) as c, substr(barcode, 6, 1) as b"
_LINK = f"""e as (select contig, stop as place, barcode as major, count(*) as x from frag group by all), s as (select contig, start as place, barcode as minor, count(*) as y from frag group by all),
p as (select distinct barcode, {_PARTS} from frag),
l as (select minor, major, sum(x * y)::bigint as n from e join s using (contig, place) join p p1 on p1.barcode = major join p p2 on p2.barcode = minor where p1.c = p2.c and (p1.a = p2.a or p1.b = p2.b) group by 1, 2)"""


def _links(spark, d):
    b = F.col("barcode")
    return barcodes.linkage(frag(spark, d), F.substring(b, 3, 2), F.substring(b, 5, 1), F.substring(b, 6, 1))


@query(f"with {cte('frag')}, {_LINK} select minor, major, n from l")
def barcode_linkage(spark, d):
    return _links(spark, d)


@query(f"""with {cte('frag')}, {_LINK}, k as (select barcode, count(*) as n from frag group by 1), o as (select minor, n as own from l where minor = major),
h as (select minor, major, n from l left join o using (minor) where minor <> major and major in (select barcode from k where n >= 20) and n > 0.4 * coalesce(own, 0)),
b as (select minor, major from h qualify row_number() over (partition by minor order by n desc, major) = 1),
w as (select b.* from b left join b r on r.minor = b.major and r.major = b.minor join k k1 on k1.barcode = b.minor join k k2 on k2.barcode = b.major where r.minor is null or k1.n < k2.n or (k1.n = k2.n and b.minor > b.major))
select w.minor, coalesce(u.major, w.major) as major from w left join w u on u.minor = w.major""")
def barcode_multiplets(spark, d):
    counts = frag(spark, d).groupBy("barcode").agg(F.count("*").alias("n"))
    return barcodes.multiplets(_links(spark, d), counts, least=20)


@query(f"""with {cte('frag', 'track')}, t as (select barcode, count(*) as n, count(case when exists (select 1 from track t where t.contig = f.contig and t."end" >= f.start and t.start < f.stop) then 1 end) as targeted from frag f group by 1)
select barcode, n, targeted from t where targeted / n < 0.05""")
def low_targeting(spark, d):
    from ..operators import fragments as fr

    return barcodes.low_targeting(fr.targeting(frag(spark, d), {"targeted": derived(spark, d, "track").drop("track")}), 0.05)


@query("""with h as (select p_brand as idx, count(*) as n from part group by 1), r as (select *, sum(n) over (order by n desc) - sum(n) over (partition by n) as ahead, sum(n) over () as t from h),
c as (select greatest(median(n) / 250, 20) as cut from r where ahead < 0.9 * t) select idx, n, n >= cut as common from h, c""")
def sample_indices(spark, d):
    return barcodes.split_indices(table(spark, d, "part").select(F.col("p_brand").alias("idx")), "idx")


# --- annotation

_NEAR = """pk as (select contig, start, "end" from peaks), d as (select k.*, t.name as gene, t.strand, t.start as t,
  case when t.start < k.start then k.start - t.start when t.start >= k."end" then t.start - k."end" + 1 else 0 end as gap from pk k join tss t on t.contig = k.contig),
n as (select contig, start, "end", gene, case when gap = 0 then 0 when (t > start) = (strand <> '-') then -gap else gap end as distance from d qualify rank() over (partition by contig, start, "end" order by gap) = 1)"""


@query(f'with {cte("frag", "tss")}, {DEPTH_SQL}, {PEAKS_SQL}, {_NEAR} select contig, start, "end", gene, distance from n')
def nearest_starts(spark, d):
    return annotation.nearest_starts(peaks_of(spark, d), derived(spark, d, "tss"))


@query(f"""with {cte("frag", "tss", "track")}, {DEPTH_SQL}, {PEAKS_SQL}, {_NEAR}, c as (select distinct *, case when distance between -1000 and 100 then 'promoter' when abs(distance) <= 200000 then 'distal' end as kind from n),
f as (select * from c where kind = 'promoter' or (kind = 'distal' and not exists (select 1 from c x where x.contig = c.contig and x.start = c.start and x."end" = c."end" and x.gene = c.gene and x.kind = 'promoter'))),
g as (select distinct k.contig, k.start, k."end", t.track as gene, 0 as distance, 'distal' as kind from pk k join track t on t.contig = k.contig and t."end" > k.start and t.start < k."end"),
u as (select * from f union all select * from g where not exists (select 1 from f where f.contig = g.contig and f.start = g.start and f."end" = g."end" and f.gene = g.gene)),
w as (select * from u union all select contig, start, "end", null, null, 'intergenic' from pk k where not exists (select 1 from u where u.contig = k.contig and u.start = k.start and u."end" = k."end")),
z as (select distinct contig, start, "end", coalesce(gene, '') as g, coalesce(cast(distance as varchar), '') as s, kind as k from w)
select contig, start, "end", string_agg(g, ';' order by g, s, k) as genes, string_agg(s, ';' order by g, s, k) as distances, string_agg(k, ';' order by g, s, k) as kinds from z group by 1, 2, 3""")
def peak_annotation(spark, d):
    bodies = derived(spark, d, "track").withColumnRenamed("track", "name")
    return annotation.collapsed(annotation.annotate(peaks_of(spark, d), derived(spark, d, "tss"), bodies))


@query(f"with {_Q}, g as (select id, round(len(regexp_replace(seq, '[^GC]', '', 'g')) / len(seq), 6) as gc from q), c as (select distinct b from (select unnest(quantile_disc(gc, [k / 25 for k in range(1, 25)])) as b from g) where b >= 0.33 and b < 0.7) select id, gc, (select count(*) from c where b <= gc)::int as gc_bin from g")
def gc_bins(spark, d):
    g = rounded(_seqs(spark, d).select("id", seq.gc_fraction(F.col("seq")).alias("gc")), "gc")
    return annotation.gc_bins(g, "gc")


@query()
def motif_scan(spark, d):
    motif = np.array([[8, 0, 0, 1, 8], [0, 9, 1, 7, 0], [1, 0, 8, 1, 1], [0, 0, 0, 0, 0]])
    return rounded(annotation.scan_motifs(_seqs(spark, d), {"m1": motif}, 2e-3), "score")


# --- inference


@query(f"""with {cte('coo')}, n as (select count(distinct case when barcode_id % 2 = 0 then barcode_id end) as na, count(distinct case when barcode_id % 2 = 1 then barcode_id end) as nb from coo),
p as (select feature_id, count(case when barcode_id % 2 = 0 then 1 end) as in_a, count(case when barcode_id % 2 = 1 then 1 end) as in_b from coo group by 1)
select feature_id, in_a, in_b, round(log2((in_a + 1) * (nb + 2) / (na + 2)::double / (in_b + 1)), 6) as log2_ratio from p, n""")
def presence_ratio(spark, d):
    m = derived(spark, d, "coo")
    g = m.select("barcode_id").distinct().withColumn("in_group", F.col("barcode_id") % 2 == 0)
    return rounded(inference.presence_test(m, g), "log2_ratio").drop("p_value")


@query(f"with {cte('coo')}, s as (select barcode_id, sum(value) as s from coo group by 1) select barcode_id, round(s / (select median(s) from s), 6) as factor from s")
def size_factors(spark, d):
    return rounded(inference.size_factors(derived(spark, d, "coo")), "factor")


@query(f"""with {cte('coo')}, b as (select barcode_id, sum(value) as s from coo group by 1), f as (select barcode_id, s / (select median(s) from b) as f from b), t as (select count(*)::double as n, sum(1 / f) as inv from f),
s as (select feature_id, sum(value / f) as s, sum((value / f) * (value / f)) as q from coo join f using (barcode_id) group by 1), g as (select feature_id, n, inv, s / n as mean, q / n - (s / n) * (s / n) as var from s, t),
r as (select *, greatest(0.0, (n * var - mean * inv) / (mean * mean * inv)) as raw from g where var > 0), z as (select quantile_cont(raw, 0.995) as zeta, avg(raw) as a, count(*) as k from r),
e as (select (select sum((raw - a) * (raw - a)) / (k - 1) from r, z group by k) / (select sum((raw - zeta) * (raw - zeta)) / (k - 2) from r, z group by k) as delta)
select feature_id, round(mean, 6) as mean, round(var, 6) as var, round((1 - delta) * raw + delta * zeta, 5) as phi from r, z, e""")
def shrunk_dispersions(spark, d):
    return rounded(rounded(inference.shrunk_dispersions(derived(spark, d, "coo")), "mean", "var"), "phi", digits=5)


@query(f"with {cte('coo')}, m as (select feature_id, sum(value) / 211.0::double as mean, sum(value * value) / 211.0::double - (sum(value) / 211.0::double) * (sum(value) / 211.0::double) as var from coo group by 1) select feature_id, round(mean, 6) as mean, round(var, 6) as var, round(greatest((var - mean) / (mean * mean), 1e-4), 6) as alpha from m")
def empirical_dispersion(spark, d):
    m = matrix.moments(derived(spark, d, "coo"), "feature_id", 211)
    return rounded(m.withColumn("alpha", F.greatest((F.col("var") - F.col("mean")) / (F.col("mean") * F.col("mean")), F.lit(1e-4))), "mean", "var", "alpha")


@query()
def glm_features(spark, d):
    m = derived(spark, d, "coo")
    g = m.select("barcode_id").distinct().withColumn("in_group", F.col("barcode_id") % 2 == 0)
    return inference.glm_test(m, g)


@query()
def fitted_peaks(spark, d):
    return inference.call_peaks(frag(spark, d))


@query()
def ambient_barcodes(spark, d):
    m = derived(spark, d, "coo")
    return inference.ambient_p_values(m, m)


# --- reduction and clusters


@query()
def lsa_scores(spark, d):
    return reduce.lsa(derived(spark, d, "coo"), 4)


@query()
def plsa_topics(spark, d):
    return reduce.plsa(derived(spark, d, "coo"), 3)


@query("""with x as (select vec_id, label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as i from embeddings), c as (select label, i, avg(x) as c from x group by 1, 2),
s as (select label, sqrt(sum(pow(x - c, 2)) / count(distinct vec_id)) as s from x join c using (label, i) group by 1),
g as (select a.label as l, b.label as m, greatest(sqrt(sum(pow(a.c - b.c, 2))), 1e-3) as d from c a join c b using (i) where a.label <> b.label group by 1, 2),
r as (select l, max((s1.s + s2.s) / d) as r from g join s s1 on s1.label = l join s s2 on s2.label = m group by 1) select round(avg(r), 5) as "index" from r""")
def davies_bouldin(spark, d):
    e = table(spark, d, "embeddings")
    return rounded(reduce.davies_bouldin(e.select("vec_id", "embedding"), e.select("vec_id", "label"), "vec_id", "embedding"), "index", digits=5)


@query("""with e as (select vec_id, embedding::double[] as v from embeddings), p as (select a.vec_id as src, b.vec_id as dst, list_distance(a.v, b.v) as dist from e a, e b where a.vec_id <> b.vec_id),
k as (select src, dst from p qualify row_number() over (partition by src order by dist, dst) <= 5) select x.src as a, y.src as b, count(*) / 5.0::double as share from k x join k y on x.dst = y.dst and x.src < y.src group by 1, 2""")
def shared_neighbours(spark, d):
    return reduce.shared_neighbours(graph.nearest(table(spark, d, "embeddings"), "vec_id", "embedding", 5), 5)


# --- run metrics


@query("""select source, count(*) as reads, sum(len(regexp_replace(coalesce(text, ''), '[^a-z]', '', 'g')))::bigint as letters, sum(len(coalesce(text, '')))::bigint as bases from documents group by 1""")
def base_counts(spark, d):
    t = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("reads"), F.sum(F.regexp_count(t, F.lit("[a-z]"))).alias("letters"), F.sum(F.length(t)).cast("long").alias("bases"))


@query(f"""with {cte('frag')}, b as (select barcode, count(case when contig = 'chr1' then 1 end) as own, count(case when contig = 'chr2' then 1 end) as other from frag group by 1)
select round(median(own / (own + other)), 6) as purity, count(*) as cells, (count(*) - count(distinct own))::bigint as repeated from b where own > 0""")
def purity_metrics(spark, d):
    b = frag(spark, d).groupBy("barcode").agg(F.count_if(F.col("contig") == "chr1").alias("own"), F.count_if(F.col("contig") == "chr2").alias("other")).where("own > 0")
    return rounded(b.agg(F.percentile(F.col("own") / (F.col("own") + F.col("other")), F.lit(0.5)).alias("purity"), F.count("*").alias("cells"), (F.count("*") - F.count_distinct("own")).alias("repeated")), "purity")


@query(f"""with {cte('reads')} select count(*) as total, round(count(case when mapq <= 30 then 1 end) / count(*), 6) as low_mapq, round(count(case when ref_id = 4 then 1 end) / count(*), 6) as mito, round(count(distinct barcode) / count(*), 6) as barcodes,
  case when count(case when ref_id = 9 then 1 end) = 0 then null else 1.0::double end as unseen from reads""")
def waste_metrics(spark, d):
    r = derived(spark, d, "reads")
    share = lambda c: F.count_if(c) / F.count("*")
    out = r.agg(F.count("*").alias("total"), share(F.col("mapq") <= 30).alias("low_mapq"), share(F.col("ref_id") == 4).alias("mito"), (F.count_distinct("barcode") / F.count("*")).alias("barcodes"), F.try_divide(F.count_if(F.col("ref_id") == 9), F.count_if(F.col("ref_id") == 9)).cast("double").alias("unseen"))
    return rounded(out, "low_mapq", "mito", "barcodes")


@query("select width, count(*) as n from (select floor((c_acctbal + 1000) / 500)::bigint as width from customer) group by 1")
def histogram_bins(spark, d):
    return table(spark, d, "customer").select(F.floor((F.col("c_acctbal") + 1000) / 500).alias("width")).groupBy("width").agg(F.count("*").alias("n"))


@query(f"with {cte('track')} select t.contig, t.start, t.\"end\", t.track from track t where t.\"end\" > {LENGTH} or exists (select 1 from track x where x.contig = t.contig and x.start < t.start and x.\"end\" > t.start)")
def bed_problems(spark, d):
    t = derived(spark, d, "track")
    from ..operators.scan import running

    seen = running(t, ["contig"], "start", F.col("end"), "before", "max", before=True)
    # rows that share a start don't precede each other
    first = seen.groupBy("contig", "start").agg(F.min("before").alias("before_all"))
    return seen.join(first, ["contig", "start"]).where((F.col("end") > LENGTH) | (F.col("before_all") > F.col("start"))).select("contig", "start", "end", "track")


@query("""select event_type, count(*) as n, round(avg(value), 5) as mean, round(var_samp(value), 4) as var, round(stddev_pop(value) / avg(value), 5) as cv, round((var_samp(value) - avg(value)) / pow(avg(value), 2), 5) as dispersion, count(distinct user_id) as users from events group by 1""")
def metric_summary(spark, d):
    v = F.col("value")
    out = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.avg(v).alias("mean"), F.var_samp(v).alias("var"), (F.stddev_pop(v) / F.avg(v)).alias("cv"), ((F.var_samp(v) - F.avg(v)) / F.pow(F.avg(v), F.lit(2))).alias("dispersion"), F.count_distinct("user_id").alias("users"))
    return rounded(rounded(out, "mean", "cv", "dispersion", digits=5), "var", digits=4)


@query("select event_type, user_id, n from (select event_type, user_id, count(*) as n, rank() over (partition by event_type order by count(*) desc) as r from events group by 1, 2) where r <= 3")
def top_users_with_ties(spark, d):
    from pyspark.sql import Window

    c = table(spark, d, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return c.withColumn("r", F.rank().over(Window.partitionBy("event_type").orderBy(F.desc("n")))).where("r <= 3").drop("r")


@query("""select start, count(*) as n from (select unnest([time_bucket(interval '30 minutes', ts), time_bucket(interval '30 minutes', ts) - interval '30 minutes']) as start from events) group by 1""")
def hopping_counts(spark, d):
    return windows.hopping(table(spark, d, "events"))


@query("select user_id, event_type, count(*) over (partition by user_id, event_type) as n from events qualify row_number() over (partition by user_id, event_type order by ts) = 1")
def deduplicated_keys(spark, d):
    e = table(spark, d, "events")
    return windows.first_seen(e.select("user_id", "event_type"), ["user_id", "event_type"]).join(e.groupBy("user_id", "event_type").agg(F.count("*").alias("n")), ["user_id", "event_type"])


@query(f"with {cte('frag')}, h as (select greatest(0, start // 16384)::bigint as bin, count(*) as n from frag group by 1) select bin, n, round(n / sum(n) over (), 8) as share from h")
def bin_histogram(spark, d):
    h = frag(spark, d).groupBy(F.floor(F.col("start") / intervals.BIN).alias("bin")).agg(F.count("*").alias("n"))
    t = h.agg(F.sum("n").alias("t"))
    return rounded(h.join(F.broadcast(t)).select("bin", "n", (F.col("n") / F.col("t")).alias("share")), "share", digits=8)


@query(f"""with {cte('frag')}, c as (select contig, barcode, count(*) as n from frag group by 1, 2), s as (select contig, sum(n) as s from c group by 1), p as (select contig, barcode, n / s as p from c join s using (contig))
select round(sum(sqrt(a.p * b.p)), 6) as overlap, round(sum(a.p * log2(a.p / b.p)), 6) as kl from p a join p b using (barcode) where a.contig = 'chr1' and b.contig = 'chr2'""")
def distribution_distance(spark, d):
    c = frag(spark, d).groupBy("contig", "barcode").agg(F.count("*").alias("n"))
    s = c.groupBy("contig").agg(F.sum("n").alias("s"))
    p = c.join(s, "contig").select("contig", "barcode", (F.col("n") / F.col("s")).alias("p"))
    both = p.where("contig = 'chr1'").select("barcode", F.col("p").alias("a")).join(p.where("contig = 'chr2'").select("barcode", F.col("p").alias("b")), "barcode")
    return rounded(both.agg(stats.bhattacharyya(F.col("a"), F.col("b")).alias("overlap"), stats.kl_divergence(F.col("a"), F.col("b")).alias("kl")), "overlap", "kl")


@query("select key, last(value order by k) as value from (select o_orderpriority as key, 0 as k, count(*) as value from orders group by 1 union all select o_orderpriority, 1, count(distinct o_custkey) from orders where o_orderstatus = 'O' group by 1) group by 1")
def merged_metrics(spark, d):
    o = table(spark, d, "orders")
    a = o.groupBy(F.col("o_orderpriority").alias("key")).agg(F.count("*").alias("value")).withColumn("k", F.lit(0))
    b = o.where("o_orderstatus = 'O'").groupBy(F.col("o_orderpriority").alias("key")).agg(F.count_distinct("o_custkey").alias("value")).withColumn("k", F.lit(1))
    return a.unionByName(b).groupBy("key").agg(F.max_by("value", "k").alias("value"))


@query(f"""with {cte('coo')}, m as (select feature_id, sum(value) / 211.0::double as mean, sum(value * value) / 211.0::double - (sum(value) / 211.0::double) * (sum(value) / 211.0::double) as var from coo group by 1),
c as (select quantile_cont(mean, [k / 4 for k in range(1, 4)]) as q from m), b as (select feature_id, var / mean as disp, len(list_filter(q, lambda x: x < mean))::int as bin from m, c), d as (select bin, median(disp) as med from b group by 1),
e as (select b.*, med, abs(disp - med) as dev from b join d using (bin)), f as (select bin, median(dev) as mad from e group by 1) select feature_id, bin, round((disp - med) / mad, 5) as z from e join f using (bin)""")
def normalised_dispersion(spark, d):
    return rounded(matrix.normalised_dispersion(matrix.moments(derived(spark, d, "coo"), "feature_id", 211), 4), "z", digits=5)


# --- group sums and size factors of the differential tests


@query(f"""with {cte('coo')}, b as (select barcode_id, sum(value) as s from coo group by 1), z as (select barcode_id, s / (select median(s) from b) as f from b),
t as (select sum(case when barcode_id % 2 = 0 then f else 0 end) as sa, sum(case when barcode_id % 2 = 1 then f else 0 end) as sb from z),
x as (select feature_id, sum(case when barcode_id % 2 = 0 then value else 0 end)::bigint as sum_a, sum(case when barcode_id % 2 = 1 then value else 0 end)::bigint as sum_b from coo group by 1)
select feature_id, sum_a, sum_b, round(log2((1 + sum_a) / (1 + sa)) - log2((1 + sum_b) / (1 + sb)), 6) as log2_ratio from x, t""")
def group_sums(spark, d):
    m = derived(spark, d, "coo")
    g = m.select("barcode_id").distinct().withColumn("in_group", F.col("barcode_id") % 2 == 0)
    return rounded(inference.sum_test(m, g).drop("p_value", "adjusted"), "log2_ratio")


@query()
def sum_test_features(spark, d):
    m = derived(spark, d, "coo")
    return inference.sum_test(m, m.select("barcode_id").distinct().withColumn("in_group", F.col("barcode_id") % 2 == 0))


@query("""with e as (select vec_id, embedding::double[] as v, label from embeddings), p as (select a.vec_id as src, b.vec_id as dst, a.label as la, b.label as lb, list_distance(a.v, b.v) as dist from e a, e b where a.vec_id <> b.vec_id),
k as (select * from p qualify row_number() over (partition by src order by dist, dst) <= 5), s as (select label, count(*) / (select count(*) from e)::double as share from e group by 1),
q as (select src, la, avg(case when la = lb then 1.0 else 0.0 end) as same from k group by 1, 2) select round(avg(same / share), 6) as score from q join s on s.label = la""")
def batch_mixing(spark, d):
    e = table(spark, d, "embeddings")
    return rounded(graph.batch_mixing(graph.nearest(e, "vec_id", "embedding", 5).select("src", "dst"), e.select(F.col("vec_id").alias("node"), F.col("label").alias("batch"))), "score")


_GRAPH = "g as (select c_custkey as src, c_nationkey + 100000 as dst, count(*) as w from customer group by 1, 2)"


@query(f"""with {_GRAPH}, n as (select node, row_number() over (order by node) - 1 as k from (select src as node from g union select dst from g)) select a.k as src, b.k as dst, w from g join n a on a.node = src join n b on b.node = dst""")
def renumbered_graph(spark, d):
    return graph.renumbered(customer_graph(spark, d))[0]


@query(f"""with {_GRAPH}, b as (select src, dst, w from g union all select dst, src, w from g) select src % 10 as src, dst % 10 as dst, sum(w)::bigint as w from b group by 1, 2""")
def contracted_graph(spark, d):
    both = graph.symmetric(customer_graph(spark, d))
    return graph.contracted(both, both.select(F.col("src").alias("node"), (F.col("src") % 10).alias("community")).distinct())


def customer_graph(spark, d):
    return table(spark, d, "customer").groupBy(F.col("c_custkey").alias("src"), (F.col("c_nationkey") + 100000).cast("long").alias("dst")).agg(F.count("*").alias("w"))
