"""Queries on contigs, barcodes as cells, and mergeable summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequence as seq
from ..functions import summaries as su
from ..operators import cells, contigs, matrix
from ..operators import fragments as fr
from .catalog import _SEQ, _seqs, frag, query, rounded, table
from .fixtures import cte, derived

#: A genome of five contigs; the last is no primary one, the fourth a sex chromosome.
_CONTIGS = [("chr1", 0, 1_000_000, "a", True, False), ("chr2", 1, 900_000, "a", True, False), ("chr3", 2, 800_000, "b", True, False), ("chr4", 3, 700_000, "b", True, True), ("chr5", 4, 600_000, "a", False, False), ("chrM", 5, 16_000, "a", False, False)]
_CONTIG_CTE = "contigs(contig, idx, length, species, is_primary, is_sex) as (values " + ", ".join(f"('{c}', {i}, {n}::bigint, '{s}', {p}, {x})" for c, i, n, s, p, x in _CONTIGS) + ")"


def genome(spark):
    return spark.createDataFrame(_CONTIGS, "contig string, idx int, length long, species string, is_primary boolean, is_sex boolean")


# --- contigs


@query(f"with {cte('frag')}, {_CONTIG_CTE} select f.* from frag f join contigs c using (contig) where is_primary and not is_sex")
def primary_fragments(spark, d):
    return contigs.on_primary(frag(spark, d), genome(spark))


@query(f"with {cte('frag')}, {_CONTIG_CTE} select coalesce(c.is_primary and c.species = 'b', false) as is_primary, count(*) as n from frag f left join contigs c using (contig) group by 1")
def primary_flags(spark, d):
    return contigs.with_primary(frag(spark, d), genome(spark), species="b", sex=True).groupBy("is_primary").agg(F.count("*").alias("n"))


@query("""select n_name as name, case when n_nationkey % 3 = 0 then 'hg19' when n_nationkey % 3 = 1 then 'mm10' end as species,
case when n_nationkey % 3 = 2 then 'other_' || n_name else n_name end as bare from nation""")
def contig_species(spark, d):
    n = table(spark, d, "nation")
    full = F.concat(F.get(F.array(F.lit("hg19_"), F.lit("mm10_"), F.lit("other_")), F.col("n_nationkey") % 3), "n_name")
    both = ["hg19", "mm10"]
    return n.select(F.col("n_name").alias("name"), contigs.species_of(full, both).alias("species"), contigs.without_species(full, both).alias("bare"))


@query("""with n as (select o_orderkey, ['chr1', '2', 'chrMT', 'M', 'chrX', 'chrUn_7', 'X'][1 + (o_orderkey % 7)::int] as raw from orders)
select o_orderkey, case raw when 'chr1' then 'chr1' when '2' then 'chr2' when 'chrMT' then 'chrM' when 'M' then 'chrM' when 'chrX' then 'X' when 'X' then 'X' end as contig from n where raw <> 'chrUn_7'""")
def clean_contigs(spark, d):
    raw = F.get(F.array(*[F.lit(x) for x in ("chr1", "2", "chrMT", "M", "chrX", "chrUn_7", "X")]), (F.col("o_orderkey") % 7).cast("int"))
    return contigs.cleaned(table(spark, d, "orders").select("o_orderkey", raw.alias("contig")), ["chr1", "chr2", "chrM", "X"])


@query(f"with {cte('frag')}, {_CONTIG_CTE} select contig from contigs where contig not in (select contig from frag)")
def unseen_contigs(spark, d):
    return contigs.unseen(frag(spark, d), genome(spark))


@query(f"with {cte('track')}, {_CONTIG_CTE} select t.*, idx from track t join contigs using (contig)")
def reference_order(spark, d):
    return contigs.in_order(derived(spark, d, "track"), genome(spark))


@query(f"with {cte('frag')}, {_CONTIG_CTE}, o as (select contig, coalesce(sum(length) over (order by idx rows between unbounded preceding and 1 preceding), 0)::bigint as off from contigs) select f.*, (start + off) % 2147483647 as global_pos from frag f join o using (contig)")
def global_positions(spark, d):
    return contigs.global_position(frag(spark, d), genome(spark), "start")


_PAIRS = f"""with {cte('reads')}, p as (select *, (ref_id + (case when qname % 11 = 0 then 1 else 0 end)) % 5 as mate_ref, qname % 2 = 0 as rev, (qname // 3) % 2 = 0 as mate_rev from reads)"""


def pairs(spark, d):
    r = derived(spark, d, "reads")
    return r.withColumns({"mate_ref": (F.col("ref_id") + F.when(F.col("qname") % 11 == 0, 1).otherwise(0)) % 5, "rev": F.col("qname") % 2 == 0, "mate_rev": F.expr("qname div 3") % 2 == 0})


@query(f"{_PAIRS} select chim, count(*) as n from (select ref_id <> mate_ref or abs(pos - mate_pos) > 3 or rev = mate_rev or (case when rev then pos < mate_pos else pos > mate_pos end) as chim from p) group by 1")
def chimeric_pairs(spark, d):
    c = [F.col(x) for x in ("ref_id", "mate_ref", "pos", "mate_pos", "rev", "mate_rev")]
    return pairs(spark, d).select(contigs.chimeric(*c, far=3).alias("chim")).groupBy("chim").agg(F.count("*").alias("n"))


@query(f"{_PAIRS} select qname, pos, count(*) as n from p where mapq >= 30 and not rev and pos % 2 = 1 and abs(mate_pos - pos) >= 2 and qname % 5 <> 0 group by 1, 2")
def stringent_reads(spark, d):
    bc = F.when(F.col("qname") % 5 != 0, F.col("barcode"))
    keep = contigs.stringent(F.col("mapq"), F.col("rev"), bc, F.col("pos") % 2, F.col("mate_pos") - F.col("pos"), 2)
    return pairs(spark, d).where(keep).groupBy("qname", "pos").agg(F.count("*").alias("n"))


_GENES = """g as (select concat('chr', cast(p_partkey % 7 as varchar)) as contig, case p_size % 4 when 0 then 'transcript' when 1 then 'mRNA' else 'exon' end as type,
concat('T', cast(p_partkey as varchar), case when p_size % 8 = 0 then '_PAR_Y' else '' end) as transcript_id, case p_partkey % 3 when 0 then 'protein_coding' when 1 then 'IG_C_gene' else 'lincRNA' end as gene_type from part)"""


def genes(spark, d):
    p, size, key = table(spark, d, "part"), F.col("p_size"), F.col("p_partkey")
    kind = F.when(size % 4 == 0, "transcript").when(size % 4 == 1, "mRNA").otherwise("exon")
    name = F.concat(F.lit("T"), key.cast("string"), F.when(size % 8 == 0, "_PAR_Y").otherwise(""))
    gene = F.when(key % 3 == 0, "protein_coding").when(key % 3 == 1, "IG_C_gene").otherwise("lincRNA")
    return p.select(F.concat(F.lit("chr"), (key % 7).cast("string")).alias("contig"), kind.alias("type"), name.alias("transcript_id"), gene.alias("gene_type"))


@query(f"with {_GENES}, {_CONTIG_CTE} select g.* from g where type in ('transcript', 'mRNA') and transcript_id not like '%\\_PAR\\_Y' escape '\\' and contig in (select contig from contigs)")
def valid_transcripts(spark, d):
    return contigs.valid_transcripts(genes(spark, d), genome(spark))


@query(f"with {_GENES} select gene_type, count(*) as n from g where gene_type in ('protein_coding', 'IG_C_gene') group by 1")
def annotated_gene_types(spark, d):
    return contigs.kept_gene_types(genes(spark, d)).groupBy("gene_type").agg(F.count("*").alias("n"))


@query("""select p_partkey, case when p_size % 3 = 0 then 'Promoter_flank' when p_size % 3 = 1 then 'CTCF Binding Site' else 'Open chromatin' end as element, case when p_size % 3 = 0 then 'promoter' when p_size % 3 = 1 then 'ctcf' else 'enhancer' end as track from part""")
def regulatory_tracks(spark, d):
    size = F.col("p_size") % 3
    e = table(spark, d, "part").select("p_partkey", F.when(size == 0, "Promoter_flank").when(size == 1, "CTCF Binding Site").otherwise("Open chromatin").alias("element"))
    return contigs.routed(e)


# --- cells


_CLASSES = f"""with {cte('reads')}, c as (select barcode, case when mapq <= 30 then 'lowmapq' when ref_id = 4 then 'mitochondrial' when abs(mate_pos - pos) > 2 then 'chimeric' when qname % 7 = 0 then 'duplicate' else 'passed_filters' end as class from reads)"""


def classes(spark, d):
    r = derived(spark, d, "reads")
    return fr.classify(r, F.col("mapq"), F.col("mapq"), F.col("ref_id") == 4, F.abs(F.col("mate_pos") - F.col("pos")) > 2, F.col("qname") % 7 == 0)


@query(_CLASSES + " select barcode, count(*) as total, " + ", ".join(f"count(case when class = '{c}' then 1 end) as {c}" for c in cells.COUNTERS[1:]) + " from c group by 1")
def mapping_counters(spark, d):
    return cells.mapping_counters(classes(spark, d))


@query(_CLASSES + " select barcode, 2 * count(*)::bigint as total, " + ", ".join(f"(2 * count(case when class = '{c}' then 1 end))::bigint as {c}" for c in cells.COUNTERS[1:]) + " from c group by 1")
def merged_counters(spark, d):
    one = cells.mapping_counters(classes(spark, d))
    return cells.added(one.unionByName(one))


_PROFILE = f"""with {cte('frag', 'tss')}, s as (select f.start - t.start as o, strand from frag f join tss t on f.contig = t.contig and f.start between t.start - 2000 and t.start + 2000
union all select f.stop - t.start, strand from frag f join tss t on f.contig = t.contig and f.stop between t.start - 2000 and t.start + 2000), h as (select case when strand = '-' then -o else o end as "offset", count(*) as n from s group by 1)"""


def profile(spark, d):
    return fr.relative_positions(fr.cut_sites(frag(spark, d)), derived(spark, d, "tss"), 2000)


@query(f'{_PROFILE} select round(max(n) / min(case when n > 0 then n end)::double, 6) as score from h where abs("offset") <= 1000')
def tss_score(spark, d):
    return rounded(cells.site_score(profile(spark, d)), "score")


@query(f'{_PROFILE} select round((coalesce(max(case when "offset" = -23 then n end), 0) + coalesce(max(case when "offset" = 34 then n end), 0) - coalesce(max(case when "offset" = -3 then n end), 0)) / max(n)::double, 6) as score from h')
def ctcf_score(spark, d):
    return rounded(cells.footprint_score(profile(spark, d)), "score")


_COUNTS = f"with {cte('frag')}, b as (select barcode, count(*) as n from frag group by 1)"


def counts(spark, d):
    return frag(spark, d).groupBy("barcode").agg(F.count("*").alias("n"))


@query(f"{_COUNTS} select n % 2 = 0 as is_cell, round(avg(n), 6) as mean, median(n)::double as median, min(n) as least, round(stddev_pop(n), 6) as deviation from b group by 1")
def sensitivity_metrics(spark, d):
    return rounded(cells.sensitivity(counts(spark, d).withColumn("cell", F.col("n") % 2 == 0), "n", "cell"), "mean", "deviation")


_CALLS = f"{_COUNTS}, c as (select barcode, 'a' as species, n from b where n % 3 <> 0 union all select barcode, 'b', n from b where n % 2 = 0)"


def calls(spark, d):
    n = counts(spark, d)
    return n.where("n % 3 <> 0").select("barcode", F.lit("a").alias("species"), "n").unionByName(n.where("n % 2 = 0").select("barcode", F.lit("b").alias("species"), "n"))


@query(f"{_CALLS} select count(*) as calls, (count(*) - count(distinct barcode))::bigint as doublets, round((count(*) - count(distinct barcode)) / count(distinct barcode)::double, 6) as rate from c")
def observed_doublets(spark, d):
    return rounded(cells.observed_doublets(calls(spark, d)), "rate")


@query(f"{_CALLS}, i as (select *, concat(species, '_cell_', (row_number() over (partition by species order by barcode) - 1)::varchar) as name from c) select barcode, string_agg(name, '_' order by name) as cell from i group by 1")
def cell_names(spark, d):
    return cells.cell_names(calls(spark, d))


@query(f"""{_CALLS}, k as (select species, count(*)::double as c, sum(n)::double as f, median(n)::double as m from c group by 1)
select concat('cells_', species) as metric, c as value from k union all select concat('fragments_', species), f from k union all select concat('median_fragments_', species), m from k""")
def call_metrics(spark, d):
    return cells.call_metrics(calls(spark, d).withColumn("is_cell", F.lit(True)))


@query(f"{_CALLS}, u as (select species, replace(barcode, '-1', '') as bare from c) select species, concat(bare, '-1') as barcode from u union select species, concat(bare, '-2') from u where species = 'b'")
def cell_union(spark, d):
    c = calls(spark, d)
    return cells.united([(1, c), (2, c.where("species = 'b'"))])


@query(f"{_CALLS} select species, barcode from c")
def cells_of_table(spark, d):
    flags = counts(spark, d).select("barcode", (F.col("n") % 3 != 0).cast("int").alias("is_a_cell_barcode"), (F.col("n") % 2 == 0).cast("int").alias("is_b_cell_barcode"))
    return cells.cell_barcodes(flags, ["a", "b"])


@query(f"{_COUNTS} select 'repeated barcode' as problem, count(*) as n from b union all select 'no flag in is_a_cell_barcode', 2 * count(case when n % 3 = 2 then 1 end) from b where n % 3 = 2 having count(*) > 0 union all select 'too many groups', 2")
def table_problems(spark, d):
    one = counts(spark, d).select("barcode", (F.col("n") % 3).alias("is_a_cell_barcode"))
    again = one.withColumn("barcode", F.regexp_replace("barcode", "-1$", "-2"))
    return cells.format_problems(one.unionByName(one).unionByName(again.limit(0)).unionByName(spark.createDataFrame([("X-2", 1)], "barcode string, is_a_cell_barcode long")), ["a"])


@query(f"{_COUNTS} select * from b where n >= (select min(n) from (select n from b order by n desc limit 50))")
def forced_cells(spark, d):
    return cells.forced(counts(spark, d), 50)


@query(f"{_COUNTS} select * from b where n >= (select greatest(1, round(quantile_cont(n, 0.99) * 0.95)) from (select n from b order by n desc limit 100))")
def magnitude_cells(spark, d):
    return cells.by_magnitude(counts(spark, d), 100, share=0.95)


@query(f"{_COUNTS} select * from b order by n desc, barcode limit 40")
def fixed_cells(spark, d):
    return cells.largest(counts(spark, d), 40)


@query(f"{_COUNTS} select * from b where barcode in (select distinct concat('BC', lpad(cast(c_custkey % 97 as varchar), 4, '0'), '-1') from customer)")
def listed_cells(spark, d):
    given = table(spark, d, "customer").select(F.concat(F.lit("BC"), F.lpad((F.col("c_custkey") % 97).cast("string"), 4, "0"), F.lit("-1")).alias("barcode"))
    return cells.listed(counts(spark, d), given)


@query(f"""{_COUNTS}, s as (select greatest(5, floor(sum(n) * 0.02 / 1000))::bigint as shift from b), l as (select barcode, n - shift as m from b, s where n > shift and barcode <> 'BC0007-1'),
k as (select barcode from l where m >= (select quantile_disc(n, 0.5) - (select shift from s) from b)) select barcode, n, barcode in (select barcode from k) as is_cell from b""")
def called_cells(spark, d):
    b = counts(spark, d)
    shift = cells.depth_shift(b, 1000)
    cut = b.agg(F.expr("percentile_disc(0.5) within group (order by n)")).first()[0] - shift
    return cells.called(b, int(cut), spark.createDataFrame([("BC0007-1",)], "barcode string"), 1000)


@query(f"{_COUNTS} select * from b where n > 20 qualify row_number() over (partition by substr(barcode, 6, 1) order by n desc, barcode) <= 5")
def bead_candidates(spark, d):
    return cells.bead_candidates(counts(spark, d), F.substring("barcode", 6, 1), 20, 5)


@query(f"{_COUNTS} select count(*) as cells, 7 as excluded, round(7 / (count(*) + 7)::double, 6) as rate from b")
def bead_metrics(spark, d):
    b = counts(spark, d)
    return rounded(cells.bead_metrics(b, b.orderBy("barcode").limit(7)), "rate")


@query(f"{_COUNTS}, a as (select barcode, sum(case when contig = 'chr1' then 1 else 0 end) as own, sum(case when contig = 'chr2' then 1 else 0 end) as other from frag group by 1) select round(median(own / (own + other)::double), 6) as purity from a where own + other > 0")
def species_purity(spark, d):
    b = frag(spark, d).groupBy("barcode").agg(F.count_if(F.col("contig") == "chr1").alias("own"), F.count_if(F.col("contig") == "chr2").alias("other"))
    return rounded(b.agg(cells.purity(F.col("own"), F.col("other")).alias("purity")), "purity")


@query(_CLASSES + ", k as (select barcode, count(*) as total, count(case when class = 'lowmapq' then 1 end) as lowmapq, count(case when class = 'duplicate' then 1 end) as duplicate, count(case when class = 'passed_filters' then 1 end) as passed from c group by 1) select barcode, round(lowmapq / total::double, 6) as low_share, case when duplicate = 0 then null else round(passed / duplicate::double, 6) end as passed_per_duplicate from k")
def read_fractions(spark, d):
    k = cells.fractions(cells.mapping_counters(classes(spark, d)), {"low_share": ("lowmapq", "total"), "passed_per_duplicate": ("passed_filters", "duplicate")})
    return rounded(k.select("barcode", "low_share", "passed_per_duplicate"), "low_share", "passed_per_duplicate")


_LIBRARIES = "l as (select o_orderpriority as library, sum(o_orderkey % 1000)::bigint as reads, count(*) as cells from orders group by 1)"


@query(f"with {_LIBRARIES} select library, depth, round(depth / (reads / cells::double), 6) as rate from l, (select unnest([100, 400, 600]) as depth) where depth <= reads / cells::double")
def sampling_plan(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("library")).agg(F.sum(F.col("o_orderkey") % 1000).alias("reads"), F.count("*").alias("cells"))
    return rounded(cells.sampling_plan(o, [100, 400, 600]), "rate")


@query(f"{_COUNTS} select sum(n)::bigint as reads, sum(case when substr(barcode, 6, 1) <> '3' then n else 0 end)::bigint as on_list, round(sum(case when substr(barcode, 6, 1) <> '3' then n else 0 end) / sum(n)::double, 6) as share from b")
def whitelist_share(spark, d):
    b = counts(spark, d)
    return rounded(cells.whitelist_share(b, b.where("substr(barcode, 6, 1) <> '3'")), "share")


@query(f"""{_COUNTS}, q as (select sum(n)::bigint as reads, sum(case when substr(barcode, 6, 1) <> '3' then n else 0 end)::bigint as exact, sum(case when barcode = 'BC0003-1' then n else 0 end)::bigint as corrected from b)
select *, round(exact / reads::double, 6) as exact_share, round(corrected / reads::double, 6) as corrected_share from q""")
def barcode_quality(spark, d):
    b = counts(spark, d)
    fixed = spark.createDataFrame([("BC0003-1", "BC0004-1"), ("BC0001-1", "BC0001-1")], "barcode string, corrected string")
    return rounded(cells.barcode_quality(b, fixed, b.where("substr(barcode, 6, 1) <> '3'")), "exact_share", "corrected_share")


# --- matrices by attributes


@query(f"with {cte('coo')} select coo.* from coo join part on p_partkey = feature_id where p_brand = 'Brand#23'")
def select_feature_type(spark, d):
    return matrix.select_by(derived(spark, d, "coo"), table(spark, d, "part").select(F.col("p_partkey").alias("feature_id"), "p_brand"), "feature_id", F.col("p_brand") == "Brand#23")


@query(f"with {cte('coo')} select * from coo where barcode_id % 7 = 0 or barcode_id % 5 = 0")
def filter_barcode_sets(spark, d):
    m = derived(spark, d, "coo")
    ids = m.select("barcode_id").distinct()
    return matrix.filter_barcodes(m, [ids.where("barcode_id % 7 = 0"), ids.where("barcode_id % 5 = 0")])


@query(f"with {cte('coo')} select feature_id, count(*) as n from coo where value >= 2 and barcode_id % 2 = 0 group by 1")
def counts_at_least(spark, d):
    return matrix.count_at_least(derived(spark, d, "coo"), 2, "feature_id", F.col("barcode_id") % 2 == 0).where("n > 0")


@query(f"with {cte('coo')}, f as (select max(feature_id) as top from coo) select feature_id, barcode_id, value from coo union all select feature_id + top, barcode_id, 2 * value from coo, f where feature_id % 9 = 0")
def stacked_features(spark, d):
    m = derived(spark, d, "coo")
    return matrix.stacked(m, m.where("feature_id % 9 = 0").withColumn("value", F.col("value") * 2))


@query(f"with {cte('coo')}, g as (select p_partkey as feature_id, (p_size % 11) / 10.0::double as gc from part) select barcode_id, round(sum(gc * value) / sum(value), 6) as gc from coo join g using (feature_id) group by 1")
def mean_gc(spark, d):
    g = table(spark, d, "part").select(F.col("p_partkey").alias("feature_id"), (F.col("p_size") % 11 / 10).alias("gc"))
    return rounded(matrix.weighted_mean(derived(spark, d, "coo"), g, "gc"), "gc")


@query("""with f as (select p_partkey as feature_id, p_name as id, 'Peaks' as kind from part where p_partkey % 2 = 0 union all select p_partkey, p_name || '_m', 'Motifs' from part where p_partkey % 2 = 1) select id, kind, row_number() over (order by kind desc, feature_id) - 1 as feature_id from f""")
def joined_features(spark, d):
    p = table(spark, d, "part")
    a = p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("feature_id"), F.col("p_name").alias("id"), F.lit("Peaks").alias("kind"))
    b = p.where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("feature_id"), F.concat("p_name", F.lit("_m")).alias("id"), F.lit("Motifs").alias("kind"))
    return matrix.join_features(a, b)


# --- summaries


@query("select event_type, floor(value / 50)::bigint as value, count(*) as n, round(sum(count(*)) over (partition by event_type order by floor(value / 50)::bigint) / sum(count(*)) over (partition by event_type), 6) as share from events group by 1, 2")
def value_distribution(spark, d):
    e = table(spark, d, "events").withColumn("v", F.floor(F.col("value") / 50))
    return rounded(su.ecdf(su.distribution(e, "v", "event_type"), "event_type"), "share")


@query("with v as (select event_type, floor(value / 50)::bigint as v from events) select event_type, round(quantile_cont(v, 0.5), 6) as median, round(quantile_cont(v, 0.75) - quantile_cont(v, 0.25), 6) as iqr from v group by 1")
def median_and_iqr(spark, d):
    e = table(spark, d, "events").withColumn("v", F.floor(F.col("value") / 50))
    return rounded(su.spread(su.distribution(e, "v", "event_type"), "event_type"), "median", "iqr")


@query("with v as (select l_linenumber * 3 as v from lineitem) select round(quantile_cont(v, 0.9), 6) as percentile from v")
def counter_percentile(spark, d):
    li = table(spark, d, "lineitem").withColumn("v", F.col("l_linenumber") * 3)
    return rounded(su.percentile(su.distribution(li, "v"), 0.9), "percentile")


@query("with v as (select l_quantity::bigint as v, row_number() over (order by l_quantity) - 1 as k, count(*) over () as n from lineitem) select min(case when k = n // 4 then v end) as low, min(case when k = n - 1 - n // 4 then v end) as high, min(case when k = n - 1 - n // 4 then v end) - min(case when k = n // 4 then v end) as width from v")
def index_spread(spark, d):
    li = table(spark, d, "lineitem").withColumn("v", F.col("l_quantity").cast("long"))
    return su.index_spread(su.distribution(li, "v"))


@query("select case when value >= 200 then 200 when value >= 50 then 50 when value >= 0 then 0 end as bin, count(*) as n, round(avg(value), 5) as mean from events group by 1")
def binned_metric(spark, d):
    return rounded(su.binned(table(spark, d, "events"), "value", [0, 50, 200], F.count("*").alias("n"), F.avg("value").alias("mean")), "mean", digits=5)


@query("select event_type as kind, count(*) as n from events group by 1 union all select o_orderpriority, count(*) from orders group by 1")
def merged_distributions(spark, d):
    a = table(spark, d, "events").groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("n"))
    b = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("kind")).agg(F.count("*").alias("n"))
    return su.merged([a, b.where("kind < '3'"), b.where("kind >= '3'")], "kind")


@query("select o_orderpriority as a, o_orderstatus as b, sum(o_orderkey)::bigint as v from orders group by 1, 2")
def nested_addition(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("a"), F.col("o_orderstatus").alias("b"), F.col("o_orderkey").alias("v"))
    return su.nested_add([o.where("v % 2 = 0"), o.where("v % 2 = 1")], ["a", "b"], "v")


@query("select count(*) as distinct from (select o_custkey from orders group by 1 having sum(o_orderkey % 3 - 1) <> 0)".replace("as distinct", 'as "distinct"'))
def distinct_keys(spark, d):
    return su.count_distinct_keys(table(spark, d, "orders").withColumn("v", F.col("o_orderkey") % 3 - 1), "o_custkey", "v")


@query("select user_id, count(*) as n from events group by 1 order by n desc, user_id limit 10")
def top_keys(spark, d):
    return su.top(table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n")), "user_id", 10)


@query("select event_type, count(*) as n, count(distinct user_id) as users, round(max(value), 6) as top from events group by 1")
def summary_set(spark, d):
    return rounded(su.summary(table(spark, d, "events"), {"n": F.count("*"), "users": F.count_distinct("user_id"), "top": F.max("value")}, "event_type"), "top")


@query("select event_type, round(max(value) + ln(sum(exp(value - m))), 5) as log_sum from (select *, max(value) over (partition by event_type) as m from events) group by event_type")
def log_sums(spark, d):
    return rounded(su.log_sum_exp(table(spark, d, "events"), "value", "event_type"), "log_sum", digits=5)


@query("select l_linenumber, round(pow(10, -l_linenumber / 10.0), 8) as error, round(-10 * log10(pow(10, -l_linenumber / 10.0)), 6) as quality, round(ln(1 - exp(-l_linenumber)), 8) as log_rest, round(l_linenumber / 1.3489795003921634, 6) as deviation from (select distinct l_linenumber from lineitem)")
def quality_transforms(spark, d):
    n = table(spark, d, "lineitem").select("l_linenumber").distinct()
    e = su.error_of(F.col("l_linenumber"))
    out = n.select("l_linenumber", e.alias("error"), su.quality_of(1 - e).alias("quality"), su.log_one_minus(-F.col("l_linenumber").cast("double")).alias("log_rest"), su.deviation_from_iqr(F.col("l_linenumber")).alias("deviation"))
    return rounded(rounded(out, "error", "log_rest", digits=8), "quality", "deviation")


@query("select round(corr(l_quantity, l_extendedprice), 6) as pearson from lineitem")
def pearson(spark, d):
    return rounded(table(spark, d, "lineitem").agg(F.corr("l_quantity", "l_extendedprice").alias("pearson")), "pearson")


@query(f"""with q as ({_SEQ.format(s='varchar')}), k as (select substr(seq, i, 3) as seq, count(*) as n from q, (select unnest(range(1, 15)) as i) group by 1),
a as (select a || b || c as seq from (select unnest(['A','C','G','T']) as a), (select unnest(['A','C','G','T']) as b), (select unnest(['A','C','G','T']) as c)) select seq, coalesce(n, 0) as n from a left join k using (seq)""")
def all_sequences(spark, d):
    """How often each sequence of three bases stands in the parts' sequences."""
    words = F.explode(F.transform(F.sequence(F.lit(1), F.length("seq") - 2), lambda i: F.col("seq").substr(i, F.lit(3)))).alias("seq")
    seen = _seqs(spark, d).select(words).groupBy("seq").agg(F.count("*").alias("n"))
    return seq.all_sequences(spark, 3).join(seen, "seq", "left").fillna(0, ["n"])


@query(f"{_COUNTS} select substr(barcode, 3, 2) as part, string_agg(distinct substr(barcode, 5, 2), ',' order by substr(barcode, 5, 2)) as rest from b group by 1")
def unique_parts(spark, d):
    b = counts(spark, d).select(F.substring("barcode", 3, 2).alias("part"), F.substring("barcode", 5, 2).alias("r"))
    return b.groupBy("part").agg(F.array_join(F.array_sort(F.collect_set("r")), ",").alias("rest"))
