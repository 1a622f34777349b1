"""Interval tables derived from the plain test tables, for both engines.

Each function gives a DataFrame; ``CTE`` holds the same as DuckDB common table
expressions.  All arithmetic is on integers, so both agree exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_MIX = "((l_partkey*7919+l_orderkey*104729+l_linenumber*31)%997)"
_CUBE = f"({_MIX}*{_MIX}*{_MIX})"

FRAG = f"""select concat('chr', cast(l_suppkey%5+1 as {{s}})) as contig, {_CUBE} {{div}} 1000 as start,
  {_CUBE} {{div}} 1000 + 20 + (l_orderkey*31+l_linenumber*17)%780 as stop,
  concat('BC', lpad(cast(l_orderkey%211 as {{s}}),4,'0'),'-1') as barcode, 1+l_linenumber%3 as dup from lineitem"""
TSS = """select concat('chr', cast(p_partkey%5+1 as {s})) as contig, (p_partkey*4973)%980000 as start, (p_partkey*4973)%980000+1 as "end", p_name as name,
  case when p_size%2=0 then '+' else '-' end as strand from part"""
TRACK = """select concat('chr', cast(s_suppkey%5+1 as {s})) as contig, (s_suppkey*7907)%950000 as start, (s_suppkey*7907)%950000 + 500 + (s_suppkey*37)%2500 as "end",
  concat('track', cast(s_nationkey%4 as {s})) as track from supplier"""
COO = "select l_partkey as feature_id, l_orderkey%211 as barcode_id, count(*) as value from lineitem group by 1,2"
READS = """select l_orderkey as qname, concat('BC', lpad(cast(l_orderkey%211 as {s}),4,'0'),'-1') as barcode, l_suppkey%5 as ref_id, l_partkey%300 as pos,
  l_suppkey%5 as mate_ref_id, l_partkey%300+l_linenumber as mate_pos, 60 - (l_quantity::int)%50 as mapq from lineitem"""
TABLES = {"frag": (FRAG, "lineitem"), "tss": (TSS, "part"), "track": (TRACK, "supplier"), "coo": (COO, "lineitem"), "reads": (READS, "lineitem")}


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql, base = TABLES[name]
    sql = sql.format(s="string", div="div") if "{" in sql else sql
    sql = sql.replace('"end"', "`end`").replace("l_quantity::int", "cast(l_quantity as int)")
    return spark.sql(sql.replace(f"from {base}", "from {base}"), base=spark.read.parquet(f"{sf_dir}/{base}.parquet"))


def cte(*names: str) -> str:
    """The named tables as the head of a WITH clause, without the word."""
    return ",\n".join(f"{n} as ({TABLES[n][0].format(s='varchar', div='//')})" for n in names)


#: DuckDB: the step function, and the peaks at depth 30.
DEPTH_SQL = """ev as (select contig, unnest([greatest(start-200,0), greatest(stop-200,0), start+201, stop+201]) as pos, unnest([1,1,-1,-1]) as d from frag),
ag as (select contig, pos, sum(d) as d from ev group by 1,2 having sum(d)<>0),
steps as (select contig, pos, lead(pos) over w as next_pos, sum(d) over w as depth from ag window w as (partition by contig order by pos))"""
PEAKS_SQL = """hi as (select contig, pos as s, next_pos as e from steps where depth>=30 and next_pos is not null),
fl as (select *, case when s-500 <= max(e) over (partition by contig order by s rows between unbounded preceding and 1 preceding) then 0 else 1 end as f from hi),
isl as (select *, sum(f) over (partition by contig order by s) as g from fl),
peaks as (select contig, min(s) as start, max(e) as "end" from isl group by contig, g)"""
