"""The queries of this subpackage, one for each operator, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fim, line_rules, lloyd, lm_score, packing, partenum, quality_cnn, secrets, shards, simhash, tokenfile, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign(_table(spark, sf_dir, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(_table(spark, sf_dir, "documents"))


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op9_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.report(_table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokenfile.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.report(_table(spark, sf_dir, "documents"))


def op12_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.clusters(_table(spark, sf_dir, "embeddings"))


def op13_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.join(_table(spark, sf_dir, "documents"))


def queries() -> dict:
    found = (op1_simhash, op2_decontaminate, op3_quality, op4_warc, op5_shards, op6_lm_score, op7_pack, op8_secrets, op9_line_rules, op10_token_files, op11_fim, op12_lloyd, op13_partenum)
    return {f.__name__: f for f in found}


OP2_SQL = r"""
with lowered as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
dw as (select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from lowered),
bw as (
  select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
bg as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as gram
  from (select item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) as i from bw where len(w) > 0)),
ns as (select distinct n from bg),
win as (select r, n, unnest(generate_series(1, len(w) - n + 1)) as i from dw, ns where len(w) >= n),
hit as (select win.r, win.n, win.i, bg.item_id from win join dw using (r) join bg on bg.n = win.n and bg.gram = array_to_string(dw.w[win.i:win.i + win.n - 1], ' ')),
words as (select r, count(distinct p) as n_hit from (select r, unnest(generate_series(i, i + n - 1)) as p from hit) group by r),
items as (select r, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from hit group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join words using (r) left join items using (r)
"""

OP4_SQL = """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, cast(strlen(h) as bigint) as payload_bytes, sha1(h) as payload_digest from p),
m as (select *, max(page_id) over (partition by payload_digest) as top from d)
select page_id, payload_bytes, payload_digest, case when payload_bytes >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id <> top then top end as refers_to
from m
"""


OP9_SQL = r"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols from d),
g as (select r, i, array_to_string(w[i:i + 7], ' ') as g from (select r, w, unnest(range(1, len(w) - 6)) as i from w where len(w) >= 8)),
again as (select r, i from g qualify count(*) over (partition by r, g) > 1),
rep as (select r, count(distinct p) as n from (select r, unnest(range(i, i + 8)) as p from again) group by r),
l as (select r, i, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as n from (select r, unnest(string_split(t, chr(10))) as line, generate_subscripts(string_split(t, chr(10)), 1) as i from d)),
m as (select r, i, n > 3 or regexp_matches(line, '[.!?…:;,。！？]["''”’»)\]]*[\x20\x09-\x0D]*$') as solid from l where n > 0),
u as (select r, i, solid, sum(solid::int) over (partition by r order by i) as run from m),
menu as (select r, i from u where not solid qualify count(*) over (partition by r, run) >= 5),
k as (select l.*, n = 0 or not (menu.i is not null or
    len(regexp_extract_all(line, '[\x20\x09-\x0D][|»›>•][\x20\x09-\x0D]')) >= 2
    or (n <= 30 and regexp_matches(line, '(?i)PHRASES'))
    or len(regexp_extract_all(line, '[#*$%&|<>]')) > 0.3 * n or (n >= 4 and len(regexp_extract_all(line, '!!')) > 0.3 * n)
    or not (n <= 12 or regexp_matches(line, '[.!?…:;。！？]["''”’»)\]]*[\x20\x09-\x0D]*$') or regexp_matches(line, '[.!?…]["''”’»)\]]*[\x20\x09-\x0D]+[^\x20\x09-\x0D|»›>•]'))
  ) as good, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) as chars from l left join menu using (r, i)),
s as (select r, sum(chars) as word_chars, sum(case when good then chars else 0 end) as kept_chars, count(case when n > 0 then 1 end) - count(distinct case when n > 0 then line end) as n_dup_lines from k group by r),
f as (select doc_id, len(w)::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines, coalesce(rep.n, 0)::bigint as n_repeat_words, kept_chars
  from d join w using (r) join s using (r) left join rep using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and kept_chars >= 0.5 * word_chars as kept from f
""".replace("PHRASES", "|".join(line_rules.PHRASES))


#: Places are found in the text by the tokens' lengths, and the text is put together from substrings.
OP11_SQL = r"""
with d as (select row_number() over () as r, coalesce(cast(doc_id as varchar), 'null') as id, doc_id, coalesce(text, '') as t from documents),
h as (select r, doc_id, t, len(regexp_replace(t, '[A-Za-z]+', 'x', 'g')) as n, sha256(concat('1:', id)) as h from d),
u as (select *, [('0x' || h[8 * k + 1:8 * k + 8])::ubigint for k in range(4)] as u from h),
c as (select *, least(u[1] % (n + 1), u[2] % (n + 1)) as lo, greatest(u[1] % (n + 1), u[2] % (n + 1)) as hi,
  case when t = '' or regexp_matches(t, '<[PSM]>') or u[3] % 100 >= 90 then 'plain' when u[4] % 100 < 20 then 'spm' else 'psm' end as form,
  list_transform(regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]'), lambda x: length(x)) as sizes from u),
p as (select *, coalesce(list_sum(sizes[1:lo::bigint]), 0)::bigint as a, coalesce(list_sum(sizes[1:hi::bigint]), 0)::bigint as b from c),
o as (select *, case form when 'plain' then t when 'psm' then concat('<P>', left(t, a), '<S>', substr(t, b + 1), '<M>', substr(t, a + 1, b - a))
  else concat('<S>', substr(t, b + 1), '<P>', left(t, a), '<M>', substr(t, a + 1, b - a)) end as output from p)
select doc_id, n::bigint as n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(output) as output_sha256, sha256(t) as restored_sha256 from o
"""


def _op12_sql(k: int = lloyd.CLUSTERS, rounds: int = lloyd.ROUNDS, dims: int = lloyd.DIMS, scale: int = lloyd.SCALE) -> str:
    """Whole rounds, each comparing every vector with every centroid, component by component."""
    steps = [f"""
q as materialized (select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v from embeddings
  where len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is not null and isfinite(x::double))) = {dims}),
x as materialized (select r, generate_subscripts(v, 1) as i, unnest(v) as x from q),
c0 as materialized (select k, generate_subscripts(v, 1) as i, unnest(v) as c from (
  select row_number() over (order by sha256(concat('2:', vec_id)), v) - 1 as k, v from q where vec_id is not null) where k < {k})"""]
    for j in range(rounds + 1):
        steps.append(f"""
a{j} as materialized (select r, arg_min(k, (d, k)) as k, min(d) as d from (select r, k, sum((x - c) * (x - c))::bigint as d from x join c{j} using (i) group by r, k) group by r)""")
        if j < rounds:
            steps.append(f"""
c{j + 1} as materialized (select k, i, coalesce(m, c) as c from c{j} left join (
  select k, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) as m from x join a{j} using (r) group by k, i) using (k, i))""")
    return f"""with {",".join(steps)},
s as (select k, sha256(string_agg(c::bigint::varchar, ',' order by i)) as h from c{rounds} group by k)
select vec_id, k::int as cluster, d as distance, (sum(d) over (partition by k))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia, h as centroid_sha256
from q join a{rounds} using (r) join s using (k)"""


def oracle_sql() -> dict[str, str]:
    return {"op9_line_rules": OP9_SQL, "op2_decontaminate": OP2_SQL, "op4_warc": OP4_SQL, "op11_fim": OP11_SQL, "op12_lloyd": _op12_sql()}
