"""Fill-in-the-middle rearrangement by DuckDB inside ``mapInArrow``.

Each Arrow batch is registered as a table, one SQL statement cuts the texts into
tokens, picks two places by hashes of the id, puts the three parts into their new
order and rebuilds the text from the result; Arrow comes back, and no row passes
through Python.  Rows don't meet, so nothing is shuffled.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Of a hundred texts so many stay plain; of a hundred others so many begin with the suffix.
PLAIN, SUFFIX_FIRST = 10, 20
#: Bytes of text that DuckDB takes at a time; a longer text goes alone.
SLICE = 16 << 20

#: ``given`` has (r, id, text), without nulls.
STATEMENT = r"""
with cut as (select r, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') as tokens, sha256('1:' || id) as h from given),
dealt as (
  select r, text, tokens, len(tokens) as n,
    ('0x' || substr(h, 1, 8))::bigint % (len(tokens) + 1) as a, ('0x' || substr(h, 9, 8))::bigint % (len(tokens) + 1) as b,
    ('0x' || substr(h, 17, 8))::bigint % 100 as plain, ('0x' || substr(h, 25, 8))::bigint % 100 as turned
  from cut),
formed as (
  select r, text, tokens, n, least(a, b) as lo, greatest(a, b) as hi,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or plain >= 100 - {plain} then 'plain'
      when turned < {suffix_first} then 'spm' else 'psm' end as form
  from dealt),
parts as (
  select r, text, n, form, array_to_string(list_slice(tokens, 1, lo), '') as prefix,
    array_to_string(list_slice(tokens, lo + 1, hi), '') as middle, array_to_string(list_slice(tokens, hi + 1, n), '') as suffix
  from formed),
made as (
  select r, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
    case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end as output
  from parts),
halves as (select *, case form when 'psm' then string_split(output, '<S>') when 'spm' then string_split(output, '<P>') end as halves from made),
again as (
  select *, case form when 'plain' then output
    when 'psm' then substr(halves[1], 4) || string_split(halves[2], '<M>')[2] || string_split(halves[2], '<M>')[1]
    else string_split(halves[2], '<M>')[1] || string_split(halves[2], '<M>')[2] || substr(halves[1], 4) end as restored
  from halves)
select n::bigint as n, form, prefix_chars::bigint as prefix_chars, middle_chars::bigint as middle_chars,
  sha256(output) as output_sha256, sha256(restored) as restored_sha256, {output} as output
from again order by r
"""

SCHEMA = "n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string, output string"


def slices(texts: pa.Array, most: int):
    """(first, end) of runs of rows that hold at most ``most`` bytes, or one row."""
    sizes = pc.binary_length(texts).to_pylist()
    at, held = 0, 0
    for k, n in enumerate(sizes):
        if k > at and held + n > most:
            yield at, k
            at, held = k, 0
        held += n
    if len(sizes) > at:
        yield at, len(sizes)


def rearranged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST, texts: bool = True) -> DataFrame:
    """(doc, fim): ``doc`` holds the row without its text, ``fim`` has SCHEMA.

    ``n`` counts tokens (runs of A-Z letters in either case, or one other character);
    ``form`` is plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle);
    ``output`` is the new text, null unless ``texts``; ``restored_sha256`` is the digest
    of the text rebuilt from output and form.  A null text is an empty one, and stays
    plain; so do texts that hold a marker.  A null id is hashed as the word null.
    Repeated rows stay repeated, with equal results; an empty table gives none.
    Columns may have any names.
    """
    statement = STATEMENT.format(plain=int(plain), suffix_first=int(suffix_first), output="output" if texts else "null::varchar")
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches):
        import duckdb

        con = duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "temp_directory": "", "autoinstall_known_extensions": "false"})
        for b in batches:
            ids, given = b.column(1), b.column(2)
            done = []
            for lo, hi in slices(given, SLICE):
                con.register("given", pa.table({"r": pa.array(range(hi - lo), pa.int64()), "id": ids.slice(lo, hi - lo), "text": given.slice(lo, hi - lo)}))
                done.append(con.sql(statement).to_arrow_table())
                con.unregister("given")
            if done:
                found = pa.concat_tables(done).combine_chunks()
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                columns = [pa.concat_arrays(found.column(c).chunks).cast(t) for c, t in zip(names, kinds)]
                yield pa.record_batch([b.column(0), pa.StructArray.from_arrays(columns, names)], ["doc", "fim"])
        con.close()

    own = F.struct(*[F.col(c) for c in docs.columns if c.lower() != text_col.lower()]).alias("doc")
    rows = docs.select(own, F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, StructType().add(rows.schema["doc"]).add("fim", StructType.fromDDL(SCHEMA)))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with each text in its new order; all other columns as they were."""
    return rearranged(docs, id_col, text_col, **how).select(*[(F.col("fim.output") if c.lower() == text_col.lower() else F.col("doc").getField(c)).alias(c) for c in docs.columns])


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) for each row."""
    some = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = rearranged(some, "doc_id", "text", texts=False)
    return found.select("doc.doc_id", *[f"fim.{c.split()[0]}" for c in SCHEMA.split(", ")[:-1]])
