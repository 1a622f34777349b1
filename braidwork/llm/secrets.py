"""Secret scanning with multipart credential linking.

One pass over whole texts finds candidates: strong ones that stand alone (assigned
values, access identifiers, long hex runs) and weak ones (account names, mixed
40-character keys, endpoints) that mean little by themselves.  Every candidate has a
scope, the interval of ``SCOPE`` characters around it.  Weak candidates are reported
only where an interval join finds candidates of another role whose scope meets
theirs: an identifier needs a secret, a secret an identifier or endpoint, an
endpoint an identifier and a secret.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stage

#: Fixed patterns of the kinds that always count; flags: ASCII, either case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Weak kinds: an account name, a key of mixed characters, an address of a service.
ACCOUNT = re.compile(r"""\b(?:user(?:name)?|login|account|client_id|access_key(?:_id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@=-]{3,})""", re.I | re.A)
KEY40 = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])")
ENDPOINT = re.compile(r"\b(?:https?|ftp|sftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9._~:@%-]+", re.I | re.A)
KINDS = ("assign", "access", "hex", "account", "key40", "endpoint")
BASE = KINDS[:3]
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "account": "id", "key40": "secret", "endpoint": "endpoint"}
#: Roles that must be near before a weak candidate counts, any one of each group.
NEEDS = {"account": (("secret",),), "key40": (("id", "endpoint"),), "endpoint": (("id",), ("secret",))}
SCOPE = 400
MASK = "[SECRET]"


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of all candidates, ascending; ends are exclusive."""
    out = []
    low = text.lower()
    if ("=" in text or ":" in text) and any(w in low for w in ("passw", "secret", "token", "api")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if ("=" in text or ":" in text) and any(w in low for w in ("user", "login", "account", "client_id", "access_key")):
        out += [(m.start(), 3, m.end()) for m in ACCOUNT.finditer(text)]
    if LONG_RUN.search(text):
        out += [(m.start(), 4, m.end()) for m in KEY40.finditer(text) if any(c.isdigit() for c in m[0]) and any(c.isupper() for c in m[0]) and any(c.islower() for c in m[0])]
    if "://" in text:
        out += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    return sorted(out)


LONG_RUN = re.compile(r"[A-Za-z0-9+/]{40}")
PARTS = "array<struct<start:int,kind:int,end:int>>"


def find_parts(docs: DataFrame, text_col: str, carry: list[str]) -> DataFrame:
    """(doc, _parts), one row for each row; ``doc`` holds ``carry``; a null text has none."""

    @F.pandas_udf(PARTS)
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": s, "kind": k, "end": e} for s, k, e in candidates(t)] if t else [] for t in texts], dtype="object")

    return docs.select(F.struct(*[F.col(c) for c in carry]).alias("doc"), run.asNondeterministic()(F.col(text_col).cast("string")).alias("_parts"))


def linked(parts: DataFrame, row: str, scope: int = SCOPE) -> DataFrame:
    """(row, start, kind, end) of the weak candidates that have their complements.

    The interval join is by bins of ``scope`` characters: a candidate stands in its
    own bin and looks in the bins that its scope meets.  Semi joins never list pairs.
    """
    one = parts.select(F.col(row).alias("_of"), F.explode("_parts").alias("p")).select("_of", "p.start", "p.kind", "p.end")
    role = F.element_at(F.create_map(*[x for k, n in enumerate(KINDS) for x in (F.lit(k), F.lit(ROLE[n]))]), F.col("kind"))
    here = one.select(F.col("_of").alias("_in"), role.alias("_role"), F.col("start").alias("_start"), F.col("end").alias("_end")).withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_start") / scope), F.floor(F.col("_end") / scope))))
    out = None
    for kind, groups in NEEDS.items():
        weak = one.where(F.col("kind") == KINDS.index(kind))
        for roles in groups:
            looks = weak.withColumn("bin", F.explode(F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))))
            near = (F.col("_of") == F.col("_in")) & (F.col("bin") == F.col("_bin")) & (F.col("_start") < F.col("end") + scope) & (F.col("_end") > F.col("start") - scope)
            # An interval is no complement of one that it overlaps: they are the same text.
            apart = (F.col("_start") >= F.col("end")) | (F.col("_end") <= F.col("start"))
            weak = looks.join(here.where(F.col("_role").isin(*roles)), near & apart, "left_semi").select("_of", "start", "kind", "end").distinct()
        out = weak if out is None else out.unionByName(weak)
    return out.withColumnRenamed("_of", row)


def spans_of(docs: DataFrame, text_col: str, carry: list[str], scope: int = SCOPE) -> DataFrame:
    """(doc, spans): strong and linked weak candidates, (start, kind, end) each; ``doc`` holds ``carry``.

    One row for each row, repeated ones too.  Rows without weak candidates, nearly
    all, never meet the join.
    """
    rows = stage(find_parts(docs, text_col, carry).withColumn("_row", F.monotonically_increasing_id()), "parts")
    strong = F.filter("_parts", lambda p: p["kind"] < len(BASE))
    weak = F.exists("_parts", lambda p: p["kind"] >= len(BASE))
    more = linked(rows.where(weak).select("_row", "_parts"), "_row", scope).groupBy("_row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("_more"))
    plain = rows.where(~weak).select("doc", strong.alias("spans"))
    joint = rows.where(weak).join(more, "_row", "left").select("doc", F.array_sort(F.concat(strong, F.coalesce("_more", F.array().cast(PARTS)))).alias("spans"))
    return plain.unionByName(joint)


def listing(spans):
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(":", F.get(names, p["kind"]), p["start"].cast("string"), p["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), one row for each row.

    Null and empty texts have no spans; positions are code points."""
    some = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = spans_of(some, "text", ["doc_id"], scope)
    kinds = F.transform("spans", lambda p: p["kind"])
    count = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{n}") for k, n in enumerate(BASE)]
    base = listing(F.filter("spans", lambda p: p["kind"] < len(BASE)))
    return found.select("doc.doc_id", *count, F.sha2(base, 256).alias("base_sha256"), listing(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mask: str = MASK, scope: int = SCOPE) -> DataFrame:
    """``docs`` with every reported span replaced by ``mask``; overlapping spans by one."""
    cols = docs.columns
    found = spans_of(docs, text_col, cols, scope)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        def one(t, parts):
            out, done, last = [], 0, -1
            for p in parts:
                if p["start"] >= last:
                    out += [t[done : p["start"]], mask]
                last = max(last, p["end"])
                done = last
            return "".join(out) + t[done:]

        return pd.Series([one(t, s) for t, s in zip(texts, spans)], dtype="object")

    clean, dirty = found.where(F.size("spans") == 0), found.where(F.size("spans") > 0)
    col = lambda c: F.col("doc").getField(c)
    return clean.select("doc.*").unionByName(dirty.select(*[(cut(col(c), F.col("spans")) if c == text_col else col(c)).alias(c) for c in cols]))
