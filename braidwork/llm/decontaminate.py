"""Benchmark decontamination with DataFrame functions only.

The benchmark's word n-grams are normalised and hashed; if their bytes (which are
summed first) allow it the set is broadcast, else it is joined by shuffle.  One pass
over the documents scans every window against it and compares the words of each hit.
With the set broadcast only hits and a row per document are shuffled; else a window
travels as its text's hash, its place and its own hash, and words are compared
afterwards, in the texts that were met alone.

Rows are told apart by their id and hashes of the text (96 bits), never by their
place, so a recomputed task gives the same keys.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stage

#: Java's pattern of what stands between words once A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Broadcast sets of n-grams of at most so many bytes, and so many texts' hashes.
MOST_BYTES, MOST_TEXTS = 128 << 20, 2_000_000


def lowered(text: Column) -> Column:
    """``text`` with A-Z alone in lower case."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    """The words of a text; null has none."""
    parts = F.split(lowered(F.coalesce(text.cast("string"), F.lit(""))), BETWEEN)
    return F.array_remove(parts, "")


def benchmark_grams(benchmark: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(gram, hash, width, item_ids): every window of the items; one of fewer than n words is one."""
    words = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    width = F.least(F.size("w"), F.lit(n))
    starts = words.select("item", "w", width.alias("width"), F.explode(F.sequence(F.lit(1), F.size("w") - width + 1)).alias("at"))
    gram = F.slice("w", F.col("at"), F.col("width"))
    grams = starts.select("item", "width", F.array_join(gram, " ").alias("gram"), F.xxhash64(gram).alias("hash"))
    return grams.groupBy("gram", "hash", "width").agg(F.collect_set("item").alias("item_ids"))


KEY = ("_k1", "_k2")


def keyed(text_col: str) -> list[Column]:
    """The hashes that stand for a text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [F.xxhash64(text).alias(KEY[0]), F.hash(text).alias(KEY[1])]


def small(df: DataFrame, most: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def hits(texts: DataFrame, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", n: int = 10, by: tuple[str, ...] = KEY, every: bool = False) -> DataFrame:
    """(``by``, n_words, copies, spans, items) of ``texts`` (``by``, with KEY among it, and _text).

    ``spans`` are the hit windows as (first, last) word positions from 1; ``items``
    the distinct benchmark ids, sorted as strings; ``copies`` the rows that are equal
    in ``by``.  ``every``: rows without a hit as well.  Null and wordless texts have no
    words and no hits.  Items with null or wordless texts have no windows; items
    with a null id are found but have no id to list.  An empty benchmark hits nothing.
    """
    grams = stage(benchmark_grams(benchmark, item_id, item_text, n), "grams")
    widths = sorted(r["width"] for r in grams.select("width").distinct().collect()) or [n]  # n values at most
    per_item = F.octet_length(F.concat_ws("", "item_ids")) + 32 * F.size("item_ids")
    few = (grams.agg(F.sum(F.octet_length("gram") + per_item + 64)).first()[0] or 0) <= MOST_BYTES
    named = texts.select(*by, words_of(F.col("_text")).alias("_w"))

    def scanned(width: int) -> Column:
        none = F.array().cast("array<bigint>")
        full = F.transform(F.sequence(F.lit(1), F.size("_w") - width + 1), lambda i: F.xxhash64(F.slice("_w", i, width)))
        return F.when(F.size("_w") >= width, full).otherwise(none)

    def placed(width: int) -> Column:
        none = F.array().cast("array<struct<first:int,hash:bigint>>")
        full = F.transform(F.sequence(F.lit(1), F.size("_w") - width + 1), lambda i: F.struct(i.alias("first"), F.xxhash64(F.slice("_w", i, width)).alias("hash")))
        return F.when(F.size("_w") >= width, full).otherwise(none)

    hashes = scanned(widths[0]) if len(widths) == 1 else F.concat(*[scanned(w) for w in widths])
    # The windows of each width follow each other: find width and place from the position.
    size, width, base = F.lit(0), F.lit(widths[0]), F.lit(0)
    for w in widths:
        ahead = size
        width, base = F.when(F.col("_at") >= ahead, w).otherwise(width), F.when(F.col("_at") >= ahead, ahead).otherwise(base)
        size = ahead + F.greatest(F.col("_n").cast("int") - w + 1, F.lit(0))
    first = F.col("_at") - base + 1 if len(widths) > 1 else F.col("_at") + 1
    words = lambda first, width: F.array_join(F.slice("_w", first, width), " ")
    span = lambda first, width: F.struct(first.cast("int").alias("first"), (first + width - 1).cast("int").alias("last"))
    n_words = F.size("_w").cast("long").alias("_n")
    if few:
        rows = named.select("*", n_words, hashes.alias("_h")).select(*by, "_w", "_n", F.posexplode_outer("_h").alias("_at", "_hash"))
        # Joined by hash alone, so that words are put together only where a hash was met.
        met = rows.join(F.broadcast(grams), F.col("_hash") == F.col("hash"), "left")
        true = F.when(F.col("gram").isNotNull(), words(first.cast("int"), width) == F.col("gram")).otherwise(F.lit(False))
        # A document's first window stands for it, whatever the number of its grams.
        start = F.coalesce(F.col("_at"), F.lit(0)) == 0
        met = met.withColumn("_true", true).where(F.col("_true") | start if every else F.col("_true"))
        per = met.select(*by, "_n", start.cast("long").alias("_one"), F.when(F.col("_true"), span(first, F.col("width"))).alias("span"), F.when(F.col("_true"), F.col("item_ids")).alias("item_ids"))
    else:
        places = F.flatten(F.array(*[placed(w) for w in widths]))
        rows = named.select(*KEY, F.explode_outer(places).alias("_p")).select(*KEY, F.col("_p.first").alias("_first"), F.col("_p.hash").alias("_hash"))
        met = rows.where("_hash is not null").join(grams, F.col("_hash") == F.col("hash"))
        found = stage(met.groupBy(*KEY).agg(F.collect_set(F.struct("_first", "width", "gram", "item_ids")).alias("_met")), "met")
        joined = named.join(small(found, MOST_TEXTS // 20), list(KEY), "left" if every else "inner")
        true = F.filter(F.coalesce("_met", F.array().cast(found.schema["_met"].dataType)), lambda m: words(m["_first"], m["width"]) == m["gram"])
        per = joined.select(*by, n_words, F.posexplode_outer(true).alias("_one", "_hit")).where(F.lit(every) | F.col("_hit").isNotNull())
        per = per.select(*by, "_n", (F.coalesce("_one", F.lit(0)) == 0).cast("long").alias("_one"), F.when(F.col("_hit").isNotNull(), span(F.col("_hit._first"), F.col("_hit.width"))).alias("span"), F.col("_hit.item_ids").alias("item_ids"))
    return per.groupBy(*by).agg(
        F.first("_n").alias("n_words"),
        F.sum("_one").alias("copies"),
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("items"),
    )


def covered(spans: Column) -> Column:
    """Words inside the union of sorted spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc, s):
        low = F.greatest(s["first"], acc["end"] + 1)
        return F.struct(F.greatest(acc["end"], s["last"]).alias("end"), (acc["n"] + F.greatest(s["last"] - low + 1, F.lit(0))).alias("n"))

    return F.aggregate(spans, zero, add, lambda acc: acc["n"])


def report(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), a row for each document row."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), *keyed(text_col))
    found = hits(texts, benchmark, item_id, item_text, n, ("doc_id", *KEY), every=True)
    n_hit = covered(F.col("spans"))
    each = found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "copies")
    return each.withColumn("_k", F.explode(F.sequence(F.lit(1), "copies"))).drop("_k", "copies")


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) without the hit words.

    With spans, a removed word takes the separators before it along; the rest of the
    text, its case included, is unchanged.  Clean rows come back as they were.  While
    the texts with hits are at most MOST_TEXTS, no other text is shuffled.
    """
    found = stage(hits(docs.select(F.col(text_col).alias("_text"), *keyed(text_col)), benchmark, item_id, item_text, n).select(*KEY, "spans"), "hits")
    own = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), *keyed(text_col))
    col = lambda c: F.col("doc").getField(c)
    if remove == "documents":
        return own.join(small(found.select(*KEY), MOST_TEXTS), list(KEY), "left_anti").select(*[col(c).alias(c) for c in docs.columns])
    text = F.coalesce(col(text_col), F.lit(""))
    lead = F.split(text, WORD_ANY)
    words = F.regexp_extract_all(text, F.lit(f"({WORD_ANY})"), 1)
    kept = F.transform(words, lambda w, i: F.when(F.exists("spans", lambda s: (s["first"] <= i + 1) & (i + 1 <= s["last"])), F.lit("")).otherwise(F.concat(F.get(lead, i), w)))
    rebuilt = F.concat(F.array_join(kept, ""), F.get(lead, F.size(words)))
    joined = own.join(small(found, MOST_TEXTS // 20), list(KEY), "left")
    return joined.select(*[(F.when(F.col("spans").isNull(), col(c)).otherwise(rebuilt) if c == text_col else col(c)).alias(c) for c in docs.columns])


#: Words of a text whose A-Z are not lower-cased yet.
WORD_ANY = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
