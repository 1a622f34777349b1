"""Rearranged texts, centroid clusters and the similarity join, against plain Python."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from test_operators import SCHEMA, docs, docs_rows, key, none, prose  # noqa: F401 (fixtures)

from braidwork.llm import fim, lloyd, partenum, registry, shingles


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 11


def plain_fim(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, h = len(tokens), hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[k : k + 8], 16) for k in range(0, 32, 8)]
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = ("".join(x) for x in (tokens[:lo], tokens[lo:hi], tokens[hi:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


ODD_TEXTS = ["<P>", "a<S>b", "x <M", "<", "<<S", "S>M>", "a\nb\r\nc", "\x00é𝄞é 👩‍👩‍👧 b", "1 2  3", "<P<S<M", "Ünïcode ıİ", ">" * 50]


def test_fim_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(fim, "SLICE", 2000)
    rows = [(r[0], r[1]) for r in docs_rows()] + [(1000 + k, t) for k, t in enumerate(ODD_TEXTS * 12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = [(d, *plain_fim(d, t)[:4], sha(plain_fim(d, t)[4]), sha(t or "")) for d, t in rows]
    got = fim.report(df)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_fim_keeps_other_columns(docs, none):  # noqa: F811
    got = fim.transform(docs)
    assert got.columns == docs.columns
    want = [(*r[:1], plain_fim(r[0], r[1])[4], *r[2:]) for r in docs_rows()]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert fim.report(none).count() == fim.transform(none).count() == 0
    renamed = docs.withColumnRenamed("spans", "a b:c").withColumnRenamed("fp", "fim")
    assert fim.transform(renamed).count() == len(docs_rows())


def test_fim_shares_are_parameters(docs):  # noqa: F811
    forms = {r["form"] for r in fim.rearranged(docs, plain=0, suffix_first=100).select("fim.form", "fim.n").where("n > 0").collect()}
    assert forms == {"spm"}
    assert {r["form"] for r in fim.rearranged(docs, plain=100).select("fim.form").collect()} == {"plain"}


# --- 12


def plain_lloyd(rows, k, rounds, dims, scale=256):
    kept = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), np.array(v, "<i4").tobytes(), v) for i, v in kept if i is not None)[:k]
    c = [list(f[2]) for f in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c)) for _, v in kept]

    for _ in range(rounds):
        owners = [j for _, j in assign()]
        for j in set(owners):
            own = [v for (_, v), o in zip(kept, owners) if o == j]
            c[j] = [sum(x) // len(own) for x in zip(*own)]
    last = assign()
    per = {j: sum(d for d, o in last if o == j) for _, j in last}
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return [(i, j, d, per[j], sum(per.values()), digest[j]) for (i, _), (d, j) in zip(kept, last)]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id string, cluster int, v int").repartition(3)


@pytest.mark.parametrize("k,rounds", [(5, 5), (5, 0), (40, 3), (1, 2)])
def test_lloyd_by_brute_force(spark, k, rounds):
    r = np.random.default_rng(5)
    middle = r.normal(0, 1, (6, 4))
    rows = [(n, (middle[n % 6] + r.normal(0, 0.6, 4)).astype(np.float32).tolist()) for n in range(90)]
    rows += [rows[0], rows[0], rows[7], (None, rows[3][1]), (200, [0.0] * 4), (201, [0.0] * 4), (202, [-0.0] * 4)]
    odd = [(300, None), (301, []), (302, [1.0] * 3), (303, [1.0, None, 1.0, 1.0]), (304, [float("nan")] * 4), (305, [float("inf"), 0.0, 0.0, 0.0])]
    got = lloyd.clusters(vectors(spark, rows + odd), k, rounds, 4)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_lloyd(rows, k, rounds, 4), key=key)


def test_lloyd_small_and_empty(spark):
    for rows in ([], [(None, [1.0, 2.0])], [(1, [1.0])]):
        assert lloyd.clusters(vectors(spark, rows), 3, 2, 2).count() == 0
    rows = [(1, [0.5, 1.0]), (1, [0.25, 1.0]), (1, [0.5, 1.0])]
    assert sorted(map(tuple, lloyd.clusters(vectors(spark, rows), 3, 2, 2).collect())) == sorted(plain_lloyd(rows, 3, 2, 2))
    with pytest.raises(Exception, match="beyond"):
        lloyd.clusters(vectors(spark, [(1, [1e30, 0.0])]), 3, 2, 2).count()


def test_lloyd_large_integers():
    r = np.random.default_rng(3)
    x, c = r.integers(-(1 << 26), 1 << 26, (20, 8)), r.integers(-(1 << 26), 1 << 26, (5, 8))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, m)) for m in c] for v in x]
    assert lloyd.distances(x, c).tolist() == want
    assert lloyd.distances(x >> 5, c >> 5).tolist() == [[sum(((int(a) >> 5) - (int(b) >> 5)) ** 2 for a, b in zip(v, m)) for m in c] for v in x]


def test_lloyd_compares_only_what_moved(monkeypatch):
    """Vectors whose owner stayed meet the changed centroids alone, and the owners are right."""
    r = np.random.default_rng(4)
    x, c = r.integers(-50, 50, (300, 6)), r.integers(-50, 50, (9, 6))
    cluster, least = lloyd.owned(x, np.full(300, -1, np.int32), np.zeros(300, np.int64), c, np.ones(9, bool))
    new, changed = c.copy(), np.zeros(9, bool)
    new[[2, 5]] += 9
    changed[[2, 5]] = True
    met, plain = [], lloyd.distances
    monkeypatch.setattr(lloyd, "distances", lambda a, b: met.append((len(a), len(b))) or plain(a, b))
    got = lloyd.owned(x, cluster, least, new, changed)
    moved = int(np.isin(cluster, [2, 5]).sum())
    assert met == [(moved, 9), (300 - moved, 2)]
    d = plain(x, new)
    assert (got[0] == d.argmin(1)).all() and (got[1] == d.min(1)).all()


# --- 13


def plain_set(text, width=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()


def plain_join(rows, percent=90, width=3):
    sets = [plain_set(t, width) for _, t in rows]
    label, degree = list(range(len(rows))), [0] * len(rows)

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                degree[a] += 1
                degree[b] += 1
                label[root(a)] = root(b)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[root(k)] = min(d, least.get(root(k), d))
    return [(d, len(s), least.get(root(k)), degree[k]) for k, ((d, _), s) in enumerate(zip(rows, sets))]


def near_rows(seed=6):
    """Texts around the border of similarity, in groups and chains of all sizes."""
    r = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    out = []
    for n in (1, 2, 3, 8, 11, 12, 13, 20, 31, 60, 61, 200, 700):
        base = [r.choice(words) for _ in range(n)]
        out.append(base)
        for _ in range(7):
            new = list(base)
            for _ in range(max(1, n // r.choice([30, 60, 100, 200]))):
                at = r.randrange(len(new))
                how = r.random()
                if how < 0.4:
                    new[at] = r.choice(words)
                elif how < 0.7:
                    new.insert(at, r.choice(words))
                elif len(new) > 1:
                    del new[at]
            out.append(new)
            base = r.choice([base, new])
    return [" ".join(x) for x in out]


@pytest.mark.parametrize("small,percent", [(False, 90), (True, 85)])
def test_partenum_by_brute_force(spark, docs, monkeypatch, small, percent):  # noqa: F811
    if small:  # many tiles, one hot set
        monkeypatch.setattr(shingles, "TILE", 3)
        monkeypatch.setattr(shingles, "TILE_BYTES", 5000)
        monkeypatch.setattr(partenum, "HOT", 60)
    rows = [(r[0], r[1]) for r in docs_rows()] + [(2000 - k, t) for k, t in enumerate(near_rows())] + [(3000 + k, "Hot text of some words here") for k in range(9)]
    df = spark.createDataFrame([(d, t, 1, "x", 2, 3) for d, t in rows], "doc_id long, text string, name long, sig string, root int, n int").repartition(5)
    got = partenum.join(df, percent=percent)
    want = plain_join(rows, percent)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert sum(w[3] for w in want) > 100


def test_partenum_empty(spark, none):  # noqa: F811
    assert partenum.join(none).count() == 0
    rows = [(1, None), (2, ""), (2, " \n"), (None, None)]
    got = partenum.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain_join(rows), key=key)


@pytest.mark.parametrize("percent", [85, 90, 95])
def test_similar_sets_share_a_signature(percent):
    """Any two sets of just enough similarity, of whatever size and in whatever bands."""
    r = np.random.default_rng(percent)
    for _ in range(300):
        n = int(r.integers(1, 500))
        h = r.integers(0, 1 << 63, 2 * n + 2, dtype=np.uint64)
        drop = int(r.integers(0, n * (100 - percent) // 100 + 1))
        # so many may be added that intersection / union stays at percent or more
        add = max(0, 100 * (n - drop) // percent - n)
        add = int(r.integers(0, add + 1)) if r.random() < 0.3 else add
        a, b = np.sort(h[:n]), np.sort(np.concatenate([h[drop:n], h[n : n + add]]))
        assert 100 * (n - drop) >= percent * (n + add)
        sa, sb = partenum.signatures(a, percent), partenum.signatures(b, percent)
        assert (drop == add == 0) or np.intersect1d(sa, sb).size, (n, drop, add)


def test_thin_signatures_need_a_second_match(monkeypatch):
    """Unlike sets that are empty in the same cells meet in no signature."""
    r = np.random.default_rng(1)
    sets = [np.sort(r.integers(0, 1 << 63, 40, dtype=np.uint64)) for _ in range(4000)]
    met = lambda: len(found := np.concatenate([np.unique(partenum.signatures(h, 85)) for h in sets])) - len(np.unique(found))
    few = met()
    monkeypatch.setattr(partenum, "THIN", 0)
    assert few * 10 < met()


@pytest.mark.parametrize("columns", [7, 4096])
def test_shared_elements_are_counted_exactly(monkeypatch, columns):
    monkeypatch.setattr(shingles, "COLUMNS", columns)
    r = np.random.default_rng(2)
    x = [np.unique(r.integers(0, 300, r.integers(0, 200)).astype(np.uint64)) for _ in range(12)]
    want = [[len(np.intersect1d(a, b)) for b in x] for a in x]
    got = shingles.shared_counts(x)
    apart = ~np.eye(12, dtype=bool)  # what a set shares with itself isn't asked for
    assert (got == np.array(want))[apart].all()
    assert shingles.shared_counts(x[:5], x[5:]).tolist() == [w[5:] for w in want[:5]]
    assert shingles.shared_counts([], []).shape == (0, 0)


def test_sql_of_new_operators(spark):
    """DuckDB on the small tables."""
    con, top = duckdb.connect(), "/root/testdata/sf0.001"
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{top}/{t}.parquet'")
    for name in ("op11_fim", "op12_lloyd"):
        got, want = registry.queries()[name](spark, top), con.sql(registry.oracle_sql()[name])
        columns = sorted(got.columns)
        assert sorted(want.columns) == columns
        assert sorted(map(tuple, got.select(columns).collect()), key=key) == sorted(want.select(", ".join(columns)).fetchall(), key=key)
