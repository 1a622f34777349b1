"""The ten operators against brute force, round trips and hard rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from braidwork.llm import decontaminate, fastbpe, line_rules, lm_score, packing, quality_cnn, registry, secrets, shards, shingles, simhash, staging, tokenfile, warc

WORDS = "the of red sky and a sea Stone moon in by old wind over Étoile night ship sail far home".split()
#: The last columns clash with names that operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, spans string"


def prose(r, n):
    return " ".join(r.choice(WORDS) + (".\n" if r.random() < 0.1 else "") for _ in range(n))


def docs_rows(seed=1, n=60):
    """Texts with copies, near copies, nulls, empties, repeats and a null id."""
    r = random.Random(seed)
    texts = [prose(r, r.choice([1, 2, 5, 40, 150])) for _ in range(n)]
    texts += [texts[3], texts[3], texts[5] + " x", "", None, "  \t\n", "one", "ab cd", "x" * 5000, "É" * 70 + " y", "a b  c d ", prose(r, 6000)]
    rows = [(k, t, "en", f"src{k % 3}" if k % 7 else None, len(t or ""), 1, "r") for k, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, texts[3], None, None, None, None, None), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(docs_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(x):
    return tuple((v is None, str(v)) for v in x)


# --- 1


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius=2):
    label = list(range(len(prints)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                label[root(a)] = root(b)
    return [root(k) for k in range(len(prints))]


@pytest.mark.parametrize("segments", [4, 8])
def test_simhash(docs, segments):
    got = simhash.near_duplicates(docs, segments=segments).collect()
    rows = docs_rows()
    prints = [brute_print(r[1]) for r in rows]
    label = brute_components(prints)
    least = {}
    for r, k in zip(rows, label):
        if r[0] is not None:
            least[k] = min(r[0], least.get(k, r[0]))
    want = [(r[0], p - (1 << 64) if p >> 63 else p, least.get(k)) for r, p, k in zip(rows, prints, label)]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_simhash_chains_and_tiles(spark, monkeypatch):
    """Chains of close prints over many small tiles; links meet only through neighbours."""
    monkeypatch.setattr(simhash, "TILE", 3)
    r = random.Random(2)
    prints = []
    for _ in range(12):
        p = r.getrandbits(64)
        for _ in range(9):
            prints.append(p)
            p ^= (1 << r.randrange(64)) ^ (1 << r.randrange(64))
    prints = sorted(set(prints))
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    for segments in (4, 8, 16):
        found = {x["node"]: x["root"] for x in simhash.stars(simhash.links(df, 2, segments)).collect()}
        label = brute_components(prints)
        groups = Counter()
        for p, k in zip(prints, label):
            groups[k, found.get(p - (1 << 64) if p >> 63 else p, p)] += 1
        assert len(groups) == len(set(label)) == len({b for _, b in groups})


def test_forest_is_exact():
    u, v = np.array([0, 4, 2, 5]), np.array([4, 2, 7, 6])
    assert list(simhash.forest(8, u, v)) == [0, 1, 0, 3, 0, 5, 5, 0]


def test_stars_of_a_long_chain(spark):
    """No number of rounds is laid down: a chain of 5000 nodes is one component."""
    order = random.Random(3).sample(range(5000), 5000)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "u long, v long")
    got = simhash.stars(edges).collect()
    assert {x["node"] for x in got} == set(range(5000)) and {x["root"] for x in got} == {0}


def test_simhash_empty_and_hot_keys(none, docs, monkeypatch):
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_first(none).count() == 0
    want = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=key)
    monkeypatch.setattr(simhash, "HOT", 30)  # texts of more than a thirtieth of the rows
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=key) == want


def shingle_sets(text, width=5):
    w = (text or "").lower().split()
    return frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute_similar(texts, least):
    """Component labels of the texts under links of that Jaccard similarity, all pairs compared."""
    label, sets = list(range(len(texts))), [shingle_sets(t) for t in texts]
    for a in range(len(texts)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    return label


@pytest.mark.parametrize("tile", [2048, 3])
def test_keep_first(spark, docs, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(shingles, "TILE", tile)
    r = random.Random(30)
    rows, at = [(x[0], x[1]) for x in docs_rows()], 1000
    for _ in range(25):  # copies with one changed word, and half copies, which stay
        t = [f"w{r.randrange(500)}" for _ in range(r.randint(120, 300))]
        near = [list(t) for _ in range(4)]
        for k in near:
            k[r.randrange(len(k))] = "changed"
        half = t[: len(t) // 2] + [f"v{r.randrange(500)}" for _ in range(len(t) // 2)]
        # a run of other words at the end: similarities of 0.6 to 0.85 with the first
        border = [t[: round(len(t) * c)] + [f"u{r.randrange(500)}" for _ in range(len(t) - round(len(t) * c))] for c in (0.75, 0.82, 0.87, 0.9, 0.93)]
        for words in (t, *near, half, *border):
            rows.append((at, " ".join(words)))
            at += 1
    rows += [(None, rows[-1][1] + " x"), (1001, "another text of that id " * 9)]
    d = spark.createDataFrame([(*x, "clash", 1, 2) for x in rows], "doc_id long, text string, name string, cells int, row int").repartition(5)
    kept = simhash.keep_first(d)
    assert kept.columns == d.columns
    label, first = brute_similar([t for _, t in rows], 0.8), {}
    for k, (i, t) in zip(label, rows):
        first[k] = min(first.get(k, (True, 0)), (i is None, i or 0))
    want = Counter(i if not no else None for no, i in first.values())
    assert Counter(x["doc_id"] for x in kept.collect()) == want


def test_similarity_of_the_radius():
    """Texts of similarity 0.85 are within the radius, those of 0.5 are not."""
    r, radius, met = random.Random(31), simhash.radius_for(0.8), Counter()
    for similarity in (0.85, 0.5):
        for _ in range(60):
            both = round(400 * similarity)
            words = [[f"{x}{k} b c d e" for k in range(both if x == "s" else (400 - both) // 2)] for x in "sab"]
            prints = [simhash.wide_print("\n".join(words[0] + words[k] + [str(r.random())]).encode(), 1)[1] for k in (1, 2)]
            a, b = (np.frombuffer(p, np.uint64) for p in prints)
            met[similarity] += int(np.bitwise_count(a ^ b).sum()) <= radius
    assert met[0.85] >= 57 and met[0.5] <= 3


# --- 2


def brute_hits(text, items, n=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, ids = words(text), set(), set()
    for i, t in items:
        b = words(t)
        k = min(n, len(b))
        if not b:
            continue
        grams = {tuple(b[j : j + k]) for j in range(len(b) - k + 1)}
        for j in range(len(w) - k + 1):
            if tuple(w[j : j + k]) in grams:
                hit |= set(range(j, j + k))
                ids.add(i)
    return len(w), len(hit), sorted(str(i) for i in ids if i is not None)


@pytest.mark.parametrize("few", [True, False])
def test_decontaminate(spark, docs, monkeypatch, few):
    if not few:
        monkeypatch.setattr(decontaminate, "MOST_BYTES", 0)
        monkeypatch.setattr(decontaminate, "MOST_TEXTS", 0)
    r = random.Random(4)
    rows = docs_rows()
    long = [t for _, t, *_ in rows if t and len(t.split()) > 30]
    items = [(10, " ".join(long[0].split()[5:20])), (9, long[1].upper()[:200]), (8, "one"), (7, None), (6, "..."), (5, "ab-cd"), (None, " ".join(long[2].split()[:12])), (10, prose(r, 15))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.report(docs, bench).collect()
    want = []
    for row in rows:
        n, hit, ids = brute_hits(row[1], items)
        want.append((row[0], n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert any(x["contaminated"] for x in got) and not all(x["contaminated"] for x in got)
    clean = decontaminate.decontaminate(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not w[5] for w in want)
    cut = decontaminate.decontaminate(docs, bench, remove="spans")
    assert cut.count() == len(rows)
    assert sorted(len(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", x["text"] or "")) for x in cut.collect()) == sorted(w[1] - w[2] for w in want)


def test_decontaminate_empty(spark, docs, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(docs, bench).where("n_hit = 0 and not contaminated").count() == docs.count()
    assert decontaminate.report(none, bench).count() == 0


# --- 3


def test_quality_learns_and_scores_whole_texts(spark):
    r = random.Random(6)
    rows, labels = [], []
    for k in range(240):
        bad = k % 3 == 0
        t = prose(r, 60)
        if bad:
            t = t.replace(" ", " | ") if k % 2 else t + " " + "*** $$$ " * 30
        rows.append((k, t))
        labels.append((k, int(not bad)))
    d = spark.createDataFrame(rows + [(900, None), (901, ""), (None, "a"), (5, rows[5][1])], "doc_id long, text string")
    l = spark.createDataFrame(labels + [(901, None), (None, 1)], "doc_id long, quality int")
    got = quality_cnn.classify(d, l, epochs=12).collect()
    assert len(got) == 244 and all(0 <= x["score"] <= 1 for x in got)
    truth = dict(labels)
    test = [x for x in got if x["held_out"] and x["doc_id"] in truth]
    assert {x["doc_id"] for x in test} == {k for k in truth if zlib.crc32(str(k).encode()) % 5 == 0}
    assert np.mean([x["predicted"] == truth[x["doc_id"]] for x in test]) > 0.9
    assert all(x["predicted"] == int(x["score"] >= 0.3) for x in got)


def test_quality_convolution_is_exact(monkeypatch):
    net = quality_cnn.fresh_net(3)
    text = bytes(random.Random(1).randrange(256) for _ in range(1000))
    pad = text + bytes(quality_cnn.WIDTH - 1)
    full = np.array([sum(net.tables[j][pad[i + j]] for j in range(quality_cnn.WIDTH)) for i in range(len(text))])
    halves = [full[k : k + quality_cnn.HALF].max(0) for k in range(0, len(text), quality_cnn.HALF)]
    assert np.allclose(quality_cnn.half_maxima(net, text)[0], halves, atol=1e-5)
    monkeypatch.setattr(quality_cnn, "SPAN", quality_cnn.HALF * 2)
    assert np.allclose(quality_cnn.half_maxima(net, text)[0], halves, atol=1e-5)


def test_quality_gradient():
    texts, labels = [b"abc abc", b"zz!! zz!!"] * 8, [1, 0] * 8
    net = quality_cnn.fit(texts, labels, epochs=30)
    assert quality_cnn.score(net, b"abc abc") > 0.8 > 0.2 > quality_cnn.score(net, b"zz!! zz!!")


def log_loss(net, texts, y, weight):
    p = np.array([quality_cnn.score(net, t) for t in texts])
    return float((-weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean())


def test_quality_score_by_brute_force():
    net = quality_cnn.fresh_net(5)
    text = bytes(random.Random(2).randrange(256) for _ in range(700))
    pad, half = text + bytes(quality_cnn.WIDTH), quality_cnn.HALF
    full = np.array([sum(net.tables[j][pad[i + j]] for j in range(quality_cnn.WIDTH)) for i in range(len(text))])
    chunks = np.tanh(np.array([full[k : k + 2 * half].max(0) for k in range(0, len(text) - half, half)]) + net.bias)
    x = np.concatenate([chunks.mean(0), chunks.max(0)])
    want = 1 / (1 + np.exp(-(np.tanh(x @ net.w1 + net.b1) @ net.w2 + net.b2[0])))
    assert quality_cnn.score(net, text) == pytest.approx(float(want), abs=1e-5)


def test_quality_one_step_lowers_the_loss_along_the_gradient():
    """The first Adam step moves every weight against the numerical derivative's sign."""
    texts, y = [b"abc abd " * 20, b"zz!! zy!! " * 20], np.array([1, 0])
    before, after = quality_cnn.fresh_net(7), quality_cnn.fit(texts, [1, 0], epochs=1, batch=2, rate=1e-3)
    weight, checked = np.ones(2), 0
    for name in ("w2", "b1", "bias", "tables"):
        old, new = getattr(before, name), getattr(after, name)
        places = np.argwhere(np.abs(new - old) > 9e-4)[:12]
        for at in map(tuple, places):
            held = old[at]
            old[at] = held + 1e-2
            up = log_loss(before, texts, y, weight)
            old[at] = held - 1e-2
            slope = up - log_loss(before, texts, y, weight)
            old[at] = held
            if abs(slope) > 1e-4:
                checked += 1
                assert np.sign(slope) == -np.sign(new[at] - held), (name, at)
    assert checked > 10


def test_quality_bounds(spark, none, monkeypatch):
    seen = {}
    monkeypatch.setattr(quality_cnn, "fit", lambda texts, labels, epochs: seen.update(n=len(texts), size=sum(map(len, texts))) or quality_cnn.blank_net())
    d = spark.createDataFrame([(k, f"text {k % 50} " * 5) for k in range(100) for _ in range(3)], "doc_id long, text string")
    l = spark.createDataFrame([(k, k % 2) for k in range(100) for _ in range(2)], "doc_id long, quality int")
    ids = [k for k in range(100) if zlib.crc32(str(k).encode()) % 5]
    quality_cnn.train(d, l)
    assert seen["n"] == len(ids)
    quality_cnn.train(d, l, sample=10)
    assert seen["n"] == 10
    quality_cnn.train(d, l, sample_bytes=400)
    assert 300 < seen["size"] <= 400
    # a text beyond the bound is passed over, whatever its place; others are learnt from
    for huge in (ids[0], ids[-1]):
        quality_cnn.train(d.where(f"doc_id <> {huge}").unionByName(d.where(f"doc_id = {huge}").limit(1).selectExpr("doc_id", "repeat('x', 20000) as text")), l, sample_bytes=15000)
        assert seen["n"] == len(ids) - 1
    with pytest.raises(ValueError, match="none of"):
        quality_cnn.train(d, l, sample_bytes=3)
    unknown = quality_cnn.classify(d, l.limit(0)).select("score").distinct().collect()
    assert [x["score"] for x in unknown] == [0.5]
    assert quality_cnn.classify(none, l).count() == 0


# --- 4


def pages_rows():
    big, other = "<p>" + "ä" * 700, "q" * 1000
    rows = [(k, f"http://h/{k}", f"page {k}") for k in range(20)]
    return rows + [(30, "u v\n", big), (31, None, big), (40, "x", big), (50, "y", other), (50, "y", other), (51, "z", "q" * 999), (52, "z", "q" * 999), (None, "n", big), (None, "n", None), (60, "e", ""), (61, "e", None), (70, "l", "w" * 3_000_000)]


def test_warc(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME", 4000)
    pages = spark.createDataFrame([(*r, "clash", 1) for r in pages_rows()], "page_id long, url string, html string, sha1 string, n int").repartition(3)
    folder = staging.fresh_path(spark, "t-warc")
    index = warc.write_archives(pages, folder)
    got = warc.read_archives(index, folder)
    want = []
    for i, _, html in pages_rows():
        b = (html or "").encode()
        top = max((p for p, _, h in pages_rows() if (h or "").encode() == b and p is not None), default=None)
        again = len(b) >= 1000 and i != top and top is not None
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", top if again else None))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.select(*cols).collect()), key=key) == sorted(want, key=key)
    one = warc.read_archives(index.where("page_id = 7"), folder).collect()
    assert [bytes(x["payload"]) for x in one] == [b"page 7"]
    empty = warc.round_trip(pages.limit(0))
    assert empty.count() == 0


def test_warc_bundle_is_plain_zstandard(spark, tmp_path):
    import zstandard

    pages = spark.createDataFrame([(k, "u", f"t{k}") for k in range(5)], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(pages, str(tmp_path / "w")).count()
    files = list((tmp_path / "w").glob("pages*.zst"))
    raw = b"".join(zstandard.ZstdDecompressor().stream_reader(f.open("rb"), read_across_frames=True).read() for f in files)
    assert raw.count(b"WARC/1.1\r\n") == 5


# --- 5


@pytest.mark.parametrize("parts", [1, 7])
def test_shards(docs, parts):
    got = shards.assign(docs.repartition(parts), 8).collect()
    rows = docs_rows()
    assert sorted((str(x["doc_id"]), x["size"], x["text_crc32"]) for x in got) == sorted((str(r[0]), len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    per = Counter(x["shard"] for x in got)
    assert set(per) == set(range(8)) and max(per.values()) - min(per.values()) <= 1
    for s in per:
        assert sorted(x["slot"] for x in got if x["shard"] == s) == list(range(per[s]))
    whole = Counter(x["source"] for x in got)
    for s in per:  # every shard has the mixture of all
        here = Counter(x["source"] for x in got if x["shard"] == s)
        assert all(abs(here[k] - whole[k] * per[s] / len(got)) <= 2.5 for k in whole)


def test_shards_do_not_depend_on_partitions(docs):
    unique = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    a = {(x["doc_id"], x["shard"], x["slot"]) for x in shards.assign(unique.repartition(2), 5).collect()}
    assert a == {(x["doc_id"], x["shard"], x["slot"]) for x in shards.assign(unique.repartition(9), 5).collect()}


def test_write_shards(spark, docs, tmp_path):
    unique = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).withColumns({"shard": F.lit("clash"), "slot": F.lit(1)})
    placed = shards.assign(unique, 4)
    shards.write_shards(unique, placed, str(tmp_path / "s"))
    got = spark.read.parquet(str(tmp_path / "s"))
    assert {x["doc_id"]: (x["_shard"], x["_slot"], x["shard"]) for x in got.collect()} == {x["doc_id"]: (x["shard"], x["slot"], "clash") for x in placed.collect()}


def test_empty_tables(none):
    for f in (secrets.scan, secrets.redact, line_rules.report, line_rules.keep_clean):
        assert f(none).count() == 0


def test_shards_small(docs, none, spark):
    assert shards.assign(none, 4).count() == 0
    few = [x["shard"] for x in shards.assign(docs.limit(2), 5).collect()]
    assert len(few) == 2 and len(set(few)) == 2


# --- 6


def test_lm_words(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(lm_score, "SLICE", 7)
    texts = [*ODD, "A\tb\x0b\x0cÉ\r\n a ", None, *(x[1] for x in docs_rows())]
    words, at, first = lm_score.tokenised(pa.array(texts))
    for k, t in enumerate(texts):
        want = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [" "]
        assert [words[i] for i in at[first[k] : first[k + 1]]] == want
    parts = list(lm_score.slices(first))
    assert parts[0][0] == 0 and parts[-1][1] == len(texts) and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))


def test_lm_score_by_brute_force(spark, docs, monkeypatch):
    """Every token by itself: its context, its class's probability, its share, in plain Python."""
    monkeypatch.setattr(lm_score, "SLICE", 50)
    none = lm_score.TOPICS
    got = {(x["doc_id"], x["n_tokens"]): x["score"] for x in lm_score.score(docs, steps=20, most=16, own=5).collect()}
    train = docs.where(~lm_score.held_out("doc_id")).select("text")
    counts = lm_score.count_words(train)
    vocab = lm_score.vocabulary(train, counts, 16, 5)
    assert len(set(vocab.topic[1:])) > 1 and (vocab.kind[6:] < 1 + 5 + lm_score.KINDS).any()
    table = lm_score.fit_nce(*lm_score.class_counts(train, vocab), steps=20).log_probabilities(vocab.present) / np.log(10)
    c = {r["word"]: r["c"] for r in counts.collect()}
    kind = lambda w: int(vocab.kind[vocab.rank[w]]) if w in vocab.rank else vocab.letters(w)
    topic = lambda w: int(vocab.topic[vocab.rank[w]]) if w in vocab.rank else none
    for r in docs_rows():
        words, total = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")) + [" "], 0.0
        for k, w in enumerate(words):
            votes = [0] * none + [1]
            for j, weight in enumerate(lm_score.WEIGHTS, 1):
                if j <= k and topic(words[k - j]) < none:
                    votes[topic(words[k - j])] += weight
            row = table[(kind(words[k - 1]) if k else 0) * (none + 1) + int(np.argmax(votes))]
            if w not in c:
                total += row[-1]
                continue
            total += row[kind(w)]
            if kind(w) > 5:
                total += np.log10((c[w] - vocab.discount) / (vocab.tail_n[kind(w)] - vocab.discount * vocab.tail_v[kind(w)]))
        assert got[r[0], len(words)] == pytest.approx(total, rel=1e-4, abs=1e-3)


def test_lm_base_counts(spark, docs, monkeypatch):
    monkeypatch.setattr(lm_score, "SLICE", 100)
    got = lm_score.score(docs, steps=10, most=12, own=6).collect()
    rows = docs_rows()
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [" "]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for r in rows if not out(r[0]) for w in words(r[1]))
    n, v = sum(c.values()), len(c)
    want = []
    for r in rows:
        w = words(r[1])
        want.append((r[0], out(r[0]), len(w), sum(c[x] > 0 for x in w), n, round(sum(np.log10((c[x] + 1) / (n + v + 1)) for x in w), 4)))
    assert sorted(((x["doc_id"], x["held_out"], x["n_tokens"], x["n_known"], x["train_tokens"], round(x["base_score"], 4)) for x in got), key=key) == sorted(want, key=key)
    assert all(x["score"] < 0 for x in got)


def test_lm_words_of_a_context_sum_to_one(spark):
    texts = spark.createDataFrame([(t,) for t in ("a b a c d", "b a e f g h", "a a b")], "text string")
    counts = lm_score.count_words(texts)
    vocab = lm_score.vocabulary(texts, counts, own=4)
    p = np.exp(lm_score.fit_nce(*lm_score.class_counts(texts, vocab), steps=5).log_probabilities(vocab.present).astype(np.float64))
    assert np.allclose(p.sum(1), 1, atol=1e-5)
    total = p[30, -1]
    for r in counts.collect():
        k = int(vocab.kind[vocab.rank[r["word"]]])
        total += p[30, k] * (1 if k <= 4 else (r["c"] - vocab.discount) / (vocab.tail_n[k] - vocab.discount * vocab.tail_v[k]))
    assert total == pytest.approx(1.0, abs=1e-5)


def test_lm_beats_unigrams_where_order_counts(spark):
    r = random.Random(8)
    rows = [(k, " ".join(w for _ in range(40) for w in r.choice([("red", "sky"), ("old", "sea"), ("far", "moon")]))) for k in range(120)]
    got = lm_score.score(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert got[1] > got[0] * 0.8  # log probabilities: nearer zero


def test_lm_held_out_gain_on_real_tables(spark):
    """On the test tables held-out texts are far likelier than by word counts alone."""
    got = lm_score.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert got[1] > got[0] * 0.85


def test_lm_empty(none):
    assert lm_score.score(none, steps=2).count() == 0


# --- 7 and 10

ODD = ["", " ", "a", " a", "a ", "Don't  stop\n\nnow\t x", "中文 text é́   x", "x" * 300 + " y", "<|endoftext|> and <|startoftext|>", "see <|endoftext|> here", ". a", "a, x.\n", "ΑΣ ΟΔΟΣ İstanbul ﬁ", "1234 5 a1b2 !?... ''' 's", "\x1c \x85  "]


@pytest.mark.parametrize("as_text", [False, True])
@pytest.mark.parametrize("name,lower", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_ids_equal_the_library(name, lower, as_text, monkeypatch):
    from tokenizers import Tokenizer

    path = registry.tokenizer_path(name)
    t = Tokenizer.from_file(path)
    if as_text:
        t.encode_special_tokens = True
    monkeypatch.setattr(fastbpe, "MOST", 40)
    monkeypatch.setattr(fastbpe, "SLICE", 3000)
    enc, r = fastbpe.Encoder(path, lower, as_text), random.Random(9)
    alphabet = list("abzT .,\n\té  ßΣσİ|*5中'!;") + ["'ll", "  ", " a", "ción ", ", ", ". ", ".\n", "<|endoftext|>"]
    prosaic = list("abzT    .,éßΣ|*5';") + ["'ll", " a", "ción ", ", ", ". ", ".\n", "word "]
    texts = ODD + [x[1] or "" for x in docs_rows()]
    texts += ["".join(r.choice(letters) for _ in range(r.randint(0, 50))) for letters in (alphabet, prosaic) for _ in range(500)]
    for x, got in zip(texts, enc.each(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, x
    assert enc.batch([None, ""]) == [b"", b""]


def library_ids(name, text):
    from tokenizers import Tokenizer

    if name not in LIBRARY:
        LIBRARY[name] = Tokenizer.from_file(registry.tokenizer_path(name))
    return np.array(LIBRARY[name].encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()


LIBRARY: dict = {}


def test_packing(spark, docs):
    special = spark.createDataFrame([(900, "see <|endoftext|> here")], "doc_id long, text string")
    rows = [(r[0], r[1]) for r in docs_rows()] + [(900, "see <|endoftext|> here")]
    pieces = packing.pack(docs.select("doc_id", "text").unionByName(special).repartition(6), registry.tokenizer_path("word_bpe_49k.json"), window=512, most_open=4)
    got = pieces.collect()
    # Every piece of every row, repeated rows included, and nothing else.
    want = Counter()
    for doc, text in rows:
        ids = library_ids("word_bpe_49k.json", text)
        for k in range(0, len(ids), 2048):
            want[doc, k // 4, ids[k : k + 2048], len(ids) // 4] += 1
    assert Counter((x["doc_id"], x["start"], bytes(x["ids"]), x["doc_tokens"]) for x in got) == want
    sizes = {}
    for x in sorted(got, key=lambda x: (x["sequence_id"], x["offset"])):
        assert sizes.get(x["sequence_id"], 0) == x["offset"] and len(x["ids"]) == 4 * x["length"]
        sizes[x["sequence_id"]] = x["offset"] + x["length"]
    assert max(sizes.values()) <= 512
    assert sum(sizes.values()) > 0.9 * 512 * len(sizes)
    seqs = {x["sequence_id"]: x["n_tokens"] for x in packing.sequences(pieces).collect()}
    assert seqs == sizes


def test_packing_empty(none):
    assert packing.pack(none, registry.tokenizer_path("word_bpe_49k.json")).count() == 0


def test_open_windows_are_bounded():
    w, r = packing.OpenWindows(100, 3), random.Random(1)
    fill = Counter()
    for _ in range(500):
        size = r.randint(1, 100)
        k, at = w.place(size)
        assert fill[k] == at
        fill[k] += size
        assert len(w.free) <= 3
    assert max(fill.values()) <= 100 and len(w.closed) + len(w.free) == len(fill)


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(1).integers(0, 1 << bits, 999).astype(np.uint32)
    data = tokenfile.pack_bits(ids, bits)
    assert len(data) == -(-999 * bits // 8) and (tokenfile.unpack_bits(data, bits, 999) == ids).all()
    assert tokenfile.width_of(50257) == 16 and tokenfile.width_of(49408) == 16 and tokenfile.width_of(2) == 1


@pytest.mark.parametrize("vocabulary", [None, 100_000])
def test_token_files(spark, docs, monkeypatch, vocabulary):
    monkeypatch.setattr(tokenfile, "BLOCK", 64)
    monkeypatch.setattr(tokenfile, "FILE_IDS", 700)
    special = spark.createDataFrame([(900, "see <|endoftext|> here")], "doc_id long, text string")
    got = tokenfile.round_trip(docs.select("doc_id", "text").unionByName(special), registry.tokenizer_path("byte_bpe_50k.json"), vocabulary).orderBy("start").collect()
    rows = [(r[0], r[1]) for r in docs_rows()] + [(900, "see <|endoftext|> here")]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at = 0
    for x, r in zip(got, rows, strict=True):
        ids = library_ids("byte_bpe_50k.json", r[1])
        assert (x["doc_id"], x["start"], x["n_tokens"], bytes(x["ids"])) == (r[0], at, len(ids) // 4, ids)
        at += len(ids) // 4


def test_an_id_beyond_the_vocabulary_is_an_error():
    with pytest.raises(ValueError):
        tokenfile.pack_bits(np.array([1, 70_000], np.uint32), 16)


def test_token_files_empty(none):
    assert tokenfile.round_trip(none, registry.tokenizer_path("byte_bpe_50k.json")).count() == 0


# --- 8

SECRET = "Aa0" + "bC1dE2fG3h" * 4
PLANTED = [
    "password = hunter22 and Token:abc12 api-key api_key='zz+/_.=-9'",
    "AKIA" + "Q" * 16 + " AKIAQQQ " + "f" * 24 + " " + "f" * 23 + " secretſ: nosuch1 SECRET:\x20\x20=abcdef",
    "user = alice then " + SECRET[:40] + " at https://db.example.com:5432 end",
    SECRET[:40] + " alone",
    "https://example.com alone",
    "login: bob " + "x " * 600 + SECRET[:40],
    "password=password=secret1 secret=abc",
    "é" * 30 + " passwd:abcdef12",
]


def brute_base(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        out += [(m.start(), 0, m.end())] if len(m[2]) >= 6 else []
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secrets(spark):
    rows = [(k, t) for k, t in enumerate(PLANTED)] + [(50, None), (51, ""), (None, PLANTED[0]), (0, PLANTED[0])]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = []
    for i, t in rows:
        b = brute_base(t or "")
        listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in b)
        want.append((i, *[sum(x[1] == k for x in b) for k in range(3)], hashlib.sha256(listed.encode()).hexdigest()))
    assert sorted((tuple(x)[:5] for x in got), key=key) == sorted(want, key=key)
    spans = {x["doc_id"]: x["spans"] for x in got}
    assert {p.split(":")[0] for p in spans[2].split(",")} == {"account", "key40", "endpoint"}
    assert spans[3] == spans[4] == spans[5] == spans[50] == ""


def brute_linked(parts, scope):
    """Weak candidates with complements, all pairs compared."""
    out = []
    for s, k, e in parts:
        kind = secrets.KINDS[k]
        if kind in secrets.NEEDS:
            near = {secrets.ROLE[secrets.KINDS[k2]] for s2, k2, e2 in parts if s2 < e + scope and e2 > s - scope and (s2 >= e or e2 <= s)}
            if all(any(r in near for r in group) for group in secrets.NEEDS[kind]):
                out.append((s, k, e))
    return out


def test_secret_links_against_all_pairs(spark):
    r = random.Random(10)
    texts = []
    for _ in range(30):
        bits = [r.choice(["user=alice9", SECRET[:40], "https://h.example.org/x", "AKIA" + "Z9" * 8, "token=abcdefg", "w " * r.randint(5, 300)]) for _ in range(8)]
        texts.append(" ".join(bits))
    got = {x["doc_id"]: x["spans"] for x in secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for k, t in enumerate(texts):
        parts = secrets.candidates(t)
        want = sorted([p for p in parts if p[1] < 3] + brute_linked(parts, secrets.SCOPE))
        assert got[k] == ",".join(f"{secrets.KINDS[b]}:{a}:{c}" for a, b, c in want)


def test_redact(spark):
    d = spark.createDataFrame([(k, t, "clash") for k, t in enumerate([*PLANTED, None])], "doc_id long, text string, spans string")
    got = {x["doc_id"]: x["text"] for x in secrets.redact(d).collect()}
    assert "hunter22" not in got[0] and got[0].count(secrets.MASK) == 2
    assert SECRET[:40] not in got[2] and got[3] == PLANTED[3] and got[8] is None


@pytest.mark.parametrize("form", ["AWS_SECRET_ACCESS_KEY={}", "AWS_SECRET_ACCESS_KEY = {}", "aws_secret_key=='{}'", "export KEY={};"])
def test_keys_after_an_equals_sign(spark, form):
    text = "AWS_ACCESS_KEY_ID=AKIA" + "Z9" * 8 + "\n" + form.format(SECRET[:40]) + "\n"
    rows = spark.createDataFrame([(1, text), (2, form.format(SECRET[:40])), (3, "AKIA" + "Z9" * 8 + " KEY=" + SECRET[:40] + "=")], "doc_id long, text string")
    at = text.index(SECRET[:40])
    spans = {x["doc_id"]: x["spans"] for x in secrets.scan(rows).collect()}
    assert f"key40:{at}:{at + 40}" in spans[1].split(",") and "key40" not in spans[2] + spans[3]
    assert SECRET[:40] not in {x["doc_id"]: x["text"] for x in secrets.redact(rows).collect()}[1]


# --- 9


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    hit = {j for k in range(len(words) - 7) if grams[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


def test_line_rules(spark, docs):
    r = random.Random(11)
    extra = [(800 + k, t, "", "", 0, 0, "") for k, t in enumerate(["a b c d e f g h " * 9, "x\nx\n \n \nx y\n", "# * | <>\n" * 5, " ".join(r.choice("ab") for _ in range(60)), prose(r, 30) + "\n" + prose(r, 30)])]
    d = docs.unionByName(spark.createDataFrame(extra, SCHEMA))
    got = line_rules.report(d).collect()
    rows = docs_rows() + extra
    assert sorted((tuple(x)[:7] for x in got), key=key) == sorted(((x[0], *brute_rules(x[1])) for x in rows), key=key)
    assert not any(x["kept"] and x["base_failed"] for x in got)


def test_line_rules_remove_lines_first(spark):
    r = random.Random(12)
    good = "\n".join(" ".join(r.sample(WORDS, 14)) + "." for _ in range(10))
    nav = "Home | News | Sport | Contact | Help"
    banner = "We use cookies on this site.\nAlle Rechte vorbehalten\nPOLITIQUE DE CONFIDENTIALITÉ\nHaga clic aquí"
    bad = "\n".join(" | ".join(r.sample(WORDS, 12)) for _ in range(10)) + "\n" + " ".join(r.sample(WORDS, 12)) + "."
    d = spark.createDataFrame([(1, f"{nav}\n{good}\n{banner}", 0), (2, bad, 0), (3, good, 0)], "doc_id long, text string, rules int")
    assert {x["doc_id"]: x["text"] for x in line_rules.keep_clean(d).collect()} == {1: good, 3: good}


def test_menus_and_common_words(spark):
    """Runs of short lines are a menu; words such as cookie in running text are none of page furniture."""
    r = random.Random(13)
    good = "\n".join(" ".join(r.sample(WORDS, 14)) + "." for _ in range(10))
    menu = "\n".join(["Home", "Products", "About us", "", "Contact", "News", "Sign in"] * 3)
    cookie = "Grandmother used to shape each cookie by hand and bake it until the edges were brown and crisp."
    poem = "Red sky,\nold sea,\nfar moon,\ncold wind,\ndark ship,\nhome."
    few = "Home\nNews\nSport\nHelp"
    texts = {1: f"{menu}\n{good}", 2: f"{good}\n{cookie}", 3: f"{good}\n{poem}", 4: f"{good}\n{few}", 5: f"{good}\nThis site uses cookies to improve your visit.\nPlease enable JavaScript"}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x["doc_id"]: x["text"] for x in line_rules.keep_clean(d).collect()}
    assert {k: got[k] for k in (2, 3, 4, 5)} == {2: texts[2], 3: texts[3], 4: texts[4], 5: good}
    assert [x for x in got[1].split("\n") if x] == good.split("\n")
    alone = spark.createDataFrame([(1, menu * 3)], "doc_id long, text string")
    assert line_rules.keep_clean(alone).count() == 0
