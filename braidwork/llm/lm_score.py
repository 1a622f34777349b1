"""A log-bilinear language model, trained with noise-contrastive estimation.

Gathered over all training texts, in tables and sums that Spark makes:

* the count of every word, a table as large as the corpus makes it;
* for the ``LEARNT`` most frequent words, how often each of the ``MARKS`` most
  frequent ones stands among the words before them, which tells words of one language
  or topic from others; they are clustered into topics and classes;
* how often each class follows each context, a context being the class of the word
  before and the topic that the words before it vote for by position weights.

The ``TOP`` most frequent words and the end are classes of their own, the other learnt
words share ``KINDS`` classes by their neighbours, all others ``TAIL`` classes by
their last letters, and the unseen word is a class too: every distinct word of a shared
class gives it a part of a count, in all as many as there are words that occur once.
The model's score of class w in context (v, t) is (r(v) + u(t)) . q(w) + b(w).  Every
step of the estimation passes over all gathered counts, and one batched matrix product
gives all normalised log-probabilities.  A word of a shared class has its class's
probability times its discounted share of the class, so the probabilities of all words
and of the unseen one sum to one.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stage

TOP, TAIL, RANK = 512, 64, 32
#: Words with learnt neighbours, words that they are learnt from, classes and topics.
LEARNT, MARKS, KINDS, TOPICS = 20_000, 96, 64, 12
#: Words whose counts are broadcast, at most; the others' are joined.
HEAD = 200_000
#: Weights of the words before, nearest first, in the vote for a topic.
WEIGHTS = (20, 18, 16, 14, 12, 10)
#: Tokens handled at a time; a long text more.
SLICE = 200_000
END = " "  # no word holds a space


def held_out(id_col, fold: int = 2, folds: int = 7):
    """Whether crc32 of the id as text leaves ``fold``; never where the id is null."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def tail_class(word: str) -> int:
    return zlib.crc32(word.encode()[-3:]) % TAIL


def tokenised(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, each token's word, first token of each text and the end).

    A-Z are lower-cased and ASCII white space splits; the last distinct word is END,
    and every text ends with it."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts.cast(pa.large_string()).fill_null(""))))
    words, edge = lists.values, lists.offsets.to_numpy()
    if pc.min(pc.binary_length(words)).as_py() == 0:  # an empty text has one empty part
        full = pc.binary_length(words).to_numpy() > 0
        edge = np.concatenate([[0], np.cumsum(full)])[edge]
        words = words.filter(pa.array(full))
    found = words.dictionary_encode()
    first = edge + np.arange(len(edge))
    word = np.ones(first[-1], bool)
    word[first[1:] - 1] = False
    at = np.full(first[-1], len(found.dictionary), np.int32)
    at[word] = found.indices.to_numpy()
    return [*found.dictionary.to_pylist(), END], at, first


def slices(first: np.ndarray):
    """(text, next text) of runs of texts of SLICE tokens, or one longer text."""
    lo = 0
    while lo < len(first) - 1:
        hi = max(lo + 1, int(np.searchsorted(first, first[lo] + SLICE, "right")) - 1)
        yield lo, hi
        lo = hi


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c) over all texts; batches are counted first, so the shuffle carries distinct words."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                words, at, _ = tokenised(b.column(0))
                yield pa.record_batch([pa.array(words), pa.array(np.bincount(at, minlength=len(words)))], ["word", "c"])

    return texts.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What scoring needs of the corpus, of bounded size."""

    n: int  # training tokens
    v: int  # distinct training tokens
    rank: dict[str, int] = field(repr=False)  # of the words in the head, by falling count; END is 0
    count: np.ndarray = field(repr=False)
    kind: np.ndarray = field(repr=False)  # class of each word of the head
    topic: np.ndarray = field(repr=False)  # TOPICS: none
    own: int = TOP  # words with a class of their own, besides the end
    tail_n: np.ndarray = None  # tokens of each shared class
    tail_v: np.ndarray = None  # distinct words of each shared class
    once: int = 0  # of those, the words that occur once

    @property
    def classes(self) -> int:
        """The end, own words, learnt classes, classes by letters, the unseen word."""
        return 1 + self.own + KINDS + TAIL + 1

    @property
    def present(self) -> np.ndarray:
        """Classes that have words; the unseen word's always has."""
        out = self.tail_v > 0
        out[: 1 + min(self.own, len(self.count) - 1)] = True
        out[-1] = True
        return out

    def letters(self, word: str) -> int:
        return 1 + self.own + KINDS + tail_class(word)

    @property
    def discount(self) -> float:
        """What each distinct word of a shared class gives to the unseen word: in all one
        count for each word that occurs once, but never more than 0.9 of a word's own."""
        return min(0.9, self.once / max(1, int(self.tail_v.sum())))

    def looked_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rank or -1, class, topic) of distinct words."""
        rank = np.array([self.rank.get(w, -1) for w in words], np.int64)
        kind, topic = self.kind[rank], self.topic[rank]
        for k in np.flatnonzero(rank < 0):
            kind[k], topic[k] = self.letters(words[k]), TOPICS
        return rank, kind, topic


def cutoff(counts: DataFrame, most: int) -> int:
    """The least count such that at most ``most`` words have it or more."""
    spread = counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(most).collect()
    room, least = most, 1 << 62
    for r in spread:
        room -= r["n"]
        if room < 0:
            break
        least = r["c"]
    return least


def head_of(counts: DataFrame, most: int, own: int) -> Vocabulary:
    """The head's words; all but ``own`` of them are classed by their letters so far."""
    least = cutoff(counts, most)
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    head = counts.where((F.col("c") >= least) & (F.col("word") != END)).toArrow()
    pairs = sorted(zip(head.column("word").to_pylist(), head.column("c").to_pylist()), key=lambda x: (-x[1], x[0]))
    ends = counts.where(F.col("word") == END).first()
    words = [END, *(w for w, _ in pairs)]
    count = np.array([ends["c"] if ends else 0, *(c for _, c in pairs)], np.int64)
    kind = np.array([k if k <= own else 1 + own + KINDS + tail_class(w) for k, w in enumerate(words)], np.int64)
    return Vocabulary(total["n"] or 0, total["v"] or 0, {w: k for k, w in enumerate(words)}, count, kind, np.full(len(words), TOPICS, np.int64), own)


def marks_before(texts: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """How often each of the MARKS most frequent words stands among the words before each learnt word."""
    shared = texts.sparkSession.sparkContext.broadcast(vocab.rank)

    def run(batches):
        for b in batches:
            words, at, first = tokenised(b.column(0))
            rank = np.array([shared.value.get(w, -1) for w in words], np.int64)
            for lo, hi in slices(first):
                r = rank[at[first[lo] : first[hi]]]
                keys = []
                for k in range(1, len(WEIGHTS) + 1):
                    target, mark = r[k:], r[:-k]
                    # An end between the two parts texts.
                    parted = np.cumsum(r == 0)
                    ok = (target > 0) & (target <= LEARNT) & (mark > 0) & (mark <= MARKS) & (parted[k:] == parted[:-k])
                    keys.append(target[ok] * (MARKS + 1) + mark[ok])
                pair, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.record_batch([pa.array(pair), pa.array(n)], ["pair", "n"])

    got = texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(((LEARNT + 1), MARKS + 1), np.int64)
    out.ravel()[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    return out


def grouped(x: np.ndarray, weight: np.ndarray, k: int, rounds: int = 25, seed: int = 5) -> np.ndarray:
    """Clusters of unit rows by cosine, weighted, from far-apart heavy rows."""
    g, n = np.random.default_rng(seed), len(x)
    if n <= k:
        return np.arange(n)
    centres, far = [int(np.argmax(weight))], np.full(n, np.inf)
    for _ in range(k - 1):
        far = np.minimum(far, 1 - x @ x[centres[-1]])
        chance = np.maximum(far, 0) * np.sqrt(weight)
        centres.append(int(g.choice(n, p=chance / chance.sum())) if chance.sum() > 0 else int(g.integers(n)))
    c, label = x[centres], None
    for _ in range(rounds):
        new = (x @ c.T).argmax(1)
        if label is not None and (new == label).all():
            break
        label = new
        sums = np.zeros_like(c)
        np.add.at(sums, label, x * weight[:, None])
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 0, sums / np.maximum(norm, 1e-9), c)
    return label


def learn_kinds(vocab: Vocabulary, before: np.ndarray) -> None:
    """Give learnt words their topics, and those without a class of their own learnt classes."""
    n = min(LEARNT, len(vocab.count) - 1)
    seen = before[1 : n + 1, 1:].astype(np.float64)
    enough = np.flatnonzero(seen.sum(1) >= 5)
    if len(enough) < TOPICS:
        return
    share = (seen[enough].sum(0) + 1) / (seen[enough].sum() + MARKS)
    x = np.sqrt(seen[enough] / seen[enough].sum(1, keepdims=True)) - np.sqrt(share)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    x = x.astype(np.float32)
    weight = np.sqrt(vocab.count[1 + enough].astype(np.float64))
    vocab.topic[1 + enough] = grouped(x, weight, TOPICS)
    rest = enough >= vocab.own
    if rest.any():
        vocab.kind[1 + enough[rest]] = 1 + vocab.own + grouped(x[rest], weight[rest], KINDS)


def tail_sums(counts: DataFrame, vocab: Vocabulary) -> None:
    """Tokens, distinct words and words that occur once of the shared classes, over all words."""
    size, base = vocab.classes, 1 + vocab.own
    shared = counts.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        n, v, once = (np.zeros(size, np.int64) for _ in range(3))
        for b in batches:
            words, c = b.column(0).to_pylist(), b.column(1).to_numpy()
            kind = shared.value.looked_up(words)[1]
            np.add.at(n, kind, c)
            v += np.bincount(kind, minlength=size)
            once += np.bincount(kind[c == 1], minlength=size)
        yield pa.record_batch([pa.array(range(size), pa.int32()), pa.array(n), pa.array(v), pa.array(once)], ["k", "n", "v", "once"])

    vocab.tail_n, vocab.tail_v = np.zeros(size, np.int64), np.zeros(size, np.int64)
    sums = counts.mapInArrow(run, "k int, n long, v long, once long").where(F.col("k") >= base).groupBy("k").agg(*[F.sum(x).alias(x) for x in ("n", "v", "once")])
    for r in sums.collect():
        vocab.tail_n[r["k"]], vocab.tail_v[r["k"]] = r["n"], r["v"]
        vocab.once += r["once"]


def vocabulary(texts: DataFrame, counts: DataFrame, most: int = HEAD, own: int = TOP) -> Vocabulary:
    vocab = head_of(counts, most, own)
    learn_kinds(vocab, marks_before(texts, vocab))
    tail_sums(counts, vocab)
    return vocab


def contexts(kind: np.ndarray, topic: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each token's context: the class before times TOPICS + 1, plus the topic voted for."""
    n = len(kind)
    text = np.concatenate([[0], np.cumsum(ends, dtype=np.int32)[:-1]])
    votes = np.zeros((n, TOPICS + 1), np.int16)
    votes[:, TOPICS] = 1  # none, unless some word votes
    for k, weight in enumerate(WEIGHTS, 1):
        row = np.flatnonzero((text[k:] == text[:-k]) & (topic[:-k] < TOPICS)) + k
        votes[row, topic[row - k]] += weight
    before = np.concatenate([[0], kind[:-1]])
    return before * (TOPICS + 1) + votes.argmax(1)


def class_counts(texts: DataFrame, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(contexts, counts): how often each class follows each context that occurs."""
    size, shared = vocab.classes, texts.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        for b in batches:
            words, at, first = tokenised(b.column(0))
            _, kind, topic = shared.value.looked_up(words)
            for lo, hi in slices(first):
                here = at[first[lo] : first[hi]]
                k = kind[here]
                pair, n = np.unique(contexts(k, topic[here], here == len(words) - 1) * size + k, return_counts=True)
                yield pa.record_batch([pa.array(pair), pa.array(n)], ["pair", "n"])

    got = texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pair, n = got.column("pair").to_numpy(), got.column("n").to_numpy()
    seen = np.unique(pair // size)
    out = np.zeros((len(seen), size), np.float32)
    out[np.searchsorted(seen, pair // size), pair % size] = n
    # Absolute discounting: every distinct word of a shared class leaves a part of a count.
    left = np.where(vocab.tail_n > 0, vocab.discount * vocab.tail_v / np.maximum(vocab.tail_n, 1), 0.0).astype(np.float32)
    out[:, -1] = out @ left
    out[:, :-1] *= 1 - left[:-1]
    return seen, out


@dataclass
class LogBilinear:
    r: np.ndarray  # what the class before says of the next
    u: np.ndarray  # what the topic does
    q: np.ndarray
    b: np.ndarray

    def log_probabilities(self, present: np.ndarray) -> np.ndarray:
        """Natural logs, normalised over the classes present: row v * (TOPICS + 1) + t holds
        those of every class in context (v, t)."""
        out = np.empty((len(self.r) * len(self.u), len(self.q)), np.float32)
        for v in range(len(self.r)):
            s = ((self.r[v] + self.u) @ self.q.T + self.b).astype(np.float64)
            s[:, ~present] = -np.inf
            s -= s.max(1, keepdims=True)
            out[v * len(self.u) : (v + 1) * len(self.u)] = s - np.log(np.exp(s).sum(1, keepdims=True))
        return out


def fit_nce(seen: np.ndarray, counts: np.ndarray, rank: int = RANK, noise: float = 256.0, steps: int = 120, rate: float = 0.08, seed: int = 11) -> LogBilinear:
    """Noise-contrastive estimation with the unigram distribution as noise.

    Every step passes over all gathered counts: a context's data are its counts, its
    noise what ``noise`` draws for each of them would give on average."""
    g, size = np.random.default_rng(seed), counts.shape[1]
    each = counts.sum(1, keepdims=True)
    total = float(each.sum())
    unigram = (counts.sum(0) + 0.5) / (total + 0.5 * size)
    net = LogBilinear(*[g.normal(0, 0.1, (n, rank)).astype(np.float32) for n in (size, TOPICS + 1, size)], np.log(unigram).astype(np.float32))
    if not total:
        return net
    v, t = seen // (TOPICS + 1), seen % (TOPICS + 1)
    log_noise = np.log(unigram * noise).astype(np.float32)
    # Frequent contexts would drown the others: a context weighs as the root of its count.
    weight = (1 / np.sqrt(each)).astype(np.float32)
    weight /= float((weight * each).sum())
    parts = [net.r, net.u, net.q, net.b]
    m, s = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for k in range(1, steps + 1):
        h = net.r[v] + net.u[t]
        data = 1 / (1 + np.exp(np.clip(log_noise - net.b - h @ net.q.T, -30, 30)))  # P(data) of each pair
        push = (counts * (1 - data) - each * (noise * unigram).astype(np.float32) * data) * weight
        dh = push @ net.q
        grads = [np.zeros_like(p) for p in parts]
        np.add.at(grads[0], v, dh)
        np.add.at(grads[1], t, dh)
        grads[2], grads[3] = push.T @ h, push.sum(0)
        step = rate * (1 - (k - 1) / steps) + 1e-3
        for p, d, a, b in zip(parts, grads, m, s):
            a += 0.1 * (d - a)
            b += 0.05 * (d * d - b)
            p += step * (a / (1 - 0.9**k)) / (np.sqrt(b / (1 - 0.95**k)) + 1e-9)
    return net


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", steps: int = 120, most: int = HEAD, own: int = TOP) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row.

    Null and empty texts are the end alone.  Rows with a null id count as training
    rows; repeated rows count and are scored each time.  With no training row at all,
    every word is unseen.  Scores are log10 of the whole text's probability, all unseen
    words being one.  ``most`` words' counts are broadcast at most; ``own`` words have a
    class of their own.
    """
    spark = docs.sparkSession
    train = docs.where(~held_out(id_col)).select(F.col(text_col).cast("string").alias("text"))
    counts = stage(count_words(train), "word-counts")
    vocab = vocabulary(train, counts, most, own)
    net = fit_nce(*class_counts(train, vocab), steps=steps)
    table = (net.log_probabilities(vocab.present) / np.log(10)).astype(np.float32)
    base = -float(np.log10(vocab.n + vocab.v + 1))
    room = np.maximum(vocab.tail_n - vocab.discount * vocab.tail_v, 1e-9)  # what shares are of
    shared = spark.sparkContext.broadcast((vocab, table, -np.log10(room)))

    def run(batches):
        vocab, table, share = shared.value
        lost = vocab.discount
        for b in batches:
            words, at, first = tokenised(b.column(2))
            rank, kind, topic = vocab.looked_up(words)
            count = np.where(rank >= 0, vocab.count[rank], 0)
            tail, known = kind > vocab.own, rank >= 0
            inner = np.where(tail, share[kind] + np.log10(np.maximum(count - lost, 1e-9)), 0.0)
            docs_at = 0
            for lo, hi in slices(first):
                here = at[first[lo] : first[hi]]
                text = np.repeat(np.arange(hi - lo), np.diff(first[lo : hi + 1]))
                ctx = contexts(kind[here], topic[here], here == len(words) - 1)
                per = lambda x: np.bincount(text, x, hi - lo)
                seen = table[ctx, kind[here]].astype(np.float64)
                unseen = table[ctx, -1].astype(np.float64)
                far = ~known[here]
                # Words beyond the head count as unseen until the join finds them.
                model = per(np.where(far, unseen, seen + inner[here]))
                own = per(np.log10(count[here] + 1.0) + base)
                pair, which = np.unique(text[far] * len(words) + here[far], return_inverse=True)
                gain = np.bincount(which, (seen - unseen)[far] + share[kind[here[far]]], len(pair)).astype(np.float64)
                edges = np.searchsorted(pair, np.arange(hi - lo + 1) * len(words))
                lists = [pa.array(words).take(pa.array(pair % len(words))), pa.array(np.bincount(which, minlength=len(pair))), pa.array(gain)]
                rare = [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), x) for x in lists]
                rows = b.slice(lo, hi - lo)
                yield pa.record_batch(
                    [rows.column(0), rows.column(1), pa.array(np.diff(first[lo : hi + 1])), pa.array(per(count[here] > 0).astype(np.int64)), pa.array(own), pa.array(model), *rare],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare", "times", "turns"],
                )

    some = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, rare array<string>, times array<long>, turns array<double>"
    rows = stage(some.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    # Words beyond the broadcast head: their counts come by a join, and only if they have any.
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times", "turns")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"), F.col("x.turns").alias("turns"))
    least = int(vocab.count[1:].min()) if len(vocab.count) > 1 else 0
    c = F.col("c")
    found = rare.join(counts.where(c < least) if least else counts, "word").groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(c + 1.0)).alias("gain"), F.sum(F.col("turns") + F.col("times") * F.log10(c - F.lit(float(vocab.discount)))).alias("turn")
    )
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return rows.drop("rare", "times", "turns").join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens", plus("n_known", "more"), F.lit(vocab.n).cast("long").alias("train_tokens"), plus("base_score", "gain"), plus("score", "turn")
    )
