"""A byte-level convolutional network for text quality, in numpy.

A learned filter of width ``WIDTH`` is a table of 256 weights per position, so a
convolution over bytes is a sum of table look-ups.  Each filter's responses are
max-pooled over chunks that overlap by half and cover the whole text; the chunks'
mean and maximum go through one hidden layer into a probability.

The network is fitted on the driver from a bounded sample of labelled rows (at most
``sample`` rows and ``sample_bytes`` bytes of text, those of lowest hash); scoring runs
in Arrow batches on every row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTERS, WIDTH, HALF, HIDDEN = 12, 5, 128, 16
#: Labelled rows to learn from, at most; passes over them.
SAMPLE, EPOCHS = 3000, 8
#: Bytes of text to learn from, at most.
SAMPLE_BYTES = 64 << 20
CUT = 0.3
#: Bytes convolved at a time, so that memory doesn't grow with a text.
SPAN = HALF * 512


@dataclass
class Net:
    tables: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def parts(self):
        return [self.tables, self.bias, self.w1, self.b1, self.w2, self.b2]


def fresh_net(seed: int = 7) -> Net:
    r = np.random.default_rng(seed)
    f = np.float32
    return Net(r.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(f), np.zeros(FILTERS, f), r.normal(0, 0.3, (2 * FILTERS, HIDDEN)).astype(f), np.zeros(HIDDEN, f), r.normal(0, 0.3, HIDDEN).astype(f), np.zeros(1, f))


def blank_net() -> Net:
    """A net that knows nothing: it scores 0.5."""
    net = fresh_net()
    net.w2 *= 0
    return net


def half_maxima(net: Net, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Per half chunk and filter: the largest response and its position.

    Every byte starts one window; windows at the end read zeros beyond it."""
    raw = np.frombuffer(text or b"\0", np.uint8)
    best, where = [], []
    for lo in range(0, len(raw), SPAN):
        n = min(SPAN, len(raw) - lo)
        data = raw[lo : lo + n + WIDTH - 1]
        if len(data) < n + WIDTH - 1:
            data = np.concatenate([data, np.zeros(n + WIDTH - 1 - len(data), np.uint8)])
        out = net.tables[0].take(data[:n], axis=0)
        for k in range(1, WIDTH):
            out += net.tables[k].take(data[k : k + n], axis=0)
        whole = n // HALF * HALF
        if whole:
            blocks = out[:whole].reshape(-1, HALF, FILTERS)
            at = blocks.argmax(1)
            best.append(np.take_along_axis(blocks, at[:, None], 1)[:, 0])
            where.append(at + lo + np.arange(0, whole, HALF)[:, None])
        if whole < n:
            at = out[whole:].argmax(0)
            best.append(out[whole:][at, np.arange(FILTERS)][None])
            where.append((at + lo + whole)[None])
    return np.concatenate(best), np.concatenate(where)


def pooled(net: Net, text: bytes):
    """Mean and maximum over chunks (two halves each) of the pooled responses."""
    best, where = half_maxima(net, text)
    if len(best) > 1:
        right = best[1:] > best[:-1]
        chunk = np.where(right, best[1:], best[:-1])
        place = np.where(right, where[1:], where[:-1])
    else:
        chunk, place = best, where
    act = np.tanh(chunk + net.bias)
    top = act.argmax(0)
    return np.concatenate([act.mean(0), act[top, np.arange(FILTERS)]]), act, place, top


def probability(net: Net, features: np.ndarray) -> np.ndarray:
    hidden = np.tanh(features @ net.w1 + net.b1)
    return 1 / (1 + np.exp(-np.clip(hidden @ net.w2 + net.b2, -30, 30)))


def score(net: Net, text: bytes | None) -> float:
    """0 to 1; a null text scores as an empty one."""
    return float(probability(net, pooled(net, text or b"")[0][None])[0])


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, batch: int = 16, rate: float = 0.01, seed: int = 7) -> Net:
    """Adam on the log loss, with both labels weighing the same in all."""
    if not texts:
        return blank_net()
    net = fresh_net(seed)
    y = np.array(labels, np.float32)
    share = np.clip(y.mean(), 0.02, 0.98)
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) ** 0.5
    parts = net.parts()
    m, v, t = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    order, filters = np.random.default_rng(seed), np.arange(FILTERS)
    for epoch in range(epochs):
        for k in np.array_split(order.permutation(len(texts)), -(-len(texts) // batch)):
            seen = [pooled(net, texts[i]) for i in k]
            x = np.stack([s[0] for s in seen])
            hidden = np.tanh(x @ net.w1 + net.b1)
            p = 1 / (1 + np.exp(-np.clip(hidden @ net.w2 + net.b2, -30, 30)))
            d = ((p - y[k]) * weight[k] / len(k)).astype(np.float32)
            dh = d[:, None] * net.w2 * (1 - hidden**2)
            dx = dh @ net.w1.T
            grads = [np.zeros_like(net.tables), np.zeros_like(net.bias), x.T @ dh, dh.sum(0), hidden.T @ d, np.array([d.sum()], np.float32)]
            for i, (_, act, place, top), g in zip(k, seen, dx):
                da = np.broadcast_to(g[:FILTERS] / len(act), act.shape).copy()
                da[top, filters] += g[FILTERS:]
                da *= 1 - act**2
                grads[1] += da.sum(0)
                raw = np.frombuffer((texts[i] or b"\0") + bytes(WIDTH), np.uint8)
                for j in range(WIDTH):
                    np.add.at(grads[0][j], (raw[place + j], filters[None, :]), da)
            t += 1
            step = rate * 0.5 ** (epoch / max(1, epochs / 3))
            for p_, g, a, b in zip(parts, grads, m, v):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p_ -= step * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-6)
    return net


def held_out(id_col: str, folds: int = 5):
    """Whether crc32 of the id as text leaves 0; rows with a null id are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, epochs: int = EPOCHS, sample_bytes: int = SAMPLE_BYTES) -> Net:
    """Fit on at most ``sample`` labelled rows of at most ``sample_bytes``, none held out.

    Null labels are left out; an id with several labels or texts gives a row for each
    pair of them, one for equal pairs.  Of all such rows those of lowest hash are taken,
    as long as they fit.  Without any the net can't be fitted, and all scores are 0.5.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).distinct()
    # Twice the rows, so that ids without a document leave enough.
    chosen = known.where(~held_out("_id")).orderBy(F.xxhash64("_id"), "_id", "_label").limit(2 * sample)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")).join(F.broadcast(chosen), "_id")
    place = [F.xxhash64("_id"), F.col("_id"), F.col("_label"), F.xxhash64("_text")]
    # The bound on bytes is held before any text is sent: sizes first, then the texts.
    sizes = rows.select(*[c.alias(f"_{k}") for k, c in enumerate(place)], F.octet_length("_text").alias("n")).distinct().orderBy("_0", "_1", "_2", "_3").limit(sample).collect()
    fits, total = [], 0
    for r in sizes:
        if total + r["n"] > sample_bytes:
            continue  # this one doesn't fit, others may
        total += r["n"]
        fits.append((r["_1"], r["_2"], r["_3"]))
    if not fits:
        if sizes:
            raise ValueError(f"none of {len(sizes)} labelled texts fits into sample_bytes={sample_bytes}")
        return blank_net()
    wanted = docs.sparkSession.createDataFrame(fits, rows.select("_id", "_label", place[3].alias("_h")).schema)
    got = rows.withColumn("_h", place[3]).join(F.broadcast(wanted), ["_id", "_label", "_h"]).dropDuplicates(["_id", "_label", "_h"]).orderBy(F.xxhash64("_id"), "_id", "_label", "_h").toArrow()
    return fit(got.column("_text").cast(pa.binary()).to_pylist(), got.column("_label").to_pylist(), epochs=epochs)


def with_score(docs: DataFrame, net: Net, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a column ``out``; every row is scored from its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([score(shared.value, t.encode() if t is not None else None) for t in texts], dtype="float64")

    run = run.asNondeterministic()  # scored once, even where the score is used twice
    return docs.withColumn(out, run(F.col(text_col).cast("string")))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row for each row, repeated ones too."""
    net = train(docs, labels, id_col, text_col, **how)
    scored = with_score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), net)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
