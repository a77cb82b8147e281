"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover the whole document
(the overlap is wider than a filter, so no window is lost). Learned filters
run over learned byte embeddings; each is max-pooled over a chunk. The mean
and the maximum of the pooled values over all chunks are combined into one
probability.

Training fits on a bounded sample of labelled rows: at most ``max_rows`` a
class and ``max_bytes`` of text in all, taken in the order of a hash of the id,
each with all chunks of its whole text. So the driver holds a bounded number
of MB whatever the corpus, and the sample, and with it the model, does not
depend on how the files are split. Class weights undo the sampling. Scoring reads every chunk of every text, a bounded
number of chunks at a time.

Defined results: a null or empty text is one chunk of padding and gets a
score; without rows of both classes the score is the share of class 1 (0.5 if
there are no labelled rows); repeated rows score alike, and an id that stands
for several texts is sampled with one of them; a text longer than
``max_bytes`` is scored but not sampled; an empty table gives
an empty table. Only the text is an input.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

CHUNK, STEP = 256, 208      # bytes of a chunk, and from one chunk's start to the next
WIDTH, DIM, FILTERS = 6, 5, 16
PAD = 256                   # embedding row of padding
MAX_ROWS = 3000             # labelled rows of a class to fit on
MAX_BYTES = 32 << 20        # bytes of their texts, all together
STEPS, BATCH, RATE = 500, 48, 0.01
SCORE_CHUNKS = 512          # chunks scored at a time
THRESHOLD = 0.3


@dataclass
class Net:
    embed: np.ndarray       # 257 x DIM, the last row stays zero
    filters: np.ndarray     # WIDTH * DIM x FILTERS
    shift: np.ndarray       # FILTERS
    out: np.ndarray         # 2 * FILTERS
    bias: float
    prior: float = 0.5
    fitted: bool = True


def chunks(text: str | None) -> np.ndarray:
    """All chunks of a text, one row of ``CHUNK`` byte values each."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    n = max(1, -(-max(0, len(raw) - CHUNK) // STEP) + 1)
    padded = np.full((n - 1) * STEP + CHUNK, PAD, np.int16)
    padded[:len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


def _windows(net: Net, x: np.ndarray) -> np.ndarray:
    """Embedded filter windows: chunk x position x (WIDTH * DIM)."""
    flat = net.embed[x].reshape(len(x), -1)
    return np.lib.stride_tricks.sliding_window_view(flat, WIDTH * DIM, axis=1)[:, ::DIM]


def pool(net: Net, x: np.ndarray) -> np.ndarray:
    """Max-pooled filter outputs of chunks, one row each."""
    w = _windows(net, x)
    act = np.ascontiguousarray(w).reshape(-1, WIDTH * DIM) @ net.filters
    return np.maximum(act.reshape(len(x), -1, FILTERS).max(1) + net.shift, 0)


def combine(net: Net, mean: np.ndarray, top: np.ndarray) -> np.ndarray:
    z = np.concatenate((mean, top), axis=-1) @ net.out + net.bias
    return 1 / (1 + np.exp(-z))


def score(texts: list[str | None], net: Net) -> np.ndarray:
    """Probability of class 1 for every whole text."""
    if not net.fitted:
        return np.full(len(texts), net.prior)
    total = np.zeros((len(texts), FILTERS), np.float64)
    top = np.zeros((len(texts), FILTERS), np.float32)
    count = np.zeros(len(texts))
    held: list[np.ndarray] = []
    owners: list[np.ndarray] = []

    def flush():
        if held:
            x, who = np.concatenate(held), np.concatenate(owners)
            held.clear()
            owners.clear()
            h = pool(net, x)
            lead = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
            own = who[lead]
            total[own] += np.add.reduceat(h, lead, axis=0)
            top[own] = np.maximum(top[own], np.maximum.reduceat(h, lead, axis=0))

    n = 0
    for i, t in enumerate(texts):
        c = chunks(t)
        count[i] = len(c)
        for at in range(0, len(c), SCORE_CHUNKS):
            part = c[at:at + SCORE_CHUNKS]
            held.append(part)
            owners.append(np.full(len(part), i))
            n += len(part)
            if n >= SCORE_CHUNKS:
                flush()
                n = 0
    flush()
    return combine(net, total / count[:, None], top).astype(float)


def train(x: np.ndarray, owner: np.ndarray, label: np.ndarray, weight: np.ndarray, seed: int = 11) -> Net:
    """Fit on chunks ``x`` of the texts ``owner`` (sorted) by Adam on the weighted log loss."""
    rng = np.random.default_rng(seed)
    net = Net(rng.normal(0, 0.5, (257, DIM)).astype(np.float32),
              rng.normal(0, (WIDTH * DIM) ** -0.5, (WIDTH * DIM, FILTERS)).astype(np.float32),
              np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS, np.float32), 0.0)
    net.embed[PAD] = 0
    first = np.searchsorted(owner, np.arange(len(label)))
    last = np.searchsorted(owner, np.arange(len(label)), side="right")
    classes = [np.flatnonzero(label == k) for k in (0, 1)]
    params = [net.embed, net.filters, net.shift, net.out, np.zeros(1, np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, STEPS + 1):
        ids = np.concatenate([rng.choice(c, BATCH // 2) for c in classes])
        rows = np.concatenate([np.arange(first[i], last[i]) for i in ids])
        sizes = last[ids] - first[ids]
        lead = np.cumsum(sizes) - sizes
        who = np.repeat(np.arange(len(ids)), sizes)
        cx = x[rows]
        w = np.ascontiguousarray(_windows(net, cx))
        act = (w.reshape(-1, WIDTH * DIM) @ net.filters).reshape(len(cx), -1, FILTERS)
        where = act.argmax(1)
        h = np.take_along_axis(act, where[:, None], 1)[:, 0] + net.shift
        on = h > 0
        h = h * on
        mean = np.add.reduceat(h, lead, axis=0) / sizes[:, None]
        top = np.maximum.reduceat(h, lead, axis=0)
        y = label[ids]
        p = 1 / (1 + np.exp(-(np.concatenate((mean, top), 1) @ net.out + params[4][0])))
        g = ((p - y) * weight[y] / weight[y].sum()).astype(np.float32)
        d_out = np.concatenate((mean, top), 1).T @ g
        d_mean, d_top = g[:, None] * net.out[:FILTERS], g[:, None] * net.out[FILTERS:]
        is_top = (h == top[who]) & on
        ties = np.maximum(np.add.reduceat(is_top.astype(np.float32), lead, axis=0), 1)
        dh = (d_mean / sizes[:, None])[who] + is_top * (d_top / ties)[who]
        dh *= on
        picked = np.take_along_axis(w, where[:, :, None], 1)        # chunk x filter x (WIDTH * DIM)
        d_filters = np.einsum("cfk,cf->kf", picked, dh)
        d_win = dh[:, :, None] * net.filters.T[None]
        at = where[:, :, None] + np.arange(WIDTH)
        bytes_at = cx[np.arange(len(cx))[:, None, None], at]
        d_embed = np.zeros_like(net.embed)
        np.add.at(d_embed, bytes_at.ravel(), d_win.reshape(-1, DIM))
        d_embed[PAD] = 0
        grads = [d_embed, d_filters, dh.sum(0), d_out, np.array([g.sum()], np.float32)]
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for q, d, (m, v) in zip(params, grads, moments):
            m += 0.1 * (d - m)
            v += 0.001 * (d * d - v)
            q -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    net.bias = float(params[4][0])
    return net


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label",
        max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> Net:
    """Fit on the texts of ``docs`` that ``labels`` gives label 0 or 1; see the module's text for the bounds.

    The sample is drawn from the labels; lists of at most ``2 * max_rows`` ids
    are broadcast, so no text is shuffled. An id with both labels counts as 0;
    a null id has none.
    """
    rows = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")) \
        .where("label in (0, 1) and key is not null").groupBy("key").agg(F.min("label").alias("label"))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n = sum(sizes.values())
    prior = sizes.get(1, 0) / n if n else 0.5
    unfitted = Net(*(np.zeros(1),) * 4, 0.0, prior=prior, fitted=False)
    if len(sizes) < 2:
        return unfitted
    share = F.when(F.col("label") == 1, min(1.0, max_rows / sizes[1])).otherwise(min(1.0, max_rows / sizes[0]))
    place = F.pmod(F.xxhash64("key", F.lit(5)), F.lit(1 << 20))
    listed = rows.where(place < share * float(1 << 20))
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # one text an id, and its length: the rows that fit the budget, in the order of the hash
    found = texts.join(F.broadcast(listed), "key").groupBy("key", "label") \
        .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), F.octet_length("text").alias("bytes"))).alias("t")) \
        .select("key", "label", "t.hash", "t.bytes", place.alias("place")).toPandas().sort_values(["place", "key"], kind="stable")
    wanted, held = [], 0
    for r in found.itertuples():
        if held + r.bytes <= max_bytes:
            held += r.bytes
            wanted.append((r.key, r.hash))
    if not wanted:
        return unfitted
    chosen = docs.sparkSession.createDataFrame(wanted, f"key {docs.schema[key].dataType.simpleString()}, hash long")
    held_texts = texts.withColumn("hash", F.xxhash64("text")).join(F.broadcast(chosen), ["key", "hash"]) \
        .groupBy("key").agg(F.first("text").alias("text")).collect()
    label_of = dict(zip(found["key"], found["label"]))
    sample = sorted((r["key"], r["text"]) for r in held_texts)
    y = np.array([label_of[k] for k, _ in sample])
    if len(set(y.tolist())) < 2:
        return unfitted
    parts = [chunks(t) for _, t in sample]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    net = train(np.concatenate(parts), owner, y, np.array([1 - prior, prior]))
    net.prior = prior
    return net


def quality_score(net: Net, text) -> F.Column:
    """Column with the probability of class 1 of a text column."""
    from pyspark.sql import SparkSession

    shared = SparkSession.active().sparkContext.broadcast(net)

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(score(list(texts), shared.value), dtype="float64")

    return pandas_udf(run, "double")(text)
