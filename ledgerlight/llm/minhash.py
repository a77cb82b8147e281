"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Sketch: every word shingle is hashed to one of ``t`` coordinates and to a
value, round after round, until each coordinate holds a value; a coordinate
keeps the smallest ``(round, value)`` it saw. After ``t`` rounds an empty
coordinate is filled by a round of its own, so none stays empty and the share
of equal coordinates of two sketches is concentrated around the Jaccard
similarity as if all were independent, at the cost of one round for a long
text.

Links: documents with equal sets are one class. Classes that share a band of
``ROWS`` coordinates are candidates; a link is confirmed on the full shingle
sets (64-bit fingerprints). A bucket is never expanded to all pairs, see
:func:`ledgerlight.llm.common.link_buckets`. At a similarity of 0.8 two classes share no band with
probability 1.2e-5 (less above it).

Defined results: a null or wordless text has an empty set and links with
nothing; a text of fewer words than a shingle is one shingle; a null id links
with nothing, its component is null and it is kept; rows that share an id are
judged each by its own text; an empty table gives an empty table. Only the
named columns are looked at.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import broadcast_if_short, components, link_buckets, materialise, own_ids, shared_buckets, with_rest

BANDS, ROWS = 48, 7
PERCENT = 80
WORDS = 5
BLOCK = 1 << 19             # bytes hashed at a time
CELL = 256                  # texts on a side of a block comparison
BROADCAST_ROWS = 500_000    # a list of ids or buckets up to this long (8 MB) is broadcast, a longer one joined by shuffle

_U = np.uint64
_NONE = _U(0xFFFFFFFFFFFFFFFF)
_P = 0x9E3779B97F4A7C15 | 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(1)
def _byte_values() -> np.ndarray:
    v = np.arange(256)
    v[65:91] += 32      # A-Z count as a-z
    return _mix(v.astype(np.uint64) + _U(0x1234567))


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, _P, np.uint64), np.full(n + 1, pow(_P, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word (run of bytes other than space and TAB..CR), A-Z in lower case."""
    size = BLOCK
    while size < len(raw):
        size *= 2
    up, down = _powers(size)
    x = np.frombuffer(raw, np.uint8)
    blank = np.ones(len(x) + 2, bool)
    blank[1:-1] = (x == 32) | ((x >= 9) & (x <= 13))
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = edge[0::2], edge[1::2]
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(_byte_values()[x] * up[:len(x)], out=total[1:], dtype=np.uint64)
    value = (total[end] - total[start]) * down[start]
    return _mix(value + (end - start).astype(np.uint64) * _U(0x2545F4914F6CDD1D)), start


def _split(raw: bytes) -> list[bytes]:
    """A long text in pieces of about ``BLOCK`` bytes that end at white space."""
    out, at = [], 0
    while len(raw) - at > 2 * BLOCK:
        cut = at + BLOCK
        while cut < len(raw) and raw[cut] not in b" \t\n\x0b\x0c\r":
            cut += 1
        out.append(raw[at:cut])
        at = cut
    return [*out, raw[at:]]


def _set_of(h: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct shingle fingerprints of a sequence of word hashes."""
    k = min(words, len(h))
    if k == 0:
        return h
    n = len(h) - k + 1
    s = np.full(n, k if len(h) < words else 0, np.uint64)
    for j in range(k):
        s = (s ^ h[j:n + j]) * _U(0xFF51AFD7ED558CCD)
        s ^= s >> _U(32)
    return np.unique(s)


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """The shingle set of every whole text, as sorted 64-bit fingerprints."""
    raws = [(t or "").encode() for t in texts]
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(raws)
    block, held = [], 0

    def flush():
        h, start = word_hashes(b"\n".join(raws[i] for i in block))
        ends = np.cumsum([len(raws[i]) + 1 for i in block])
        for i, part in zip(block, np.split(h, np.searchsorted(start, ends[:-1]))):
            out[i] = _set_of(part, words)

    for i, r in enumerate(raws):
        if len(r) > 2 * BLOCK:
            out[i] = _set_of(np.concatenate([word_hashes(p)[0] for p in _split(r)]), words)
            continue
        block.append(i)
        held += len(r) + 1
        if held >= BLOCK:
            flush()
            block, held = [], 0
    if block:
        flush()
    return out


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """Sketch of every non-empty set: one row of ``t`` coordinates."""
    s = np.full((len(sets), t), _NONE, np.uint64)
    flat = s.reshape(-1)
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    for i in range(2 * t):
        if not len(values):
            break
        h = _mix(values ^ _mix(np.array([i + 1], np.uint64)))
        at = owner * t + ((h >> _U(40)) % _U(t)).astype(np.int64) if i < t else owner * t + (i - t)
        np.minimum.at(flat, at, (_U(i) << _U(40)) | (h & _U((1 << 40) - 1)))
        live = np.flatnonzero((s == _NONE).any(1))
        if len(live) < len(s):
            more = np.zeros(len(s), bool)
            more[live] = True
            keep = more[owner]
            if not keep.all():
                values, owner = values[keep], owner[keep]
    return s


def band_keys(s: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of each sketch; the band's number goes into the key."""
    b = s.reshape(len(s), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), b.shape[:2]).copy()
    for j in range(rows):
        key = _mix((key * _U(_P)) ^ b[:, :, j])
    return key.view(np.int64)


def jaccard_at_least(a: bytes, b: bytes, percent: int) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _prepare(words: int, bands: int, rows: int):
    """Rows of key, set size, set digest and band keys from rows of key and text."""
    def run(batches):
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.iloc[at:at + 512]
                sets = shingle_sets(list(part["text"]), words)
                full = [k for k, x in enumerate(sets) if len(x)]
                keys = dict(zip(full, band_keys(sketches([sets[k] for k in full], bands * rows), bands, rows)))
                yield pd.DataFrame({
                    "key": part["key"].to_numpy(), "text_hash": part["text_hash"].to_numpy(), "n": [len(x) for x in sets],
                    "digest": [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets],
                    "bands": [keys.get(k, []) for k in range(len(sets))]})
    return run


def _sets(words: int):
    def run(batches):
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.iloc[at:at + 512]
                yield pd.DataFrame({"id": part["key"].to_numpy(),
                                    "set": [x.tobytes() for x in shingle_sets(list(part["text"]), words)]})
    return run


def _sets_of(texts: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``(id, set)`` of the texts listed in the written table ``ids (id)``: by broadcast if it is short, else by shuffle."""
    listed = broadcast_if_short(ids, BROADCAST_ROWS)
    return materialise(texts.join(listed, texts["key"] == ids["id"], "left_semi")
                       .mapInPandas(_sets(words), "id long, set binary"), "sets")


def verified(texts: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough. ``texts`` has ``key, text``.

    Only texts that occur in a pair are read into sets. A short list of ids
    (counted first) is broadcast to the scan, a longer one joined by shuffle.
    """
    ids = materialise(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "ids")
    sets = _sets_of(texts, ids, words)
    near = pandas_udf(lambda x, y: pd.Series([jaccard_at_least(p, q, percent) for p, q in zip(x, y)], dtype=bool), "boolean")
    return pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a") \
        .join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b") \
        .where(near("set_a", "set_b")).select("a", "b").distinct()


def _common(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Owner and column of every shingle that more than one of the sets has; columns are numbered from 0."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = n[column] > 1
    _, column = np.unique(column[keep], return_inverse=True)
    return owner[keep], column


def intersections(left: list[np.ndarray], right: list[np.ndarray], width: int = 1 << 14) -> np.ndarray:
    """Sizes of the intersections of all left sets with all right sets, ``width`` shared shingles at a time."""
    owner, column = _common([*left, *right])
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [at, at + width])
        has = np.zeros((len(left) + len(right), width), np.float32)
        has[owner[i:j], column[i:j] - at] = 1
        both += (has[:len(left)] @ has[len(left):].T).astype(np.int64)
    return both


def clump_links(texts: DataFrame, mixed: DataFrame, words: int, percent: int, cell: int = CELL) -> DataFrame:
    """Links ``(a, b)`` among members ``(band, rep, label)`` of shared buckets that have different labels.

    Members that hang together by buckets are a clump. A clump is cut into
    blocks of about ``cell`` and a task compares two blocks: all intersections
    of their full sets as one matrix product. Only links that join two labels
    leave the task. Every set is sent once per block of its clump, so the
    shuffled rows, as the comparisons, grow with the square of a clump.
    """
    lead = mixed.groupBy("band").agg(F.min("rep").alias("a"))
    clump = components(mixed.join(lead, "band").select("a", F.col("rep").alias("b"))).withColumnRenamed("component", "clump")
    of = materialise(mixed.select(F.col("rep").alias("id"), "label").distinct().join(clump, "id"), "clumps")
    blocks = of.groupBy("clump").agg(F.ceil(F.count("*") / cell).alias("blocks"))
    dealt = of.join(blocks, "clump").withColumn("mine", F.pmod(F.xxhash64("id"), "blocks")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
        .withColumn("x", F.least("mine", "other")).withColumn("y", F.greatest("mine", "other"))
    sets = _sets_of(texts, materialise(of.select("id"), "ids"), words)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = (pdf[pdf["mine"] == pdf[side].iloc[0]] for side in ("x", "y"))
        found = []
        if len(left) and len(right):
            a, b = ([np.frombuffer(v, np.uint64) for v in side["set"]] for side in (left, right))
            both = intersections(a, b)
            size = np.add.outer([len(v) for v in a], [len(v) for v in b])
            la, lb = left["label"].to_numpy(), right["label"].to_numpy()
            near = (both > 0) & (100 * both >= percent * (size - both)) & (la[:, None] != lb[None, :])
            seen = set()
            for i, j in zip(*np.nonzero(near)):
                pair = (min(la[i], lb[j]), max(la[i], lb[j]))
                if pair not in seen:
                    seen.add(pair)
                    found.append((int(left["id"].iloc[i]), int(right["id"].iloc[j])))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return dealt.join(sets, "id").groupBy("clump", "x", "y").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: ``key, n_shingles, component_id, kept, text_hash, leads``.

    ``key`` is an integer column. The sketch table, classes, buckets with more
    than one member, pairs and links are written to the shared folder; none is
    collected. ``leads`` is true for the texts that stand for their component;
    it differs from ``kept`` only where texts that are near share an id.
    """
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")) \
        .withColumn("text_hash", F.xxhash64("text"))
    known, ids = own_ids(texts.where("key is not null"), "key", "text_hash")
    schema = "key long, text_hash long, n long, digest binary, bands array<long>"
    prepared = materialise(known.mapInPandas(_prepare(words, bands, rows), schema), "sketch")
    classes = materialise(prepared.where("n > 0").groupBy("digest")
                          .agg(F.min("key").alias("rep"), F.first("bands").alias("bands")), "classes")

    members = shared_buckets(classes.select("rep", F.explode("bands").alias("band")), BROADCAST_ROWS)
    label = link_buckets(members, lambda pairs: verified(known, pairs, words, percent),
                         lambda mixed: clump_links(known, mixed, words, percent))
    of_class = classes.select("digest", "rep").join(label.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("digest", F.coalesce("component", "rep").alias("component"))
    done = prepared.select("key", "text_hash", "n", "digest").join(of_class, "digest", "left") \
        .select("key", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component_id")) \
        .withColumn("leads", F.col("key") == F.col("component_id"))
    if ids is not None:     # back to the ids that texts share
        for c in ("key", "component_id"):
            done = done.join(ids.select(F.col("own").alias(c), F.col("key").alias("theirs")), c) \
                .withColumn(c, F.col("theirs")).drop("theirs")
    # rows without an id take no part
    lost = texts.where("key is null").withColumn("key", F.lit(0).cast("long")) \
        .mapInPandas(_prepare(words, bands, rows), schema) \
        .select(F.lit(None).cast("long").alias("key"), "text_hash", F.col("n").alias("n_shingles"),
                F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("leads"))
    return done.unionByName(lost).select(
        F.col("key").alias(key), "n_shingles", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"),
        "text_hash", "leads")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` without the near duplicates of a document with a smaller id, all columns.

    Rows that share id and text stay or go together; of near texts that share
    an id one stays.
    """
    gone = materialise(near_duplicates(docs.select(key, text), key, text, words).where("not leads")
                       .select(F.col(key).alias("__key"), F.col("text_hash").alias("__hash")).distinct(), "gone")

    def without(rows: DataFrame) -> DataFrame:
        return rows.join(broadcast_if_short(gone, BROADCAST_ROWS),
                         (F.col(key) == F.col("__key")) & (F.xxhash64(text) == F.col("__hash")), "left_anti")

    return with_rest(docs, [key, text], without)
