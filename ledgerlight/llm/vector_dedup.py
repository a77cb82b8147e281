"""Near-duplicate vectors by sorted projection passes.

Each pass hashes every vector to the signs of ``BITS`` random projections and
sorts the vectors lexicographically by them. Neighbours in that order, up to
``WINDOW`` places apart, are compared by cosine in double precision; pairs
that are similar enough join components across all passes. Vectors with the
same label only are compared. The sort is a range partition, each partition a
stream that remembers ``WINDOW`` vectors; the ends of neighbouring partitions
are compared in a second, small step. A pass reports a spanning forest of what
it found, so a big group costs one row a vector, not all pairs.

The window caps the partners that a pass looks at, and vectors of a label that
share a direction share most signs, so the passes alone miss links. They only
find most components cheaply. After them all pairs of vectors of one label and
length are compared, so every link is found and every count is exact, however
the vectors lie. Its rows are shuffled once: rounds broadcast a piece of a
label and scan the rest of it, and what leaves a task are counts and the links
between different components. Equal vectors are one class with a multiplicity,
so copies cost nothing; the comparisons are the square of the *different*
vectors of a label, and a label of several pieces is scanned once for each.

Defined results: a null label, a null, empty or zero vector, and a vector with
a null or non-finite component link with nothing; vectors of different length
do not link; a null id links with nothing, its component is null and it is
kept; rows that share an id are judged each by its own vector; an empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_short, components, materialise, own_ids, shared_path

PASSES, BITS, WINDOW = 16, 64, 32
MIN_COSINE = 0.98
CELL = 512          # rows compared at a time
HELD_BYTES = 1 << 25        # vectors that a round of the comparison of all pairs broadcasts
BROADCAST_ROWS = 100_000    # groups whose sizes are broadcast
SEED = 4
_CLASS = "rep long, grp string, raw binary"
_FOUND = "a long, b long, part int, side int, at int, band int, grp string, raw binary"
_PAIRS = "a long, b long, n long"


def planes(dim: int, band: int, bits: int) -> np.ndarray:
    return np.random.default_rng((SEED, dim, band)).normal(size=(dim, bits))


def _clean(batches):
    """Key, group (label and length), digest and the vector's doubles; group null if it cannot link."""
    for b in batches:
        rows = []
        for k, label, v in zip(b["key"], b["label"], b["vector"]):
            raw = None
            if v is not None and label is not None and not pd.isna(k) and len(v):
                x = np.array([np.nan if e is None else e for e in v], np.float64) + 0.0
                if np.isfinite(x).all() and x.any():
                    raw = x
            if raw is None:
                rows.append((k, None, None, None))
            else:
                grp = f"{len(raw)}:{label}"
                data = raw.tobytes()
                rows.append((k, grp, hashlib.blake2b(grp.encode() + b"|" + data, digest_size=16).digest(), data))
        df = pd.DataFrame(rows, columns=["key", "grp", "digest", "raw"])
        yield df.astype({"key": "Int64"})


def _matrix(raws) -> np.ndarray:
    """Unit vectors."""
    x = np.frombuffer(b"".join(raws), np.float64).reshape(len(raws), -1)
    scaled = x / np.abs(x).max(1, keepdims=True)        # no overflow in the norm
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _keys(passes: int, bits: int):
    """Every vector once per pass, with its sort key."""
    def run(batches):
        for b in batches:
            for _, g in b.groupby("grp", sort=False):
                x = _matrix(g["raw"])
                for p in range(passes):
                    signs = np.packbits(x @ planes(x.shape[1], p, bits) > 0, axis=1)
                    yield pd.DataFrame({"band": p, "grp": g["grp"].to_numpy(), "sort": [s.tobytes() for s in signs],
                                        "rep": g["rep"].to_numpy(), "raw": g["raw"].to_numpy()})
    return run


class _Forest(dict):
    def root(self, i):
        while (p := self.setdefault(i, i)) != i:
            self[i] = self.setdefault(p, p)
            i = p
        return i

    def join(self, i, j) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self[max(i, j)] = min(i, j)
        return True


def _compare(rows: pd.DataFrame, window: int, least: float, split: int | None = None) -> list[tuple[int, int]]:
    """Spanning links among rows of one order that lie up to ``window`` apart (and, with ``split``, across it)."""
    links, forest = [], _Forest()
    for _, g in rows.groupby(["band", "grp"], sort=False):
        x, ids, place = _matrix(g["raw"]), g["rep"].to_numpy(), g["place"].to_numpy()
        for lag in range(1, min(window, len(g) - 1) + 1):
            near = np.einsum("ij,ij->i", x[:-lag], x[lag:]) >= least
            near &= place[lag:] - place[:-lag] <= window
            if split is not None:
                near &= (place[:-lag] < split) & (place[lag:] >= split)
            for i in np.flatnonzero(near):
                if forest.join(int(ids[i]), int(ids[i + lag])):
                    links.append((int(ids[i]), int(ids[i + lag])))
    return links


def _windows(window: int, least: float):
    """Links within a sorted partition, and its first and last rows for the comparison across partitions."""
    columns = ["a", "b", "part", "side", "at", "band", "grp", "raw"]

    def edge(rows, part, side):
        return pd.DataFrame({"a": rows["rep"].to_numpy(), "b": None, "part": part, "side": side,
                             "at": np.arange(len(rows)), "band": rows["band"].to_numpy(), "grp": rows["grp"].to_numpy(),
                             "raw": rows["raw"].to_numpy()})[columns].astype({"b": "Int64"})

    def run(batches):
        part, tail, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            for at in range(0, len(b), 4096):
                rows = b.iloc[at:at + 4096]
                if seen < window:
                    yield edge(rows.iloc[:window - seen], part, 0).assign(at=lambda d, s=seen: d["at"] + s)
                seen += len(rows)
                rows = rows if tail is None else pd.concat([tail, rows], ignore_index=True)
                found = _compare(rows.assign(place=np.arange(len(rows))), window, least)
                if found:
                    a, c = zip(*found)
                    yield pd.DataFrame({"a": a, "b": c, "part": None, "side": None, "at": None, "band": None,
                                        "grp": None, "raw": None})[columns] \
                        .astype({"part": "Int32", "side": "Int32", "at": "Int32", "band": "Int32"})
                tail = rows.iloc[-window:]
        if tail is not None:
            yield edge(tail, part, 1)
    return run


def _across(window: int, least: float):
    def run(pdf):
        last = pdf[pdf["side"] == 1].sort_values("at")
        first = pdf[pdf["side"] == 0].sort_values("at")
        rows = pd.concat([last, first], ignore_index=True).rename(columns={"a": "rep"})
        rows["place"] = np.arange(len(rows))
        return pd.DataFrame(_compare(rows, window, least, split=len(last)), columns=["a", "b"], dtype="int64")
    return run


def sorted_passes(classes: DataFrame, passes: int = PASSES, bits: int = BITS, window: int = WINDOW,
                  least: float = MIN_COSINE) -> DataFrame:
    """Links ``(a, b)`` that span what the passes found among ``classes (rep, grp, raw)``."""
    spark = classes.sparkSession
    rows = classes.count() * passes
    parts = max(1, min(rows // (8 * window) + 1, max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 50_000)))
    keyed = classes.mapInPandas(_keys(passes, bits), "band int, grp string, sort binary, rep long, raw binary")
    found = materialise(keyed.repartitionByRange(parts, "band", "grp", "sort", "rep")
                        .sortWithinPartitions("band", "grp", "sort", "rep")
                        .mapInPandas(_windows(window, least), _FOUND), "windows")
    border = F.when(F.col("side") == 0, F.col("part") - 1).otherwise(F.col("part"))
    across = found.where("part is not null").withColumn("border", border).groupBy("border") \
        .applyInPandas(_across(window, least), "a long, b long")
    return found.where("part is null").select("a", "b").union(across).distinct()


def _against(shared, piece: int, least: float):
    """Compare rows with the held vectors of their group: counts for both sides, and links that join two labels.

    Rows of the held piece itself are counted for their own side only: each of them is a row as well as held.
    """
    def run(batches):
        held = {c: (_matrix(raws), *rest) for c, (raws, *rest) in shared.value.items()}
        other = {c: np.zeros(len(n), np.int64) for c, (_, _, n, _) in held.items()}
        forest, links = _Forest(), []
        for b in batches:
            out = []
            for (c, same), g in b.assign(same=b["piece"] == piece).groupby(["component", "same"], sort=False):
                if c not in held:
                    continue
                right, _, n_right, l_right = held[c]
                for i in range(0, len(g), CELL):
                    part = g.iloc[i:i + CELL]
                    left, n_left, l_left = _matrix(part["raw"]), part["n"].to_numpy(), part["label"].to_numpy()
                    n = np.zeros(len(part), np.int64)
                    for j in range(0, len(right), 8 * CELL):
                        p, q = np.nonzero(left @ right[j:j + 8 * CELL].T >= least)
                        q += j
                        np.add.at(n, p, n_right[q])
                        if not same:
                            np.add.at(other[c], q, n_left[p])
                        apart = l_left[p] != l_right[q]
                        if apart.any():
                            for x, y in np.unique(np.column_stack((l_left[p[apart]], l_right[q[apart]])), axis=0):
                                if forest.join(int(x), int(y)):
                                    links.append((int(x), int(y)))
                    out.append(pd.DataFrame({"a": part["rep"].to_numpy(), "b": None, "n": n})[n > 0])
            if out:
                yield pd.concat(out).astype({"b": "Int64"})
        for c, n in other.items():
            if n.any():
                yield pd.DataFrame({"a": held[c][1], "b": None, "n": n})[n > 0].astype({"b": "Int64"})
        if links:
            yield pd.DataFrame(links, columns=["a", "b"]).assign(n=None).astype({"n": "Int64"})
    return run


def all_pairs(members: DataFrame, least: float = MIN_COSINE, cell: int | None = None) -> DataFrame:
    """Every pair of vectors of a component of ``members (component, rep, n, label, raw)``, compared by cosine.

    Returns ``(a, b, n)``: rows without ``b`` say that ``a`` links with ``n``
    vectors, copies included (``a`` itself in one of its rows); rows without
    ``n`` are links between labels that span all links between different labels.

    Rows are shuffled once: components are cut into pieces of ``cell`` vectors
    (those that fill ``HELD_BYTES`` if None), small ones share a piece, and a
    round broadcasts one piece to tasks that scan the rest of its component.
    """
    spark = members.sparkSession
    room = F.lit(cell) if cell else F.greatest(F.lit(1), F.floor(F.lit(HELD_BYTES) / F.max(F.length("raw"))))
    sizes = materialise(members.groupBy("component").agg((F.count("*") / room).alias("share"),
                                                         F.sum(F.length("raw")).alias("bytes")), "groups")
    total = sizes.agg(F.sum("bytes").alias("bytes"), F.sum(F.when(F.col("share") <= 1, F.col("share"))).alias("small")).first()
    path = shared_path(spark, "pairs")
    if total["bytes"] is None:
        return spark.createDataFrame([], _PAIRS)
    shelves = max(1, math.ceil(total["small"] or 0))
    lot = F.when(F.col("share") <= 1, F.concat(F.lit("-"), F.pmod(F.xxhash64("component"), F.lit(shelves)).cast("string"))) \
        .otherwise(F.concat(F.lit("+"), "component"))
    piece = F.pmod(F.xxhash64("rep"), F.ceil("share")).cast("int")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total["bytes"] // (1 << 24))
    dealt = materialise(members.join(broadcast_if_short(sizes, BROADCAST_ROWS), "component")
                        .select("component", "rep", "n", "label", "raw", lot.alias("lot"), piece.alias("piece"))
                        .repartitionByRange(parts, "lot", "piece", "rep"), "lots")
    rounds = dealt.select("lot", "piece").distinct().collect()
    for k, (lot, piece) in enumerate(rounds):
        mine = dealt.where(F.col("lot") == lot)
        held = mine.where(F.col("piece") == piece).select("component", "rep", "n", "label", "raw").toPandas()
        shared = spark.sparkContext.broadcast({c: (list(g["raw"]), g["rep"].to_numpy(), g["n"].to_numpy(), g["label"].to_numpy())
                                               for c, g in held.groupby("component", sort=False)})
        mine.where(F.col("piece") >= piece).mapInPandas(_against(shared, piece, least), _PAIRS).write.parquet(f"{path}/round={k}")
        shared.destroy()
    return spark.read.schema(_PAIRS).parquet(*(f"{path}/round={k}" for k in range(len(rounds))))


def link_counts(members: DataFrame, least: float = MIN_COSINE, cell: int | None = None) -> DataFrame:
    """``(rep, n)``: vectors, copies included, that each member of a component links with, itself included.

    ``members`` has ``component, rep, n, raw`` (``n`` copies).
    """
    return all_pairs(members.withColumn("label", F.lit(0).cast("long")), least, cell).where("n is not null") \
        .groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 least: float = MIN_COSINE, passes: int = PASSES, window: int = WINDOW,
                 cell: int | None = None) -> DataFrame:
    """One row per vector: ``key, n_links, component_id, kept``."""
    clean = materialise(vectors.select(F.col(key).cast("long").alias("key"), F.col(label).cast("string").alias("label"),
                                       F.col(vector).alias("vector"))
                        .mapInPandas(_clean, "key long, grp string, digest binary, raw binary"), "vectors")
    named, ids = own_ids(clean.withColumn("content", F.coalesce(F.xxhash64("digest"), F.lit(0))), "key", "content")
    if ids is not None:         # ids that stand for several vectors
        clean = materialise(named.drop("content"), "vectors")
    classes = materialise(clean.where("grp is not null").groupBy("digest")
                          .agg(F.min("key").alias("rep"), F.count("*").alias("n"), F.first("grp").alias("grp"),
                               F.first("raw").alias("raw")), "classes")
    links = sorted_passes(classes.select("rep", "grp", "raw"), passes, BITS, window, least)
    label_of = materialise(components(links).withColumnRenamed("id", "rep"), "labels")
    # what no pass brought together: all pairs of a label, whatever the passes found
    members = classes.join(label_of, "rep", "left").select(F.col("grp").alias("component"), "rep", "n",
                                                           F.coalesce("component", "rep").alias("label"), "raw")
    pairs = all_pairs(members, least, cell)
    missed = pairs.where("n is null").select("a", "b")
    if not missed.isEmpty():
        known = label_of.select(F.col("rep").alias("a"), F.col("component").alias("b"))
        label_of = materialise(components(known.union(missed)).withColumnRenamed("id", "rep"), "labels")
    counts = materialise(pairs.where("n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n")), "counts")
    of_class = classes.select("digest", "rep", "n").join(counts.withColumnRenamed("n", "linked"), "rep", "left") \
        .join(label_of, "rep", "left") \
        .select("digest", (F.coalesce("linked", "n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = clean.select("key", "digest").join(of_class, "digest", "left").select(
        "key", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "key").alias("component_id"))
    if ids is not None:
        for c in ("key", "component_id"):
            out = out.join(ids.select(F.col("own").alias(c), F.col("key").alias("theirs")), c, "left") \
                .withColumn(c, F.col("theirs")).drop("theirs")
    return out.select(F.col("key").alias(key), "n_links", "component_id",
                      F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
