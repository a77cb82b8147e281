"""Helpers shared by the operators: scratch tables, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: A word: a run of characters other than space and TAB..CR.
WORD = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder of ``spark.checkpoint.dir``, scheme kept."""
    return os.path.join(ensure_checkpoint_dir(spark), "ledgerlight-llm", f"{tag}-{uuid.uuid4().hex[:12]}")


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: a lineage cut that any executor can read."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def count_words(text) -> F.Column:
    """Number of words of a text column; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_crc32(col) -> F.Column:
    """crc32 of an id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    ``edges`` has two id columns of one orderable type. Returns ``(id,
    component)`` for every id of an edge, where ``component`` is the smallest
    id reachable. Each round is two aggregates and two joins over the edge
    table, so a hub is pre-aggregated before its rows move and the join that
    follows can be split by AQE; each round's edges are written to the shared
    folder. Rounds end when every id has one edge, to the smallest. Loops and repeated edges are fine; no edges give no rows.
    """
    def settled(e: DataFrame) -> DataFrame:
        return e.where(F.col("u") != F.col("v")).distinct()

    def star(e: DataFrame, large: bool) -> DataFrame:
        # e: u > v in every row. Large star looks at all neighbours, small star at the smaller ones.
        near = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        low = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        if large:   # connect every larger neighbour of u to the smallest around u
            moved = near.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:       # connect u and its smaller neighbours to the smallest of them
            moved = near.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
                .union(low.select("u", F.col("m").alias("v")))
        return settled(moved)

    def is_forest_of_stars(e: DataFrame) -> bool:
        ends = e.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
            .union(e.select("v", F.lit(0), F.lit(1)))
        return ends.groupBy("id").agg(F.sum("up").alias("up"), F.sum("down").alias("down")) \
            .where("up > 1 or (up > 0 and down > 0)").isEmpty()

    big, small = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    now = materialise(settled(edges.select(big.alias("u"), small.alias("v"))), "edges")
    while not is_forest_of_stars(now):
        now = materialise(star(star(now, large=True), large=False), "edges")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")) \
        .union(now.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()


#: bytes of a batch that goes to a Python worker at most (more only for a single longer text)
ARROW_BYTES = 4 << 20


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that do not have it installed, once per context.

    Also bounds the batches they get by bytes, so that a worker's memory does not grow with the length of the texts.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_ledgerlight_shipped", False):
        return
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="ledgerlight-"))
    target = os.path.join(folder, "ledgerlight.zip")
    with zipfile.ZipFile(target, "w") as z:
        for top, _, names in os.walk(os.path.join(home, "ledgerlight")):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(top, n), os.path.relpath(os.path.join(top, n), home))
    sc.addPyFile(target)    # served to the executors by the driver
    sc._ledgerlight_shipped = True


def broadcast_if_short(df: DataFrame, rows: int) -> DataFrame:
    """Mark a written table for broadcast if its counted rows are few; otherwise leave the join to a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def broadcast_if_small(df: DataFrame, size: F.Column, limit: int = 32 << 20) -> DataFrame:
    """As :func:`broadcast_if_short` for rows of no fixed width: by the summed ``size`` of the rows in bytes."""
    total = df.agg(F.sum(size.cast("long") + 32)).first()[0] or 0
    return F.broadcast(df) if total <= limit else df


def link_buckets(members: DataFrame, verify: Callable[[DataFrame], DataFrame],
                 apart: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Components of the links among ids that share a bucket: ``(id, component)`` for every linked id.

    ``members`` is a written table ``(band, rep, leader)`` of the buckets with
    more than one id, ``leader`` being the bucket's smallest. ``verify`` takes
    pairs ``(a, b)`` and returns those that are links. A bucket is not expanded
    to all pairs: each id is held against the leader it shares most buckets
    with, then against the leaders it is still apart from. A pair within one
    component needs no look. What is left are buckets whose members are still
    in different components; ``apart`` takes these, ``(band, rep, label)``, and
    returns the links among members with different labels, so no link between
    different components is lost.
    """
    stars = materialise(members.where("rep != leader").groupBy(F.col("leader").alias("a"), F.col("rep").alias("b"))
                        .agg(F.count("*").alias("votes")), "stars")
    first = stars.groupBy("b").agg(F.max(F.struct(F.col("votes"), (-F.col("a")).alias("less"))).alias("m")) \
        .select((-F.col("m.less")).alias("a"), "b")
    tested = materialise(first, "pairs")
    links = materialise(verify(tested), "links")
    label = materialise(components(links), "labels")

    def labelled(df: DataFrame, col: str, out: str) -> DataFrame:
        of = label.select(F.col("id").alias(col), F.col("component").alias(out))
        return df.join(of, col, "left").withColumn(out, F.coalesce(out, col))

    rest = labelled(labelled(stars.select("a", "b"), "a", "la"), "b", "lb").where("la != lb").select("a", "b") \
        .join(tested, ["a", "b"], "left_anti")
    rest = materialise(rest, "pairs")
    if not rest.isEmpty():
        links = materialise(links.union(verify(rest)), "links")
        label = materialise(components(links), "labels")

    m = labelled(members.select("band", "rep"), "rep", "label")
    mixed = m.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("band")
    open_ = materialise(m.join(mixed, "band", "left_semi"), "mixed")
    if not open_.isEmpty():
        links = materialise(links.union(apart(open_)), "links")
        label = materialise(components(links), "labels")
    return label


def shared_buckets(banded: DataFrame, short: int) -> DataFrame:
    """``(band, rep, leader)`` of the buckets of ``banded (rep, band)`` that hold more than one id, written once.

    Buckets are counted with partial aggregation first; the second pass joins
    those found, by broadcast if they are few.
    """
    found = materialise(banded.groupBy("band").agg(F.min("rep").alias("leader"), F.count("*").alias("n"))
                        .where("n > 1").select("band", "leader"), "shared")
    return materialise(banded.join(broadcast_if_short(found, short), "band").select("band", "rep", "leader"), "buckets")


def quoted(name: str) -> F.Column:
    """A column by its literal name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_rest(docs: DataFrame, used: list[str], work: Callable[[DataFrame], DataFrame], extra: list[str] | None = None) -> DataFrame:
    """``work`` on the ``used`` columns of ``docs`` alone, with the other columns put back under their names.

    They travel in one struct, ``rest``, whose fields are numbered, so no name
    of theirs can clash with a name that ``work`` uses. ``extra`` are columns
    that ``work`` adds.
    """
    others = [c for c in docs.columns if c not in used]
    rest = [F.struct(*(quoted(c).alias(f"c{i}") for i, c in enumerate(others))).alias("rest")] if others else []
    out = work(docs.select(*map(quoted, used), *rest))
    place = {c: F.col("rest")[f"c{i}"].alias(c) for i, c in enumerate(others)}
    return out.select(*(place.get(c, quoted(c)) for c in docs.columns), *(extra or []))


def own_ids(rows: DataFrame, key: str, content: str) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` with an id of their own for every different ``content`` of a key, where keys are shared at all.

    Returns the rows and a written table ``(own, key)``, or the rows as they
    are and None if no key has two contents (``content`` is a hash column). The
    new ids are longs in the order of the old ones, so a smallest id stays
    one; null keys stay null.
    """
    shared = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(content).alias("a"), F.max(content).alias("b")).where("a != b")
    if shared.isEmpty():
        return rows, None
    pairs = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("of_key"), F.col(content).alias("of_content")).distinct()
    # ids that rise along a global sort rise with the key
    ids = materialise(pairs.orderBy("of_key", "of_content").withColumn("own", F.monotonically_increasing_id()), "ids")
    named = rows.join(ids, (F.col(key) == F.col("of_key")) & (F.col(content) == F.col("of_content")), "left")
    return named.select(*(F.col("own").alias(key) if c == key else F.col(c) for c in rows.columns)), \
        ids.select("own", F.col("of_key").alias("key"))
