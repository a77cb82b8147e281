"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Documents of a source queue in a shuffled order. A document's virtual finish
time is the cumulative size of its source up to and including it, divided by
the source's target; a second and later copy queues behind the whole source.
All entries of all sources are then taken in order of finish time until the
next one would exceed the total budget. At finish time 1 every source has
used up its own target, so each gets its share whatever the document sizes.

Scale: a running total over a hot source or over all entries is never one
window. Rows fall into fixed slices of the shuffle order (or of the finish
time), slices of about ``SLICE_ROWS`` rows each; slice sums are added up over
the slice table and only slices are windowed row by row. Texts are not
shuffled, only ``(id, source, size)``. The order is a hash of the id, so
reruns agree.

Defined results: a null text has size 0; a null source is a source of its own
and sorts last; a null id is hashed as the empty text; rows that share id,
source and text queue as one entry and are taken alike; an empty table gives an empty table; a
source of empty texts has target 0 and takes 0 words.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_short, count_words, materialise, with_rest

WEIGHTS = (3, 1, 2)     # by rank of the source, repeating
SHARE = 1.5             # budget as a multiple of all sizes
REPEATS = 2             # a source may be taken this many times over
SLICE_ROWS = 4096
SEED = "mix-1"
SHORT = 500_000         # a plan of up to this many rows (about 20 MB) is broadcast to the documents


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, repeats=REPEATS) -> DataFrame:
    """Per source: rank, documents, size, weight and target.

    ``sizes`` has ``source, source_size, n_docs``. A target is the weighted
    share of the budget, but at most ``repeats`` times the source; what that
    cuts off is shared among the others by weight until none is above. The
    water level of that filling is the largest of the levels that come out
    when the sources are taken as full one after the other, in order of size
    per weight.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    w = ranked.withColumn("weight", weight.cast("long")).withColumn("cap", repeats * F.col("source_size"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("full_cap", F.coalesce(F.sum("cap").over(before), F.lit(0))) \
         .withColumn("full_weight", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    left = share * F.sum("source_size").over(everything) - F.col("full_cap")
    w = w.withColumn("level", F.max(left / (F.sum("weight").over(everything) - F.col("full_weight"))).over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return w.select("source", "rank", "n_docs", "source_size", "weight", target.alias("target"))


def plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
         share=SHARE, repeats=REPEATS, seed: str = SEED) -> DataFrame:
    """One row per distinct ``(key, source, text)``: what the mix takes of it.

    ``key, source, text_hash, n_same`` (rows alike), ``size, source_size,
    target, finish`` (the first copy's finish time) and ``copies`` (0 to
    ``repeats``).
    """
    digest = F.md5(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(f":{seed}")))
    place = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")     # 52 bits: exact as a double
    sized = materialise(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), F.xxhash64(text).alias("text_hash"),
                                    count_words(F.col(text)).alias("words"))
                        .groupBy("key", "source", "text_hash", "words").agg(F.count("*").alias("n_same"))
                        .withColumn("size", F.col("words") * F.col("n_same")).withColumn("place", place), "mix")
    targets = materialise(source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")),
        weights, share, repeats), "targets")
    total, rows = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("n_docs"), F.lit(0))).first()
    budget = share * total

    # cumulative size within the source: slice sums first, then rows within a slice
    t = targets.withColumnRenamed("source", "of_source")
    slices = F.ceil(F.col("n_docs") / SLICE_ROWS)
    rowed = sized.join(t, F.col("source").eqNullSafe(F.col("of_source"))) \
        .withColumn("slice", F.floor(F.col("place") / float(1 << 52) * slices))
    earlier = Window.partitionBy("rank").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = rowed.groupBy("rank", "slice").agg(F.sum("size").alias("sum")) \
        .select("rank", "slice", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("rank", "slice").orderBy("place", "key", "size", "text_hash") \
        .rowsBetween(Window.unboundedPreceding, 0)
    queued = materialise(
        rowed.withColumn("inside", F.sum("size").over(inside)).join(starts, ["rank", "slice"])
        .select("key", "source", "text_hash", "n_same", "words", "size", "source_size", "target", "rank",
                (F.col("start") + F.col("inside")).alias("cum")), "queue")

    # finish times, and where the budget cuts them
    finishes = [F.when(F.col("target") > 0, (e * F.col("source_size") + F.col("cum")) / F.col("target")).otherwise(0.0)
                for e in range(repeats)]
    steps = max(1, -(-rows * repeats // SLICE_ROWS))
    entries = queued.select("size", "rank", "cum", F.explode(F.array(*finishes)).alias("finish")) \
        .withColumn("step", F.floor(F.col("finish") * steps))
    running = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    over = entries.groupBy("step").agg(F.sum("size").alias("sum")).withColumn("run", F.sum("sum").over(running)) \
        .where(F.col("run") > budget).orderBy("step").select("step", (F.col("run") - F.col("sum")).alias("before")).first()
    order = F.struct("finish", "rank", "cum")
    if over is None:
        inside_cut = lambda f: F.lit(True)      # noqa: E731  the budget covers every entry
    else:
        sorted_ = Window.orderBy("finish", "rank", "cum").rowsBetween(Window.unboundedPreceding, 0)
        last = entries.where(F.col("step") == over["step"]).withColumn("run", F.sum("size").over(sorted_)) \
            .where(F.col("run") + over["before"] <= budget).agg(F.max(order).alias("last")).first()["last"]
        if last is None:        # not even the step's first entry fits
            inside_cut = lambda f: F.floor(f * steps) < over["step"]
        else:
            edge = F.struct(F.lit(last["finish"]).alias("finish"), F.lit(last["rank"]).cast("int").alias("rank"),
                            F.lit(last["cum"]).cast("long").alias("cum"))
            inside_cut = lambda f: F.struct(f.alias("finish"), F.col("rank"), F.col("cum")) <= edge
    copies = reduce(add, [inside_cut(f).cast("int") for f in finishes])
    return queued.select("key", "source", "text_hash", "n_same", F.col("words").alias("size"), "source_size", "target",
                         finishes[0].alias("finish"), copies.alias("copies"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """One row per document: ``key, source, size, source_size, target, finish, copies, taken`` (words taken)."""
    planned = plan(docs, key, text, source, **how)
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_same")))
    return planned.select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", "finish",
                          "copies", (F.col("copies") * F.col("size")).alias("taken"), each.alias("__row")).drop("__row")


def take(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all columns; rows without words go.

    The plan is written once and joined back on id, source and text hash, by
    broadcast if it is short.
    """
    planned = plan(docs.select(key, text, source), key, text, source, **how).where("copies > 0 and size > 0") \
        .select(F.col("key").alias("__key"), F.col("source").alias("__source"), F.col("text_hash").alias("__hash"),
                F.col("copies").alias("__copies"))
    wanted = materialise(planned, "taken")

    def repeated(rows: DataFrame) -> DataFrame:
        joined = rows.join(broadcast_if_short(wanted, SHORT), F.col(key).eqNullSafe(F.col("__key"))
                           & F.col(source).eqNullSafe(F.col("__source")) & (F.xxhash64(text) == F.col("__hash")))
        return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))

    return with_rest(docs, [key, text, source], repeated)
