"""Fuzzy line dedup by MinHash over character shingles, in DataFrame operations only.

Lines are compared trimmed and in lower case. Equal lines are one class,
found by a 128-bit hash with partial aggregation, so a line that a third of
all documents hold is one row per task before it moves. A class's shingles are
all runs of ``CHARS`` characters; each is hashed once, and coordinate ``j`` of
the signature is the smallest ``hash xor seed_j``. Lines go by their hash
only, so the signature's aggregate needs no shuffle of its own. Classes that
share a band of ``ROWS`` coordinates are candidates and are verified by the
exact Jaccard similarity of their shingle sets, after an odd sketch of each set has
ruled out most of those that cannot reach it (see :func:`may_be_near`: no link
is lost by it); links become components by
:func:`ledgerlight.llm.common.link_buckets`. Of each component one line stays:
the first in the document with the smallest id that has one.

At a similarity of 0.8 two lines share no band with probability 0.3 %, at 0.9
with 3e-5.

Defined results: lines without a word stay as they are; a line shorter than a
shingle is one shingle; a null or empty text stays as it is; of a component
with an occurrence under a null id only, that one stays; rows that share id
and text keep the same lines; rows that share an id alone are apart, in the
order of a hash of their text; a text may lose all its lines and is then
empty; an empty table gives an empty table. Columns of the input other than
id and text pass through untouched, whatever their names.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_short, broadcast_if_small, components, link_buckets, materialise, own_ids, shared_buckets, with_rest

CHARS = 8
BANDS, ROWS = 8, 3
PERCENT = 80
STRIDE = 8
MARKS = 16              # longs of a set's odd sketch
SHORT = 1_000_000       # tables of up to this many narrow rows (about 40 MB) are broadcast, longer ones joined by shuffle
_BLANKS = " \t\n\x0b\x0c\r"


def _seeds() -> list[int]:
    """One seed per coordinate; their top bits are spread evenly, so each looks for another part of the hash range."""
    rng, n = random.Random(20), BANDS * ROWS
    spread = rng.sample(range(n), n)
    return [((s << 64) // n + rng.getrandbits(58)) % (1 << 64) - (1 << 63) for s in spread]


def line_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per line with a word: ``doc, text_hash, pos, line, h1, h2``."""
    d = docs.select(F.col(key).alias("doc"), F.col(text).alias("text")) \
        .select("doc", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    # trimming the end walks the whole line, so the filter trims the start alone and only lines that end in a blank are trimmed there
    left = F.ltrim("raw", F.lit(_BLANKS))
    ends = reduce(lambda x, y: x | y, (F.endswith("raw", F.lit(c)) for c in _BLANKS))
    return d.where(left != "").withColumn("line", F.lower(F.when(ends, F.rtrim(left, F.lit(_BLANKS))).otherwise(left))) \
        .select("doc", "text_hash", "pos", "line", F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(1)).alias("h2"))


def _wide(line) -> F.Column:
    """The line with four bytes a character: a shingle is then a plain slice of it, wherever it begins."""
    return F.encode(line, "UTF-32")


def _last_byte(wide, chars: int) -> F.Column:
    """Where the last shingle begins, in bytes from 0."""
    return F.greatest(F.octet_length(wide) - 4 * chars, F.lit(0))


def _shingle(wide, at, chars: int) -> F.Column:
    return F.xxhash64(F.substring(wide, at + 1, F.lit(4 * chars)))


def _hashed(lines: DataFrame, chars: int) -> DataFrame:
    """Shingle hashes ``s0``, ``s1``, ... of the column ``wide``, ``STRIDE`` of them a row; ``at`` is 0 in the first row of a line.

    So the buffers of an aggregate over them are touched that much less often; the last one of a line may repeat.
    """
    last = _last_byte(F.col("wide"), chars)
    keep = [c for c in lines.columns if c != "wide"]
    return lines.select(*keep, "wide", last.alias("last")) \
        .select(*keep, "wide", "last", F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(4 * STRIDE))).alias("at")) \
        .select(*keep, "at", *(_shingle(F.col("wide"), F.least(F.col("at") + 4 * k, F.col("last")), chars).alias(f"s{k}") for k in range(STRIDE)))


def classes_of(lines: DataFrame, chars: int = CHARS) -> DataFrame:
    """One row per distinct line: ``rep, h1, h2, doc, n, bands``, written once.

    Every line is signed where it is read and equal lines are then one row per
    task, so no text is sorted or moves.
    """
    hashed = _hashed(lines.select("h1", "h2", "doc", _wide(F.col("line")).alias("wide")), chars)
    signed = hashed.groupBy("h1", "h2").agg(
        F.min("doc").alias("doc"), F.count_if(F.col("at") == 0).alias("n"),
        *(F.min(F.least(*(F.col(f"s{k}").bitwiseXOR(F.lit(s)) for k in range(STRIDE)))).alias(f"m{j}")
          for j, s in enumerate(_seeds())))
    bands = F.array(*(F.xxhash64(F.lit(b), *(f"m{b * ROWS + j}" for j in range(ROWS))) for b in range(BANDS)))
    return materialise(signed.select(F.monotonically_increasing_id().alias("rep"), "h1", "h2", "doc", "n", bands.alias("bands")), "lines")


def shingles(line: F.Column, chars: int) -> F.Column:
    """The distinct shingle hashes of a line."""
    def of(wide):
        return F.transform(F.sequence(F.lit(0), _last_byte(wide, chars), F.lit(4)), lambda at: _shingle(wide, at, chars))

    # the lambda's argument keeps the line from being encoded once a shingle
    return F.array_distinct(F.get(F.transform(F.array(_wide(line)), of), F.lit(0)))


def marks_of(found: DataFrame, chars: int) -> DataFrame:
    """``(rep, size, marks)`` of lines: how many distinct shingles, and an odd sketch of them, written once.

    In an odd sketch every distinct shingle flips one bit, so unlike a bitmap it does not fill up with long lines.
    """
    sets = found.select("rep", shingles(F.col("line"), chars).alias("set")).select("rep", F.size("set").alias("size"), "set")
    dealt = sets.select("rep", "size", "set", F.explode(F.sequence(F.lit(0), F.col("size") - 1, F.lit(STRIDE))).alias("at")) \
        .select("rep", "size", *(F.get("set", F.col("at") + k).alias(f"s{k}") for k in range(STRIDE)))

    def word(w: int) -> F.Column:   # past the end of the set s is null and flips nothing
        bits = [F.expr(f"if((s{k} >> 6) & {MARKS - 1} = {w}, shiftleft(1L, cast(s{k} & 63 as int)), 0L)") for k in range(STRIDE)]
        return F.bit_xor(reduce(lambda x, y: x.bitwiseXOR(y), bits)).alias(f"w{w}")

    words = dealt.groupBy("rep").agg(F.max("size").alias("size"), *map(word, range(MARKS)))
    return materialise(words.select("rep", "size", F.array(*(f"w{w}" for w in range(MARKS))).alias("marks")), "marks")


def _differ(words_a: list[F.Column], words_b: list[F.Column]) -> F.Column:
    return reduce(lambda x, y: x + y, (F.bit_count(x.bitwiseXOR(y)) for x, y in zip(words_a, words_b, strict=True)))


def _words(marks: str) -> list[F.Column]:
    return [F.get(marks, F.lit(w)) for w in range(MARKS)]


def may_be_near(words_a: list[F.Column], size_a, words_b: list[F.Column], size_b, percent: int) -> F.Column:
    """False only for sets whose similarity is below ``percent``.

    Sets of that similarity have sizes in that ratio at least. A bit that
    differs between two odd sketches stands for at least one shingle of one
    set alone, and sets of similarity t differ in at most (1 - t) / (1 + t) of
    the sum of their sizes.
    """
    return (size_a * 100 >= size_b * percent) & (size_b * 100 >= size_a * percent) \
        & (_differ(words_a, words_b) * (100 + percent) <= (size_a + size_b) * (100 - percent))


def near_pairs(mixed: DataFrame, marks: DataFrame, percent: int, leaders: bool) -> DataFrame:
    """``(a, b, x, y, gap)``: pairs of members ``(band, rep, label)`` of one bucket with different labels that may be near, written once.

    ``x`` and ``y`` are the labels, ``x`` the smaller; ``gap`` is the share of
    shingles by which the sketches differ. With ``leaders`` one of the two is
    among some sqrt(n) members of a bucket of n, picked by a hash; without,
    all pairs are looked at, each in the first bucket that it shares.
    """
    bands = mixed.groupBy("rep").agg(F.collect_set("band").alias("bands"))
    every = mixed.groupBy("band").agg(F.ceil(F.sqrt(F.count("*"))).alias("every"))
    m = mixed.join(marks, "rep").select("band", "rep", "label", "size", *(x.alias(f"w{w}") for w, x in enumerate(_words("marks"))))
    m = m.join(every, "band").withColumn("lead", F.expr("pmod(xxhash64(rep), every) = 0")).drop("every") if leaders else m.join(bands, "rep")
    m = materialise(m, "marked")
    # sketches are compared as plain columns: with arrays the compiled condition is too long for the JVM to optimise
    other = m.where("lead") if leaders else m
    other = other.select(*(F.col(c).alias(f"{c}_b") for c in m.columns))
    near = (F.col("band") == F.col("band_b")) & (F.col("label") != F.col("label_b")) \
        & ((~F.col("lead") | (F.col("rep") < F.col("rep_b"))) if leaders else (F.col("rep") < F.col("rep_b"))) \
        & may_be_near([F.col(f"w{w}") for w in range(MARKS)], F.col("size"), [F.col(f"w{w}_b") for w in range(MARKS)], F.col("size_b"), percent)
    if not leaders:
        near = near & (F.array_min(F.array_intersect("bands", "bands_b")) == F.col("band"))
    gap = _differ([F.col(f"w{w}") for w in range(MARKS)], [F.col(f"w{w}_b") for w in range(MARKS)]) / (F.col("size") + F.col("size_b"))
    return materialise(m.join(other, near).select(
        F.least("rep", "rep_b").alias("a"), F.greatest("rep", "rep_b").alias("b"),
        F.least("label", "label_b").alias("x"), F.greatest("label", "label_b").alias("y"), gap.alias("gap")), "pairs")


def closest_links(found: DataFrame, near: DataFrame, chars: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of the pairs between the same two labels the closest is compared: its pairs ``(a, b)``, the links, and ``(id, component)`` of labels."""
    closest = near.groupBy("x", "y").agg(F.min(F.struct("gap", "a", "b")).alias("m"))
    tested = materialise(closest.select("m.a", "m.b", "x", "y"), "closest")
    links = materialise(verified(found, tested.select("a", "b"), chars, percent), "links")
    joined = materialise(components(tested.join(links, ["a", "b"], "left_semi"), "x", "y"), "joined")
    return tested.select("a", "b"), links, joined


def relabelled(rows: DataFrame, col: str, joined: DataFrame) -> DataFrame:
    """``rows`` with the labels of ``col`` replaced by the components they are in."""
    return rows.join(joined.withColumnRenamed("id", col), col, "left").withColumn(col, F.coalesce("component", col)).drop("component")


def links_apart(found: DataFrame, mixed: DataFrame, marks: DataFrame, chars: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` among members of one bucket with different labels, enough to join all components that any link joins.

    A few leaders of each bucket first, which joins most of what can be
    joined; then all pairs of what is still apart, the closest of each two
    components before the others.
    """
    _, first, joined = closest_links(found, near_pairs(mixed, marks, percent, leaders=True), chars, percent)
    m = relabelled(mixed, "label", joined)
    still = m.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("band")
    near = near_pairs(materialise(m.join(still, "band", "left_semi"), "mixed"), marks, percent, leaders=False)
    tested, second, joined = closest_links(found, near, chars, percent)
    rest = near.select("a", "b", "x", "y").join(tested, ["a", "b"], "left_anti")
    rest = materialise(relabelled(relabelled(rest, "x", joined), "y", joined).where("x != y").select("a", "b"), "rest")
    links = first.union(second)
    return links if rest.isEmpty() else links.union(verified(found, rest, chars, percent))


def likely(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that may be near, written once."""
    a = marks.select(F.col("rep").alias("a"), F.col("size").alias("size_a"), F.col("marks").alias("marks_a"))
    b = marks.select(F.col("rep").alias("b"), F.col("size").alias("size_b"), F.col("marks").alias("marks_b"))
    near = may_be_near(_words("marks_a"), F.col("size_a"), _words("marks_b"), F.col("size_b"), percent)
    return materialise(pairs.join(a, "a").join(b, "b").where(near).select("a", "b"), "likely")


def lines_of(lines: DataFrame, classes: DataFrame, members: DataFrame) -> DataFrame:
    """``(rep, line)`` of every class in a bucket with another, read from the texts once and written."""
    wanted = materialise(classes.join(members.select("rep").distinct(), "rep", "left_semi").select("rep", "h1", "h2"), "ids")
    return materialise(lines.join(broadcast_if_short(wanted, SHORT), ["h1", "h2"]).groupBy("rep")
                       .agg(F.first("line").alias("line")), "found")


def verified(found: DataFrame, pairs: DataFrame, chars: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose shingle sets have the similarity; ``found`` has their lines."""
    def near(x):
        both, size_a, size_b = F.size(F.array_intersect(x["a"], x["b"])), F.size(x["a"]), F.size(x["b"])
        return 100 * both >= percent * (size_a + size_b - both)

    # the lines travel, not their sets; the lambda's argument keeps each set from being made more than once
    sets = F.array(F.struct(shingles(F.col("line_a"), chars).alias("a"), shingles(F.col("line_b"), chars).alias("b")))
    return pairs.join(found.select(F.col("rep").alias("a"), F.col("line").alias("line_a")), "a") \
        .join(found.select(F.col("rep").alias("b"), F.col("line").alias("line_b")), "b") \
        .where(F.exists(sets, near)).select("a", "b")


def dropped_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: int = CHARS,
                  percent: int = PERCENT) -> DataFrame:
    """``(doc, text_hash, dropped)``: the positions (from 0) of the lines that go, for texts that lose any."""
    hashed = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).withColumn("hash", F.xxhash64("text"))
    rows, ids = own_ids(hashed, "id", "hash")
    lines = line_rows(rows, "id", "text")
    classes = classes_of(lines, chars)
    members = shared_buckets(classes.select("rep", F.explode("bands").alias("band")), SHORT)
    found = lines_of(lines, classes, members)
    marks = marks_of(found, chars)
    label = link_buckets(members, lambda pairs: verified(found, likely(pairs, marks, percent), chars, percent),
                         lambda mixed: links_apart(found, mixed, marks, chars, percent))

    # only classes with another line somewhere can lose one
    of = classes.select("rep", "h1", "h2", "doc", "n").join(label.withColumnRenamed("id", "rep"), "rep", "left") \
        .where("n > 1 or component is not null").withColumn("component", F.coalesce("component", "rep"))
    keeper = of.groupBy("component").agg(F.min("doc").alias("keeper"))
    repeated = materialise(of.join(keeper, "component").select("h1", "h2", "component", "keeper"), "repeated")
    hits = lines.select("doc", "text_hash", "pos", "h1", "h2").join(broadcast_if_short(repeated, SHORT), ["h1", "h2"])
    per_line = hits.groupBy("doc", "text_hash", "component").agg(
        F.collect_set("pos").alias("at"), F.min("pos").alias("first"), F.max("keeper").alias("keeper"))
    gone = F.when(F.col("doc").eqNullSafe(F.col("keeper")), F.array_remove("at", F.col("first"))).otherwise(F.col("at"))
    out = per_line.select("doc", "text_hash", gone.alias("gone")).where(F.size("gone") > 0) \
        .groupBy("doc", "text_hash").agg(F.flatten(F.collect_list("gone")).alias("dropped"))
    if ids is None:
        return out
    return out.join(ids, out["doc"] == ids["own"], "left").select(F.col("key").alias("doc"), "text_hash", "dropped")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", n_dropped: str | None = None,
                chars: int = CHARS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with the text's repeated lines removed; ``n_dropped`` names a column for their number."""
    gone = materialise(dropped_lines(docs.select(key, text), key, text, chars, percent), "dropped").toDF("__doc", "__hash", "__dropped")
    lines = F.split(F.col(text), "\n")

    def joined(of):
        kept = F.array_except(F.sequence(F.lit(0), F.size(of) - 1), F.col("__dropped"))
        return F.array_join(F.transform(kept, lambda i: F.get(of, i)), "\n")

    # the lambda's argument keeps the text from being split once a line
    new = F.when(F.col("__dropped").isNull(), F.col(text)).otherwise(F.get(F.transform(F.array(lines), joined), F.lit(0)))
    count = [F.coalesce(F.size("__dropped"), F.lit(0)).cast("long").alias("__count")]

    def cut(rows: DataFrame) -> DataFrame:
        joined = rows.join(broadcast_if_small(gone, 4 * F.size("__dropped")), F.col(key).eqNullSafe(F.col("__doc"))
                           & (F.xxhash64(text) == F.col("__hash")), "left")
        return joined.select(*(new.alias(c) if c == text else F.col(c) for c in rows.columns), *count)

    return with_rest(docs, [key, text], cut, [F.col("__count").alias(n_dropped)] if n_dropped else [])
