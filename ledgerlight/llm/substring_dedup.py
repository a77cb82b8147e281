"""Substring dedup: token windows that occur earlier in the corpus are cut out, as maximal intervals.

Every window of ``window`` words gets a Rabin-Karp hash: word hashes, prefix
sums of a polynomial modulo 2**64, one subtraction and one multiplication a
window. A window repeats if its 96 hash bits occur again; the occurrences are
counted in Spark, all but the first (smallest document id, then position) mark
their words, and marked words merge into maximal intervals.

Sending every window of a corpus costs several times the corpus, so a window is
sent only if it can repeat. Each window has an *anchor*, the ``anchor``-word
run inside it with the smallest hash. Equal windows have equal anchors at
equal places, so a window whose anchor occurs once in the corpus occurs once
itself; neighbouring windows mostly share their anchor, so there are far fewer
anchors than windows. Anchors are counted first, then the windows around
repeated anchors. Nothing is lost by it.

Before anything is shuffled, a task works through its texts in chunks of about
``CHUNK`` words: what occurs twice within a chunk is settled there, and one
occurrence is sent. So a passage that a third of all documents share sends one
row per chunk. A text longer than ``PIECE`` bytes is worked through in pieces
that overlap by a window less a word.

Defined results: a null text has no words and an empty rest; texts with fewer
words than a window stay whole; a null id comes before all others; rows that
share an id are ordered by a hash of their text, and of equal rows (id and
text) one counts as first while the others are repeats of it; an empty table
gives no rows; other columns of the input are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

WINDOW, ANCHOR = 20, 8
CHUNK = 1 << 20
PIECE = 1 << 22
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BASES = {"anchor": 0x9E3779B97F4A7C15, "window": 0xD6E8FEB86659FD93, "check": 0xA0761D6478BD642F}
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_PLACE = np.uint64((1 << 24) - 1)
_NO_ID = -(1 << 63)


def words_of(text: bytes | None, size: int = PIECE) -> Iterator[list[bytes]]:
    """Words of a text in pieces of about ``size`` bytes, cut at white space."""
    at, n = 0, len(text or b"")
    while at < n:
        cut = _SPACE.search(text, at + size) if at + size < n else None
        end = cut.start() if cut else n
        yield text[at:end].split()      # bytes.split() knows exactly space and TAB..CR
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash modulo 2**64 of every run of ``width`` values, by prefix sums."""
    n = len(values)
    if n < width:
        return np.empty(0, np.uint64)
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        inverse = pow(base, -1, 1 << 64)
        _POWERS[base] = tuple(np.multiply.accumulate(np.full(n, b, np.uint64)) for b in (base, inverse))
    up, down = _POWERS[base]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:n], dtype=np.uint64)])
    return mix((sums[width:] - sums[:n - width + 1]) * down[:n - width + 1])


class Chunk:
    """Word hashes of consecutive texts, with the key and place of each segment."""

    def __init__(self, segments: list[tuple], window: int, anchor: int):
        self.window = window
        sizes = np.array([len(s[-1]) for s in segments], np.int64)
        self.begin = np.cumsum(sizes) - sizes
        self.key = np.array([s[0] for s in segments], np.int64)
        self.text_key = np.array([s[1] for s in segments], np.int64)
        self.first = np.array([s[2] for s in segments], np.int64)
        self.hashes = np.concatenate([s[-1] for s in segments])
        self.segment = np.repeat(np.arange(len(segments)), sizes)
        n = max(0, len(self.hashes) - window + 1)
        self.whole = self.segment[:n] == self.segment[window - 1:window - 1 + n]    # windows within one segment
        self.anchors = rolling(self.hashes, anchor, _BASES["anchor"])
        # smallest hash of each window by doubling, its place in the low bits (the leftmost of equal ones)
        low = (self.anchors & ~_PLACE) | np.arange(len(self.anchors), dtype=np.uint64)
        reach, span = 1, window - anchor + 1
        while reach * 2 <= span:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        if span > reach and len(low):
            low = np.minimum(low[:reach - span], low[span - reach:])
        self.anchor_at = (low[:n] & _PLACE).astype(np.int64)

    def place(self, at: np.ndarray) -> np.ndarray:
        """Position in its document of the word at a place of the chunk."""
        s = self.segment[at]
        return self.first[s] + at - self.begin[s]

    def spread(self, at: np.ndarray) -> np.ndarray:
        """A key of their own for rows that need no partner, so that they lie evenly."""
        s = self.segment[at]
        return mix(mix(self.key[s].astype(np.uint64)) + self.place(at).astype(np.uint64)).astype(np.int64)


def _chunks(batches, window: int, anchor: int, limits: tuple[int, int], with_marks: bool = False):
    """Chunks of about ``limits[0]`` words, each with the anchor places known of its segments."""
    segments, marks, n = [], [], 0
    for b in batches:
        texts = b.column("text").cast(pa.binary())
        keys, text_keys = b.column("key").to_pylist(), b.column("text_key").to_pylist()
        for i, (key, text_key) in enumerate(zip(keys, text_keys)):
            at, tail = 0, np.empty(0, np.uint64)
            mark = np.array(b.column("at")[i].as_py(), np.int64) if with_marks else None
            for words in words_of(texts[i].as_py(), limits[1]):
                new = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
                hashes = np.concatenate([tail, new]) if len(tail) else new
                if len(hashes) >= window:
                    segments.append((key, text_key, at - len(tail), hashes))
                    marks.append(mark)
                    n += len(hashes)
                at += len(new)
                tail = hashes[max(0, len(hashes) - window + 1):]
                if n >= limits[0]:
                    yield Chunk(segments, window, anchor), marks
                    segments, marks, n = [], [], 0
    if segments:
        yield Chunk(segments, window, anchor), marks


def _find_anchors(window: int, anchor: int, limits: tuple[int, int]):
    """Rows ``(hash, key, text_key, at, n)``: the anchors of a chunk. ``n``: how often it counts (0: known to repeat)."""
    def run(batches):
        for c, _ in _chunks(batches, window, anchor, limits):
            seen = np.zeros(len(c.hashes), bool)
            seen[c.anchor_at[c.whole]] = True
            at = np.flatnonzero(seen)
            values, back, count = np.unique(c.anchors[at], return_inverse=True, return_counts=True)
            known = count[back] > 1
            alone, twice = at[~known], at[known]
            s = c.segment[np.concatenate([alone, twice])]
            none = np.zeros(int((count > 1).sum()), np.int64)
            yield pa.RecordBatch.from_pydict({
                "hash": np.concatenate([c.anchors[alone].astype(np.int64), c.spread(twice), values[count > 1].astype(np.int64)]),
                "key": np.concatenate([c.key[s], none]), "text_key": np.concatenate([c.text_key[s], none]),
                "at": np.concatenate([c.place(alone), c.place(twice), none - 1]),
                "n": np.repeat(np.array([1, 0, 2], np.int32), [len(alone), len(twice), len(none)])})
    return run


def _find_windows(window: int, anchor: int, limits: tuple[int, int]):
    """Rows ``(hash, check, key, text_key, start, length)`` of the windows around repeated anchors.

    ``length`` 0: the chunk's first occurrence of a window; else an interval
    of words known to occur earlier within the chunk.
    """
    def run(batches):
        for c, marks in _chunks(batches, window, anchor, limits, with_marks=True):
            open_ = np.zeros(len(c.hashes), bool)
            for s, mark in enumerate(marks):
                end = c.begin[s + 1] if s + 1 < len(c.begin) else len(c.hashes)
                at = mark - c.first[s] + c.begin[s]
                open_[at[(at >= c.begin[s]) & (at < end)]] = True
            at = np.flatnonzero(c.whole & open_[c.anchor_at])
            hashes = rolling(c.hashes, window, _BASES["window"])[at]
            check = (rolling(mix(c.hashes), window, _BASES["check"])[at] >> np.uint64(32)).astype(np.int64).astype(np.int32)
            s = c.segment[at]
            place = c.place(at)
            order = np.lexsort((place, c.text_key[s], c.key[s], check, hashes))
            same = (hashes[order][1:] == hashes[order][:-1]) & (check[order][1:] == check[order][:-1])
            repeat = np.zeros(len(at), bool)
            repeat[order[1:][same]] = True
            lead, dup = at[~repeat], at[repeat]
            # runs of consecutive repeated windows of one segment, as intervals of words
            new = np.ones(len(dup), bool)
            new[1:] = (np.diff(dup) > 1) | (np.diff(c.segment[dup]) > 0)
            runs = np.flatnonzero(new)
            length = np.diff(np.append(runs, len(dup))) + window - 1
            head = dup[runs]
            s = c.segment[np.concatenate([lead, head])]
            yield pa.RecordBatch.from_pydict({
                "hash": np.concatenate([hashes[~repeat].astype(np.int64), c.spread(head)]),
                "check": np.concatenate([check[~repeat], np.zeros(len(head), np.int32)]),
                "key": c.key[s], "text_key": c.text_key[s], "start": np.concatenate([place[~repeat], place[repeat][runs]]),
                "length": np.concatenate([np.zeros(len(lead), np.int64), length])})
    return run


def merge(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Maximal intervals of a union of half-open intervals."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    head = np.flatnonzero(np.append(True, starts[1:] > reach[:-1]))
    return [(int(a), int(b)) for a, b in zip(starts[head], reach[np.append(head[1:] - 1, len(starts) - 1)])]


def without(text: bytes | None, spans: list[tuple[int, int]]) -> tuple[int, str]:
    """Number of words of a text, and its words outside the spans, joined by one space."""
    n, kept, k = 0, [], 0
    for words in words_of(text):
        at, end = n, n + len(words)
        if not spans:
            kept.append(b" ".join(words))
        while at < end and spans:
            while k < len(spans) and spans[k][1] <= at:
                k += 1
            begin, stop = spans[k] if k < len(spans) else (end, end)
            if at < begin:
                kept.append(b" ".join(words[at - n:min(begin, end) - n]))
            at = max(at, min(stop, end) if begin < end else end)
        n = end
    return n, b" ".join(x for x in kept if x).decode()


def _cut(window: int):
    """Texts with their repeated windows -> ``(doc_id, n_words, removed, kept_text)``, one row per copy."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                        ("removed", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                        ("kept_text", pa.string())])

    def run(batches):
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            rows, size = [], 0
            for doc_id, found, copies, text in zip(b.column("doc_id").to_pylist(), b.column("found"),
                                                   b.column("copies").to_pylist(), texts):
                text, found = text.as_py(), found.as_py() or []
                start = np.array([f["start"] for f in found], np.int64)
                length = np.array([f["length"] for f in found], np.int64)
                spans = merge(start, start + np.where(length == 0, window, length))
                n, kept = without(text, spans)
                rows.append((doc_id, n, spans, kept))
                if copies > 1:      # the others repeat the first word for word
                    spans = [(0, n)] if n >= window else []
                    other = (doc_id, n, spans, "" if spans else kept)
                    for _ in range(copies - 1):
                        rows.append(other)
                        if len(rows) >= 10_000:
                            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, _typed(r))) for r in rows], schema)
                            rows, size = [], 0
                size += len(kept)
                if size > PIECE:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, _typed(r))) for r in rows], schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, _typed(r))) for r in rows], schema)
    return run


def _typed(row):
    doc_id, n, spans, kept = row
    return doc_id, n, [{"start": a, "stop": b} for a, b in spans], kept


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, key, text_key, copies, text)``: a row per document, or per different text of an id that is not unique."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ids = d.groupBy("doc_id").count()
    if ids.where("count > 1 or doc_id is null").isEmpty():
        return d.select("doc_id", F.col("doc_id").alias("key"), F.lit(0).cast("long").alias("text_key"),
                        F.lit(1).cast("long").alias("copies"), "text")
    # a hash of the text tells rows of one id apart; a null id takes the smallest key and another hash
    text_key = F.xxhash64(F.coalesce("text", F.lit("")), F.col("doc_id").isNull())
    return materialise(d.withColumn("text_key", text_key).groupBy("doc_id", "text_key")
                       .agg(F.max("text").alias("text"), F.count("*").alias("copies"))
                       .select("doc_id", F.coalesce("doc_id", F.lit(_NO_ID)).alias("key"), "text_key", "copies", "text"),
                       "classes")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   anchor: int = ANCHOR, limits: tuple[int, int] = (CHUNK, PIECE)) -> DataFrame:
    """``(doc_id, n_words, removed, kept_text)`` of every document.

    ``removed`` lists the maximal intervals of words ``[start, stop)`` covered
    by windows that occur earlier; ``kept_text`` joins the other words by one
    space. ``limits`` are the words of a chunk and the bytes of a piece.
    """
    if not 1 <= anchor <= window:
        raise ValueError("an anchor lies within its window")
    # keys that cannot be null, so that both joins below ask for the same rows and the texts are shuffled once for both
    texts = _classes(docs, id_col, text_col) \
        .select("doc_id", F.coalesce("key", F.lit(_NO_ID)).alias("key"), F.coalesce("text_key", F.lit(0)).alias("text_key"), "copies", "text")
    found = texts.select("key", "text_key", "text").mapInArrow(_find_anchors(window, anchor, limits), "hash long, key long, text_key long, at long, n int")
    total = F.sum("n").over(Window.partitionBy("hash"))
    again = found.withColumn("total", total).where("n = 0 or (n = 1 and total > 1)")
    marks = materialise(again.groupBy("key", "text_key").agg(F.collect_list("at").alias("at")), "anchors")

    windows = texts.join(marks, ["key", "text_key"]).select("doc_id", "key", "text_key", "copies", "at", "text") \
        .mapInArrow(_find_windows(window, anchor, limits), "hash long, check int, key long, text_key long, start long, length long")
    place = F.row_number().over(Window.partitionBy("hash", "check").orderBy("key", "text_key", "start"))
    repeated = windows.withColumn("place", place).where("length > 0 or place > 1")
    spans = repeated.groupBy("key", "text_key").agg(F.collect_list(F.struct("start", "length")).alias("found"))
    return texts.join(spans, ["key", "text_key"], "left").select("doc_id", "text", "copies", "found") \
        .mapInArrow(_cut(window), "doc_id long, n_words long, removed array<struct<start: long, stop: long>>, kept_text string")
