"""Language identification: scripts narrow the candidates, Viterbi over word scores labels spans.

A word's main script leaves the languages that use it. Those are scored by
hashed character n-grams of the word (log-likelihood ratios learned from
labelled texts), and a Viterbi pass over the words of the whole text, with a
penalty for every switch, labels each word; runs of one label are the spans.
The document's language is the label with the most letters.

Everything is numpy over blocks of texts: n-grams of a block in a few array
operations, Viterbi word by word for all texts of the block at once. A very
long text is scored piece by piece (cut at white space) and decoded as a
whole, so memory grows with its number of words only.

Defined results: a null text or one without a letter is ``und``, score 0, no
spans; so is every text if nothing was learned. Repeated rows score alike; an
empty table gives an empty table. Only the text is an input.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import materialise

UNKNOWN = "und"
BUCKET_BITS = 16
ORDERS = (2, 3, 4)
SWITCH = 8.0            # nats a change of language costs
SMOOTHING = 0.5
TRAIN_DOCS = 2000       # different labelled texts a language, chosen by a hash of the text
SCRIPT_SHARE = 0.01     # a language uses a script if this share of its letters is in it
BLOCK = 1 << 19         # characters scored at a time
RESULT = "lang string, score double, spans array<struct<start:int,end:int,lang:string>>"

# fixed values: first and last code point of the letters of each script (Unicode blocks)
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F), (0xA8E0, 0xA8FF)),
    "bengali": ((0x980, 0x9FF),),
    "gurmukhi": ((0xA00, 0xA7F),),
    "gujarati": ((0xA80, 0xAFF),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "kannada": ((0xC80, 0xCFF),),
    "malayalam": ((0xD00, 0xD7F),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF), (0x2D00, 0x2D2F)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "ethiopic": ((0x1200, 0x139F),),
    "khmer": ((0x1780, 0x17FF),),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)),
}
N_SCRIPTS = len(SCRIPTS) + 1    # the last stands for any other


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray       # bucket x language
    uses: np.ndarray        # script x language


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: lower-case letter or 0, and script."""
    top = 0x110000
    lower, script = np.zeros(top, np.int32), np.full(top, N_SCRIPTS - 1, np.int8)
    for c in range(top):
        if chr(c).isalpha():
            x = chr(c).lower()
            lower[c] = ord(x) if len(x) == 1 else c
    for k, ranges in enumerate(SCRIPTS.values()):
        for a, b in ranges:
            script[a:b + 1] = k
    return lower, script


def _grams(letters: np.ndarray) -> list[np.ndarray]:
    """Bucket of the n-gram that starts at each position but the last three, per order; -1 if there is none.

    ``letters`` has 0 for all that is no letter; an n-gram may have it at its ends only.
    """
    x = letters.astype(np.uint64)
    n = len(x) - 3
    out, is_letter = [], letters > 0
    for k in ORDERS:
        h = np.full(n, k, np.uint64)
        for j in range(k):
            h = (h ^ x[j:n + j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        ok = is_letter[:n] | is_letter[1:n + 1]
        for j in range(1, k - 1):
            ok &= is_letter[j:n + j]
        out.append(np.where(ok, (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), np.int32(-1)))
    return out


def _codes(text: str) -> np.ndarray:
    """Code points with a blank before and four after."""
    return np.frombuffer(f" {text}    ".encode("utf-32-le"), np.uint32)


def _blank(codes: np.ndarray) -> np.ndarray:
    return (codes == 32) | ((codes >= 9) & (codes <= 13))


def count_text(text: str) -> tuple[np.ndarray, np.ndarray]:
    """n-gram and script counts of a text."""
    lower, script = _tables()
    codes = _codes(text)
    letters = lower[codes]
    grams = np.zeros(1 << BUCKET_BITS, np.int64)
    for g in _grams(letters):
        grams += np.bincount(g[g >= 0], minlength=len(grams))
    return grams, np.bincount(script[codes[letters > 0]], minlength=N_SCRIPTS)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", max_docs: int = TRAIN_DOCS) -> Model:
    """Learn from the rows of ``labelled`` that have a text and a language.

    Of each language about ``max_docs`` different texts are read, one copy of each, all if there are fewer: those
    whose hash is below its share, and the one with the smallest hash in any case. Counts are summed by language on
    the executors; the driver gets one vector of ``2 ** BUCKET_BITS`` counts per language.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text <> '' and lang is not null") \
        .withColumn("hash", F.xxhash64("text", F.lit(7)))
    distinct = materialise(rows.select("lang", "hash").distinct(), "texts")
    sizes = {r["lang"]: r for r in distinct.groupBy("lang").agg(F.count("*").alias("n"), F.min("hash").alias("first")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((1 << BUCKET_BITS, 0), np.float32), np.zeros((N_SCRIPTS, 0), bool))
    share = F.create_map(*(F.lit(x) for k in langs for x in (k, min(1.0, max_docs / sizes[k]["n"]))))
    first = F.create_map(*(F.lit(x) for k in langs for x in (k, sizes[k]["first"])))
    below = F.pmod("hash", F.lit(1 << 20)) < share[F.col("lang")] * float(1 << 20)
    drawn = distinct.where(below | (F.col("hash") == first[F.col("lang")]))

    def once(batches):
        """The first copy in this task; the others go no further."""
        part, seen = TaskContext.get().partitionId(), set()
        for b in batches:
            new = [(k, h) not in seen and not seen.add((k, h)) for k, h in zip(b["lang"], b["hash"])]
            yield b[new].assign(part=part)

    copies = materialise(rows.join(F.broadcast(drawn), ["lang", "hash"]).select("lang", "hash", "text")
                         .mapInPandas(once, "lang string, hash long, text string, part int"), "drawn")
    chosen = copies.join(F.broadcast(copies.groupBy("lang", "hash").agg(F.min("part").alias("part"))), ["lang", "hash", "part"]) \
        .select("text", "lang")

    def count(batches):
        sums: dict = {}
        for b in batches:
            for t, k in zip(b["text"], b["lang"]):
                for at in range(0, len(t), BLOCK):
                    pair = count_text(t[at:at + BLOCK])
                    sums[k] = tuple(map(np.add, sums[k], pair)) if k in sums else pair
        yield pd.DataFrame([(k, g.tobytes(), s.astype(np.int64).tobytes()) for k, (g, s) in sums.items()],
                           columns=["lang", "grams", "scripts"])

    def add(pdf):
        total = lambda c: sum(np.frombuffer(x, np.int64) for x in pdf[c]).tobytes()
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "grams": [total("grams")], "scripts": [total("scripts")]})

    schema = "lang string, grams binary, scripts binary"
    got = {r["lang"]: r for r in chosen.repartition(12).mapInPandas(count, schema)
           .groupBy("lang").applyInPandas(add, schema).collect()}
    langs = [k for k in langs if k in got]
    grams = np.array([np.frombuffer(got[k]["grams"], np.int64) for k in langs], float).T
    scripts = np.array([np.frombuffer(got[k]["scripts"], np.int64) for k in langs], float).T
    table = np.log((grams + SMOOTHING) / (grams.sum(0) + SMOOTHING * len(grams)))
    table -= table.mean(1, keepdims=True)
    uses = scripts >= np.maximum(SCRIPT_SHARE * scripts.sum(0), 1)
    return Model(langs, (table / len(ORDERS)).astype(np.float32), uses)


def _score_words(text: str, model: Model) -> tuple[np.ndarray, ...]:
    """Start, end, letters and score vector of every word of a piece of text."""
    lower, script = _tables()
    codes = _codes(text)
    blank = _blank(codes)
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    n_langs = len(model.langs)
    if not len(start):
        return start, end, start, np.zeros((0, n_langs), np.float32)
    letters = lower[codes]
    scores = np.zeros((len(codes) - 3, n_langs), np.float32)
    for g in _grams(letters):
        ok = g >= 0
        scores[ok] += model.table[g[ok]]
    total = np.add.reduceat(scores, np.column_stack((start - 1, end)).ravel(), axis=0)[0::2]
    is_letter = letters > 0
    cells = np.column_stack((start, end)).ravel()
    n_letters = np.add.reduceat(is_letter.astype(np.int64), cells)[0::2]
    kinds = np.unique(script[codes[is_letter]])
    per = np.array([np.add.reduceat((is_letter & (script[codes] == k)).astype(np.int64), cells)[0::2] for k in kinds])
    if len(kinds):
        uses = model.uses[kinds]
        uses[~uses.any(1)] = True       # a script nobody was seen to use tells nothing
        total[~uses[per.argmax(0)] & (n_letters > 0)[:, None]] -= 1e4
    total[n_letters == 0] = 0
    return start - 1, end - 1, n_letters, total


def _pieces(text: str) -> list[tuple[int, str]]:
    """The text in pieces of about ``BLOCK`` characters that end before white space."""
    out, at = [], 0
    while len(text) - at > 2 * BLOCK:
        cut = at + BLOCK
        while cut < len(text) and text[cut] not in " \t\n\x0b\x0c\r":
            cut += 1
        out.append((at, text[at:cut]))
        at = cut
    return [*out, (at, text[at:])]


def viterbi(scores: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of every word. ``scores`` holds the words of all texts one after the other, ``sizes`` their counts."""
    labels = np.zeros(len(scores), np.int16)
    if not len(scores):
        return labels
    order = np.argsort(-sizes, kind="stable")
    first = (np.cumsum(sizes) - sizes)[order]
    alive = np.searchsorted(-sizes[order], -np.arange(sizes.max()), side="left")     # texts with more than t words
    best = scores[first[:alive[0]]].astype(np.float64)
    moved, came = np.zeros(scores.shape, bool), np.zeros(len(scores), np.int16)
    for t in range(1, len(alive)):
        n = alive[t]
        at = first[:n] + t
        b = best[:n]
        top = b.argmax(1)
        bar = b[np.arange(n), top] - switch
        came[at] = top
        moved[at] = b < bar[:, None]
        best[:n] = np.maximum(b, bar[:, None]) + scores[at]
    state = best.argmax(1).astype(np.int16)
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        at = first[:n] + t
        labels[at] = state[:n]
        state[:n] = np.where(moved[at, state[:n]], came[at], state[:n])
    return labels


def identify(texts: list[str | None], model: Model) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """Language, letter share of that language and spans of every text."""
    out = [(UNKNOWN, 0.0, [])] * len(texts)
    if not model.langs:
        return out
    block, held = [], 0
    for i, t in enumerate(texts):
        if t:
            block.append((i, t))
            held += len(t)
        if block and (held >= BLOCK or i == len(texts) - 1):
            _identify_block(block, model, out)
            block, held = [], 0
    if block:
        _identify_block(block, model, out)
    return out


def _identify_block(block, model, out) -> None:
    words: list[list[tuple]] = [[] for _ in block]
    run, at = [], 0
    short = [(k, t) for k, (_, t) in enumerate(block) if len(t) <= 2 * BLOCK]
    if short:       # short texts together
        start, end, n_letters, scores = _score_words("\n".join(t for _, t in short), model)
        for k, t in short:
            run.append((k, at, at + len(t)))
            at += len(t) + 1
        lo = np.searchsorted(start, [a for _, a, _ in run])
        hi = np.searchsorted(start, [b for _, _, b in run])
        for (k, a, _), i, j in zip(run, lo, hi):
            words[k].append((start[i:j] - a, end[i:j] - a, n_letters[i:j], scores[i:j]))
    for k, (_, t) in enumerate(block):
        if len(t) > 2 * BLOCK:
            for a, piece in _pieces(t):
                s, e, n, x = _score_words(piece, model)
                words[k].append((s + a, e + a, n, x))
    start, end, n_letters, scores = (np.concatenate([w[c] for ws in words for w in ws]) for c in range(4))
    sizes = np.array([sum(len(w[0]) for w in ws) for ws in words])
    labels = viterbi(scores, sizes)
    lo = 0
    for (i, _), n in zip(block, sizes):
        hi = lo + n
        mine = np.bincount(labels[lo:hi], n_letters[lo:hi], len(model.langs)) if n else np.zeros(1)
        if mine.sum() > 0:
            y = labels[lo:hi]
            cut = np.flatnonzero(y[1:] != y[:-1]) + 1
            a, b = np.concatenate(([0], cut)), np.concatenate((cut, [n]))
            spans = [(int(start[lo + p]), int(end[lo + q - 1]), model.langs[y[p]]) for p, q in zip(a, b)]
            best = int(mine.argmax())
            out[i] = (model.langs[best], float(mine[best] / mine.sum()), spans)
        lo = hi


def label_languages(model: Model, text) -> F.Column:
    """Column ``struct<lang, score, spans>`` of a text column."""
    from pyspark.sql import SparkSession

    shared = SparkSession.active().sparkContext.broadcast(model)

    def label(texts: pd.Series) -> pd.DataFrame:
        got = identify([None if t is None else t for t in texts], shared.value)
        return pd.DataFrame({"lang": [g[0] for g in got], "score": [g[1] for g in got],
                             "spans": [[{"start": a, "end": b, "lang": k} for a, b, k in g[2]] for g in got]})

    return pandas_udf(label, RESULT)(text)
