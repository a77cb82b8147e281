"""Best-fit packing of documents into sequences with several capacities at once.

Documents are tokenised in full and end with a separator id. One longer than
a sequence is cut into full pieces, the first of which may be shorter. A piece
asks for tokens, one document place and attention cost (its length squared);
a sequence offers :data:`TOKENS`, ``docs`` and ``cost`` of these. Pieces go by
falling length, each into the sequence that all its demands fit and that
scores best: the largest weighted dot product of demand and residual
(``rule="dot"``) or the smallest weighted norm of what would be left
(``rule="norm"``). If none fits, a sequence is opened.

Scale: full pieces are sequences by themselves. The others are dealt by a
hash of the row's place to groups of about ``GROUP_ROWS`` pieces, which are packed
independently; a group leaves at most a few sequences with room, so the loss
against one big packing is a small share of one in a thousand. Lengths and
checksums travel, token ids stay where they were made; ``token_ids`` makes the
ids of a text again for whoever writes the sequences out.

Defined results: a null or empty text is the separator alone; a null id stays
null; repeated rows are packed as often as they occur; an
empty table gives no pieces.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

TOKENS = 1024
# slack by choice beside TOKENS, for the fewest sequences: pieces have a token at least, squares sum to at most the squared sum
DOCS = 1024             # documents in a sequence at most
COST = 1024 * 1024      # sum of squared lengths in a sequence at most
WEIGHTS = (1.0, 0.05, 0.05)     # of tokens, documents and cost in the score
SEPARATOR = 2
GROUP_ROWS = 8192
CACHE = 300_000         # distinct pieces of text whose ids a worker remembers (about 60 MB)
BLOCK = 1 << 20         # characters whose pieces are looked up together
PIECES = "key long, piece int, start long, length long, ids_crc32 long"

# fixed values: white space of the pre-tokeniser's pattern, outside ASCII
_SPACES = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of the first 65,536 code points: 0 white space, 1 letter, 2 number, 3 other."""
    import unicodedata

    out = np.full(0x10000, 3, np.int8)
    for c in range(0x10000):
        kind = unicodedata.category(chr(c))[0]
        out[c] = 1 if kind == "L" else 2 if kind == "N" else 3
    out[[*range(9, 14), 32, *_SPACES]] = 0
    return out


@lru_cache(1)
def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where it prints, else the next free one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return {b: chr(b if b in prints else next(free)) for b in range(256)}


class Ids(dict):
    """Little-endian ids of a piece of text, remembered up to ``CACHE`` pieces.

    A piece is merged by the tokeniser's model directly, in byte letters: the
    tokeniser's own pre-tokenisation is what :func:`piece_starts` has done.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.merge = tokenizer.model.tokenize

    def learn(self, pieces: set[str]) -> None:
        """Make sure of all ``pieces``."""
        if len(self) > CACHE:
            self.clear()
        letters, merge = _byte_letters(), self.merge
        for x in pieces.difference(self):
            ids = [t.id for t in merge(x.encode().decode("latin-1").translate(letters))]
            self[x] = struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(2)
def _tokenizer(path: str) -> tuple:
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    special = [x.content for x in t.get_added_tokens_decoder().values()]
    return t, Ids(t), special


def plain_codes(text: str, special: list[str]) -> np.ndarray | None:
    """Code points of a text that :func:`piece_starts` can cut; None where the tokeniser needs its own pattern.

    That is so for apostrophes (contractions), special tokens and rare code points.
    """
    if "'" in text or any(s in text for s in special):
        return None
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return None if codes.max(initial=0) >= 0x10000 else codes


def piece_starts(codes: np.ndarray) -> np.ndarray:
    """Where the byte-level pre-tokeniser begins a new piece of a non-empty text.

    Runs of letters, numbers and other signs, each with a single space before
    it; of white space before such a run all but its last character is a
    piece.
    """
    kind = _classes()[codes]
    new = np.empty(len(codes), bool)
    new[0] = True
    new[1:] = kind[1:] != kind[:-1]
    # a run after white space: the last blank goes with it if it is a space, else stands alone
    run = np.flatnonzero(new[1:] & (kind[:-1] == 0)) + 1
    space = codes[run - 1] == 32
    new[run[space]] = False
    new[run - 1] = True
    return np.flatnonzero(new)


def encode_texts(texts: list[str | None], path: str, separator: int = SEPARATOR) -> list[bytes]:
    """Ids of whole texts, little-endian 32-bit, each closed by the separator.

    The pieces of all texts form one Arrow string array over their bytes; its
    dictionary has every different piece once, and ids are gathered by
    dictionary index.
    """
    tokenizer, cache, special = _tokenizer(path)
    end = np.array([separator], "<u4")
    raws, offsets, counts, base = [], [], [], 0
    for t in texts:
        codes = plain_codes(t, special) if t else np.empty(0, np.uint32)
        if codes is None or not len(codes):
            counts.append(None if codes is None else 0)
            continue
        before = np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800)) if codes.max() >= 0x80 else None
        at = piece_starts(codes)
        raw = t.encode()
        offsets.append(base + (at if before is None else np.append(0, before)[at]))
        raws.append(raw)
        counts.append(len(at))
        base += len(raw)
    bounds = np.append(np.concatenate(offsets), base).astype(np.int64) if offsets else np.zeros(1, np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.tobytes()), pa.py_buffer(b"".join(raws))).dictionary_encode()
    names, which = pieces.dictionary.to_pylist(), pieces.indices.to_numpy()
    cache.learn(set(names))
    known = [cache[x] for x in names]
    size = np.fromiter(map(len, known), np.int64, len(known)) // 4
    first = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(known), "<u4")
    n = size[which]
    done = np.append(0, np.cumsum(n))           # ids before each piece
    ids = flat[np.repeat(first[which] - done[:-1], n) + np.arange(done[-1])] if done[-1] else flat
    out, piece = [], 0
    for t, k in zip(texts, counts):
        if k is None:
            own = np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4")
        else:
            own = ids[done[piece]:done[piece + k]]
            piece += k
        out.append(np.concatenate([own, end]).tobytes())
    return out


def token_ids(text: str | None, path: str, separator: int = SEPARATOR) -> bytes:
    """Ids of a whole text, little-endian 32-bit, closed by the separator."""
    return encode_texts([text], path, separator)[0]


def _blocks(keys, texts):
    """Rows in blocks of about ``BLOCK`` characters."""
    block, held = [], 0
    for k, t in zip(keys, texts):
        block.append((k, t))
        held += len(t or "")
        if held >= BLOCK:
            yield block
            block, held = [], 0
    if block:
        yield block


def cut(n: int, size: int = TOKENS) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens: full ones, but for the first."""
    if n <= size:
        return [(0, n)]
    head = n % size
    return ([(0, head)] if head else []) + [(s, size) for s in range(head, n, size)]


def tokenise(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", size: int = TOKENS,
             separator: int = SEPARATOR) -> DataFrame:
    """One row per piece, columns of :data:`PIECES`."""
    def run(batches):
        for b in batches:
            for block in _blocks(b["key"], b["text"]):
                out = []
                for (k, _), ids in zip(block, encode_texts([t for _, t in block], path, separator)):
                    k = None if pd.isna(k) else int(k)
                    out += [(k, i, s, n, zlib.crc32(ids[4 * s:4 * (s + n)]))
                            for i, (s, n) in enumerate(cut(len(ids) // 4, size))]
                df = pd.DataFrame(out, columns=["key", "piece", "start", "length", "ids_crc32"])
                yield df.astype({"key": "Int64"})

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInPandas(run, PIECES)


def best_fit(lengths: np.ndarray, size: int = TOKENS, docs: int = DOCS, cost: int = COST, weights=WEIGHTS,
             rule: str = "dot") -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each of ``lengths``, which fall.

    Equal open sequences are not told apart: they are grouped by residual, and
    a piece looks at the groups only.
    """
    whole = np.array([size, docs, cost], float)
    pull = np.array(weights) / whole
    open_at: dict[tuple[int, int, int], list[int]] = {}     # residual -> sequences
    table, keys, live = np.zeros((64, 3)), [], {}           # residuals with sequences, for the scores
    seq, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened = 0

    def put(residual, number):
        nonlocal table
        if residual[0] <= 0 or residual[1] <= 0 or residual[2] <= 0:
            return      # nothing fits any more
        if residual not in open_at:
            open_at[residual] = []
            live[residual] = len(keys)
            keys.append(residual)
            if len(keys) > len(table):
                table = np.concatenate((table, np.zeros_like(table)))
            table[live[residual]] = residual
        open_at[residual].append(number)

    for i, n in enumerate(lengths.tolist()):
        need = np.array([n, 1, n * n], float)
        rest = table[:len(keys)]
        fits = (rest >= need).all(1)
        if fits.any():
            if rule == "dot":
                # of the sequences that fit, the residual most aligned with the demand, relative to its size
                part = rest * pull
                value = -(part @ (need / whole)) / (np.einsum("ij,ij->i", part, rest / whole) + 1e-12)
            else:
                value = (((rest - need) / whole) ** 2) @ np.array(weights)
            best = int(np.where(fits, value, np.inf).argmin())
            residual = keys[best]
            number = open_at[residual].pop()
            if not open_at[residual]:
                del open_at[residual]
                gone = live.pop(residual)
                last = keys.pop()
                if last is not residual and gone < len(keys):
                    keys[gone], live[last] = last, gone
                    table[gone] = table[len(keys)]
        else:
            residual, number = (size, docs, cost), opened
            opened += 1
        seq[i], offset[i] = number, size - residual[0]
        put((residual[0] - n, residual[1] - 1, residual[2] - n * n), number)
    return seq, offset


def pack(pieces: DataFrame, size: int = TOKENS, docs: int = DOCS, cost: int = COST, weights=WEIGHTS,
         rule: str = "dot", group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (columns of :data:`PIECES`, read more than once)."""
    rows = pieces.where(F.col("length") < size).count()
    groups = max(1, -(-rows // group_rows))
    spot = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))    # by row: copies do not pile up
    schema = PIECES + ", sequence_id long, offset long"
    step = 1 << 20      # more sequences than a group can open

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "key", "piece"], ascending=[False, True, True], kind="stable")
        seq, offset = best_fit(pdf["length"].to_numpy(), size, docs, cost, weights, rule)
        out = pdf.drop(columns="spot").astype({"key": "Int64"})
        out["sequence_id"] = seq + int(pdf["spot"].iloc[0]) * step
        out["offset"] = offset
        return out

    full = pieces.where(F.col("length") >= size).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = pieces.where(F.col("length") < size).withColumn("spot", spot).groupBy("spot").applyInPandas(run, schema)
    return part.unionByName(full)


def pack_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Tokenise and pack whole documents; the piece table is written once to the shared folder."""
    return pack(materialise(tokenise(docs, path, key, text), "pieces"), **how).withColumnRenamed("key", key)
