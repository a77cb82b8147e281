"""Secret scan: Aho-Corasick keyword prefilter, anchored patterns at the hits, embedded checksums.

One pass of the automaton over the lower-cased bytes of the whole text finds
the places worth a look; a pattern is then matched *at* a place, never
searched for. Bare hexadecimal strings have no keyword: their prefilter is a
search for sixteen class characters in a row in the class-projected text.
Tokens that carry their own checksum are reported only if it is right.

Kinds, in the order used for ties: ``assign access hex`` (the base kinds) and
``github npm`` (checksummed tokens). Offsets are code points, end exclusive.
A null or empty text has no spans. Rows are independent: repeated rows give
repeated results, an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm")
SPANS = "array<struct<kind:string,start:int,end:int>>"

# fixed values: keywords (lower case) and the pattern to match where one is found
_KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
_PATTERNS = {
    "assign": re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "github": re.compile(rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
}
_BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
MIN_VALUE, MIN_ACCESS, MIN_HEX = 12, 18, 16

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_HEX = bytes(104 if c in b"0123456789abcdef" else 46 for c in range(256))


def checksum62(body: bytes) -> bytes:
    """crc32 of ``body`` as six base-62 digits, the check digits of these tokens."""
    n, out = zlib.crc32(body), bytearray()
    for _ in range(6):
        n, d = divmod(n, 62)
        out.append(_BASE62[d])
    return bytes(out[::-1])


def _valid(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[1]) >= MIN_VALUE
    if kind == "access":
        return m.end() - m.start() >= MIN_ACCESS
    return checksum62(m[1][:-6]) == m[1][-6:]


@lru_cache(1)
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, words in _KEYWORDS.items():
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """Spans ``(kind, start, end)`` of one whole text, by start and then kind."""
    if not text:
        return []
    raw = text.encode()
    found, over = [], dict.fromkeys(KINDS, 0)
    for at, (kind, size) in _automaton().iter(raw.translate(_LOWER).decode("latin-1")):
        start = at + 1 - size
        if start >= over[kind] and (m := _PATTERNS[kind].match(raw, start)):
            over[kind] = m.end()    # also a match that fails its check uses up its text
            if _valid(kind, m):
                found.append((start, KINDS.index(kind), m.end()))
    classes = raw.translate(_HEX)
    start = classes.find(b"h" * MIN_HEX)
    while start >= 0:
        end = start + MIN_HEX
        while end < len(classes) and classes[end] == 104:
            end += 1
        found.append((start, KINDS.index("hex"), end))
        start = classes.find(b"h" * MIN_HEX, end)
    found.sort()
    if len(raw) != len(text):
        places = sorted({p for s, _, e in found for p in (s, e)})
        chars, last, n = {}, 0, 0
        for p in places:
            n += len(raw[last:p].decode())
            chars[p], last = n, p
        found = [(chars[s], k, chars[e]) for s, k, e in found]
    return [(KINDS[k], s, e) for s, k, e in found]


def _spans(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in scan(t)] for t in texts], dtype=object)


def secret_spans(text) -> F.Column:
    """Column of spans ``array<struct<kind, start, end>>`` of a text column, by start and then kind."""
    return pandas_udf(_spans, SPANS)(text)
