"""Small inputs with every awkward case, and plain-Python reference forms."""

from __future__ import annotations

import random
import re

import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use inside.
CLASH = "key string, size string, rep string, band string, component string, text_hash string, host string, line string, n string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYLLABLES = "ka lo mi re su ta vo ne shi dru pal ost ing er und".split()


def word(rng):
    return "".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))


def awkward_docs(seed=1, n=60):
    """Rows with nulls in every column, empty, blank and very long texts, copies, near copies and repeated rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = "\n".join(prose(rng, rng.randint(8, 40)) for _ in range(rng.randint(1, 5)))
        rows.append((i, t, rng.choice(["aa", "bb", None]), rng.choice(["s1", "s1", "s1", "s2", "é", None]), len(t)))
    base = rows[3][1]
    for k in range(6):
        w = base.split(" ")
        w[k % len(w)] = word(rng) + "x"
        rows.append((100 + k, " ".join(w), "aa", "s1", None))
        rows.append((120 + k, base, None, "s2", 1))
    rows += [(200, None, None, None, None), (201, "", "aa", "s1", 0), (202, " \n\t ", "aa", "s2", 4), (None, base, "aa", "s1", 3),
             (None, None, None, None, None), (203, "single", "bb", "s2", 6), (204, "two words", "bb", "s2", 9),
             (205, prose(rng, 30000), "aa", "s1", 1), (206, "x" * 200_000, "aa", "s2", 1), (207, "one " * 300, "aa", "s2", 1)]
    rows += [rows[5], rows[5]]
    return rows


def docs_frame(spark, rows, clash=True):
    df = spark.createDataFrame(rows, DOCS)
    if clash:
        for c in CLASH.split(", "):
            name = c.split()[0]
            df = df.selectExpr("*", f"concat('c', doc_id) as {name}")
    return df


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def text_hash(text):
    """Spark's xxhash64 of a text: rows that share an id are in its order."""
    if text is None:
        return 42
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def closure(ids, links):
    """Smallest id reachable from each id."""
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def word_set(text, words):
    w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in WORD.findall(text or "")]
    if 0 < len(w) < words:
        return {tuple(w)}
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)}


def similar(a, b, percent=80):
    return bool(a & b) and 100 * len(a & b) >= percent * len(a | b)
