import random
import re

from pyspark.sql import functions as F

from ledgerlight.llm import line_dedup as ld
from llm_fixtures import awkward_docs, closure, docs_frame, empty_docs, prose, similar, text_hash


def brute(rows):
    """Text of every row after the dedup, by comparing all pairs of distinct lines; rows are told apart by id and text."""
    own = lambda r: None if r[0] is None else (r[0], text_hash(r[1]))
    blanks = " \t\n\x0b\x0c\r"
    norm = lambda x: x.strip(blanks).lower()
    first = {}
    for r in rows:
        for x in (r[1] or "").split("\n"):
            if norm(x):
                first.setdefault(norm(x), []).append(own(r))
    names = sorted(first)
    sets = [{x[i:i + 8] for i in range(max(1, len(x) - 7))} for x in names]
    links = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))
             if len(sets[i]) * 100 >= 80 * len(sets[j]) and len(sets[j]) * 100 >= 80 * len(sets[i]) and similar(sets[i], sets[j])]
    comp = closure(range(len(names)), links)
    of = {x: comp[i] for i, x in enumerate(names)}
    keeper = {}
    for x, docs in first.items():
        ids = [d for d in docs if d is not None]
        if ids:
            keeper[of[x]] = min([keeper.get(of[x], ids[0]), *ids])
    out = []
    for r in rows:
        if r[1] is None:
            out.append(None)
            continue
        seen, kept = set(), []
        for x in r[1].split("\n"):
            c = of.get(norm(x))
            if c is not None:
                if keeper.get(c) != own(r) or c in seen:
                    continue
                seen.add(c)
            kept.append(x)
        out.append("\n".join(kept))
    return out


def _rows():
    rng = random.Random(9)
    rows = [r for r in awkward_docs(9, 25) if r[0] not in (205, 206)]
    lines = [prose(rng, 14) for _ in range(12)]
    for k in range(25):     # shared lines: exact, cased, edited by a letter, short
        a, b = rng.choice(lines), rng.choice(lines)
        edited = b[:20] + rng.choice("xyz") + b[21:]
        rows.append((300 + k, "\n".join([a, a.upper(), prose(rng, 10), " " + edited + "\t", "ok", "", "ok"]), "aa", "s1", 1))
    rows.append((None, lines[0] + "\nonly under a null id", "aa", "s1", 1))
    return rows


def test_equals_brute_force(spark):
    rows = _rows()
    df = docs_frame(spark, rows)
    got = ld.dedup_lines(df, n_dropped="gone")
    assert got.columns == [*df.columns, "gone"]
    key = lambda x: repr(x)
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=key) == \
        sorted(zip([r[0] for r in rows], brute(rows)), key=key)


def test_hot_group_of_similar_lines(spark):
    """One line that most documents hold, and a large group of variants of another."""
    rng = random.Random(2)
    base = prose(rng, 25)
    rows = [(i, f"the one line that everybody has, always\n{base[:i % 90]}{chr(97 + i % 26)}{base[i % 90 + 1:]}\n{prose(rng, 12)}",
             None, None, None) for i in range(300)]
    got = {r["doc_id"]: r["text"] for r in ld.dedup_lines(docs_frame(spark, rows, clash=False)).collect()}
    assert [got[r[0]] for r in rows] == brute(rows)
    assert sum("everybody" in t for t in got.values()) == 1


def test_long_line_and_no_rows(spark):
    rows = [r for r in awkward_docs() if r[0] in (205, 206)]
    copies = rows + [(i + 1000, t + "x", a, b, c) for i, t, a, b, c in rows]
    got = {r["doc_id"]: r["text"] for r in ld.dedup_lines(docs_frame(spark, copies)).collect()}
    assert got[205] == rows[0][1] and got[206] == rows[1][1] and got[1205] == "" and got[1206] == ""
    assert ld.dedup_lines(empty_docs(spark)).count() == 0


def test_main_path_is_native(spark):
    df = docs_frame(spark, _rows())
    plans = [ld.dedup_lines(df), ld.classes_of(ld.line_rows(df, "doc_id", "text"))]
    for p in plans:
        text = p._jdf.queryExecution().toString()
        assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


def test_bitmaps_rule_out_no_link(spark):
    """Pairs around the threshold, short and long, with repeated shingles: none at or above it is ruled out, far ones are."""
    from pyspark.sql import functions as F
    rng = random.Random(4)
    lines = []
    for k in range(400):
        base = (prose(rng, rng.randint(1, 90)) if k % 5 else "ab" * rng.randint(3, 200))[:rng.choice([9, 16, 40, 400, 900])]
        edits = rng.randint(0, max(1, len(base) // 60))
        other = list(base)
        for _ in range(edits):
            other[rng.randrange(len(other))] = rng.choice("xyz")
        lines += [(2 * k, base), (2 * k + 1, "".join(other))]
    found = spark.createDataFrame(lines, "rep long, line string")
    marks = ld.marks_of(found, 8)
    pairs = [(2 * k, 2 * k + 1) for k in range(400)] + [(2 * k, 2 * ((k + 7) % 400)) for k in range(400)]
    kept = {tuple(r) for r in ld.likely(spark.createDataFrame(pairs, "a long, b long"), marks, 80).collect()}
    sets = {i: {x[j:j + 8] for j in range(max(1, len(x) - 7))} for i, x in lines}
    links = {(a, b) for a, b in pairs if similar(sets[a], sets[b])}
    assert links <= kept and len(links) > 100
    far = {(a, b) for a, b in pairs if 10 * len(sets[a] & sets[b]) < 3 * len(sets[a] | sets[b])}
    assert len(far & kept) < 0.1 * len(far)
    assert marks.where(F.size("marks") != ld.MARKS).count() == 0


def test_sketches_tell_long_lines_apart(spark):
    """Long lines that share two thirds of their shingles: a bitmap of them is nearly full, an odd sketch is not."""
    rng = random.Random(11)
    lines = []
    for k in range(60):
        shared = prose(rng, 200)[:600]
        lines += [(2 * k, shared + prose(rng, 200)[:180]), (2 * k + 1, shared + prose(rng, 200)[:180])]
    sets = {i: {x[j:j + 8] for j in range(max(1, len(x) - 7))} for i, x in lines}
    marks = ld.marks_of(spark.createDataFrame(lines, "rep long, line string"), 8)
    assert {r["rep"]: r["size"] for r in marks.collect()} == {i: len(s) for i, s in sets.items()}
    pairs = [(2 * k, 2 * k + 1) for k in range(60)]
    kept = {tuple(r) for r in ld.likely(spark.createDataFrame(pairs, "a long, b long"), marks, 80).collect()}
    assert not any(similar(sets[a], sets[b]) for a, b in pairs) and len(kept) < 6


def test_pairs_between_two_components_are_not_all_compared(spark, monkeypatch):
    """One bucket with two components of many members, all near each other, and one member that is near none."""
    rng = random.Random(12)
    base = prose(rng, 200)[:400]
    lines = [(i, base[:380] + chr(97 + i % 26) + chr(97 + i // 26) + base[382:]) for i in range(60)] + [(60, prose(rng, 60))]
    found = spark.createDataFrame(lines, "rep long, line string")
    mixed = spark.createDataFrame([(band, i, i % 2) for band in (7, 8) for i, _ in lines[:60]]
                                  + [(7, 60, 60)], "band long, rep long, label long")
    compared, real = [], ld.verified

    def counted(found, pairs, *args):
        compared.append(pairs.count())
        return real(found, pairs, *args)

    monkeypatch.setattr(ld, "verified", counted)
    links = {tuple(r) for r in ld.links_apart(found, mixed, ld.marks_of(found, 8), 8, 80).collect()}
    assert links and all(a % 2 != b % 2 and 60 not in (a, b) for a, b in links)
    assert sum(compared) < 5        # all 900 pairs of different labels were compared before


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_signatures_sort_and_move_no_text(spark, monkeypatch):
    """Signing the lines takes one exchange, of signatures; the lines were sorted and sent by their hash before."""
    plans, real = [], ld.materialise
    monkeypatch.setattr(ld, "materialise", lambda df, tag: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or real(df, tag))
    rows = [(i, "the same line, here\n" + prose(random.Random(i), 30), None, None, None) for i in range(9)]
    lines = ld.line_rows(docs_frame(spark, [*rows, rows[0]], clash=False), "doc_id", "text")
    classes = {r["h1"]: r for r in ld.classes_of(lines).collect()}
    assert "SortAggregate" not in plans[0]
    shared = [r for r in classes.values() if r["n"] > 2]
    assert len(classes) == 10 and [(r["n"], r["doc"]) for r in shared] == [(10, 0)]
    assert sorted(r["n"] for r in classes.values()) == [1] * 8 + [2, 10]


def test_lines_are_encoded_and_split_once(spark):
    """A set of shingles encodes its line once, whatever its length; a text that loses lines is split once."""
    found = spark.createDataFrame([(1, "ab" * 5000 + "é😀xyz" * 40)], "rep long, line string")
    got = found.select(ld.shingles(F.col("line"), 8).alias("s"))
    line = found.first()["line"]
    assert len(got.first()["s"]) == len({line[i:i + 8] for i in range(len(line) - 7)})
    assert _plan(got).count("UTF-32") == 1 and "encode.encode(substring" not in _plan(got).lower()
    docs = docs_frame(spark, [(i, "a line that comes again\nline number %d of its own" % i, None, None, None) for i in range(3)], clash=False)
    assert _plan(ld.dedup_lines(docs)).count("split(") == 1


def test_sizes_too_far_apart_are_ruled_out(spark):
    """A set and a small part of it: the sizes alone rule the pair out, at exactly the threshold they do not."""
    df = spark.createDataFrame([(80, 100), (79, 100), (100, 80), (100, 79)], "a int, b int")
    same = [F.lit(0)] * ld.MARKS
    got = df.select(ld.may_be_near(same, F.col("a"), same, F.col("b"), 80).alias("near")).collect()
    assert [r["near"] for r in got] == [True, False, True, False]


def test_line_ends_are_walked_only_where_they_are_blank(spark):
    """Every line was trimmed at both ends twice; now only one that ends in a blank is trimmed there, with the same rows."""
    blanks = " \t\n\x0b\x0c\r"
    rng = random.Random(13)
    texts = ["\n".join("".join(rng.choices(blanks.replace("\n", "") + "aÉ\u00a0😀", k=rng.randint(0, 6))) for _ in range(40)) for _ in range(30)]
    docs = docs_frame(spark, [(i, x, None, None, None) for i, x in enumerate([*texts, "", " \r\n\t", None])], clash=False)
    lines = ld.line_rows(docs, "doc_id", "text")
    want = {(i, pos, x.strip(blanks).lower()) for i, text in enumerate(texts) for pos, x in enumerate(text.split("\n")) if x.strip(blanks)}
    got = [(r["doc"], r["pos"], r["line"]) for r in lines.collect()]
    assert set(got) == want and len(got) == len(want)
    plan = _plan(lines)
    assert not re.search(r"(?<![lr])trim\(", plan) and len(re.findall(r"\brtrim\(", plan)) == 1
