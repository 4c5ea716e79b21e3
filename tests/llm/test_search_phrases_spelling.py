"""Exact search, collocations and spelling variants against brute force, awkward rows included."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from stratalake.llm import collocations, exact_search, spelling
from pyspark.sql import functions as F


# Exact search

VECTORS = "vec_id bigint, embedding array<float>, row string, score array<int>, cell map<string,int>"


def vectors():
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(12)]) for i in range(300)]
    centre = rows[7][1]
    rows += [(300 + i, [x + rnd.gauss(0, 0.01) for x in centre]) for i in range(200)]
    rows += [(500 + i, list(centre)) for i in range(120)]            # ties
    rows += [(100, list(rows[100][1])), (42, list(rows[42][1]))]      # repeated rows
    rows += [(700, None), (800, [1.0, None]), (900, [float("nan")] * 12), (1000, [float("inf")])]
    rows += [(1100, []), (1200, [0.5, -2.0]), (1300, [0.0] * 12), (None, list(centre)), (1400, [1.0] * 40)]
    rows += [(1500, [3e38, -1e30]), (1501, [-3e38, 2.0]), (1502, [5e11, 1.0])]
    return rows


def brute_search(rows, k):
    import numpy as np
    parts = []
    for name, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            parts.append((name, [math.floor(1024 * float(np.float32(x))) for x in v]))
    out = []
    for at, (name, q) in enumerate(parts):
        if name is None or name % 100:
            continue
        scored = []
        for other, (c_name, c) in enumerate(parts):
            if other != at:
                total = max(-2 ** 63, min(2 ** 63 - 1, sum(x * y for x, y in zip(q, c))))
                scored.append((-total, c_name is None, c_name, -total))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(name, rank, s[2], -s[0]) for rank, s in enumerate(scored[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("block, asked", [(8192, 4096), (40, 3)])
def test_search_equals_brute_force(spark, monkeypatch, block, asked):
    monkeypatch.setattr(exact_search, "BLOCK", block)
    monkeypatch.setattr(exact_search, "QUERIES", asked)
    rows = vectors()
    df = spark.createDataFrame([(*r, "x", None, None) for r in rows], VECTORS)
    found = exact_search.nearest_by_product(df, F.col("vec_id") % 100 == 0, 10)
    got = Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())
    assert got == brute_search(rows, 10)


def test_search_of_few_or_none(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert exact_search.nearest_by_product(empty, F.col("vec_id") % 100 == 0, 10).collect() == []
    one = spark.createDataFrame([(100, [1.0], "", None, None)], VECTORS)
    assert exact_search.nearest_by_product(one, F.col("vec_id") % 100 == 0, 10).collect() == []
    two = spark.createDataFrame([(100, [1.0], "", None, None), (1, [0.5], "", None, None)], VECTORS)
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in exact_search.nearest_by_product(
        two, F.col("vec_id") % 100 == 0, 10).collect()] == [(100, 1, 1, 1024 * 512)]


def test_bounds_leave_candidates_out():
    import numpy as np
    import pyarrow as pa
    rnd = np.random.default_rng(1)
    parts = np.floor(np.concatenate([rnd.normal(0, 1, (500, 8)), rnd.normal(9, 1, (500, 8))]) * 1024)
    pivots = parts[[0, 900]]
    far = exact_search.distances(parts, pivots).astype(np.float32)
    block = exact_search.Block(pa.table({
        "row": np.arange(1000), "vec_id": np.arange(1000), "parts": list(parts), "norm": (parts ** 2).sum(axis=1), "far": list(far)}))
    bounds = block.bounds(float((parts[3] ** 2).sum()), far[3])
    exact = parts @ parts[3]
    assert (bounds >= exact).all()
    tenth = np.sort(exact)[-11]
    assert (bounds < tenth).sum() > 100


# Collocations

DOCS = "doc_id bigint, text string, lang string, phrase int, n string, words map<string,int>"


def documents():
    rnd = random.Random(8)
    names = ["".join(rnd.choice("abcdeü") for _ in range(rnd.randint(1, 4))) for _ in range(30)]
    rows = []
    for i in range(60):
        words = [rnd.choice(names[:6]) if rnd.random() < 0.5 else rnd.choice(names) for _ in range(rnd.randint(0, 120))]
        text = "".join(w + rnd.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b", "-", " "]) for w in words)
        rows.append((i, text, rnd.choice(["en", "en", "de", "", None])))
    rows += [(100, "New York Stock Exchange opens. " * 40, "en"), (101, "new YORK city\n" * 50, "en")]
    rows += [(102, "a a a a a a a a " * 20, "de"), (103, None, "en"), (104, "", None), (105, " \t. , ", "de")]
    rows += [(106, "one two three four " * 5000, "xx"), (106, "one two three four " * 5000, "xx"), (None, "solo", "yy")]
    return rows


def brute_collocations(rows, least, top):
    totals, counts = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                for at in range(len(words) - k + 1):
                    counts[lang, tuple(words[at:at + k])] += 1
    out = defaultdict(list)
    candidates = {p: f for p, f in counts.items() if len(p[1]) > 1 and f >= least}
    for (lang, phrase), a in candidates.items():
        cuts = [(2_000_000 * a // (counts[lang, phrase[:k]] + counts[lang, phrase[k:]]), k) for k in range(1, len(phrase))]
        score, k = min(cuts)
        within = [f for (other, longer), f in candidates.items() if other == lang and len(longer) > len(phrase) and any(
            longer[i:i + len(phrase)] == phrase for i in range(len(longer)))]
        if not any(100 * f >= 80 * a for f in within):
            out[lang].append((-score, -a, " ".join(phrase).encode(), counts[lang, phrase[:k]], counts[lang, phrase[k:]]))
    return Counter((lang, rank, p.decode(), -a, l, r, totals[lang], -s)
                   for lang, found in out.items() for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1))


@pytest.mark.parametrize("block, least, top", [(8 << 20, 30, 2000), (300, 5, 7), (64, 300, 50)])
def test_collocations_equal_brute_force(spark, monkeypatch, block, least, top):
    monkeypatch.setattr(collocations, "BLOCK", block)
    rows = documents()
    df = spark.createDataFrame([(*r, 1, "x", None) for r in rows], DOCS)
    found = collocations.collocations(df, least=least, top=top)
    got = Counter((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found.collect())
    assert got == brute_collocations(rows, least, top)


def test_products_beyond_64_bits(spark):
    counts = spark.createDataFrame([("en", 0, "", 9 * 10 ** 18), ("en", 1, "x", 9 * 10 ** 17), ("en", 1, "y", 8 * 10 ** 17),
                                    ("en", 2, "x y", 7 * 10 ** 17)], "lang string, k int, phrase string, f bigint")
    original = collocations.phrase_counts
    try:
        collocations.phrase_counts = lambda *a, **b: counts
        row, = collocations.collocations(counts).collect()
    finally:
        collocations.phrase_counts = original
    assert (row.a, row.l, row.r, row.score) == (7 * 10 ** 17, 9 * 10 ** 17, 8 * 10 ** 17, 2_000_000 * 7 * 10 ** 17 // (17 * 10 ** 17))


def test_packed_hashes_come_back():
    import numpy as np
    values = np.array([0, 1, 7, 1 << 30, (1 << 39) + 5], np.uint64)
    counts = np.array([1, 30, 2, 9, 255], np.uint8)
    back, again = collocations.unpack(collocations.pack(values, counts))
    assert (back == values).all() and (again == counts).all()


def test_no_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    assert collocations.collocations(empty).collect() == []
    assert spelling.spelling_variants(empty).collect() == []


# Spelling variants


def texts():
    rnd = random.Random(11)
    stems = ["".join(rnd.choice("abcdeß") for _ in range(rnd.randint(5, 9))) for _ in range(40)] + ["Àbcdefÿ", "prefixes" * 40]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rnd.randint(0, 200)):
            w = rnd.choice(stems[:8]) if rnd.random() < 0.7 else rnd.choice(stems)
            if rnd.random() < 0.15:
                at = rnd.randrange(len(w))
                w = w[:at] + rnd.choice(["", "x", "q" + w[at], "ê"]) + w[at + 1:]
            words.append(w.upper() if rnd.random() < 0.1 and w.isascii() else w)
        rows.append((i, "".join(w + rnd.choice([" ", "1", "_", "’", "-", "\n"]) for w in words)))
    rows += [(7, rows[7][1]), (None, rows[3][1]), (900, None), (901, ""), (902, "12 34"), (903, "longword" * 4000 + " ")] * 2
    rows += [(920, "chainword " * 125 + "chainwort " * 25 + "chainwart " * 5)]
    rows += [(904 + i, "×÷ abcdef abcdeg abcdeg " + "abcdeg " * i) for i in range(9)]
    return rows


def brute_spelling(rows):
    counts = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    known = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        at = next((i for i, c in enumerate(short) if c != long[i]), len(short))
        return short[at:] == long[at + 1:]

    nears = {w: [x for x in known if near(w, x)] for w in known}
    forms = {}
    for w, found in nears.items():
        best = min(found, key=lambda x: (-known[x], x), default=None)
        if best is not None and known[best] >= 5 * known[w]:
            forms[w] = best

    def root(w):
        return root(forms[w]) if w in forms else w

    return Counter((w, n, len(nears[w]), forms.get(w), known.get(forms.get(w)), root(w)) for w, n in known.items())


@pytest.mark.parametrize("shard", [8192, 6])
def test_spelling_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(spelling, "SHARD", shard)
    monkeypatch.setattr(spelling, "HELD", 25)
    rows = texts()
    df = spark.createDataFrame([(*r, "x", None) for r in rows], "doc_id bigint, text string, word string, n map<string,int>")
    got = Counter((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.spelling_variants(df).collect())
    want = brute_spelling(rows)
    assert got == want
    assert any(form for _, _, _, form, _, _ in want) and any(form and form != root for _, _, _, form, _, root in want)


def test_index_finds_every_edit():
    rnd = random.Random(2)
    words = sorted({"".join(rnd.choice("abç") for _ in range(rnd.randint(6, 8))) for _ in range(150)})
    shard = spelling.Shard(words)
    known = set(words)
    for length in (6, 7, 8):
        asked = [w for w in words if len(w) == length]
        found = {(asked[i], words[j]) for front in (True, False) for i, j in shard.one_edit(asked, front)}
        want = set()
        for w in asked:
            edits = {w[:i] + w[i + 1:] for i in range(length)}
            edits |= {w[:i] + c + w[i + 1:] for i in range(length) for c in "abç"}
            edits |= {w[:i] + c + w[i:] for i in range(length + 1) for c in "abç"}
            want |= {(w, e) for e in edits & known if e != w}
        assert found == want


