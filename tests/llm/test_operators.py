"""Operators against brute force, on documents with the awkward cases."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from stratalake.llm import (
    decontaminate, discriminant, licenses, linear, mixing, near_duplicates, quality_rules, shard,
    substrings, warc,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, hits int, score string, shard int, row string, n_words int"
BENCH = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "Short one"), (3, None), (4, "")]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sample():
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(400)]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(n)) for n in (3, 5, 40, 80, 120, 300, 60, 70, 90, 100)]
    passage = " ".join(rnd.choice(vocabulary) for _ in range(70))
    base = texts[5].split()
    for _ in range(6):  # near copies
        copy = list(base)
        for i in rnd.sample(range(len(copy)), 4):
            copy[i] = rnd.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [texts[4], texts[4], texts[3] + "\n" + passage, passage + " " + texts[2], "Intro " + passage]
    texts += [None, "", "  \n\t ", "a" * 900, "ab " * 500, "Ünï çödé " * 60, "one two", "ONE\ttwo"]
    texts += ["x " + BENCH[0][1].upper().replace(" ", ", ") + ". y", "this short, one!", "line one here\n" * 9]
    texts += [" ".join(rnd.choice(vocabulary) for _ in range(30_000))]
    rows = [(i, t, "en" if i % 3 else None, ["s1", "s2", None][i % 3] if i % 7 else "s1", 1, "x", 2, "r", 3)
            for i, t in enumerate(texts)]
    return rows + [rows[7], rows[7], rows[20], (None, texts[6], "en", "s1", 1, "x", 2, "r", 3)]


ROWS = sample()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(i, int(i % 2 == 0), int(i % 5 == 0)) for i in range(len(ROWS) - 4)] + [(None, 1, 1), (3, None, None), (4, 0, 1)],
        "doc_id bigint, quality int, toxic int")


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_repeats(docs, empty):
    texts = [(r[0], (r[1] or "").encode()) for r in ROWS]
    seen = Counter(t[i:i + 200] for _, t in texts for i in range(len(t) - 199))
    expected = Counter()
    for doc_id, t in texts:
        hit = bytearray(len(t))
        for i in range(len(t) - 199):
            if seen[t[i:i + 200]] > 1:
                hit[i:i + 200] = b"\1" * 200
        kept = bytes(b for b, x in zip(t, hit) if not x)
        expected[doc_id, len(t), sum(hit), len(re.findall(rb"\x01+", hit)), hashlib.sha256(kept).hexdigest(), kept] += 1
    found = substrings.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, sum(e - s for s, e in zip(r.starts, r.ends)), len(r.starts), r.kept_sha256,
                    bytes(r.text)) for r in found) == expected
    assert substrings.remove_repeats(empty).count() == 0


def test_quality_statistics(docs, empty):
    expected = Counter()
    for doc_id, text, *_ in ROWS:
        t = text or ""
        words = WORD.findall(t)
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        expected[doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)),
                 len(lines) - len(set(lines)), len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words)] += 1
    found = quality_rules.judge(docs)
    assert bag(found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                            "base_failed")) == expected
    assert found.where("base_failed and kept").count() == 0 and found.where("kept").count() > 10
    assert quality_rules.judge(empty).count() == 0


def test_fences_follow_their_group(spark):
    rows = [(i, " ".join(["word"] * 3 + [f"w{j}{'#' * (s == 'b')}" for j in range(80)]), "en", s)
            for i in range(120) for s in "ab"] + [(999, " ".join(f"w{j}#" for j in range(80)), "en", "a")]
    kept = quality_rules.judge(spark.createDataFrame(rows, "doc_id int, text string, lang string, source string"))
    assert kept.where("not kept").select("doc_id").collect() == [(999,)]


def brute_hits(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    hit, items = set(), set()
    for item, other in BENCH:
        theirs = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(other or ""))
        size = min(10, len(theirs))
        for a in range(len(theirs) - size + 1 if size else 0):
            for b in range(len(words) - size + 1):
                if words[b:b + size] == theirs[a:a + size]:
                    hit |= set(range(b, b + size))
                    items.add(str(item))
    return len(words), len(hit), tuple(sorted(items))


@pytest.mark.parametrize("most", [200_000, 2])
def test_decontamination(spark, docs, empty, most):
    benchmark = spark.createDataFrame(BENCH, "item_id int, text string")
    found = decontaminate.find_contamination(docs, benchmark, "found", max_patterns=most)
    assert Counter((r.doc_id, r.found.n_words, r.found.n_hit, tuple(r.found["items"])) for r in found.collect()) == \
        Counter((r[0], *brute_hits(r[1])) for r in ROWS)
    kept = decontaminate.drop_contaminated(docs, benchmark, max_patterns=most)
    assert kept.columns == docs.columns
    assert bag(kept) == Counter(r for r in ROWS if not brute_hits(r[1])[1])
    assert decontaminate.drop_contaminated(empty, benchmark).count() == 0
    assert decontaminate.drop_contaminated(docs, benchmark.limit(0)).count() == len(ROWS)


def test_toxicity(spark, docs, empty, labels):
    model = linear.fit(docs, labels)
    scored = linear.score(docs, model, "p").collect()
    assert len(scored) == len(ROWS) and all(0 <= r.p <= 1 for r in scored)
    kept = linear.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert linear.drop_toxic(empty, labels).count() == 0
    assert linear.drop_toxic(docs, labels.limit(0)).count() == len(ROWS)


def test_toxicity_is_learnt(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice("lorem ipsum dolor sit amet elit".split()) for _ in range(rnd.randint(20, 400)))
             + (" vile scum" if i % 6 == 0 else "")) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id int, text string")
    known = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(300)], "doc_id int, toxic int")
    scored = linear.score(table, linear.fit(table, known)).collect()
    held = [r for r in scored if r.doc_id >= 300]
    assert sum((r.score >= 0.3) == (r.doc_id % 6 == 0) for r in held) >= 0.97 * len(held)


def test_ngrams_cross_pieces(monkeypatch):
    text = bytes(random.Random(2).randrange(32, 127) for _ in range(30_000))
    whole = linear.ngram_ids(text)
    monkeypatch.setattr(linear, "PIECE", 777)
    assert (linear.ngram_ids(text) == whole).all()


def test_licenses(spark, empty):
    rows = [(1, "intro\nReleased under the  MIT license!\nend"), (2, None), (3, ""),
            (4, "Licensed under CC BY-NC 4.0."), (5, "released under the moon"), (6, "one word\n" * 3)]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id int, text string"))
    assert {r.doc_id: [(n.line, n.license, n.dice) for n in r.notices] for r in found.collect()} == {
        1: [(1, "mit", 1.0)], 2: [], 3: [], 4: [(0, "cc-by-nc-4.0", 1.0)], 5: [], 6: []}
    assert licenses.scan_licenses(empty).count() == 0


def check_shards(placed, shards, rows):
    slots = defaultdict(list)
    for r in placed:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[i]) for i in range(shards)]
    assert sum(sizes) == rows and max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards(spark, docs, empty):
    placed = shard.shuffle_into_shards(docs, 4)
    check_shards(placed.collect(), 4, len(ROWS))
    assert bag(placed) == bag(shard.shuffle_into_shards(docs.repartition(5), 4))
    names = [c for c in docs.columns if c != "shard"]
    assert bag(placed.select(*names)) == bag(docs.select(*names))
    assert shard.shuffle_into_shards(empty, 4).count() == 0
    copies = spark.range(9000).selectExpr("1L AS doc_id", "'same' AS text").unionByName(
        spark.range(2000).selectExpr("id AS doc_id", "'other' AS text"))
    check_shards(shard.shuffle_into_shards(copies, 7).collect(), 7, 11_000)


def test_fisher_yates_is_a_permutation():
    assert sorted(shard.fisher_yates(50, 3).tolist()) == list(range(50))
    assert shard.fisher_yates(50, 3).tolist() != list(range(50)) and not len(shard.fisher_yates(0, 1))


def test_warc(spark, tmp_path):
    rnd = random.Random(3)
    big = "".join(rnd.choice("abc <é>") for _ in range(700_000))
    rows = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2\r\nX: y", "<p>x</p>"), (3, None, None), (4, "u", ""),
            (5, "u", big), (6, "u", "WARC/1.1\r\n\r\n\r\n"), (None, "u", "<p>x</p>"), (None, "u", "alone"), (2, "again", "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)
    folder = f"file://{tmp_path}/warc"
    manifest = warc.write_archives(pages, folder, archive_bytes=2000)
    manifest.write.parquet(f"file://{tmp_path}/manifest")
    manifest = spark.read.parquet(f"file://{tmp_path}/manifest")
    records = warc.read_archives(spark, manifest, folder).select(
        warc.page_number("record_id").alias("page_id"), warc.page_number("refers_to_id").alias("refers_to"), "*").collect()
    best = {}
    for page_id, _, html in rows:
        best[html or ""] = max(best.get(html or "", -1), -1 if page_id is None else page_id)
    expected = Counter()
    for page_id, _, html in rows:
        body, top = (html or "").encode(), best[html or ""]
        revisit = top >= 0 and top != page_id
        expected[page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                 "revisit" if revisit else "response", top if revisit else None, None if revisit else body, None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                    None if r.payload is None else bytes(r.payload), r.problem) for r in records) == expected
    none = warc.write_archives(pages.limit(0), folder)
    assert none.count() == 0


def test_warc_finds_damage():
    member = warc.record_bytes(1, "u", b"payload")
    headers, block = warc.read_record(iter([zlib.decompress(member, 31)]))
    assert warc.parse_record(headers, block)["problem"] is None
    assert warc.parse_record(headers, block.replace(b"pay", b"PAY"))["problem"] == "block digest"


def test_near_duplicates(docs, empty):
    sets = []
    for _, text, *_ in ROWS:
        words = WORD.findall(lower(text or ""))
        size = min(5, len(words))
        sets.append({tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if size else set())
    parent = list(range(len(ROWS)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(ROWS)):
        groups[root(i)].append(ROWS[i][0])
    expected = Counter()
    for i, row in enumerate(ROWS):
        ids = [x for x in groups[root(i)] if x is not None]
        expected[row[0], len(sets[i]), min(ids) if ids and sets[i] else row[0]] += 1
    found = near_duplicates.find_near_duplicates(docs)
    assert bag(found.select("doc_id", "n_shingles", "component_id")) == expected
    kept = near_duplicates.drop_near_duplicates(docs)
    blank = [r for r, s in zip(ROWS, sets) if not s]
    linked = len({root(i) for i, s in enumerate(sets) if s})
    assert kept.columns == docs.columns and kept.count() == linked + len(blank)
    assert near_duplicates.drop_near_duplicates(empty).count() == 0


def test_loose_groups_are_bounded_not_lost(spark):
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(140):
        copy = list(base)
        for j in rnd.sample(range(150), rnd.choice([1, 2, 3, 4, 5, 6, 8])):
            copy[j] = f"e{rnd.randrange(40)}"
        rows.append((i, " ".join(copy)))
    sets = [near_duplicates.shingles(t.encode()) for _, t in rows]
    parent = list(range(140))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(set(a.tolist()) & set(sets[j].tolist()))
            if 100 * common >= 75 * (len(a) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    least = {}
    for i in range(140):
        least.setdefault(root(i), i)
    found = near_duplicates.find_near_duplicates(spark.createDataFrame(rows, "doc_id int, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: least[root(i)] for i in range(140)}


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = "some words, ÜBER and More ".encode() * 200
    whole = near_duplicates.word_hashes(text)
    monkeypatch.setattr(near_duplicates, "PIECE", 37)
    assert (near_duplicates.word_hashes(text) == whole).all() and len(whole) == 1000


def test_quality_classifier(docs, empty, labels):
    scored = discriminant.score_quality(docs, labels).collect()
    assert len(scored) == len(ROWS) and all(0 <= r.score <= 1 for r in scored)
    assert discriminant.score_quality(empty, labels).count() == 0
    assert {r.score for r in discriminant.score_quality(docs, labels.limit(0)).collect()} == {0.0}


def test_mixing(docs, empty):
    found = mixing.mix_report(docs, block=16).collect()
    assert len(found) == len(ROWS)
    totals, taken = Counter(), Counter()
    for r in ROWS:
        totals[r[3]] += len(WORD.findall(r[1] or ""))
    for r in found:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r["size"] and r.source_size == totals[r.source]
    targets = {r.source: r.target for r in found}
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full = set()
    while True:
        left = 1.5 * sum(totals.values()) - sum(2 * totals[s] for s in full)
        share = sum(weights[s] for s in order if s not in full)
        more = {s for s in order if s not in full and left * weights[s] / share > 2 * totals[s]}
        if not more:
            break
        full |= more
    for s in order:
        assert targets[s] == pytest.approx(2 * totals[s] if s in full else left * weights[s] / share)
        assert abs(taken[s] - targets[s]) <= 1
    again = mixing.mix_report(docs.repartition(7), block=16).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and set(bag(mixed)) <= set(ROWS)
    assert mixing.mix_report(empty).count() == 0 and mixing.mix(empty).count() == 0
