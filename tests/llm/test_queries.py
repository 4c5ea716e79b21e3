"""Registered queries and the pipeline on the smallest tables: against their SQL, or against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from stratalake.llm import linear, mixing, queries
from stratalake.llm.common import table
from tests.llm.test_search_phrases_spelling import brute_spelling
from tests.oracle import compare, connect

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return {r.doc_id: r for r in table(spark, sf_dir, "documents").collect()}


def run(spark, sf_dir, prefix):
    name, = [n for n in queries.QUERIES if n.startswith(prefix + "_")]
    return queries.QUERIES[name](spark, sf_dir).collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    _, problem = compare(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name])
    assert problem is None


def test_quality_rules(spark, sf_dir, documents):
    found = run(spark, sf_dir, "op2")
    assert {r.doc_id for r in found} == set(documents)
    for r in found:
        text = documents[r.doc_id].text or ""
        words = WORD.findall(text)
        seen, repeated = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                repeated += line in seen
                seen.add(line)
        windows = Counter(zip(words, words[1:], words[2:]))
        often = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(often))
        assert r.base_failed == (len(words) < 50 or 100 * len(often) > 50 * len(words))
        assert not (r.base_failed and r.kept)


@pytest.mark.parametrize("prefix, folds, rest", [("op4", 4, 2), ("op9", 5, 0)])
def test_folds_and_verdicts(spark, sf_dir, documents, prefix, folds, rest):
    found = run(spark, sf_dir, prefix)
    assert {r.doc_id for r in found} == set(documents)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == rest)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_sharding(spark, sf_dir, documents):
    found = run(spark, sf_dir, "op6")
    assert Counter(r.doc_id for r in found) == Counter(list(documents))
    slots = defaultdict(list)
    for r in found:
        text = (documents[r.doc_id].text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text) + 16, zlib.crc32(text), "rows", None)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(40)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_mixing(spark, sf_dir, documents):
    found = run(spark, sf_dir, "op10")
    taken, target = Counter(), {}
    for r in found:
        row = documents[r.doc_id]
        assert r["size"] == len(WORD.findall(row.text or "")) and 0 <= r.taken <= 2 * r["size"]
        assert (r.first_slot is None) == (r.taken == 0)
        taken[row.source] += r.taken
        target[row.source] = r.target
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())


def test_slots_decide_what_is_taken(spark):
    # A mix of eight slots: a source below an eighth of it gets none, others what falls to them.
    rows = [(i, "w " * 100, "a") for i in range(9)] + [(100, "w " * 3, "b")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string")
    found = mixing.mix_report(docs, block=1 << 20, slots=6).collect()
    assert {r.taken for r in found if r.source == "b"} == {0}
    a = sum(r.taken for r in found if r.source == "a")
    assert abs(a - next(r.target for r in found if r.source == "a")) <= 1
    assert sorted(r.first_slot for r in found if r.taken)[0] == 0
    slots = mixing.schedule(spark.createDataFrame(
        [(0, 700, 1000, 0, 700), (1, 300, 1000, 700, 1000)], "rank int, words long, all_words long, low long, high long"), 5).collect()
    assert Counter(r["rank"] for r in slots) == {0: 23, 1: 9}
    # In every run of eight slots the second source has two or three.
    order = [r["rank"] for r in sorted(slots, key=lambda r: r.slot)]
    assert {sum(order[i:i + 8]) for i in range(0, 32, 8)} <= {2, 3}
    assert all(sorted(r.turn for r in slots if r["rank"] == s) == list(range(n)) for s, n in ((0, 23), (1, 9)))


def test_licences(spark, sf_dir, documents):
    found = {r.doc_id: r for r in run(spark, sf_dir, "op5")}
    assert set(found) == set(documents)
    for name, row in documents.items():
        if re.search(r"Released under the MIT License(?! [0-9])", row.text or ""):
            assert "mit" in found[name].licenses.split(",") and found[name].best_dice == 1.0
        assert (found[name].n_notices > 0) == (found[name].best_dice >= 0.8)


def test_spelling_variants(spark, sf_dir, documents):
    found = queries.op13_spelling_variants(spark, sf_dir).select("word", "n", "n_near", "form", "form_n", "root")
    assert Counter(tuple(r) for r in found.collect()) == brute_spelling([(r.doc_id, r.text) for r in documents.values()])


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    width = min(5, len(words))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if width else set()


def first_of_groups(rows):
    sets = {r.doc_id: shingles(r.text) for r in rows}
    root = {d: d for d in sets}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {d for d in ids if top(d) == d}


def contaminated(rows, items):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))

    windows = set()
    for r in items:
        found = words(r.text)
        size = min(10, len(found))
        windows |= {tuple(found[i:i + size]) for i in range(len(found) - size + 1)} if size else set()
    sizes = {len(w) for w in windows}
    out = set()
    for r in rows:
        found = words(r.text)
        if any(tuple(found[i:i + n]) in windows for n in sizes for i in range(len(found) - n + 1)):
            out.add(r.doc_id)
    return out


def test_pipeline_stage_by_stage(spark, sf_dir, documents):
    docs, kept = table(spark, sf_dir, "documents"), list(documents.values())
    stage = dict(corpus_pipeline.STAGES)
    names = docs.columns
    assert list(stage) == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]

    model = linear.fit(docs, table(spark, sf_dir, "labels"))
    kept = [r for r in kept if linear.probability((r.text or "").encode(), model) < 0.3]
    docs = stage["toxicity"](spark, docs, sf_dir)
    assert docs.columns == names and {r.doc_id for r in docs.collect()} == {r.doc_id for r in kept}
    assert len(kept) < len(documents)

    docs = corpus_pipeline.staged(docs, "t")
    first = first_of_groups(kept)
    kept = [r for r in kept if r.doc_id in first]
    docs = corpus_pipeline.staged(stage["near_dedup"](spark, docs, sf_dir), "t")
    assert docs.columns == names and Counter(docs.collect()) == Counter(kept)

    hit = contaminated(kept, table(spark, sf_dir, "benchmark").collect())
    kept = [r for r in kept if r.doc_id not in hit]
    docs = corpus_pipeline.staged(stage["decontamination"](spark, docs, sf_dir), "t")
    assert docs.columns == names and Counter(docs.collect()) == Counter(kept)

    report = {r.doc_id: r for r in mixing.mix_report(docs).collect()}
    docs = corpus_pipeline.staged(stage["mixing"](spark, docs, sf_dir), "t")
    times = Counter(docs.collect())
    assert docs.columns == names and set(times) <= set(kept)
    for r in kept:
        size = report[r.doc_id]["size"]
        assert times[r] == (int(report[r.doc_id].taken / size + 0.5) if size else 0)

    placed = stage["sharding"](spark, docs, sf_dir).collect()
    assert Counter(r.doc_id for r in placed) == Counter(r.doc_id for r in docs.collect())
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.shard, r.slot) for r in whole) == Counter((r.doc_id, r.shard, r.slot) for r in placed)
    slots = defaultdict(list)
    for r in whole:
        slots[r.shard].append(r.slot)
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_map_columns_are_carried(spark):
    from stratalake.llm import near_duplicates, shard
    rows = [(i, f"some text of the number {i % 3} and more words", "a", {"k": i % 2}) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string, tags map<string,int>")
    placed = shard.shuffle_into_shards(docs, 3)
    assert Counter(r.doc_id for r in placed.collect()) == Counter(range(20))
    assert len(near_duplicates.drop_near_duplicates(docs).collect()) == 3
    assert set(mixing.mix(docs).columns) == set(docs.columns) and mixing.mix(docs).count() > 0
