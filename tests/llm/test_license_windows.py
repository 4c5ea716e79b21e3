"""Licences wherever they stand: in a paragraph, wrapped over lines, on one line, whole."""

import random

from stratalake.llm import licenses

FULL = dict(licenses.FULL)
NOISE = "some text that goes on before"


def scan(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return {r.doc_id: [(n.line, n.license, n.dice) for n in r.notices]
            for r in licenses.scan_licenses(docs, **options).collect()}


def brute(text, templates, least=0.8):
    """Licences that some window of admissible length finds, without regard to overlaps."""
    words = licenses.re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    grams = [f"{a} {b}" for a, b in zip(words, words[1:])]
    found = set()
    for name, template in templates:
        places = licenses.template_bigrams(template)
        theirs = set(places)
        for i in range(len(grams)):
            for j in range(i, min(i + licenses.size_bounds(len(places), least)[1], len(grams))):
                if j + 2 < len(words) and words[j + 2].isdigit() and grams[j] != places[-1]:
                    continue
                mine = set(grams[i:j + 1])
                if 2 * len(mine & theirs) / (len(mine) + len(theirs)) >= least - 1e-12:
                    found.add(name)
    return found


def test_notices_in_paragraphs_and_over_lines(spark):
    bsd = dict(x for x in licenses.NOTICES if x[0] == "bsd-3-clause")["bsd-3-clause"]
    wrapped = bsd.replace("without modification", "without\nmodification").replace("provided that", "provided\n * that")
    found = scan(spark, [
        f"{NOISE}. Released under the MIT License. And text goes on, for more than a template's size, as it does.",
        f"{NOISE}\n{wrapped}\nend",
        f"a\n\nb Licensed under CC BY 4.0. {NOISE} This work is licensed under the GNU\nGeneral Public License, version 3. c",
        f"{NOISE} Licensed under the Apache License, Version 1.1 {NOISE}",
        "Released under the MIT License.\n" * 3,
    ])
    assert found == {0: [(0, "mit", 1.0)], 1: [(1, "bsd-3-clause", 1.0)],
                     2: [(2, "cc-by-4.0", 1.0), (2, "gpl-3.0", 1.0)], 3: [],
                     4: [(0, "mit", 1.0), (1, "mit", 1.0), (2, "mit", 1.0)]}


def test_full_licences(spark):
    names = sorted(FULL)
    found = scan(spark, [FULL[n] for n in names] + [" ".join(FULL[n].split()) for n in names]
                 + [f"{NOISE}\n" * 40 + FULL[n] + NOISE for n in names])
    for k in range(3):
        for i, name in enumerate(names):
            assert [x[1] for x in found[k * len(names) + i]] == [name], (k, name, found[k * len(names) + i])


def test_windows_against_brute_force(spark):
    rnd = random.Random(4)
    templates = licenses.NOTICES
    texts = []
    for _ in range(60):
        name, text = rnd.choice(templates)
        words = text.split()
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randrange(len(words))
            words[at:at + 1] = rnd.choice([[], ["other"], [words[at], "the"], ["7"]])
        texts.append(" ".join([*rnd.choices(NOISE.split(), k=rnd.randint(0, 6)), *words,
                               *rnd.choices(NOISE.split(), k=rnd.randint(0, 6))]))
    found = scan(spark, texts, templates=templates)
    for i, text in enumerate(texts):
        expected = brute(text, templates)
        assert bool(found[i]) == bool(expected) and {x[1] for x in found[i]} <= expected, text


def test_steps_lose_no_window(spark, monkeypatch):
    rnd = random.Random(6)
    template = (("long", " ".join(f"w{i}" for i in range(260))),)
    texts = []
    for k in range(30):
        words = template[0][1].split()
        for at in rnd.sample(range(260), 18 + k // 2):
            words[at] = "x"
        texts.append("a b c " + " ".join(words) + " d e")
    monkeypatch.setattr(licenses, "LONG", 10_000)
    exact = scan(spark, texts, templates=template)
    monkeypatch.setattr(licenses, "LONG", 50)
    stepped = scan(spark, texts, templates=template)
    assert {i for i in exact if exact[i]} == {i for i in stepped if stepped[i]}
    assert 0 < sum(map(bool, exact.values())) < len(texts)
