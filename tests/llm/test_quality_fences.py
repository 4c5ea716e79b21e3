"""Fences of zero-heavy statistics follow the group and let no junk through."""

import random

from stratalake.llm import quality_rules

SCHEMA = "doc_id int, text string, lang string, source string"


def text(rnd, repeated=0, lines=0, symbols=0):
    words = [f"w{rnd.randrange(10 ** 9)}" for _ in range(200 - 6 * repeated)]
    words += [w for i in range(repeated) for w in [f"a{i}", f"b{i}", f"c{i}"] * 2]
    words = [w + "#" if i < symbols else w for i, w in enumerate(words)]
    return "\n".join([" ".join(words)] + [f"line {i} of {rnd.random()}" for i in range(20 - lines)] + ["same line"] * lines)


def test_few_symbols_are_junk_where_others_have_none(spark):
    rnd = random.Random(1)
    rows = [(i, text(rnd), "en", "a") for i in range(200)] + [(999, text(rnd, symbols=80), "en", "a")]
    judged = quality_rules.judge(spark.createDataFrame(rows, SCHEMA))
    # 80 symbols in 288 words: below 400 thousandths.
    assert [r.doc_id for r in judged.where("not kept").collect()] == [999]


def test_fences_differ_by_group(spark):
    rnd = random.Random(2)
    rows = [(i, text(rnd, repeated=i % 9 * (s == "b"), lines=i % 7 * (s == "b")), "en", s)
            for i in range(200) for s in "ab"]
    stray = text(rnd, repeated=8, lines=6)
    rows += [(998, stray, "en", "a"), (999, stray, "en", "b")]
    judged = quality_rules.judge(spark.createDataFrame(rows, SCHEMA))
    assert [r.doc_id for r in judged.where("not kept").collect()] == [998]
    limits = {r.source: r for r in quality_rules.fences(judged).collect()}
    assert limits["a"].high_repeats < limits["b"].high_repeats
    assert limits["a"].high_dup_lines < limits["b"].high_dup_lines
