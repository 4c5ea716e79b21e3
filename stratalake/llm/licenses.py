"""Licence texts and notices, found by Dice coefficient over word bigrams.

A whole text is normalised (lower case, runs of other characters than letters
and digits, line breaks too, become one blank) and compared with full licences
and short notices: 2 * common bigrams / (bigrams of the window + bigrams of the
template), over distinct bigrams, for windows of any place and of up to the
template's length / ratio, where ratio = t / (2 - t).  A text that is a licence is
the window of all its words; a notice within a paragraph, or wrapped over lines, is
a window of some.  A window does not end right before a number, unless with the
template's last words: "version 1.1" is not cut to "version".

A window reaches t only with ratio times the template's bigrams in common, so it is
looked for only where so many places of the text, near enough, have a bigram of the
template; the best window is one that starts at such a place.  From each of them
one pass gives the best end.  For templates of more than ``LONG`` places only every
hundredth part of a template is such a start; where that comes near t without
reaching it, by no more than a start in between can add, those in between follow.

Windows of one template do not overlap; the best coefficient goes first.  Where those
of several templates overlap, the one with most bigrams in common stays, so a full
licence hides the notice it contains; ties go to the better coefficient and the
first name.

DataFrame functions only, one pass, no shuffle: the templates are literals.  NULL
and empty texts have no notice.  Rows repeat as they come; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import column

LEAST = 0.8
# Places of a template from which on its windows start in steps at first.
LONG = 400

# Names and notice texts of public licences, and full licences by file name.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("bsd-2-clause", "Released under the BSD 2-Clause License"),
    ("bsd-3-clause", "Released under the BSD 3-Clause License"),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc0-1.0", "Released into the public domain under CC0 1.0"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
FULL = tuple((f.stem, f.read_text()) for f in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")))
TEMPLATES = NOTICES + FULL


def template_bigrams(text: str) -> list[str]:
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def size_bounds(size: int, least: float) -> tuple[int, int]:
    """Bigram counts that may reach ``least`` against a template of ``size``."""
    ratio = least / (2 - least)
    return math.ceil(size * ratio - 1e-9), math.floor(size / ratio + 1e-9)


def normalised_words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")


def listed(grams: list[str]) -> str:
    """Bigrams for an SQL list, which is parsed at once; they hold only letters, digits and a blank."""
    return ", ".join(f"'{g}'" for g in grams)


def disjoint(windows: Column) -> Column:
    """Windows that overlap none kept before, in the order of their fields."""
    return F.aggregate(
        F.array_sort(windows), F.filter(windows, lambda x: F.lit(False)),
        lambda kept, x: F.when(
            F.exists(kept, lambda k: (k["start"] <= x["end"] + 1) & (x["start"] <= k["end"] + 1)), kept
        ).otherwise(F.concat(kept, F.array(x))))


class Template:
    """A template's bigrams, and what its windows can be."""

    def __init__(self, name: str, text: str, least: float):
        places = template_bigrams(text)
        self.name, self.least = name, least
        self.grams, self.last = sorted(set(places)), places[-1]
        self.size = len(self.grams)
        self.need, _ = size_bounds(self.size, least)
        self.longest = max(size_bounds(len(places), least)[1], 1)
        self.step = max(1, len(places) // 100) if len(places) > LONG else 1
        # What a start up to a step further on can lose.
        self.slack = 2 * (self.step - 1) / (self.need + self.size)

    def places(self) -> Column:
        """Places of the text that have a bigram of the template."""
        return F.expr(f"filter(hits_, i -> get(grams_, i) IN ({listed(self.grams)}))")

    def starts(self, places: str) -> Column:
        """(number, place) of places with enough others within the longest window."""
        fewest = self.need - self.step
        return F.filter(
            F.transform(places, lambda p, i: F.struct(i.alias("nr"), p.alias("at"))),
            lambda x: F.get(places, x["nr"] + fewest) - x["at"] < self.longest
            if fewest > 0 else F.lit(True))

    def coarse(self, starts: str) -> Column:
        return F.filter(starts, lambda x: x["nr"] % self.step == 0)

    def between(self, starts: str, windows: str) -> Column:
        """Starts before those whose window is just below the threshold."""
        below = F.filter(windows, lambda w: (w["minus"] > -self.least) & (
            w["minus"] <= -self.least + self.slack + 1e-9))
        return F.filter(starts, lambda x: F.exists(
            below, lambda w: (x["nr"] < w["nr"]) & (x["nr"] > w["nr"] - self.step)))

    def notices(self, windows: str) -> Column:
        """Those of the windows over the threshold that do not overlap a better one."""
        return F.transform(disjoint(F.col(windows)), lambda w: F.struct(
            w["held"].alias("held"), w["minus"].alias("minus"), F.lit(self.name).alias("name"),
            w["start"].alias("start"), w["end"].alias("end")))

    def marks(self) -> Column:
        """Each place: the one before with its bigram, if the template has it, if a window may end here."""
        return F.expr(f"""transform(grams_, (g, i) -> struct(
            get(before_, i) AS before, g IN ({listed(self.grams)}) AS common,
            g = '{self.last}' OR NOT coalesce(get(words_, i + 2) RLIKE '^[0-9]+$', false) AS end))""")

    def windows(self, starts: Column, marks: str) -> Column:
        """The best window from each start."""

        def add(s, x, at):
            new = (x["before"] < at).cast("int")
            size, held = s["size"] + new, s["held"] + F.when(x["common"], new).otherwise(0)
            dice = 2.0 * held / (size + self.size)
            better = x["end"] & (dice > s["dice"])
            return F.struct(
                size.alias("size"), held.alias("held"), (s["place"] + 1).alias("place"),
                F.when(better, dice).otherwise(s["dice"]).alias("dice"),
                F.when(better, held).otherwise(s["best"]).alias("best"),
                F.when(better, s["place"]).otherwise(s["to"]).alias("to"))

        def scan(x):
            nothing = F.struct(F.lit(0).alias("size"), F.lit(0).alias("held"), x["at"].alias("place"),
                               F.lit(0.0).alias("dice"), F.lit(0).alias("best"), x["at"].alias("to"))
            return F.aggregate(
                F.slice(marks, x["at"] + 1, self.longest), nothing, lambda s, m: add(s, m, x["at"]),
                lambda s: F.struct((-s["dice"]).alias("minus"), (-s["best"]).alias("held"),
                                   x["at"].alias("start"), s["to"].alias("end"), x["nr"].alias("nr")))

        return F.transform(starts, scan)


def scan_licenses(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST,
) -> DataFrame:
    """Per document: notices [(line of the first word, license, dice)], in order, of the whole text."""
    made = [Template(name, text, least) for name, text in templates if template_bigrams(text)]
    every = sorted({g for t in made for g in t.grams})
    size = F.size("words_")
    frame = docs.select(column(id_col).alias("doc_id"),
                        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text_"))
    frame = frame.withColumn("words_", normalised_words(F.col("text_")))
    frame = frame.withColumn("grams_", F.zip_with(
        F.slice("words_", 1, size - 1), F.slice("words_", 2, size - 1), lambda a, b: F.concat_ws(" ", a, b)))
    frame = frame.withColumn("hits_", F.expr(
        f"filter(transform(grams_, (g, i) -> IF(g IN ({listed(every)}), i, NULL)), i -> i IS NOT NULL)"))
    frame = frame.select("*", *[F.when(F.size("hits_") >= t.need - t.step + 1, t.places())
                                .alias(f"places_{k}") for k, t in enumerate(made)])
    frame = frame.select("*", *[F.when(F.size(f"places_{k}") >= t.need - t.step + 1, t.starts(f"places_{k}"))
                                .alias(f"starts_{k}") for k, t in enumerate(made)])
    there = [F.coalesce(F.size(f"starts_{k}") > 0, F.lit(False)) for k in range(len(made))]
    # Equal bigrams stand side by side once sorted, so each finds the one before.
    frame = frame.withColumn("sorted_", F.when(reduce(or_, there), F.array_sort(
        F.transform("grams_", lambda g, i: F.struct(g.alias("gram"), i.alias("at"))))))
    frame = frame.withColumn("before_", F.transform(F.array_sort(F.transform("sorted_", lambda x, i: F.struct(
        x["at"].alias("at"), F.when(
            (i > 0) & (F.get("sorted_", i - 1)["gram"] == x["gram"]), F.get("sorted_", i - 1)["at"]
        ).otherwise(-1).alias("before")))), lambda x: x["before"]))
    frame = frame.select("*", *[F.when(here, t.marks()).alias(f"marks_{k}")
                                for k, (t, here) in enumerate(zip(made, there))])
    frame = frame.select("*", *[F.when(here, t.windows(t.coarse(f"starts_{k}"), f"marks_{k}"))
                                .alias(f"windows_{k}") for k, (t, here) in enumerate(zip(made, there))])
    frame = frame.select("*", *[(F.when(here, F.concat(f"windows_{k}", t.windows(
        t.between(f"starts_{k}", f"windows_{k}"), f"marks_{k}"))) if t.step > 1 else F.col(f"windows_{k}"))
        .alias(f"all_{k}") for k, (t, here) in enumerate(zip(made, there))])
    frame = frame.select("doc_id", "text_", *[F.filter(f"all_{k}", lambda w: w["minus"] <= -least).alias(f"good_{k}")
                                              for k in range(len(made))])
    none = F.array().cast("array<struct<held:int,minus:double,name:string,start:int,end:int>>")
    chosen = [F.coalesce(F.when(F.size(f"good_{k}") > 0, t.notices(f"good_{k}")), none) for k, t in enumerate(made)]
    frame = frame.select("doc_id", "text_", F.concat(*chosen).alias("windows_"))
    frame = frame.select("doc_id", "text_", disjoint(F.col("windows_")).alias("found_"))
    counts = F.when(F.size("found_") > 0, F.transform(F.split("text_", "\n"), lambda line: F.size(
        F.filter(normalised_words(line), lambda w: w != ""))))
    frame = frame.select("doc_id", "found_", counts.alias("counts_"))

    def line_of(start):
        return F.aggregate("counts_", F.struct(F.lit(0).alias("words"), F.lit(0).alias("line")), lambda s, n: F.struct(
            (s["words"] + n).alias("words"),
            (s["line"] + (s["words"] + n <= start).cast("int")).alias("line")), lambda s: s["line"])

    ordered = F.array_sort(F.transform("found_", lambda w: F.struct(
        w["start"].alias("start"), w["name"].alias("name"), w["minus"].alias("minus"))))
    return frame.select("doc_id", F.transform(ordered, lambda w: F.struct(
        line_of(w["start"]).cast("long").alias("line"), w["name"].alias("license"),
        (-w["minus"]).alias("dice"))).alias("notices"))
