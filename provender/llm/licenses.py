"""Licence scans by a positional index of rare licence words.

How rare a licence word is comes from its document frequency over all documents.
Each template is indexed by its rarest words with their places. A file looks up its
own licence words; every posting says where the template would begin, and words of
one template that agree on that place add up. A candidate counts when the rare
words that agree carry enough weight and the template's mandatory key phrases stand
at their exact places. Fixed phrases are found through their rarest word likewise.

Everything about a file happens in its own row: nothing but word counts is shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provender.llm.walks import bound, over_runs, run_ends

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a text whose letters A-Z were made small.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that give a label wherever they stand.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Template:
    """Licence wording; every key phrase must stand where the template has it."""

    label: str
    text: str
    keys: tuple[str, ...]


#: Public licence notices.
TEMPLATES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
             "and associated documentation files (the \"Software\"), to deal in the Software without restriction",
             ("permission is hereby granted free of charge", "without restriction")),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("apache", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
             "GNU General Public License as published by the Free Software Foundation",
             ("gnu general public license",)),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3",
             ("gnu general public license version 3",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met",
             ("redistribution and use in source and binary forms", "following conditions are met")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
             "fee is hereby granted", ("permission to use copy modify", "with or without fee")),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
             ("mozilla public license v 2 0",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    Template("cc-by", "Licensed under a Creative Commons Attribution 4.0 International License",
             ("creative commons attribution 4 0 international",)),
)


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def text_words(text: Column) -> Column:
    """The words of a whole text; none for a null one."""
    small = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(small, F.lit(WORD), F.lit(0))


def rarity(docs: DataFrame, vocabulary: Sequence[str]) -> dict[str, float]:
    """Inverse document frequency of licence words over all documents.

    The driver gets one row per word of the templates.
    """
    words = F.array(*[F.lit(w) for w in sorted(vocabulary)])
    held = docs.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(text_words(F.col("text")), words)))
                       .alias("word"))
    counts = {r["word"]: r["count"] for r in held.groupBy("word").count().collect()}
    total = counts.get("", 0)  # every document has the empty word
    return {w: math.log((1 + total) / (1 + counts.get(w, 0))) + 1 for w in vocabulary}


def scan_licenses(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Sequence[Template] = TEMPLATES,
                  rare: int = 8, least: float = 0.6) -> DataFrame:
    """Every document with its licence places and labels.

    Adds ``n_words``, ``places`` (of fixed phrases: ``label``, ``start``),
    ``matches`` (of templates: ``label``, ``start``, ``score``), ``base_labels``,
    ``labels`` and ``score``. The score is 1 where a fixed phrase stands, else the
    best template's share of rare-word weight, else 0. Input columns of these names
    are replaced, others kept.

    A null or empty text has no words and no labels. Repeated rows are scanned each
    by itself; an empty table gives no rows. Of templates with one label the best
    place each is kept.
    """
    added = ("n_words", "places", "matches", "base_labels", "labels", "score")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    split = [words_of(t.text) for t in templates]
    phrase_words = {p: words_of(p) for p in phrases}
    vocabulary = sorted({w for ws in [*split, *phrase_words.values()] for w in ws})
    weight = rarity(docs, vocabulary)
    rarest = [sorted(set(ws), key=lambda w: (-weight[w], w))[:rare] for ws in split]
    mass = [sum(weight[w] for w in ws) for ws in rarest]
    anchors = {p: max(range(len(ws)), key=lambda i: (weight[ws[i]], -i)) for p, ws in phrase_words.items()}

    postings: dict[str, list[tuple[int, int]]] = {}
    for t, (ws, index) in enumerate(zip(split, rarest, strict=True)):
        for place, w in enumerate(ws):
            if w in index:
                postings.setdefault(w, []).append((t, place))
    looked_up = sorted({*postings, *(phrase_words[p][at] for p, at in anchors.items())})

    rows = docs.select(F.struct(*kept).alias("_doc"), text_words(F.col("text")).alias("_words"))
    rows = rows.withColumn("_held", F.filter(
        F.transform("_words", lambda w, i: F.when(w.isin(looked_up), F.struct(w.alias("word"), i.alias("at")))),
        lambda h: h.isNotNull()))
    rows = rows.withColumn("places", _places(phrase_words, anchors, phrases))
    rows = rows.withColumn("_agreed", F.when(F.size("_held") > 0, _agreed(postings, weight)).otherwise(_none(AGREED)))
    rows = rows.withColumn("matches", _verified(templates, split, mass, least))
    label_list = lambda found: F.array_join(F.array_sort(F.array_distinct(found)), ",")
    base, more = F.col("places")["label"], F.col("matches")["label"]
    best = F.coalesce(F.array_max(F.col("matches")["score"]), F.lit(0.0))
    return rows.select(
        "_doc.*", F.size("_words").cast("bigint").alias("n_words"), "places", "matches",
        label_list(base).alias("base_labels"), label_list(F.concat(base, more)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"))


AGREED = "array<struct<template: int, start: int, weight: double>>"
PLACES = "array<struct<label: string, start: int>>"
MATCHES = "array<struct<label: string, start: int, score: double>>"


def _none(kind: str) -> Column:
    return F.from_json(F.lit("[]"), kind)


def _stand_at(start: Column, words: Sequence[str]) -> Column:
    """Whether these words stand one after another from a place on."""
    from functools import reduce

    return reduce(lambda a, b: a & b, [
        F.coalesce(F.get("_words", start + i) == w, F.lit(False)) for i, w in enumerate(words)])


def _places(phrase_words, anchors, phrases) -> Column:
    """Starts of fixed phrases, looked for around each phrase's rarest word."""
    def of(phrase: str) -> Column:
        words, at = phrase_words[phrase], anchors[phrase]
        starts = F.transform(F.filter("_held", lambda h: h["word"] == words[at]), lambda h: h["at"] - at)
        return F.transform(F.filter(starts, lambda s: (s >= 0) & _stand_at(s, words)),
                           lambda s: F.struct(F.lit(phrases[phrase]).alias("label"), s.alias("start")))

    return F.when(F.size("_held") > 0, F.concat(*[of(p) for p in phrases])).otherwise(_none(PLACES))


def _agreed(postings, weight) -> Column:
    """Weight of the distinct rare words that agree on a template and its place.

    Postings are sorted by template, place and word, so equal ones are neighbours
    and one walk adds them up.
    """
    def struct(t: int, place: int, word: str, at: Column) -> Column:
        return F.struct(F.lit(t).alias("template"), (at - place).alias("start"), F.lit(word).alias("word"),
                        F.lit(float(weight[word])).alias("weight"))

    none = F.from_json(F.lit("[]"), "array<struct<template: int, start: int, word: string, weight: double>>")

    def of(held: Column) -> Column:
        found = none
        for word, entries in sorted(postings.items()):
            found = F.when(held["word"] == word, F.array(*[struct(t, p, word, held["at"]) for t, p in entries])) \
                .otherwise(found)
        return found

    votes = F.array_sort(F.array_distinct(F.flatten(F.transform("_held", of))))

    def summed(held: Column) -> Column:
        places = F.transform(held, lambda v: F.struct(v["template"].alias("template"), v["start"].alias("start")))
        weight = lambda first, size: F.aggregate(
            F.transform(F.slice(held, first + 1, size), lambda v: v["weight"]), F.lit(0.0), lambda a, b: a + b)
        return over_runs(run_ends(places), lambda first, size: F.struct(
            F.get(held, first)["template"].alias("template"), F.get(held, first)["start"].alias("start"),
            weight(first, size).alias("weight")))

    return bound(votes, summed)


def _verified(templates, split, mass, least) -> Column:
    """Candidates with enough weight whose key phrases stand at their places."""
    def of(t: int, template: Template) -> Column:
        keys = [words_of(k) for k in template.keys]
        at = [_find(split[t], k) for k in keys]
        share = lambda c: F.least(F.lit(1.0), c["weight"] / F.lit(mass[t]))
        stand = lambda c: [_stand_at(c["start"] + a, k) for a, k in zip(at, keys, strict=True)]

        def holds(c: Column) -> Column:
            ok = (c["template"] == t) & (share(c) >= least)
            for s in stand(c):
                ok = ok & s
            return ok

        return F.transform(F.filter("_agreed", holds), lambda c: F.struct(
            F.lit(template.label).alias("label"), c["start"].alias("start"), share(c).alias("score")))

    return F.when(F.size("_agreed") > 0, F.concat(*[of(t, x) for t, x in enumerate(templates)])) \
        .otherwise(_none(MATCHES))


def _find(words: Sequence[str], part: Sequence[str]) -> int:
    for i in range(len(words) - len(part) + 1):
        if list(words[i:i + len(part)]) == list(part):
            return i
    raise ValueError(f"key phrase {' '.join(part)!r} isn't in its template")
