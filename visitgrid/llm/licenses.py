"""License notices in documents: fixed phrases, and an exact set-similarity join.

A block is a run of consecutive words of a document, wherever its lines break, a quarter
longer than the notice it is held against; a template is the set of words of a notice.  A
block matches a template if it holds at least 80 % of its words, and the phrases that tell
notices apart.  The join finds every such pair:

* words are ordered by how many documents have them, rare ones first;
* prefix filter: a block that holds ``need`` of the n words of a template must hold one of
  the n - need + 1 rarest, so only places of those are looked up;
* positional filter: all of the block lies within a block's length before and after that
  place;
* length filter: the template's words there must be ``need`` or more;
* what is left is verified run by run.

Words that no template has take no part.  All of it is DataFrame functions.
"""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, materialize

#: Phrases with their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Notices with their labels.
TEMPLATES = {
    "Licensed under the Apache License, Version 2.0": "apache-2.0",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met": "bsd",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by-4.0",
    "Licensed under CC BY-NC 4.0": "cc-by-nc-4.0",
    "Licensed under CC BY-SA 4.0": "cc-by-sa-4.0",
    "This work is licensed under the GNU General Public License, version 2": "gpl-2.0",
    "This work is licensed under the GNU General Public License, version 3": "gpl-3.0",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation": "gpl-notice",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": "mit",
    "Released under the MIT License": "mit",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0": "mpl-2.0",
    "This is free and unencumbered software released into the public domain": "unlicense",
}
#: Words that tell notices apart: a notice that has them needs them, next to each other.
TELLING = (
    "apache license version 2", "attribution 4", "by nc 4", "by sa 4", "gnu general public license", "mit license",
    "mozilla public license v 2", "public license version 2", "public license version 3", "unencumbered software",
)
#: Share of a template's words that a block must hold, in percent.
CONTAINED = 80
_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def words_of_notice(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def needed(size: int, percent: int = CONTAINED) -> int:
    return -(-size * percent // 100)


def measure(
    docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None, text: str = "text",
) -> tuple[DataFrame, str]:
    """All columns of ``docs`` and a struct: ``n_words``, ``known`` (the words that notices
    and phrases have, ``at`` and ``w``, in order) and ``places`` (phrase starts, with
    labels).  Null and empty texts have no words."""
    phrases = PHRASES if phrases is None else phrases
    notices = [words_of_notice(x) for x in (TEMPLATES if templates is None else templates)]
    vocabulary = sorted(set().union(*notices, *(p.split(" ") for p in phrases)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    words, known, out = (free_name(docs, f"license_{x}") for x in ("words", "known", "all"))

    def place(w: Column, i: Column) -> Column:
        low = F.lower(w)  # of letters beyond ASCII too, so the length must show that there are none
        return F.when(low.isin(vocabulary) & (F.octet_length(w) == F.char_length(w)), F.struct(i.alias("at"), low.alias("w")))

    df = docs.select(*columns, F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(_WORD), F.lit(0)).alias(words))
    df = df.select("*", F.array_compact(F.transform(words, place)).alias(known))
    nowhere = F.array().cast("array<struct<at:int,label:string>>")

    def places_of(phrase: str, name: str) -> Column:
        """The phrase's words are neighbours among the known words, and in the text."""
        k = F.col(known)

        def follows(n: int, part: str, o: Column, i: Column) -> Column:
            return F.coalesce((F.get(k, i + n)["w"] == part) & (F.get(k, i + n)["at"] == o["at"] + n), F.lit(False))

        starts = F.filter(k, lambda o, i: functools.reduce(operator.and_, (follows(n, part, o, i) for n, part in enumerate(phrase.split(" ")))))
        return F.transform(starts, lambda o: F.struct(o["at"].alias("at"), F.lit(name).alias("label")))

    found = [places_of(phrase, name) for phrase, name in phrases.items()]
    return df.select(*columns, F.struct(F.size(words).cast("long").alias("n_words"), F.col(known).alias("known"), F.concat(nowhere, *found).alias("places")).alias(out)), out


def _span(size: int) -> int:
    """Words a run may have for a template of ``size`` words: a quarter more."""
    return size + size // 4


def _told(sequence: list[str], telling: tuple[str, ...]) -> list[str]:
    """Those of the phrases that a notice has."""
    return [p for p in telling if f" {p} " in f" {' '.join(sequence)} "]


def runs(measured: DataFrame, row: str, measures: str, templates: dict[str, str], percent: int = CONTAINED, telling: tuple[str, ...] = TELLING) -> DataFrame:
    """Every row and template with a run of words that holds enough of it, and what tells
    it from others: ``row``, ``label``, ``common`` (the most of a run) and ``size``.
    ``measured`` is read twice: a written table."""
    sequences = [(label, words_of_notice(text)) for text, label in templates.items()]
    vocabulary = sorted({w for _, ws in sequences for w in ws})
    places = measured.select(F.col(row).alias("row"), F.col(measures)["known"].alias("known"))
    own = F.array_distinct(F.transform("known", lambda o: o["w"]))
    # at most as many rows as the templates have words
    often = {r["w"]: r["count"] for r in places.select(F.explode(own).alias("w")).where(F.col("w").isin(vocabulary)).groupBy("w").count().collect()}
    rank = {w: n for n, w in enumerate(sorted(vocabulary, key=lambda w: (often.get(w, 0), w)))}

    rows = []
    for n, (label, sequence) in enumerate(sequences):
        ordered = sorted(set(sequence), key=rank.get)
        need = needed(len(ordered), percent)
        for w in ordered[: len(ordered) - need + 1]:
            rows.append((w, n, label, need, _span(len(sequence)), ordered, [p.split(" ") for p in _told(sequence, telling)]))
    # templates are given by the caller and few, so their prefixes go to every task
    prefixes = places.sparkSession.createDataFrame(rows, "w string, template int, label string, need int, span int, t_words array<string>, told array<array<string>>")

    # a run that holds the word is within the widest span before and after it; known words
    # are in order, so these are neighbours in the array
    reach = max((r[4] for r in rows), default=1) - 1
    indexed = F.array_compact(F.transform("known", lambda o, i: F.when(
        o["w"].isin(sorted({r[0] for r in rows})), F.struct(i.alias("i"), o["at"].alias("at"), o["w"].alias("w")))))
    probes = F.transform(indexed, lambda x: F.struct(
        x["at"].alias("at"), x["w"].alias("w"), F.slice("known", F.greatest(x["i"] - reach, F.lit(0)) + 1, F.lit(2 * reach + 1)).alias("near")))
    met = places.select("row", F.explode(probes).alias("p")).select("row", "p.*").join(F.broadcast(prefixes), "w")
    met = met.withColumn("near", F.filter("near", lambda o: F.abs(o["at"] - F.col("at")) < F.col("span")))
    have = F.array_intersect("t_words", F.transform("near", lambda o: o["w"]))
    possible = met.withColumn("have", have).where(F.size("have") >= F.col("need"))

    def within(start: Column) -> Column:
        run = F.filter("near", lambda o: (o["at"] >= start) & (o["at"] < start + F.col("span")))

        def begins(phrase: Column, o: Column) -> Column:
            parts = F.transform(phrase, lambda w, n: F.struct((o["at"] + n).alias("at"), w.alias("w")))
            return F.forall(parts, lambda part: F.array_contains(run, part))

        told = F.forall("told", lambda phrase: F.exists(run, lambda o: (o["w"] == phrase[0]) & begins(phrase, o)))
        return F.when(told, F.size(F.array_intersect(F.transform(run, lambda o: o["w"]), F.col("have")))).otherwise(0)

    starts = F.transform(F.filter("near", lambda o: o["at"] <= F.col("at")), lambda o: o["at"])
    common = F.array_max(F.transform(starts, within))
    verified = possible.select("row", "template", "label", "need", common.alias("common"), F.size("t_words").alias("size")).where("common >= need")
    return verified.groupBy("row", "template", "label", "size").agg(F.max("common").alias("common")).select("row", "label", "common", "size")


def label(
    docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None, text: str = "text",
    percent: int = CONTAINED, telling: tuple[str, ...] = TELLING,
) -> tuple[DataFrame, str]:
    """All columns of ``docs`` and a struct of what was found; returns the frame and its name.

    ``n_words``, ``n_base`` (places of phrases), ``first_word``, ``last_word`` (smallest and
    largest start, null without any), ``base_labels``, ``notice_labels``, ``labels`` (both;
    distinct and sorted), ``notice_score`` (the largest share of a matched template, else 0)
    and ``score`` (1 with a phrase, else that).  Equal rows are labelled alike.
    """
    templates = TEMPLATES if templates is None else templates
    row = free_name(docs, "license_row")
    measured, measures = measure(docs, templates, phrases, text)
    # written with their numbers, so both reads give the same
    measured = materialize(measured.withColumn(row, F.monotonically_increasing_id()), "licenses")
    best = runs(measured, row, measures, templates, percent, telling).groupBy(F.col("row").alias(free_name(measured, "hit_row"))).agg(
        F.collect_set("label").alias(free_name(measured, "hit_labels")), F.max(F.col("common") / F.col("size")).alias(free_name(measured, "hit_score")))
    hit_row, hit_labels, hit_score = best.columns
    joined = measured.join(best, F.col(row) == F.col(hit_row), "left")
    places, found = F.col(measures)["places"], F.coalesce(hit_labels, F.array().cast("array<string>"))
    base, share = F.array_distinct(F.transform(places, lambda p: p["label"])), F.coalesce(hit_score, F.lit(0.0))
    out = free_name(docs, "licenses")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(
        F.col(measures)["n_words"].alias("n_words"), F.size(places).cast("long").alias("n_base"),
        F.array_min(F.transform(places, lambda p: p["at"])).cast("long").alias("first_word"),
        F.array_max(F.transform(places, lambda p: p["at"])).cast("long").alias("last_word"),
        F.array_sort(base).alias("base_labels"), F.array_sort(found).alias("notice_labels"), F.array_sort(F.array_union(base, found)).alias("labels"),
        share.alias("notice_score"), F.when(F.size(places) > 0, 1.0).otherwise(share).alias("score"),
    ).alias(out)), out
