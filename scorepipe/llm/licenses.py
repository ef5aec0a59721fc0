"""License notices by diagonal voting, in DataFrame functions only.

Rolling hashes of k words of every text are joined with the same hashes of the templates. A match of text word
i with template word j votes for the diagonal i - j; a copy of a notice is a diagonal with many votes, and
inserted or missing words move it to a neighbouring one. A vote must agree in two hashes of other kinds, 96 bits
together; the words themselves stay behind, since a row of every gram with its text's words would copy each text
as often as it has words. Votes are summed by diagonal and neighbouring diagonals are merged into one band. The
few bands that cover enough of a template go back to their text and are verified: only template words count that
stand in the text at the very place that a vote of the band names.

Votes belong to a text, named by its MD5, not to an id: rows that share an id, or have none, are told apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorepipe.llm import common

GRAM = 4
SHARE = 0.6
NEAR_DIAGONALS = 4
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that name a license on their own.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: Public notices; fixed values.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


def words(text: Column) -> Column:
    """Lower-case words. Lowering all letters, not A-Z alone, moves no word border and makes no ASCII letter but k."""
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORDS), F.lit(0))


def gram_hashes(w: str, k: int) -> Column:
    """Two hashes (h, g) of the k words that start at each word; empty for shorter texts."""
    at = F.when(F.size(w) >= k, F.sequence(F.lit(0), F.size(w) - k)).otherwise(F.array().cast("array<int>"))

    def both(i: Column) -> Column:
        gram = [F.get(F.col(w), i + j) for j in range(k)]
        return F.struct(F.xxhash64(*gram).alias("h"), F.hash(*gram).alias("g"))

    return F.transform(at, both)


def template_grams(spark: SparkSession, templates: list[tuple[str, str]], k: int) -> DataFrame:
    """(h, g, label, template, n_template, tpos): one row per template position, as many as the templates have words."""
    listed = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(text).alias("text")) for i, (label, text) in enumerate(templates)])
    rows = spark.range(1).select(F.inline(listed))
    cut = rows.withColumn("w", words(F.col("text"))).withColumn("h", gram_hashes("w", k))
    return cut.select("label", "template", F.size("w").alias("n_template"), F.posexplode_outer("h").alias("tpos", "gram")).select("label", "template", "n_template", "tpos", "gram.h", "gram.g")


def bands(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, k: int = GRAM, near: int = NEAR_DIAGONALS) -> DataFrame:
    """(name, label, template, first_word, end_word, diagonals, coverage): merged diagonals of a text with the share of the template they cover.

    ``name`` is `common.text_name` of the text; ``diagonals`` lists each diagonal with the template places of its votes.
    """
    grams = template_grams(docs.sparkSession, templates, k)
    cut = docs.select(common.text_name("text").alias("name"), words(F.col("text")).alias("w")).withColumn("h", gram_hashes("w", k))
    # an outer explode, since for an inner one the optimizer tests that the array is not empty and, doing so, cuts the words anew for every gram
    votes = (
        cut.select("name", F.posexplode_outer("h").alias("pos", "gram"))
        .select("name", "pos", "gram.h", "gram.g")
        .join(F.broadcast(grams), ["h", "g"])  # bounded by the words of the templates
        .select("name", "label", "template", "n_template", (F.col("pos") - F.col("tpos")).alias("diagonal"), "tpos")
    )
    key = ["name", "label", "template", "n_template"]
    diagonals = votes.groupBy(*key, "diagonal").agg(F.collect_set("tpos").alias("places"))
    along = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > near, F.lit(True))
    merged = diagonals.withColumn("apart", apart.cast("int")).withColumn("band", F.sum("apart").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    found = merged.groupBy(*key, "band").agg(
        F.flatten(F.collect_list("places")).alias("places"), F.collect_list(F.struct("diagonal", "places")).alias("diagonals"),
        F.min(F.col("diagonal") + F.array_min("places")).alias("first_word"), F.max(F.col("diagonal") + F.array_max("places") + k).alias("end_word"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + k - 1)))))
    return found.select("name", "label", "template", "first_word", "end_word", "diagonals", (covered / F.col("n_template")).alias("coverage"))


def verified(found: DataFrame, docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, k: int = GRAM) -> DataFrame:
    """(name, label, template, first_word, end_word, coverage): bands with the share of template words that stand in the text where the votes say."""
    spark = docs.sparkSession
    listed = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(text).alias("source")) for i, (_, text) in enumerate(templates)])
    wanted = spark.range(1).select(F.inline(listed)).select("template", words(F.col("source")).alias("t"))  # as many rows as templates
    texts = docs.select(common.text_name("text").alias("name"), F.col("text"))
    both = found.join(texts, "name").join(F.broadcast(wanted), "template").withColumn("w", words(F.col("text")))

    def places(d: Column) -> Column:
        own = F.array_distinct(F.flatten(F.transform(d["places"], lambda p: F.sequence(p, p + k - 1))))
        return F.filter(own, lambda p: F.get(F.col("w"), (p + d["diagonal"]).cast("int")) == F.get(F.col("t"), p))

    stand = F.size(F.array_distinct(F.flatten(F.transform("diagonals", places)))) / F.size("t")
    # copies of a text give equal rows
    return both.select("name", "label", "template", "first_word", "end_word", stand.alias("coverage")).distinct()


def phrase_places(w: str) -> Column:
    """Array of (start, label) of every place where a phrase's words stand consecutively."""

    def at(i: Column) -> Column:
        named = None
        for phrase, label in PHRASES:
            terms = phrase.split(" ")
            start = i - (len(terms) - 1)
            same = F.get(F.col(w), i) == terms[-1]
            for j, term in enumerate(terms[:-1]):
                same = same & F.coalesce(F.get(F.col(w), start + j) == term, F.lit(False))
            place = F.struct(start.cast("bigint").alias("start"), F.lit(label).alias("label"))
            named = F.when(same, place) if named is None else named.when(same, place)
        return named

    last = PHRASES[0][0].split(" ")[-1]
    assert all(p.endswith(last) for p, _ in PHRASES)
    return F.filter(F.transform(F.sequence(F.lit(0), F.size(w) - 1), at), lambda p: p.isNotNull())


def license_labels(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, k: int = GRAM, share: float = SHARE) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    base_labels come from phrases, labels also from bands that cover at least ``share`` of a template; both are
    distinct, sorted, joined by commas, and empty where nothing was found. score is 1 where a phrase stands, else
    the best coverage of a band (0 without one): verified where it reaches ``share``, by votes below. Null texts
    have no words. Every row is judged by its own text, whatever its id; a null id comes back null. Texts of any
    length are taken whole. Extra columns are ignored; an empty table gives no rows.
    """
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lowered = F.lower(F.coalesce(F.col("text"), F.lit("")))
    # every phrase ends in the same word: texts without it have no place
    ends = lowered.contains(PHRASES[0][0].split(" ")[-1])
    none = F.array().cast("array<struct<start:bigint,label:string>>")
    base = (
        plain.select("doc_id", common.text_name("text").alias("name"), F.regexp_count(lowered, F.lit(WORDS)).cast("bigint").alias("n_words"), F.when(ends, words(F.col("text"))).otherwise(F.array().cast("array<string>")).alias("w"))
        .withColumn("places", F.when(F.size("w") > 0, phrase_places("w")).otherwise(none))
        .select("doc_id", "name", "n_words", "places.start", F.array_distinct("places.label").alias("own"))
    )
    voted = common.settled(bands(plain, templates, k))
    high = F.col("coverage") >= share
    checked = verified(voted.filter(high), plain, templates, k)
    every = checked.unionByName(voted.filter(~high).drop("diagonals"))
    best = every.groupBy("name").agg(F.collect_set(F.when(high, F.col("label"))).alias("voted"), F.max("coverage").alias("coverage"))
    joined = base.join(best, "name", "left")
    every = F.array_union("own", F.coalesce("voted", F.array().cast("array<string>")))
    return joined.select(
        "doc_id", "n_words", F.size("start").cast("bigint").alias("n_base"), F.array_min("start").alias("first_word"), F.array_max("start").alias("last_word"),
        F.array_join(F.array_sort("own"), ",").alias("base_labels"), F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size("start") > 0, F.lit(1.0)).otherwise(F.coalesce("coverage", F.lit(0.0))).alias("score"),
    )
