"""Exact set-similarity join of texts with license templates, on built-in expressions only.

Tokens are runs of five words. The tokens of the templates are counted over the whole corpus and put in one global
order, rarest first. A template is found in a text when the text holds at least THRESHOLD of its tokens; then the
two share a token among the template's first ``m - need + 1`` (prefix filter), the text has ``need`` template tokens
at all (length filter), and what follows the shared token on both sides can still reach ``need`` (positional filter).
Survivors are verified by intersection. Defined results: NULL and empty texts have no words and no labels; rows with
equal id and text are labelled alike, each on its own row; other columns pass through, and a column that has the result's name is refused; very
long texts are scanned whole; an empty table gives an empty table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.llm.common import SHINGLE, SIMILARITY, let, refuse_clash, shingle_hashes, text_of

# Phrases that name a license, and their labels.
PHRASES = {"mit": ("mit", "license"), "apache": ("apache", "license"), "gpl": ("general", "public", "license")}
# Notices as their licenses word them.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
)
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_words(text: Column) -> Column:
    """Words of ASCII letters, digits and everything beyond ASCII.

    ``lower`` stands for lowering A-Z: it moves no other letter to one that occurs in a phrase, and no word border.
    """
    return F.array_remove(F.split(F.lower(text), WORD_GAP), "")


def phrase_places(words: Column) -> Column:
    """(start, label) of every place where a phrase stands, in order; decided at the phrase's last word."""

    def at(w: Column, i: Column) -> Column:
        hit = F.lit(None).cast("struct<start:int,label:string>")
        for label, phrase in PHRASES.items():
            first = i - (len(phrase) - 1)
            here = first >= 0
            for k, word in enumerate(phrase[:-1]):
                here = here & (F.get(w, F.greatest(first + k, F.lit(0))) == word)
            hit = F.when(here, F.struct(first.alias("start"), F.lit(label).alias("label"))).otherwise(hit)
        return hit

    last = {phrase[-1] for phrase in PHRASES.values()}
    none = F.array().cast("array<struct<start:int,label:string>>")

    def of(w: Column) -> Column:
        ends = F.filter(F.transform(w, lambda x, i: F.when(x.isin(*last), i)), lambda i: i.isNotNull())
        return F.filter(F.transform(ends, lambda i: at(w, i)), lambda hit: hit.isNotNull())

    return let(words, lambda w: F.when(F.arrays_overlap(w, F.array(*[F.lit(x) for x in sorted(last)])), of(w)).otherwise(none))


def templates(spark: SparkSession, named=TEMPLATES, threshold: float = SIMILARITY) -> DataFrame:
    """template_id, label, tokens (distinct), need: a small table made from a parameter, five words at least each."""
    rows = [(i, label, text) for i, (label, text) in enumerate(named)]
    df = spark.createDataFrame(rows, "template_id int, label string, text string")
    tokens = F.array_distinct(shingle_hashes(license_words(F.col("text")), SHINGLE))
    # The small surplus keeps 0.8 * 5 from rounding up to 5.
    need = F.ceil(F.size("tokens") * F.lit(threshold) - F.lit(1e-9)).cast("int")
    return df.select("template_id", "label", tokens.alias("tokens")).where(F.size("tokens") > 0).withColumn("need", need)


def anchor_words(named=TEMPLATES) -> list[str]:
    """The longest word of every template token, so every token holds one of them."""
    anchors = set()
    for _, text in named:
        words = [w for w in re.split(WORD_GAP, text.lower()) if w]
        anchors |= {max(words[i : i + SHINGLE], key=len) for i in range(len(words) - SHINGLE + 1)}
    return sorted(anchors)


def similarity_join(texts: DataFrame, key: list[str], text: str, named=TEMPLATES, threshold: float = SIMILARITY) -> DataFrame:
    """key, template_id, label, containment of every pair of a text and a template at or above the threshold."""
    spark = texts.sparkSession
    wanted = templates(spark, named, threshold)
    # A parameter's tokens, a few hundred at most: known to the driver, so written into the plan.
    known = F.array(*[F.lit(r[0]) for r in wanted.select(F.explode("tokens")).distinct().collect()]).cast("array<bigint>")
    # A text without any of these words holds no token of any template.
    anchors = F.array(*[F.lit(w) for w in anchor_words(named)]).cast("array<string>")
    shared = let(
        license_words(F.col(text)),
        lambda w: F.when(F.arrays_overlap(w, anchors), F.array_intersect(shingle_hashes(w, SHINGLE), known)).otherwise(F.array().cast("array<bigint>")),
    )
    blocks = texts.select(*key, shared.alias("_tokens")).where(F.size("_tokens") > 0)
    ordered = F.sort_array(F.collect_list(F.struct("_n", "_token")))["_token"]
    # One row per template token, so at most a few hundred rows: a bounded broadcast.
    counted = blocks.select(F.explode("_tokens").alias("_token")).groupBy("_token").agg(F.count(F.lit(1)).alias("_n"))
    counted = F.broadcast(counted)
    by_text = (
        blocks.withColumn("_token", F.explode("_tokens")).join(counted, "_token")
        .groupBy(*key).agg(ordered.alias("_have"))
        .select(*key, "_have", F.posexplode("_have").alias("_at", "_token"))
    )
    prefixes = (
        wanted.withColumn("_token", F.explode("tokens")).join(counted, "_token", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
        .groupBy("template_id", "label", "need").agg(ordered.alias("_want"))
        .select("template_id", "label", "need", "_want", F.posexplode("_want").alias("_place", "_token"))
        .where(F.col("_place") <= F.size("_want") - F.col("need"))
    )
    follow = F.least(F.size("_have") - F.col("_at"), F.size("_want") - F.col("_place"))
    overlap = F.size(F.array_intersect("_have", "_want"))
    return (
        by_text.join(F.broadcast(prefixes), "_token")
        .where((F.size("_have") >= F.col("need")) & (follow >= F.col("need")))
        .withColumn("_overlap", overlap)
        .where(F.col("_overlap") >= F.col("need"))
        .groupBy(*key, "template_id", "label")
        .agg(F.max(F.col("_overlap") / F.size("_want")).alias("containment"))
    )


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text", into: str = "license") -> DataFrame:
    """``df`` with a struct: n_words, n_base, first_word, last_word, base_labels, labels, score.

    A text in which a phrase stands scores 1; else the score is the best containment found.
    """
    refuse_clash(df, into)
    # The row travels as one field, so no column of it can clash with one of these.
    keyed = df.select(F.struct("*").alias("_row"), F.col(doc_id).alias("_i"), text_of(df, text).alias("_t")).withColumn("_h", F.md5("_t"))
    found = similarity_join(keyed.select("_i", "_h", "_t"), ["_i", "_h"], "_t")
    found = found.groupBy(F.col("_i").alias("_fi"), F.col("_h").alias("_fh")).agg(F.collect_set("label").alias("_labels"), F.max("containment").alias("_best"))

    def base(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n"), phrase_places(w).alias("p"))

    marked = keyed.withColumn("_b", let(license_words(F.col("_t")), base)).drop("_t")
    joined = marked.join(found, F.col("_i").eqNullSafe(F.col("_fi")) & (F.col("_h") == F.col("_fh")), "left")
    places = F.col("_b.p")
    starts = F.transform(places, lambda p: p["start"].cast("long"))
    base_labels = F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"])))
    labels = F.array_sort(F.array_union(base_labels, F.coalesce("_labels", F.array().cast("array<string>"))))
    return joined.select(
        "_row.*",
        F.struct(
            F.col("_b.n").alias("n_words"),
            F.size(places).cast("long").alias("n_base"),
            F.array_min(starts).alias("first_word"),
            F.array_max(starts).alias("last_word"),
            F.array_join(base_labels, ",").alias("base_labels"),
            F.array_join(labels, ",").alias("labels"),
            F.when(F.size(places) > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
        ).alias(into),
    )
