"""License scan: base phrases by word position, and an exact set-similarity join of text blocks with notice templates.

A block matches a template when it contains at least ``threshold`` of the template's distinct words. A block is a line of a
document; with ``across_lines`` also every window of twice the longest template's words, at steps of that many words, that holds a
line end, so that wrapped notices match. (A window inside of one line can match nothing that its line does not.)

The join is the usual filter-and-verify one, exact at any size:

* length: a block that shares fewer template words than the smallest template needs can match nothing; it goes at the scan;
* prefix: words are ordered by how many blocks hold them, rarest first; a match must share one of a template's first
  ``n - needed + 1`` words, so only those are joined on;
* position: from the first shared word on, both sides must still have enough words left;
* the survivors are verified on the whole sets.

Skew: the joins are on rare words with a bounded table of templates, and what is grouped is one block's words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from pitframe.llm.common import ascii_lower, split_words, whole
from pitframe.sources.tables import materialise

#: Everything in ASCII but digits and small letters (texts are lower-cased first).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"

# Phrase and label.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Label and words of well-known notices.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
               "http www apache org licenses license 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("mit", "released under the mit license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)


def needed(size: int, threshold: float) -> int:
    """Words that a block must share with a template of ``size`` distinct words."""
    return math.ceil(round(threshold * size, 9))


def _base_columns(words: Column) -> dict[str, Column]:
    """Where each phrase's words stand one after another, by word number from 0."""
    spaced = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))

    def places(phrase: str) -> Column:
        parts = phrase.split()

        def starts(i: Column) -> Column:
            test = F.lit(True)
            for k, part in enumerate(parts):
                test = test & (F.get(words, i + k) == part)
            return test

        found = F.filter(F.sequence(F.lit(0), F.size(words) - 1), starts)
        return F.when(F.contains(spaced, F.lit(f" {phrase} ")), found).otherwise(F.array().cast("array<int>"))

    each = {label: places(phrase) for phrase, label in PHRASES}
    every = F.concat(*each.values())
    return {
        "n_words": F.size(words).cast("long"),
        "places": every,
        "found": F.array_sort(F.array_distinct(F.flatten(F.array(*[F.when(F.size(p) > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>")) for label, p in each.items()])))),
    }


def template_table(spark, templates=TEMPLATES, threshold: float = 0.9) -> DataFrame:
    rows = []
    for number, (label, text) in enumerate(templates):
        words = sorted(set(text.split()))
        rows.append((number, label, words, len(words), needed(len(words), threshold)))
    return spark.createDataFrame(rows, "template int, label string, words array<string>, size int, needed int")


def matching_blocks(blocks: DataFrame, templates: DataFrame) -> DataFrame:
    """``blocks`` (doc_id, block, tokens: distinct template words) joined exactly with templates they contain enough of:
    doc_id, block, template, label, overlap, containment."""
    tokens = blocks.select("doc_id", "block", F.explode("tokens").alias("token"))
    frequency = tokens.groupBy("token").agg(F.count("*").alias("blocks_with"))
    # every template word has a place in the order, seen or not; the table is as small as the templates' vocabulary
    order = (templates.select(F.explode("words").alias("token")).distinct().join(frequency, "token", "left")
             .select("token", F.struct(F.coalesce("blocks_with", F.lit(0)).alias("n"), "token").alias("rarity")))
    in_template = W.partitionBy("template").orderBy("rarity")
    prefixes = (templates.select("*", F.explode("words").alias("token")).join(order, "token")
                .withColumn("at", F.row_number().over(in_template) - 1)
                .where(F.col("at") <= F.col("size") - F.col("needed")))
    in_block = W.partitionBy("doc_id", "block").orderBy("rarity")
    placed = (blocks.select("doc_id", "block", "tokens", F.explode("tokens").alias("token")).join(F.broadcast(order), "token")
              .withColumn("block_at", F.row_number().over(in_block) - 1))
    candidates = (placed.join(F.broadcast(prefixes.select("token", "template", "label", "words", "size", "needed", "at")), "token")
                  .where(F.least(F.col("size") - F.col("at"), F.size("tokens") - F.col("block_at")) >= F.col("needed")))
    return (candidates.dropDuplicates(["doc_id", "block", "template"])
            .withColumn("overlap", F.size(F.array_intersect("tokens", "words")))
            .where(F.col("overlap") >= F.col("needed"))
            .select("doc_id", "block", "template", "label", "overlap", (F.col("overlap") / F.col("size")).alias("containment")))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = 0.9, across_lines: bool = False) -> DataFrame:
    """One row per document: n_words, base places and labels, and the labels and best containment of the set join.

    A null text counts as empty: no words, null places, empty labels, score 0. Repeated rows each keep their row; blocks are
    matched by doc_id, so rows that share one get the labels of both. Columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    table = template_table(spark, templates, threshold)
    vocabulary = sorted({w for _, text in templates for w in text.split()})
    least = min(needed(len(set(text.split())), threshold) for _, text in templates)
    known = F.array(*map(F.lit, vocabulary))
    lowered = docs.select("doc_id", ascii_lower(whole(F.col("text"))).alias("t"))

    def known_words(blocks: Column) -> Column:
        return F.filter(F.transform(blocks, lambda words: F.array_intersect(words, known)), lambda found: F.size(found) >= least)

    # a line end is a separator, so the words of the lines are those of the text
    lined = lowered.select("doc_id", F.transform(F.split("t", "\n"), lambda line: split_words(line, SEPARATORS)).alias("lines"))
    worded = lined.select("doc_id", F.flatten("lines").alias("w"), known_words(F.col("lines")).alias("blocks"),
                          F.flatten(F.transform("lines", lambda words, number: F.array_repeat(number, F.size(words)))).alias("line"))
    if across_lines:
        step = max(len(text.split()) for _, text in templates)
        starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0)), F.lit(step)),
                          lambda at: F.get("line", at) < F.get("line", F.least(at + 2 * step, F.size("w")) - 1))
        windows = known_words(F.transform(starts, lambda at: F.slice("w", at + 1, 2 * step)))
        worded = worded.select("doc_id", "w", F.concat("blocks", windows).alias("blocks"))
    base = _base_columns(F.col("w"))
    slim = materialise(worded.select("doc_id", *[c.alias(n) for n, c in base.items()], "blocks"), "license-blocks")
    blocks = slim.where(F.size("blocks") > 0).select("doc_id", F.posexplode("blocks").alias("block", "tokens"))
    matched = matching_blocks(blocks, table).groupBy("doc_id").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    none = F.array().cast("array<string>")
    return slim.join(matched, "doc_id", "left").select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join("found", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("found", F.coalesce("more", none))), ",").alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"))


def _literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle(templates=TEMPLATES, threshold: float = 0.9) -> str:
    """DuckDB: the phrases by list positions, the templates against every line."""
    values = ", ".join(f"({_literal(label)}, [{', '.join(map(_literal, sorted(set(text.split()))))}], {needed(len(set(text.split())), threshold)})"
                       for label, text in templates)
    tests = []
    for phrase, label in PHRASES:
        parts = phrase.split()
        tests.append((label, " AND ".join(f"w[i + {k + 1}] = {_literal(p)}" for k, p in enumerate(parts))))
    arms = "\n    UNION ALL ".join(f"SELECT doc_id, i, {_literal(label)} AS label FROM placed WHERE {test}" for label, test in tests)
    return f"""WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
  words AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM d),
  placed AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM words WHERE len(w) > 0),
  base AS ({arms}),
  found AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list_distinct(list(label))) AS l FROM base GROUP BY doc_id),
  template AS (SELECT * FROM (VALUES {values}) AS v(label, tw, needed)),
  lines AS (SELECT doc_id, list_distinct(list_filter(regexp_split_to_array(line, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')) AS lw
            FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM words)),
  hits AS (SELECT doc_id, label, len(list_intersect(tw, lw)) / len(tw) AS c FROM lines, template WHERE len(list_intersect(tw, lw)) >= needed),
  more AS (SELECT doc_id, list_distinct(list(label)) AS l, max(c) AS score FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(found.l, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(found.l, []), coalesce(more.l, [])))), ','), '') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM words LEFT JOIN found USING (doc_id) LEFT JOIN more USING (doc_id)"""
