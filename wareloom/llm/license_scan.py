"""License scans by diagonal voting.

Native DataFrame functions only.  A template is a label with a text.  All
rolling k-gram hashes of a document meet the template positions of equal
k-grams (``k`` words, or the whole template where it is shorter); each match
votes for the diagonal document position - template position.  Votes of a
document and template are summed by diagonal, diagonals at most ``gap`` apart are merged into
one span (words put in or left out move the diagonal), and a span is verified when its
matches cover at least ``cover`` percent of the template's words.  Phrases are
templates that only match as a whole: their places are the *base*.

How: one scan of the texts.  The templates' grams are broadcast, at most
``BROADCAST_GRAMS`` of them (more are left to a shuffled join); a match is
confirmed on the words themselves right there, so hash collisions cannot vote, and
texts are never shuffled.  Each document also sends one row of its own through
that join, which carries its columns and word count.

Defined cases: a null text is empty and has no words, no labels and score 0;
templates without words match nothing; a null label never shows; repeated rows
are judged alike; an empty table gives no rows; made columns of the input are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wareloom.llm.url_filters import LOWER, UPPER
from wareloom.session import cut_lineage, local_rows

#: fixed values of the query: phrase, label
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: public license notices: label, text
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
               "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, "
               "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
               "See the License for the specific language governing permissions and limitations under the License."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
            "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K, GAP, COVER = 5, 8, 80
BROADCAST_GRAMS = 100_000
MADE = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]


def with_words(df: DataFrame, text: str) -> DataFrame:
    """``words`` in place of the column ``text``: A-Z lower-cased, what lies between runs of other characters."""
    rest = [c for c in df.columns if c != text]
    parts = df.select(*rest, F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN).alias("parts"))
    empty = lambda at: (F.element_at("parts", at) == "").cast("int")
    inner = F.slice("parts", empty(1) + 1, F.greatest(F.size("parts") - empty(1) - empty(-1), F.lit(0)))
    return parts.select(*rest, inner.alias("words"))


def _grams(hashes: Column, n: Column, k: int) -> Column:
    """Hashes of all k words in a row, by position, from the words' hashes."""
    rolled = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]))
    return F.when(n >= k, rolled).otherwise(F.array().cast("array<bigint>"))


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def template_grams(spark, templates: list[tuple], phrases: list[tuple], k: int = K) -> tuple[DataFrame, list[int]]:
    """(template, label, phrase (boolean), length, k, tpos, gram (words) and its hash; the gram sizes)."""
    rows = [(i, label, text, False) for i, (label, text) in enumerate(templates)]
    rows += [(len(rows) + i, label, text, True) for i, (text, label) in enumerate(phrases)]
    known = local_rows(spark, rows, "template int, label string, text string, phrase boolean").where("label is not null")
    known = with_words(known, "text").withColumn("length", F.size("words")).where("length > 0")
    known = known.withColumn("k", F.when(F.col("phrase"), F.col("length")).otherwise(F.least("length", F.lit(k))))
    known = cut_lineage(known.withColumn("hashes", _word_hashes(F.col("words"))), "license-templates")
    sizes = sorted(r.k for r in known.select("k").distinct().collect())  # at most k and the phrase lengths
    rolled = F.array().cast("array<bigint>")
    for size in sizes:
        rolled = F.when(F.col("k") == size, _grams(F.col("hashes"), F.col("length"), size)).otherwise(rolled)
    known = known.select("*", F.posexplode_outer(rolled).alias("tpos", "hash"))
    return known.withColumn("gram", F.slice("words", F.col("tpos") + 1, F.col("k"))).drop("words", "hashes"), sizes


def _matches(docs: DataFrame, grams: DataFrame, sizes: list[int], rest: list) -> DataFrame:
    """Confirmed matches (template >= 0) and one row per document (template -1) with its columns."""
    doc = F.struct(F.lit(0).alias("_"), *[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(rest)])
    split = with_words(docs.select(F.monotonically_increasing_id().alias("row"), doc.alias("doc"), "text"), "text")
    split = split.withColumns({"n": F.size("words"), "hashes": _word_hashes(F.col("words"))})
    # position 0 is the document's own row; then the grams of each size in turn
    rolled = F.concat(F.array(F.lit(0).cast("long")), *[_grams(F.col("hashes"), F.col("n"), k) for k in sizes])
    # outer, as a plain explode would filter on the array's size, which computes it a second time with every input written out
    each = split.select("row", "doc", "words", "n", rolled.alias("rolled")).select("row", "doc", "words", "n", F.posexplode_outer("rolled").alias("at", "hash"))
    own = local_rows(docs.sparkSession, [(-1, None, False, 0, 0, 0, 0)], "template int, label string, phrase boolean, length int, k int, tpos int, hash long")
    known = grams.unionByName(own.withColumn("gram", F.array().cast("array<string>")))
    if grams.count() <= BROADCAST_GRAMS:
        known = F.broadcast(known)
    begin, before = F.lit(1), F.lit(0)
    for k in sizes:
        before = F.when(F.col("k") == k, begin).otherwise(before)
        begin = begin + F.greatest(F.col("n") - k + 1, F.lit(0))
    met = each.join(known, "hash").withColumn("pos", F.col("at") - before)
    fits = F.when(F.col("template") < 0, F.col("at") == 0).otherwise((F.col("at") > 0) & (F.col("pos") >= 0) & (F.slice("words", F.greatest(F.col("pos"), F.lit(0)) + 1, F.col("k")) == F.col("gram")))
    met = met.where(fits)
    return met.select("row", F.when(F.col("template") < 0, F.col("doc")).alias("doc"), "n", "template", "label", "phrase", "length", "k", "tpos", "pos")


def _spans(votes: DataFrame, gap: int) -> DataFrame:
    """Votes summed by diagonal, neighbouring diagonals merged: row, label, first_word, last_word, covered and length of each span."""
    key = ["row", "template"]
    lines = votes.groupBy(*key, (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(
        F.min("pos").alias("first"), F.max(F.col("pos") + F.col("k") - 1).alias("last"), F.first("label").alias("label"), F.first("length").alias("length"),
        F.first("k").alias("k"), F.collect_set("tpos").alias("starts"))  # at most the template's grams
    order = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > gap).cast("int"), F.lit(0))
    lines = lines.withColumn("apart", apart).withColumn("band", F.sum("apart").over(order))
    ends = lines.groupBy(*key, "band").agg(F.min("first").alias("first_word"), F.max("last").alias("last_word"), F.first("label").alias("label"), F.first("length").alias("length"))
    covers = F.flatten(F.transform("starts", lambda t: F.sequence(t, t + F.col("k") - 1)))
    words = lines.select(*key, "band", F.explode(covers).alias("word")).groupBy(*key, "band").agg(F.size(F.collect_set("word")).alias("covered"))  # at most the template's words
    return ends.join(words, [*key, "band"]).select("row", "label", "first_word", "last_word", "covered", "length")


def scan(docs: DataFrame, templates: list[tuple] = TEMPLATES, phrases: list[tuple] = PHRASES, k: int = K, gap: int = GAP, cover: int = COVER) -> DataFrame:
    """``docs`` (without text) with n_words, n_base, first_word, last_word, base_labels, labels, score and spans.

    ``n_base`` counts the phrases' places; ``spans`` has (label, first_word, last_word, covered, length) of the verified
    spans; ``score`` is the best share of a template's words that a span covers, 1 with a phrase.
    """
    spark = docs.sparkSession
    rest = [f for f in docs.schema.fields if f.name not in (*MADE, "text")]
    grams, sizes = template_grams(spark, templates, phrases, k)
    met = cut_lineage(_matches(docs, grams, sizes, rest), "license-matches")
    base = met.where("phrase").groupBy("row").agg(
        F.count(F.lit(1)).alias("n_base"), F.min("pos").cast("long").alias("first_word"), F.max("pos").cast("long").alias("last_word"), F.collect_set("label").alias("_base"))
    share = F.col("covered") / F.col("length")
    good = F.col("covered") * 100 >= F.col("length") * cover
    span = F.struct("label", F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"), "covered", "length")
    found = _spans(met.where("template >= 0 and not phrase"), gap).groupBy("row").agg(
        F.max(share).alias("_share"), F.array_sort(F.collect_list(F.when(good, span))).alias("spans"), F.collect_set(F.when(good, F.col("label"))).alias("_found"))
    none = F.array().cast("array<string>")
    text = lambda labels: F.concat_ws(",", F.array_sort(labels))
    own, added = F.coalesce("_base", none), F.coalesce("_found", none)
    out = met.where("template < 0").select("row", "doc", F.col("n").cast("long").alias("n_words")).join(base, "row", "left").join(found, "row", "left")
    return out.select(
        *[F.col(f"doc.c{i}").alias(f.name) for i, f in enumerate(rest)], "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        text(own).alias("base_labels"), text(F.array_union(own, added)).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_share", F.lit(0.0))).alias("score"), F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)).alias("spans"))
