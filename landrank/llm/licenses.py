"""License scans by diagonal voting, with DataFrame operations only.

All rolling k-grams of words of all texts are joined by their hashes with the positions of the same k-grams in templates.
A match of text position p with template position q votes for the diagonal p - q, as words that stand in a text as they
stand in a template share one; a word more or less shifts what follows to a neighbouring diagonal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landrank.llm.common import attach, written

#: What lies between words (words are runs of digits, small letters and all beyond ASCII), and phrases with their labels.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))

#: Notices of licenses as (label, least share of the words that a text must have, words).
#: Where one word tells two licenses apart, all words are asked for.
NOTICES = (
    ("mit", 1.0, "released under the mit license"),
    ("mit", 0.8, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software "
                 "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
                 "persons to whom the software is furnished to do so subject to the following conditions"),
    ("apache-2", 1.0, "licensed under the apache license version 2 0"),
    ("apache-2", 0.8, "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
                      "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("gpl-2", 1.0, "gnu general public license version 2"),
    ("gpl-3", 1.0, "gnu general public license version 3"),
    ("gpl", 0.8, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", 1.0, "gnu lesser general public license"),
    ("agpl", 1.0, "gnu affero general public license"),
    ("bsd", 0.8, "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", 0.8, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this "
                 "permission notice appear in all copies"),
    ("mpl-2", 0.8, "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl-2", 0.8, "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("cc-by-nc", 1.0, "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", 1.0, "licensed under cc by sa"),
    ("cc-by-sa", 1.0, "creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nd", 1.0, "licensed under cc by nd"),
    ("cc-by", 1.0, "licensed under cc by 4 0"),
    ("cc-by", 1.0, "creative commons attribution 4 0 international license"),
    ("cc0", 0.8, "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", 0.8, "this is free and unencumbered software released into the public domain"),
)

#: Words of a k-gram; of a template's length, the share by which merged diagonals may lie apart.
GRAM, DRIFT = 3, 1 / 8
#: Positions that all templates may have together, as they are broadcast: some 6 MB.
MOST_POSITIONS = 100_000
#: Seeds of the two hashes of a k-gram.
SEEDS = (11, 1109)


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null has none."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), BETWEEN), "")


def gram_hash(w: Column, i: Column, k: int, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[F.get(w, i + j) for j in range(k)])


def templates(spark: SparkSession, phrases: tuple, notices: tuple, k: int) -> tuple[DataFrame, DataFrame]:
    """(t, label, is_phrase, least, len, drift) of every template, and (t, q, g, g2) of every k-gram in one."""
    rows = [(label, True, 1.0, text) for label, text in phrases] + [(label, False, float(least), text) for label, least, text in notices]
    t = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "t int, label string, is_phrase boolean, least double, text string")
    t = t.select("t", "label", "is_phrase", "least", words(F.col("text")).alias("w")).withColumn("len", F.size("w"))
    total, short = t.agg(F.sum("len"), F.min("len")).first()
    if total > MOST_POSITIONS or short < k:
        raise ValueError(f"templates must have {k} words each and {MOST_POSITIONS} together at most")
    known = t.select("t", "label", "is_phrase", "least", "len", F.greatest(F.lit(1.0), F.floor(F.col("len") * DRIFT).cast("double")).alias("drift"))
    grams = t.select("t", "w", F.explode_outer(F.sequence(F.lit(0), F.col("len") - k)).alias("q"))
    return known, grams.select("t", "q", gram_hash(F.col("w"), F.col("q"), k, SEEDS[0]).alias("g"), gram_hash(F.col("w"), F.col("q"), k, SEEDS[1]).alias("g2"))


def votes(docs: DataFrame, grams: DataFrame, k: int) -> DataFrame:
    """(digest, n_words, t, diagonal, q, n): matches of distinct texts, and for each text a row without t that counts copies.

    Every k-gram of every text meets the templates in the join; what leaves a task is matches, each once a text.
    """
    w = docs.select(F.md5(F.coalesce("text", F.lit(""))).alias("digest"), words(F.col("text")).alias("w"))
    none = "cast(array() as array<struct<p: int, h: bigint, h2: bigint>>)"
    own = F.when(F.size("w") >= k, F.transform(F.sequence(F.lit(0), F.size("w") - k), lambda i: F.struct(
        i.alias("p"), gram_hash(F.col("w"), i, k, SEEDS[0]).alias("h"), gram_hash(F.col("w"), i, k, SEEDS[1]).alias("h2")))).otherwise(F.expr(none))
    head = F.array(F.struct(F.lit(-1).alias("p"), F.lit(None).cast("long").alias("h"), F.lit(None).cast("long").alias("h2")))
    # explode() without _outer makes Spark ask for the size of the array first, by an expression that splits a text once for each word
    e = w.select("digest", F.size("w").alias("n_words"), F.explode_outer(F.concat(head, own)).alias("e")).select("digest", "n_words", "e.p", "e.h", "e.h2")
    met = e.join(F.broadcast(grams), (F.col("h") == F.col("g")) & (F.col("h2") == F.col("g2")), "left").filter("p = -1 or t is not null")
    return met.groupBy("digest", "n_words", "t", (F.col("p") - F.col("q")).alias("diagonal"), "q").agg(F.count(F.lit(1)).alias("n"))


def spans(matches: DataFrame, known: DataFrame, k: int) -> DataFrame:
    """votes() with a template to (digest, label, is_phrase, start, end, score, found), a row for each place.

    A phrase has a place where all its k-grams lie on one diagonal.  Of a notice, diagonals within its drift of each other
    are merged around the one with most votes (the first of these); the score is the share of the notice's words that lie
    in a matched k-gram there, and the notice is found if it reaches the least share.
    """
    d = matches.groupBy("digest", "t", "diagonal").agg(F.collect_set("q").alias("qs")).join(F.broadcast(known), "t").withColumn("votes", F.size("qs"))
    phrases = d.filter("is_phrase").filter(F.col("votes") == F.col("len") - k + 1).select(
        "digest", "label", "is_phrase", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("len")).alias("end"), F.lit(1.0).alias("score"), F.lit(True).alias("found"))
    over = lambda x: F.expr(f"{x} over (partition by digest, t order by diagonal / drift range between 1.0D preceding and 1.0D following)")
    n = d.filter("not is_phrase").withColumns({
        "merged": F.array_distinct(F.flatten(over("collect_list(qs)"))), "best": over("max(struct(votes, -diagonal))") == F.expr("struct(votes, -diagonal)"),
        "start": over("min(diagonal + array_min(qs))"), "end": over(f"max(diagonal + array_max(qs) + {k})")}).filter("best")
    covered = F.size(F.array_distinct(F.flatten(F.transform("merged", lambda q: F.sequence(q, q + k - 1)))))
    n = n.withColumn("score", covered / F.col("len"))
    return phrases.unionByName(n.select("digest", "label", "is_phrase", "start", "end", "score", (F.col("score") >= F.col("least")).alias("found")))


def license_scan(docs: DataFrame, phrases: tuple = PHRASES, notices: tuple = NOTICES, k: int = GRAM) -> DataFrame:
    """Licenses named in every whole text of docs (doc_id, text), a row a row: doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score, spans.

    n_base counts the places of phrases, first_word and last_word are their least and greatest start, base_labels their
    labels; labels has those of found notices too, score is the best score of any place, spans (label, start, end, score)
    tells where phrases and found notices stand, in words from 0.

    Equal texts are told by their digest and looked at together once their matches have left their tasks; rows get the
    result of their text by attach(), so no group of copies, null texts among them, is one task's.  Null and empty texts
    have no words and no labels ("", score 0); very long texts are taken whole; a null doc_id stays null; repeated rows
    and ids get a row each; other columns, whatever their names, are not read; no rows give no rows.
    """
    spark = docs.sparkSession
    known, grams = templates(spark, phrases, notices, k)
    met = written(votes(docs.select("text"), grams, k), "licenses")
    found = spans(met.filter("t is not null"), known, k)
    base, label, none = F.col("is_phrase"), F.when(F.col("found"), F.col("label")), F.expr("cast(array() as array<struct<label: string, start: int, end: int, score: double>>)")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    by_text = found.groupBy("digest").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"), joined(label).alias("labels"), F.max("score").alias("score"),
        F.array_sort(F.collect_set(F.when(F.col("found"), F.struct("label", "start", "end", "score")))).alias("spans"))
    facts = met.filter("t is null").groupBy("digest").agg(F.max("n_words").cast("long").alias("n_words"), F.sum("n").alias("n")).join(by_text, "digest", "left")
    facts = facts.withColumns({"n_base": F.coalesce("n_base", F.lit(0)).cast("long"), "base_labels": F.coalesce("base_labels", F.lit("")), "labels": F.coalesce("labels", F.lit("")),
                               "score": F.coalesce("score", F.lit(0.0)), "spans": F.coalesce("spans", none)})
    facts = written(facts, "licenses-by-text")
    total = facts.agg(F.sum("n")).first()[0] or 0
    rows = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), F.monotonically_increasing_id().alias("at"))
    return attach(rows, facts, "digest", "at", total).drop("digest", "at")
