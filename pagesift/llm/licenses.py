"""License scan by diagonal voting.

Every run of ``GRAM`` words of a document that a template has is joined to its
places in the templates. A pair of places votes for the diagonal (place in the
document minus place in the template) of its document and template. Diagonals
at most ``DRIFT`` apart are merged, which bridges inserted and missing words,
and the merged spans are verified by the share of the template's runs they
hold. Votes are joined on the words themselves, so none is a hash collision.
All of it is DataFrame functions: runs no template has leave inside the row,
and what is shuffled are votes and one narrow row per document.

The base phrases are templates that must match as a whole on one diagonal.

Defined results: a null or empty text has no words and no label; rows equal in
id and text share their votes and give a row each; null ids match each other; a
label found twice is listed once; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagesift.llm.tasks import staged

GRAM = 3
DRIFT = 2
# Share of a template's runs that a span must hold.
MIN_COVERAGE = 0.6
WORD_BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices of common licenses (label, wording), in words.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"),
    ("bsd-3-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
)


def template_grams(spark: SparkSession, phrases: Mapping[str, str] = PHRASES, notices=NOTICES, gram: int = GRAM):
    """``(template, label, base, n_grams, place, gram)`` of all templates."""
    rows = []
    templates = [(label, text, True) for text, label in phrases.items()] + [(label, text, False) for label, text in notices]
    for t, (label, text, base) in enumerate(templates):
        words = text.split()
        if len(words) < gram:
            raise ValueError(f"a template has {gram} words at least: {text!r}")
        n = len(words) - gram + 1
        rows += [(t, label, base, n, i, " ".join(words[i : i + gram])) for i in range(n)]
    return spark.createDataFrame(rows, "template int, label string, base boolean, n_grams int, place int, gram string")


def scan(docs: DataFrame, grams: DataFrame, gram: int = GRAM, drift: int = DRIFT, min_coverage: float = MIN_COVERAGE):
    """``(documents, spans)``: a narrow row per document with its key and number
    of words, and a row per verified span."""
    # The templates are the user's own list, held by the driver as the query is.
    wanted = sorted({r["gram"] for r in grams.select("gram").collect()})
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    keyed = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("_text"),
        F.filter(F.split(text, WORD_BREAKS), lambda w: w != "").alias("_words"),
    )
    run = lambda i: F.concat_ws(" ", *[F.get("_words", i + k) for k in range(gram)])
    # The first words of wanted runs pick the places whose runs are spelled out.
    first = sorted({g.split()[0] for g in wanted})
    places = F.filter(
        F.sequence(F.lit(0), F.size("_words") - gram),
        lambda i: F.get("_words", i).isin(first),
    )
    hits = F.filter(F.transform(places, lambda i: F.struct(i.alias("at"), run(i).alias("gram"))), lambda x: x["gram"].isin(wanted))
    narrow = staged(
        keyed.select(
            "doc_id", "_text", F.size("_words").cast("long").alias("n_words"),
            F.when(F.size("_words") >= gram, hits).otherwise(F.array().cast("array<struct<at:int,gram:string>>")).alias("_hits"),
        ),
        "license_hits",
    )
    votes = (
        narrow.where(F.size("_hits") > 0)
        .select("doc_id", "_text", F.explode("_hits").alias("hit"))
        .select("doc_id", "_text", "hit.at", "hit.gram", F.xxhash64("hit.gram").alias("hash"))
        .join(F.broadcast(grams.withColumn("hash", F.xxhash64("gram"))), ["hash", "gram"])
        .select("doc_id", "_text", "template", "label", "base", "n_grams", "at", "place", (F.col("at") - F.col("place")).alias("diagonal"))
        .distinct()
    )
    by = ["doc_id", "_text", "template"]
    # One row per diagonal, then neighbouring diagonals in one span.
    diagonals = votes.groupBy(*by, "label", "base", "n_grams", "diagonal").agg(
        F.collect_set("place").alias("places"), F.min("at").alias("first_at"), F.max("at").alias("last_at")
    )
    ordered = Window.partitionBy(*by).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(ordered) > F.when(F.col("base"), 0).otherwise(drift)
    merged = diagonals.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("_span", F.sum("_new").over(ordered))
    held = F.size(F.array_distinct(F.flatten(F.collect_list("places"))))
    spans = merged.groupBy(*by, "label", "base", "n_grams", "_span").agg(
        held.alias("held"), F.min("first_at").cast("long").alias("start"), (F.max("last_at") + gram).cast("long").alias("end")
    )
    coverage = F.col("held") / F.col("n_grams")
    verified = spans.withColumn("coverage", coverage).where(F.when(F.col("base"), F.col("held") == F.col("n_grams")).otherwise(coverage >= min_coverage))
    return narrow.drop("_hits"), verified.select(*by, "label", "base", "start", "end", "coverage")


def judge(docs: DataFrame, grams: DataFrame | None = None) -> DataFrame:
    """One row per document: the base places and all labels."""
    grams = template_grams(docs.sparkSession) if grams is None else grams
    narrow, spans = scan(docs, grams)
    base = F.col("base")
    labels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = spans.groupBy("doc_id", "_text").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        labels(F.when(base, F.col("label"))).alias("base_labels"),
        labels("label").alias("labels"),
        F.max("coverage").alias("score"),
    )
    same = narrow["doc_id"].eqNullSafe(found["doc_id"]) & (narrow["_text"] == found["_text"])
    return narrow.join(found, same, "left").select(
        narrow["doc_id"], "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
