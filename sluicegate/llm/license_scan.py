"""License notices by diagonal voting (DataFrame expressions only).

Every k-gram of words of a text is hashed and joined to the places where the same k-gram stands in a
license template. A notice that follows a template votes for one diagonal (place in text minus place
in template); an added or missing word moves it to a neighbouring one, so diagonals that lie close are
merged. A merged span is verified by the share of the template's k-grams it covers and by its length.

The templates are a parameter and the only broadcast side: its rows are the k-grams of the templates.
Hits are few beside the words, and only hits are shuffled, by the row they belong to.

Nulls and empty texts have no words, no labels and score 0. Repeated rows are scanned one by one and
each gives its row. Columns of the input beyond ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Base phrases, and notice texts as their licenses give them (words, lower case).
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "all rights reserved"),
)

K = 3
GAP = 2
MIN_COVER = 0.7
MAX_STRETCH = 2.0
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KELVIN = "\u212a"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased for word matching: ``lower`` is fast, and only the Kelvin sign would become an ASCII letter."""
    return F.when(F.contains(text, F.lit(KELVIN)), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS), "")


def template_grams(spark: SparkSession, templates: Sequence[tuple[str, str]], k: int) -> DataFrame:
    """One row per template and place: hash of the k-gram, label, template number, place, number of places."""
    listed = [
        F.struct(F.lit(label).alias("label"), F.lit(number).alias("template"), F.split(F.lit(notice), " ").alias("words"))
        for number, (label, notice) in enumerate(templates)
    ]
    rows = spark.range(1).select(F.inline(F.array(*listed)))
    places = F.size("words") - k + 1
    zipped = F.arrays_zip(*[F.slice("words", j + 1, places).alias(f"w{j}") for j in range(k)])
    grams = rows.select("label", "template", places.alias("places"), F.posexplode(zipped).alias("place", "g"))
    gram = F.xxhash64(*[F.col("g").getField(f"w{j}") for j in range(k)])
    return grams.select(gram.alias("gram"), "label", "template", "place", "places")


def _places(words: Column, phrase: str) -> Column:
    parts = phrase.split()

    def stands_at(i: Column) -> Column:
        match = F.get(words, i) == parts[0]
        for j, part in enumerate(parts[1:], 1):
            match = match & F.coalesce(F.get(words, i + j) == part, F.lit(False))
        return match

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), stands_at)


def scan(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    k: int = K,
    gap: int = GAP,
    min_cover: float = MIN_COVER,
    max_stretch: float = MAX_STRETCH,
) -> DataFrame:
    """One row per row of ``docs``: base phrases, labels, score and the verified spans (words, end exclusive)."""
    spark = docs.sparkSession
    grams = template_grams(spark, templates, k)
    text = F.coalesce(F.col("text"), F.lit(""))
    # A text that holds none of the phrases' longest words holds no phrase.
    longest = sorted({max(reversed(phrase.split()), key=len) for _, phrase in phrases})
    rows = docs.select("doc_id", text.alias("text")).select(
        F.monotonically_increasing_id().alias("rid"),
        "doc_id",
        words_of(F.col("text")).alias("words"),
        reduce(or_, [F.contains(lower_ascii(F.col("text")), F.lit(word)) for word in longest]).alias("has_base"),
    )
    none = F.array().cast("array<int>")
    found = rows.select(
        "rid",
        "doc_id",
        "words",
        *[
            F.when(F.col("has_base") & (F.size("words") > 0), _places(F.col("words"), phrase)).otherwise(none).alias(f"at_{label}")
            for label, phrase in phrases
        ],
    )
    starts = F.concat(*[F.col(f"at_{label}") for label, _ in phrases])
    thin = found.select(
        "rid",
        "doc_id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_compact(
            F.array(*[F.when(F.size(f"at_{label}") > 0, F.lit(label)) for label, _ in phrases])
        ).alias("base"),
    )
    kept = ["rid", "doc_id", "n_words", "n_base", "first_word", "last_word", "base"]
    n_grams = F.greatest(F.size("words") - k + 1, F.lit(0))
    zipped = F.arrays_zip(*[F.slice("words", j + 1, n_grams).alias(f"w{j}") for j in range(k)])
    # The outer form keeps a row for texts shorter than k words.
    exploded = thin.select(*kept, F.posexplode_outer(zipped).alias("i", "g"))
    hashed = exploded.select(*kept, "i", F.xxhash64(*[F.col("g").getField(f"w{j}") for j in range(k)]).alias("gram"))
    voted = (
        hashed.join(F.broadcast(grams), "gram", "left")
        .where(F.col("template").isNotNull() | F.coalesce(F.col("i"), F.lit(0)).eqNullSafe(0))
        .withColumn("diagonal", F.col("i") - F.col("place"))
        .repartition("rid")
    )
    by_diagonal = voted.groupBy(*kept, "template", "label", "places", "diagonal").agg(
        F.count("template").alias("votes"),
        F.collect_set("place").alias("covered"),
        F.min("i").alias("first_i"),
        F.max("i").alias("last_i"),
    )
    order = Window.partitionBy("rid", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > gap, F.lit(False))
    merged = (
        by_diagonal.withColumn("apart", apart.cast("int"))
        .withColumn("span", F.sum("apart").over(order))
        .groupBy(*kept, "template", "label", "places", "span")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("n_covered"),
            F.min("first_i").alias("start"),
            (F.max("last_i") + k).alias("end"),
        )
    )
    cover = F.col("n_covered") / F.col("places")
    stretch = (F.col("end") - F.col("start")) / (F.col("places") + (k - 1))
    verified = F.col("template").isNotNull() & (cover >= min_cover) & (stretch <= max_stretch)
    by_row = merged.groupBy(*kept).agg(
        F.collect_set(F.when(verified, F.col("label"))).alias("added"),
        F.coalesce(F.max(cover), F.lit(0.0)).alias("best"),
        F.sort_array(F.collect_list(F.when(verified, F.struct("start", "end", "label")))).alias("notices"),
    )
    return by_row.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", "added")), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.col("best")).alias("score"),
        "notices",
    )
