"""Licence scans by a positional index of licence words, with DataFrame operations alone.

Each licence has templates (its notice, the opening of its text) and key phrases.  The
templates' words, but for common ones, are indexed by place and weighted by inverse
document frequency.  Where a licence's mandatory key phrases stand in a file, all the
file's licence words are looked up in that index; a template whose words keep their
distances in the file collects their weight at one offset, and counts where it collects
enough.  What else a file says changes nothing in that.

Inverse document frequencies are counted over all files.  Beside that, plain base
phrases are found wherever their words stand in a row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewalk.llm.common import Workspace, ascii_lower

# Base phrases and their labels.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Public licences' notices and opening words, as words without case and marks.
TEMPLATES = {
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    ],
    "apache-2": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
    ],
    "gpl-2": ["licensed under the gnu general public license version 2", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license"],
    "gpl-3": ["licensed under the gnu general public license version 3", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"],
    "lgpl-3": ["licensed under the gnu lesser general public license version 3"],
    "agpl-3": ["licensed under the gnu affero general public license version 3"],
    "mpl-2": ["this source code form is subject to the terms of the mozilla public license v 2 0", "licensed under the mozilla public license version 2 0"],
    "bsd": ["licensed under the bsd license", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "isc": ["licensed under the isc license", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "cc-by": ["licensed under a creative commons attribution 4 0 international license"],
    "cc-by-sa": ["licensed under a creative commons attribution sharealike 4 0 international license", "licensed under cc by sa 4 0"],
    "cc-by-nc": ["licensed under a creative commons attribution noncommercial 4 0 international license", "licensed under cc by nc 4 0"],
    "cc0": ["to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "licensed under cc0 1 0 universal"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "all-rights-reserved": ["all rights reserved"],
}

# Of each list one alternative's phrases must all stand in the file.
KEY_PHRASES = {
    "mit": [["mit license"], ["permission is hereby granted free of charge", "the software without restriction"]],
    "apache-2": [["apache license", "version 2"], ["licenses license 2 0"]],
    "gpl-2": [["gnu general public license", "version 2"]],
    "gpl-3": [["gnu general public license", "version 3"]],
    "lgpl-3": [["gnu lesser general public license", "version 3"]],
    "agpl-3": [["gnu affero general public license", "version 3"]],
    "mpl-2": [["mozilla public license", "2 0"]],
    "bsd": [["bsd license"], ["redistribution and use in source and binary forms"]],
    "isc": [["isc license"], ["with or without fee is hereby granted"]],
    "cc-by": [["creative commons attribution 4 0"]],
    "cc-by-sa": [["creative commons attribution sharealike"], ["cc by sa"]],
    "cc-by-nc": [["creative commons attribution noncommercial"], ["cc by nc"]],
    "cc0": [["waived all copyright"], ["cc0"]],
    "unlicense": [["unencumbered software", "public domain"]],
    "all-rights-reserved": [["all rights reserved"]],
}

# Words too common to be looked up.
COMMON_WORDS = frozenset("the of to is this and or any a in by for on with be under as at it you may not are from that an all has have was into use if no other either person work file form software".split())

#: What stands between words, whatever the case.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class LicenseParams:
    """``coverage``: share of a template's weight that must stand at one offset."""

    coverage: float = 0.7


def vocabulary() -> list[str]:
    """The words that are indexed."""
    said = {w for texts in TEMPLATES.values() for t in texts for w in t.split()}
    return sorted(said - COMMON_WORDS | {"mit", "apache", "cc"})


def _once(column: Column) -> Column:
    """Computed once and kept as a column of its own, however often it is used above."""
    return F.explode(F.array(column))


def _all(conditions: list[Column]) -> Column:
    return reduce(and_, conditions)


def _any(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def _holds(padded: Column, phrase: str) -> Column:
    return padded.contains(f" {phrase} ")


def _base_places(words: Column, hits: Column) -> Column:
    """(start, label) of each place of a base phrase, by its rarest word."""

    def places(phrase: str, label: str) -> Column:
        parts = phrase.split()
        anchor = next(w for w in parts if w in ("mit", "apache", "cc"))
        k, whole = parts.index(anchor), F.array(*[F.lit(w) for w in parts])

        def stands(h: Column) -> Column:
            return (h["word"] == anchor) & (h["place"] >= k) & (F.slice(words, F.greatest(h["place"] - k + 1, F.lit(1)), len(parts)) == whole)

        return F.transform(F.filter(hits, stands), lambda h: F.struct((h["place"] - k).cast("long").alias("start"), F.lit(label).alias("label")))

    return F.concat(*[places(phrase, label) for phrase, label in BASE_PHRASES.items()])


def scan_licenses(docs: DataFrame, params: LicenseParams | None = None) -> DataFrame:
    """Base phrases and licences of all files.

    ``docs`` has ``doc_id`` and ``text`` (null: empty); other columns are not looked at.
    One row per row, repeated and null ids included: ``n_words``; ``n_base`` (all places
    of base phrases), ``first_word`` and ``last_word`` (their smallest and largest
    start, words from 0, else null); ``base_labels`` and ``labels`` (distinct, sorted,
    comma-joined, empty if none); ``score`` (0 to 1: the best verified template's share
    of weight, 1 where a base phrase stands).  An empty table gives no rows.
    """
    params = params or LicenseParams()
    spark = docs.sparkSession
    words_of = vocabulary()
    spaced = F.trim(ascii_lower(F.regexp_replace(F.coalesce("text", F.lit("")), _BETWEEN, " ")))
    text = docs.select("doc_id", _once(spaced).alias("spaced"))
    text = text.select("doc_id", "spaced", _once(F.when(F.col("spaced") == "", F.array().cast("array<string>")).otherwise(F.split("spaced", " "))).alias("words"))
    marked = F.transform("words", lambda w, i: F.when(w.isin(words_of), F.struct(w.alias("word"), i.alias("place"))))
    text = text.select("doc_id", "spaced", "words", _once(F.filter(marked, lambda h: h.isNotNull())).alias("hits"))
    phrases = sorted({p for ways in KEY_PHRASES.values() for way in ways for p in way})
    padded = F.concat(F.lit(" "), F.col("spaced"), F.lit(" "))
    held = F.array_compact(F.array(*[F.when(_holds(padded, p), F.lit(p)) for p in phrases]))
    scanned = text.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        "hits",
        F.when(F.size("hits") > 0, _base_places(F.col("words"), F.col("hits"))).alias("base"),
        F.when(F.size("hits") > 0, held).alias("phrases"),
    )
    # Written once, so that row numbers stay as they are whatever executor is lost.
    scanned = Workspace(spark, "licences").table(scanned, "scan")

    # Document frequencies: one row per indexed word.
    total = scanned.count()
    seen = scanned.where("size(hits) > 0").select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["word"]))).alias("word"))
    often = {r["word"]: r["files"] for r in seen.groupBy("word").agg(F.count("*").alias("files")).collect()}
    weight = {w: math.log(1 + (total + 1) / (often.get(w, 0) + 0.5)) for w in words_of}
    postings = [
        (w, label, k, t_place, weight[w] / sum(weight[x] for x in t.split() if x in weight))
        for label, texts in TEMPLATES.items()
        for k, t in enumerate(texts)
        for t_place, w in enumerate(t.split())
        if w in weight
    ]
    index = F.broadcast(spark.createDataFrame(postings, "word string, label string, template int, at int, share double"))

    # Licences whose key phrases stand in the file, all places of indexed words there, and the offsets that these imply.
    met = [F.when(_any([_all([F.array_contains("phrases", p) for p in way]) for way in ways]), F.lit(label)) for label, ways in KEY_PHRASES.items()]
    likely = scanned.where("size(phrases) > 0").select("row", "hits", _once(F.array_compact(F.array(*met))).alias("likely")).where("size(likely) > 0")
    looked = likely.select("row", "likely", F.inline("hits"))
    votes = looked.join(index, "word").where(F.array_contains("likely", F.col("label")))
    votes = votes.groupBy("row", "label", "template", (F.col("place") - F.col("at")).alias("offset")).agg(F.sum("share").alias("share"))
    sure = votes.where(F.col("share") >= params.coverage)
    named = sure.groupBy("row").agg(F.collect_set("label").alias("more"), F.least(F.max("share"), F.lit(1.0)).alias("best"))

    base_labels = F.array_sort(F.array_distinct(F.transform(F.coalesce("base", F.array().cast("array<struct<start:bigint,label:string>>")), lambda b: b["label"])))
    starts = F.transform("base", lambda b: b["start"])
    out = scanned.join(named, "row", "left").withColumn("own", base_labels)
    return out.select(
        "doc_id",
        "n_words",
        F.when(F.col("base").isNull(), 0).otherwise(F.size("base")).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join("own", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("own", F.coalesce("more", F.array().cast("array<string>"))))), ",").alias("labels"),
        F.when(F.size("own") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
