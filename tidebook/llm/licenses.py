"""License scan by a positional index of rare license words; DataFrame operations only.

Two answers for each text. The base: places where a fixed phrase's words stand
consecutively. The method: the text's license words, all of them and weighted by inverse
document frequency (counted over the whole corpus), look up the postings of notice templates;
hits of one template vote for the relative position at which the notice would start; the best
alignment's share of the template's weight is the score; and a label counts only if a
mandatory key phrase of it stands in the text. Texts are split once; their license words
with places are written to the shared folder.

Words are runs of ASCII letters and digits and of all non-ASCII characters, A-Z lower-cased.
Null and blank texts have no words. Repeated rows each get their result; ids may be null or
repeat. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm import _shared

#: Base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notices (label, text): what license headers usually say, in words as the scan splits them.
NOTICES = (
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "available under cc by 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights cc0 1 0 universal public domain dedication"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
#: Mandatory key phrases: a label needs one of them.
KEYS = {
    "gpl": ("gnu general public license",), "lgpl": ("gnu lesser general public license", "gnu library general public license"), "agpl": ("gnu affero general public license",),
    "apache": ("apache license", "apache org licenses"), "mit": ("mit license", "permission is hereby granted free of charge"), "bsd": ("redistribution and use in source and binary forms",),
    "isc": ("permission to use copy modify and or distribute this software",), "mpl": ("mozilla public license",), "epl": ("eclipse public license",),
    "cc-by": ("creative commons attribution", "cc by"), "cc-by-sa": ("creative commons attribution sharealike", "cc by sa"), "cc0": ("cc0", "waived all copyright"),
    "unlicense": ("free and unencumbered software",),
}
#: Words of notices that say nothing about licenses.
PLAIN = frozenset("a all and any are as at available by can files for form forms free has in into is it may not of on or org public person program source that the this to under use used v with work www you your 0 1 2 3 4".split())
#: The share of a notice's weight that must align.
ALIGNED = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    """The text's words, joined and surrounded by single spaces; one space if there are none."""
    spaced = F.regexp_replace(F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" ")), _OTHER, " ")
    return F.translate(spaced, _UPPER, _LOWER)


def _starts(phrase: str, label: str) -> str:
    """SQL: (start, label) of each place where the phrase's words stand consecutively in array w."""
    words = phrase.split()
    here = " and ".join(f"get(w, i{f' + {k}' if k else ''}) = '{x}'" for k, x in enumerate(words))
    all_ = f"transform(filter(sequence(0, size(w) - 1), i -> {here}), i -> struct(cast(i as long) as start, '{label}' as label))"
    return f"case when contains(t, ' {phrase} ') then {all_} else array() end"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, places (array of (start, label): base phrases), found (labels that the method confirms), score.

    ``score`` is the method's own: the best share of a notice that aligns, of the labels whose key phrase stands in the text.
    """
    vocabulary = sorted({w for _, text in NOTICES for w in text.split()} - PLAIN)
    known = F.array(*[F.lit(x) for x in vocabulary])
    labels = "array<string>"
    t = docs.select(F.col(id_col).cast("long").alias("doc_id"), plain_words(F.col(text_col)).alias("t"))
    w = t.withColumn("w", F.split(F.trim("t"), " ")).withColumn("rare", F.array_intersect("w", known))
    keys = F.array(*[F.struct(F.lit(f" {p} ").alias("phrase"), F.lit(label).alias("label")) for label, phrases in KEYS.items() for p in phrases])
    verified = F.array_distinct(F.transform(F.filter(keys, lambda x: F.contains(F.col("t"), x["phrase"])), lambda x: x["label"]))
    places = F.flatten(F.array(*[F.expr(_starts(p, label)).cast("array<struct<start:long,label:string>>") for p, label in PHRASES.items()]))
    at = F.filter(F.transform("w", lambda x, i: F.struct(x.alias("word"), i.alias("pos"))), lambda x: x["word"].isin(vocabulary))
    some = F.size("rare") > 0
    # the texts are split once; what the index needs of them is written
    scanned = w.select(
        "doc_id", F.when(F.col("t") == " ", F.lit(0)).otherwise(F.size("w")).cast("long").alias("n_words"), places.alias("places"), "rare",
        F.when(some, verified).otherwise(F.array().cast(labels)).alias("verified"), F.when(some, at).otherwise(F.array().cast("array<struct<word:string,pos:int>>")).alias("at"),
    )
    scanned = _shared.written(scanned, "scanned").select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))

    # document frequencies over the whole corpus: a row for each license word
    rows = scanned.count()
    df = {r["word"]: r["n"] for r in scanned.select(F.explode("rare").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    idf = {x: math.log(1 + (rows + 1) / (df.get(x, 0) + 1)) for x in vocabulary}

    # the index: word -> (notice, position), with each word's share of its notice's weight
    postings, whole = [], {}
    for k, (label, text) in enumerate(NOTICES):
        for place, x in enumerate(text.split()):
            if x in idf:
                postings.append((x, k, label, place, idf[x]))
                whole[k] = whole.get(k, 0.0) + idf[x]
    index = docs.sparkSession.createDataFrame([(x, k, label, place, v / whole[k]) for x, k, label, place, v in postings], "word string, notice int, label string, place int, share double")

    # hits of one notice vote for the place where it would begin
    hits = scanned.filter(F.size("verified") > 0).select("file", "row", "verified", F.inline("at"))
    votes = hits.join(F.broadcast(index), "word").filter(F.array_contains("verified", F.col("label")))  # len(NOTICES) notices of some words each
    votes = votes.groupBy("file", "row", "notice", "label", (F.col("pos") - F.col("place")).alias("begin")).agg(F.least(F.lit(1.0), F.sum("share")).alias("score"))
    best = votes.groupBy("file", "row").agg(F.collect_set(F.when(F.col("score") >= ALIGNED, F.col("label"))).alias("found"), F.max("score").alias("score"))  # a text's labels
    out = scanned.join(best, ["file", "row"], "left")
    return out.select("doc_id", "n_words", "places", F.array_sort(F.coalesce("found", F.array().cast(labels))).alias("found"), F.coalesce("score", F.lit(0.0)).alias("score"))
