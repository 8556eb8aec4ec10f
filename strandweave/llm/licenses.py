"""Licence scans through a positional rare-token index.

Of each file the licence words (words of any template) are kept with their
places; they are counted over all files.  A file's words with the highest
inverse document frequency are looked up: those that are the rarest of a
template's key phrase.  Each gives the template's place in the file, where the
key phrase is verified and the template's postings (place, word) are
intersected with the file's, less the template's place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandweave.llm.common import cut, row_key, small, stored, words
from strandweave.llm.positional import KEY, rarest_terms

#: Phrases whose places are all counted, with their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label, template, mandatory key phrase within it.
TEMPLATES = [
    ("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    ("apache", "licensed under the apache license version 2 0", "apache license version"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "unless required by applicable law or agreed to in writing"),
    ("apache", "you may not use this file except in compliance with the license", "use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "may be used to endorse or promote products derived from this software"),
    ("cc-by", "licensed under cc by 4 0", "licensed under cc by"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "licensed under cc by nc"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("mit", "released under the mit license", "under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "shall be included in all copies or substantial portions of the software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software released into the public domain"),
]
#: Least share of a template's words that must stand at their relative positions.
MIN_SHARE = 0.8

_PHRASE = T.StructType(
    [
        T.StructField("phrase_id", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("base", T.BooleanType()),
        T.StructField("terms", T.ArrayType(T.StringType())),
        T.StructField("template", T.ArrayType(T.StringType())),
        T.StructField("key_at", T.IntegerType()),
    ]
)


def phrase_rows(base=BASE, templates=TEMPLATES) -> list[tuple]:
    rows = [(f"base{i}", label, True, p.split(), p.split(), 0) for i, (p, label) in enumerate(base.items())]
    for i, (label, template, key) in enumerate(templates):
        t, k = template.split(), key.split()
        at = next(j for j in range(len(t) - len(k) + 1) if t[j : j + len(k)] == k)
        rows.append((f"template{i}", label, False, k, t, at))
    return rows


def licence_words(docs: DataFrame, templates: list[tuple]) -> DataFrame:
    """doc_id, row_hash, row_chars, n_words and hits (at, term), the licence words in order, of each row of ``docs``, stored."""
    terms = sorted({t for _, _, _, key, template, _ in templates for t in key + template})
    split = docs.select("doc_id", *row_key("doc_id", "text"), words(F.col("text")).alias("words"))
    placed = F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("term")))
    hits = F.filter(placed, lambda x: x["term"].isin(terms))
    return stored(split.select("doc_id", *KEY, F.size("words").cast("long").alias("n_words"), hits.alias("hits")), "licence-words")


def places(files: DataFrame, templates: list[tuple]) -> DataFrame:
    """Where ``templates`` stand in ``files``, as ``licence_words`` makes them.

    One row per place with its key phrase: row_hash, row_chars, phrase_id,
    label, base, start (of the key phrase, words from 0), share (of the
    template's words that stand at their relative positions).
    """
    phrases = files.sparkSession.createDataFrame(templates, _PHRASE)
    held = files.select(F.explode(F.array_distinct(F.transform("hits", lambda x: x["term"]))).alias("term"))
    in_files = held.groupBy("term").agg(F.count(F.lit(1)).alias("postings"))
    ranked = rarest_terms(phrases, in_files, keep=1).withColumn("anchor", F.col("anchors")[0])
    looked_up = cut(ranked.select("*", F.col("anchor.term").alias("word"), F.col("anchor.at").alias("in_key")).drop("anchor", "anchors"))
    rarest = [r["word"] for r in looked_up.select("word").distinct().collect()]  # one for each template at most
    wide = max(len(t) for *_, t, _ in templates)
    at_rarest = F.filter(F.sequence(F.lit(0), F.size("hits") - 1), lambda k: F.get("hits", k)["term"].isin(rarest))
    # only the neighbours of a rarest word go on; the words of a template that stands here are among them
    near = F.transform(at_rarest, lambda k: F.struct(F.least(k, F.lit(wide)).alias("k"), F.slice("hits", F.greatest(k - wide, F.lit(0)) + 1, F.lit(2 * wide + 1)).alias("hits")))
    found = (
        files.where("size(hits) > 0")
        .select(*KEY, F.inline(near))
        .withColumn("hit", F.get("hits", "k"))
        .join(small(looked_up), F.col("hit.term") == F.col("word"))
        .withColumn("start", F.col("hit.at") - F.col("in_key"))
        .withColumn("own", F.when(F.col("k") >= F.col("in_key"), F.slice("hits", F.col("k") - F.col("in_key") + 1, F.size("terms"))))
        .where("size(own) = size(terms) and own[0].at = start and own[size(own) - 1].at = start + size(own) - 1")
        .where(F.transform("own", lambda x: x["term"]) == F.col("terms"))
    )
    postings = F.transform("template", lambda t, j: F.struct((j + F.col("start") - F.col("key_at")).alias("at"), t.alias("term")))
    around = F.slice("hits", F.greatest(F.col("k") - F.col("key_at") - F.col("in_key"), F.lit(0)) + 1, F.size("template"))
    share = F.size(F.array_intersect(around, postings)) / F.size("template")
    return found.select(*KEY, "phrase_id", "label", "base", "start", share.alias("share"))


def scan(docs: DataFrame, base=BASE, templates=TEMPLATES, min_share: float = MIN_SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the largest share of a template that stands in the text, 1
    for a base phrase, 0 if nothing is found.  Null text is empty; a null
    doc_id is kept; rows with the same doc_id and text have the same result,
    once for each of them.
    """
    rows = phrase_rows(base, templates)
    files = licence_words(docs, rows)
    base_place = F.when(F.col("base"), F.col("start"))
    kept = F.col("base") | (F.col("share") >= min_share)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = (
        places(files, rows)
        .distinct()  # rows that are repeated have the same places
        .groupBy(*[F.col(c).alias(f"f_{c}") for c in KEY])
        .agg(
            F.count(base_place).alias("n_base"),
            F.min(base_place).cast("long").alias("first_word"),
            F.max(base_place).cast("long").alias("last_word"),
            joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
            joined(F.when(kept, F.col("label"))).alias("labels"),
            F.max(F.when(kept, F.col("share"))).alias("score"),
        )
    )
    return files.select("doc_id", *KEY, "n_words").join(small(cut(found)), [F.col(c) == F.col(f"f_{c}") for c in KEY], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
    )
