"""License scans by diagonal voting.

Every rolling word pair of the corpus, hashed, is joined to the positions of
the same pair in the license templates; the templates are a few hundred rows
(checked), so that side is broadcast, and the join compares both words, not
only their hash.  A hit votes for its diagonal, the word position less the
template position; votes are counted by (document, template, diagonal).

A base phrase is found where all its pairs stand on one diagonal.

A notice is found where its pairs stand in their order, from one to the next
at most ``DRIFT`` words put in or left out.  Its score is the share of the
template's pairs in the longest such run; one of ``ACCEPT`` or more gives the
notice's own label, of a notice of fewer than ``LONG`` pairs, where a version
is a word or two, only 1.  A run changes its diagonal by at most DRIFT at a
step, so it stays inside one span of neighbouring diagonals: those no more than
DRIFT apart are merged, spans that hold too few *different* template positions
go, and the few that are left are verified word by word for the longest run.

Nulls: a null text has no words and no labels (empty strings, score 0, first
and last null); a null doc_id stays.  Rows alike in doc_id and text share
their hits and each have a row.  An empty table gives an empty result.  Other
columns are ignored.  A span's hits are one array, bounded by the words of one
text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import ASCII_FOLD, ASCII_LOWER, ASCII_UPPER, row_key

#: Words are runs of ASCII letters, digits and everything beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Well-known notices and the labels that this method adds.
NOTICES = [
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license", "apache-2.0"),
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit-notice"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ("licensed under the gnu general public license version 2", "gpl-2.0"),
    ("redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl-notice"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa-4.0"),
    ("cc0 1 0 universal public domain dedication", "cc0-1.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]
ACCEPT, LONG = 0.8, 12
#: Words put in or left out between two pairs, at most.
DRIFT = 3
#: Templates' words in all; what is broadcast is no larger.
MOST_TEMPLATE_WORDS = 20_000


def words(text: Column) -> Column:
    folded = F.translate(F.coalesce(text.cast("string"), F.lit("")), ASCII_UPPER, ASCII_LOWER)
    return F.filter(F.split(folded, SEPARATORS), lambda w: w != "")


def _pair_hash(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def _template_pairs(docs: DataFrame, base: list[tuple[str, str]], notices: list[tuple[str, str]]) -> DataFrame:
    rows = []
    for number, (phrase, label) in enumerate(base + notices):
        ws = [w for w in re.split(SEPARATORS, phrase.translate(ASCII_FOLD)) if w]
        if len(ws) < 2:
            raise ValueError(f"a template needs two words or more: {phrase!r}")
        rows += [(number, label, number < len(base), len(ws) - 1, i, a, b) for i, (a, b) in enumerate(zip(ws, ws[1:]))]
    if len(rows) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MOST_TEMPLATE_WORDS} words; raise the limit only if they can be broadcast")
    made = docs.sparkSession.createDataFrame(rows, "template int, label string, is_base boolean, n_pairs int, at int, ta string, tb string")
    return made.withColumn("th", _pair_hash(F.col("ta"), F.col("tb")))


def longest_run(at: list[int], pos: list[int], drift: int = DRIFT) -> tuple[int, int, int]:
    """(pairs, first word, word after the last) of the longest run of hits (at, pos): both ascend, and by nearly as much."""
    hits = sorted(zip(pos, at))
    reach = max(at) - min(at) + drift  # no step is longer
    best, length, begin, low = (0, 0, 0), [], [], 0
    for i, (p, a) in enumerate(hits):
        while p - hits[low][0] > reach:
            low += 1
        n, start = 1, p
        for j in range(low, i):
            q, b = hits[j]
            if q < p and b < a and abs(p - q - a + b) <= drift and length[j] >= n:
                n, start = length[j] + 1, begin[j]
        length.append(n), begin.append(start)
        best = max(best, (n, -start, p + 2))
    return best[0], -best[1], best[2]


def _verified(found: DataFrame) -> DataFrame:
    """(key, template, label, is_base, start, end, score) of candidate spans (key, template, label, n_pairs, need, hits)."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, of, need = (batch.column(c).to_pylist() for c in ("hits", "n_pairs", "need"))
            runs = [longest_run([h["at"] for h in x], [h["pos"] for h in x]) for x in hits]
            ok = [i for i, r in enumerate(runs) if r[0] >= need[i]]
            some = batch.take(pa.array(ok, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [some.column("key"), some.column("template"), some.column("label"), pa.array([False] * len(ok), pa.bool_()), pa.array([runs[i][1] for i in ok], pa.int32()), pa.array([runs[i][2] for i in ok], pa.int32()), pa.array([runs[i][0] / of[i] for i in ok], pa.float64())],
                names=["key", "template", "label", "is_base", "start", "end", "score"],
            )

    return found.mapInArrow(over, "key binary, template int, label string, is_base boolean, start int, end int, score double")


def spans(docs: DataFrame, base: list[tuple[str, str]] = BASE, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """(key, template, label, is_base, start, end, score): verified spans, words from ``start`` up to ``end``.

    key is row_key(doc_id, text).  Of a notice the longest run of each span is given.
    """
    pairs = _template_pairs(docs, base, notices)
    rolling = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), words(F.col("text")).alias("ws"))
    rolling = rolling.filter(F.size("ws") > 1).select("key", F.inline(F.transform(
        F.sequence(F.lit(0), F.size("ws") - 2),
        lambda i: F.struct(i.alias("pos"), F.get(F.col("ws"), i).alias("a"), F.get(F.col("ws"), i + 1).alias("b")),
    )))
    hits = rolling.join(F.broadcast(pairs), (_pair_hash(F.col("a"), F.col("b")) == F.col("th")) & (F.col("a") == F.col("ta")) & (F.col("b") == F.col("tb")))
    by = ["key", "template", "label", "is_base", "n_pairs"]
    # a set: rows alike in doc_id and text give the same hits
    diagonals = hits.groupBy(*by, (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.collect_set("at").alias("ats"))
    exact = diagonals.filter("is_base and size(ats) = n_pairs").select("key", "template", "label", "is_base", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("n_pairs") + 1).alias("end"), F.lit(1.0).alias("score"))
    order = Window.partitionBy("key", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT, F.lit(True))
    merged = diagonals.filter("not is_base").withColumn("span", F.when(apart, F.col("diagonal")))
    merged = merged.withColumn("span", F.last("span", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    votes = F.collect_list(F.transform("ats", lambda a: F.struct(a.alias("at"), (F.col("diagonal") + a).alias("pos"))))
    whole = merged.groupBy("key", "template", "label", "n_pairs", "span").agg(F.flatten(votes).alias("hits"))
    need = F.when(F.col("n_pairs") < LONG, F.col("n_pairs")).otherwise(F.ceil(F.lit(ACCEPT) * F.col("n_pairs"))).cast("int")
    some = whole.withColumn("need", need).filter(F.size(F.array_distinct(F.transform("hits", lambda h: h["at"]))) >= F.col("need"))
    return exact.unionByName(_verified(some.select("key", "template", "label", "n_pairs", "need", "hits")))


def scan(docs: DataFrame, base: list[tuple[str, str]] = BASE, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    mine = F.when(F.col("is_base"), F.col("start"))
    label = F.when(F.col("is_base"), F.col("label"))
    per_text = spans(docs, base, notices).groupBy("key").agg(
        F.count(mine).alias("n_base"), F.min(mine).cast("bigint").alias("first_word"), F.max(mine).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(label)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"),
    )
    rows = docs.select("doc_id", F.size(words(F.col("text"))).cast("bigint").alias("n_words"), row_key(F.col("doc_id"), F.col("text")).alias("key"))
    return rows.join(per_text, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
