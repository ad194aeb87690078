"""License scans by diagonal voting.

All rolling 3-word hashes of the documents are joined to the positions of the same hashes in a few templates. A hit votes for the
diagonal (document position - template position) that it lies on. Votes of a document, template and diagonal are the set of template
positions hit, as a bit mask, so copies of a hit count once. A phrase stands consecutively where a diagonal has all its positions;
of a longer template, neighbouring diagonals are merged (words put in or left out shift the diagonal) and the merged span is verified
by the share of the template's words that it covers. Hits themselves are verified by their words, so no hash decides alone.

Only the table of template positions is broadcast; its size is that of ``PHRASES`` and ``TEMPLATES``. Documents never travel: what is
shuffled is one row per document and one per hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopmetrics.llm import alnum as A
from shopmetrics.llm import text as X
from shopmetrics.llm.store import keep, schema_with

K = 3
#: Each of these, word for word, is a base label.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
#: Of these, a span that covers the share LEAST_COVER of their words gives the label (at most 62 words each).
TEMPLATES = [
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met"),
    ("cc", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
            "as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
            "files the software to deal in the software without restriction"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("reserved", "all rights reserved no part of this publication may be reproduced"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
LEAST_COVER = 0.8
#: Diagonals no further apart than this (less than the words of any template) are one span; one of twice its template's words is none.
NEAR_DIAGONAL = 6
#: The hash that stands once in every document, so that one without hits has a row too; no word run has it.
EVERY = 0
#: A row of the documents: its id and 128 bits of its text. Rows that agree in both share their work and are counted.
ROW = ["doc_id", "t1", "t2"]


def _gram_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    h = X.gram_hashes(X.word_hashes(buf, starts, ends), K).view(np.int64)
    return np.where(h == EVERY, 1, h)


def template_rows(phrases=PHRASES, templates=TEMPLATES) -> list[tuple]:
    """(gram, template, position, words, size, label, base) of every position of every template, and the row that all documents hit."""
    out = [(EVERY, -1, 0, "", 0, "", False)]
    for t, (label, words, base) in enumerate([(*p, True) for p in phrases] + [(*p, False) for p in templates]):
        size = len(words.split(" "))
        if not K <= size <= 62:
            raise ValueError(f"a template has {K} to 62 words: {words}")
        for _, _, buf, starts, ends, _ in A.word_chunks(pa.array([words])):
            if len(starts) != size:
                raise ValueError(f"not in lower-case words with one space between: {words}")
            for i, h in enumerate(_gram_hashes(buf, starts, ends).tolist()):
                out.append((h, t, i, " ".join(words.split(" ")[i : i + K]), size, label, base))
    return out


TEMPLATE_SCHEMA = "gram long, template int, t_pos int, gram_words string, t_size int, label string, base boolean"


def _rolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of all runs of K words of each text, with the bytes that each run spans; EVERY after the last."""
    for b in batches:
        col = b.column("text")
        for lo, hi, buf, starts, ends, first in A.word_chunks(col):
            row = np.searchsorted(first, np.arange(len(starts)), side="right") - 1
            h = _gram_hashes(buf, starts, ends)
            at = np.flatnonzero(row[: len(h)] == row[K - 1 : K - 1 + len(h)]) if len(h) else np.zeros(0, np.int64)
            base = X.byte_column(col.slice(lo, hi - lo))[1]  # byte offsets of the rows in this chunk
            begin, end = starts[at] - base[row[at]], ends[at + K - 1] - base[row[at]]
            words = np.diff(first)
            size = np.maximum(words - K + 1, 0)
            stop = np.cumsum(size)
            offsets = pa.array(np.concatenate([[0], stop + np.arange(1, hi - lo + 1)]), pa.int32())
            grams, begin, end = np.insert(h[at], stop, EVERY), np.insert(begin, stop, 0), np.insert(end, stop, 0)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).slice(lo, hi - lo) for c in ("doc_id", "t1", "t2")), col.slice(lo, hi - lo).cast(pa.binary()),
                 pa.array(words, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(grams, pa.int64())),
                 pa.ListArray.from_arrays(offsets, pa.array(begin, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(end, pa.int32()))],
                ["doc_id", "t1", "t2", "bytes", "n_words", "grams", "begin", "end"])


def diagonals(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, template, diagonal, mask, low, high, n, n_words, t_size, label, base): the votes; template -1 is a document's own row,
    where n counts the rows with that id and text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).select("doc_id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(13), "text").alias("t2"), "text")
    schema = schema_with(rows.select(*ROW), "bytes binary, n_words long, grams array<long>, begin array<int>, end array<int>")
    runs = rows.mapInArrow(_rolled, schema).select(*ROW, "bytes", "n_words", "begin", "end", F.posexplode("grams").alias("pos", "gram"))
    hits = runs.join(F.broadcast(templates), "gram")
    own = F.expr("substring(bytes, begin[pos] + 1, end[pos] - begin[pos])").cast("string")
    hits = hits.where((F.col("template") < 0) | (F.regexp_replace(F.lower(own), A.SEPARATORS, " ") == F.col("gram_words")))
    return hits.groupBy(*ROW, "template", "t_size", "label", "base",
                        F.when(F.col("template") < 0, 0).otherwise(F.col("pos") - F.col("t_pos")).alias("diagonal")).agg(
        F.bit_or(F.expr("shiftleft(1L, t_pos)")).alias("mask"), F.min("pos").alias("low"), F.max("pos").alias("high"),
        F.count(F.lit(1)).alias("n"), F.max("n_words").alias("n_words"))


def covered(mask: str) -> Column:
    """Words of a template that the hits of a mask cover."""
    return F.bit_count(F.expr(" | ".join(f"shiftleft({mask}, {j})" for j in range(K))))


def spans(votes: DataFrame) -> DataFrame:
    """Verified and other spans of the templates: (doc_id, t1, t2, label, base, start, cover), words from 0."""
    real = votes.where("template >= 0")
    exact = real.where("base").where(F.bit_count("mask") == F.col("t_size") - (K - 1)).select(
        *ROW, "label", "base", F.col("diagonal").cast("long").alias("start"), F.lit(1.0).alias("cover"))
    in_turn = Window.partitionBy(*ROW, "template").orderBy("diagonal")
    far = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(in_turn) > NEAR_DIAGONAL).cast("int"), F.lit(0))
    merged = real.where("NOT base").withColumn("far", far).withColumn("turn", F.sum("far").over(in_turn)) \
        .groupBy(*ROW, "template", "label", "base", "t_size", "turn").agg(
            F.bit_or("mask").alias("mask"), F.min("low").cast("long").alias("start"), (F.max("high") + K).cast("long").alias("stop")) \
        .where(F.col("stop") - F.col("start") <= 2 * F.col("t_size"))
    return exact.unionByName(merged.select(*ROW, "label", "base", "start", (covered("mask") / F.col("t_size")).alias("cover")))


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of ``docs`` (doc_id, text; others are not read).

    ``score`` is the greatest share of a template's words that a span covers (1 with a base phrase, 0 without any run of 3 words in
    common). A null text is empty. Rows that repeat an id and its text have equal rows each, rows that repeat an id with another text
    rows of their own, a null id too."""
    spark: SparkSession = docs.sparkSession
    votes = keep(diagonals(docs, spark.createDataFrame(template_rows(phrases, templates), TEMPLATE_SCHEMA)), "votes")
    every = votes.where("template < 0").select(*ROW, "n", "n_words")
    named = every.unionByName(spans(votes), allowMissingColumns=True).groupBy(*ROW).agg(
        F.max("n").alias("n"), F.max("n_words").alias("n_words"), F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"), F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        F.collect_set(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        F.collect_set(F.when(F.col("cover") >= LEAST_COVER, F.col("label"))).alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"))
    return named.select("doc_id", "n_words", "n_base", "first_word", "last_word", *(
        F.array_join(F.array_sort(c), ",").alias(c) for c in ("base_labels", "labels")), "score",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")).drop("copy")
