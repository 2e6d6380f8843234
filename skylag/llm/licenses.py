"""License scans by diagonal voting: shared word k-grams vote for the place of a template."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.llm import common
from skylag.llm.common import near_keys, row_key, text_of
from skylag.llm.registry import documents, query
from skylag.session import written

# Phrases that name a license, and the label of each.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Public license notices and the label of each.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
            "to whom the Software is furnished to do so, subject to the following conditions"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
               "file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of "
            "the GNU General Public License as published by the Free Software Foundation, either "
            "version 3 of the License, or (at your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms "
             "of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
            "without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# words of a k-gram, how far neighbouring diagonals lie apart, and the part of a template that must stand
GRAM, DRIFT, COVERED = 3, 3, 0.75
_CAPITALS = {c: c + 32 for c in range(0x41, 0x5B)}


def words_of(text: str) -> list[str]:
    """Words of a text with A-Z lower-cased; offsets in results count them from 0."""
    return WORD.findall(text.translate(_CAPITALS))


def _hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and how many words stand before each text."""
    data = common.LOWER[data]
    starts, ends = common.word_spans(common.LETTER[data], offsets)
    return common.span_hashes(data, starts, ends), common.first_word_of_texts(starts, offsets)


def _word_hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return _hashed(data, np.array([0, len(data)]))[0]


def template_grams(spark: SparkSession, templates=None, gram: int = GRAM) -> DataFrame:
    """gram, template, at: where each k-gram stands in the templates. As long as the fixed list."""
    rows = [
        (int(h), i, at)
        for i, (_, text) in enumerate(templates or TEMPLATES)
        for at, h in enumerate(common.gram_hashes(_word_hashes(text), gram).view(np.int64))
    ]
    return spark.createDataFrame(rows, "gram long, template int, at int")


def _grams(batches: Iterator[pa.RecordBatch], gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in common.blocks(*common.utf8(batch.column("text"))):
            hashes, before = _hashed(data, offsets)
            n = np.maximum(np.diff(before) - gram + 1, 0)
            all_grams = common.gram_hashes(hashes, gram)
            ends = np.cumsum(n)
            at = np.repeat(before[:-1] - (ends - n), n) + np.arange(int(n.sum()))
            lists = common.list_column(all_grams[at].view(np.int64), ends, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key").slice(first, end - first), lists], ["_key", "grams"]
            )


def _phrase_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    phrases = [(_word_hashes(p), label) for p, label in PHRASES.items()]
    for batch in batches:
        for first, end, data, offsets in common.blocks(*common.utf8(batch.column("text"))):
            hashes, before = _hashed(data, offsets)
            n = end - first
            count, low, high = np.zeros(n, np.int64), np.full(n, -1), np.full(n, -1)
            labels: list[set] = [set() for _ in range(n)]
            for phrase, label in phrases:
                found = np.ones(max(len(hashes) - len(phrase) + 1, 0), bool)
                for i, h in enumerate(phrase):
                    found &= hashes[i : len(found) + i] == h
                for at in np.flatnonzero(found).tolist():
                    doc = int(np.searchsorted(before, at, "right")) - 1
                    if at + len(phrase) <= before[doc + 1]:
                        place = at - int(before[doc])
                        count[doc] += 1
                        low[doc] = place if low[doc] < 0 else min(low[doc], place)
                        high[doc] = max(high[doc], place)
                        labels[doc].add(label)
            none = low < 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").slice(first, n), batch.column("_key").slice(first, n),
                    pa.array(np.diff(before).astype(np.int64)), pa.array(count),
                    pa.array(low.astype(np.int64), mask=none), pa.array(high.astype(np.int64), mask=none),
                    pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
                ],
                ["doc_id", "_key", "n_words", "n_base", "first_word", "last_word", "_base"],
            )


def longest_common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence; one of the two is a template."""
    best = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            kept = best[j]
            best[j] = diagonal + 1 if x == y else max(best[j], best[j - 1])
            diagonal = kept
    return best[-1]


def merged_diagonals(votes: list[tuple[int, int, int]], length: int) -> list[tuple[int, int]]:
    """(diagonal, first, last) of one template to spans (start, end) of words.

    Diagonals at most DRIFT apart, whose words lie within the template's length, are one place.
    """
    places: list[list[int]] = []
    for diagonal, first, last in sorted(votes):
        for place in places:
            if diagonal - place[0] <= DRIFT and first < place[2] + length and last > place[1] - length:
                place[:] = [diagonal, min(place[1], first), max(place[2], last)]
                break
        else:
            places.append([diagonal, first, last])
    return [(first, last + GRAM) for _, first, last in places]


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified places of templates: _key, found array of (label, start, end, covered).

    All k-grams of all texts are joined with the templates' (a fixed list of a few hundred rows).
    Matches are counted by document and diagonal, neighbouring diagonals are merged, and only
    documents with enough votes are read again: the words of each span are aligned with the
    template, of which COVERED must stand there in order.
    """
    texts = docs.select(row_key(id_col, text_col).alias("_key"), text_of(text_col).alias("text"))
    grams = texts.mapInArrow(lambda b: _grams(b, GRAM), "_key binary, grams array<long>")
    hits = (
        grams.select("_key", F.posexplode("grams").alias("pos", "gram"))
        .join(F.broadcast(template_grams(docs.sparkSession)), "gram")
        .withColumn("diagonal", F.col("pos") - F.col("at"))
    )
    # a hot diagonal is one document's, and each of its k-grams counts once
    votes = written(
        hits.groupBy("_key", "template", "diagonal")
        .agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
        .groupBy("_key").agg(F.sort_array(F.collect_set(F.struct("template", "diagonal", "first", "last"))).alias("votes")),
        "license-votes",
    )
    templates = [(label, words_of(text)) for label, text in TEMPLATES]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([
            ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.float64()),
        ]))
        for batch in batches:
            out = []
            for text, votes in zip(batch.column("text"), batch.column("votes")):
                words, by_template, found = words_of(text.as_py()), {}, []
                for v in votes.as_py():
                    by_template.setdefault(v["template"], []).append((v["diagonal"], v["first"], v["last"]))
                for i, rows in by_template.items():
                    label, template = templates[i]
                    for start, end in merged_diagonals(rows, len(template)):
                        covered = longest_common(words[start:end], template) / len(template)
                        if covered >= COVERED:
                            found.append({"label": label, "start": start, "end": end, "covered": covered})
                out.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array(out, kind)], ["_key", "found"]
            )

    return (
        near_keys(texts, "_key", votes).join(votes, "_key").select("_key", "text", "votes")
        .mapInArrow(verify, "_key binary, found array<struct<label:string,start:long,end:long,covered:double>>")
        .filter(F.size("found") > 0).dropDuplicates(["_key"])
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: what phrases name, what spans of templates prove, and a score.

    The score is the largest part of a template that stands in the text, at least 0.5 where a
    phrase names a license, and 0 without either. A null or empty text has no words; a null id is
    kept; rows that repeat id and text get equal rows; further columns are ignored.
    """
    texts = docs.select(
        F.col(id_col).alias("_id"), row_key(id_col, text_col).alias("_key"), text_of(text_col).alias("text")
    )
    id_type = docs.schema[id_col].dataType.simpleString()
    base = texts.mapInArrow(
        _phrase_rows,
        f"doc_id {id_type}, _key binary, n_words long, n_base long, first_word long, last_word long, "
        "_base array<string>",
    )
    named = F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)
    return base.join(spans(docs, id_col, text_col), "_key", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.array_union("_base", F.coalesce(F.transform("found", lambda s: s["label"]), F.array()))),
            ",",
        ).alias("labels"),
        F.greatest(named, F.coalesce(F.array_max(F.transform("found", lambda s: s["covered"])), F.lit(0.0)))
        .alias("score"),
        F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_spans"),
    )


@query("op3_license_scan")
def op3(spark, sf_dir):
    return scan(documents(spark, sf_dir))
