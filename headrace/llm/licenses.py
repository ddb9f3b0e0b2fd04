"""License scans: phrases, and blocks that contain the words of a license notice.

A block is a line and the ``WRAPPED`` - 1 lines behind it, from each line on, as notices are
wrapped. A notice is found in a block that holds at least nine tenths of the notice's distinct
words. That is an exact set-similarity join: the words of all notices are
counted over all blocks and put in order, rarest first; a block can only reach the threshold
if it holds one of the first words of the notice, has enough words, and has enough left
behind the place of a shared word in either order; the overlap of what remains is counted.

Everything is DataFrame and SQL functions. Null text has no words. Repeated rows give
repeated results, an empty table an empty one, and only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm import frames

# Fixed values of the contract: phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Notices of public licenses, as words.
NOTICES = {
    "agpl": "under the terms of the gnu affero general public license",
    "apache-2.0": "licensed under the apache license version 2 0",
    "boost": "distributed under the boost software license version 1 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "gpl": "this work is licensed under the gnu general public license version 3",
    "gpl-text": "this program is free software you can redistribute it and or modify it under the terms of the "
    "gnu general public license as published by the free software foundation",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee "
    "is hereby granted",
    "lgpl": "under the terms of the gnu lesser general public license",
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "zlib": "this software is provided as is without any express or implied warranty",
}
PERCENT = 90
WRAPPED = 4  # lines of a block: enough for the longest notice, begun in the middle of a line

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NOT_WORD = "[\\\\x00-\\\\x2F\\\\x3A-\\\\x60\\\\x7B-\\\\x7F]+"


def _strings(values) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _needed(size: int) -> int:
    return -(-size * PERCENT // 100)


def places(docs: DataFrame, vocabulary: list[str], least: int) -> DataFrame:
    """Per document its words, the places of phrases, and the notice words of each block that has
    as many as ``least``."""
    lines = (
        frames.texts(docs)
        .withColumn("row", F.monotonically_increasing_id())
        .selectExpr(
            "row", "doc_id",
            f"transform(split(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '\\n'), "
            f"x -> array_remove(split(x, '{NOT_WORD}'), '')) as lines",
        )
    )
    # Every word stands between spaces of its own, so that neighbours share none.
    words = lines.selectExpr(
        "row", "doc_id",
        f"transform(lines, x -> array_intersect(x, {_strings(vocabulary)})) as known",
        "flatten(lines) as w",
    ).selectExpr(
        "row", "doc_id",
        f"filter(transform(known, (x, i) -> array_distinct(flatten(slice(known, i + 1, {WRAPPED})))), "
        f"x -> size(x) >= {least}) as blocks",
        "size(w) as n_words",
        "if(size(w) = 0, '', concat(' ', array_join(w, '  '), ' ')) as spaced",
    )
    count = "char_length({0}) - char_length(replace({0}, ' ', ''))"
    each = []
    for k, phrase in enumerate(PHRASES):
        spaced = " " + phrase.replace(" ", "  ") + " "
        before = count.format(f"substring_index(spaced, '{spaced}', 1)")
        behind = count.format(f"substring_index(spaced, '{spaced}', -1)")
        words = words.withColumn(
            f"n{k}", F.expr(f"(char_length(spaced) - char_length(replace(spaced, '{spaced}', ''))) div {len(spaced)}")
        )
        each.append(
            f"if(n{k} = 0, null, named_struct('first', ({before}) div 2, "
            f"'last', n_words - ({behind}) div 2 - {len(phrase.split())}))"
        )
    n_each = [f"n{k}" for k in range(len(PHRASES))]
    labels = ", ".join(f"if(n{k} > 0, '{label}', null)" for k, label in enumerate(PHRASES.values()))
    return words.selectExpr(
        "row", "doc_id", "blocks", "cast(n_words as long) as n_words",
        f"cast({' + '.join(n_each)} as long) as n_base",
        f"array({', '.join(each)}) as found",
        f"array_compact(array({labels})) as base",
    ).selectExpr(
        "row", "doc_id", "blocks", "n_words", "n_base",
        "cast(array_min(transform(found, x -> x.first)) as long) as first_word",
        "cast(array_max(transform(found, x -> x.last)) as long) as last_word",
        "base",
    )


def _order(blocks: DataFrame, vocabulary: list[str]) -> list[str]:
    """The notice words, rarest first over all blocks. As many rows as the notices have words."""
    counted = blocks.select(F.explode("tokens").alias("word")).groupBy("word").count()
    n = {r["word"]: r["count"] for r in counted.collect()}
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def matches(blocks: DataFrame, notices: dict[str, str], order: list[str]) -> DataFrame:
    """``row``, ``label`` and ``share`` of every block that meets a notice's threshold.

    ``blocks`` has a ``row`` and ``tokens``, its distinct words among those of the notices.
    """
    spark, place = blocks.sparkSession, {w: i for i, w in enumerate(order)}
    index = []
    for label, text in notices.items():
        words = sorted(set(text.split()), key=place.__getitem__)
        need = _needed(len(words))
        for at, word in enumerate(words[: len(words) - need + 1]):
            index.append((word, label, at, len(words), need, words))
    prefix = F.broadcast(  # a row for each prefix word of each notice
        spark.createDataFrame(index, "word string, label string, at int, size int, need int, words array<string>")
    )
    ranks = "map(" + ", ".join(f"'{w}', {i}" for w, i in place.items()) + ")"
    firsts = _strings(sorted({row[0] for row in index}))
    least = min(row[4] for row in index)
    return (
        blocks.where(f"size(tokens) >= {least} and arrays_overlap(tokens, {firsts})")
        .selectExpr("row", f"transform(array_sort(transform(tokens, x -> struct({ranks}[x] as r, x as x))), x -> x.x) as b")
        .selectExpr("row", "b", "posexplode(b) as (place, word)")
        .join(prefix, "word")
        .where("size(b) >= need and least(size - at, size(b) - place) >= need")
        .selectExpr("row", "label", "b", "words", "size", "need", "size(array_intersect(b, words)) as shared")
        .where("shared >= need")
        .selectExpr("row", "label", "shared / size as share")
    )


def scan(docs: DataFrame, notices: dict[str, str] | None = None) -> DataFrame:
    """Places of the base phrases, and the labels of phrases and notices, of every document.

    ``score`` is 1 where a phrase stands, else the largest share of a notice that a block
    holds, else 0.
    """
    notices = NOTICES if notices is None else notices
    vocabulary = sorted({w for text in notices.values() for w in text.split()})
    least = min((_needed(len(set(text.split()))) for text in notices.values()), default=1)
    with frames.scratch(docs.sparkSession) as store:
        found = store(places(docs, vocabulary, least), "licenses")
        blocks = found.selectExpr("row", "explode(blocks) as tokens")
        met = matches(blocks, notices, _order(blocks, vocabulary))
        by_row = met.groupBy("row").agg(F.collect_set("label").alias("added"), F.max("share").alias("share"))
        return frames.stored(_labelled(found, by_row), "license-labels")


def _labelled(found: DataFrame, by_row: DataFrame) -> DataFrame:
    nothing = "cast(array() as array<string>)"
    return found.join(by_row, "row", "left").selectExpr(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        "array_join(array_sort(array_distinct(base)), ',') as base_labels",
        f"array_join(array_sort(array_distinct(concat(base, coalesce(added, {nothing})))), ',') as labels",
        "cast(if(n_base > 0, 1, coalesce(share, 0)) as double) as score",
    )
