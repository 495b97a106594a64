"""License notices: base phrases, and an exact set-similarity join of text blocks and templates.

A text block is any run of as many words as a template of n words may stretch over (n divided by
the threshold). It matches if it holds at least that share of the template's distinct words. The
words of each template are ordered by how often they occur in all documents; a matching block
must hold one of the rarest few (the prefix), so only places of prefix words are looked at, only
blocks around them (position) that can hold enough words (length) are counted.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import map_rows, plain_words, texts_of

CONTAINMENT = 0.8

# Phrases of the base labels, and the opening notices of common licenses.
BASE_PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at",
    ),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    (
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    (
        "cc-by-nc",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 "
        "International License",
    ),
    (
        "cc-by-sa",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International "
        "License",
    ),
    (
        "cc-by",
        "This work is licensed under the Creative Commons Attribution 4.0 International License",
    ),
    ("all-rights-reserved", "Copyright. All rights reserved."),
)


class Template:
    """A template's distinct words in global order, with what a matching block must hold."""

    def __init__(self, label: str, text: str, counts: dict[bytes, int], threshold: float):
        words = plain_words(text.encode())
        self.label = label
        self.tokens = sorted(set(words), key=lambda w: (counts.get(w, 0), w))
        self.needed = math.ceil(threshold * len(self.tokens) - 1e-9)
        self.prefix = set(self.tokens[: len(self.tokens) - self.needed + 1])
        self.span = math.ceil(len(words) / threshold - 1e-9)
        self.known = set(self.tokens)

    def blocks(self, words: list[bytes], at: list[int]) -> list[tuple[int, int, float]]:
        """(start, end, containment) of matching blocks that do not overlap, by start.

        Fuller blocks come first, then earlier ones; no match is left between the chosen ones.
        """
        found, stretch = [], []
        for place in [*at, None]:
            if stretch and (place is None or place - stretch[-1] >= 2 * self.span - 1):
                low = max(0, stretch[0] - self.span + 1)
                high = min(len(words), stretch[-1] + self.span)
                if high - low >= self.needed:
                    found += self._chosen(words, low, high)
                stretch = []
            if place is not None:
                stretch.append(place)
        return [(start, end, n / len(self.tokens)) for start, end, n in sorted(found)]

    def _chosen(self, words: list[bytes], low: int, high: int) -> list[tuple[int, int, int]]:
        """Non-overlapping windows, fullest first; the gaps they leave are searched again."""
        chosen, gaps = [], [(low, high)]
        while gaps:
            low, high = gaps.pop()
            here: list[tuple[int, int, int]] = []
            for start, end, n in sorted(self._windows(words, low, high), key=lambda w: (-w[2], w)):
                k = bisect_left(here, (start,))
                if (not k or here[k - 1][1] <= start) and (k == len(here) or here[k][0] >= end):
                    here.insert(k, (start, end, n))
            if here:
                chosen += here
                edges = [low, *[x for block in here for x in block[:2]], high]
                free = zip(edges[::2], edges[1::2], strict=True)
                gaps += [(a, b) for a, b in free if b - a >= self.needed]
        return chosen

    def _windows(self, words: list[bytes], low: int, high: int) -> list[tuple[int, int, int]]:
        """(start, end, distinct template words) by end: the shortest window that holds as many
        as the ``span`` words before its end, if those are enough."""
        held, found = Counter(), []
        places = [i for i in range(low, high) if words[i] in self.known]
        first = 0
        for i in places:
            held[words[i]] += 1
            while places[first] <= i - self.span or held[words[places[first]]] > 1:
                gone = words[places[first]]
                held[gone] -= 1
                if not held[gone]:
                    del held[gone]
                first += 1
            if len(held) >= self.needed:
                found.append((places[first], i + 1, len(held)))
        return found


def base_places(words: list[bytes]) -> list[tuple[str, int]]:
    """(label, start) of every place where a base phrase's words stand one after another."""
    found = []
    joined = b" " + b" ".join(words) + b" "
    for label, phrase in BASE_PHRASES.items():
        wanted = b" " + phrase.encode() + b" "
        at, seen, counted = joined.find(wanted), 0, 0
        while at >= 0:
            counted += joined.count(b" ", seen, at)
            seen = at
            found.append((label, counted))
            at = joined.find(wanted, at + 1)
    return sorted(found, key=lambda f: (f[1], f[0]))


def token_counts(docs: DataFrame, text_col: str, wanted: set[bytes]) -> dict[bytes, int]:
    """How often the words of the templates occur in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in texts_of(batch, "text"):
                total.update(w for w in plain_words(text or b"") if w in wanted)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
            names=["word", "n"],
        )

    rows = (
        docs.select(F.col(text_col).alias("text"))
        .mapInArrow(run, "word binary, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    return {bytes(row["word"]): row["n"] for row in rows.collect()}


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = CONTAINMENT,
) -> DataFrame:
    """Per row of ``docs``: (id, n_words, base, blocks).

    ``base`` is an array of (label, start) with every place of a base phrase, ``blocks`` of
    (label, start, end, containment): for each template all blocks that reach ``threshold`` and do
    not overlap, fuller ones before others. Positions count words from 0, ends are
    exclusive; words are runs of ASCII letters, digits and non-ASCII characters with A-Z
    lower-cased. Null and empty texts have neither; repeated rows are each reported; only the two
    named columns are read. Templates are few and go to every task.
    """
    wanted = {w for _, text in templates for w in plain_words(text.encode())}
    counts = token_counts(docs, text_col, wanted)

    def setup():
        ready = [Template(label, text, counts, threshold) for label, text in templates]
        return ready, set().union(*[t.prefix for t in ready]) if ready else set()

    def one(state, key, text):
        ready, prefix = state
        words = plain_words(text or b"")
        base = [{"label": n, "start": s} for n, s in base_places(words)]
        blocks = []
        if not prefix.isdisjoint(words):
            places = [(i, w) for i, w in enumerate(words) if w in prefix]
            for template in ready:
                at = [i for i, w in places if w in template.prefix]
                for start, end, share in template.blocks(words, at):
                    blocks.append(
                        {"label": template.label, "start": start, "end": end, "containment": share}
                    )
        return key, len(words), base, blocks

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
        f"id {kind}, n_words long, base array<struct<label:string,start:long>>, "
        "blocks array<struct<label:string,start:long,end:long,containment:double>>",
        ["id", "text"],
        one,
        setup,
    ).withColumnRenamed("id", id_col)
