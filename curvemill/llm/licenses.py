"""License scans: phrases, and an exact set-similarity join of text blocks with templates.

A template is met by a run of as many words as it has itself that contains its tokens to the
threshold, and among them those that tell it from templates so like it that their texts would meet
it too. Texts are cut into overlapping blocks of words that hold all such runs. The tokens of the
templates are ordered by their frequency in all blocks, the rarest first. A template that is
contained in a block to the threshold shares a token of its prefix with it, so only blocks with such
a token are compared; the length and position filters stop most comparisons early. Runs are looked
for in the blocks that are left.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache",
           "cc by": "cc-by", "mit license": "mit"}

# Notices looked for by default: label and text.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
           "this software and associated documentation files",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, "
           "are permitted provided that the following conditions are met",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under "
               "the terms of the GNU General Public License as published by the Free Software "
               "Foundation, either version 3 of the License, or any later version",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, "
               "v. 2.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International "
                 "License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "proprietary": "All rights reserved. No part of this work may be reproduced without the "
                   "written permission of the publisher",
}
THRESHOLD = 0.8

_SIGNS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
               else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-case words of digits, a-z and all signs beyond ASCII."""
    return [] if text is None else text.translate(_SIGNS).split()


class Templates:
    """The templates as token lists in one global order, with their prefix index."""

    def __init__(self, templates: Mapping[str, str], threshold: float,
                 counts: Mapping[bytes, int] | None = None):
        self.threshold = threshold
        texts = {label: words_of(t.encode()) for label, t in templates.items()}
        self.span = max(map(len, texts.values()), default=1)
        counts = counts or {}
        vocabulary = {w for t in texts.values() for w in t}
        self.rank = {w: i for i, w in enumerate(sorted(
            vocabulary, key=lambda w: (counts.get(w, 0), w)))}
        self.needed, self.index = {}, {}
        for label, words in texts.items():
            tokens = sorted({self.rank[w] for w in words})
            need = max(1, math.ceil(threshold * len(tokens) - 1e-9))
            self.needed[label] = tokens, need
            for place, token in enumerate(tokens[:len(tokens) - need + 1]):
                self.index.setdefault(token, []).append((label, place))
        self.length = {label: len(words) for label, words in texts.items()}
        self.marks = {label: {t for other, _ in self.needed.values()
                              if need <= len(set(tokens).intersection(other)) < len(tokens)
                              for t in set(tokens).difference(other)}
                      for label, (tokens, need) in self.needed.items()}

    def blocks(self, words: list[bytes]) -> Iterator[list[tuple[int, int]]]:
        """(word, template token) of each block; any ``span`` words lie inside one block.

        Only template tokens are kept: no other token can be in an overlap.
        """
        rank, step = self.rank, self.span
        cells: dict[int, list[tuple[int, int]]] = {}
        for i, w in enumerate(words):
            if w in rank:
                cells.setdefault(i // step, []).append((i, rank[w]))
        for cell in sorted(cells.keys() | {c - 1 for c in cells if c}):
            yield cells.get(cell, []) + cells.get(cell + 1, [])

    def run(self, label: str, block: list[tuple[int, int]]) -> tuple[int, float] | None:
        """(first word, containment) of the best run of the template's own length."""
        (tokens, need), wanted, best = self.needed[label], set(self.needed[label][0]), None
        held: Counter[int] = Counter()
        inside = [(i, t) for i, t in block if t in wanted]
        low, most = 0, need - 1
        for i, token in inside:
            held[token] += 1
            while i - inside[low][0] >= self.length[label]:
                held[inside[low][1]] -= 1
                if not held[inside[low][1]]:
                    del held[inside[low][1]]
                low += 1
            if len(held) > most and self.marks[label] <= held.keys():
                best, most = (inside[low][0], len(held) / len(tokens)), len(held)
        return best

    def matches(self, block: list[int]) -> list[str]:
        """The templates that the block contains to the threshold."""
        seen, found = set(), []
        for place, token in enumerate(block):
            for label, at in self.index.get(token, ()):
                if label in seen:
                    continue
                seen.add(label)
                tokens, need = self.needed[label]
                # length: the block is long enough; position: so is what both have left
                if len(block) < need or 1 + min(
                        len(tokens) - at - 1, len(block) - place - 1) < need:
                    continue
                if len(set(tokens).intersection(block)) >= need:
                    found.append(label)
        return found


def _count(templates: Templates):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["text"]:
                for block in templates.blocks(words_of(text)):
                    total.update({t for _, t in block})
        yield pd.DataFrame({"token": list(total), "n": list(total.values())},
                           ).astype({"token": "int64", "n": "int64"})
    return count


def phrase_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(start, label) of all places of the fixed phrases."""
    found = []
    for phrase, label in _PHRASES:
        at = -1
        while True:
            try:
                at = words.index(phrase[0], at + 1)
            except ValueError:
                break
            if words[at:at + len(phrase)] == phrase:
                found.append((at, label))
    return found


_PHRASES = [(p.encode().split(), label) for p, label in PHRASES.items()]


def _scan(templates: Templates):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                words = words_of(text)
                places = phrase_places(words)
                runs = {}       # neighbouring blocks may hold the same one
                for block in templates.blocks(words):
                    for label in templates.matches(sorted({t for _, t in block})):
                        if run := templates.run(label, block):
                            runs[label, run[0]] = run[1]
                blocks = [{"label": label, "first_word": i, "containment": share}
                          for (label, i), share in runs.items()]
                rows.append((len(words), [{"label": x, "word": i} for i, x in sorted(places)],
                             blocks))
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), pd.DataFrame(
                rows, columns=["n_words", "phrases", "blocks"])], axis=1)
    return scan


FOUND = ("n_words bigint, phrases array<struct<label string, word bigint>>, "
         "blocks array<struct<label string, first_word bigint, containment double>>")


def scan(df: DataFrame, key: str = "doc_id", text: str = "text",
         templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key, n_words, phrases, blocks) per row: phrase places and runs that meet a template.

    A first pass counts the template tokens over the blocks of all rows, which gives the
    global order; these counts are as many as the templates have words. The second pass
    joins; ``blocks`` are the runs that meet a template. A null text has no words; repeated rows and
    very long texts are scanned like all others, and an empty table gives no rows.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    first = Templates(templates, threshold)
    words = {i: w for w, i in first.rank.items()}
    counts = rows.select("text").mapInPandas(_count(first), "token bigint, n bigint") \
        .groupBy("token").agg(F.sum("n").alias("n")).collect()
    ordered = Templates(templates, threshold, {words[r.token]: r.n for r in counts})
    return rows.mapInPandas(_scan(ordered), f"doc_id {kind}, {FOUND}") \
        .withColumnRenamed("doc_id", key)
