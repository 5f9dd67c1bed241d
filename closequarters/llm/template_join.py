"""Licence scan: exact phrases plus an exact set-similarity join.

Base: the places where a phrase's words stand consecutively.

Method: text blocks (lines, and overlapping windows of ``BLOCK_WORDS`` words of
the whole text, so a notice wrapped over lines lies in one block) are joined with licence templates on containment
|block & template| >= t |template|.  Tokens are ordered by their frequency in
the whole corpus (counted by a Spark job), rarest first.  With a = ceil(t |T|):
a match must share a token between the first |T| - a + 1 tokens of the template
and the first |B| - a + 1 of the block (prefix filter), needs |B| >= a (length
filter), and at the shared token enough tokens must be left on both sides
(positional filter); survivors are verified on the full sets, so the join is
exact.  Tokens in no template cannot add to an overlap and are dropped from
blocks first.

Naming.  Containment alone lets the word that names the licence be missing, so
the registered query confirms every candidate of the join: some window of
ceil(words of T / t) consecutive words of a line or of the whole text must reach
the threshold, hold all naming tokens of T and none of those that name another
licence.  Two neighbouring blocks overlap by more than such a window, so none
is missed.

The template side is a fixed parameter of a few hundred tokens,
which every task holds whole, so the join needs no shuffle.
"""
from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, text_slices

# Phrases of the base scan and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Public licence notices and their labels.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
            "of the Software"),
    ("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance "
                 "with the License. You may obtain a copy of the License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
)
LGPL_AGPL = "lesser affero"
# Per template the tokens that name its licence, and those that name another one.
NAMING = (("merge publish sublicense", ""), ("apache 2", ""), ("apache 2", ""), ("mit", ""),
          ("gnu general public 3", LGPL_AGPL), ("gnu general public", LGPL_AGPL), ("redistribution source binary", ""),
          ("creative commons noncommercial", ""), ("cc by nc", ""))
THRESHOLD = 0.8
BLOCK_WORDS = 128
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))
SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, n_blocks long")


def words_of(raw: bytes) -> list[bytes]:
    """Words: runs of a-z (A-Z lower-cased), 0-9 and non-ASCII characters."""
    return raw.translate(WORD_BYTES).split()


def base_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(index of the first word, label) of every place of every phrase."""
    line = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases.items():
        probe = b" " + phrase.encode() + b" "
        at = line.find(probe)
        while at >= 0:
            found.append((line.count(b" ", 0, at), label))
            at = line.find(probe, at + 1)
    return found


def windows(words: list[bytes], size: int):
    """Overlapping windows: every run of up to size - size // 2 words lies in one."""
    step = size // 2
    for s in range(0, max(len(words) - (size - step), 1), step):
        yield words[s:s + size]


def text_blocks(raw: bytes, size: int = BLOCK_WORDS):
    """The lines (a longer one in windows), and the windows of the whole text
    across its line ends."""
    lines = [w for w in map(words_of, raw.split(b"\n")) if w]
    for words in lines:
        yield from windows(words, size)
    if len(lines) > 1:
        yield from windows([w for words in lines for w in words], size)


class TemplateIndex:
    """Prefix index of the templates under a global token order."""

    def __init__(self, templates, frequency: dict[bytes, int], threshold: float = THRESHOLD, naming=None):
        self.naming = naming and [tuple(frozenset(words_of(t.encode())) for t in pair) for pair in naming]
        self.widths = [math.ceil(len(words_of(text.encode())) / threshold - 1e-9) for _, text in templates]
        self.sets = [(label, frozenset(words_of(text.encode()))) for label, text in templates]
        self.rank = {t: i for i, t in enumerate(sorted(set().union(*(s for _, s in self.sets)),
                                                       key=lambda t: (frequency.get(t, 0), t)))}
        self.vocabulary = frozenset(self.rank)
        self.need = [max(1, math.ceil(threshold * len(s) - 1e-9)) for _, s in self.sets]
        self.least = min(self.need)
        self.index: dict[bytes, list[tuple[int, int]]] = {}
        for k, (_, tokens) in enumerate(self.sets):
            order = sorted(tokens, key=self.rank.__getitem__)
            for i, token in enumerate(order[:len(order) - self.need[k] + 1]):
                self.index.setdefault(token, []).append((k, i))

    def named(self, k: int, words: list[bytes]) -> int:
        """The largest overlap of template ``k`` with a window of its width
        that holds its naming tokens and none of another licence; 0 if none."""
        (must, never), tokens, width = self.naming[k], self.sets[k][1], self.widths[k]
        if not must.issubset(words):
            return 0
        best, inside = 0, Counter()
        for i, word in enumerate(words):
            if word in tokens or word in must or word in never:
                inside[word] += 1
            gone = words[i - width] if i >= width else None
            if gone in inside:
                inside[gone] -= 1
                if not inside[gone]:
                    del inside[gone]
            if i >= width - 1 or i == len(words) - 1:
                if must <= inside.keys() and not never & inside.keys():
                    best = max(best, len(tokens & inside.keys()))
        return best

    def matches(self, words: list[bytes]) -> list[tuple[str, float]]:
        """(label, containment) of every template that the block contains;
        with ``naming``, that one of its windows contains and names."""
        block = self.vocabulary.intersection(words)
        if len(block) < self.least:
            return []
        order = sorted(block, key=self.rank.__getitem__)
        shared: dict[int, int] = {}
        for j, token in enumerate(order):
            for k, i in self.index.get(token, ()):
                need, left = self.need[k], min(len(self.sets[k][1]) - i, len(order) - j)
                if len(order) < need or (k not in shared and j > len(order) - need):
                    continue  # length and block prefix
                if shared.get(k, 0) + left >= need:  # positional
                    shared[k] = shared.get(k, 0) + 1
        out = []
        for k in shared:
            label, tokens = self.sets[k]
            overlap = len(tokens & block)
            if self.naming and overlap >= self.need[k]:
                overlap = self.named(k, words)
            if overlap >= self.need[k]:
                out.append((label, overlap / len(tokens)))
        return out


def token_frequencies(docs: DataFrame, vocabulary: frozenset[bytes], text_col: str = "text") -> dict[bytes, int]:
    """Occurrences of the template tokens in the whole corpus (at most one row per token)."""
    def run(batches):
        import pyarrow as pa

        total: Counter = Counter()
        for batch in batches:
            for _, texts in text_slices(batch, text_at=0):
                for t in texts:
                    total.update(filter(vocabulary.__contains__, words_of(t.encode())))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
                                         ["token", "n"])

    rows = (map_batches(docs.select(F.col(text_col).alias("text")), run, "token binary, n long")
            .groupBy("token").agg(F.sum("n").alias("n")).collect())
    return {bytes(r["token"]): r["n"] for r in rows}


def license_scan(docs: DataFrame, *, phrases: dict[str, str] = PHRASES, templates=TEMPLATES,
                 threshold: float = THRESHOLD, naming=None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base (places of phrases),
    first_word, last_word (null without a place), base_labels, labels (with
    those of matched templates; empty text if none), score (1 with a base
    place, else the best containment found, else 0) and n_blocks (matched
    blocks, lines and windows alike).

    ``naming`` has a pair per template, the tokens a match needs and those it
    must not have; without it containment in a block alone decides.

    Null texts count as empty; null ids and repeated rows pass through;
    further columns are not read.
    """
    vocabulary = TemplateIndex(templates, {}, threshold).vocabulary
    index = TemplateIndex(templates, token_frequencies(docs, vocabulary, text_col), threshold, naming)
    size = max([BLOCK_WORDS, *(2 * w for w in index.widths)])

    def scan(doc, text):
        raw = text.encode()
        words = words_of(raw)
        places = base_places(words, phrases)
        blocks = [m for m in map(index.matches, text_blocks(raw, size)) if m]
        base = {label for _, label in places}
        more = {label for m in blocks for label, _ in m}
        at = [i for i, _ in places]
        score = 1.0 if places else max((c for m in blocks for _, c in m), default=0.0)
        return (doc, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
                ",".join(sorted(base | more)), score, len(blocks))

    def run(batches):
        import pyarrow as pa

        names = [f.split()[0] for f in SCHEMA.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.int64()]
        for batch in batches:
            for part, texts in text_slices(batch):
                rows = [scan(d, t) for d, t in zip(part.column(0).to_pylist(), texts, strict=True)]
                cols = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return map_batches(docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text"), run, SCHEMA)
