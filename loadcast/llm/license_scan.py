"""Licence scans: matching statistics against a suffix automaton of licence texts, chained into covered spans.

The automaton accepts every run of words of every template. A document streams through it word by word; the state and
length after each word tell the longest run that ends there and stands in a template. Runs that cannot be extended and
are long enough are chained, in the order of document and template, into spans with the share of the template that
they cover. Short phrases are templates too: a phrase ends wherever the state's run has it as its end.

Words are runs of ASCII letters, digits and other than ASCII characters; A-Z is lower-cased. Only words that some
template holds are streamed, in the runs that they form; any other word breaks a match. Null and empty texts have no
words and no labels; equal rows give equal results; extra columns are ignored; texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import LOWER, byte_set, prefix_hash, span_hash, text_chunks, word_spans

WORD = ~byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
_WORD_TEXT = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

# The phrases and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Passages of public licence texts and notices, with the label each one gives.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the Software), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so"),
    ("mit", "Released under the MIT License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met: Redistributions of source code must retain the above copyright notice, "
     "this list of conditions and the following disclaimer"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
     "your option) any later version"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "You should have received a copy of the GNU Affero General Public License along with this program"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
     "MPL was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
     "modify, publish, use, compile, sell, or distribute this software"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
     "to this work"),
    ("all-rights-reserved", "No part of this publication may be reproduced, distributed, or transmitted in any form "
     "or by any means without the prior written permission of the publisher"),
)
# Words of a run that counts towards a span, free words between runs of a span, and the share that gives a label.
MIN_RUN, MAX_GAP, LABEL_SHARE = 4, 40, 0.6


def words_of(text: str) -> list[str]:
    return _WORD_TEXT.findall(text.encode().translate(LOWER.tobytes()).decode())


class SuffixAutomaton:
    """The generalised suffix automaton of several word sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].add((number, place))
        # Ends of a state are ends of all shorter states on its links.
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, source: int, word: int) -> int:
        """The state for the run of `source` and `word`, cut off a longer state if need be."""
        target = self.step[source][word]
        if self.length[target] == self.length[source] + 1:
            return target
        clone = self._new(self.length[source] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = clone
        while source >= 0 and self.step[source].get(word) == target:
            self.step[source][word] = clone
            source = self.link[source]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:
            return self._split(last, word)
        new = self._new(self.length[last] + 1, {}, 0)
        while last >= 0 and word not in self.step[last]:
            self.step[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def advance(self, state: int, length: int, word: int) -> tuple[int, int]:
        """The longest run that ends with `word` after the run of `length` words in `state`."""
        while state and word not in self.step[state]:
            state = self.link[state]
            length = self.length[state]
        if word in self.step[state]:
            return self.step[state][word], length + 1
        return 0, 0


@dataclass
class Scan:
    """What one document holds: places of phrases, and spans (template, first word, last word, share)."""

    places: list[tuple[int, str]]
    spans: list[tuple[int, int, int, float]]


class Scanner:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.labels = [label for label, _ in templates]
        texts = [words_of(text) for _, text in templates] + [words_of(text) for text, _ in phrases]
        self.numbers = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
        hashes = np.array([_hash(w) for w in self.numbers], np.uint64)
        self.sorted = np.argsort(hashes)
        self.hashes = hashes[self.sorted]
        sequences = [[self.numbers[w] for w in t] for t in texts]
        self.sizes = [len(s) for s in sequences]
        self.automaton = SuffixAutomaton(sequences)
        self.least = min([MIN_RUN, *(len(words_of(p)) for p, _ in phrases)])
        # Per state the phrases that end its runs, each with the run length that it takes.
        phrase_at: dict[int, list[tuple[int, str]]] = {}
        for text, label in phrases:
            state = 0
            for word in words_of(text):
                state = self.automaton.step[state][self.numbers[word]]
            phrase_at.setdefault(state, []).append((len(words_of(text)), label))
        self.phrases_of: dict[int, list[tuple[int, str]]] = {}
        for state in range(1, len(self.automaton.link)):
            up, held = state, []
            while up > 0:
                held += phrase_at.get(up, [])
                up = self.automaton.link[up]
            if held:
                self.phrases_of[state] = held
        self.templates = len(templates)

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, or -1."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.sorted[at], -1)

    def scan(self, runs: list[tuple[int, list[int]]]) -> Scan:
        """The document whose runs of known words start at the given places."""
        places: list[tuple[int, str]] = []
        matches: list[tuple[int, int, int]] = []
        for start, words in runs:
            state = length = 0
            for i, word in enumerate(words):
                before, run = state, length
                state, length = self.automaton.advance(state, length, word)
                if length <= run and run >= MIN_RUN:
                    matches.append((start + i - run, run, before))
                if length >= 3 and state in self.phrases_of:
                    for size, label in self.phrases_of[state]:
                        if length >= size:
                            places.append((start + i + 1 - size, label))
            if length >= MIN_RUN:
                matches.append((start + len(words) - length, length, state))
        return Scan(places, self._chain(matches))

    def _chain(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
        """Matches in template order become spans; the best chain of each template and neighbourhood is kept."""
        # Per template and end place: covered words, first word and last word of the best open chain.
        open_: dict[int, dict[int, tuple[int, int, int]]] = {}
        best: dict[int, tuple[int, int, int]] = {}
        spans: list[tuple[int, int, int, float]] = []

        def close(template: int) -> None:
            covered, first, last = best.pop(template)
            open_.pop(template)
            spans.append((template, first, last, covered / self.sizes[template]))

        for first, run, state in matches:
            for template, end in self.automaton.ends[state]:
                if template >= self.templates:
                    continue
                if template in best and first - best[template][2] > MAX_GAP:
                    close(template)
                begin = end - run + 1
                chains = open_.setdefault(template, {})
                fits = [c for place, c in chains.items() if place < begin and c[2] < first and first - c[2] <= MAX_GAP]
                covered, start, _ = max(fits, default=(0, first, 0))
                chain = (covered + run, start if covered else first, first + run - 1)
                if chain > chains.get(end, (0, 0, 0)):
                    chains[end] = chain
                if template not in best or chain[0] > best[template][0]:
                    best[template] = chain
        for template in list(best):
            close(template)
        return sorted(spans, key=lambda s: (s[1], s[0]))


def _hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(span_hash(prefix_hash(data), np.array([0]), np.array([len(data)]))[0])


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


SCANNED = (
    "doc_id long, n_words long, places array<struct<first_word: long, label: string>>, "
    "spans array<struct<label: string, template: int, first_word: long, last_word: long, share: double>>"
)
_PLACES = pa.list_(pa.struct([("first_word", pa.int64()), ("label", pa.string())]))
_SPANS = pa.list_(pa.struct([
    ("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("share", pa.float64()),
]))


def scan_table(df: DataFrame) -> DataFrame:
    """Places of phrases and covered template spans of every row; words count from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scanner()
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(1)):
                low = LOWER[data]
                starts, ends, rows = word_spans(low, offsets, WORD)
                number = own.known(span_hash(prefix_hash(low), starts, ends))
                runs = _known_runs(number, rows, own.least)
                scans = [own.scan(r) if r else Scan([], []) for r in runs]
                places = [[{"first_word": p, "label": v} for p, v in s.places] for s in scans]
                spans = [[
                    {"label": own.labels[t], "template": t, "first_word": a, "last_word": b, "share": share}
                    for t, a, b, share in s.spans
                ] for s in scans]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, end - first), pa.array(np.diff(rows)), pa.array(places, _PLACES),
                    pa.array(spans, _SPANS),
                ], names=["doc_id", "n_words", "places", "spans"])

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCANNED)


def _known_runs(number: np.ndarray, rows: np.ndarray, least: int) -> list[list[tuple[int, list[int]]]]:
    """Per row, the runs of at least `least` known words, with the place of the first."""
    out: list[list[tuple[int, list[int]]]] = [[] for _ in range(len(rows) - 1)]
    known = number >= 0
    start = known.copy()
    start[1:] &= ~known[:-1]
    heads = rows[:-1][np.diff(rows) > 0]
    start[heads] = known[heads]
    begins = np.flatnonzero(start)
    if not len(begins):
        return out
    # A run ends before the next unknown word, the next run or the end of the row.
    breaks = np.unique(np.concatenate((np.flatnonzero(~known), begins, rows[1:])))
    stops = breaks[np.searchsorted(breaks, begins, "right")]
    row_of = np.searchsorted(rows, begins, "right") - 1
    for a, b, row in zip(begins.tolist(), stops.tolist(), row_of.tolist()):
        if b - a >= least:
            out[row].append((a - int(rows[row]), number[a:b].tolist()))
    return out


def license_report(df: DataFrame, share: float = LABEL_SHARE) -> DataFrame:
    """One row per document: counts and ends of the phrase places, labels of phrases and of covered templates."""
    base = F.transform("places", lambda p: p["label"])
    chained = F.transform(F.filter("spans", lambda s: s["share"] >= share), lambda s: s["label"])
    first = F.transform("places", lambda p: p["first_word"])

    def joined(labels):
        return F.concat_ws(",", F.sort_array(F.array_distinct(labels)))

    most = F.greatest(
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)),
        F.when(F.size("places") > 0, 1.0).otherwise(0.0),
    )
    return scan_table(df).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"), joined(base).alias("base_labels"),
        joined(F.concat(base, chained)).alias("labels"), F.least(most, F.lit(1.0)).alias("score"), "spans",
    )
