"""Licence scan with a trained paragraph classifier.

Paragraphs end at blank lines, and a line is read by itself as well; what is long is read in
overlapping windows.  Sparse word 1- and 2-gram features, hashed, feed a multinomial logistic regression over licence families and
an unknown class; a temperature fitted on a calibration part makes its probabilities
honest.  A family is reported if its calibrated probability reaches one half and one of
its template sentences confirms it by shared word pairs; so is each family whose template
sentence a window holds, if the part with that sentence reaches one half by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _SPACE, buffers, mix, small_batches, steps, words_at

UNKNOWN = "unknown"
#: Sentences by which licence families are told, after the public licence texts.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http www apache org licenses LICENSE-2.0",
        "SPDX-License-Identifier Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier BSD-3-Clause",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
        "You may not use the material for commercial purposes.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier GPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https mozilla org MPL 2.0",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "proprietary": [
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
        "All rights reserved.",
        "Confidential and proprietary. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ],
}
#: Sentences with a licence's words that grant none.
NOT_LICENCES = [
    "The driver must carry a valid license at all times.",
    "The version of the software was released in general to the public.",
    "He read the file and made a copy of the work for the office.",
    "A new version of the program is free of charge for any person.",
    "They reserved the rights to the work under the old terms.",
    "The list of conditions follows in the next part of the source.",
]
#: Hashed features, words of a window, its step, corpus lines that are sampled as unknown.
FEATURES, WINDOW, STRIDE, MAX_LINES = 1 << 15, 40, 20, 4000
COPIES, EPOCHS, RATE, SEED = 60, 6, 0.3, 41
#: Calibrated probability, and share of word pairs with a template, that a report takes.
LEAST_PROBABILITY, LEAST_TEMPLATE = 0.5, 0.6

_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[[ord(c) for c in "!\"#$%&'()*,:;<=>?@[]^_`{|}~"]] = 32
RESULT = "doc_id long, n_paragraphs long, found array<struct<family:string,start:int,end:int,probability:double,template:double>>"


@dataclass
class Lines:
    """Words of texts, and windows: those of each line, then those of paragraphs that hold a line break."""

    words: np.ndarray
    pairs: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    wrapped: np.ndarray


def _windows(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, word after the last) of the windows of runs of ``size`` words."""
    count = np.where(size <= WINDOW, 1, -(-(size - WINDOW) // STRIDE) + 1)
    which = np.repeat(np.arange(len(begin)), count)
    k = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    first = begin[which] + k * STRIDE
    return first, np.minimum(first + WINDOW, begin[which] + size[which])


def read_lines(raw: np.ndarray, offsets: np.ndarray) -> Lines:
    """``first``/``last``: word ranges of the windows, ``row`` the text of each; ``wrapped``: it crosses a line break."""
    clean = _CLEAN[raw[offsets[0]:offsets[-1]]]
    at0 = offsets - offsets[0]
    stop = np.append(clean[1:], np.uint8(10))
    stop[at0[1:][at0[1:] > at0[:-1]] - 1] = 10  # a text's last byte
    clean[(clean == 46) & _SPACE[stop]] = 32  # a full stop at a word's end
    words, at, starts, ends = words_at(clean, at0)
    if not len(words):
        e = np.empty(0, np.int64)
        return Lines(words, words, e, e, e, e, e, e.astype(bool))
    of_row = np.searchsorted(at0, starts, "right") - 1
    line = np.cumsum(clean == 10)[starts]
    head = np.r_[True, (line[1:] != line[:-1]) | (of_row[1:] != of_row[:-1])]
    begin = np.flatnonzero(head)
    first, last = _windows(begin, np.diff(np.r_[begin, len(words)]))
    begin = np.flatnonzero(head & np.r_[True, (line[1:] > line[:-1] + 1) | (of_row[1:] != of_row[:-1])])
    over, end = _windows(begin, np.diff(np.r_[begin, len(words)]))
    across = line[over] != line[end - 1]  # the others hold a part of one line, which has its own
    wrapped = np.repeat([False, True], [len(first), int(across.sum())])
    first, last = np.r_[first, over[across]], np.r_[last, end[across]]
    with np.errstate(over="ignore"):
        pairs = mix(words[:-1] * np.uint64(0x9FB21C651E98DF25) + words[1:]) if len(words) > 1 else np.empty(0, np.uint64)
    return Lines(words, np.append(pairs, np.uint64(0)), starts, ends, of_row[first], first, last, wrapped)


@dataclass
class Classifier:
    families: list[str]  # the unknown class last
    weight: np.ndarray
    bias: np.ndarray
    temperature: float
    templates: list[list[np.ndarray]]

    def probabilities(self, lines: Lines) -> np.ndarray:
        """Calibrated class probabilities of each window."""
        one = np.concatenate([np.zeros((1, len(self.bias))), np.cumsum(self.weight[(lines.words % np.uint64(FEATURES)).astype(np.intp)], axis=0, dtype=np.float64)])
        two = np.concatenate([np.zeros((1, len(self.bias))), np.cumsum(self.weight[(lines.pairs % np.uint64(FEATURES)).astype(np.intp)], axis=0, dtype=np.float64)])
        n = lines.last - lines.first
        z = one[lines.last] - one[lines.first] + two[lines.last - 1] - two[lines.first]
        z = (z / np.sqrt(2 * n - 1)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def probability(self, lines: Lines, first: int, last: int) -> np.ndarray:
        """Calibrated class probabilities of one run of words."""
        x = np.concatenate([lines.words[first:last], lines.pairs[first:last - 1]]) % np.uint64(FEATURES)
        z = (self.weight[x.astype(np.intp)].sum(axis=0, dtype=np.float64) / np.sqrt(len(x)) + self.bias) / self.temperature
        z = np.exp(z - z.max())
        return z / z.sum()

    def parts(self, lines: Lines) -> Iterator[tuple[int, int, int, int, float]]:
        """(window, family, first word, word after the last, share) of each template that a window
        holds: the shortest run, no longer than one and a half templates, with the most of its pairs."""
        known = np.unique(np.concatenate([t for ts in self.templates for t in ts]))
        some = np.zeros(1 << 16, bool)
        some[known & np.uint64(0xFFFF)] = True
        hits = np.flatnonzero(some[lines.pairs & np.uint64(0xFFFF)])
        hits = hits[np.isin(lines.pairs[hits], known)]
        for family, templates in enumerate(self.templates):
            for t in templates:
                at = hits[np.isin(lines.pairs[hits], t)]
                begin, end = np.searchsorted(at, lines.first), np.searchsorted(at, lines.last - 1)
                for k in np.flatnonzero(end - begin >= max(1, LEAST_TEMPLATE * len(t))):
                    place = at[begin[k]:end[k]].tolist()
                    most, short, first, last = 0, 0, 0, 0
                    for i, a in enumerate(place):
                        seen: set[int] = set()
                        for b in place[i:]:
                            if b - a >= 1.5 * len(t):
                                break
                            seen.add(int(lines.pairs[b]))
                            if (len(seen), a - b) > (most, short):
                                most, short, first, last = len(seen), a - b, a, b + 2
                    if most >= LEAST_TEMPLATE * len(t):
                        yield int(k), family, first, last, most / len(t)

    def template(self, family: int, pairs: np.ndarray) -> float:
        """The largest share of a template's word pairs that the window holds."""
        return max(len(np.intersect1d(t, pairs)) / max(1, len(t)) for t in self.templates[family])


def _features(texts: list[str]) -> list[np.ndarray]:
    out = []
    for text in texts:
        raw = np.frombuffer(text.encode(), np.uint8)
        lines = read_lines(raw, np.array([0, len(raw)]))
        out.append((np.concatenate([lines.words, lines.pairs[:-1]]) % np.uint64(FEATURES)).astype(np.intp))
    return out


def train(corpus_lines: list[str], *, seed: int = SEED) -> Classifier:
    """Fit on altered copies of the templates (words lost, cut short, set between other words)
    against corpus lines and sentences that grant nothing; a fifth calibrates the temperature."""
    rng = np.random.default_rng(seed)
    families = [*sorted(TEMPLATES), UNKNOWN]
    pool = [w for line in corpus_lines[:500] for w in line.split()] or ["text"]
    samples: list[tuple[str, int]] = []
    for y, family in enumerate(families[:-1]):
        for template in TEMPLATES[family]:
            words = template.split()
            for c in range(COPIES):
                kept = [w for w in words if c == 0 or rng.random() > 0.08] or words
                side = [[pool[i] for i in rng.integers(len(pool), size=rng.integers(0, 12))] if c % 2 else [] for _ in range(2)]
                text = " ".join([*side[0], *kept, *side[1]])
                samples.append((text.upper() if c % 7 == 6 else text, y))
    unknown = [*NOT_LICENCES * 10, *corpus_lines]
    samples += [(" ".join(line.split()[:WINDOW]), len(families) - 1) for line in unknown if line.split()]
    x = _features([t for t, _ in samples])
    y = np.array([k for _, k in samples])
    order = rng.permutation(len(samples))
    part = len(order) // 5
    check, fit = order[:part], order[part:]
    w, b = np.zeros((FEATURES, len(families)), np.float32), np.zeros(len(families))
    for epoch in range(EPOCHS):
        for i in rng.permutation(fit):
            scale = 1 / np.sqrt(max(1, len(x[i])))
            z = w[x[i]].sum(axis=0) * scale + b
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            rate = RATE * 4 / (1 + epoch)
            np.subtract.at(w, x[i], (rate * scale * p).astype(np.float32))
            b -= 0.02 * p
    z = np.array([w[x[i]].sum(axis=0) / np.sqrt(max(1, len(x[i]))) + b for i in check])
    grid = np.exp(np.linspace(np.log(0.2), np.log(5), 60))

    def loss(t: float) -> float:
        s = z / t
        return float((np.log(np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1)) + s.max(axis=1) - s[np.arange(len(s)), y[check]]).mean())

    temperature = float(min(grid, key=loss))
    templates = []
    for family in families[:-1]:
        raws = [np.frombuffer(t.encode(), np.uint8) for t in TEMPLATES[family]]
        templates.append([np.unique(read_lines(r, np.array([0, len(r)])).pairs[:-1]) for r in raws])
    return Classifier(families, w, b, temperature, templates)


def sample_lines(docs: DataFrame, most: int = MAX_LINES) -> list[str]:
    """At most ``most`` lines of the rows (doc_id, text) with the lowest seeded hashes, one line each, none with a licence's word pairs.

    Hashes are uniform, so a rate from the row count leaves about twice as many rows as are
    wanted; only these are cut to their line and sorted.
    """
    at = F.xxhash64("doc_id", F.lit(SEED))
    rate = min(1.0, (2 * most + 1000) / max(1, docs.count()))
    bound = int(-(1 << 63) + rate * ((1 << 64) - 1)) if rate < 1 else (1 << 63) - 1
    lines = F.split("text", "\n")
    line = F.element_at(lines, (F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.size(lines)) + 1).cast("int"))
    chosen = docs.filter(F.col("text").isNotNull() & (at <= F.lit(bound).cast("long"))).select(at.alias("at"), "doc_id", F.substring(line, 1, 400).alias("line"))
    picked = chosen.orderBy("at", "doc_id").limit(most).select("line")
    marks = "licen|copyright|rights reserved|creative commons|spdx|permission|redistribution"
    return [r["line"] for r in picked.filter(~F.lower("line").rlike(marks)).collect()]


def finds(lines: Lines, model: Classifier) -> list[tuple]:
    """(family, first word, word after the last, text, probability, share of the template) of all finds.

    A window across lines adds nothing where a line alone shows the same family, and a part
    of a window nothing where the family is found already.
    """
    out: list[tuple] = []
    if not len(lines.words):
        return out
    held: dict[tuple, list] = {}
    p = model.probabilities(lines)
    best = p.argmax(axis=1)
    for k in np.flatnonzero((best < len(model.families) - 1) & (p.max(axis=1) >= LEAST_PROBABILITY)):  # the lines' windows come first
        y, first, last, row = (int(x[k]) for x in (best, lines.first, lines.last, lines.row))
        share = model.template(y, lines.pairs[first:last - 1])
        places = held.setdefault((row, y), [])
        if share >= LEAST_TEMPLATE and not (lines.wrapped[k] and any(a < last and first < b for a, b, across in places if not across)):
            places.append((first, last, bool(lines.wrapped[k])))
            out.append((y, first, last, row, float(p[k, y]), share))
    for k, y, first, last, share in model.parts(lines):
        row = int(lines.row[k])
        places = held.setdefault((row, y), [])
        if any(a < last and first < b for a, b, _ in places):
            continue
        own = model.probability(lines, first, last)
        if own[y] >= LEAST_PROBABILITY:
            places.append((first, last, False))
            out.append((y, first, last, row, float(own[y]), share))
    return out


def scan(docs: DataFrame, model: Classifier, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_paragraphs, found) for every row; ``found``: family, place (code points),
    calibrated probability and share of the template, in order of place.

    A null or empty text has no paragraph and finds nothing; null ids stay, equal rows give
    equal rows, an empty table none; other columns play no part.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = buffers(batch.column(1))
            for i, j in steps(offsets):
                lines = read_lines(raw, offsets[i:j + 1])
                found: list[list] = [[] for _ in range(i, j)]
                # Code points before each byte of the step.
                points = np.concatenate([[0], np.cumsum((raw[offsets[i]:offsets[j]] & 0xC0) != 0x80)])
                for family, first, last, row, p, share in finds(lines, model):
                    at = [int(points[int(x)] - points[int(offsets[i + row] - offsets[i])]) for x in (lines.starts[first], lines.ends[last - 1])]
                    found[row].append({"family": model.families[family], "start": at[0], "end": at[1], "probability": p, "template": share})
                for f in found:
                    f.sort(key=lambda x: (x["start"], x["end"], x["family"]))
                kind = pa.list_(pa.struct([("family", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64()), ("template", pa.float64())]))
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(np.bincount(lines.row, minlength=j - i).astype(np.int64)), pa.array(found, kind)], names=["doc_id", "n_paragraphs", "found"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, RESULT)
