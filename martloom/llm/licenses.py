"""Licence scan: a trained paragraph classifier, confirmed against templates.

Paragraphs are runs of lines with words, so that comment marks and wrapping do not matter;
they are judged line by line and in overlapping windows of lines. A multinomial logistic regression on sparse word
n-grams gives each the probability of every licence family and of ordinary text. It is
trained on templates, on notices of other licences as a class of their own, both altered
and set into ordinary words, and on a bounded sample of the corpus' own lines. Its features
are the words and word pairs that several training texts hold, by name, not by bucket. Part of the
same data is kept apart to calibrate: a temperature makes the probabilities honest, and a
threshold is set above what ordinary text reaches. What the calibrated probability calls no
ordinary text, but of which no family is sure or whose words fit no template of the
predicted family, is reported as ``unknown``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.tables import carried, read_table, restored
from martloom.llm.words import Words, grams, mixed, split_words, text_slices
from martloom.session import keep

# Words of a window; a line with more is cut into windows that overlap by half.
WINDOW = 48
# Ordinary lines for training, about; and altered copies of each template.
SAMPLE = 4000
COPIES = 40
REGULARISATION, STEPS = 1e-3, 60
# Part of a template's words, by weight and in the same order, that a paragraph must hold.
LEAST_FIT = 0.6
# Training texts, joined lines aside, in which a word or word pair must stand to be a feature.
LEAST_TEXTS = 3
# Of ordinary paragraphs kept apart, at most this part may be taken for a licence.
FALSE_ALARMS = 0.001
SEED = 11

# How licences are named and noticed.
TEMPLATES = {
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file"
        " except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
        "Distributed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0"
        " International License.",
    ],
    "Proprietary": [
        "All rights reserved.",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ],
}
ORDINARY, UNKNOWN = "ordinary", "unknown"

# Notices of licences that are no family of their own.
UNNAMED = [
    "ISC License",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
    " without fee is hereby granted",
    "Distributed under the Boost Software License, Version 1.0.",
    "This file is in the public domain.",
    "This is free and unencumbered software released into the public domain.",
    "This software is licensed under the zlib license.",
    "Licensed under the Eclipse Public License, Version 2.0.",
    "WTFPL",
    "Licensed under the terms of the license in the LICENSE file.",
    "SPDX-License-Identifier: Zlib",
]

_FOUND = (
    "doc_id long, paragraph int, last_line int, family string, predicted string, probability double,"
    " template_fit double"
)


def _split(texts: list[str]) -> Words:
    return split_words(texts, lower=True, marks=False)


class Features:
    """Words and word pairs of texts as numbered features; others count in the length only."""

    def __init__(self, known: np.ndarray):
        self.known = known

    @classmethod
    def of(cls, texts: list[str]) -> Features:
        """Features that stand in at least ``LEAST_TEXTS`` of the training texts."""
        every, texts_with = np.unique(_terms(_split(texts))[0], return_counts=True)
        return cls(every[texts_with >= LEAST_TEXTS])

    def __len__(self) -> int:
        return len(self.known)

    def vectors(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature, text and value; a text's words and pairs together have length 1."""
        term, owner, counts = _terms(words)
        length = np.sqrt(np.bincount(owner, counts.astype(float) ** 2, len(words.first) - 1))
        at = np.searchsorted(self.known, term)
        found = np.zeros(len(term), dtype=bool)
        inside = at < len(self.known)
        found[inside] = self.known[at[inside]] == term[inside]
        owner = owner[found]
        return at[found], owner, counts[found] / length[owner]


def _terms(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and count of the different words and word pairs of every text."""
    pairs, whole = grams(words, 2)
    owner = words.text_of_word()
    term = np.concatenate([mixed(words.hashes), pairs[whole]])
    owner = np.concatenate([owner, owner[whole]])
    order = np.lexsort((term, owner))
    term, owner = term[order], owner[order]
    fresh = np.ones(len(term), dtype=bool)
    fresh[1:] = (term[1:] != term[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(fresh)
    return term[starts], owner[starts], np.diff(np.append(starts, len(term)))


def _training_vector(features: Features):
    """For training only: paragraphs of the bounded sample."""

    @F.udf(returnType=VectorUDT())
    def vector(paragraph: str):
        at, _, values = features.vectors(_split([paragraph]))
        return Vectors.sparse(len(features), sorted(zip(at.tolist(), values.tolist())))

    return vector


class Templates:
    """Word sequences of all templates, for comparison with paragraphs."""

    def __init__(self, templates: dict[str, list[str]]):
        self.words: dict[str, list[list[int]]] = {}
        for name, texts in templates.items():
            words = _split(texts)
            self.words[name] = [
                words.hashes[a:b].tolist() for a, b in zip(words.first[:-1], words.first[1:])
            ]
        # A word counts less the more families use it: "license" tells none of them.
        families = [{w for t in texts for w in t} for texts in self.words.values()]
        every = set().union(*families)
        self.weights = {w: 1.0 / sum(w in f for f in families) ** 2 for w in every}
        lists = [t for texts in self.words.values() for t in texts]
        self.pairs = {pair for t in lists for pair in zip(t, t[1:])}

    def fit(self, name: str, paragraph: list[int]) -> float:
        """Largest part of a template's words, by weight, that the paragraph holds in order."""
        templates = self.words.get(name, ())
        return max((_in_order(t, paragraph, self.weights) for t in templates), default=0.0)

    def touches(self, paragraph: list[int]) -> bool:
        """Whether the paragraph shares two words in a row with any template."""
        return any(pair in self.pairs for pair in zip(paragraph, paragraph[1:]))


def _in_order(template: list[int], paragraph: list[int], weights: dict[int, float]) -> float:
    """Heaviest common subsequence of words, as part of the template."""
    known = set(template)
    row = [0.0] * (len(template) + 1)
    for word in paragraph:
        if word not in known:
            continue
        before = 0.0
        for at, own in enumerate(template, 1):
            here = row[at]
            match = before + weights[own] if own == word else 0.0
            row[at] = max(match, here, row[at - 1])
            before = here
    return row[-1] / sum(weights[w] for w in template)


def altered(templates: dict[str, list[str]], ordinary: list[str], seed: int) -> list[tuple]:
    """Copies of every template: words left out, and ordinary words before and after."""
    random = np.random.default_rng(seed)
    pool = [w for text in ordinary[:500] for w in text.split()[:40]] or ["the"]
    out = []
    for name, texts in templates.items():
        for text in texts:
            words = text.split()
            out.append((name, text))
            for copy in range(COPIES):
                own = [w for w in words if random.random() > 0.08] or words
                # Some stand alone, others within a window of which they are a good part.
                most = 1 + (4 if copy % 2 else max(4, len(words) // 2))
                before = list(random.choice(pool, random.integers(0, most)))
                after = list(random.choice(pool, random.integers(0, most)))
                out.append((name, " ".join([*before, *own, *after])))
    return out


def windows(words: Words, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """What is judged of lines: first and last line, first word and word after the last.

    Every line with words, and windows of consecutive lines with at most ``WINDOW`` words
    that begin at every second line of a paragraph, at its last full window, and where two
    neighbouring lines would stand in no window. A line with
    more words gives windows that overlap by half. ``ends`` has the line after the last of
    each line's text.
    """
    first, counts = words.first, words.counts()
    lines = np.arange(len(counts))
    filled = counts > 0
    # The paragraph's end: the next line without words, or the text's end.
    blank = np.where(filled, len(counts), lines)
    stop = np.minimum(np.minimum.accumulate(blank[::-1])[::-1], ends) if len(lines) else lines
    out = []
    short = lines[filled & (counts <= WINDOW)]
    out.append((short, short, first[short], first[short + 1]))
    for line in lines[counts > WINDOW]:
        starts = np.arange(first[line], first[line + 1] - WINDOW // 2, WINDOW // 2)
        same = np.full(len(starts), line)
        out.append((same, same, starts, np.minimum(starts + WINDOW, first[line + 1])))
    reach = np.minimum(np.searchsorted(first, first[:-1] + WINDOW, side="right") - 1, stop)
    begin = np.ones(len(lines), dtype=bool)
    begin[1:] = stop[1:] != stop[:-1]
    since = lines - np.maximum.accumulate(np.where(begin, lines, 0)) if len(lines) else lines
    final = np.zeros(len(lines), dtype=bool)
    final[1:] = (reach[1:] == stop[1:]) & (reach[:-1] < stop[1:])
    # So does one whose first two lines the window before does not hold together.
    final[1:] |= reach[:-1] < lines[1:] + 2
    several = filled & (reach > lines + 1) & ((since % 2 == 0) | final)
    # A window within the one that begins before it tells nothing more.
    some = lines[several]
    fresh = np.ones(len(some), dtype=bool)
    fresh[1:] = reach[some[1:]] != reach[some[:-1]]
    some = some[fresh]
    out.append((some, reach[some] - 1, first[some], first[reach[some]]))
    return tuple(np.concatenate(parts) for parts in zip(*out))


def _cut(words: Words, start: np.ndarray, end: np.ndarray) -> Words:
    """The words of some runs, each as a text of its own."""
    sizes = end - start
    first = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(first[-1]) + np.repeat(start - first[:-1], sizes)
    return Words(words.data, words.start[at], words.end[at], first, words.hashes[at])


class Scanner:
    """Weights, temperature and threshold of a trained classifier."""

    def __init__(
        self, classes: list[str], features: Features, weights: np.ndarray, offsets: np.ndarray
    ):
        self.classes = classes
        self.features = features
        self.weights = weights.astype(np.float32)
        self.offsets = offsets
        self.temperature, self.threshold = 1.0, 0.5

    def logits(self, words: Words, count: int) -> np.ndarray:
        feature, owner, values = self.features.vectors(words)
        out = np.empty((count, len(self.classes)))
        for at in range(len(self.classes)):
            weights = self.weights[at, feature] * values
            out[:, at] = np.bincount(owner, weights, count) + self.offsets[at]
        return out

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        scaled = logits / self.temperature
        scaled = np.exp(scaled - scaled.max(1, keepdims=True))
        return scaled / scaled.sum(1, keepdims=True)

    def calibrate(self, texts: list[str], labels: list[str]) -> None:
        """Temperature of the least log loss; threshold above ordinary paragraphs."""
        logits = self.logits(_split(texts), len(texts))
        truth = np.array([self.classes.index(label) for label in labels])
        plain = truth == self.classes.index(ORDINARY)
        # As in training: ordinary paragraphs count as much as all notices.
        weights = np.where(plain, (~plain).sum() / max(1, plain.sum()), 1.0)

        def loss(temperature: float) -> float:
            self.temperature = temperature
            p = self.probabilities(logits)[np.arange(len(truth)), truth]
            return float(np.average(-np.log(np.maximum(p, 1e-12)), weights=weights))

        self.temperature = float(min(np.geomspace(0.1, 4.0, 40), key=loss))
        p = self.probabilities(logits)
        licence = 1.0 - p[plain, self.classes.index(ORDINARY)]
        if len(licence):
            self.threshold = float(max(0.5, np.quantile(licence, 1.0 - FALSE_ALARMS)))


def _paragraphs(docs: DataFrame) -> DataFrame:
    return docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("paragraph"))


def train(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> Scanner:
    """A scanner from templates and about ``SAMPLE`` different lines of ``docs``.

    The sample takes lines by hash, at the rate that gives ``SAMPLE`` of the different ones,
    and leaves out those that share two words in a row with a licence notice. Of a long line
    one window is taken; some lines are joined, as windows of a paragraph are.
    """
    spark = docs.sparkSession
    templates = templates or TEMPLATES
    notices = {**templates, UNKNOWN: UNNAMED}
    known = Templates(notices)
    texts = docs.select("text").where("length(text) > 0")
    lines = _paragraphs(texts).agg(F.approx_count_distinct("paragraph")).first()[0]
    rate = min(1.0, SAMPLE / max(1, lines))
    place = F.pmod(F.xxhash64("paragraph", F.lit(SEED)), F.lit(10_000_000)) / F.lit(1e7)
    rows = keep(
        _paragraphs(texts).where(place < rate).distinct().orderBy(F.xxhash64("paragraph")), "sample"
    ).collect()
    random = np.random.default_rng(SEED)
    sample = []
    for text in sorted(row[0] for row in rows if row[0].strip()):
        own = text.split()
        at = int(random.integers(0, max(1, len(own) - WINDOW + 1)))
        sample.append(" ".join(own[at : at + WINDOW]))
    words = _split(sample)
    ordinary = [
        text
        for i, text in enumerate(sample)
        if not known.touches(words.hashes[words.first[i] : words.first[i + 1]].tolist())
    ] or ["the text of a page"]
    joined = []
    for _ in range(len(ordinary) // 2):
        some = random.choice(len(ordinary), random.integers(2, 5))
        joined.append(" ".join(" ".join(ordinary[i] for i in some).split()[:WINDOW]))
    labelled = altered(notices, ordinary, SEED) + [(ORDINARY, t) for t in ordinary + joined]
    classes = sorted({label for label, _ in labelled})
    held, used = [], []
    for name in classes:
        own = [item for item in labelled if item[0] == name]
        own = [own[i] for i in random.permutation(len(own))]
        held += own[: len(own) // 4]
        used += own[len(own) // 4 :]
    features = Features.of([text for label, text in used if label != ORDINARY] + ordinary)
    # Ordinary paragraphs are many; together they count as much as all notices.
    plain = sum(label == ORDINARY for label, _ in used)
    share = (len(used) - plain) / plain
    rows = [
        (float(classes.index(label)), share if label == ORDINARY else 1.0, text)
        for label, text in used
    ]
    schema = T.StructType.fromDDL("label double, weight double, paragraph string")
    data = (
        spark.createDataFrame(rows, schema)
        .repartition(6)
        .select("label", "weight", _training_vector(features)("paragraph").alias("features"))
    )
    data = keep(data, "paragraphs")
    model = LogisticRegression(
        family="multinomial",
        maxIter=STEPS,
        regParam=REGULARISATION,
        standardization=False,
        weightCol="weight",
    ).fit(data)
    weights, offsets = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    scanner = Scanner(classes, features, weights, offsets)
    scanner.calibrate([text for _, text in held], [label for label, _ in held])
    return scanner


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per licence notice: doc_id, ``paragraph`` and ``last_line``, family, and why.

    The notice stands in the lines from ``paragraph`` (from 0) to ``last_line``; notices of a
    text do not overlap. Of overlapping ones those of a sure family come first, then the
    better fit, the higher probability, fewer words, and the earlier line. ``predicted`` is
    the classifier's family, ``probability`` its calibrated probability and ``template_fit``
    the part of that family's best notice in the lines; ``family`` is ``unknown`` unless both
    suffice. Missing and empty texts have no line. Rows without doc_id are scanned and
    reported without one; repeated rows are reported once each. An empty table gives an
    empty result.
    """
    templates = templates or TEMPLATES
    scanner = train(docs, templates)
    notices = Templates({**templates, UNKNOWN: UNNAMED})
    sent = docs.sparkSession.sparkContext.broadcast((scanner, notices))

    def scanned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner, known = sent.value
        names = [c.split()[0] for c in _FOUND.split(", ")]
        for frame in frames:
            out = []
            for part in text_slices(frame["text"], 1_000_000):
                ids = frame["doc_id"].iloc[part].tolist()
                lines = [(text or "").split("\n") for text in frame["text"].iloc[part]]
                for doc, begin, found in _notices(scanner, known, lines):
                    first, last, *rest = found
                    out.append((ids[doc], first - begin, last - begin, *rest))
            yield pd.DataFrame(out, columns=names)

    return restored(docs.select(carried(), "text").mapInPandas(scanned, _FOUND))


def _notices(
    scanner: Scanner, known: Templates, texts: list[list[str]]
) -> Iterator[tuple[int, int, tuple]]:
    """Text, its first line, and a notice in it, for the lines of many texts."""
    sizes = np.array([len(lines) for lines in texts])
    begins = np.concatenate([[0], np.cumsum(sizes)])
    words = _split([line for lines in texts for line in lines])
    first, last, start, end = windows(words, np.repeat(begins[1:], sizes))
    cut = _cut(words, start, end)
    p = scanner.probabilities(scanner.logits(cut, len(first)))
    ordinary = scanner.classes.index(ORDINARY)
    candidates = []
    for i in np.flatnonzero(1.0 - p[:, ordinary] >= scanner.threshold):
        families = p[i].copy()
        families[ordinary] = -1.0
        best = int(families.argmax())
        name = scanner.classes[best]
        fit = known.fit(name, words.hashes[start[i] : end[i]].tolist())
        sure = name != UNKNOWN and p[i, best] >= scanner.threshold and fit >= LEAST_FIT
        order = (not sure, -round(fit, 6), -round(float(p[i, best]), 6), end[i] - start[i], first[i])
        found = (name if sure else UNKNOWN, name, -order[2], -order[1])
        candidates.append((order, int(first[i]), int(last[i]), found))
    taken = np.zeros(begins[-1], dtype=bool)
    for _, a, b, found in sorted(candidates):
        if not taken[a : b + 1].any():
            taken[a : b + 1] = True
            doc = int(np.searchsorted(begins, a, side="right")) - 1
            yield doc, int(begins[doc]), (a, b, *found)


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan(read_table(spark, folder, "documents"))
