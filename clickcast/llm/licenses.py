"""Licence scan: a paragraph classifier with an unknown class, confirmed by comparison with templates.

Paragraphs are lines, and runs of neighbouring lines for notices that are wrapped: see ``find``. Their features are which word n-grams of one to three words they contain, digits made equal. A
multinomial logistic regression with an L1 penalty is trained by Spark on variants of the templates of each family
(words dropped, prose around them) and, as the unknown class, on paragraphs of the documents and on sentences that use
the same words otherwise. N-grams that ordinary paragraphs contain are no features, so nearly every paragraph has none,
and that is found by one set comparison; such a paragraph has the probabilities of the intercepts. A temperature,
fitted on variants that were kept from the training, calibrates the probabilities. A family is reported if it is likelier
than unknown by ``LEAST_PROBABILITY`` and one of its templates is contained in the paragraph to ``LEAST_CONTAINED`` of
its word triples.

The fit reads about ``SAMPLE_PARAGRAPHS`` paragraphs, chosen by a hash of their text. Every line of every document is
classified, and every run of lines that a template is spread over.

Defined results: null, empty and blank texts have no paragraphs and no families; every row is scanned by itself; without
documents the model is trained on the templates and sentences alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from random import Random

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickcast.llm.common import in_pandas

SAMPLE_PARAGRAPHS = 2000
VARIANTS = 24
LEAST_PROBABILITY, LEAST_CONTAINED = 0.5, 0.6
UNKNOWN = "unknown"
LONGEST = 3

# Notices as the licences word them.
TEMPLATES = {
    "agpl": ["licensed under the GNU Affero General Public License, version 3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "apache": ["Licensed under the Apache License, Version 2.0", "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Released under the BSD License", "licensed under the BSD 3-Clause License"],
    "cc-by": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc0": ["Released under CC0 1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"],
    "gpl": ["licensed under the GNU General Public License, version 3", "redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Released under the ISC License"],
    "lgpl": ["licensed under the GNU Lesser General Public License, version 3", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "mit": ["Released under the MIT License", "Licensed under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License, version 2.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
}
# Sentences with the words of licences that are none.
OTHERWISE = [
    "The driver showed a license to the officer and was released.",
    "He had permission to use the general copy of the source.",
    "All rights reserved by the public library under the terms of its charter.",
    "A creative work for the commons, to the attribution of many people.",
    "The software version was published by a foundation for the public.",
    "You may obtain a fishing license for a fee at the office.",
    "Copyright law is subject to the conditions of each state.",
    "The committee granted a license to the general store.",
    "The new version of the source was modified without notice.",
    "Distribution of free copies is permitted to any person.",
]

_WORD = re.compile(r"[^\W_]+")
_DIGITS = re.compile(r"\d+")


def paragraph_words(paragraph: str) -> list[str]:
    return _WORD.findall(_DIGITS.sub("0", paragraph.lower()))


def ngrams(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in range(1, LONGEST + 1) for i in range(len(words) - n + 1)}


def _triples(words: list[str]) -> set[tuple]:
    return set(zip(words, words[1:], words[2:]))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


@dataclass
class LicenceModel:
    """``index`` from n-grams to rows of ``weights``; ``words`` has a word of every n-gram; ``classes`` end in unknown."""

    classes: list[str]
    index: dict[str, int]
    words: frozenset[str]
    weights: np.ndarray
    intercepts: np.ndarray
    templates: dict[str, list[set]]
    temperature: float = 1.0

    def logits(self, words: list[str]) -> np.ndarray:
        rows = [self.index[g] for g in ngrams(words) if g in self.index]
        return self.weights[rows].sum(0) + self.intercepts

    def classify(self, paragraph: str) -> tuple[str, float]:
        """The family of a paragraph and its probability, or unknown."""
        words = paragraph_words(paragraph)
        if self.words.isdisjoint(words):
            return UNKNOWN, 1.0
        probabilities = _softmax(self.logits(words) / self.temperature)
        triples = _triples(words)
        for k in np.argsort(-probabilities):
            family, p = self.classes[k], float(probabilities[k])
            if family == UNKNOWN or p < LEAST_PROBABILITY:
                break
            if any(len(t & triples) >= LEAST_CONTAINED * len(t) for t in self.templates[family]):
                return family, p
        return UNKNOWN, float(probabilities[self.classes.index(UNKNOWN)])


def _variants(rng: Random, ordinary: list[list[str]]) -> Iterator[tuple[str, list[str]]]:
    """Templates with words dropped and prose around them."""
    for family, notices in TEMPLATES.items():
        for notice in notices:
            words = paragraph_words(notice)
            yield family, words
            for _ in range(VARIANTS):
                kept = [w for w in words if rng.random() > 0.08]
                around = rng.choice(ordinary) if ordinary and rng.random() < 0.5 else []
                cut = rng.randrange(len(around) + 1)
                yield family, [*around[:cut], *kept, *around[cut:]]


def _kept(words: list[str], common: set[str]) -> set[str]:
    """N-grams with a word that ordinary paragraphs don't use."""
    return {g for g in ngrams(words) if not common.issuperset(g.split(" "))}


def _sampled(column: str, sample: int, total: int) -> Column:
    """Whether a value is one of about ``sample`` of ``total``, by its hash: as fine as 2**53, so of any total some are."""
    return F.pmod(F.xxhash64(column), F.lit(1 << 53)) / float(1 << 53) < min(1.0, sample / max(total, 1))


def fit(spark: SparkSession, docs: DataFrame, *, text_col="text", sample=SAMPLE_PARAGRAPHS, seed: int = 7) -> LicenceModel:
    """Train on templates and on a sample of the documents' paragraphs."""
    lines = docs.select(F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line")).filter("trim(line) != ''")
    total = lines.count()
    ordinary = sorted(r["line"] for r in lines.filter(_sampled("line", sample, total)).distinct().collect())
    rng = Random(seed)
    notices = [_triples(paragraph_words(n)) for family in TEMPLATES.values() for n in family]
    prose = [w for w in map(paragraph_words, ordinary) if not any(len(t & _triples(w)) >= LEAST_CONTAINED * len(t) for t in notices)]
    counts: dict[str, int] = {}
    for words in prose:
        for w in set(words):
            counts[w] = counts.get(w, 0) + 1
    common = {w for w, n in counts.items() if n > 0.001 * len(prose) + 1}
    rows = list(_variants(rng, prose))
    rows += [(UNKNOWN, w) for w in prose] + [(UNKNOWN, paragraph_words(s)) for s in OTHERWISE for _ in range(VARIANTS // 2)]
    rng.shuffle(rows)
    held, train = rows[::5], [r for i, r in enumerate(rows) if i % 5]
    names = sorted({g for family in TEMPLATES.values() for n in family for g in _kept(paragraph_words(n), common)})
    index = {g: i for i, g in enumerate(names)}
    classes = [*sorted(TEMPLATES), UNKNOWN]
    data = [
        (float(classes.index(k)), SparseVector(len(index), [(i, 1.0) for i in sorted(index[g] for g in ngrams(words) if g in index)]))
        for k, words in train
    ]
    table = spark.createDataFrame(data, ["label", "features"]).coalesce(2)
    fitted = LogisticRegression(family="multinomial", regParam=0.0005, elasticNetParam=0.5, standardization=False, maxIter=60).fit(table)
    weights = np.asarray(fitted.coefficientMatrix.toArray()).T
    used = {g: i for g, i in index.items() if weights[i].any()}
    words = frozenset(next(w for w in g.split(" ") if w not in common) for g in used)
    templates = {k: [_triples(paragraph_words(n)) or {tuple(paragraph_words(n))} for n in TEMPLATES[k]] for k in TEMPLATES}
    model = LicenceModel(classes, used, words, weights, np.asarray(fitted.interceptVector.toArray()), templates)
    logits = np.array([model.logits(w) for _, w in held])
    truth = np.array([classes.index(k) for k, _ in held])

    def loss(t: float) -> float:
        return -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()

    model.temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8), key=loss)
    return model


def _window(hits: list[tuple[int, int, tuple]], template: set[tuple]) -> tuple[int, int, int]:
    """How many triples of a template stand close together at most, and the places of the first and last in ``hits``.

    Close together is within twice the template's length.
    """
    best, counts, low = (0, 0, 0), {}, 0
    for high, (at, _, triple) in enumerate(hits):
        counts[triple] = counts.get(triple, 0) + 1
        # What is too far away goes, and what comes again later.
        while at - hits[low][0] > 2 * len(template) or counts[hits[low][2]] > 1:
            counts[hits[low][2]] -= 1
            if not counts[hits[low][2]]:
                del counts[hits[low][2]]
            low += 1
        if len(counts) > best[0]:
            best = (len(counts), low, high)
    return best


def _wrapped(model: LicenceModel, lines: list[tuple[int, str]]) -> Iterator[tuple[int, int, str, float]]:
    """Notices that are spread over neighbouring lines (start and text), none of which is one by itself."""
    if len(lines) < 2:
        return
    words, of_line = [], []
    for i, (_, line) in enumerate(lines):
        made = paragraph_words(line)
        words += made
        of_line += [i] * len(made)
    if model.words.isdisjoint(words):
        return
    triples = list(zip(words, words[1:], words[2:]))
    runs = set()
    for template in (t for templates in model.templates.values() for t in templates):
        hits = [(at, of_line[at], triple) for at, triple in enumerate(triples) if triple in template]
        if len(hits) >= LEAST_CONTAINED * len(template):
            n, low, high = _window(hits, template)
            if n >= LEAST_CONTAINED * len(template):
                runs.add((-n, hits[low][1], of_line[hits[high][0] + 2]))
    # The run with the most triples first; the lines before and after it may hold others.
    for _, first, last in sorted(runs):
        family, p = model.classify("\n".join(line for _, line in lines[first : last + 1]))
        if family != UNKNOWN:
            yield from _wrapped(model, lines[:first])
            yield lines[first][0], lines[last][0] + len(lines[last][1]), family, p
            yield from _wrapped(model, lines[last + 1 :])
            return


def find(model: LicenceModel, text: str | None) -> list[tuple[int, int, str, float]]:
    """``start, end, family, probability`` of the licence paragraphs of a text.

    A line that is a notice is a paragraph. Of the other lines, those between blank lines and such notices are searched for
    runs that hold a template; the paragraph is the lines on which it stands.
    """
    found, start, block = [], 0, []
    for line in (text or "").split("\n"):
        family, p = model.classify(line)
        if family != UNKNOWN or not line.strip():
            found += _wrapped(model, block)
            block = []
        else:
            block.append((start, line))
        if family != UNKNOWN:
            found.append((start, start + len(line), family, p))
        start += len(line) + 1
    return [*found, *_wrapped(model, block)]


def scan(docs: DataFrame, model: LicenceModel, *, id_col="doc_id", text_col="text") -> DataFrame:
    """Per document: id, ``n_licences``, ``families`` (sorted, comma-joined) and ``spans`` (``family:start:end``)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [find(sent.value, t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "n_licences": [len(f) for f in found],
                    "families": [",".join(sorted({x[2] for x in f})) for f in found],
                    "spans": [",".join(f"{k}:{s}:{e}" for s, e, k, _ in f) for f in found],
                }
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return in_pandas(rows, label, "n_licences long, families string, spans string").withColumnRenamed("id", id_col)
