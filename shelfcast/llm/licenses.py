"""License scan: a trained paragraph classifier, calibrated, confirmed against templates."""

from __future__ import annotations

import functools
import random
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import UPPER, hashed_share

# Sentences by which licences are named or granted, by family.
TEMPLATES = {
    "AGPL-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        'the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied.",
        "This project is released under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-2-Clause": [
        "Released under the BSD 2-Clause License.",
        "Licensed under the Simplified BSD License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior "
        "written permission.",
        "Use of this source code is governed by a BSD-style license that can be found in the "
        "LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "To view a copy of this license, visit https://creativecommons.org/licenses/by/4.0/",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
        "To view a copy of this license, visit https://creativecommons.org/licenses/by-nc/4.0/",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        "International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this "
        "program. If not, see https://www.gnu.org/licenses/.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License. See LICENSE in the project root for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ],
}
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *TEMPLATES]
_TOKEN = re.compile(r"\w+|\n")
_WORD = re.compile(r"\w+")
_LOWER = str.maketrans(UPPER, UPPER.lower())
_CACHE_MOST = 200_000
_CHUNK = 1 << 14  # words
_cache: dict[str, int] = {}


@dataclass(frozen=True)
class Scan:
    """Parameters of the classifier and of the confirmation."""

    bits: int = 15
    sample: int = 6_000  # corpus paragraphs learnt as unknown, at most; those least by hash
    variants: int = 40  # of each template sentence
    epochs: int = 6
    rate: float = 0.5
    l2: float = 1e-5
    false_rate: float = 0.001  # of held-out unknown paragraphs that may be given a family
    floor: float = 0.9  # of the least probability of a family, against unknown alone
    words: int = 5  # in a shingle of the comparison with templates
    similarity: float = 0.8
    longest: int = 2  # words of a wrapped paragraph, in lengths of the longest template sentence
    seed: int = 5


@dataclass(frozen=True)
class LicenseModel:
    weights: np.ndarray  # a row for each slot, a column for each of FAMILIES
    temperature: float
    least: float  # probability of the best family, against unknown, below which it is unknown
    params: Scan


def _hashes(tokens: list[str]) -> np.ndarray:
    if len(_cache) > _CACHE_MOST:
        _cache.clear()
    for token in {t for t in tokens if t not in _cache}:
        _cache[token] = zlib.crc32(token.encode("utf-8", "replace"))
    return np.fromiter(map(_cache.__getitem__, tokens), np.uint64, len(tokens))


def _mixed(h: np.ndarray) -> np.ndarray:
    """Hashes of the pairs of neighbouring words."""
    mixed = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    return mixed ^ (mixed >> np.uint64(31))


def _slots(h: np.ndarray, bits: int) -> np.ndarray:
    return (h % np.uint64((1 << bits) - 1)).astype(np.int64) + 1  # slot 0 is the intercept


def paragraph_slots(text: str, bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashed word unigrams and bigrams of a whole text: slots, the line each is of, and the
    number of lines. No n-gram crosses the end of a line."""
    tokens = _TOKEN.findall(text.lower())
    n = tokens.count("\n") + 1
    if not tokens:
        return np.empty(0, np.int64), np.empty(0, np.int64), n
    h = _hashes(tokens)
    line = np.fromiter((t == "\n" for t in tokens), bool, len(tokens))
    at = np.cumsum(line)
    word = ~line
    pair = word[:-1] & word[1:]
    slots = np.concatenate([_slots(h[word], bits), _slots(_mixed(h)[pair], bits)])
    return slots, np.concatenate([at[word], at[:-1][pair]]), n


def _running(weights: np.ndarray, slots: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the weights of all slots before each place of ``at``, which ascends. Only a
    chunk of the running sums is held at once."""
    out, total = np.empty((len(at), weights.shape[1])), np.zeros(weights.shape[1])
    for low in range(0, len(slots) + 1, _CHUNK):
        part = np.vstack([total, weights[slots[low : low + _CHUNK]]])
        np.cumsum(part, axis=0, out=part)
        here = slice(*np.searchsorted(at, [low, low + len(part)]))
        out[here] = part[at[here] - low]
        total = part[-1]
    return out


class Stream:
    """The lines of a text with running sums of the weights of words and of pairs of words, so
    the classifier's score of any run of lines costs a few differences. ``starts`` and ``ends``
    are the words of each line; comment marks are no words."""

    def __init__(self, text: str, model: LicenseModel):
        weights, bits = model.weights, model.params.bits
        tokens = _TOKEN.findall(text.lower())
        mark = np.fromiter((t == "\n" for t in tokens), bool, len(tokens))
        h = _hashes([t for t in tokens if t != "\n"])
        breaks = np.cumsum(~mark)[mark]
        self.model = model
        self.starts, self.ends = np.r_[0, breaks], np.r_[breaks, len(h)]
        words, pairs = _slots(h, bits), _slots(_mixed(h), bits)
        self.last = np.maximum(self.ends - 1, self.starts)  # last word of a line
        self.before = _running(weights, words, self.starts)
        self.until = _running(weights, words, self.ends)
        self.before += _running(weights, pairs, np.minimum(self.starts, len(pairs)))
        self.until += _running(weights, pairs, np.minimum(self.last, len(pairs)))

    def logits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Calibrated scores of FAMILIES for the runs of lines from a to b."""
        grams = self.ends[b] + self.last[b] - 2 * self.starts[a]
        total = (self.until[b] - self.before[a]) / np.sqrt(np.maximum(grams, 1))[:, None]
        return (total + self.model.weights[0]) / self.model.temperature

    def named(self, most: int) -> Iterator[tuple[int, int, int, float]]:
        """Lines, and runs of neighbouring lines of ``most`` words in all, that the classifier
        gives a family: first line, last line, family, probability. No run holds a line without
        words."""
        least = self.model.least
        margin = np.log(least / max(1 - least, 1e-12))
        full = np.flatnonzero(self.ends > self.starts)
        first = np.arange(len(full))
        for more in range(len(full) + 1):
            first = first[first + more < len(full)]
            a, b = full[first], full[np.minimum(first + more, len(full) - 1)]
            if more:
                run = (b - a == more) & (self.ends[b] - self.starts[a] <= most)
                first, a, b = first[run], a[run], b[run]
            if not len(first):
                return
            z = self.logits(a, b)
            lead = z[:, 1:].max(axis=1) - z[:, 0]
            near = np.flatnonzero((lead >= margin) & (lead > 0))
            for i, p in zip(near.tolist(), _softmax(z[near]), strict=True):
                family = int(p[1:].argmax()) + 1
                yield int(a[i]), int(b[i]), family, float(p[family])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
    return e / e.sum(axis=1, keepdims=True)


def paragraph_probabilities(text: str, model: LicenseModel) -> np.ndarray:
    """A row of probabilities of FAMILIES for each line of a text."""
    stream = Stream(text, model)
    lines = np.arange(len(stream.starts))
    return _softmax(stream.logits(lines, lines))


def shingles(text: str, words: int) -> set[tuple[str, ...]]:
    found = _WORD.findall(text.translate(_LOWER))
    if not found:
        return set()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))}


@functools.cache
def _sentences(family: str, words: int) -> list[set[tuple[str, ...]]]:
    return [shingles(sentence, words) for sentence in TEMPLATES[family]]


def _shares(own: set[tuple[str, ...]], family: str, words: int) -> list[float]:
    return [len(wanted & own) / len(wanted) for wanted in _sentences(family, words)]


def sentence_shares(paragraph: str, family: str, params: Scan) -> list[float]:
    """Share of the shingles of each template sentence of a family that a paragraph holds."""
    return _shares(shingles(paragraph, params.words), family, params.words)


def template_similarity(paragraph: str, family: str, params: Scan) -> float:
    """The largest of the shares."""
    return max(sentence_shares(paragraph, family, params), default=0.0)


def _most_similar(paragraph: str, families: Iterable[str], params: Scan) -> float:
    """The largest of the shares over several families; the shingles are taken once."""
    own = shingles(paragraph, params.words)
    return max((share for f in families for share in _shares(own, f, params.words)), default=0.0)


@functools.cache
def _longest() -> int:
    return max(len(_WORD.findall(t)) for texts in TEMPLATES.values() for t in texts)


def wrapped_sentences(
    lines: list[str], named: list[tuple[int, int, int, float]], params: Scan
) -> list[tuple[str, int, int, float, float]]:
    """Of runs of lines the classifier named, those that hold ``similarity`` of a template
    sentence of that family and less of it without their first or their last line: family, first
    and last line, probability, share. Of runs over the same lines the one with the largest
    share of a sentence counts, then the shorter, then the earlier. A run that holds more of
    another family's sentence is none."""
    tight = []
    for first, last, family, probability in named:
        name = FAMILIES[family]
        shares = sentence_shares("\n".join(lines[first : last + 1]), name, params)
        if max(shares) < params.similarity:
            continue
        headless = sentence_shares("\n".join(lines[first + 1 : last + 1]), name, params)
        tailless = sentence_shares("\n".join(lines[first:last]), name, params)
        for n, share in enumerate(shares):
            if share >= params.similarity and share > max(headless[n], tailless[n]):
                tight.append((-share, last - first, first, name, n, probability))
    taken: dict[tuple[str, int], set[int]] = {}
    out = []
    for share, more, first, name, n, probability in sorted(tight):
        text = "\n".join(lines[first : first + more + 1])
        used, run = taken.setdefault((name, n), set()), range(first, first + more + 1)
        others = [f for f in TEMPLATES if f != name]
        if used.isdisjoint(run) and _most_similar(text, others, params) <= -share:
            used.update(run)
            out.append((name, first, first + more, probability, -share))
    return out


def _variants(params: Scan, filler: list[str]) -> list[tuple[str, int, int]]:
    """Template sentences with words left out, in other case, or among words of the corpus:
    text, family and number of the sentence in its family."""
    rng, out = random.Random(params.seed), []
    for k, family in enumerate(TEMPLATES, start=1):
        for number, sentence in enumerate(TEMPLATES[family]):
            for i in range(params.variants):
                words = sentence.split()
                if i % 3 == 1:
                    words = [w for w in words if rng.random() > 0.1] or words
                if i % 3 == 2 and filler:
                    extra = rng.choice(filler).split()
                    cut = rng.randrange(len(extra) + 1)
                    words = extra[max(0, cut - 6) : cut] + words + extra[cut : cut + rng.randrange(7)]
                text = " ".join(words)
                out.append((text.upper() if i % 5 == 4 else text, k, number))
    return out


Example = tuple[np.ndarray, np.ndarray, int]  # slots, value of each, label


def _example(text: str, label: int, params: Scan) -> Example:
    slots, _, _ = paragraph_slots(text.replace("\n", " "), params.bits)
    at, often = np.unique(np.r_[0, slots], return_counts=True)
    value = often / np.sqrt(max(1, len(slots)))
    value[0] = 1.0  # the intercept; no n-gram has slot 0
    return at, value, label


def _learn(examples: list[Example], params: Scan) -> np.ndarray:
    weights = np.zeros((1 << params.bits, len(FAMILIES)))
    square = np.full(weights.shape, 1e-8)
    for _ in range(params.epochs):
        for at, value, label in examples:
            own = weights[at]
            z = value @ own
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            grad = value[:, None] * p + params.l2 * own
            seen = square[at] + grad * grad
            square[at] = seen
            weights[at] = own - params.rate * grad / np.sqrt(seen)
    return weights


def _calibrated(weights: np.ndarray, held: list[Example], params: Scan) -> tuple[float, float]:
    """Temperature of least log loss on held-out examples, and the least probability of
    a family, against unknown alone, that leaves ``false_rate`` of the unknown ones above it. So
    families that are much alike do not lose by sharing what is no doubt a licence."""
    z = np.array([value @ weights[at] for at, value, _ in held]).reshape(len(held), len(FAMILIES))
    labels = np.array([label for *_, label in held], dtype=int)
    choices = np.geomspace(0.25, 8, 21)
    losses = [-np.log(_softmax(z / t)[np.arange(len(z)), labels] + 1e-12).mean() for t in choices]
    temperature = float(choices[int(np.argmin(losses))])
    p = _softmax(z / temperature)[labels == 0]
    best = p[:, 1:].max(axis=1, initial=0.0)
    false = best / np.maximum(best + p[:, 0], 1e-300)
    if not len(false):
        return temperature, 0.5  # nothing says how far unknown paragraphs come
    return temperature, max(params.floor, float(np.quantile(false, 1 - params.false_rate)))


def fit_rows(unknown: list[str], params: Scan) -> LicenseModel:
    """Fit on the templates' variants and on paragraphs of the corpus. Those that hold much of a
    template sentence are no example of unknown. Temperature and least probability come from a
    first fit that leaves out one whole sentence of each family, with all its variants, and a
    fifth of the unknown paragraphs; the weights come from a second fit on everything."""
    clean = [p for p in unknown if _most_similar(p, TEMPLATES, params) < params.similarity / 2]
    out = {k: k % len(TEMPLATES[f]) for k, f in enumerate(TEMPLATES, start=1)}
    examples = [(text, k, number == out[k]) for text, k, number in _variants(params, clean)]
    examples += [(p, 0, i % 5 == 0) for i, p in enumerate(clean)]
    random.Random(params.seed).shuffle(examples)
    used, held = [], []
    for text, label, left_out in examples:
        (held if left_out else used).append(_example(text, label, params))
    temperature, least = _calibrated(_learn(used, params), held, params)
    everything = used + held
    random.Random(params.seed + 1).shuffle(everything)
    return LicenseModel(_learn(everything, params), temperature, least, params)


def fit_licenses(docs: DataFrame, text_col: str = "text", params: Scan = Scan()) -> LicenseModel:
    """The model for a corpus. Of it, at most ``sample`` distinct paragraphs are learnt from, of
    some 4 * sample texts; they are fitted in one task, and the weights come to the driver
    (2 ** bits rows). A corpus without paragraphs gives a model to which all are unknown."""
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    texts = texts.where(hashed_share(F.col("text"), params.sample, docs.count()))
    paragraphs = texts.select(F.explode(F.split("text", "\n")).alias("p"))
    paragraphs = paragraphs.where(F.length("p").between(12, 2_000)).distinct()
    ranked = paragraphs.select("p", F.xxhash64("p").alias("rank"))
    chosen = ranked.orderBy("rank", "p").limit(params.sample)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = fit_rows([p for b in batches for p in b["p"]], params)
        at = np.flatnonzero(np.any(model.weights != 0, axis=1))
        setting = np.array([model.temperature, model.least])
        yield pd.DataFrame({"slot": np.r_[-1, at], "w": [setting, *model.weights[at]]})

    weights, setting = np.zeros((1 << params.bits, len(FAMILIES))), (1.0, 0.5)
    one = chosen.repartition(1).sortWithinPartitions("rank", "p").select("p")
    for row in one.mapInPandas(fit, "slot int, w array<double>").collect():
        if row["slot"] < 0:
            setting = tuple(row["w"])
        else:
            weights[row["slot"]] = row["w"]
    return LicenseModel(weights, *setting, params)


FOUND = (
    "array<struct<paragraph:long,family:string,probability:double,similarity:double,"
    "confirmed:boolean>>"
)


def scan(text: str | None, model: LicenseModel) -> list[dict]:
    """Paragraphs of a text given a family, with the best share of a template they hold. A
    paragraph is a line, or a run of neighbouring lines over which a sentence is wrapped; that
    counts at its first line. The classifier names the family of either, and template sentences
    of that family confirm it. Runs of lines count only if confirmed, and then their unconfirmed
    lines of the same family do not. Of paragraphs of a family at one line, the one with the
    largest share counts, the shorter of equal ones."""
    return scan_texts([text], model)[0]


def scan_texts(texts: list[str | None], model: LicenseModel) -> list[list[dict]]:
    """The same for many texts, scored as one stream with a blank line between them."""
    params = model.params
    bodies = [(t or "").split("\n") for t in texts]
    begins = np.cumsum([0] + [len(lines) + 1 for lines in bodies])
    found: dict[int, list[tuple[int, int, int, float]]] = {}
    stream = Stream("\n\n".join(t or "" for t in texts), model)
    for first, last, family, probability in stream.named(params.longest * _longest()):
        n = int(np.searchsorted(begins, first, side="right")) - 1
        at = int(begins[n])
        found.setdefault(n, []).append((first - at, last - at, family, probability))
    return [_paragraphs(lines, found.get(n, []), params) for n, lines in enumerate(bodies)]


def _paragraphs(lines: list[str], named: list[tuple[int, int, int, float]], params: Scan) -> list[dict]:
    out: dict[tuple[int, str], tuple[float, float, bool]] = {}
    wrapped = wrapped_sentences(lines, [x for x in named if x[1] > x[0]], params)
    covered = {(i, family) for family, a, b, *_ in wrapped for i in range(a, b + 1)}
    for i, last, k, probability in named:
        if i == last:
            similar = template_similarity(lines[i], FAMILIES[k], params)
            confirmed = similar >= params.similarity
            if confirmed or (i, FAMILIES[k]) not in covered:
                out[i, FAMILIES[k]] = (probability, similar, confirmed)
    for family, i, _, probability, similar in wrapped:
        if similar > out.get((i, family), (0, 0))[1]:
            out[i, family] = (probability, similar, True)
    return [
        {"paragraph": i, "family": f, "probability": p, "similarity": similar, "confirmed": confirmed}
        for (i, f), (p, similar, confirmed) in sorted(out.items())
    ]


_STREAM_CHARS = 500_000  # of texts scored at once; a longer text is a stream by itself


def _streams(texts: pd.Series) -> Iterator[list[str | None]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text or "")
        if size >= _STREAM_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def license_column(docs: DataFrame, text: Column, model: LicenseModel) -> Column:
    """Array of the paragraphs of a whole text that are given a licence family; empty for null
    and empty texts and where every paragraph is unknown."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(FOUND)
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            found = [f for part in _streams(batch) for f in scan_texts(part, shared.value)]
            yield pd.Series(found, dtype="object")
        _cache.clear()

    return of(text)
