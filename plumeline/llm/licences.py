"""Licence families of paragraphs by a trained classifier.

Features are word bigrams and trigrams; a multinomial logistic regression tells the
families, an ``unknown`` class (licence talk of no family) and ``none`` (other text) apart.
It is fitted on variations of the notices below and on a bounded sample of the
corpus.  Held-out variations calibrate its confidence by one temperature; a family whose
calibrated probability is under ``SURE`` becomes ``unknown``.  A family is confirmed when the paragraph
holds at least ``CONFIRMED`` of the trigrams of one of its notices (bigrams, of two-word notices), and no larger share of
a notice of another family.

Every line is judged.  Adjacent lines with words (comment marks are none) are a block, and a notice whose
trigrams follow each other over lines of a block is a paragraph of these lines, judged as one in place of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from plumeline.llm.common import hash_sample

# Customary wording of licence notices, by family.
NOTICES = {
    "mit": [
        "released under the mit license",
        "this project is licensed under the terms of the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability",
        "spdx-license-identifier mit",
    ],
    "apache": [
        "licensed under the apache license version 2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at apache.org",
        "apache license version 2.0 january 2004",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
        "spdx-license-identifier apache-2.0",
    ],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
        "released under the gnu gpl version 2 or later",
        "you should have received a copy of the gnu general public license along with this program",
    ],
    "lgpl": [
        "licensed under the gnu lesser general public license version 2.1",
        "this library is free software you can redistribute it under the terms of the gnu lesser general public license",
        "you should have received a copy of the gnu lesser general public license along with this library",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted",
        "released under the bsd 3-clause license",
        "use of this source code is governed by a bsd style license",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
        "spdx-license-identifier bsd-3-clause",
    ],
    "mpl": [
        "this source code form is subject to the terms of the mozilla public license v 2.0",
        "licensed under the mozilla public license version 2.0",
    ],
    "epl": [
        "made available under the terms of the eclipse public license v 2.0",
        "licensed under the eclipse public license version 1.0",
        "eclipse public license v 2.0",
    ],
    "boost": [
        "distributed under the boost software license version 1.0",
    ],
    "cc-by": [
        "licensed under cc by 4.0",
        "this work is licensed under a creative commons attribution 4.0 international license",
        "licensed under cc by-sa 4.0",
    ],
    "cc-by-nc": [
        "licensed under cc by-nc 4.0",
        "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
    ],
    "public-domain": [
        "this work has been dedicated to the public domain under cc0 1.0 universal",
        "this is free and unencumbered software released into the public domain",
    ],
}
# Licence talk that names no family.
UNKNOWN = [
    "all rights reserved no part of this work may be reproduced without permission",
    "licensed under the terms of the vendor agreement",
    "this software is licensed under a proprietary license",
    "use of this product is subject to the end user license agreement",
    "released under a license of its own",
    "this work is licensed under the house license version 1",
    "see the license file for the terms of use",
]
WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
#: Documents sampled for the class ``none``, about; paragraphs used of them.
SAMPLE_DOCS = 1500
SAMPLE_PARAGRAPHS = 3000
VARIATIONS = 60
SURE = 0.6
CONFIRMED = 0.5
#: Words that may be missing or added between two trigrams of a wrapped notice.
GAP = 12


def grams(paragraph: str) -> set[tuple[str, ...]]:
    """Bigrams and trigrams of a paragraph's lower-cased words."""
    found = WORD.findall(paragraph.lower())
    return {*zip(found, found[1:]), *zip(found, found[1:], found[2:])}


def _template(notice: str) -> frozenset:
    """What a paragraph is compared with: the notice's trigrams, or its bigram."""
    found = WORD.findall(notice.lower())
    return frozenset(zip(found, found[1:], found[2:]) if len(found) > 2 else zip(found, found[1:]))


TEMPLATES = {family: [_template(n) for n in notices] for family, notices in [*NOTICES.items(), ("unknown", UNKNOWN)]}


def _share(own: set[tuple[str, ...]], family: str) -> float:
    """The largest share of one of a family's templates that ``own`` holds."""
    return max(len(own & t) / len(t) for t in TEMPLATES[family])


@dataclass
class Classifier:
    classes: list[str]
    feature: dict[tuple[str, ...], int]
    weights: np.ndarray  # features x classes
    bias: np.ndarray
    temperature: float = 1.0

    def probabilities(self, rows: list[list[int]]) -> np.ndarray:
        score = np.array([self.bias + self.weights[row].sum(axis=0) for row in rows]).reshape(len(rows), -1) / self.temperature
        score = np.exp(score - score.max(axis=1, keepdims=True))
        return score / score.sum(axis=1, keepdims=True)

    def rows_of(self, paragraph: str) -> list[int]:
        look = self.feature
        return [look[g] for g in grams(paragraph) if g in look]

    def judge(self, paragraph: str) -> tuple[str, float, float, bool] | None:
        """Family or ``unknown``, its probability, the best template overlap and whether it
        confirms; None for other text."""
        row = self.rows_of(paragraph)
        if not row:  # all that is left is the bias, which says none
            return None
        p = self.probabilities([row])[0]
        best = int(p.argmax())
        if self.classes[best] == "none":
            return None
        family = self.classes[best] if p[best] >= SURE else "unknown"
        if family == "unknown":
            return family, float(p[self.classes.index("unknown")] if self.classes[best] == "unknown" else 1 - p[best]), 0.0, False
        own = grams(paragraph)
        overlap = _share(own, family)
        rival = max(_share(own, other) for other in NOTICES if other != family)
        return family, float(p[best]), overlap, overlap >= CONFIRMED and overlap >= rival


def _places() -> tuple[dict[tuple[str, ...], list[tuple[int, int]]], list[int]]:
    """Notices and places in them of every trigram, and the trigrams each notice has."""
    places: dict[tuple[str, ...], list[tuple[int, int]]] = {}
    sizes = []
    for notice in [n for notices in [*NOTICES.values(), UNKNOWN] for n in notices]:
        found = WORD.findall(notice.lower())
        grams3 = list(dict.fromkeys(zip(found, found[1:], found[2:])))
        for at, gram in enumerate(grams3):
            places.setdefault(gram, []).append((len(sizes), at))
        sizes.append(len(grams3))
    return places, sizes


PLACES, SIZES = _places()


def wrapped(lines: list[str]) -> list[tuple[int, int]]:
    """``[first, last)`` of the adjacent lines that hold a notice over several lines."""
    found: set[tuple[int, int]] = set()
    words: list[str] = []
    owner: list[int] = []

    def block() -> None:
        if not owner or owner[0] == owner[-1]:
            return
        # Per notice the first and last word, the last place and the trigrams of the run under way.
        open_runs: dict[int, list[int]] = {}

        def close(notice: int) -> None:
            first, last, _, count = open_runs.pop(notice)
            if owner[first] != owner[last] and count >= CONFIRMED * SIZES[notice]:
                found.add((owner[first], owner[last] + 1))

        for i, gram in enumerate(zip(words, words[1:], words[2:])):
            for notice, at in PLACES.get(gram, ()):
                run = open_runs.get(notice)
                if run and (at <= run[2] or i > run[1] + GAP):
                    close(notice)
                    run = None
                if run:
                    run[1], run[2], run[3] = i + 2, at, run[3] + 1
                else:
                    open_runs[notice] = [i, i + 2, at, 1]
        for notice in list(open_runs):
            close(notice)

    for k, line in enumerate(lines):
        own = WORD.findall(line.lower())
        if not own:
            block()
            words, owner = [], []
        words += own
        owner += [k] * len(own)
    block()
    return sorted(found)


def paragraphs(classifier: Classifier, text: str) -> list[tuple]:
    """``first line, family, probability, overlap, confirmed, text`` of a text's notices, in order."""
    lines = text.split("\n")
    ranges: dict[str, list[list[int]]] = {}
    for first, last in wrapped(lines):
        found = classifier.judge("\n".join(lines[first:last]))
        if found:
            own = ranges.setdefault(found[0], [])
            if own and first < own[-1][1]:  # notices of one family that share a line
                own[-1][1] = max(own[-1][1], last)
            else:
                own.append([first, last])
    rows, inside = [], {}
    for family, own in ranges.items():
        for first, last in own:
            body = "\n".join(lines[first:last])
            found = classifier.judge(body)
            if found and found[0] == family:
                rows.append((first, *found, body))
                for k in range(first, last):
                    inside.setdefault(k, set()).add(family)
    for k, line in enumerate(lines):
        found = classifier.judge(line)
        if found and (k not in inside or _apart(line, found[0], inside[k])):
            rows.append((k, *found, line))
    return sorted(rows, key=lambda r: r[:2])


def _apart(line: str, family: str, others: set[str]) -> bool:
    """Whether a line of paragraphs of ``others`` confirms another family by trigrams that they have not."""
    if family in others or family == "unknown":
        return False
    return _share(grams(line).difference(*(t for f in others for t in TEMPLATES[f])), family) >= CONFIRMED


def _variations(notice: str, filler: list[str], count: int, random: np.random.Generator) -> list[str]:
    """The notice with up to a sixth of its words lost and other words around it."""
    words, out = notice.split(), [notice]
    for _ in range(count - 1):
        kept = [w for w in words if random.random() > random.choice([0, 0, 0.08, 0.16])]
        around = [list(random.choice(filler, size=int(random.integers(0, 12)))) if filler else [] for _ in range(2)]
        out.append(" ".join([*around[0], *kept, *around[1]]))
    return out


def train(background: list[str], seed: int = 11) -> Classifier:
    """Fit on the notices and on paragraphs of the corpus; every fifth variation is held out for calibration."""
    random = np.random.default_rng(seed)
    classes = [*NOTICES, "unknown", "none"]
    filler = [w for p in background[:200] for w in WORD.findall(p.lower())]
    texts, labels = [], []
    for family, notices in [*NOTICES.items(), ("unknown", UNKNOWN)]:
        for notice in notices:
            made = _variations(notice, filler, VARIATIONS, random)
            texts += made
            labels += [classes.index(family)] * len(made)
    notice_grams = {g for notices in [*NOTICES.values(), UNKNOWN] for n in notices for g in grams(n)}
    cues = {g for g in notice_grams if len(g) == 3}
    others = [p for p in background if not grams(p) & cues]
    texts += others
    labels += [classes.index("none")] * len(others)
    feature = {g: i for i, g in enumerate(sorted(notice_grams))}
    y = np.array(labels)
    x = np.zeros((len(texts) + len(classes), len(feature)), dtype=np.float32)
    for i, text in enumerate(texts):
        for g in grams(text):
            if g in feature:
                x[i, feature[g]] = 1
    x = x[: len(texts)]
    held = np.arange(len(texts)) % 5 == 4
    weights = np.zeros((len(feature), len(classes)), dtype=np.float32)
    bias = np.zeros(len(classes), dtype=np.float32)
    bias[-1] = 1.0
    speed_w, speed_b = np.zeros_like(weights), np.zeros_like(bias)
    xt, yt = x[~held], np.eye(len(classes), dtype=np.float32)[y[~held]]
    for _ in range(300):
        score = xt @ weights + bias
        score = np.exp(score - score.max(axis=1, keepdims=True))
        error = (score / score.sum(axis=1, keepdims=True) - yt) / len(xt)
        speed_w = 0.9 * speed_w - 4.0 * (xt.T @ error + 2e-5 * weights)
        speed_b = 0.9 * speed_b - 0.5 * error.sum(axis=0)
        weights += speed_w
        bias += speed_b
    bias[-1] = max(bias[-1], bias[:-1].max() + 1.0)  # no feature at all means other text
    score = x[held] @ weights + bias
    best, least = 1.0, np.inf
    for temperature in np.geomspace(0.25, 8, 41):
        s = score / temperature
        s = s - s.max(axis=1, keepdims=True)
        loss = float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), y[held]]).mean()) if len(s) else 0.0
        if loss < least:
            best, least = float(temperature), loss
    return Classifier(classes, feature, weights.astype(np.float64), bias.astype(np.float64), best)


def fit(docs: DataFrame) -> Classifier:
    """Classifier whose class ``none`` is ``SAMPLE_PARAGRAPHS`` lines, at most, of about
    ``SAMPLE_DOCS`` documents, of each its first 20 lines of up to 2,000 characters."""
    lines = F.transform(F.slice(F.split("text", "\n"), 1, 20), lambda x: F.substring(x, 1, 2000))
    texts = docs.select("doc_id", "text").where("text is not null")
    rows = hash_sample(texts, F.xxhash64("doc_id", "text"), SAMPLE_DOCS).select("doc_id", lines.alias("lines")).collect()
    paragraphs = sorted(line for r in rows for line in r["lines"] if line.strip())
    step = max(1, len(paragraphs) // SAMPLE_PARAGRAPHS)
    return train(paragraphs[::step][:SAMPLE_PARAGRAPHS])


def _scan(classifier: Classifier, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [id_type, pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.string()]
        names = ["doc_id", "paragraph", "family", "probability", "overlap", "confirmed", "text"]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                rows += [(doc_id, *found) for found in paragraphs(classifier, text.as_py() or "")]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return run


def scan(docs: DataFrame) -> DataFrame:
    """A row for every paragraph (a line, or the lines of a wrapped notice) that speaks of a licence: ``doc_id,
    paragraph, family, probability, overlap, confirmed, text``, ``paragraph`` being its first line.

    ``docs`` needs ``doc_id, text``; other columns are ignored.  Null and empty texts give nothing, repeated rows
    their paragraphs each; no rows give no rows.  Every line of every text is scored; one pass, no shuffle.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, paragraph int, family string, probability double, overlap double, confirmed boolean, text string"
    return docs.select("doc_id", "text").mapInArrow(_scan(fit(docs), to_arrow_type(docs.schema["doc_id"].dataType)), shape)
