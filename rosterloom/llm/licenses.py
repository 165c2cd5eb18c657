"""Licence scans: a trained paragraph classifier with a calibrated unknown class, confirmed by templates.

A paragraph is a line of a text.  Its features are hashed runs of one and two words; a multinomial logistic
regression gives each licence family, and *unknown*, a probability.  It is trained here: on
varied template sentences of the families, and on ordinary lines of the corpus for unknown.  A held-out part
sets the temperature that makes the probabilities honest and the least probability that counts.
A prediction stands only if the paragraph shares most of its word pairs with a template of the family.

The fit sees at most ``max_docs`` documents (those with the smallest hash of their id) and ``max_lines`` of their
lines; scoring covers every line of every text, as arrays over whole chunks.

Defined results: null and empty texts have no paragraph; lines without a word are none either; without any text to
sample, unknown is learned from the made-up ordinary sentences alone; repeated rows are scanned alike.  The column ``licences``
replaces one of that name; other columns stay as they are.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.words import ALNUM_BYTES, LOWER, Words, chunks, code_points_before, run_hashes

MAX_DOCS, MAX_LINES, MAX_LINE_CHARS = 500, 4_000, 2_000
BITS = 16
VARIANTS = 24
MIN_OVERLAP = 0.6
UNKNOWN = "unknown"
#: Head start of unknown; it is not fitted, so that words decide rather than how often a class is met.
PRIOR = 2.0
SEED = 7

# What notices of the families say.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GNU General Public License, version 2.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Licensed under the 2-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License 2.0.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released into the public domain under CC0 1.0 Universal.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose.",
    ),
    "Proprietary": (
        "All rights reserved.",
        "Copyright the authors. All rights reserved.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
    ),
}
ORDINARY = (
    "The driver showed a license at the gate and was let in.", "She asked for permission to use the room on the second floor.",
    "The software was slow and the new version is not better.", "A copy of the letter was sent to all members of the family.",
    "Under the terms of the peace the general had to leave the town.", "The public was not free to enter the library at night.",
    "He works for a company that sells source code.", "All seats are reserved for the guests of the house.",
    "The work of the foundation is known in all of the country.", "This is the first version of a long story about the sea.",
)


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of each run of one and two words."""
    hashes = words.hashes()
    one = np.arange(len(words)), hashes >> np.uint64(64 - BITS)
    two = words.run_starts(2)
    pairs = run_hashes(hashes, 2)[two] if len(two) else np.empty(0, np.uint64)
    return np.concatenate([one[0], two]), np.concatenate([one[1], pairs >> np.uint64(64 - BITS)]).astype(np.int64)


def _sparse(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, bucket, value): counts over the root of the line's number of features."""
    row, bucket = [], []
    for chunk in chunks(pa.array(lines, pa.string())):
        words = chunk.words(lower=True, table=ALNUM_BYTES)
        at, b = _features(words)
        row.append(words.text_of()[at] + chunk.first_row)
        bucket.append(b)
    rows, buckets = np.concatenate(row), np.concatenate(bucket)
    total = np.bincount(rows, minlength=len(lines))
    return rows, buckets, 1 / np.sqrt(total[rows])


@dataclass
class Model:
    families: list[str]  # unknown comes first
    weights: np.ndarray  # bucket x family
    bias: np.ndarray
    temperature: float
    least: float
    held_out: dict[str, float]

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        z = (scores + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def score(self, lines: list[str]) -> np.ndarray:
        rows, buckets, values = _sparse(lines)
        out = np.zeros((len(lines), len(self.families)))
        np.add.at(out, rows, self.weights[buckets] * values[:, None])
        return out


def variants(rng: random.Random) -> list[tuple[str, str]]:
    """(family, line): the templates, varied as notices vary."""
    ahead = ("", "", "Copyright (c) 2019 Ada Example. ", "Note: ", "This package. ", "# ", "// ", "* ")
    behind = ("", "", " See the file LICENSE.", " See LICENSE for details.", " Thank you.")
    out = []
    for family, sentences in TEMPLATES.items():
        for sentence in sentences:
            for k in range(VARIANTS):
                words = sentence.split()
                if k and len(words) > 12:  # long paragraphs are often cut or wrapped
                    size = rng.randint(8, len(words))
                    start = rng.randint(0, len(words) - size)
                    words = words[start : start + size]
                    if size > 12 and rng.random() < 0.5:
                        del words[rng.randrange(len(words))]
                text = " ".join(words)
                text = text.upper() if rng.random() < 0.1 else text
                out.append((family, rng.choice(ahead) + text + rng.choice(behind) if k else sentence))
    return out


def train(ordinary: list[str], steps: int = 300, rate: float = 4.0, decay: float = 1e-5) -> Model:
    """Fits, calibrates and measures the classifier; every fifth line is held out."""
    rng = random.Random(SEED)
    known = variants(rng)
    rest = [line for line in ordinary if line.strip() and max(overlap(own, f) for own in [_pairs(line)] for f in TEMPLATES) < MIN_OVERLAP]
    mixed = [" ".join(w for s in rng.sample(ORDINARY, 2) for w in s.split() if rng.random() < 0.9) for _ in range(200)]
    data = known + [(UNKNOWN, line) for line in [*ORDINARY, *mixed, *rest]]
    rng.shuffle(data)
    families = [UNKNOWN, *TEMPLATES]
    target = np.array([families.index(f) for f, _ in data])
    held = np.arange(len(data)) % 5 == 0
    rows, buckets, values = _sparse([line for _, line in data])
    licence = np.isin(target[rows], 0, invert=True) & ~held[rows]
    used = np.unique(buckets[licence])  # only what licences say can speak for one
    keep = np.isin(buckets, used)
    rows, columns, values = rows[keep], np.searchsorted(used, buckets[keep]), values[keep]
    matrix = np.zeros((len(data), len(used)), np.float32)
    np.add.at(matrix, (rows, columns), values)
    x, y = matrix[~held], target[~held]
    balance = np.sqrt(len(y) / np.maximum(np.bincount(y, minlength=len(families)), 1))[y]
    balance /= balance.mean()
    weights, bias = np.zeros((len(used), len(families)), np.float32), np.zeros(len(families), np.float32)
    bias[0] = PRIOR
    pull = np.zeros_like(weights)
    for _ in range(steps):  # gradient steps with momentum
        z = x @ weights + bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        z /= z.sum(axis=1, keepdims=True)
        z[np.arange(len(y)), y] -= 1
        z *= balance[:, None] / len(y)
        pull = 0.9 * pull + x.T @ z + decay * weights
        weights -= rate * pull
    logits, truth = matrix[held] @ weights + bias, target[held]

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(truth)), truth]))

    temperature = min((0.25 * 1.1**k for k in range(40)), key=loss)  # never sharper than four times the fit
    full = np.zeros((1 << BITS, len(families)), np.float32)
    full[used] = weights
    model = Model(families, full, bias, temperature, 0.5, {})
    chance = model.probabilities(logits - bias)
    guess = chance.argmax(axis=1)
    wrong = chance[np.arange(len(truth)), guess][(guess > 0) & (truth == 0)]
    model.least = float(min(0.9, max(0.5, wrong.max() if len(wrong) else 0.5)))
    stands = np.where(chance.max(axis=1) >= model.least, guess, 0)
    model.held_out = {"lines": float(len(truth)), "accuracy": float((stands == truth).mean()), "false_alarms": float(((stands > 0) & (truth == 0)).sum())}
    return model


def _pairs(text: str) -> set[bytes]:
    words = next(chunks(pa.array([text], pa.string()))).words(lower=True, table=ALNUM_BYTES) if text else None
    own = [words.data[s:e].tobytes() for s, e in zip(words.start, words.end)] if words else []
    return {a + b" " + b for a, b in zip(own, own[1:])} or set(own)


_TEMPLATE_PAIRS = {family: [_pairs(s) for s in sentences] for family, sentences in TEMPLATES.items()}


def overlap(own: set[bytes], family: str) -> float:
    """Word pairs shared with the nearest template of the family, over those of the shorter one (three at least)."""
    return max((len(own & t) / max(min(len(own), len(t)), min(3, len(t))) for t in _TEMPLATE_PAIRS[family]), default=0.0)


_SPANS = "struct<n_paragraphs:bigint,n_predicted:bigint,spans:array<struct<family:string,start:int,end:int,probability:double,overlap:double>>>"
_SPAN = pa.struct([("family", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64()), ("overlap", pa.float64())])


def _scan(texts: pa.Array, model: Model, min_overlap: float) -> pa.Array:
    n_paragraphs: list[int] = []
    n_predicted = np.zeros(len(texts), np.int64)
    spans: list[list[dict]] = [[] for _ in range(len(texts))]
    spoken = np.abs(model.weights).max(axis=1) > 0
    for chunk in chunks(texts):
        data = chunk.data
        ends = np.flatnonzero(data == 0x0A)
        bounds = np.unique(np.concatenate([chunk.offsets, ends + 1]))  # a line begins at each of them
        lines = Words(LOWER[data], bounds, ALNUM_BYTES)
        with_words = np.flatnonzero(lines.counts)
        owner = np.searchsorted(chunk.offsets, bounds[:-1], side="right") - 1
        n_paragraphs += np.bincount(owner[with_words], minlength=len(chunk))[: len(chunk)].tolist()
        if not len(with_words):
            continue
        at, bucket = _features(lines)
        total = lines.counts + np.maximum(lines.counts - 1, 0)
        said = spoken[bucket]
        line = lines.text_of()[at[said]]
        order = np.argsort(line, kind="stable")
        line, bucket = line[order], bucket[said][order]
        if not len(line):
            continue
        firsts = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
        scores = np.add.reduceat(model.weights[bucket], firsts, axis=0) / np.sqrt(total[line[firsts]])[:, None]
        chance = model.probabilities(scores)
        guess = chance.argmax(axis=1)
        chosen = np.flatnonzero((guess > 0) & (chance.max(axis=1) >= model.least))
        if not len(chosen):
            continue
        before = code_points_before(data)
        for k in chosen.tolist():
            number = int(line[firsts[k]])
            d, a, b = int(owner[number]), int(bounds[number]), int(bounds[number + 1])
            own = data[a:b].tobytes().decode().rstrip("\n")
            family = model.families[guess[k]]
            n_predicted[chunk.first_row + d] += 1
            shared = overlap(_pairs(own), family)
            if shared >= min_overlap:
                start = int(before[a] - before[chunk.offsets[d]])
                spans[chunk.first_row + d].append(
                    {"family": family, "start": start, "end": start + len(own), "probability": float(chance[k, guess[k]]), "overlap": shared}
                )
    return pa.StructArray.from_arrays([pa.array(n_paragraphs, pa.int64()), pa.array(n_predicted), pa.array(spans, pa.list_(_SPAN))], ["n_paragraphs", "n_predicted", "spans"])


def ordinary_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_docs: int = MAX_DOCS, max_lines: int = MAX_LINES) -> list[str]:
    """The bounded sample of corpus lines that stands for unknown: lines of 1 to ``MAX_LINE_CHARS`` code points of ``max_docs`` documents.

    The documents are those with the lowest hashes of their ids.  Hashes alone are put in order first; the last one is the
    limit that texts are read by, so no task is sent more texts than are taken.
    """
    keyed = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"), F.xxhash64(doc_id).alias("h"), F.xxhash64(text).alias("x"))
    last = keyed.select("h", "x").orderBy("h", "x").limit(max_docs).agg(F.max(F.struct("h", "x"))).first()[0]
    if last is None:
        return []
    within = (F.col("h") < last.h) | ((F.col("h") == last.h) & (F.col("x") <= last.x))
    some = keyed.where(within).orderBy("h", "x", "id", "t").limit(max_docs)
    lines = some.select(F.explode(F.split("t", "\n")).alias("line")).where(F.length("line").between(1, MAX_LINE_CHARS)).distinct()
    return [r.line for r in lines.orderBy(F.xxhash64("line"), "line").limit(max_lines).collect()]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    return train(ordinary_lines(docs, doc_id, text))


def scan(docs: DataFrame, model: Model, text: str = "text", min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """Adds ``licences``: struct of n_paragraphs, n_predicted and confirmed spans (code points) with their evidence."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size
    find = F.arrow_udf(lambda texts: _scan(texts, shared.value, min_overlap), _SPANS).asNondeterministic()
    return docs.withColumn("licences", find(F.col(text)))


def op10_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs, fit(docs))
    spans = F.col("licences.spans")
    listed = F.transform(spans, lambda s: F.concat_ws(":", s["family"], s["start"].cast("string"), s["end"].cast("string")))
    return found.select(
        "doc_id", "licences.n_paragraphs", "licences.n_predicted", F.size(spans).cast("bigint").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["family"]))), ",").alias("families"),
        F.array_join(listed, ",").alias("spans"),
    )
