"""Licence scans: a trained classifier of paragraphs, confirmed by comparison with templates.

The classifier is a sparse logistic regression on word 1- and 2-grams, with a class for each licence family and one
for everything else. It is trained on the templates, whole, cut and damaged, against paragraphs of the corpus that
share little with any template and against notices of foreign licences, and calibrated by a temperature. A prediction is confirmed by the share of the
word 3-grams of a template that the paragraph has, or of the paragraph that a template has.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .language import fit_temperature

UNKNOWN = "unknown"
#: Bound of the documents, chosen by a hash, whose paragraphs train the unknown class; of each, paragraphs are drawn by a seed.
MOST_DOCUMENTS = 1_500
PARAGRAPHS_EACH = 8
#: Paragraphs over this many words are looked at in windows of as many that overlap by half.
WINDOW_WORDS = 96
#: Least calibrated score, and least overlap with a template of the family to confirm it.
LEAST_SCORE, LEAST_OVERLAP = 0.5, 0.5

# Passages of public licences and the notices that name them, by family.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the terms of the MIT license.", "SPDX-License-Identifier: MIT", "License: MIT",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0.", "SPDX-License-Identifier: Apache-2.0", "License: Apache 2.0",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Released under the BSD 3-Clause License.", "Licensed under the BSD license.", "SPDX-License-Identifier: BSD-3-Clause", "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "GPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 2.", "Released under the GPLv3.", "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0.", "Released under the Creative Commons Attribution license CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Text is available under the Creative Commons Attribution-ShareAlike License.", "Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC-BY-NC": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0.", "Released under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Released into the public domain under CC0 1.0 Universal.", "Licensed under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0",
    ],
}

# Notices of licences that are of none of these families, and forms with a place for any other name.
FOREIGN: list[str] = [
    "SPDX-License-Identifier: Zlib", "SPDX-License-Identifier: EPL-2.0", "SPDX-License-Identifier: BSL-1.0", "SPDX-License-Identifier: Artistic-2.0",
    "Licensed under the Eclipse Public License 2.0.", "Eclipse Public License 2.0", "Eclipse Public License, version 1.0", "Licensed under the Artistic License 2.0.",
    "Distributed under the Boost Software License, Version 1.0.", "Licensed under the zlib License.", "Common Development and Distribution License, version 1.0",
    "Licensed under the European Union Public Licence, version 1.2.", "Licensed under the Microsoft Public License.", "Licensed under the Open Software License, version 3.0.",
    "Licensed under the SIL Open Font License, Version 1.1.", "Licensed under the Python Software Foundation License, version 2.", "Do What The Fuck You Want To Public License, Version 2",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "This software is proprietary. All rights reserved.", "Redistribution of this software is prohibited without prior written permission.",
    "SPDX-License-Identifier: {}", "SPDX-License-Identifier: {}-1.0", "SPDX-License-Identifier: {}-2.0", "SPDX-License-Identifier: {}-3.0-only", "License: {}",
    "Licensed under the {} License.", "Released under the {} License.", "Licensed under the {} license.", "Licensed under the {} Public License, version 2.0.", "Licensed under the {} General Public License, version 3.",
    "Released under the {} Public License.", "Licensed under the {} License, Version 2.0.", "Released under {} 4.0.", "Licensed under {} 1.0.", "This project is licensed under the terms of the {} license.",
]

_TOKEN = re.compile(r"[0-9a-z]+|\n")
_FINDINGS = "doc_id long, paragraph int, first_word int, words int, license string, score double, overlap double, confirmed boolean, text string"


def tokens(text: str) -> list[str]:
    """Runs of a-z and digits, lower-cased, and line ends."""
    return _TOKEN.findall(text.lower().replace("\r", "\n"))


@dataclass
class Model:
    families: list[str]  # the last is UNKNOWN
    words: dict[str, int]  # 0 stands for every other word
    pairs: np.ndarray  # sorted keys first * len(words) + second
    word_weights: np.ndarray
    pair_weights: np.ndarray  # the last row is that of pairs without a weight
    bias: np.ndarray
    temperature: float
    grams: list[set[tuple[int, int, int]]]  # word 3-grams of each template
    owner: list[int]

    def pair_ids(self, ids: np.ndarray) -> np.ndarray:
        key = ids[:-1].astype(np.int64) * (len(self.words) + 1) + ids[1:]
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, at, len(self.pairs))

    def probabilities(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of each family for the units ids[start:end], of which none is empty: by the mean of the features' weights."""
        w = np.concatenate([np.zeros((1, len(self.bias))), np.cumsum(self.word_weights[ids], axis=0)])
        z = w[ends] - w[starts]
        if len(ids) > 1:
            p = np.concatenate([np.zeros((1, len(self.bias))), np.cumsum(self.pair_weights[self.pair_ids(ids)], axis=0)])
            z += np.where((ends - starts > 1)[:, None], p[np.maximum(ends - 1, starts)] - p[starts], 0.0)
        z = (z / np.sqrt(2 * (ends - starts) - 1)[:, None] + self.bias) / self.temperature
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def overlap(self, ids: np.ndarray, family: int) -> float:
        """The largest share of word 3-grams that the unit has of a template of the family, or such a template of the unit."""
        own = _grams(ids)
        best = 0.0
        for g, f in zip(self.grams, self.owner, strict=True):
            if f == family and own and g:
                both = len(own & g)
                best = max(best, both / len(g), both / len(own) if len(own) >= 4 else 0.0)
        return best


def _grams(ids: np.ndarray) -> set[tuple[int, int, int]]:
    x = ids.tolist()
    if len(x) < 3:
        x = [*x, -1, -1][:3] if x else []
    return set(zip(x, x[1:], x[2:], strict=False))


def units(text: str | None, model: Model) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The word ids of a whole text, and (paragraph, start, end) of its units. Paragraphs are lines."""
    if not text:
        return np.empty(0, np.int64), []
    get = model.words.get
    line_end = -1
    raw = np.array([line_end if t == "\n" else get(t, 0) for t in tokens(text)], np.int64)
    stops = np.flatnonzero(raw < 0)
    at = np.concatenate([[0], stops - np.arange(len(stops)), [len(raw) - len(stops)]]).tolist()
    out = []
    for k in range(len(at) - 1):
        s, e = at[k], at[k + 1]
        if e - s <= WINDOW_WORDS:
            if e > s:
                out.append((k, s, e))
        else:
            out += [(k, s + i, min(e, s + i + WINDOW_WORDS)) for i in range(0, e - s - WINDOW_WORDS // 2, WINDOW_WORDS // 2)]
    return raw[raw >= 0], out


def train(plain: list[list[str]], epochs: int = 30, rate: float = 0.5, l1: float = 2e-5, seed: int = 0) -> Model:
    """Trains on the templates and on plain paragraphs (lists of words) that are of no licence."""
    rng = np.random.default_rng(seed)
    families = [*TEMPLATES, UNKNOWN]
    clean = [(tokens(t), i) for i, f in enumerate(TEMPLATES) for t in TEMPLATES[f]]
    known = {w for t, _ in clean for w in t}
    words = {w: i + 1 for i, w in enumerate(sorted(known))}
    code = lambda t: np.array([words.get(w, 0) for w in t], np.int64)
    grams = [_grams(code(t)) for t, _ in clean]
    plain = [p for p in plain if p]
    odd = [list(rng.permutation(sorted(known))[: rng.integers(2, 12)]) for _ in range(300)]  # words of licences in no order
    examples: list[tuple[np.ndarray, int]] = [(code(p), len(families) - 1) for p in plain + odd]
    filler = plain or odd
    for t in FOREIGN:  # alone, and between other words, as the families' notices are
        for k in range(12):
            x = tokens(t.replace("{}", "-".join(["othername"] * (1 + k % 3))))
            if k % 2:
                a, b = (filler[int(i)] for i in rng.integers(0, len(filler), 2))
                x = [*a[: int(rng.integers(0, 8))], *x, *b[: int(rng.integers(0, 8))]]
            examples.append((code(x), len(families) - 1))
    for t, f in clean:
        for k in range(30):
            x = list(t)
            if k % 3 == 1 and len(x) > 12:
                s = int(rng.integers(0, len(x) - 10))
                x = x[s : s + int(rng.integers(10, len(x)))]
            if k % 3 == 2 and len(x) > 6:
                x = [w for w in x if rng.random() > 0.08]
            if k % 2 and k > 4:
                a, b = (filler[int(i)] for i in rng.integers(0, len(filler), 2))
                x = [*a[: int(rng.integers(0, 8))], *x, *b[: int(rng.integers(0, 8))]]
            examples.append((code(x), f))
    y = np.array([f for _, f in examples])
    n_words = len(words) + 1
    keys = [x[:-1] * n_words + x[1:] for x, _ in examples]
    of_templates = np.unique(np.concatenate([k for k, f in zip(keys, y, strict=True) if f < len(families) - 1]))
    pairs = of_templates[(of_templates // n_words > 0) & (of_templates % n_words > 0)]
    model = Model(families, words, pairs, np.zeros((n_words, len(families))), np.zeros((len(pairs) + 1, len(families))), np.zeros(len(families)), 1.0, grams, [f for _, f in clean])
    idx = [np.concatenate([x, n_words + model.pair_ids(x)]) if len(x) > 1 else x for x, _ in examples]
    size = [1 / np.sqrt(max(1, len(i))) for i in idx]
    w = np.zeros((n_words + len(pairs) + 1, len(families)))
    squares, bias = np.full_like(w, 1e-6), np.zeros(len(families))
    learn = rng.random(len(examples)) > 0.15
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(np.flatnonzero(learn)), max(1, int(learn.sum()) // 64)):
            flat = np.concatenate([idx[i] for i in at])
            own = np.repeat(np.arange(len(at)), [len(idx[i]) for i in at])
            scale = np.array([size[i] for i in at])
            z = np.zeros((len(at), len(families)))
            np.add.at(z, own, w[flat])
            z = z * scale[:, None] + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(at)), y[at]] -= 1
            p /= len(at)
            g = np.zeros_like(w)
            np.add.at(g, flat, (p * scale[:, None])[own])
            squares += g * g
            step = rate / np.sqrt(squares) * 0.2
            w -= step * g
            w = np.sign(w) * np.maximum(np.abs(w) - l1 * rate, 0)
            bias -= rate * p.sum(0)
    model.word_weights, model.pair_weights, model.bias = w[:n_words], w[n_words:], bias
    held = np.flatnonzero(~learn)
    z = np.array([w[idx[i]].sum(0) * size[i] + bias for i in held]) if len(held) else np.zeros((0, len(families)))
    model.temperature = fit_temperature(z, y[held])
    return model


def fit(docs: DataFrame, most_documents: int = MOST_DOCUMENTS) -> Model:
    """Trains with paragraphs of a bounded sample of docs for the unknown class."""
    rows = docs.where("text is not null")
    n = rows.count()
    h = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    known = {g for ts in TEMPLATES.values() for t in ts for g in _word_grams(tokens(t))}

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for t in batch[0].to_pylist():
                lines = [x for x in "\x00".join(tokens(t)).split("\n") if x.strip("\x00")]
                rng = np.random.default_rng(len(t))
                for i in rng.permutation(len(lines))[:PARAGRAPHS_EACH].tolist():
                    ws = lines[i].strip("\x00").split("\x00")
                    if not known.intersection(_word_grams(ws)):
                        at = int(rng.integers(0, max(1, len(ws) - WINDOW_WORDS)))
                        out.append(" ".join(ws[at : at + WINDOW_WORDS]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["words"])

    sample = rows.where(h < F.lit(0.9 * most_documents / max(1, n))).select(F.col("text").cast("string")).limit(most_documents)
    return train([r.words.split(" ") for r in sorted(sample.mapInArrow(draw, "words string").collect())])


def _word_grams(ws: list[str]) -> set[tuple[str, ...]]:
    return set(zip(ws, ws[1:], ws[2:], strict=False))


def scan(docs: DataFrame, model: Model, least_score: float = LEAST_SCORE, least_overlap: float = LEAST_OVERLAP) -> DataFrame:
    """A row for each paragraph of each row of docs that a licence family is predicted for: see license_paragraphs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unknown = len(model.families) - 1
        for batch in slices(batches, 64):
            rows: list[tuple] = []
            for doc_id, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                ids, own = units(text, model)
                for block in range(0, len(own), 4096):
                    part = own[block : block + 4096]
                    base = part[0][1]
                    s, e = np.array([u[1] for u in part]) - base, np.array([u[2] for u in part]) - base
                    p = model.probabilities(ids[base : base + int(e.max())], s, e)
                    best = p.argmax(1)
                    score = p[np.arange(len(p)), best]
                    lines = None
                    for i in np.flatnonzero((best != unknown) & (score >= least_score)).tolist():
                        k, start, end = part[i]
                        if lines is None:
                            lines = text.lower().replace("\r", "\n").split("\n")  # as the paragraphs are counted
                        overlap = model.overlap(ids[start:end], int(best[i]))
                        rows.append((doc_id, k, start, end - start, model.families[best[i]], float(score[i]), overlap, overlap >= least_overlap, lines[k]))
            if rows:
                types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[c.split()[0] for c in _FINDINGS.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _FINDINGS)


def license_paragraphs(docs: DataFrame, **how) -> DataFrame:
    """doc_id, paragraph (line, from 0), first_word, words, license, score, overlap, confirmed and the line's text.

    One row per paragraph, or window of a long one, that a family is predicted for; confirmed says whether a
    template bears the prediction out. Null, empty and wordless texts have no paragraphs. Null doc_id and repeated
    rows: findings for each. Empty table: no rows. Extra columns are ignored.
    """
    return scan(docs, fit(docs), **how)
