"""Operator 3: licence scan.

Every paragraph (line; windows of ``WINDOW`` words in longer ones) is scored by
a logistic regression over hashed word unigrams and bigrams, one class for each
licence family and one for "unknown".  It is trained here on variations of the
families' notices (words dropped, cut off, set in other text, two licences on
a line) against paragraphs of a bounded sample of ``sample_docs`` documents and
notices of licences that are no family of ours.  A held-out part of both, which
has unknown licences that training has not, calibrates it: a temperature for
the probabilities, and the least probability (0.1 to 0.95) at which at most one
in a thousand paragraphs without a known licence are named and confirmed.  A
named paragraph counts for every family that a template confirms: half of the word
pairs of the shorter of the two (six at least, unless the template has fewer) agree, and among them is a pair that only
templates of this family, and no notices of other licences, have.

One scan of the documents, after two for the sample, of which one shuffles
hashes; the model has a fixed size.

Defined results: null and empty texts and blank lines have no rows; repeated
rows are scanned each; a very long text is scanned whole, in windows; a line
has one row a family, of its best window; equal hashes in the sample leave the
smaller text; an empty table trains on templates alone; other columns are not
read, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import U, mix

BITS, WINDOW, STRIDE, LEAST_PAIRS = 15, 60, 30, 6
STRIP = b".,;:!?()[]{}<>\"'*#$%&|=/\\-"

#: Notices of each family (fixed values: public licence texts and usual short forms).
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Apache License"),
    "MIT": (
        "Released under the MIT License.", "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "MIT License"),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Distributed under the BSD 3-Clause License.", "BSD License", "BSD 2-Clause License"),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "Released under the GPL v2.", "GNU General Public License", "GNU GPL"),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library. If not, see https://www.gnu.org/licenses/.",
        "Licensed under the GNU Lesser General Public License, version 3.", "Lesser General Public License", "GNU LGPL"),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "Affero General Public License", "GNU AGPL"),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.", "Mozilla Public License"),
    "EPL": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "Licensed under the Eclipse Public License, version 2.0.", "Eclipse Public License"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.", "ISC License"),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0.",
        "Content is available under the Creative Commons Attribution licence unless otherwise noted."),
    "CC-BY-SA": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply."),
    "CC-BY-NC": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0.",
        "This content may be shared for noncommercial purposes under CC BY-NC-SA 4.0."),
    "CC0": (
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
        "This work is dedicated to the public domain under CC0 1.0 Universal."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",),
    "Proprietary": (
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
        "This software is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited."),
}
#: SPDX identifiers of the families (fixed values).
IDENTIFIERS = {
    "Apache-2.0": ("Apache-2.0",), "MIT": ("MIT",), "BSD": ("BSD-2-Clause", "BSD-3-Clause"),
    "GPL": ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"),
    "LGPL": ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "AGPL": ("AGPL-3.0-only", "AGPL-3.0-or-later"), "MPL": ("MPL-2.0",), "EPL": ("EPL-1.0", "EPL-2.0"), "ISC": ("ISC",),
    "CC-BY": ("CC-BY-4.0",), "CC-BY-SA": ("CC-BY-SA-4.0",), "CC-BY-NC": ("CC-BY-NC-4.0",), "CC0": ("CC0-1.0",),
    "Unlicense": ("Unlicense",),
}
#: Licences that are none of the families (fixed values), and how notices name them.
OTHERS = ("Zlib", "Artistic", "PostgreSQL", "OpenSSL", "Ruby", "PHP", "Vim", "Python Software Foundation", "Common Development and Distribution",
          "Microsoft Public", "SIL Open Font", "Open Data Commons", "Academic Free", "Sleepycat", "Beerware", "Business Source",
          "Server Side Public", "Elastic", "Example Corp", "Acme Commercial", "Community", "Internal Use", "Evaluation", "Standard Vendor")
NOTICES = ("Released under the {} License.", "Released under the {} license of the vendor.", "Licensed under the {} License, version 2.0.",
           "This project is licensed under the terms of the {} license.", "Distributed under the {} Software License.",
           "SPDX-License-Identifier: {}", "This work is licensed under a {} 4.0 International License.", "{} License",
           "Use of this source code is governed by a {} license that can be found in the LICENSE file.")
EITHER = ("{} OR {}", "SPDX-License-Identifier: {} OR {}", "SPDX-License-Identifier: ({} AND {})")
#: Text about licences that grants none.
NEAR_MISSES = (
    "A driving licence is required to rent a car in this country.", "He lost his license after the accident and could not work.",
    "The general public was free to visit the foundation on Sunday.", "The version of the story that the apache told was different.",
    "She works at the institute of technology and likes free software.", "The committee discussed the license fee for public television.",
    "Please read the terms and conditions before you open an account.", "The restaurant was granted a licence to sell wine.",
)
FAMILIES = tuple(TEMPLATES)
_MEMO: dict[bytes, int] = {}


def _hashes(words: list[bytes]) -> np.ndarray:
    if len(_MEMO) > 400_000:
        _MEMO.clear()
    memo = _MEMO
    for w in set(words):
        if w not in memo:
            memo[w] = xxhash.xxh3_64_intdigest(w.strip(STRIP) or w)
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def _pairs(h: np.ndarray) -> np.ndarray:
    return mix(h[:-1] * U(3) + mix(h[1:]))


def _features(h: np.ndarray) -> np.ndarray:
    """Distinct feature numbers of one paragraph."""
    return np.unique(np.concatenate([mix(h), _pairs(h)]) >> U(64 - BITS)).astype(np.int64)


def windows(text: str | None) -> list[tuple[int, list[bytes]]]:
    """(line number, words) of every paragraph or window of one."""
    out = []
    for no, line in enumerate((text or "").encode("utf-8", "surrogatepass").lower().split(b"\n")):
        words = line.split()
        if len(words) <= WINDOW:
            if words:
                out.append((no, words))
        else:
            out += [(no, words[at:at + WINDOW]) for at in range(0, len(words) - STRIDE, STRIDE)]
    return out


class Model:
    """Weights, temperature and least probability; class 0 is unknown."""

    def __init__(self, negatives: list[list[bytes]], seed: int = 11, epochs: int = 12, copies: int = 40):
        rng = np.random.default_rng(seed)
        cut_up = lambda t: t.lower().encode().split()
        notices = {f: [*ts, *(f"SPDX-License-Identifier: {x}" for x in IDENTIFIERS.get(f, ()))] for f, ts in TEMPLATES.items()}
        pair_set = lambda t: np.unique(_pairs(_hashes(cut_up(t))))
        ids = [(f, x) for f, xs in IDENTIFIERS.items() for x in xs]
        joins = [form for word in ("OR", "AND") for form in (f"{{}} {word}", f"{word} {{}}")]
        # an identifier with a number is a name by itself, "mit or" is one only next to another identifier
        either = [(f, form.format(x)) for f, x in ids for form in joins if any(c.isdigit() for c in x)]
        pairs = {f: [pair_set(t) for t in ts + [e for g, e in either if g == f]] for f, ts in notices.items()}
        seen = Counter(x for ts in pairs.values() for x in np.unique(np.concatenate(ts)).tolist())
        for t in NOTICES:
            seen.update(x for name in OTHERS for x in set(pair_set(t.format(name)).tolist()))
        #: each family's templates, with the pairs no other family's templates have, nor notices of other licences
        self.templates = {f: [(t, t[[seen[x] == 1 for x in t.tolist()]]) for t in ts] for f, ts in pairs.items()}
        for f, x in ids:
            if not any(c.isdigit() for c in x):
                self.templates[f] += [(pair_set(f"SPDX-License-Identifier: {form.format(x)} {y}" if form.startswith("{") else
                                                f"SPDX-License-Identifier: {y} {form.format(x)}"), pair_set(form.format(x)))
                                      for form in joins for g, y in ids if g != f]
        self.owner: dict[int, str] = {x: f for f, ts in self.templates.items() for _, own in ts for x in own.tolist()}
        negatives = negatives + [cut_up(t) for t in NEAR_MISSES] * 4
        rows, labels = [_hashes(w) for w in negatives], [0] * len(negatives)
        # licences that are no family; every third only calibrates
        late = set()
        for i, name in enumerate(OTHERS):
            for t in NOTICES:
                if i % 3 == 2:
                    late.add(len(rows))
                rows += [_hashes(cut_up(t.format(name)))] * (1 if i % 3 == 2 else 4)
                labels += [0] * (len(rows) - len(labels))
        # two licences on a line, as an example of each
        known = [(c, x) for c, f in enumerate(FAMILIES, 1) for x in IDENTIFIERS.get(f, ())]
        for _ in range(20 * copies):
            (a, x), (b, y) = known[int(rng.integers(len(known)))], known[int(rng.integers(len(known)))]
            rows.append(_hashes(cut_up(EITHER[int(rng.integers(len(EITHER)))].format(x, y))))
            labels.append((a, b)[int(rng.integers(2))])
        for c, ts in enumerate(notices.values(), 1):
            for t in ts:
                words = cut_up(t)
                for k in range(copies):
                    w = [x for x in words if rng.random() > 0.1] or words if k % 4 == 1 else words
                    if k % 4 == 2 and len(words) > 12:
                        cut = int(rng.integers(0, len(words) - 10))
                        w = words[cut:cut + int(rng.integers(10, len(words) - cut + 1))]
                    if k % 4 == 3:  # inside other text
                        around = negatives[int(rng.integers(len(negatives)))]
                        cut = int(rng.integers(0, min(len(around), 20) + 1))
                        w = around[:cut] + words + around[cut:cut + 20]
                    rows.append(_hashes(w))
                    labels.append(c)
        y, x = np.array(labels), [_features(h) for h in rows]
        order = rng.permutation(len(y))
        aside = np.isin(order, list(late)) | (np.arange(len(y)) < len(y) // 5)
        hold, fit = order[aside], order[~aside]
        w = np.zeros((1 << BITS, len(FAMILIES) + 1), np.float32)
        past = np.full(w.shape, 1e-6, np.float32)
        for _ in range(epochs):
            rng.shuffle(fit)
            for i in fit:
                ids, scale = x[i], 1 / np.sqrt(len(x[i]))
                z = w[ids].sum(0) * scale
                p = np.exp(z - z.max())
                g = (p / p.sum() - (np.arange(len(p)) == y[i])) * scale
                past[ids] += g * g
                w[ids] -= 0.2 * g / np.sqrt(past[ids])
        self.w, self.temperature, self.least = w, 1.0, 0.5
        z = self.logits([x[i] for i in hold])
        grid = np.exp(np.linspace(np.log(0.2), np.log(10), 50))
        self.temperature = float(grid[int(np.argmin([-np.log(self.soft(z / t)[np.arange(len(hold)), y[hold]] + 1e-12).mean() for t in grid]))])
        known = 1 - self.soft(z / self.temperature)[y[hold] == 0][:, 0]
        known *= [bool(self.confirmed(rows[i])) for i in hold if y[i] == 0]
        if len(known):
            self.least = float(min(0.95, max(0.1, np.quantile(known, 0.999))))

    @staticmethod
    def soft(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        n = np.array([len(r) for r in rows])
        starts = np.cumsum(n) - n
        return np.add.reduceat(self.w[np.concatenate(rows)], starts, axis=0) / np.sqrt(n)[:, None]

    def similarity(self, family: str, p: np.ndarray) -> float:
        """Largest share of word pairs that ``p`` (sorted, distinct) and a template with a pair of
        its family's own in ``p`` have in common, of those of the shorter one; a shorter ``p``
        counts as ``LEAST_PAIRS``, so that two words of a long template confirm nothing."""
        both = lambda t: len(np.intersect1d(p, t, assume_unique=True))
        return max((both(t) / min(max(len(p), LEAST_PAIRS), len(t)) for t, own in self.templates[family] if both(own)), default=0.0)

    def confirmed(self, h: np.ndarray) -> list[tuple[str, float]]:
        """Families whose templates confirm a paragraph, with the similarity."""
        pairs = np.unique(_pairs(h))
        named = {self.owner[x] for x in pairs.tolist() if x in self.owner}
        return [(f, s) for f in FAMILIES if f in named and (s := self.similarity(f, pairs)) >= 0.5]

    def scan(self, texts: list[str | None]) -> list[tuple[int, int, str, float, float]]:
        """(row, line, family, probability, similarity) of confirmed paragraphs, the best window of a line."""
        found: dict[tuple[int, int, str], tuple[float, float]] = {}
        todo = [(i, no, words) for i, t in enumerate(texts) for no, words in windows(t)]
        for at in range(0, len(todo), 4000):
            part = todo[at:at + 4000]
            sizes = np.array([len(w) for _, _, w in part])
            h = _hashes([x for _, _, w in part for x in w])
            ends = np.cumsum(sizes)
            one, two = mix(h) >> U(64 - BITS), np.zeros(len(h), np.uint64)
            two[:-1] = _pairs(h) >> U(64 - BITS)
            two[ends - 1] = one[ends - 1]           # no pair over the end of a paragraph
            owner = np.repeat(np.arange(len(part), dtype=np.uint64), sizes)
            ids = np.unique(np.concatenate([owner << U(BITS) | one, owner << U(BITS) | two]))
            who = (ids >> U(BITS)).astype(np.int64)
            n = np.bincount(who, minlength=len(part))
            z = np.add.reduceat(self.w[(ids & U((1 << BITS) - 1)).astype(np.int64)], np.cumsum(n) - n, axis=0) / np.sqrt(n)[:, None]
            p = self.soft(z / self.temperature)
            for k in np.nonzero(1 - p[:, 0] >= self.least)[0]:
                i, no, _ = part[k]
                for family, s in self.confirmed(h[ends[k] - sizes[k]:ends[k]]):
                    key, got = (i, no, family), (float(1 - p[k, 0]), s)
                    found[key] = max(found.get(key, got), got)
        return [(*k, *v) for k, v in sorted(found.items())]


def train(docs: DataFrame, sample_docs: int = 400, sample_paragraphs: int = 4000, text: str = "text", longest: int = 100_000) -> Model:
    """A model whose unknown class comes from at most ``sample_paragraphs``
    paragraphs, which name no licence themselves, of at most ``sample_docs``
    different documents of at most ``longest`` characters: those of the smallest
    hashes.  Hashes choose them, so no other text leaves its task."""
    texts = docs.select(F.col(text).alias("text")).where(F.length("text") <= longest).select(F.xxhash64("text").alias("h"), "text")
    last = [r["h"] for r in texts.select("h").distinct().orderBy("h").limit(sample_docs).collect()][-1:]
    few = texts.where(F.col("h") <= last[0]).groupBy("h").agg(F.min("text").alias("text")).orderBy("h").collect() if last else []
    negatives = [w for r in few for _, w in windows(r["text"])][:sample_paragraphs]
    named = (b"licen", b"copyright", b"spdx", b"creative", b"apache", b"gnu")
    return Model([w for w in negatives if not any(n in x for x in w for n in named)])


def license_scan(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, line_no, family, probability, similarity) of every paragraph that names a licence."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("doc_id", d.schema["doc_id"].dataType), T.StructField("line_no", T.IntegerType()),
                           T.StructField("family", T.StringType()), T.StructField("probability", T.DoubleType()),
                           T.StructField("similarity", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 500):
                got = shared.value.scan(texts[at:at + 500])
                if got:
                    rows, nos, families, ps, ss = zip(*got)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([at + r for r in rows])), pa.array(nos, pa.int32()),
                                                      pa.array(families), pa.array(ps), pa.array(ss)], names=[f.name for f in schema])

    return d.mapInArrow(work, schema)
