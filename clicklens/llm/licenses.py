"""Licence scan with a trained paragraph classifier.

A text's paragraphs are its sentences and lines. A multinomial logistic
regression on hashed word one- and two-grams tells licence families and
``unknown``; it is trained on windows of the templates below with words left
out, and on corpus lines without licence words as ``unknown`` (at most
``SAMPLE``, the first of all lines by hash order). Probabilities are
calibrated by a temperature fitted on a held-out part. A family counts only
when it is likelier than ``THRESHOLD`` and the template comparison confirms it: at
least ``CONFIRM`` of the paragraph's two-grams stand in that family's templates.

Defined cases: null and empty texts have no paragraphs and no licence;
repeated rows are reported alike; an empty table gives no rows (and a model
whose unknown class is the templates' shuffled words); other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm import textbytes as tb
from clicklens.llm.exchange import first_by_hash, ready
from clicklens.llm.spans import sentences

SAMPLE, ROWS, THRESHOLD, CONFIRM = 4_000, 1 << 13, 0.8, 0.5
UNKNOWN = "unknown"
# fixed values: opening words of the public licence texts and usual notices
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Released under the BSD License.", "Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under CC BY 4.0.", "This work is licensed under the Creative Commons Attribution-ShareAlike License."],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Distributed under the terms of the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Released under the MIT License.", "Licensed under the MIT License.", "This project is distributed under the MIT License.",
        "SPDX-License-Identifier: MIT"],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0."],
}
FAMILIES = [*TEMPLATES, UNKNOWN]
CUES = r"(?i)licen[sc]e|copyright|warrant|spdx|permission"


def grams(buf: np.ndarray, offsets: np.ndarray):
    """Word one- and two-grams of paragraphs: ``(hash, paragraph, is_pair)``
    sorted by paragraph, and the paragraphs' documents."""
    start, end, doc, n_words = sentences(buf, offsets)
    lower = tb.ASCII_LOWER[buf]
    ws, we, _ = tb.words(lower, offsets, tb.IS_ALNUM)
    para = np.searchsorted(start, ws, side="right") - 1
    word = tb.RangeHash(lower)(ws, we)
    next_ = np.flatnonzero(para[1:] == para[:-1])
    pair = tb.mix(word[next_] + tb.mix(word[next_ + 1]))
    key, owner = np.concatenate([word, pair]), np.concatenate([para, para[next_]])
    is_pair = np.repeat([False, True], [len(word), len(pair)])
    order = np.argsort(owner, kind="stable")
    return key[order], owner[order], is_pair[order], doc


def _texts(rows: list[str]):
    raw = [r.encode() for r in rows]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def _template_pairs() -> list[np.ndarray]:
    out = []
    for rows in TEMPLATES.values():
        key, _, is_pair, _ = grams(*_texts([r + "\n" for r in rows]))
        out.append(np.unique(key[is_pair]))
    return out


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # ROWS by families
    bias: np.ndarray
    temperature: float
    pairs: list[np.ndarray]

    def logits(self, key: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        z = np.zeros((n, len(FAMILIES)))
        if len(key):
            heads = tb.runs(owner)
            z[owner[heads]] = np.add.reduceat(self.weight[(key % np.uint64(ROWS)).astype(np.int64)], heads, axis=0)
        return z / np.sqrt(np.maximum(np.bincount(owner, minlength=n), 1))[:, None] + self.bias

    def classify(self, buf: np.ndarray, offsets: np.ndarray):
        """``(doc, family, probability)`` per paragraph; unconfirmed families
        are ``unknown``."""
        key, owner, is_pair, doc = grams(buf, offsets)
        p = _softmax(self.logits(key, owner, len(doc)) / self.temperature)
        family = p.argmax(axis=1)
        best = p[np.arange(len(p)), family] if len(p) else np.zeros(0)
        total = np.bincount(owner[is_pair], minlength=len(doc))
        for f, pairs in enumerate(self.pairs):
            mine = is_pair & (family[owner] == f) if len(owner) else is_pair
            seen = np.bincount(owner[mine], weights=np.isin(key[mine], pairs), minlength=len(doc))
            family[(family == f) & ((best < THRESHOLD) | (seen < CONFIRM * total) | (total == 0))] = len(FAMILIES) - 1
        return doc, family, best


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
    return e / e.sum(axis=1, keepdims=True) if len(z) else z


def _examples(rng: np.random.Generator, unknown: list[str]) -> tuple[list[str], np.ndarray]:
    rows, y = [], []
    for f, templates in enumerate(TEMPLATES.values()):
        for t in templates * 24:
            w = t.split()
            size = int(rng.integers(min(5, len(w)), len(w) + 1))
            a = int(rng.integers(0, len(w) - size + 1))
            kept = [x for x in w[a : a + size] if rng.random() > 0.08]
            rows.append(" ".join(kept).rstrip(".") or t)
            y.append(f)
    pool = [w for t in TEMPLATES.values() for r in t for w in r.split()]
    for _ in range(200):  # licence words without licence sense
        rows.append(" ".join(rng.choice(pool, 8)).replace(".", ""))
        y.append(len(FAMILIES) - 1)
    return rows + unknown, np.array(y + [len(FAMILIES) - 1] * len(unknown))


def train(docs: DataFrame) -> Model:
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("t")).where(~F.col("t").rlike(CUES) & (F.trim("t") != ""))
    unknown = [t for (t,) in first_by_hash(lines, ["doc_id", "t"], SAMPLE).select("t").toLocalIterator()]
    rows, y = _examples(np.random.default_rng(17), unknown)
    key, owner, _, para_doc = grams(*_texts([r.replace("\n", " ") + "\n" for r in rows]))
    y = y[para_doc]
    slot = (key % np.uint64(ROWS)).astype(np.int64)
    n, k = len(y), len(FAMILIES)
    scale = 1 / np.sqrt(np.maximum(np.bincount(owner, minlength=n), 1))
    held = np.arange(n) % 5 == 0
    model = Model(np.zeros((ROWS, k)), np.zeros(k), 1.0, _template_pairs())
    share = np.bincount(y[~held], minlength=k)
    cost = np.where(held, 0.0, (1 / np.maximum(share, 1))[y]) * n / k
    for step in range(150):
        g = _softmax(model.logits(key, owner, n))
        g[np.arange(n), y] -= 1
        g *= cost[:, None] / n
        grad = np.zeros_like(model.weight)
        np.add.at(grad, slot, (g * scale[:, None])[owner])
        model = Model(model.weight - 20 * (grad + 1e-5 * model.weight), model.bias - 2 * g.sum(axis=0), 1.0, model.pairs)
    z = model.logits(key, owner, n)[held]
    loss = {t: -np.log(np.maximum(_softmax(z / t)[np.arange(len(z)), y[held]], 1e-12)).mean() for t in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0)}
    return Model(model.weight, model.bias, min(loss, key=loss.get), model.pairs)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id, n_paragraphs, n_license, family`` (of most licence
    paragraphs, the first by name on ties; ``unknown`` without one),
    ``families`` (all, sorted) and the best ``confidence``."""
    ready(docs.sparkSession)
    types = pa.schema([("doc_id", pa.int64()), ("n_paragraphs", pa.int64()), ("n_license", pa.int64()), ("family", pa.string()),
                       ("families", pa.string()), ("confidence", pa.float64())])
    last = len(FAMILIES) - 1

    def run(batches):
        for batch in batches:
            for at, buf, offsets in tb.text_chunks(batch.column(1)):
                n = len(offsets) - 1
                doc, family, p = model.classify(buf, offsets)
                seen = np.bincount(doc * (last + 1) + family, minlength=n * (last + 1)).reshape(n, last + 1)[:, :last]
                best = np.zeros(n)
                np.maximum.at(best, doc[family < last], p[family < last])
                names = [FAMILIES[int(r.argmax())] if r.any() else UNKNOWN for r in seen]
                every = [",".join(FAMILIES[f] for f in np.flatnonzero(r)) for r in seen]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), pa.array(np.bincount(doc, minlength=n).astype(np.int64)),
                     pa.array(seen.sum(axis=1).astype(np.int64)), pa.array(names), pa.array(every), pa.array(best)], schema=types)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_paragraphs long, n_license long, family string, families string, confidence double")
