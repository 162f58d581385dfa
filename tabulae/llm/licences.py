"""Licence families by a trained paragraph classifier [native].

Paragraphs are scored by a multinomial logistic regression over sparse word
n-grams, with a class of other text.  The model is fitted on the driver from
the fixed templates below and calibrated by a temperature on held-out
variants; it is then plain expressions over the row.  A prediction counts as
confirmed if the paragraph shares enough n-grams with a template.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulae.llm.common import let, written

# Short notices and leading sentences of public licences, by family.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license. See the LICENSE file for details.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "Released under the Apache 2.0 license."],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
            "Licensed under the GPL version 2 or later.", "You should have received a copy of the GNU General Public License along with this program."],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License, version 2.1.", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"],
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.", "This program is distributed under the terms of the GNU Affero General Public License"],
    "BSD": ["Licensed under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."],
    "CC-BY": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-SA": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
    "CC-BY-NC": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Dedicated to the public domain under CC0 1.0 Universal."],
    "ISC": ["Licensed under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "Proprietary": ["Copyright. All rights reserved.", "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.", "No part of this publication may be reproduced without the prior written permission of the publisher."],
}
# Identifiers of SPDX tags, by family.
SPDX = {"MIT": ["MIT"], "Apache-2.0": ["Apache-2.0"], "GPL": ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"], "LGPL": ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-or-later"],
        "AGPL": ["AGPL-3.0-only", "AGPL-3.0-or-later"], "BSD": ["BSD-2-Clause", "BSD-3-Clause"], "MPL": ["MPL-2.0"], "CC-BY": ["CC-BY-4.0"], "CC-BY-SA": ["CC-BY-SA-4.0"], "CC-BY-NC": ["CC-BY-NC-4.0"], "CC0": ["CC0-1.0"], "ISC": ["ISC"]}
for _name, _ids in SPDX.items():
    TEMPLATES[_name] += [f"SPDX-License-Identifier: {x}" for x in _ids]
OTHER = "other"
# Sentences that use the same words and grant nothing.
PROSE = ["He lost his driving license and had to apply for a new one.", "Permission to enter the building was granted by the guard.", "The general public was invited to the opening.",
         "Version 2.0 of the game was released in March.", "Copyright law is a matter of some dispute among scholars.", "The license fee was raised again this year.", "The patent was licensed to a rival firm.",
         "They redistribute food to those who need it.", "The software crashed under heavy load.", "Conditions in the camp were poor and help was slow.", "A copy of the letter was found in the file.", "The foundation is free and open to the public.",
         "SPDX-License-Identifier: Zlib", "SPDX-License-Identifier: Unlicense", "SPDX-License-Identifier: EPL-2.0", "SPDX-License-Identifier: NONE"]
# A paragraph without one of these stems is other text; every template has one.
ANCHORS = "licen[cs]|copyright|permission|redistribut|public domain|creative commons|free software|all rights|proprietary|general public|waived|\\bcc0\\b"
WORDS = ANCHORS.replace(" ", "[^a-z0-9]+")      # an anchor of two words may be wrapped
# A piece ends at a line without a letter or digit, or at one that ends a sentence.
BLANK = r"(?dm)^[^\p{L}\p{N}\n]+$"
PIECE_END = r"\n{2,}|(?<=[.!?][\"')\]*/ \t\r]{0,4})\n"
SENTENCE_END = r"(?<=[.!?])\s+(?![a-z0-9])"
WRAP = r"[^\p{L}\p{N}\n]*\n[^\p{L}\p{N}]*"
WINDOW, STRIDE = 60, 30   # words of a longer piece's windows; a piece of STRIDE words is whole in one
LONGEST = 3           # words of an n-gram
MIN_PROBABILITY = 0.5
MIN_SHARED = 0.6      # of the template's n-grams, or of the paragraph's, to confirm
STEPS, RATE, DECAY = 300, 2.0, 1e-4


def grams(text: str) -> set[str]:
    w = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
    return {" ".join(w[i:i + k]) for k in range(1, LONGEST + 1) for i in range(len(w) - k + 1)}


def variants() -> list[tuple[set[str], int]]:
    """(n-grams, class) of templates whole and with words left out, of prose, and of templates in random order."""
    r = np.random.default_rng(3)
    out: list[tuple[set[str], int]] = []
    for k, texts in enumerate([*TEMPLATES.values(), PROSE]):
        for t in texts:
            w = t.split()
            out.append((grams(t), k))
            for _ in range(12):
                out.append((grams(" ".join(x for x in w if r.random() > 0.12)), k))
            mixed = list(w)
            r.shuffle(mixed)
            some = mixed[:max(1, len(w) // 2)]
            out.append((grams(" ".join(some)), len(TEMPLATES)) if len(some) > 4 else (set(), len(TEMPLATES)))
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@lru_cache(maxsize=1)
def fit() -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    """(classes, n-grams, weights, biases), divided by the calibrated temperature."""
    classes, rows = [*TEMPLATES, OTHER], variants()
    vocab = sorted(set().union(*(g for g, _ in rows)))
    place = {g: i for i, g in enumerate(vocab)}
    x = np.zeros((len(rows), len(vocab)))
    for i, (g, _) in enumerate(rows):
        x[i, [place[v] for v in g]] = 1
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    y = np.eye(len(classes))[[c for _, c in rows]]
    held = np.arange(len(rows)) % 4 == 3
    w, b = np.zeros((len(vocab), len(classes))), np.zeros(len(classes))
    for _ in range(STEPS):
        error = (_softmax(x[~held] @ w + b) - y[~held]) / (~held).sum()
        w -= RATE * len(classes) * (x[~held].T @ error + DECAY * w)
        b -= RATE * error.sum(0)
    z = x[held] @ w + b
    heat = min(np.geomspace(0.2, 5, 41), key=lambda t: -np.log(_softmax(z / t)[y[held] == 1] + 1e-12).mean())
    return classes, vocab, w / heat, b / heat


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda x: x != "")


def _windows(sentence: Column) -> Column:
    """A long sentence as overlapping windows that cover it."""
    def cut(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.ceil((F.size(w) - WINDOW) / STRIDE), F.lit(0)).cast("int"))
        return F.when(F.size(w) <= WINDOW, F.array(sentence)).otherwise(
            F.transform(starts, lambda i: F.array_join(F.slice(w, i * STRIDE + 1, WINDOW), " ")))
    return let(_words(sentence), cut)


def units_of(text: Column) -> Column:
    """array of struct(piece, part, text): what is classified.

    A piece is a paragraph with its wrapped lines joined; one of more than
    WINDOW words is taken sentence by sentence, and a longer sentence in
    windows.  The lines of a piece of several are looked at too, as parts,
    which only a template that is there nearly whole confirms.
    """
    def units(piece: Column, i: Column) -> Column:
        def of(whole: Column) -> Column:
            return F.when(F.size(_words(whole)) <= WINDOW, F.array(whole)).otherwise(
                F.flatten(F.transform(F.split(whole, SENTENCE_END), _windows)))

        def named(texts: Column, part: bool) -> Column:
            return F.transform(F.filter(texts, lambda x: F.lower(x).rlike(WORDS)), lambda x: F.struct(i.alias("piece"), F.lit(part).alias("part"), x.alias("text")))

        lines = F.when(piece.contains("\n"), F.split(piece, "\n")).otherwise(F.array().cast("array<string>"))
        return F.concat(named(let(F.regexp_replace(piece, WRAP, " "), of), False), named(lines, True))

    pieces = F.filter(F.split(F.regexp_replace(text, BLANK, ""), PIECE_END), lambda x: F.lower(x).rlike(WORDS))
    return let(pieces, lambda p: F.flatten(F.transform(p, units)))


def _grams(text: Column) -> Column:
    def of_words(w: Column) -> Column:
        def runs(k: int) -> Column:
            starts = F.slice(w, 1, F.greatest(F.size(w) - (k - 1), F.lit(0)))
            return F.transform(starts, lambda _x, i: F.array_join(F.slice(w, i + 1, k), " "))
        return F.array_distinct(F.concat(*map(runs, range(1, LONGEST + 1))))
    return let(_words(text), of_words)


def model_rows() -> list[tuple[str, list[float], list[int]]]:
    """(n-gram, weights by class, 1 for each template that has it)."""
    _classes, vocab, w, _b = fit()
    sets = [grams(t) for texts in TEMPLATES.values() for t in texts]
    return [(g, [float(v) for v in w[i]], [int(g in s) for s in sets]) for i, g in enumerate(vocab)]


def classify(units: DataFrame, model: DataFrame) -> DataFrame:
    """(uid, piece, family, probability, confirmed) of rows (uid, unit, piece, part, text)."""
    at = ["uid", "unit", "piece", "part"]
    classes, _vocab, _w, bias = fit()
    sizes = [(name, len(grams(t))) for name, texts in TEMPLATES.items() for t in texts]
    own = units.select(*at, _grams(F.col("text")).alias("own")).select(
        *at, F.size("own").alias("n"), F.explode_outer("own").alias("gram"))
    sums = own.join(F.broadcast(model), "gram", "left").groupBy(*at, "n").agg(
        *(F.coalesce(F.sum(F.col("weights")[i]), F.lit(0.0)).alias(f"z{i}") for i in range(len(classes))),
        *(F.coalesce(F.sum(F.col("templates")[i]), F.lit(0)).alias(f"t{i}") for i in range(len(sizes))))
    root = F.sqrt(F.greatest(F.col("n"), F.lit(1)).cast("double"))
    logits = F.array(*(F.col(f"z{i}") / root + F.lit(float(b)) for i, b in enumerate(bias)))
    # Templates as (class, shared n-grams, n-grams).
    shared = F.array(*(F.struct(F.lit(name).alias("f"), F.col(f"t{i}").alias("s"), F.lit(size).alias("n"))
                       for i, (name, size) in enumerate(sizes)))

    def chosen(x: Column) -> Column:
        top = F.array_max(x["z"])
        family = F.element_at(F.array(*map(F.lit, classes)), F.array_position(x["z"], top).cast("int"))
        odds = F.aggregate(F.transform(x["z"], lambda v: F.exp(v - top)), F.lit(0.0), lambda a, v: a + v)
        mine = let(family, lambda f: F.struct(f.alias("family"), F.exists(
            x["t"], lambda t: (t["f"] == f) & (t["s"] >= MIN_SHARED * F.when(x["part"], t["n"]).otherwise(F.least(t["n"], x["n"])))).alias("confirmed")))
        return F.struct(mine.alias("m"), (1 / odds).alias("probability"))

    picked = sums.select("uid", "piece", let(F.struct(logits.alias("z"), shared.alias("t"), F.col("n").alias("n"), F.col("part").alias("part")), chosen).alias("c"))
    return picked.select("uid", "piece", "c.m.family", "c.probability", "c.m.confirmed")


def scan_licences(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_notices, families, best, probability, confirmed.

    A paragraph ends at a blank line or at a line that ends a sentence; its
    wrapped lines are joined.  A notice is a paragraph, or a part of it as in
    units_of, with an anchor, whose class is a family at MIN_PROBABILITY or
    more and which a template confirms; a paragraph counts once a family.
    ``families`` are theirs, sorted and comma-joined.  ``best`` is the most
    probable notice's family (ties: the first by name), or ``unknown`` with
    the highest probability if paragraphs with an anchor are there but none is
    a notice; null without such a paragraph.  Null and empty texts have none;
    repeated rows are judged alike; an empty table gives no row.  Reads doc_id
    and text.  The model is a table of fixed size; only the units with an
    anchor are taken apart, and only counts of documents are joined.
    """
    marked = written(docs.select("doc_id", F.monotonically_increasing_id().alias("uid"),
                                 F.when(F.lower("text").rlike(WORDS), units_of(F.col("text"))).alias("units")), "units")
    model = written(docs.sparkSession.createDataFrame(model_rows(), "gram string, weights array<double>, templates array<int>").coalesce(1), "model")
    judged = written(classify(marked.select("uid", F.posexplode("units").alias("unit", "u")).select("uid", "unit", "u.*"), model), "judged")
    notice = F.col("confirmed") & (F.col("probability") >= MIN_PROBABILITY)
    by_doc = judged.groupBy("uid").agg(
        F.count_distinct(F.when(notice, F.struct("piece", "family"))).alias("n"), F.array_join(F.array_sort(F.collect_set(F.when(notice, F.col("family")))), ",").alias("names"),
        F.min(F.when(notice, F.struct((-F.col("probability")).alias("p"), F.col("family").alias("f")))).alias("first"),
        F.max("probability").alias("most"))
    return marked.drop("units").join(by_doc, "uid", "left").select(
        "doc_id", F.coalesce("n", F.lit(0)).alias("n_notices"), F.coalesce("names", F.lit("")).alias("families"),
        F.when(F.col("n").isNotNull(), F.coalesce("first.f", F.lit("unknown"))).alias("best"),
        F.coalesce(-F.col("first.p"), "most").alias("probability"), (F.col("n") > 0).alias("confirmed"))
