"""Licence scans by a trained paragraph classifier; scoring uses DataFrame functions only.

A paragraph is a line of a text together with the lines it is wrapped onto: a line that does not end a sentence goes on in the next one.
A multinomial logistic regression over sparse word n-grams (one to three words, and words near a name) is trained on the driver from statements made by
rule, each family's names set in ``GRANTS``, and from sentences that name a licence or rights and grant nothing (``REFUSALS`` and ``OTHERS``),
which are a class of their own, ``unknown``. Whole frames are held back from training; on these the softmax is tempered so that their
likelihood is greatest. A family less likely than ``CONFIDENT`` is unknown. A predicted family is confirmed by comparison with its
templates: the paragraph holds one of the names that only this family bears, or ``COVERAGE`` of the words of one of its ``TEXTS`` or of a half of it.

The model's n-grams are those that hold a marker, a word of some family's name, tag or text that none of the ``OTHERS`` holds; so a paragraph
without a marker has no n-gram of the model and is unknown by the bias alone, and its score is not computed. Nothing else is left out.

The whole scan is one projection: nothing is shuffled, so hot sources and groups of copies cost what other rows cost.

Defined results: null and empty texts have no paragraphs and no family; ties between families go to the first by name;
repeated rows repeat; an empty table gives no rows. Only the id and text columns are read, so extra columns of any name
do no harm.
"""

from __future__ import annotations

import functools
import json
import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, table

#: Names of each licence family as statements have them.
NAMED = {
    "agpl": ["the GNU Affero General Public License", "the GNU Affero General Public License, version 3", "the AGPL", "AGPLv3", "AGPL-3.0", "the GNU AGPL v3 or later"],
    "apache": ["the Apache License, Version 2.0", "the Apache 2.0 license", "the Apache License", "Apache 2", "the Apache Software License", "Apache-Lizenz 2.0", "licencia Apache 2.0"],
    "bsd": ["the BSD License", "the BSD 3-Clause License", "the 2-clause BSD license", "a BSD-style license", "the New BSD License", "BSD-3-Clause", "BSD-Lizenz"],
    "cc-by": ["CC BY 4.0", "CC-BY 3.0", "a Creative Commons Attribution 4.0 International License", "the Creative Commons Attribution License", "Creative Commons Namensnennung 4.0", "Creative Commons Attribution 4.0"],
    "cc-by-nc": ["CC BY-NC 4.0", "CC BY-NC-SA 4.0", "CC BY-NC-ND 3.0", "a Creative Commons Attribution-NonCommercial 4.0 International License", "the Creative Commons Attribution-NonCommercial-ShareAlike License", "Creative Commons Attribution Non-Commercial"],
    "cc-by-sa": ["CC BY-SA 4.0", "CC-BY-SA 3.0", "a Creative Commons Attribution-ShareAlike 4.0 International License", "the Creative Commons Attribution-ShareAlike License", "Creative Commons Attribution Share Alike"],
    "cc0": ["CC0 1.0 Universal", "CC0", "the CC0 public domain dedication", "Creative Commons Zero"],
    "epl": ["the Eclipse Public License 2.0", "the Eclipse Public License - v 1.0", "EPL-2.0", "the EPL"],
    "gpl": ["the GNU General Public License", "the GNU General Public License, version 3", "the GNU General Public License v2", "the GNU GPL", "the GPL", "GPLv3", "GPLv2 or later", "GPL-3.0", "the GNU GPL version 2"],
    "isc": ["the ISC License", "ISC license", "the ISC licence"],
    "lgpl": ["the GNU Lesser General Public License", "the GNU Lesser General Public License, version 2.1", "the GNU Library General Public License", "the LGPL", "LGPLv3", "LGPLv2.1 or later", "LGPL-2.1"],
    "mit": ["the MIT License", "the MIT license (MIT)", "an MIT-style license", "MIT licence", "the MIT/X11 license", "MIT-Lizenz", "licencia MIT", "licence MIT"],
    "mpl": ["the Mozilla Public License, version 2.0", "the Mozilla Public License, v. 2.0", "MPL 2.0", "the MPL"],
    "unlicense": ["the Unlicense", "The Unlicense", "the Unlicense (public domain)"],
    "zlib": ["the zlib License", "the zlib/libpng license", "zlib licence"],
}
#: What stands behind the tag "SPDX-License-Identifier".
TAGS = {
    "agpl": ["AGPL-3.0-only", "AGPL-3.0-or-later"], "apache": ["Apache-2.0"], "bsd": ["BSD-3-Clause", "BSD-2-Clause"], "cc-by": ["CC-BY-4.0"], "cc-by-nc": ["CC-BY-NC-4.0", "CC-BY-NC-SA-4.0"], "cc-by-sa": ["CC-BY-SA-4.0"],
    "cc0": ["CC0-1.0"], "epl": ["EPL-2.0"], "gpl": ["GPL-3.0-or-later", "GPL-2.0-only"], "isc": ["ISC"], "lgpl": ["LGPL-2.1-or-later", "LGPL-3.0"], "mit": ["MIT"], "mpl": ["MPL-2.0"], "unlicense": ["Unlicense"], "zlib": ["Zlib"],
}
#: Opening words of licences that do not name themselves there, and of usual headers.
TEXTS = {
    "agpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "apache": ["Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "gpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "zlib": ["This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."],
}
#: Frames of a statement that grants, and of one that does not. The first of each are trained on, those in the second list are held back.
GRANTS = (
    ["Licensed under {}.", "Released under {}.", "This project is licensed under the terms of {}.", "It uses {}.", "Text and images: {}", "Dual licensed under {}", "This program and its materials are {} software.", "You should have received a copy of {} along with this program.", "Dieses Programm steht unter {}.", "Esta obra se distribuye bajo {}.", "License: {}", "This work is licensed under {}.", "Available under {}.", "Distributed under {}.", "Code is under {}, see the file.", "You may use this file under {}.", "Lizenziert unter {}.", "Publicado bajo {}.", "Sous {}.", "Made available by its authors under {}."],
    ["Shared under {}.", "Published under {} by the authors.", "Use is subject to {}.", "Veröffentlicht unter {}.", "Distribuido bajo {}."],
)
REFUSALS = (
    ["Not licensed under {}.", "This file is not covered by {}.", "The fee for {} is due.", "{} fee is due.", "{} was written many years ago.", "He compared {} with other texts.", "An article about {}.", "Unlike {}, ours is closed.", "No rights under {} are granted.", "This is no longer released under {}.", "We do not offer it under {}.", "We don't offer it under {}.", "No part of this is under {}.", "Nicht unter {} lizenziert.", "No se publica bajo {}.", "{} does not apply here.", "The history of {} is long.", "Never distributed under {}.", "It isn't available under {}.", "{} has been criticised."],
    ["This text is not released under {}.", "A book on {} appeared.", "It can't be used under {}.", "{} is not used here.", "They argued about {} for years."],
)
#: Sentences that name licences or rights and grant nothing known.
OTHERS = (
    "All rights reserved.", "Copyright by the authors.", "The driver must hold a valid license.", "A license is required to fish in the river.", "See the license file for details.", "The licence fee is due in March.",
    "No permission is granted.", "Permission of the owner is needed for any use of this file.", "Public transport runs at night.", "The general public was not admitted.", "Free software is discussed here.", "The company sells a commercial license.",
    "Your license has expired.", "Terms of use apply to this work.", "The version was released in May.", "It was released under great pressure by the authors.", "Copyright law differs by country.", "Licensed under the terms of the agreement between the parties.",
    "This work is licensed by the city.", "The software is provided to all members and may not be copied.", "Creative work needs quiet.", "The commons was grazed by sheep.", "The library is open to the public on Sunday.", "This program is for sale; you can modify it to any purpose.",
    "The source of the river is in the hills and its use is free of charge.", "Domain names and files are stored with the code.", "To the extent possible, the conditions are met by a person without fee.", "Er kam mit dem Zug und ging mit ihr nach Hause.", "Die Lizenz ist abgelaufen.", "La licencia de conducir caduca.", "La licence est requise.",
)
#: Sentences in which a family's name means something else.
NAMESAKES = (
    "He studied at MIT for four years.", "MIT researchers released a new text under embargo.", "The Apache helicopter landed.", "The Mozilla foundation met in public.", "The gnu is an antelope.", "The Apache were a people of the plains.", "Mit uns und mit euch.", "An eclipse of the sun was seen.",
    "The ISC conference was held in June.", "CC the report by 4 o'clock.", "The lesser of two evils.", "He ran a BSD system at home.",
)
UNKNOWN = "unknown"
#: Words of an n-gram at most; words on either side of a marker that count by themselves, as "not" and "fee" do; buckets of the weights.
NGRAM, NEAR, BUCKETS = 3, 8, 256
#: What a refusal counts in training, against one of a statement that grants.
REFUSAL = 0.2
#: Times that each name, among words never seen elsewhere, and each part of a text is trained on.
BARE = 6
CONFIDENT, COVERAGE = 0.5, 0.7
#: A word of a statement: letters and digits.
WORD = r"[\p{L}\p{N}]+"
#: A licence's name with its version behind it, as in GPLv3 and LGPL2.1; the two are words of their own.
VERSIONED = "(?<![a-z0-9])(a?gpl|lgpl|mpl|apache|bsd|epl)v?([0-9])"
#: A line's end within a paragraph: nothing that ends a sentence before it, and no blank line behind it.
WRAPPED = r"(?<![.!?\n\r])[ \t]*\r?\n(?![ \t]*\r?(?:\n|$))"
#: Patterns over a paragraph's words, one space apart, that only this family's names match.
BORNE = {
    "agpl": "agpl|affero general public", "apache": "apache (software )?(license|licence|lizenz|version|2)|(licencia|licence) apache", "bsd": "bsd", "cc-by": "cc by(?! (nc|sa|nd))|creative commons (attribution|namensnennung)(?! (non ?commercial|share ?alike|no ?deriv|nc|sa|nd))",
    "cc-by-nc": "cc by nc|creative commons attribution non ?commercial", "cc-by-sa": "cc by sa|creative commons attribution share ?alike", "cc0": "cc0|creative commons zero", "epl": "epl|eclipse public", "gpl": "gpl|gnu general public",
    "isc": "isc (license|licence)|(identifier|license|under) isc", "lgpl": "lgpl|(lesser|library) general public", "mit": "mit (x11 |style )?(license|licence|lizenz)|(licencia|licence|identifier|license|under) mit", "mpl": "mpl|mozilla public", "unlicense": "unlicense", "zlib": "zlib (libpng )?(license|licence)|identifier zlib",
}


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", re.sub(VERSIONED, r"\1 \2", text.lower()))


@functools.lru_cache(1)
def markers() -> frozenset[str]:
    """Words of the families' names, tags and texts that no other sentence holds; "license" and its like mark a statement as well."""
    plain = {w for t in OTHERS for w in words_of(t)}
    ours = {w for part in (NAMED, TAGS, TEXTS) for texts in part.values() for t in texts for w in words_of(t)}
    return frozenset(w for w in ours if w not in plain and not w.isdigit() and len(w) > 2 or w in ("cc", "mit"))


def ngrams_of(found: list[str], n: int = NGRAM) -> set[str]:
    """The n-grams that hold a marker, and with a mark of their own the words that stand near one."""
    marks = markers()
    held = {" ".join(found[i : i + k]) for k in range(1, n + 1) for i in range(len(found) - k + 1) if not marks.isdisjoint(found[i : i + k])}
    near = {j for i, w in enumerate(found) if w in marks for j in range(max(0, i - NEAR), min(len(found), i + NEAR + 1))}
    return held | {f"~{found[j]}" for j in near}


class Model:
    """``weights``: n-gram to a weight a class; ``bias`` and ``temper`` complete the softmax."""

    def __init__(self, classes: list[str], weights: dict[str, list[float]], bias: list[float], temper: float):
        self.classes, self.weights, self.bias, self.temper = classes, weights, bias, temper

    def chances(self, grams: set[str]) -> np.ndarray:
        z = np.array(self.bias) + sum((np.array(self.weights[g]) for g in sorted(grams) if g in self.weights), np.zeros(len(self.bias)))
        z = z * self.temper
        e = np.exp(z - z.max())
        return e / e.sum()


def parts_of(texts: list[str]) -> list[str]:
    """Texts whole, without their first third, without their last and by halves: a paragraph may hold a part."""
    out = []
    for t in texts:
        w = t.split()
        n = len(w)
        out += [t, " ".join(w[n // 3 :]), " ".join(w[: n - n // 3]), " ".join(w[: n // 2]), " ".join(w[n // 2 :])]
    return out


def statements(held_back: bool) -> list[tuple[set[str], str]]:
    """(n-grams, class) of every name in every frame; ``held_back`` chooses the frames."""
    rows = []
    for name, names in NAMED.items():
        for n in names:
            rows += [(f.format(n), name) for f in GRANTS[held_back]] + [(f.format(n), UNKNOWN) for f in REFUSALS[held_back]]
        if not held_back:
            rows += [(n, name) for n in names] * BARE + [(f"SPDX-License-Identifier: {t}", name) for t in TAGS[name]] * 3 + [(t, name) for t in parts_of(TEXTS.get(name, []))] * BARE
    if not held_back:
        rows += [(t, UNKNOWN) for t in (*OTHERS, *NAMESAKES)] * 6
    return [(ngrams_of(words_of(t)), c) for t, c in rows]


@functools.lru_cache(1)
def trained(steps: int = 250, rate: float = 0.05, sparse: float = 1e-4) -> Model:
    """Fit on the frames of training with Adam and a lasso step; temper the softmax on the frames held back."""
    learn, test = statements(False), statements(True)
    classes = [*sorted(NAMED), UNKNOWN]
    counts: dict[str, int] = {}
    for grams, _ in learn:
        for g in grams:
            counts[g] = counts.get(g, 0) + 1
    at = {g: i for i, g in enumerate(sorted(g for g, n in counts.items() if n >= 3))}

    def matrix(rows: list[tuple[set[str], str]]) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros((len(rows), len(at) + 1), dtype=np.float32)
        x[:, -1] = 1
        for r, (grams, _) in enumerate(rows):
            x[r, [at[g] for g in grams if g in at]] = 1
        return x, np.eye(len(classes), dtype=np.float32)[[classes.index(c) for _, c in rows]]

    x, y = matrix(learn)
    share = np.where(y[:, -1] == 1, REFUSAL, 1.0).astype(np.float32)[:, None]
    share /= share.sum()
    w = np.zeros((x.shape[1], len(classes)), dtype=np.float32)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = x.T @ (share * (p - y)) + 1e-5 * w
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w = w - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - sparse, 0)
    xt, yt = matrix(test)
    zt = (xt @ w).astype(np.float64)

    def loss(t: float) -> float:
        v = t * zt
        top = v.max(1, keepdims=True)
        return float((top[:, 0] + np.log(np.exp(v - top).sum(1)) - (v * yt).sum(1)).mean())

    temper = min(np.linspace(0.1, 3, 59), key=loss)
    kept = {g: [round(float(v), 3) for v in w[i]] for g, i in at.items() if np.abs(w[i]).max() > 0.05}
    return Model(classes, kept, [round(float(v), 3) for v in w[-1]], round(float(temper), 3))


def _classified(paragraph: Column, model: Model) -> Column:
    """struct(family, chance, confirmed) of a paragraph's words."""
    dealt: list[dict[str, list[float]]] = [{} for _ in range(BUCKETS)]
    for g, w in sorted(model.weights.items()):
        dealt[zlib.crc32(g.encode()) % BUCKETS][g] = w
    # one literal, parsed once while planning; a look-up scans the few n-grams of a bucket
    weights = F.from_json(F.lit(json.dumps(dealt, ensure_ascii=False)), "array<map<string,array<double>>>")
    marks = sorted(markers())
    texts = {k: [sorted(set(words_of(t))) for t in parts_of(v)[::5] + parts_of(v)[3::5] + parts_of(v)[4::5]] for k, v in TEXTS.items()}

    def confirmed(family: Column, w: Column, joined: Column) -> Column:
        out = F.lit(False)
        for k in model.classes[:-1]:
            alike = joined.rlike(f"(?<!\\S)(?:{BORNE[k]})(?!\\S)")
            for t in texts.get(k, []):
                alike = alike | (F.size(F.array_intersect(F.array(*map(F.lit, t)), w)) >= COVERAGE * len(t))
            out = F.when(family == k, alike).otherwise(out)
        return out

    def of(w: Column) -> Column:
        marked = F.filter(F.transform(w, lambda x, i: F.when(x.isin(marks), i)), lambda i: i.isNotNull())
        around = lambda before, after: F.array_distinct(F.flatten(F.transform(marked, lambda i: F.sequence(F.greatest(i - before, F.lit(0)), F.least(i + after, F.size(w) - 1)))))
        # the n-grams of each length that begin at i and reach a marker
        grams = F.flatten(F.transform(around(NGRAM - 1, 0), lambda i: F.filter(F.transform(F.sequence(F.lit(1), F.lit(NGRAM)), lambda k: F.when((i + k <= F.size(w)) & F.exists(F.slice(w, i + 1, k), lambda x: x.isin(marks)), F.array_join(F.slice(w, i + 1, k), " "))), lambda g: g.isNotNull())))
        near = F.transform(around(NEAR, NEAR), lambda i: F.concat(F.lit("~"), F.get(w, i)))
        rows = F.filter(F.transform(F.array_distinct(F.concat(grams, near)), lambda g: F.element_at(F.get(weights, F.pmod(F.crc32(g.cast("binary")), F.lit(BUCKETS)).cast("int")), g)), lambda x: x.isNotNull())
        z = F.aggregate(rows, F.array(*[F.lit(b) for b in model.bias]), lambda a, x: F.zip_with(a, x, lambda p, q: p + q))

        def softmax(v: Column) -> Column:
            top = F.array_max(v)
            total = F.aggregate(v, F.lit(0.0), lambda a, x: a + F.exp((x - top) * model.temper))
            family = F.element_at(F.array(*[F.lit(c) for c in model.classes]), F.array_position(v, top).cast("int"))
            return F.struct(family.alias("family"), (F.lit(1.0) / total).alias("chance"))

        def judged(s: Column) -> Column:
            sure = F.when((s["chance"] >= CONFIDENT) & (s["family"] != UNKNOWN), s["family"]).otherwise(F.lit(UNKNOWN))
            return F.struct(sure.alias("family"), s["chance"].alias("chance"), confirmed(sure, w, F.array_join(w, " ")).alias("confirmed"))

        return bind(bind(z, softmax), judged)

    return of(paragraph)


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """(doc_id, n_paragraphs, found): found has, of each paragraph with a marker, paragraph (from 0), family, chance, confirmed."""
    model = model or trained()
    marks = sorted(markers())
    unwrapped = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), WRAPPED, " ")
    paragraphs = F.split(F.regexp_replace(F.lower(unwrapped), VERSIONED, "$1 $2"), "\n")

    def of(x: Column) -> Column:
        worded = F.transform(x, lambda t, i: F.struct(i.alias("paragraph"), F.regexp_extract_all(t, F.lit(WORD), F.lit(0)).alias("w")))
        marked = F.filter(worded, lambda y: F.exists(y["w"], lambda w: w.isin(marks)))
        found = F.transform(marked, lambda y: bind(_classified(y["w"], model), lambda c: F.struct(y["paragraph"].alias("paragraph"), c["family"].alias("family"), F.round(c["chance"], 6).alias("chance"), c["confirmed"].alias("confirmed"))))
        return F.struct(F.size(F.filter(x, lambda t: F.length(F.btrim(t)) > 0)).cast("long").alias("n"), found.alias("found"))

    s = docs.select(F.col(id_col).alias("doc_id"), bind(paragraphs, of).alias("s"))
    return s.select("doc_id", F.col("s.n").alias("n_paragraphs"), F.col("s.found").alias("found"))


def op3_licences(spark, sf_dir: str) -> DataFrame:
    """One row a document: its licence paragraphs counted, the confirmed families and the likeliest one."""
    s = scanned(table(spark, sf_dir, "documents"))
    known = F.filter("found", lambda x: x["confirmed"])
    best = F.reverse(F.array_sort(F.transform(known, lambda x: F.struct(x["chance"].alias("chance"), (-x["paragraph"]).alias("n"), x["family"].alias("family")))))
    return s.select(
        "doc_id", "n_paragraphs",
        F.size("found").cast("long").alias("n_licence_like"),
        F.size(known).cast("long").alias("n_licences"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(known, lambda x: x["family"]))), ",").alias("families"),
        F.array_join(F.transform(known, lambda x: x["paragraph"].cast("string")), ",").alias("paragraphs"),
        F.get(best, F.lit(0))["family"].alias("best_family"),
        F.get(best, F.lit(0))["chance"].alias("best_chance"),
    )
