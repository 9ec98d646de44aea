import random
import re

import pytest

from paperloom.llm import licences as L

#: Statements whose wording shares no frame with training. The classes were written down before the first run; after it the weight of refusals
#: and of bare names in training was changed, so ``UNSEEN`` has been looked at. ``LATER`` has not been used for any change.
UNSEEN = [
    ("gpl", "Licensed under the GNU General Public License v2"), ("gpl", "This module can be copied under GPLv3 or any later version."), ("gpl", "The engine's source is GPL."), ("gpl", "Copyright (C) 1999 by A. Person. GNU General Public License applies, version 2."),
    ("lgpl", "Linking is allowed as this is LGPL 2.1 code."), ("lgpl", "See the GNU Lesser General Public License for the details that govern this library."), ("agpl", "Our server ships under AGPL 3."), ("agpl", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("mit", "The parser is open source (MIT License)."), ("mit", "MIT © 2019 the contributors, license: MIT"), ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"), ("mit", "Das Paket wird unter der MIT-Lizenz vertrieben."), ("mit", "El programa tiene licencia MIT."),
    ("apache", "Apache License 2.0, see NOTICE."), ("apache", "All of our tools come with an Apache 2.0 license."), ("apache", "you may not use this file except in compliance with the Apache License"), ("bsd", "Simplified BSD License applies to the whole tree."), ("bsd", "Redistribution and use in source and binary forms are permitted provided that"),
    ("cc-by", "Photos by A. Person, CC BY 2.0."), ("cc-by", "This chapter is open access under a Creative Commons Attribution 4.0 licence."), ("cc-by-sa", "Wikipedia text, CC BY-SA 3.0"), ("cc-by-sa", "Share under the same terms: Creative Commons Attribution-ShareAlike."), ("cc-by-nc", "For teaching only: CC BY-NC 3.0."), ("cc-by-nc", "Creative Commons Attribution-NonCommercial-NoDerivatives, 2015"),
    ("cc0", "Data dedicated with CC0."), ("cc0", "No rights reserved: CC0 1.0"), ("mpl", "Mozilla Public License 2.0 (MPL)"), ("epl", "Eclipse Public License, see about.html"), ("isc", "ISC License, 2016"), ("unlicense", "The text of the Unlicense is at the end."), ("unlicense", "free and unencumbered software released into the public domain"), ("zlib", "zlib License, (C) 2011"),
    ("unknown", "This snippet was never under the MIT license."), ("unknown", "The MIT license fee is due"), ("unknown", "She taught at MIT before the war."), ("unknown", "They flew an Apache over the border."), ("unknown", "The general public may not use the source."), ("unknown", "No license, Apache or other, is given."), ("unknown", "Not under the GPL."),
    ("unknown", "Kommt mit zur Lizenz."), ("unknown", "A license plate was lost."), ("unknown", "It is not released under CC BY 4.0"), ("unknown", "El río no tiene licencia."), ("unknown", "Attribution of the painting is in doubt."), ("unknown", "The creative team shared the award."), ("unknown", "The foundation published a public statement."),
]
LATER = [("gpl", "Kernel code, GPL-2.0"), ("gpl", "The GNU General Public License covers most of the archive."), ("mit", "Everything here is MIT licensed"), ("mit", "(MIT License) by two friends"), ("apache", "Apache-2.0 OR whatever you like"), ("bsd", "Three clause BSD, see COPYING"), ("cc-by", "Figure 3 reproduced from [4], CC BY 4.0"), ("cc-by-sa", "CC BY-SA, 2012"), ("cc-by-nc", "Audio: CC BY-NC"), ("lgpl", "Shipped as LGPL"), ("mpl", "MPL-2.0 everywhere"), ("epl", "EPL v2"), ("cc0", "The dataset is CC0"), ("isc", "ISC licensed"), ("agpl", "GNU AGPL 3"), ("unlicense", "Unlicense applies"), ("unknown", "MIT was founded in 1861."), ("unknown", "Contrary to rumours this is not MIT licensed."), ("unknown", "A licence dispute about the river"), ("unknown", "GPL questions are answered on the list"), ("unknown", "we cannot accept code under the AGPL"), ("unknown", "Er kam mit Lizenz."), ("unknown", "the public license office"), ("unknown", "without the Apache License")]


@pytest.mark.parametrize(("statements", "precise", "recalled"), [(UNSEEN, 0.9, 0.7), (LATER, 0.7, 0.5)])
def test_unseen_statements(docs, statements, precise, recalled):
    found = {r["doc_id"]: [(x["family"], x["confirmed"]) for x in r["found"]] for r in L.scanned(docs([(i, t) for i, (_, t) in enumerate(statements)])).collect()}
    confirmed = [next((f for f, c in found[i] if c), "unknown") for i in range(len(statements))]
    pairs = [(asked, got) for (asked, _), got in zip(statements, confirmed, strict=True)]
    named = [p for p in pairs if p[1] != "unknown"]
    recall = sum(a == b for a, b in pairs if a != "unknown") / sum(a != "unknown" for a, _ in pairs)
    precision = sum(a == b for a, b in named) / len(named)
    print("precision", precision, "recall", recall, [(a, b, t) for (a, b), (_, t) in zip(pairs, statements, strict=True) if a != b])
    assert precision >= precise
    assert recall >= recalled


def test_held_back_frames():
    model, right, sure = L.trained(), 0, 0.0
    rows = L.statements(True)
    for grams, c in rows:
        p = model.chances(grams)
        right += model.classes[int(p.argmax())] == c
        sure += float(p.max())
    assert right / len(rows) > 0.75
    assert abs(sure - right) / len(rows) < 0.12  # calibrated


def test_scan(docs):
    text = "First line of text.\nLicensed under the Apache License, Version 2.0.\n\nThe driver must hold a valid license.\nReleased under the MIT License."
    rows = [(1, text), (2, None), (3, ""), (4, "no such thing"), (5, "\n".join(["Filler words."] * 5000) + "\nLicensed under CC BY-NC 4.0."), (5, "This work is licensed under the GNU General Public License, version 3."), (None, "All rights reserved."), (6, "mit")]
    found = [(r["doc_id"], r["n_paragraphs"], [(x["paragraph"], x["family"], x["confirmed"]) for x in r["found"]]) for r in L.scanned(docs(rows)).collect()]
    assert found == [
        (1, 4, [(1, "apache", True), (4, "mit", True)]), (2, 0, []), (3, 0, []), (4, 1, []),
        (5, 5001, [(5000, "cc-by-nc", True)]), (5, 1, [(0, "gpl", True)]), (None, 1, []), (6, 1, [(0, "unknown", False)]),
    ]
    assert L.scanned(docs([])).count() == 0


def test_wrapped_header(docs):
    header = "# Copyright 2020 A. Person.\n#\n# Licensed under the Apache\n# License, Version 2.0 (the License);\r\n# you may not use this file except\n# in compliance with the License.\n\nOther text."
    found = L.scanned(docs([(1, header)])).first()["found"]
    assert [(x["family"], x["confirmed"]) for x in found] == [("apache", True)]


def test_refusals_and_others(docs):
    refused = [f.format(n) for f in L.REFUSALS[0] for names in L.NAMED.values() for n in names[:2]]
    rows = [(i, t) for i, t in enumerate([*refused, *L.OTHERS, *L.NAMESAKES])]
    wrong = [t for r in L.scanned(docs(rows)).collect() for x in r["found"] if x["confirmed"] for t in [rows[r["doc_id"]][1]]]
    assert len(wrong) <= 0.02 * len(rows), wrong


def test_matches_the_model(docs):
    m, r = L.trained(), random.Random(3)
    lines = [f.format(n) for names in L.NAMED.values() for n in names for f in r.sample(L.GRANTS[0] + L.REFUSALS[1], 3)] + list(L.OTHERS) + ["Code: MIT, see CC BY 4.0 notes", "gnu gnu gnu license", "Lizenz für Bücher: GPLv3 née"]
    for row, line in zip(L.scanned(docs([(i, t.replace("\n", " ")) for i, t in enumerate(lines)])).orderBy("doc_id").collect(), lines, strict=True):
        words = L.words_of(line)
        if L.markers().isdisjoint(words):
            assert not row["found"]
            continue
        p = m.chances(L.ngrams_of(words))
        own = m.classes[int(p.argmax())]
        assert row["found"][0]["chance"] == pytest.approx(float(p.max()), abs=1e-5)
        assert row["found"][0]["family"] == (own if p.max() >= L.CONFIDENT else "unknown")


def test_query_against_plain(spark, docs, tmp_path):
    rows = [(1, "Released under the MIT License.\nAlso licensed under the Apache License, Version 2.0."), (2, "Nothing here."), (3, None), (4, "Not licensed under the GPL.\nCC0"), (2, "Nothing here.")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    m = L.trained()

    def plain(text):
        out = []
        for i, line in enumerate((text or "").split("\n")):
            p = m.chances(L.ngrams_of(L.words_of(line)))
            k = m.classes[int(p.argmax())]
            if p.max() >= L.CONFIDENT and k != "unknown" and re.search(rf"(?<!\S)(?:{L.BORNE[k]})(?!\S)", " ".join(L.words_of(line))):
                out.append((i, k))
        return out

    for r in L.op3_licences(spark, str(tmp_path)).collect():
        asked = plain(dict(rows)[r["doc_id"]])
        assert (r["n_licences"], r["families"], r["paragraphs"]) == (len(asked), ",".join(sorted({k for _, k in asked})), ",".join(str(i) for i, _ in asked))


def test_no_python(docs):
    plan = L.scanned(docs([(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan
    assert "Arrow" not in plan


def test_versions_and_tags(docs):
    lines = {
        "Distributed under GPLv3.": "gpl", "This code is GPLv2 or later.": "gpl", "Available under LGPLv2.1+.": "lgpl", "AGPLv3.": "agpl", "Released to the public domain (Unlicense).": "unlicense",
        "SPDX-License-Identifier: MIT.": "mit", "SPDX-License-Identifier: BSD-3-Clause.": "bsd", "SPDX-License-Identifier: GPL-2.0-only.": "gpl", "SPDX-License-Identifier: LGPL-3.0.": "lgpl",
        "SPDX-License-Identifier: AGPL-3.0.": "agpl", "SPDX-License-Identifier: ISC.": "isc", "SPDX-License-Identifier: CC0-1.0.": "cc0",
    }
    found = L.scanned(docs([(1, "\n".join([*lines, *L.OTHERS]))])).first()["found"]
    assert {x["paragraph"]: x["family"] for x in found if x["confirmed"]} == dict(enumerate(lines.values()))
