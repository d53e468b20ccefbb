"""License scan: winnowed fingerprints pick candidates, banded alignment reports coverage and spans.

Words (letters and digits, lower case) of templates and texts are hashed in
runs of K, and of each W neighbouring hashes the smallest are kept.  A shared
run of K + W - 1 words shares a fingerprint, which the inverted index of the
templates finds.  Each candidate is a template and a diagonal; a banded
alignment of the words there gives the share of the template that the text
covers, and where.  The words that tell licenses apart (name, version) must
stand in the text exactly as in the template.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm import textbytes as B
from orderlake.llm.common import map_arrow

K, W = 3, 2
#: Least share of a template's words that must be found.
COVERAGE = 0.8
#: Share of a template's length by which its copy may drift off its diagonal.
DRIFT = 0.2

#: Notices by which public licenses are usually applied.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD", "Licensed under the BSD License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, Version 2.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    # Titles of the full texts.
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
]
#: Identifiers whose SPDX line is a template too; of an expression, the first one is reported.
SPDX = (
    "MIT MIT-0 Apache-2.0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 MPL-2.0 EPL-2.0 BSD-2-Clause BSD-3-Clause 0BSD ISC Unlicense CC0-1.0 "
    "CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0"
).split()
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}") for name in SPDX]

#: Names and versions.  Those that a template holds must stand in the text too, each as one run of words.
NAMES = [
    "MIT License", "BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "ISC License", "Apache License, Version 2.0", "under the Apache License, Version 2.0",
    "GNU General Public License", "GNU Lesser General Public License", "GNU Affero General Public License",
    "Public License, version 2", "Public License, version 2.1", "Public License, version 3", "either version 2 of", "either version 2.1 of", "either version 3 of",
    "Mozilla Public License, v. 2.0", "Mozilla Public License, Version 2.0", "Eclipse Public License, Version 2.0", "Eclipse Public License 2.0", "Eclipse Public License - v 2.0",
    *(f"CC {kind} 4.0" for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")), "CC0 1.0 Universal",
    *(f"Creative Commons Attribution{kind} 4.0" for kind in ("", "-ShareAlike", "-NonCommercial", "-NoDerivatives", "-NonCommercial-ShareAlike", "-NonCommercial-NoDerivatives")),
    *(f"SPDX-License-Identifier: {name}" for name in SPDX),
]

_OUTSIDE = ~B.ALNUM


def winnow(words: np.ndarray, whole: np.ndarray | None = None) -> np.ndarray:
    """Positions of the kept fingerprints among the runs; ``whole`` marks runs that lie in one text."""
    h = B.gram_hashes(words, K)
    n = len(words) - K + 1
    keep = np.zeros(len(words), bool)
    if n < 1:
        return np.flatnonzero(keep), h
    h_ = np.where(whole[:n], h[:n], ~np.uint64(0)) if whole is not None else h[:n]
    if n < W:
        keep[:n] = True
    else:
        low = np.min([h_[i : n - W + 1 + i] for i in range(W)], axis=0)
        for i in range(W):
            keep[i : n - W + 1 + i] |= h_[i : n - W + 1 + i] == low
    if whole is not None:
        keep[:n] &= whole[:n]
    return np.flatnonzero(keep), h


def _holds(words: np.ndarray, run: np.ndarray) -> bool:
    return len(words) >= len(run) and bool((np.lib.stride_tricks.sliding_window_view(words, len(run)) == run).all(axis=1).any())


class Templates:
    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES):
        self.names = [n for n, _ in templates]
        raw = [t.encode() for _, t in templates]
        self.words = [B.word_hashes([t], _OUTSIDE)[0] for t in raw]
        if min(map(len, self.words)) < K + W - 1:
            raise ValueError(f"a template has fewer than {K + W - 1} words")
        names = [B.word_hashes([n.encode()], _OUTSIDE)[0] for n in NAMES]
        self.marks = [[n for n in names if _holds(w, n)] for w in self.words]
        keys, number, place = [], [], []
        for i, w in enumerate(self.words):
            at, h = winnow(w)
            keys.append(h[at])
            number.append(np.full(len(at), i))
            place.append(at)
        self.index = B.Postings(np.concatenate(keys), np.concatenate(number), np.concatenate(place))


def scan_texts(t: Templates, raw: list[bytes], coverage: float = COVERAGE) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, template, coverage, first byte, last byte) of the found notices of some texts."""
    words, starts, ends, first = B.word_hashes(raw, _OUTSIDE)
    if not len(words):
        return
    owner = np.repeat(np.arange(len(raw)), np.diff(first))
    whole = np.zeros(len(words), bool)
    if len(words) >= K:
        whole[: len(words) - K + 1] = owner[: len(words) - K + 1] == owner[K - 1 :]
    kept, h = winnow(words, whole)
    pos, template, place = t.index.hits(h[kept])
    if not len(pos):
        return
    pos = kept[pos]
    order = np.lexsort((pos - place, template, owner[pos]))
    text_start = np.cumsum([0] + [len(x) + 1 for x in raw])
    seen: list[tuple[int, int, int]] = []
    for i in order:
        doc, k, diagonal = int(owner[pos[i]]), int(template[i]), int(pos[i] - place[i])
        pattern = t.words[k]
        m, slack = len(pattern), max(1, int(DRIFT * len(t.words[k])))
        if seen and seen[-1][:2] == (doc, k) and diagonal <= seen[-1][2]:
            continue
        seen = [(doc, k, diagonal + slack)]
        low, high = max(int(first[doc]), diagonal - slack), min(int(first[doc + 1]), diagonal + 2 * slack + m)
        part = words[low:high]
        edits, s, e = B.banded_alignment(pattern, part, diagonal - slack - low, diagonal + 2 * slack - low)
        share = 1 - edits / m
        if share >= coverage and e > s and all(_holds(part[s:e], n) for n in t.marks[k]):
            yield doc, k, share, int(starts[low + s] - text_start[doc]), int(ends[low + e - 1] - text_start[doc])


SCHEMA = "doc_id long, license string, template int, coverage double, start long, end long"


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """One row per notice found: doc_id, license, template, coverage, start, end (code points of the text).

    Where notices overlap (a short one inside a longer one) the one with the
    most covered words is reported, then the best coverage, then the first
    template.  Null and empty texts hold no notice; null or repeated
    identifiers are rows like any other; an empty table gives no rows; extra
    columns are ignored.  Whole texts are read, whatever their length.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Templates(templates)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            raw = [(x or "").encode("utf-8", "surrogatepass") for x in batch.column(1).to_pylist()]
            out: list[list] = [[] for _ in range(6)]
            for a, b in B.chunks(raw):
                found: dict[int, list] = {}
                for doc, k, share, start, end in scan_texts(t, raw[a:b], coverage):
                    found.setdefault(a + doc, []).append((-share * len(t.words[k]), -share, k, start, end))
                for doc, rows in found.items():
                    taken: list[tuple[int, int]] = []
                    for _, share, k, start, end in sorted(rows):
                        if all(end <= s or e <= start for s, e in taken):
                            taken.append((start, end))
                            begin = len(raw[doc][:start].decode("utf-8", "ignore"))
                            row = (ids[doc], t.names[k], k, -share, begin, begin + len(raw[doc][start:end].decode("utf-8", "ignore")))
                            for c, v in zip(out, row, strict=True):
                                c.append(v)
            types = (pa.int64(), pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(out, types, strict=True)], ["doc_id", "license", "template", "coverage", "start", "end"])

    return map_arrow(rows, find, SCHEMA)
