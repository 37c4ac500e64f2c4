"""Licence notices in texts: MinHash bands over windows, then exact containment.

Words are runs of ASCII letters, digits and non-ASCII characters, lower-cased;
shingles are of ``WIDTH`` words. Templates are dealt into classes by length, each
at most a quarter longer than the one before; a text is cut into windows of one
and a half times the class's length, which start every half length, so any run of
a template's length lies whole in some window. A window's MinHash signature has
``BANDS`` bands of ``ROWS`` values; templates with an equal band are retrieved and
verified: the share of the template's shingles that the window holds, counted
exactly, must reach ``CONTAINMENT``. A window that holds that share has a Jaccard
similarity of at least ``LEAST_SIMILAR`` with the template, at which one of the
bands is equal with a chance of ``collision_chance()``, above 1 - 1e-5.

Notices of one family differ in a word or two, so a whole notice contains most of
its siblings'. With ``telling``, the window must also hold the shingles that tell
the licence from its siblings (version, Lesser or Affero, SA, NC, ND), so a window
with a sibling's notice alone is no match, and one beside it still is.

Windows that hold no shingle of any template are skipped: their containment is 0.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entwise.llm.common import LOWER, SpanHashes, mix64, prepare, release, slices, string_buffers, word_spans
from entwise.llm.decontaminate import IS_WORD

WIDTH = 3
CONTAINMENT = 0.8
ROWS = 2
BANDS = 128
#: Least Jaccard similarity of a template with a window that contains CONTAINMENT
#: of it: the window has at most 15/8 of the template's words, and a few shingles
#: more than that for the rounding of short classes.
LEAST_SIMILAR = 0.3
SLICE_BYTES = 1 << 18

# FIXED VALUES: notices as their licences word them.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Proprietary", "All rights reserved. No part of this work may be reproduced without written permission."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Library General Public License as published by the Free Software Foundation; either "
                 "version 2 of the License"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either "
                 "version 2.1 of the License"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation, either "
                 "version 3 of the License"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either "
                 "version 3 of the License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                 "International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                 "International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 "
                 "International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
                 "International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
                 "International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
]

#: Shingles that tell a licence from its siblings: a template needs those of them
#: that it has itself.
TELLING = {
    "Apache-2.0": ["version 2 0"],
    "MPL-2.0": ["v 2 0"],
    "GPL-2.0": ["gnu general public", "license version 2", "version 2 of"],
    "GPL-3.0": ["gnu general public", "license version 3", "version 3 of"],
    "LGPL-2.0": ["gnu library general", "version 2 of"],
    "LGPL-2.1": ["gnu lesser general", "version 2 1"],
    "LGPL-3.0": ["gnu lesser general", "license version 3", "version 3 of"],
    "AGPL-3.0": ["gnu affero general", "license version 3", "version 3 of"],
    "CC-BY-4.0": ["commons attribution 4", "attribution 4 0", "cc by 4", "by 4 0"],
    "CC-BY-SA-4.0": ["attribution sharealike 4", "sharealike 4 0", "by sa 4", "sa 4 0"],
    "CC-BY-NC-4.0": ["attribution noncommercial 4", "noncommercial 4 0", "by nc 4", "nc 4 0"],
    "CC-BY-ND-4.0": ["attribution noderivatives 4", "noderivatives 4 0", "by nd 4", "nd 4 0"],
    "CC-BY-NC-SA-4.0": ["noncommercial sharealike 4", "sharealike 4 0", "nc sa 4", "sa 4 0"],
    "CC-BY-NC-ND-4.0": ["noncommercial noderivatives 4", "noderivatives 4 0", "nc nd 4", "nd 4 0"],
}

_A = mix64(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64)) | np.uint64(1)
_B = mix64(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(7919))


def collision_chance(similarity: float = LEAST_SIMILAR) -> float:
    return 1 - (1 - similarity ** ROWS) ** BANDS


def _shingles(words: np.ndarray) -> np.ndarray:
    n = len(words) - WIDTH + 1
    if n <= 0:
        return words[:0]
    acc = np.zeros(n, np.uint64)
    for i in range(WIDTH):
        acc = mix64(acc * np.uint64(3) + words[i:i + n])
    return acc


def _bands(shingles: np.ndarray) -> list[int]:
    """Band values of a set's MinHash signature, different for different bands."""
    low = ((shingles[:, None] * _A) + _B).min(0)
    key = np.zeros(BANDS, np.uint64)
    for r in range(ROWS):
        key = mix64(key * np.uint64(3) + low[r::ROWS])
    return mix64(key + np.arange(BANDS, dtype=np.uint64)).tolist()


def _words(raw: np.ndarray, offsets: np.ndarray):
    low = LOWER[raw]
    start, end, first = word_spans(low, offsets, IS_WORD)
    return SpanHashes(low).of(start, end), first


class Library:
    """Templates by class, with band buckets."""

    def __init__(self, templates: Sequence[tuple[str, str]], telling: Mapping[str, Sequence[str]] | None = None):
        self.names, self.sets, self.needs, self.buckets = [], [], [], {}
        for name, text in templates:
            words, _ = _words(*string_buffers(pa.array([text])))
            shingles = np.unique(_shingles(words))
            if not len(shingles):
                raise ValueError(f"template of {name} has fewer than {WIDTH} words")
            m = 4
            while m < len(words):
                m = max(m + 1, m * 5 // 4)
            buckets = self.buckets.setdefault(m, defaultdict(set))
            for band in _bands(shingles):
                buckets[band].add(len(self.sets))
            self.names.append(name)
            self.sets.append(shingles)
            phrases = (telling or {}).get(name, ())
            told = [_shingles(_words(*string_buffers(pa.array([x])))[0]) for x in phrases]
            self.needs.append(np.intersect1d(np.concatenate([shingles[:0], *told]), shingles))
        self.known = np.unique(np.concatenate(self.sets))

    def matches(self, shingles: np.ndarray) -> dict[int, tuple[float, int]]:
        """template -> (containment, first word of the window) of its best window."""
        places = np.flatnonzero(self.known[np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)] == shingles)
        found: dict[int, tuple[float, int]] = {}
        if not len(places):
            return found
        for m, buckets in self.buckets.items():
            half, size = -(-m // 2), m + -(-m // 2)
            # windows start every half length; those that hold one of the places
            last = places // half
            near = np.unique(np.concatenate([last - k for k in range(-(-size // half))]))
            for w in near[near >= 0].tolist():
                window = np.unique(shingles[w * half:w * half + size - WIDTH + 1])
                if not len(window):
                    continue
                for t in set().union(*(buckets.get(b, ()) for b in _bands(window))):
                    if not np.isin(self.needs[t], window).all():
                        continue
                    held = len(np.intersect1d(self.sets[t], window, assume_unique=True)) / len(self.sets[t])
                    if held >= CONTAINMENT and (held, -w * half) > (found[t][0], -found[t][1]) if t in found else held >= CONTAINMENT:
                        found[t] = (held, w * half)
        return found


def _scan(library: Library):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            raw, off = string_buffers(batch.column(1))
            for i, j in slices(off, SLICE_BYTES):
                words, first = _words(raw[off[i]:off[j]], off[i:j + 1] - off[i])
                got = []
                for d in range(j - i):
                    best: dict[str, tuple[float, int]] = {}
                    for t, (held, at) in library.matches(_shingles(words[first[d]:first[d + 1]])).items():
                        name = library.names[t]
                        if name not in best or (-held, at) < (-best[name][0], best[name][1]):
                            best[name] = (held, at)
                    got.append([{"license": n, "containment": c, "word": int(w)} for n, (c, w) in sorted(best.items())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(first), pa.int64()),
                     pa.array(got, pa.list_(pa.struct([("license", pa.string()), ("containment", pa.float64()),
                                                       ("word", pa.int64())])))],
                    ["doc_id", "n_words", "found"])
    return run


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES,
                  telling: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """doc_id, n_words and ``found`` for every row of ``docs`` (doc_id, text): for
    each licence with a template that some window contains to CONTAINMENT of its
    shingles, its name, the best containment and the window's first word (the
    earliest of the best), ordered by name. With ``telling`` (as ``TELLING``), only
    windows that hold a licence's telling shingles count, so siblings are told apart.

    Null, empty and wordless texts have none. Rows with a null doc_id are left
    out, repeated ones are reported each. Extra columns are ignored; an empty
    table gives an empty result.
    """
    prepare(docs.sparkSession)
    library = Library(templates, telling)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .filter("doc_id IS NOT NULL")
    return rows.mapInArrow(
        _scan(library), "doc_id long, n_words long, found array<struct<license:string,containment:double,word:long>>")
