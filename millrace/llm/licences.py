"""Licence notices in texts: word bigrams of lines, paragraphs and whole texts against templates, by Dice coefficient."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.words import _LOWER, _PLACES, mix, slices, utf8, word_hashes

# Notices as their licences word them, named by SPDX id.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
                         "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
           "that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                 "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
                 "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
                 "is furnished to do so, subject to the following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_WORD = np.full(256, 32, np.uint8)
for _byte in (*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)):
    _WORD[_byte] = _LOWER[_byte]


def bigrams(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of neighbouring words; a single word counts as one, with nothing after it."""
    if len(words) == 1:
        return mix(words * _PLACES[0])
    return np.unique(mix(words[:-1] * _PLACES[0] + words[1:] * _PLACES[1]))


def template_bigrams(templates: Mapping[str, str]) -> dict[str, np.ndarray]:
    found = {}
    for name in sorted(templates):
        data = _WORD[np.frombuffer(templates[name].encode(), np.uint8)]
        own = bigrams(word_hashes(data, np.array([0, len(data)]))[0])
        if len(own):
            found[name] = own
    return found


def _units(blank: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of lines: the whole text, its paragraphs (between lines without words), and single lines, each once."""
    seen = set()
    full = np.flatnonzero(~blank)
    if not len(full):
        return
    edges = np.flatnonzero(np.diff(full) > 1) + 1
    paragraphs = [(int(x[0]), int(x[-1]) + 1) for x in np.split(full, edges)]
    for unit in [(int(full[0]), int(full[-1]) + 1), *paragraphs, *((int(k), int(k) + 1) for k in full)]:
        if unit not in seen:
            seen.add(unit)
            yield unit


def _scan(templates: Mapping[str, str], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = template_bigrams(templates)
        every = np.unique(np.concatenate([*sets.values(), np.zeros(0, np.uint64)]))
        least = min((len(x) for x in sets.values()), default=0) * threshold / (2 - threshold)
        for batch in slices(batches, "text"):
            ids, out = batch.column("id").to_pylist(), []
            data, offsets = utf8(batch.column("text"))
            if len(data) and len(every):
                lines = np.union1d(offsets, np.flatnonzero(data == 10) + 1)
                words, bounds = word_hashes(_WORD[data], lines)
                pairs = mix(words[:-1] * _PLACES[0] + words[1:] * _PLACES[1])
                near = np.concatenate([[0], np.cumsum(np.isin(pairs, every))]) if len(pairs) else np.zeros(len(words) + 1, np.int64)
                near = np.concatenate([near, near[-1:]])
                single = len(every) and any(len(x) == 1 for x in sets.values())
                first = np.searchsorted(lines, offsets)
                begins, ends = bounds[first[:-1]], bounds[first[1:]]
                hit = near[np.maximum(begins, ends - 1)] > near[begins]
                for row in np.flatnonzero((hit | bool(single)) & (ends > begins)):
                    own = bounds[first[row]:first[row + 1] + 1]
                    best: dict[str, tuple] = {}
                    for top, end in _units(np.diff(own) == 0):
                        a, b = own[top], own[end]
                        if near[max(a, b - 1)] - near[a] < least and not single:
                            continue
                        grams = bigrams(words[a:b])
                        fits: dict[str, float] = {}
                        for name, template in sets.items():
                            small, large = sorted((len(grams), len(template)))
                            if 2 * small >= threshold * (small + large):  # else no overlap can reach the threshold
                                fits[name] = 2 * len(np.intersect1d(grams, template, assume_unique=True)) / (small + large)
                        name = min(fits, key=lambda x: (-fits[x], x), default=None)
                        if name is not None and fits[name] >= threshold:
                            start, stop = int(lines[first[row] + top] - offsets[row]), int(lines[first[row] + end] - offsets[row])
                            best[name] = min(best.get(name, (0.0,)), (-fits[name], stop - start, start))
                    out += [(ids[row], name, -x[0], x[2], x[1]) for name, x in sorted(best.items())]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["id", "licence", "dice", "start_byte", "n_bytes"])
    return run


def scan_licences(docs: DataFrame, templates: Mapping[str, str] = NOTICES, threshold: float = 0.85, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """``id_column, licence, dice, start_byte, n_bytes``: per row and template the best stretch whose best template it is.

    A stretch is a line, a paragraph (lines up to one without words) or the whole text, so a notice is found alone as well
    as within a text. Words are runs of ASCII letters and digits and of other characters, A-Z in lower case; all else is
    white space. The coefficient is 2 |A and B| / (|A| + |B|) over the distinct pairs of neighbouring words, and a stretch of
    one word has that word as its pair. Templates whose size alone rules the threshold out are not compared, nor are texts
    without any pair of a template. Of equal coefficients the shortest stretch counts, then the first; its place is in
    bytes of UTF-8. Stretches below ``threshold`` are none; of templates that fit a stretch equally the first by name counts.

    A null or empty text, and one with no such stretch, gives no row; ids may be null or repeat, each row gives its own.
    Other columns are ignored; an empty table or no templates give an empty result.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    found = rows.mapInArrow(_scan(dict(templates), threshold), "id long, licence string, dice double, start_byte long, n_bytes long")
    return found.withColumnRenamed("id", id_column)

