"""Licence scans: Dice coefficient over word bigrams of normalised text against licence templates.

Text and templates are normalised to lower-case words without punctuation. A template of w words is
compared with every run of w words of a document (a shorter document as a whole). Bounds prune first:
a document too short for a template to reach the threshold is not compared with it, nor is one
that holds too few of its bigrams, nor a run that does; what remains gets its exact coefficient.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readweave.llm import text as T

LEAST_DICE = 0.8

#: Wordings of public licences and their notices.
TEMPLATES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "MIT-line": "Released under the MIT License.",
    "MIT-terms-line": "This project is licensed under the terms of the MIT license.",
}


def normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of all texts, and first-offsets by text."""
    data, offsets = T.buffers(column)
    data = T.LOWER[data]
    starts, ends, first = T.word_spans(data, offsets, T.ALNUM)
    return starts, ends, T.xxh64(data, starts, ends), first


def bigrams(hashes: np.ndarray) -> np.ndarray:
    """Hash of every two neighbouring words, one fewer than words."""
    with np.errstate(over="ignore"):
        return T.mix((T.rotl(hashes[:-1], 29) * T.P1) ^ hashes[1:])


class Template:
    def __init__(self, name: str, words: str):
        _, _, hashes, _ = normalised(pa.array([words]))
        self.name, self.words = name, len(hashes)
        self.counts = Counter(bigrams(hashes).tolist())
        self.members = np.array(sorted(self.counts), np.uint64)

    def dice(self, own: np.ndarray) -> float:
        """Coefficient of two multisets of bigrams."""
        common = sum(min(n, self.counts.get(b, 0)) for b, n in Counter(own.tolist()).items())
        return 2 * common / (len(own) + self.words - 1) if len(own) + self.words > 1 else 0.0

    def matches(self, own: np.ndarray, least: float) -> list[tuple[float, int, int]]:
        """(dice, first word, end word) of the best runs that do not overlap in a document of bigrams own."""
        width = min(self.words - 1, len(own))
        need = least * (width + self.words - 1) / 2  # common bigrams that the threshold asks for
        if width < need or not width:
            return []
        inside = np.isin(own, self.members)
        if inside.sum() < need:
            return []
        held = np.concatenate([[0], np.cumsum(inside)])
        bound = held[width:] - held[:-width]
        at = np.flatnonzero(bound >= need)
        scored = sorted(((-self.dice(own[a : a + width]), int(a)) for a in at))
        chosen: list[tuple[float, int, int]] = []
        for d, a in scored:
            if -d >= least and all(a + width < x or a > y - 1 for _, x, y in chosen):
                chosen.append((-d, a, a + width + 1))
        return chosen


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST_DICE) -> DataFrame:
    """(doc_id, license, start_char, end_char, dice): every passage that matches a template at least so well.

    Passages of one template do not overlap: the best comes first, of equals the first. Ends are exclusive,
    in code points. Templates of fewer than two words never match. A null or empty text has no match;
    repeated rows match each; only doc_id and text are read.
    """
    wanted = [t for t in (Template(k, v) for k, v in (templates or TEMPLATES).items()) if t.words > 1]
    every = np.unique(np.concatenate([t.members for t in wanted])) if wanted else np.zeros(0, np.uint64)
    table = np.zeros(1 << 20, dtype=bool)
    table[(every >> np.uint64(44)).astype(np.int64)] = True
    fewest = min((int(np.ceil(least * (t.words - 1) / (2 - least))) for t in wanted), default=1)
    names = ["doc_id", "license", "start_char", "end_char", "dice"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.blocks(batches):
            starts, ends, hashes, first = normalised(part.column("text"))
            pairs = bigrams(hashes) if len(hashes) > 1 else hashes[:0]
            hit = np.flatnonzero(table[(pairs >> np.uint64(44)).astype(np.int64)])
            doc, n = np.unique(np.searchsorted(first, hit, "right") - 1, return_counts=True)
            found = []
            points = None
            for d in doc[n >= fewest].tolist():
                a, b = int(first[d]), int(first[d + 1])
                for t in wanted:
                    for dice, x, y in t.matches(pairs[a : b - 1], least):
                        if points is None:
                            data, offsets = T.buffers(part.column("text"))
                            points = T.code_points(data)
                        base = points[offsets[d]]
                        found.append((d, t.name, int(points[starts[a + x]] - base), int(points[ends[a + y - 1]] - base), dice))
            at, license, start, end, dice = zip(*found, strict=True) if found else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(at, pa.int64())), pa.array(license, pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(dice, pa.float64())], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, license string, start_char long, end_char long, dice double")
