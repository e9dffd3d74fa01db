"""License scan by conditional compression.

A template of ``m`` words may differ in a tenth of them.  It is cut into one piece more than it may
have differences, so a text that holds it has one of the pieces word for word.  Around every such
piece, whatever the lines, blank lines and comment signs, template and text are aligned word by word.
An aligned block is compressed alone and with the template as a raw zstandard dictionary, and blocks are
ranked by the bytes that the template saves.  From the top of the ranking a block is confirmed by its
wording, which may differ in no more than a tenth, unless it overlaps one that saves more.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

TOLERANCE = 0.1  # of a template's words may be missing or added

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
    "notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
_BSD_3 = (
    f"{_BSD} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
    "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
)
_GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version {} of the License, or (at your option) any "
    "later version."
)
# Wordings of public license notices, by SPDX identifier.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", _BSD_3),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0-or-later", _GPL.format(2)),
    ("GPL-3.0-or-later", _GPL.format(3)),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0-only", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
WORD = re.compile(r"[^\W_]+(?:\.\d+)*")


def wording(text: str) -> list[str]:
    return WORD.findall(text.lower())


def align(want: list[str], words: list[str], most: int) -> tuple[int, list[str], list[str]] | None:
    """(words used, missing, added) of the start of ``words`` that differs least from ``want``, or None above ``most``."""
    if words[: len(want)] == want:
        return len(want), [], []
    over = most + 1
    costs = [{j: j for j in range(min(most, len(words)) + 1)}]
    for i, w in enumerate(want, 1):
        above, row = costs[-1], {}
        for j in range(max(0, i - most), min(len(words), i + most) + 1):
            cost = min(above.get(j, over), row.get(j - 1, over)) + 1
            row[j] = min(cost, above.get(j - 1, over)) if j and words[j - 1] == w else cost
        costs.append(row)
    cost, end = min(((c, j) for j, c in costs[-1].items()), default=(over, 0))
    if cost > most:
        return None
    missing, added, i, j = [], [], len(want), end
    while i or j:
        here = costs[i][j]
        if i and j and words[j - 1] == want[i - 1] and costs[i - 1].get(j - 1, over) == here:
            i, j = i - 1, j - 1
        elif i and costs[i - 1].get(j, over) + 1 == here:
            i -= 1
            missing.append(want[i])
        else:
            j -= 1
            added.append(words[j])
    return end, missing[::-1], added[::-1]


class Templates:
    """The templates ready for compression; built once per worker task."""

    def __init__(self, templates: list[tuple[str, str]]):
        import zstandard as z

        self.names = [n for n, _ in templates]
        self.words = [wording(t) for _, t in templates]
        self.most = [int(TOLERANCE * len(ws)) for ws in self.words]
        self.pieces: dict[str, list[tuple[int, int, int]]] = {}  # text of a piece -> (template, first word, end)
        for k, (ws, n) in enumerate(zip(self.words, self.most)):
            cuts = [len(ws) * i // (n + 1) for i in range(n + 2)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    self.pieces.setdefault(f" {' '.join(ws[a:b])} ", []).append((k, a, b))
        self.plain = z.ZstdCompressor(level=3)
        self.primed = [
            z.ZstdCompressor(level=3, dict_data=z.ZstdCompressionDict(" ".join(w).encode(), dict_type=z.DICT_TYPE_RAWCONTENT)) for w in self.words
        ]

    def saving(self, k: int, words: list[str]) -> int:
        """Bytes by which template ``k`` shortens compressed words."""
        raw = " ".join(words).encode()
        return len(self.plain.compress(raw)) - len(self.primed[k].compress(raw))

    def scan(self, text: str) -> list[tuple[int, int, str, int, list[str], list[str]]]:
        """(first line, lines, license, bytes saved, missing words, added words) of the licenses of a text that do not overlap."""
        low = text.lower()
        words = WORD.findall(low)
        joined, found, whole = f" {' '.join(words)} ", {}, set()
        for piece, places in self.pieces.items():
            at, seen, i = joined.find(piece), 0, 0
            while at >= 0:
                i, seen = i + joined.count(" ", seen, at), at
                for k, a, b in places:
                    if (k, i - a) not in whole:
                        self._extend(k, a, b, words, i, found, whole)
                at = joined.find(piece, at + 1)
        out, used = [], []
        ranked = sorted((-saved, len(missing) + len(added), start, end, k) for (start, end, k), (saved, missing, added) in found.items())
        for _, _, start, end, k in ranked:
            if all(end <= a or b <= start for a, b in used):
                saved, missing, added = found[start, end, k]
                used.append((start, end))
                out.append((start, end, self.names[k], saved, missing, added))
        if out:
            places = [m.start() for m in WORD.finditer(low)]
            out = [(low.count("\n", 0, places[a]), low.count("\n", places[a], places[b - 1]) + 1, *rest) for a, b, *rest in sorted(out)]
        return out

    def _extend(self, k: int, a: int, b: int, words: list[str], i: int, found: dict, whole: set) -> None:
        """Align template ``k`` around its words ``a .. b - 1``, which the text has from word ``i`` on."""
        want, most = self.words[k], self.most[k]
        before = align(want[:a][::-1], words[max(0, i - a - most) : i][::-1], most)
        after = before and align(want[b:], words[i + b - a : i + len(want) - a + most], most)
        if not after:
            return
        missing, added = before[1][::-1] + after[1], before[2][::-1] + after[2]
        differences = len(missing) + len(added)
        if differences > most:
            return
        if not differences:
            whole.add((k, i - a))
        start, end = i - before[0], i + b - a + after[0]
        if (start, end, k) not in found:
            saved = self.saving(k, words[start:end])
            if saved > 0:
                found[start, end, k] = saved, missing, added
        elif differences < len(found[start, end, k][1]) + len(found[start, end, k][2]):
            found[start, end, k] = found[start, end, k][0], missing, added


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per licensed block: id, ``line`` (from 0), ``n_lines``, ``license``, ``bytes_saved``, ``missing``, ``added``.

    Blocks of a text do not overlap; NULL and empty texts have none.  Rows are scanned one by one: repeated rows give repeated
    blocks, a NULL id is carried along, no rows give no rows.
    """
    own = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))
    words = ArrayType(StringType())
    schema = own.select(id_col).schema.add("line", "long").add("n_lines", "long").add("license", "string").add("bytes_saved", "long")
    schema = schema.add("missing", words).add("added", words)

    def scanned(batches):
        known = Templates(templates)
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for row in known.scan(text or ""):
                    at.append(i)
                    rows.append(row)
            col = list(zip(*rows)) if rows else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(list(c), t) for c, t in zip(col, types)]], names=schema.names
            )

    return own.mapInArrow(scanned, schema)
