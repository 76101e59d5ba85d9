"""License scans by conditional compression: a block compresses better with the wording it contains as dictionary.

Candidate blocks are the words around each cue (a word that license wordings use), as far to both sides as the
longest wording reaches and across line ends; blocks that touch are one. Comment marks are no words, and a word
that a line end cuts at its hyphen is whole. Places of a block are the runs of words that few enough word changes
turn some template into. The words of each place are compressed alone and with every template as a raw zstandard
dictionary, and templates are ranked by the bytes they save. The first in that order that the exact wording confirms
names the place: the word insertions, deletions and changes between the two must not exceed DIFFER of the
template's words. Ties go by the share of words that differ, then to the longer template. Readings of a block are taken
by the bytes they save as well. One whose run lies in that of one taken before, but for as many words as it may differ by,
is another reading of the same words and dropped, and so is one that a longer template of the same license covers.
Savings rank within a place and cut none: beside a long wording, in a whole block, a short one saves next to nothing.

Defined cases: null and empty texts have no blocks; a block lists each of its licenses once, at its best run;
several licenses in a text are listed in order of name;
repeated rows and ids give a row each; an empty table gives an empty result; only the id and text columns are
read. Blocks longer than MOST_WORDS are scanned in overlapping parts, so texts of any length are read whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from factloom.llm.common import mapped, table

# Wordings as the licenses and their usual notices give them.
_GNU = "This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
_SHORT = "This work is licensed under the GNU {}, version {}."
_SOURCE = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_TWO = " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_THIRD = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
TEMPLATES = [
    ("AGPL-3.0", _SHORT.format("Affero General Public License", "3")),
    ("AGPL-3.0", _GNU.format("program", ":", "Affero General Public License", ",", "3")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", _SOURCE + _TWO),
    ("BSD-3-Clause", _SOURCE),
    ("BSD-3-Clause", _SOURCE + _TWO + _THIRD),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", _SHORT.format("General Public License", "2")),
    ("GPL-2.0", _GNU.format("program", ";", "General Public License", ";", "2")),
    ("GPL-3.0", _SHORT.format("General Public License", "3")),
    ("GPL-3.0", _GNU.format("program", ":", "General Public License", ",", "3")),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1", _SHORT.format("Lesser General Public License", "2.1")),
    ("LGPL-2.1", _GNU.format("library", ";", "Lesser General Public License", ";", "2.1")),
    ("LGPL-3.0", _SHORT.format("Lesser General Public License", "3")),
    ("LGPL-3.0", _GNU.format("program", ":", "Lesser General Public License", ",", "3")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
]
CUES = r"licen[cs]|permission|redistribut|copyright|warrant|unencumbered"
DIFFER, MOST_WORDS = 0.15, 200
# Lower levels find less of a changed wording in its dictionary: at 3 some wordings with three changes got the name of a near one.
LEVEL = 9
# Comment marks that are letters, at the start of a line; all others have no word character and are no words.
MARKS = re.compile(r"^[ \t]*(?:dnl|rem|c)[ \t]+", re.I | re.M)
CUT = re.compile(r"(?<=\w-)[ \t\r]*\n[^\w\n]*(?=\w)")


def plain(text: str) -> list[str]:
    """Words in lower case without punctuation around them; inner marks stay (BY-NC, 4.0)."""
    return [w for w in (re.sub(r"^\W+|\W+$", "", x) for x in text.lower().split()) if w]


def ends(template: list[str], block: list[str], anywhere: bool = True) -> np.ndarray:
    """Least word edits between the template and a run of the block's words that ends before each place."""
    place = np.arange(len(block) + 1)
    row = np.zeros(len(block) + 1, np.int64) if anywhere else place
    words = np.array(block, object)
    for i, w in enumerate(template, 1):
        step = np.minimum(row[1:] + 1, row[:-1] + (words != w))
        # Insertions run along the row: the least of all earlier cells plus the distance.
        row = np.minimum.accumulate(np.concatenate([[i], step]) - place) + place
    return row


def differences(template: list[str], block: list[str]) -> int:
    """Least word edits between the template and any run of the block's words."""
    return int(ends(template, block).min())


def runs(template: list[str], block: list[str], most: int) -> list[tuple[int, int, int]]:
    """(edits, start, end) of the best run at each place where the template stands with at most so many edits."""
    out, row = [], ends(template, block)
    near = np.flatnonzero(row <= most)
    for part in np.split(near, np.flatnonzero(np.diff(near) > 1) + 1) if len(near) else []:
        end = int(part[np.argmin(row[part])])
        low = max(0, end - len(template) - most)
        back = ends(template[::-1], block[low:end][::-1], False)
        out.append((int(row[end]), end - int(np.argmin(back)), end))
    return out


class Scanner:
    def __init__(self, templates=TEMPLATES, cues: str = CUES, differ: float = DIFFER):
        import zstandard

        self.templates = [(name, plain(text)) for name, text in templates]
        # A wording with words put in reaches further than its own length.
        self.differ, self.reach = differ, max(len(w) + int(differ * len(w)) for _, w in self.templates)
        self.cue = re.compile(cues, re.I | re.A)
        self.alone = zstandard.ZstdCompressor(level=LEVEL)
        self.given = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(" ".join(w).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for _, w in self.templates]
        self.bags = [Counter(w) for _, w in self.templates]
        self.known: dict[str, list[tuple]] = {}
        self.named: dict[str, int | None] = {}

    def blocks(self, text: str) -> list[list[str]]:
        """The words around cues."""
        if not self.cue.search(text):
            return []
        words = [w for w in CUT.sub("", MARKS.sub("", text)).split() if w.isalnum() or re.search(r"\w", w)]
        spans: list[list[int]] = []
        for i in (i for i, w in enumerate(words) if self.cue.search(w)):
            a, b = max(0, i - self.reach), min(len(words), i + self.reach + 1)
            if spans and a <= spans[-1][1]:
                spans[-1][1] = b
            else:
                spans.append([a, b])
        return [plain(" ".join(words[a:b])) for a, b in spans]

    def runs(self, words: list[str]) -> list[tuple[int, int, int, int]]:
        """(template, edits, start, end) of every template in a part of a block: the places that may have a name."""
        part = " ".join(words)
        if part in self.known:
            return self.known[part]
        bag, out = Counter(words), []
        for i, (_, template) in enumerate(self.templates):
            most = int(self.differ * len(template))
            # Each of its words that the part lacks is an edit.
            if sum((self.bags[i] - bag).values()) <= most:
                out += [(i, *run) for run in runs(template, words, most)]
        return self.keep(self.known, part, out)

    def keep(self, memo: dict, key: str, value):
        if len(memo) >= 100_000:
            memo.clear()
        memo[key] = value
        return value

    def saved(self, words: list[str]) -> list[int]:
        """Bytes that each template as dictionary saves of the words."""
        raw = " ".join(words).encode()
        size = len(self.alone.compress(raw))
        return [size - len(c.compress(raw)) for c in self.given]

    def read(self, words: list[str]) -> int | None:
        """The template of a place: by the bytes saved the first that word differences confirm."""
        place = " ".join(words)
        if place in self.named:
            return self.named[place]
        sizes = [len(w) for _, w in self.templates]
        edits: dict[int, int] = {}

        def confirmed(i: int) -> bool:
            most = int(self.differ * sizes[i])
            if abs(sizes[i] - len(words)) > most:
                return False
            edits[i] = int(ends(self.templates[i][1], words, False)[-1])
            return edits[i] <= most

        ranked, out = sorted((-s, i) for i, s in enumerate(self.saved(words))), None
        for _, equal in groupby(ranked, lambda x: x[0]):
            if fit := [i for _, i in equal if confirmed(i)]:
                out = min(fit, key=lambda i: (edits[i] / sizes[i], -sizes[i], i))
                break
        return self.keep(self.named, place, out)

    def names(self, words: list[str]) -> list[tuple[str, int]]:
        """(license, word differences) of a block's licenses, in order of place."""
        found: dict[int, set] = {}
        for at in range(0, max(1, len(words) - self.reach), MOST_WORDS):
            for i, n, a, b in self.runs(words[at : at + MOST_WORDS + self.reach]):
                found.setdefault(i, set()).add((at + a, at + b, n))
        own = {i: sorted(x) for i, x in found.items()}
        readings = set()
        for a, b in {(a, b) for x in found.values() for a, b, _ in x}:
            i = self.read(words[a:b])
            # The run of fewest edits that the template has there; its runs are no longer than reach.
            near = own.get(i, ())[bisect_left(own.get(i, ()), (a - self.reach,)) : bisect_left(own.get(i, ()), (b,))]
            if there := [x for x in near if x[1] > a]:
                readings.add((i, *min(there, key=lambda x: (x[2], x))))
        ranked = []
        for i, a, b, n in readings:
            size = len(self.templates[i][1])
            ranked.append((-self.saved(words[a:b])[i], n / size, -size, a, b, i, n))
        taken, used = [], np.zeros(len(words), bool)
        for x in sorted(ranked):
            if (~used[x[3] : x[4]]).sum() > int(self.differ * -x[2]):
                taken.append(x)
                used[x[3] : x[4]] = True
        best: dict[str, tuple] = {}
        for x in sorted(taken, key=lambda x: (x[2], x[1], *x)):
            label = self.templates[x[5]][0]
            if label not in best or (best[label][1] > x[1] and not best[label][3] <= x[3] < x[4] <= best[label][4]):
                best[label] = x
        return [(label, x[6]) for label, x in sorted(best.items(), key=lambda y: y[1][3])]

    def scan(self, text: str | None) -> tuple[int, list[tuple[str, int]]]:
        blocks = self.blocks(text or "")
        return len(blocks), [x for words in blocks for x in self.names(words)]


def scan(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_blocks (candidates), n_confirmed, licenses (names joined by commas), n_differences, for every row."""
    def run(batches):
        import pyarrow as pa

        from factloom.llm import licences

        own = licences.Scanner(templates)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                n, found = own.scan(text.as_py())
                rows.append((n, len(found), ",".join(sorted({x[0] for x in found})), sum(x[1] for x in found)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64())
            cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], [id_col, "n_blocks", "n_confirmed", "licenses", "n_differences"])

    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_blocks bigint, n_confirmed bigint, licenses string, n_differences bigint"
    return mapped(docs.select(id_col, text_col), run, schema)


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
