"""Operator 9, license scans: conditional compression against license templates.

A template's trigger words are so many of its words that no wording near enough to it
lacks them all; the words about one and a half template lengths to either side of a
trigger word, across line ends, are a candidate block. Each block is compressed alone
and with each template as a zstandard raw dictionary. The bytes saved, as a share of the
template's own compressed size, rank the (block, template) pairs; pairs under
``MIN_SAVING`` are given up, which loses no notice (a test confirms every block with
every template and compares). The others are confirmed in rank order by their exact
wording: the template's words that are missing there or stand in another order (all but
the longest common subsequence) are at most ``MAX_DIFFERENCES`` of its words, its words
with digits (versions) are all there, and no negation stands before. Where confirmed
templates cover the same stretch, the one with the fewest missing and added words, then
the highest saving, is reported; notices elsewhere are reported too. The scan is one
narrow pass; the trigger test runs before any row reaches Python.

Defined results. Null text counts as empty: no candidates, no license. Every row
of the input gives one row, null ids and repeated rows included; an empty table
an empty result. Equal savings are ranked by template name. Other columns are ignored.
Texts are scanned whole, however long; the cost grows with their trigger words.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.llm.common import text_of

# Customary notices of common licenses, and how they are named.
_GPL = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} "
        "as published by the Free Software Foundation, {}")
_LATER = "either version {} of the License, or (at your option) any later version."
TEMPLATES = {
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "AGPL-3.0-or-later": [_GPL.format("Affero General Public License", _LATER.format(3))],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0, January 2004",
                   "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", "Licensed under the BSD 2-Clause License."],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "Licensed under the BSD 3-Clause License.",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
                "Licensed under CC0 1.0 Universal."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-2.0-or-later": [_GPL.format("General Public License", _LATER.format(2)),
                         "This work is licensed under the GNU General Public License, version 2 or (at your option) any later version."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "GPL-3.0-or-later": [_GPL.format("General Public License", _LATER.format(3)),
                         "This work is licensed under the GNU General Public License, version 3 or (at your option) any later version."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1."],
    "LGPL-2.1-or-later": [_GPL.format("Lesser General Public License", _LATER.format("2.1"))],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "LGPL-3.0-or-later": [_GPL.format("Lesser General Public License", _LATER.format(3))],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
for _name in TEMPLATES:
    TEMPLATES[_name].append(f"SPDX-License-Identifier: {_name}")
NEGATIONS = [["not"], ["never"], ["isn", "t"]]      # words right before a notice that deny it
LEVEL = 12                  # lower levels miss matches with dictionaries this short
MIN_SAVING = 0.2            # bytes saved by a template, as a share of its own compressed size
MAX_DIFFERENCES = 0.1
_WORD = re.compile(r"\w+(?:[.-]\w+)*")


def wording(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Template:
    """A notice's words, prepared for comparison and as a compressor."""

    def __init__(self, name: str, text: str, alone):
        import zstandard as z
        self.name, self.words = name, wording(text)
        n = self.length = max(1, len(self.words))
        self.allowed = int(MAX_DIFFERENCES * n + 1e-9)
        self.distinct = set(self.words)
        self.reach = n + n // 2 + 4
        self.numbers = {w for w in self.words if any(c.isdigit() for c in w)}
        # one more than may be missing: the longest words, which are the rarest
        self.triggers = sorted(self.distinct, key=lambda w: (-len(w), w))[:self.allowed + 1]
        self.masks, self.back = {}, {}
        for i, w in enumerate(self.words):
            self.masks[w] = self.masks.get(w, 0) | 1 << i
            self.back[w] = self.back.get(w, 0) | 1 << (n - 1 - i)
        data = f" {' '.join(self.words)} ".encode()
        self.size = len(alone.compress(data))
        self.packer = z.ZstdCompressor(
            level=LEVEL, dict_data=z.ZstdCompressionDict(data * 2, dict_type=z.DICT_TYPE_RAWCONTENT),
            write_content_size=False, write_checksum=False, write_dict_id=False)

    def common(self, masks: dict, words) -> tuple[int, int]:
        """Length of the longest common subsequence, and how many of ``words`` it
        takes to reach it (bit-parallel: a zero bit for each word matched)."""
        full = (1 << self.length) - 1
        v, most, at = full, 0, 0
        for i, w in enumerate(words):
            m = masks.get(w)
            if m:
                u = v & m
                v = ((v + u) | (v - u)) & full
                same = self.length - v.bit_count()
                if same > most:
                    most, at = same, i + 1
        return most, at

    def place(self, words: list[str], at: int):
        """(words missing or added, start, end) of the stretch around word ``at`` that
        confirms the template, or None."""
        start = max(0, at - self.reach)
        near = words[start:at + self.reach + 1]
        if len(self.distinct.difference(near)) > self.allowed:
            return None
        same, end = self.common(self.masks, near)
        if self.length - same > self.allowed:
            return None
        _, taken = self.common(self.back, reversed(near[:end]))
        begin = end - taken
        if not self.numbers.issubset(near[begin:end]) or \
                any(near[max(0, begin - len(x)):begin] == x for x in NEGATIONS):
            return None
        return self.length - same + taken - same, start + begin, start + end


class Scanner:
    """Templates prepared for comparison."""

    def __init__(self, templates: dict[str, list[str]], min_saving: float = MIN_SAVING):
        import zstandard as z
        self.alone = z.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
        self.known = [Template(name, t, self.alone) for name in sorted(templates) for t in templates[name]]
        self.trigger = re.compile(trigger(self.known))
        self.of: dict[str, list[Template]] = {}
        for t in self.known:
            for w in t.triggers:
                self.of.setdefault(w, []).append(t)
        self.min_saving = min_saving
        self.stretch = 1 + 2 * max((t.reach for t in self.known), default=0)   # no place is longer

    def ranked(self, words: list[str], places: list[int]) -> list[tuple]:
        """(saving, place, template) of the candidate blocks, highest saving first."""
        out, blocks = [], {}
        for at in places:
            for t in self.of.get(words[at], ()):
                span = max(0, at - t.reach), at + t.reach + 1
                if span not in blocks:
                    data = " ".join(words[span[0]:span[1]]).encode()
                    blocks[span] = data, len(self.alone.compress(data))
                data, size = blocks[span]
                saving = (size - len(t.packer.compress(data))) / t.size
                if saving >= self.min_saving:
                    out.append((saving, at, t))
        return sorted(out, key=lambda x: (-x[0], x[1], x[2].name))

    def text(self, text: str):
        """(trigger words, confirmed licenses sorted, best saving, its differences)."""
        text = text.lower()
        if not self.known or not self.trigger.search(text):
            return 0, [], 0.0, 1.0
        words = _WORD.findall(text)
        places = [i for i, w in enumerate(words) if w in self.of]
        seen = {}
        for saving, at, t in self.ranked(words, places):
            got = t.place(words, at)
            if got and (t.name, got) not in seen:
                seen[t.name, got] = (got[0] / t.length, -saving, t.name, got[1], got[2])
        taken, found, best = {}, set(), (0.0, 1.0)
        for diff, less, name, start, end in sorted(seen.values()):
            k = start // self.stretch
            if any(2 * (min(end, e) - max(start, s)) > min(end - start, e - s)
                   for j in (k - 1, k, k + 1) for s, e in taken.get(j, ())):
                continue                # the same stretch, named better already
            taken.setdefault(k, []).append((start, end))
            found.add(name)
            best = max(best, (-less, diff), key=lambda x: (x[0], -x[1]))
        return len(places), sorted(found), *best


def trigger(known: list[Template]) -> str:
    """A pattern for Spark and Python: any trigger word of any template."""
    words = sorted({w for t in known for w in t.triggers})
    return r"(?i)(?:" + "|".join(map(re.escape, words)) + ")" if words else r"(?!)"


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per document: doc_id, n_candidates, licenses (array), saving and
    differences of its best confirmed notice (0 and 1 without one). ``n_candidates``
    counts the trigger words."""
    templates = TEMPLATES if templates is None else templates
    pattern = Scanner(templates).trigger.pattern
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, n_candidates long, licenses array<string>, saving double, differences double"
    d = docs.select("doc_id", text_of(docs).alias("text"))
    # only texts with a trigger word go to Python with their text
    d = d.select("doc_id", F.when(F.col("text").rlike(pattern), F.col("text")).alias("text"))

    def work(batch_iter):
        s = Scanner(templates)
        none = (0, [], 0.0, 1.0)
        for batch in batch_iter:
            got = [s.text(t.as_py()) if t.is_valid else none for t in batch.column(1)]
            cols = list(zip(*got))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.list_(pa.string())),
                 pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64())],
                ["doc_id", "n_candidates", "licenses", "saving", "differences"])

    return d.mapInArrow(work, fields)
