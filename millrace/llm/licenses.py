"""License scans by conditional compression.

Templates are short statements, the standard notices, and full license texts (``license_texts/``). Texts
and templates are read as words, so line breaks, comment marks and letter case do not matter, and a notice may lie
anywhere in a text.

A block is a stretch of words around a cue: near the rarest telling word of a short template all its telling words, or
runs of four words that occur once in a long template on about the same diagonal. Stretches that overlap are one block. A
block is compressed alone and with every template as raw zstandard dictionary, and the templates are ranked by the bytes
saved. The first in rank whose wording is confirmed in the block is its winner: missing, added and changed words may
make up at most ``MOST`` of the template, and none of the words that tell licenses apart may lack. Each place of the winner
is then a block of its own, compressed and ranked again, since a block may hold several notices; the winner there is the
finding if its template saves bytes on it. What is left of a block on either side is judged in the same way until nothing is confirmed, so every place is a
finding, also of a license that the text has elsewhere. Equal savings are settled by the fewest differing words, then by name.

Only texts with a cue are read: the longest telling word of some template. NULL and empty texts have none. Every finding is
a row; its place is that of its first word. Rows that are repeated are judged each; a NULL id stays NULL.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from importlib import resources
from itertools import groupby

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import batch_of

#: Name, wording, words that tell it from the others.
STATEMENTS = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3.", "affero 3"),
    ("ARR", "All rights reserved.", "all rights reserved"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2 0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted", "redistribution forms modification"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", "cc by 4 0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "cc by nc 4 0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "cc by sa 4 0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0.", "cc0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", "gnu general 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "gnu general 3"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3.", "lesser 3"),
    ("MIT", "Released under the MIT License.", "mit license"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla 2 0"),
]
_GNU = (
    "{what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by "
    "the Free Software Foundation, either version {n} of the License, or (at your option) any later version."
)
#: Standard notices of source headers and pages.
NOTICES = [
    ("AGPL-3.0", _GNU.format(what="This program", kind="Affero General Public License", n="3"), "affero 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
     "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache 2 0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "bsd license"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "commons attribution 4 0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
     "commons attribution noncommercial 4 0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
     "commons attribution sharealike 4 0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
     "waived neighboring"),
    ("GPL-2.0", _GNU.format(what="This program", kind="General Public License", n="2"), "gnu general 2"),
    ("GPL-3.0", _GNU.format(what="This program", kind="General Public License", n="3"), "gnu general 3"),
    ("LGPL-2.1", _GNU.format(what="This library", kind="Lesser General Public License", n="2.1"), "lesser 2 1"),
    ("LGPL-3.0", _GNU.format(what="This library", kind="Lesser General Public License", n="3"), "lesser 3"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction", "permission granted charge software restriction"),
    ("MIT", "Licensed under the MIT License.", "mit license"),
]
#: Words that tell the full texts apart.
FULL = {
    "Apache-2.0": "apache 2 0", "BSD-2-Clause": "redistribution forms modification", "BSD-3-Clause": "redistribution modification endorse",
    "CC0-1.0": "cc0", "GPL-2.0": "gnu general 2", "GPL-3.0": "gnu general 3", "LGPL-2.1": "lesser 2 1", "LGPL-3.0": "lesser 3",
    "MIT": "permission granted charge software restriction", "MPL-2.0": "mozilla 2 0",
}


def full_texts() -> list[tuple[str, str, str]]:
    """The license texts of this package; the BSD text without its third clause is another license."""
    folder = resources.files("millrace.llm") / "license_texts"
    texts = {name: (folder / f"{name}.txt").read_text() for name in FULL if name != "BSD-2-Clause"}
    texts["BSD-2-Clause"] = re.sub(r"(?s)3\. Neither.*?permission\.\n", "", texts["BSD-3-Clause"])
    return [(name, texts[name], FULL[name]) for name in sorted(FULL)]


TEMPLATES = STATEMENTS + NOTICES + full_texts()
MOST = 0.25
#: Templates with more words are looked for by their runs of ``RUN`` words.
LONG = 64
RUN = 4
#: Short blocks whose ranking a task remembers; the same notices come again and again.
REMEMBERED = 10_000
LEVEL = 9
#: Words around a place that are ranked with it.
PAD = 3
_word = re.compile(r"[^\W_]+")


def cue_pattern(templates: list[tuple[str, str, str]]) -> str:
    """Matches every text that holds all telling words of a template, by the longest of them."""
    longest = {max(sorted(tells.split()), key=lambda w: (len(w), w)) for _, _, tells in templates}
    return r"(?iu)(?<![\p{L}\p{N}])(?:" + "|".join(sorted(longest)) + r")(?![\p{L}\p{N}])"


def _places_of(words: list[str]) -> dict[str, list[int]]:
    known: dict[str, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        known[w].append(i)
    return known


def _any_between(places: list[int], first: int, last: int) -> bool:
    i = bisect_left(places, first)
    return i < len(places) and places[i] <= last


@dataclass
class Kind:
    """A template; its words are the dictionary."""

    name: str
    words: list[str]
    tells: set[str]
    compressor: zstandard.ZstdCompressor

    def __post_init__(self) -> None:
        self.counts = Counter(self.words)
        self.slack = max(2, int(MOST * len(self.words)))

    def near(self, part: list[str]) -> bool:
        """Whether enough words are there, in whatever order."""
        return (self.counts & Counter(part)).total() >= (1 - MOST) * len(self.words)

    def aligned(self, part: list[str]) -> tuple[int, int, int, int] | None:
        """(first word, end, words in common, differing words) of the best place that begins with the first word in common."""
        if not self.near(part):
            return None
        equal = [o for o in SequenceMatcher(None, self.words, part, autojunk=False).get_matching_blocks() if o.size]
        best, common, differ = None, 0, 0
        at, first = (0, equal[0].b) if equal else (0, 0)
        spot = first
        for block in equal:
            differ += max(block.a - at, block.b - spot)
            common += block.size
            at, spot = block.a + block.size, block.b + block.size
            whole = differ + len(self.words) - at
            if best is None or whole < best[3]:
                best = (first, spot, common, whole)
        if best is None or best[3] > MOST * len(self.words) or not self.tells <= set(part[best[0] : best[1]]):
            return None
        return best


class Scanner:
    def __init__(self, templates: list[tuple[str, str, str]]):
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.kinds = []
        self.runs: dict[tuple[str, ...], list[tuple[int, int]]] = defaultdict(list)
        self.ranked: dict[str, list[tuple[int, int]]] = {}
        for name, text, tells in templates:
            words = _word.findall(text.lower())
            given = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            given.precompute_compress(level=LEVEL)
            self.kinds.append(Kind(name, words, set(tells.split()), zstandard.ZstdCompressor(level=LEVEL, dict_data=given)))
            if len(words) > LONG:
                runs = [tuple(words[i : i + RUN]) for i in range(len(words) - RUN + 1)]
                often = Counter(runs)
                for i, run in enumerate(runs):
                    if often[run] == 1:
                        self.runs[run].append((len(self.kinds) - 1, i))

    def rank(self, block: list[str]) -> list[tuple[int, int]]:
        """(bytes saved, template) of all templates on a block, most first."""
        text = " ".join(block)
        ranked = self.ranked.get(text)
        if ranked is None:
            data = text.encode()
            alone = len(self.plain.compress(data))
            saved = [(alone - len(kind.compressor.compress(data)), i) for i, kind in enumerate(self.kinds)]
            ranked = sorted(saved, key=lambda s: (-s[0], s[1]))
            if len(text) <= 1_000:
                if len(self.ranked) >= REMEMBERED:
                    self.ranked.clear()
                self.ranked[text] = ranked
        return ranked

    def findings(self, text: str) -> Iterator[tuple[int, str, int, int]]:
        """(place of the first word, license, bytes saved, differing words), by place."""
        spots = [m.start() for m in _word.finditer(text)]
        words = [w.lower() for w in _word.findall(text)]
        found = []
        left = self.blocks(words)
        while left:
            first, last = left.pop()
            taken = sorted(self._judged(words, first, last))
            found += taken
            if taken:
                cuts = [first, *(c for f in taken for c in f[:2]), last]
                left += [(a, b) for a, b in zip(cuts[::2], cuts[1::2]) if a < b]
        for start, _, saved, differ, i in sorted(found):
            yield spots[start], self.kinds[i].name, saved, differ

    def blocks(self, words: list[str]) -> list[tuple[int, int]]:
        """Stretches of words (first, end) around cues; those that overlap are one."""
        known = _places_of(words)
        found = [c for i, own in self._clusters(words).items() if self.kinds[i].tells <= known.keys() for c in own]
        for kind in self.kinds:
            if len(kind.words) <= LONG and kind.tells <= known.keys():
                reach = len(kind.words) + kind.slack
                for p in min((known[t] for t in sorted(kind.tells)), key=len):
                    if all(_any_between(known[t], p - reach, p + reach) for t in kind.tells):
                        found.append((max(0, p - reach), min(len(words), p + reach + 1)))
        merged: list[tuple[int, int]] = []
        for a, b in sorted(found):
            if merged and a < merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged

    def _judged(self, words: list[str], first: int, last: int) -> list[tuple[int, int, int, int, int]]:
        """(first word, end, bytes saved, differing words, template) of the places of a block's winner, each ranked by itself."""
        for _, places in self._confirmed(words, first, last):
            found: list[tuple[int, int, int, int, int]] = []
            for start, end, _, _ in sorted(places):
                # A little more than the place, since the words at its ends may tell another template; never what is found already.
                low = max(first, start - PAD, found[-1][1] if found else first)
                for i, own in self._confirmed(words, low, min(last, end + PAD)):
                    start, end, _, differ = own[0]
                    saved = {k: s for s, k in self.rank(words[start:end])}[i]
                    if saved > 0:
                        found.append((start, end, saved, differ, i))
                        break
            if found:
                return found
        return []

    def _confirmed(self, words: list[str], first: int, last: int) -> Iterator[tuple[int, list[tuple[int, int, int, int]]]]:
        """By rank the templates whose wording a block holds, and their places there, best first."""
        block = words[first:last]
        known = _places_of(block)
        clusters = None
        for _, equal in groupby(self.rank(block), key=lambda r: r[0]):
            confirmed = []
            for _, i in equal:
                kind = self.kinds[i]
                if kind.tells <= known.keys():
                    if len(kind.words) > LONG:
                        clusters = self._clusters(block) if clusters is None else clusters
                        places = self._apart(self._long(kind, block, clusters.get(i, [])))
                    else:
                        places = self._apart(self._short(kind, block, known))
                    if places:
                        confirmed.append((places[0][3], kind.name, i, [(first + a, first + b, *rest) for a, b, *rest in places]))
            for _, _, i, places in sorted(confirmed):
                yield i, places

    @staticmethod
    def _apart(places: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Of places that overlap the best ones."""
        kept: list[tuple[int, int, int, int]] = []
        used: set[int] = set()
        for place in sorted(places, key=lambda f: (-f[2], f[3], f[0])):
            if used.isdisjoint(range(place[0], place[1])):
                used.update(range(place[0], place[1]))
                kept.append(place)
        return kept

    @staticmethod
    def _short(kind: Kind, words: list[str], known: dict[str, list[int]]) -> list[tuple[int, int, int, int]]:
        rare = min((known[t] for t in sorted(kind.tells)), key=len)
        reach = len(kind.words) + kind.slack
        starts = {i for p in rare for i in range(max(0, p - reach + 1), p + 1) if words[i] in kind.counts}
        found = set()
        for start in starts:
            place = kind.aligned(words[start : start + reach])
            if place is not None:
                found.add((start + place[0], start + place[1], *place[2:]))
        return list(found)

    def _clusters(self, words: list[str]) -> dict[int, list[tuple[int, int]]]:
        """Per long template: stretches of words in which its runs come in order."""
        # Stretches in the making: first and last word, and the diagonal last seen.
        growing: dict[int, list[list[int]]] = defaultdict(list)
        found: dict[int, list[tuple[int, int]]] = defaultdict(list)

        def close(k: int, first: int, last: int, diagonal: int) -> None:
            found[k].append((max(0, first), min(len(words), max(last, diagonal + len(self.kinds[k].words)) + RUN)))

        for i in range(len(words) - RUN + 1):
            for k, at in self.runs.get(tuple(words[i : i + RUN]), ()):
                slack = self.kinds[k].slack
                for old in [g for g in growing[k] if i - g[1] > slack]:
                    growing[k].remove(old)
                    close(k, *old)
                fits = [g for g in growing[k] if abs(i - at - g[2]) <= slack]
                for g in fits:
                    g[1:] = i + RUN, i - at
                if not fits:
                    growing[k].append([i - at, i + RUN, i - at])
        for k, left in growing.items():
            for g in left:
                close(k, *g)
        return found

    @staticmethod
    def _long(kind: Kind, words: list[str], clusters: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
        found = []
        for a, b in clusters:
            place = kind.aligned(words[a:b])
            if place is not None:
                found.append((a + place[0], a + place[1], *place[2:]))
        return found


def license_findings(docs: DataFrame, templates: list[tuple[str, str, str]] = TEMPLATES) -> DataFrame:
    """Rows (doc_id, place, license, bytes_saved, differences) of ``docs`` (doc_id, text)."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("place", pa.int64()), ("license", pa.string()), ("bytes_saved", pa.int32()), ("differences", pa.int32()),
    ])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            out = [
                (doc_id, *found)
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                for found in scanner.findings(text)
            ]
            if out:
                yield batch_of(dict(zip(schema.names, zip(*out))), schema)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.where(F.col("text").rlike(cue_pattern(templates))).mapInArrow(
        scan, "doc_id bigint, place bigint, license string, bytes_saved int, differences int"
    )
