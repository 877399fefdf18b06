"""Licence notices by conditional compression.

A block near a telling word is compressed alone and with each template as a raw dictionary. The
template that saves most bytes describes it best; it is confirmed by the words in which
block and template differ. Its words are taken out, and what is left is searched again.
"""

from __future__ import annotations

import re
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Usual wordings of licence notices.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright, CC0 1.0, public domain"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved. No part of this work may be reproduced without permission."),
)
# Words near which a notice is looked for, and names without which a notice is none.
TELLING = (r"(?i)licen[cs]e|copyright|redistribution\W+and\W+use|permission\W+is\W+hereby|public\W+domain"
           r"|rights\W+reserved")
NAMES = frozenset(("mit apache gnu general lesser affero public mozilla cc by cc0 sa nc nd free unencumbered redistribution "
                   "permission rights reserved").split())
REACH = 32
LIKE = 0.6

_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")
_BLANK = re.compile(r"\n[^\S\n]*\n")
_KEEP = 4_096


@dataclass(frozen=True)
class Match:
    start: int
    length: int
    licence: str
    gain: int
    n_different: int
    differences: str


class LicenceScanner:
    """Blocks of a text around telling words and their licences."""

    def __init__(self, templates=TEMPLATES):
        import zstandard as z

        self.alone = z.ZstdCompressor(level=9, write_content_size=False)
        self.templates = []
        for licence, text in templates:
            raw = z.ZstdCompressionDict(self._plain(text).encode(), dict_type=z.DICT_TYPE_RAWCONTENT)
            self.templates.append((licence, _WORD.findall(text.lower()), z.ZstdCompressor(
                level=9, dict_data=raw, write_content_size=False, write_dict_id=False)))
        self.telling = re.compile(TELLING)
        self.kept: dict = {}  # what the latest blocks hold

    @staticmethod
    def _words(text: str) -> list[str]:
        # Found first: small letters can be more characters, and more words.
        return [w.lower() for w in _WORD.findall(text)]

    @classmethod
    def _plain(cls, text: str) -> str:
        return " ".join(cls._words(text))

    @staticmethod
    def _before(text: str, low: int, at: int) -> int:
        """Where the up to `REACH` words that end before `at` begin, not before `low` or a blank line."""
        size = 16 * REACH
        while True:
            start = max(low, at - size)
            blank = None
            for blank in _BLANK.finditer(text, start, at):
                pass
            words = [w.start() for w in _WORD.finditer(text, blank.end() if blank else start, at)]
            # The first word may be cut by the start of the slice.
            if len(words) > REACH:
                return words[-REACH]
            if blank or start == low:
                return words[0] if words else at
            size *= 2

    @staticmethod
    def _after(text: str, at: int, high: int) -> int:
        """Where the up to `REACH` words that begin after `at` end, not after `high` or a blank line."""
        words = [w.end() for w in islice(_WORD.finditer(text, at, high), REACH)]
        end = words[-1] if words else at
        blank = _BLANK.search(text, at, end)
        if blank:
            words = [w for w in words if w <= blank.start()]
            end = words[-1] if words else at
        return end

    def ranked(self, block: str) -> list[tuple[int, int]]:
        """(bytes saved, template) of all templates, most first."""
        data = self._plain(block).encode()
        size = len(self.alone.compress(data))
        return sorted(((size - len(t[2].compress(data)), -i) for i, t in enumerate(self.templates)), reverse=True)

    def differences(self, block: str, template: int) -> tuple[list[str], list[str], float, tuple[int, int]]:
        """Words the template has and the block lacks, words the block has within the match, share matched, the match's words."""
        words, mine = self._words(block), self.templates[template][1]
        runs = [r for r in SequenceMatcher(None, words, mine, autojunk=False).get_matching_blocks() if r.size]
        if not runs:
            return mine, [], 0.0, (0, 0)
        # What lies before the first and after the last equal word is no part of the notice, nor are
        # equal words that lie farther off than they are many.
        best, begin, total = (0, 0, 0), 0, 0
        for i, r in enumerate(runs):
            gap = r.a - runs[i - 1].a - runs[i - 1].size if i else 0
            if total < gap:
                begin, total = i, r.size
            else:
                total += r.size - gap
            best = max(best, (total, i - begin, i))
        runs = runs[best[2] - best[1]:best[2] + 1]
        inside = set().union(*(range(r.a, r.a + r.size) for r in runs))
        have = set().union(*(range(r.b, r.b + r.size) for r in runs))
        extra = [words[i] for i in range(min(inside), max(inside) + 1) if i not in inside]
        missing = [w for i, w in enumerate(mine) if i not in have]
        return missing, extra, len(have) / len(mine), (min(inside), max(inside))

    def confirmed(self, block: str, template: int) -> tuple[list[str], tuple[int, int]] | None:
        """The wording differences if the block holds that notice (all numbers and names of it, most of its words), and where."""
        mine, words = self.templates[template][1], set(self._words(block))
        absent = [w for w in mine if w not in words]
        if len(mine) - len(absent) < LIKE * len(mine) or any(map(self._decides, absent)):
            return None
        missing, extra, share, match = self.differences(block, template)
        if share < LIKE or len(extra) > len(mine) or any(map(self._decides, (*missing, *extra))):
            return None
        return [*("-" + w for w in missing), *("+" + w for w in extra)], match

    @staticmethod
    def _decides(word: str) -> bool:
        return word in NAMES or any(c.isdigit() for c in word)

    def best(self, block: str) -> tuple[int, int, list[str], tuple[int, int]] | None:
        """(gain, template, differences, words of the match) of the best-ranked template that the block's words confirm."""
        plain = self._plain(block)
        if plain not in self.kept:
            if len(self.kept) >= _KEEP:
                self.kept.clear()
            self.kept[plain] = None
            for gain, i in self.ranked(block):
                if gain <= 0:
                    break
                found = self.confirmed(block, -i)
                if found is not None:
                    self.kept[plain] = gain, -i, *found
                    break
        return self.kept[plain]

    def scan(self, text: str) -> list[Match]:
        """All notices in order of place: near each telling word until what is left confirms no template."""
        found: list[Match] = []
        taken: list[tuple[int, int]] = []  # in order, apart from each other
        for m in self.telling.finditer(text):
            while True:
                k = bisect_right(taken, (m.start(), len(text)))
                if k and m.start() < taken[k - 1][1]:
                    break
                low, high = taken[k - 1][1] if k else 0, taken[k][0] if k < len(taken) else len(text)
                start, end = self._before(text, low, m.start()), self._after(text, m.start(), high)
                hit = self.best(text[start:end])
                if hit is None:
                    break
                # A notice that the reach cuts off is looked at whole.
                spans = [w.span() for w in _WORD.finditer(text, start, end)]
                a, b = spans[hit[3][0]][0], spans[hit[3][1]][1]
                wide = self._before(text, low, a), self._after(text, a, high)
                whole = self.confirmed(text[wide[0]:wide[1]], hit[1])
                if whole is not None and len(whole[0]) < len(hit[2]):
                    spans = [w.span() for w in _WORD.finditer(text, *wide)]
                    hit = *hit[:2], *whole
                    a, b = spans[hit[3][0]][0], spans[hit[3][1]][1]
                insort(taken, (a, b))
                found.append(Match(a, b - a, self.templates[hit[1]][0], hit[0], len(hit[2]), " ".join(hit[2])))
        return sorted(found, key=lambda x: x.start)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = LicenceScanner()
    for batch in batches:
        rows = [(d, m.start, m.length, m.licence, m.gain, m.n_different, m.differences)
                for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for m in scanner.scan(text)]
        columns = list(zip(*rows)) or [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)],
            names=["doc_id", "start", "length", "licence", "gain", "n_different", "differences"])


def scan_licences(docs: DataFrame) -> DataFrame:
    """One row per licence notice: doc_id, start and length in characters, licence, gain in bytes, differences.

    Whole texts are searched. Texts without a telling word are left out in the scan and never
    reach Python. Null and empty texts have no notice; a repeated row gives repeated notices.
    A block reaches over line breaks to `REACH` words on either side of a telling word, or a blank line. It is
    given to the best-ranked template that its words confirm, what is left of it to the next; no confirmed one, no row.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).where(text.rlike(TELLING))
    return rows.mapInArrow(_scan, "doc_id long, start long, length long, licence string, gain long, n_different long, "
                                  "differences string")
