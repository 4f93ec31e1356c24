"""License notices in texts: conditional compression, confirmed by wording.

Sentences and lines that hold a cue word, with neighbours that share most of their word pairs
with some template, form candidate blocks. A block is compressed as it is and with every
template as a raw dictionary; templates are ranked by the bytes they save, as text that a
dictionary already holds costs next to nothing. The winner is confirmed by its exact
wording: the span of the block that takes the fewest word edits to become the template is
found, at most one word in ``WORDS_PER_EDIT`` may differ, and numbers and names must be the
same, so another version is another license. If the winner is not confirmed the next one is
tried. What lies before and behind a confirmed span is ranked again, until nothing is confirmed.

Blocks of more than ``PIECE`` words are cut into pieces that overlap by more than the longest
template, so no span is lost and the work grows with the text. Case, punctuation and white
space do not matter; places are code points of the text, end exclusive.

Rows: null and empty texts have no notices; every row is worked on by itself and whole, so
repeated rows each give the same; of templates that save the same the earlier in the list
goes first; an empty table gives an empty table; only the key and the text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

WORDS_PER_EDIT = 10
PIECE = 2000
LEVEL = 19
# Distinct blocks whose notices a task remembers.
MEMORY = 20_000

# Names of licenses as notices give them, and published wordings.
NAMES = {
    "MIT": ["the MIT License", "the MIT licence", "MIT"],
    "Apache-2.0": ["the Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GNU GPL version 3", "GPLv3", "GPL 3.0"],
    "GPL-2.0": ["the GNU General Public License, version 2", "the GNU GPL version 2", "GPLv2", "GPL 2.0"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3", "LGPLv3"],
    "LGPL-2.1": ["the GNU Lesser General Public License, version 2.1", "LGPLv2.1"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3", "AGPLv3"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "MPL 2.0"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the 2-clause BSD license"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-clause BSD license"],
    "ISC": ["the ISC License"],
    "EPL-2.0": ["the Eclipse Public License, version 2.0"],
    "CC0-1.0": ["CC0 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0"],
}
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
WORDINGS = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-3-Clause": _BSD + _BSD_THIRD,
    "BSD-2-Clause": _BSD,
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
    "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
    "binary, for any purpose, commercial or non-commercial, and by any means.",
}
# Names of license families; they must be the same words in notice and template.
FAMILIES = frozenset(
    "mit apache gnu gpl lgpl agpl lesser affero general mozilla mpl bsd isc eclipse cc cc0 by sa nc nd attribution "
    "sharealike noncommercial noderivatives international neither endorse".split()
)
TEMPLATES = [(name, text) for name, text in WORDINGS.items()] + [
    (name, f"under {text}") for name, texts in NAMES.items() for text in texts
]

# Every template holds one of these; short names count only behind "under".
_CUE = re.compile(
    r"licen[cs]|redistribut|permission|copyright|public domain"
    r"|\bunder\W+(?:the\W+)?(?:mit|apache|gnu|[al]?gpl|mpl|cc|bsd|isc)",
    re.I,
)
_CUT = re.compile(r"\n|(?<=[.!?;:])[ \t]+")
_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")


def words_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    found = list(_WORD.finditer(text))
    return [m.group().lower() for m in found], [m.span() for m in found]


def nearest_span(block: np.ndarray, template: np.ndarray) -> tuple[int, int, int]:
    """Word edits, start and end of the span of the block that is nearest to the template; the first of equals."""

    def ends(hay: np.ndarray, needle: np.ndarray, free: bool) -> np.ndarray:
        places = np.arange(len(hay) + 1)
        row = np.zeros_like(places) if free else places
        for at, word in enumerate(needle, 1):
            step = np.minimum(row[1:] + 1, row[:-1] + (hay != word))
            step = np.concatenate([[at], step])
            row = np.minimum.accumulate(step - places) + places
        return row

    last = ends(block, template, True)
    end = int(last.argmin())
    back = ends(block[:end][::-1], template[::-1], False)
    return int(last[end]), end - int(back.argmin()), end


class Scanner:
    """The templates with what is derived from them once a task."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.templates = [(name, words_of(text)[0]) for name, text in templates]
        self.longest = max((len(words) for _, words in self.templates), default=0)
        self.pairs = {pair for _, words in self.templates for pair in zip(words, words[1:])}
        self.numbers = {w: n for n, w in enumerate(sorted({w for _, words in self.templates for w in words}))}
        self.coded = [self.codes(words) for _, words in self.templates]
        self.named = [[w for w in words if _named(w)] for _, words in self.templates]
        self.memory: dict[tuple[str, ...], list] = {}

    @cached_property
    def plain(self) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

    @cached_property
    def primed(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for _, words in self.templates:
            raw = zstandard.ZstdCompressionDict(
                " ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False))
        return made

    def codes(self, words: list[str]) -> np.ndarray:
        return np.array([self.numbers.get(w, -1) for w in words], np.int64)

    def ranked(self, words: list[str]) -> list[tuple[int, float]]:
        """Templates that save bytes, most first, with the share that they save."""
        body = " ".join(words).encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(body))
        saved = [alone - len(one.compress(body)) for one in self.primed]
        order = sorted(range(len(saved)), key=lambda t: -saved[t])
        return [(t, saved[t] / alone) for t in order if saved[t] > 0]

    def notices(self, words: list[str]) -> list[tuple[int, int, str, float, str]]:
        """Start, end, license, saved share and wording differences of all notices in a block."""
        out, todo = [], [(0, len(words))]
        while todo:
            low, high = todo.pop()
            part = words[low:high]
            if len(part) < 2:
                continue
            coded = self.codes(part)
            for t, share in self.ranked(part):
                hit = self.confirmed(part, coded, t)
                if hit:
                    start, end, changes = hit
                    out.append((low + start, low + end, self.templates[t][0], share, changes))
                    todo += [(low, low + start), (low + end, high)]
                    break
        return sorted(out)

    def confirmed(self, words: list[str], coded: np.ndarray, t: int) -> tuple[int, int, str] | None:
        template = self.templates[t][1]
        edits, start, end = nearest_span(coded, self.coded[t])
        if edits > len(template) // WORDS_PER_EDIT or [w for w in words[start:end] if _named(w)] != self.named[t]:
            return None
        return start, end, differences(template, words[start:end]) if edits else ""

    def scan(self, text: str) -> list[tuple[int, int, str, float, str]]:
        """The notices of a whole text, by their places in it."""
        found = []
        for low, high in self.blocks(text):
            words, spans = words_of(text[low:high])
            seen = set()
            lap = 2 * self.longest
            for at in range(0, max(1, len(words) - lap), PIECE - lap):
                piece = words[at : at + PIECE]
                for start, end, name, share, changes in self.remembered(tuple(piece)):
                    start, end = at + start, at + end
                    if any(start < e and s < end for s, e in seen):
                        continue
                    seen = {(s, e) for s, e in seen if e > at} | {(start, end)}
                    found.append((low + spans[start][0], low + spans[end - 1][1], name, share, changes))
        return sorted(found)

    def remembered(self, words: tuple[str, ...]) -> list:
        if words not in self.memory:
            if len(self.memory) >= MEMORY:
                self.memory.clear()
            self.memory[words] = self.notices(list(words))
        return self.memory[words]

    def blocks(self, text: str) -> Iterator[tuple[int, int]]:
        """Runs of units with a cue, or next to one and mostly in the words of some template."""
        if not _CUE.search(text):
            return
        edges = [0, *(m.end() for m in _CUT.finditer(text)), len(text)]
        units = [(a, b) for a, b in zip(edges, edges[1:]) if a < b]
        held = [bool(_CUE.search(text, a, b)) for a, b in units]
        # From every cue outward, once in each direction.
        for order in (range(len(units)), range(len(units) - 1, -1, -1)):
            before = False
            for u in order:
                if before and not held[u]:
                    held[u] = self.alike(text[slice(*units[u])])
                before = held[u]
        start = None
        for (a, b), take in zip(units, held):
            if take and start is None:
                start = a
            elif not take and start is not None:
                yield start, a
                start = None
        if start is not None:
            yield start, len(text)

    def alike(self, text: str) -> bool:
        words, _ = words_of(text)
        pairs = list(zip(words, words[1:]))
        # A unit of one word, as the number of a clause, joins what stands around it.
        return len(words) < 2 or 2 * sum(pair in self.pairs for pair in pairs) >= len(pairs)


def _named(word: str) -> bool:
    return word in FAMILIES or any(c.isdigit() for c in word)


def differences(template: list[str], words: list[str]) -> str:
    """The fewest word edits from the template: ``-`` words that lack, ``+`` words that are new."""
    rows = [list(range(len(words) + 1))]
    for i, word in enumerate(template, 1):
        row, last = [i], rows[-1]
        for j, other in enumerate(words, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (word != other)))
        rows.append(row)
    i, j, out = len(template), len(words), []
    while i or j:
        here = rows[i][j]
        if i and j and here == rows[i - 1][j - 1] + (template[i - 1] != words[j - 1]):
            i, j = i - 1, j - 1
            if template[i] != words[j]:
                out += [f"+{words[j]}", f"-{template[i]}"]
        elif i and here == rows[i - 1][j] + 1:
            i -= 1
            out.append(f"-{template[i]}")
        else:
            j -= 1
            out.append(f"+{words[j]}")
    return " ".join(reversed(out))


def find(
    docs: DataFrame,
    templates: list[tuple[str, str]] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key`` and ``notices``, an array of (start, stop, license, saved, changes), for every row.

    Templates of the caller's own must hold a cue word, as those of the module do.
    """
    source = docs.select(F.col(key).alias(key), F.col(text).alias("_text"))
    kind = "start long, stop long, license string, saved double, changes string"
    templates = TEMPLATES if templates is None else templates
    struct = pa.struct(
        [("start", pa.int64()), ("stop", pa.int64()), ("license", pa.string()), ("saved", pa.float64()), ("changes", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in common.steps(batches, 1):
            rows = [
                [dict(zip(struct.names, notice)) for notice in scanner.scan(one or "")]
                for one in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(struct))], [key, "notices"])

    fields = kind.replace(" ", ": ").replace(",:", ",")
    return common.mapped(source, run, f"`{key}` {dict(source.dtypes)[key]}, notices array<struct<{fields}>>")


def report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: number of notices, licenses in order of their names, and all spans with their changes."""
    span = F.transform(
        "notices",
        lambda n: F.concat_ws(":", n["license"], n["start"].cast("string"), n["stop"].cast("string"), n["changes"]),
    )
    return found.select(
        key,
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.col("notices.license"))), ",").alias("licenses"),
        F.array_join(span, ",").alias("spans"),
        F.array_max(F.col("notices.saved")).alias("most_saved"),
    )
