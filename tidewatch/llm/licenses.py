"""License scans: the Dice coefficient over word bigrams of texts and licence notices.

Lines, paragraphs, whole texts and windows of words anywhere in a text are compared with the
templates as normalised words. A coefficient of s needs sizes within s / (2 - s) of each
other, so most templates are ruled out by size before any bigram is looked at. For the same
reason a window holds that share of a template's bigrams; only where it does are windows
measured. Texts are read as words, so line breaks and comment marks do not matter to windows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_BSD_THREE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_FOUR = (
    "3. All advertising materials mentioning features or use of this software must display the following "
    "acknowledgement: This product includes software developed by the organization. 4. Neither the name of the "
    "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gnu(name: str, version: str, *, title: str, this: str = "This program") -> list[str]:
    """Sentence, header of a source file and head of the full text of a GNU licence."""
    return [
        f"This work is licensed under the {name}, version {version}.",
        f"{this} is free software: you can redistribute it and/or modify it under the terms "
        f"of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at "
        "your option) any later version.",
        f"{name} {title} Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies "
        "of this license document, but changing it is not allowed.",
    ]


def _creative_commons() -> dict[str, list[str]]:
    names = {
        "BY": "Attribution",
        "BY-SA": "Attribution-ShareAlike",
        "BY-NC": "Attribution-NonCommercial",
        "BY-ND": "Attribution-NoDerivatives",
        "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
        "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
    }
    made = {}
    for short, name in names.items():
        for version, law in (("1.0", "Generic"), ("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
            made[f"CC-{short}-{version}"] = [
                f"Licensed under CC {short} {version}.",
                f"This work is licensed under a Creative Commons {name} {version} {law} License.",
                f"This work is licensed under the Creative Commons {name} {version} {law} License. To view a copy of this "
                f"license, visit http://creativecommons.org/licenses/{short.lower()}/{version}/",
            ]
    return made


#: Notices by licence. Fixed values. Of the long licences the head of the full text stands for it.
TEMPLATES = _creative_commons() | {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
        "KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION 1. Definitions.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ],
    "GPL-3.0": _gnu("GNU General Public License", "3", title="Version 3, 29 June 2007 Copyright (C) 2007"),
    "GPL-2.0": _gnu("GNU General Public License", "2", title="Version 2, June 1991 Copyright (C) 1989, 1991"),
    "GPL-1.0": _gnu("GNU General Public License", "1", title="Version 1, February 1989 Copyright (C) 1989"),
    "LGPL-3.0": _gnu(
        "GNU Lesser General Public License", "3", title="Version 3, 29 June 2007 Copyright (C) 2007", this="This library"
    ),
    "LGPL-2.1": _gnu(
        "GNU Lesser General Public License", "2.1", title="Version 2.1, February 1999 Copyright (C) 1991, 1999",
        this="This library",
    ),
    "LGPL-2.0": _gnu(
        "GNU Library General Public License", "2", title="Version 2, June 1991 Copyright (C) 1991", this="This library"
    ),
    "AGPL-3.0": _gnu("GNU Affero General Public License", "3", title="Version 3, 19 November 2007 Copyright (C) 2007"),
    "ISC": [
        "Released under the ISC License.",
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "BSD-2-Clause": [
        "Released under the 2-Clause BSD License.", "Licensed under the BSD 2-Clause License.", _BSD_TWO + _BSD_END,
    ],
    "BSD-4-Clause": [
        "Released under the 4-Clause BSD License.", "Licensed under the BSD 4-Clause License.",
        _BSD_TWO + _BSD_FOUR + _BSD_END, _BSD_TWO + _BSD_FOUR,
    ],
    "BSD-3-Clause": [
        "Released under the 3-Clause BSD License.", "Licensed under the BSD 3-Clause License.",
        _BSD_TWO + _BSD_THREE + _BSD_END, _BSD_TWO + _BSD_THREE,
    ],
    "Apache-1.1": ["Licensed under the Apache License, Version 1.1.", "Licensed under the Apache Software License, Version 1.1."],
    "MPL-1.1": [
        "Licensed under the Mozilla Public License, version 1.1.",
        'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use '
        "this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.mozilla.org/MPL/",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity "
        "that creates, contributes to the creation of, or owns Covered Software.",
    ],
    "CC0-1.0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright."],
}

TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
BLANK = re.compile(r"\n[ \t\x0b\x0c\r]*\n")

FOUND = "array<struct<license:string,dice:double,unit:string,number:int>>"


def terms(text: str) -> list[str]:
    """Words in lower case without punctuation; versions keep their points."""
    return TERM.findall(text.lower())


def bigrams(words: list[str]) -> Counter:
    """Bigrams with their counts; a single word is one."""
    return Counter(zip(words, words[1:], strict=False)) if len(words) > 1 else Counter([tuple(words)] if words else [])


class Templates:
    """Templates sorted by size."""

    def __init__(self, notices: dict[str, list[str]], least: float):
        made = sorted(
            ((bigrams(terms(text)), name) for name, texts in notices.items() for text in texts),
            key=lambda t: (t[0].total(), t[1]),
        )
        self.items, self.least = made, least
        self.sizes = [grams.total() for grams, _ in made]
        ratio = least / (2 - least)
        self.smallest, self.largest = (self.sizes[0] * ratio, self.sizes[-1] / ratio) if made else (1, 0)
        self.ratio = ratio
        #: Numbers of the templates that hold a bigram.
        self.holders: dict[tuple, list[int]] = {}
        for number, (grams, _) in enumerate(made):
            for gram in grams:
                self.holders.setdefault(gram, []).append(number)

    def best(self, words: list[str]) -> tuple[str, float] | None:
        """The most similar template of a similarity of ``least`` or more; ties to the first by size and name."""
        size = max(1, len(words) - 1) if words else 0
        if not self.smallest <= size <= self.largest:
            return None
        pairs = list(zip(words, words[1:], strict=False)) or [tuple(words)]
        if sum(pair in self.holders for pair in pairs) < size * self.ratio - 1e-9:  # each must hold that share of the other
            return None
        low = bisect_left(self.sizes, size * self.ratio - 1e-9)
        high = bisect_right(self.sizes, size / self.ratio + 1e-9)
        grams, found = bigrams(words), None
        for template, name in self.items[low:high]:
            dice = 2 * (grams & template).total() / (size + template.total())
            if dice >= self.least - 1e-12 and (found is None or dice > found[1]):
                found = (name, dice)
        return found


    def windows(self, words: list[str]) -> list[tuple[str, float, int, int]]:
        """(license, dice, start, end) of windows of words, in order, that resemble a template.

        Of windows that overlap the most similar stays, then the longest. From each bigram
        of a template the windows up to the largest size are counted one bigram after the
        other; a start is left out if not enough bigrams of the template follow.
        """
        pairs = list(zip(words, words[1:], strict=False))
        places: dict[int, list[int]] = {}
        for at, pair in enumerate(pairs):
            for number in self.holders.get(pair, ()):
                places.setdefault(number, []).append(at)
        found = []
        for number, held in places.items():
            template, name = self.items[number]
            size = template.total()
            need, most = math.ceil(size * self.ratio - 1e-9), size / self.ratio + 1e-9
            for first in range(len(held) - need + 1):
                start = held[first]
                if held[first + need - 1] - start + 1 > most:
                    continue
                used, common, best = Counter(), 0, (0.0, 0)
                for at in held[first:first + math.ceil(most) + 1]:
                    width = at - start + 1
                    if width > most:
                        break
                    if used[pairs[at]] < template[pairs[at]]:
                        used[pairs[at]] += 1
                        common += 1
                        best = max(best, (2 * common / (width + size), width))
                if best[0] >= self.least - 1e-12:
                    found.append((-best[0], -best[1], start, name))
        chosen: list[tuple[int, int, str, float]] = []
        for dice, width, start, name in sorted(found):
            end = start - width + 1
            at = bisect_left(chosen, (start,))
            if (at == len(chosen) or chosen[at][0] >= end) and (at == 0 or chosen[at - 1][1] <= start):
                chosen.insert(at, (start, end, name, -dice))
        return [(name, dice, start, end) for start, end, name, dice in chosen]


def units(text: str):
    """(kind, number, text) of lines, of paragraphs of several lines, and of the whole text if it is one paragraph's multiple."""
    lines = text.split("\n")
    yield from (("line", n, line) for n, line in enumerate(lines))
    paragraphs = BLANK.split(text)
    if len(lines) > 1:
        yield from (("paragraph", n, p) for n, p in enumerate(paragraphs) if "\n" in p)
    if len(paragraphs) > 1:
        yield "text", 0, text


def scan_text(text: str | None, templates: Templates) -> list[tuple[str, float, str, int]]:
    """All units of a text that resemble a template; null and empty texts have none."""
    found = []
    for kind, number, part in units(text or ""):
        hit = templates.best(terms(part))
        if hit:
            found.append((*hit, kind, number))
    return found


def scan_everywhere(text: str | None, templates: Templates) -> list[tuple[str, float, str, int]]:
    """``scan_text`` and the windows in no unit found that says the same or resembles its template as much.

    A window's number is that of its first word. ``rem`` and ``dnl`` before a line are
    comment marks to windows.
    """
    if not text:
        return []
    lines = [terms(line) for line in text.split("\n")]
    bare = [line[1:] if line[:1] in (["rem"], ["dnl"]) else line for line in lines]
    starts = [0, *accumulate(map(len, bare))]
    found, spans = [], []

    def unit(kind, number, first, last):
        hit = templates.best([w for line in lines[first:last] for w in line])
        if hit:
            found.append((*hit, kind, number))
            spans.append((starts[first], starts[last], *hit))

    for number in range(len(lines)):
        unit("line", number, number, number + 1)
    paragraphs, first = BLANK.split(text), 0
    for number, paragraph in enumerate(paragraphs):
        last = first + paragraph.count("\n") + 1
        if last - first > 1:
            unit("paragraph", number, first, last)
        first = last + 1
    if len(paragraphs) > 1:
        unit("text", 0, 0, len(lines))
    for name, dice, start, end in templates.windows([w for line in bare for w in line]):
        if not any(a < end and start < b and (n == name or d >= dice - 1e-12) for a, b, n, d in spans):
            found.append((name, dice, "window", start))
    return found


def scan(text: Column, *, notices: dict[str, list[str]] = TEMPLATES, least: float = 0.8, everywhere: bool = False) -> Column:
    """The licence notices of a text, as ``FOUND``: in order of lines, then paragraphs, then the whole.

    Whole texts are read. Each unit has its best template if their similarity is ``least``
    or more. ``everywhere`` adds windows of words, after the units, so that notices inside
    longer lines and blocks are found. A row's result depends on its text alone, so repeated
    rows agree.
    """

    look = scan_everywhere if everywhere else scan_text

    @F.pandas_udf(FOUND)
    def of(texts: pd.Series) -> pd.Series:
        templates = Templates(notices, least)
        return texts.map(
            lambda t: [
                {"license": name, "dice": dice, "unit": kind, "number": number}
                for name, dice, kind, number in look(t, templates)
            ]
        )

    return of(text)
