"""Licence scans: parts of texts against licence templates, by Dice over word bigrams.

The parts are all runs of words, so a notice inside a line and a licence of many
paragraphs inside a document are parts like any other. With a and b bigrams,
2 * min(a, b) / (a + b) bounds the coefficient, so a template is compared only
with runs near its size that hold enough of its bigrams. Of overlapping parts
near different licences, the one that shares more bigrams counts.
"""

from __future__ import annotations

import pkgutil
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

THRESHOLD = 0.8

CC_KINDS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike",
            "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
            "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
            "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
CC_VERSIONS = ("2.0", "2.5", "3.0", "4.0")

#: Short public licence texts and the notices by which texts are put under them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE
SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the
terms of the GNU General Public License as published by the Free Software Foundation, either
version 3 of the License, or (at your option) any later version. This program is distributed in
the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details."""),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v.
2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
http://mozilla.org/MPL/2.0/."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met: 1. Redistributions of
source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list
of conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution."""),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", """This work is licensed under a Creative Commons Attribution 4.0 International
License."""),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related "
                "or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the
terms of the GNU General Public License as published by the Free Software Foundation; either
version 2 of the License, or (at your option) any later version. This program is distributed in
the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details."""),
    ("LGPL-2.1", """This library is free software; you can redistribute it and/or modify it under the
terms of the GNU Lesser General Public License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version. This library is distributed in
the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for
more details."""),
    ("LGPL-3.0", """This library is free software; you can redistribute it and/or modify it under the
terms of the GNU Lesser General Public License as published by the Free Software Foundation; either
version 3 of the License, or (at your option) any later version. This library is distributed in
the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for
more details."""),
    ("AGPL-3.0", """This program is free software: you can redistribute it and/or modify it under the
terms of the GNU Affero General Public License as published by the Free Software Foundation, either
version 3 of the License, or (at your option) any later version. This program is distributed in
the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more
details."""),
    *((f"CC-{kind}-{version}", f"Licensed under CC {kind} {version}.")
      for kind in CC_KINDS for version in CC_VERSIONS),
    *((f"CC-{kind}-{version}", "This work is licensed under a Creative Commons "
       f"{said} {version} {scope} License.")
      for kind, said in CC_KINDS.items() for version in CC_VERSIONS
      for scope in (("International",) if version == "4.0" else ("Unported",))),
)

#: Whole licence texts, in files of these names; README says where they are from.
TEXTS = ("AGPL-3.0", "Apache-2.0", "Artistic-1.0-Perl", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0",
         "GFDL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.0", "LGPL-2.1",
         "LGPL-3.0", "MPL-1.1", "MPL-2.0")

_WORD = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")
_PARAGRAPH = re.compile(r"\n[ \t\r]*\n")


def normalised(text: str) -> list[str]:
    """Lower-case words without marks; spelling variants of 'licence' are one."""
    return [{"licence": "license", "licenced": "licensed", "licences": "licenses"}.get(w, w)
            for w in _WORD.findall(text.lower())]


def all_templates() -> tuple:
    """``TEMPLATES`` and the whole texts, these read from the package, a zipped one too."""
    read = lambda name: pkgutil.get_data(__package__, f"licence_texts/{name}.txt")
    return (*TEMPLATES, *((name, read(name).decode()) for name in TEXTS))


def bigrams(words: list[str]) -> Counter:
    return Counter(zip(words, words[1:]))


def dice(a: Counter, b: Counter) -> float:
    """Twice the common bigrams over all, repeats counted; 0 when there is none."""
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


class Matcher:
    """Templates by bigram, so that a text is compared with those it shares enough with."""

    def __init__(self, templates=None, threshold: float = THRESHOLD):
        self.threshold = threshold
        self.reach = (2 - threshold) / threshold
        self.templates: list[tuple[str, int, dict]] = []  # name, size, place of bigram -> repeats
        self.place: dict[tuple[str, str], int] = {}
        self.held_by: list[list[tuple[int, int]]] = []
        for name, text in templates or all_templates():
            words = normalised(text)
            if len(words) < 2:
                continue
            repeats = {}
            for pair, n in bigrams(words).items():
                at = self.place.setdefault(pair, len(self.place))
                if at == len(self.held_by):
                    self.held_by.append([])
                self.held_by[at].append((len(self.templates), n))
                repeats[at] = n
            self.templates.append((name, len(words) - 1, repeats))
        #: What a part must share with a template at least: the coefficient is near enough only if
        #: 2 * common >= threshold * (a + b), and a is not below b / reach.
        self.needed = [threshold * (size + size / self.reach) / 2 - 1e-9
                       for _, size, _ in self.templates]

    def parts(self, text: str) -> list[tuple]:
        """(common, coefficient, name, first, end) of the best runs for every template, none
        overlapping for one template; first and end are numbers of bigrams."""
        words = normalised(text)
        get = self.place.get
        known = [(at, place) for at, pair in enumerate(zip(words, words[1:]))
                 if (place := get(pair)) is not None]
        if not known:
            return []
        common: dict[int, int] = {}
        for place, n in Counter(place for _, place in known).items():
            for template, most in self.held_by[place]:
                common[template] = common.get(template, 0) + min(n, most)
        found = []
        for template, n in common.items():
            if n >= self.needed[template]:
                name, size, repeats = self.templates[template]
                found += [(c, value, name, first, end)
                          for c, value, first, end in self._runs(
                              known, size, repeats, self.needed[template])]
        return found

    def _runs(self, known: list, size: int, repeats: dict, least: float) -> list[tuple]:
        """The best run of words from each start, then the best of those that overlap.

        A bigram adds to a run if fewer than its repeats in the template stand before it there,
        that is if ``bound``, the place of the one so many before, is left of the start.
        """
        at, bound, seen = [], [], {}
        for place, key in known:
            most = repeats.get(key)
            if most is not None:
                before = seen.setdefault(key, [])
                bound.append(before[-most] if len(before) >= most else -1)
                before.append(len(at))
                at.append(place)
        at, bound = np.array(at), np.array(bound)
        ends = np.searchsorted(at, at + size * self.reach + 1e-9)
        runs = []
        for k in np.flatnonzero(ends - np.arange(len(at)) >= least):
            stop = ends[k]
            common = np.cumsum(bound[k:stop] < k)
            values = 2 * common / (at[k:stop] - at[k] + 1 + size)
            top = int(values.argmax())
            if values[top] >= self.threshold:
                runs.append((int(common[top]), float(values[top]), int(at[k]), int(at[k + top]) + 1))
        kept, taken = [], np.zeros(int(at[-1]) + 1, bool)
        for run in sorted(runs, key=lambda r: (-r[1], -r[0], r[2])):
            if not taken[run[2]:run[3]].any():
                taken[run[2]:run[3]] = True
                kept.append(run)
        return kept

    def scan(self, text: str | None) -> dict[str, float]:
        """licence -> best coefficient over all parts of a text.

        A part most of which belongs to parts that share more bigrams with other licences is
        passed over; licences equally near to the same part all count.
        """
        found = sorted(self.parts(text or ""), key=lambda p: (-p[0], -p[1], p[3], p[2]))
        best: dict[str, float] = {}
        if not found:
            return best
        owner = np.full(max(end for *_, end in found), -1)
        numbers: dict[str, int] = {}
        ties: dict[tuple, tuple] = {}
        for common, value, name, first, end in found:
            number = numbers.setdefault(name, len(numbers))
            here = owner[first:end]
            others = np.count_nonzero((here >= 0) & (here != number))
            if 2 * others > end - first and ties.get((first, end)) != (common, value):
                continue
            here[here < 0] = number
            ties.setdefault((first, end), (common, value))
            best[name] = max(value, best.get(name, 0.0))
        return best


def scan(docs: DataFrame, templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, licences (sorted, comma-joined), n_licences and the best coefficient of every row.

    Null and empty texts have none, and a coefficient of 0. Other columns are
    ignored; each row is judged alone.
    """
    templates = templates or all_templates()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates, threshold)
        for batch in batches:
            found = [matcher.scan(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([",".join(sorted(f)) for f in found], pa.string()),
                 pa.array([len(f) for f in found], pa.int64()),
                 pa.array([max(f.values(), default=0.0) for f in found], pa.float64())],
                names=["doc_id", "licences", "n_licences", "best_dice"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, licences string, n_licences long, best_dice double")
