"""License notices by conditional compression.

Candidate blocks are the stretches of a text around words that license notices use: from
``BEFORE`` characters before such a word to ``AFTER`` behind it, stretches that meet joined, each
``STEP`` characters of a longer one a block with the next one's first ``AFTER`` characters. A block is
compressed alone and with each template as a raw zstandard dictionary, case and white space made
equal before; the share of bytes that a template saves ranks the templates. A template that saves at least ``SAVES`` is confirmed by wording:
its words are aligned with the block's words, and it is found if at most ``MISSING`` of its words
have no match and no more than that are put in between. A version number or a family word
(``FAMILY``) that is missing, and a family word put in, rule a template out at that place, whatever
the share: another version or member of the family is another license. Several templates of one block may be
confirmed; one whose matched words lie inside those of a better confirmed one is dropped.

Templates are short public notices, of which there is a fixed number: Apache 1.1 and 2.0, MIT, ISC,
BSD by its clauses, GPL 2 and 3, LGPL 2, 2.1 and 3, AGPL 3, MPL 1.1 and 2.0, EPL 1.0 and 2.0, CC0,
Unlicense and the six Creative Commons licenses in versions 1.0 to 4.0. Other licenses are not found. zstandard is quick to
train on none of them, a dictionary being the template's own bytes.

A null or empty text has no blocks and no rows. Repeated rows give repeated results. A null id
is returned as null. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame

from panelloom.llm.common import column, per_chunk, texts

# Wording of common license notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:"
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "apache-1.1": "Licensed under the Apache License, Version 1.1.",
    "mit-warranty": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "isc-warranty": (
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "bsd-source-clause": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."
    ),
    "bsd-binary-clause": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "bsd-name-clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
    "bsd-advertising-clause": (
        "All advertising materials mentioning features or use of this software must display the following acknowledgement:"
    ),
    "bsd-warranty": (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
        "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING "
        "IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "mpl-1.1": (
        'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use '
        "this file except in compliance with the License."
    ),
    "epl-1.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 "
        "which accompanies this distribution"
    ),
    "epl-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at"
    ),
    "cc0-1.0": "Licensed under CC0 1.0.",
    "cc0-1.0-notice": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
        "to this software to the public domain worldwide. This software is distributed without any warranty."
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
}
for _name, _kind, _thing, _version in (
    ("gpl-2.0", "", "program", "2"),
    ("lgpl-2.0", "Library ", "library", "2"),
    ("lgpl-2.1", "Lesser ", "library", "2.1"),
    ("lgpl-3.0", "Lesser ", "program", "3"),
    ("agpl-3.0", "Affero ", "program", "3"),
):
    TEMPLATES[_name] = f"This work is licensed under the GNU {_kind}General Public License, version {_version}."
    TEMPLATES[_name + "-notice"] = (
        f"This {_thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {_kind}General "
        f"Public License as published by the Free Software Foundation, either version {_version} of the License, or (at your "
        "option) any later version."
    )
for _short, _long in (
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
):
    for _version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        _name = f"cc-{_short.lower()}-{_version}"
        TEMPLATES[_name] = f"Licensed under CC {_short} {_version}."
        TEMPLATES[_name + "-notice"] = f"This work is licensed under a Creative Commons {_long} {_version} International License."
# Words that tell members of a family, and families, apart; in joined words any part does.
FAMILY = frozenset(
    "lesser library affero nc sa nd noncommercial sharealike noderivatives noderivs attribution cc cc0 gpl lgpl agpl mpl epl "
    "apache mit isc bsd gnu mozilla eclipse".split()
)
VERSION = re.compile(r"v?(\d{1,2}(?:\.\d+)*)")
CUES = re.compile(
    r"(?i:licen[sc]e|permission is hereby|permission to use|redistribut|free software|all rights reserved|is provided|warrant|liable"
    r"|public domain|accompanying materials|advertising materials|neither the name|unencumbered)"
)
QUICK = (
    "licens", "licenc", "permission", "redistribut", "free software", "rights reserved", "is provided", "warrant", "liable",
    "public domain", "accompanying materials", "advertising materials", "neither the name", "unencumbered",
)
BEFORE, AFTER, STEP = 200, 900, 4000
SAVES = 0.04
MISSING = 0.15
WORD = re.compile(r"[^\W_]+(?:[.\-'][^\W_]+)*")
LEVEL = 9
FORM = (
    "doc_id long, license string, start long, end long, saved_share double, rank int, n_matched int, n_missing int, "
    "n_extra int, wording_exact boolean"
)


def blocks(text: str) -> list[tuple[int, int]]:
    """Candidate stretches, as code points."""
    low = text.lower()
    if not any(q in low for q in QUICK):
        return []
    out: list[list[int]] = []
    for m in CUES.finditer(text):
        start, end = max(0, m.start() - BEFORE), min(len(text), m.end() + AFTER)
        if out and start <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [
        (at, min(end, at + STEP + AFTER))
        for start, end in out
        for at in (range(start, max(start + 1, end - AFTER), STEP) if end - start > STEP + AFTER else [start])
    ]


def words(text: str) -> list[tuple[str, int, int]]:
    return [(m[0].lower(), m.start(), m.end()) for m in WORD.finditer(text)]


def level(text: str) -> bytes:
    """What is compressed: small letters, single blanks."""
    return " ".join(text.lower().split()).encode()


def telling(run: list[str]) -> tuple[Counter, Counter]:
    """Version numbers, without trailing zeros, and family words of a run of words."""
    numbers = (VERSION.fullmatch(w) for w in run)
    versions = Counter(re.sub(r"(\.0+)+$", "", m[1]) for m in numbers if m)
    return versions, Counter(w if w in FAMILY else f for w in run for f in ({w} | set(re.split("[.'-]", w))) & FAMILY)


class Matcher:
    """Compressors and words of all templates."""

    def __init__(self, templates: dict[str, str] = TEMPLATES):
        import zstandard

        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.names = list(templates)
        self.words = {n: [w for w, _, _ in words(t)] for n, t in templates.items()}
        raw = zstandard.DICT_TYPE_RAWCONTENT
        self.given = {
            n: zstandard.ZstdCompressor(
                level=LEVEL, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(level(t), dict_type=raw)
            )
            for n, t in templates.items()
        }

    def ranked(self, block: str) -> list[tuple[float, str]]:
        """Share of the block's compressed size that each template saves, of the template's own at most; best first."""
        data = level(block)
        alone = len(self.plain.compress(data))
        saved = [((alone - len(self.given[n].compress(data))), n) for n in self.names]
        own = {n: min(alone, len(" ".join(self.words[n]))) for n in self.names}
        return sorted(((s / max(1, own[n]), n) for s, n in saved), key=lambda x: (-x[0], x[1]))

    def wording(self, name: str, found: list[tuple[str, int, int]]) -> tuple[tuple[int, int, int, int, int] | None, int, int] | None:
        """Start, end, matched, missing and extra words of the closest run of a template's words, if it is confirmed.

        After it the place of the longest common run; nothing at all where no run is long enough for any confirmed place.
        """
        want, have = self.words[name], [w for w, _, _ in found]
        spare = int(len(want) * MISSING)
        match = SequenceMatcher(None, want, have, autojunk=False)
        anchor = match.find_longest_match(0, len(want), 0, len(have))
        # Missing and extra words cut a confirmed place into at most 2 * spare + 1 runs.
        if not anchor.size or anchor.size * (2 * spare + 1) < len(want) - spare:
            return None
        # The template can reach no further than its own words plus as many again as may be put in.
        room = spare + 1
        low = max(0, anchor.b - anchor.a - room)
        high = min(len(have), anchor.b + len(want) - anchor.a + room)
        there = have[low:high]
        codes = SequenceMatcher(None, want, there, autojunk=False).get_opcodes()
        same = [c for c in codes if c[0] == "equal"]
        first, last = low + same[0][3], low + same[-1][4]
        matched = sum(c[2] - c[1] for c in same)
        missing, extra = len(want) - matched, last - first - matched
        ok = max(missing, extra) <= MISSING * len(want)
        for kind, a, b, c, d in codes:
            if kind == "equal":
                continue
            # Beyond the ends only as many words as the template lacks there are its own.
            c, d = (max(c, d - (b - a)), d) if a == 0 else (c, min(d, c + b - a)) if b == len(want) else (c, d)
            (versions, family), (versions_, family_) = telling(want[a:b]), telling(there[c:d])
            ok = ok and not versions - versions_ and family == family_
        hit = (found[first][1], found[last - 1][2], matched, missing, extra) if ok else None
        return hit, anchor.b, anchor.b + anchor.size

    def find(self, text: str) -> list[tuple]:
        """``license, start, end, saved share, rank, matched, missing, extra, exact`` of confirmed notices."""
        out: list[tuple] = []
        for begin, end in blocks(text):
            block = text[begin:end]
            found = words(block)
            here: list[tuple] = []
            for rank, (share, name) in enumerate(self.ranked(block), 1):
                if share < SAVES:
                    break
                todo = [found]
                while todo:
                    part = todo.pop()
                    near = self.wording(name, part)
                    if near is None:
                        continue
                    hit, first, last = near
                    if hit is None:
                        # Another place may be the right one.
                        todo += [p for p in (part[:first], part[last:]) if p]
                        continue
                    start, stop = hit[0], hit[1]
                    here.append((name, begin + start, begin + stop, share, rank, hit[2], hit[3], hit[4], hit[3] + hit[4] == 0))
                    # The same notice may stand in the block again.
                    todo += [p for p in ([w for w in part if w[2] <= start], [w for w in part if w[1] >= stop]) if p]
            out += here
        # Of notices that overlap the one with more of its words, then fewer differences, stays.
        out = sorted(set(out), key=lambda r: (-r[5], r[6] + r[7], r[4], r[1], r[0]))
        kept: list[tuple] = []
        for row in out:
            if not any(row[1] < k[2] and k[1] < row[2] for k in kept):
                kept.append(row)
        return sorted(kept, key=lambda r: (r[1], r[0]))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each confirmed notice of every whole text."""
    names = [f.split()[0] for f in FORM.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), *[pa.int32()] * 4, pa.bool_()]

    def make():
        matcher = Matcher(templates)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [
                (i, *hit)
                for i, text in zip(column(batch, "doc_id").to_pylist(), column(batch, "text").to_pylist(), strict=True)
                for hit in matcher.find(text)
            ]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

        return work

    return texts(docs, id_col, text_col).mapInArrow(per_chunk(make), FORM)
