"""License scan by conditional compression.

A document's words, lower-cased and joined by single spaces, are cut into overlapping blocks of ``BLOCK`` words, all of them.
Each block is compressed by zstandard alone and with all wordings as one raw dictionary; those that shrink by ``JOINT`` bytes
or more are candidates. A candidate is compressed with each wording as a raw dictionary of its own, and the wordings that
shrink it by their threshold (a share of what they save on themselves) are ranked by that reduction. Every one of them is then
compared word by word with the text round the block, and confirmed by the exact differences: no license name, no negation and
no version number may be among them, a short wording may differ by one word spelt otherwise or one linking word, a long one by
``tolerance`` of its words. A negation right before the wording refuses it too. Of confirmed stretches that overlap, the one
stands whose reduction is greatest, then the one with fewer differing words. Wordings that several licenses begin with name
them all: such a finding is undecided between them.

Defined results: NULL counts as empty text; a text without candidates has no finding; repeated rows are scanned one by one; a
text of any length is scanned whole, a word without end is a block that is compressed whole; equal stretches of a document
are one finding; NULL ids are kept; an empty table gives no rows; further columns, whatever their names, are left out.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import slices, whole

# Wordings of published licenses and their usual notices.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_PERMISSION = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
_REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:"
)
_TWO_CLAUSES = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution."
)
_THIRD_CLAUSE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, "
    "STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
    "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
    'shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY '
    "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
    "THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_FREE = (
    "{} is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as "
    "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
_FREE_OPENING = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License "
    "as published by the Free Software Foundation"
)
_GNU = "This work is licensed under the GNU {}General Public License, version {}."
TEMPLATES = {
    "0BSD": [f"{_PERMISSION}. {_AS_IS}"],
    "0BSD OR ISC": [_PERMISSION],
    "AGPL-3.0": [_GNU.format("Affero ", "3")],
    "AGPL-3.0-or-later": [_FREE.format("This program", "Affero ", "3"), _FREE_OPENING.format("Affero ")],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache-2.0 license.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ],
    "BSD-2-Clause": [f"{_REDISTRIBUTION} {_TWO_CLAUSES} {_BSD_DISCLAIMER}"],
    "BSD-2-Clause OR BSD-3-Clause": [_REDISTRIBUTION],
    "BSD-3-Clause": [f"{_REDISTRIBUTION} {_TWO_CLAUSES} {_THIRD_CLAUSE} {_BSD_DISCLAIMER}"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "GPL-2.0": [_GNU.format("", "2")],
    "GPL-2.0-or-later": [_FREE.format("This program", "", "2")],
    "GPL-2.0-or-later OR GPL-3.0-or-later": [_FREE_OPENING.format("")],
    "GPL-3.0": [_GNU.format("", "3")],
    "GPL-3.0-or-later": [_FREE.format("This program", "", "3")],
    "ISC": [f"{_PERMISSION}, provided that the above copyright notice and this permission notice appear in all copies. {_AS_IS}"],
    "LGPL-2.1": [_GNU.format("Lesser ", "2.1")],
    "LGPL-2.1-or-later": [_FREE.format("This library", "Lesser ", "2.1")],
    "LGPL-2.1-or-later OR LGPL-3.0-or-later": [_FREE_OPENING.format("Lesser ")],
    "LGPL-3.0": [_GNU.format("Lesser ", "3")],
    "LGPL-3.0-or-later": [_FREE.format("This program", "Lesser ", "3")],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", _MIT.partition(" (the")[0], _MIT],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
# Words by which licenses are told apart, and words that turn a grant round.
NAMES = set(
    "affero agpl apache artistic attribution boost bsd by cc cddl commercial eclipse epl general gnu gpl isc lesser lgpl library "
    "mit mozilla mpl nc nd noncommercial proprietary public sa unlicense x11 zlib".split()
)
NEGATIONS = set("cannot don't except formerly isn't never no non nor not nowhere without unless".split())
#: Words that may be lacking or added, one of them, in a short wording.
LINKING = {"a", "an", "the", "this", "is", "are", "of", "under", "terms", "to", "and", "or"}
LEVEL = 12
TOKEN = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
SPELLING = 0.75
#: Words of a block (each begins half a block after the one before) and of a short wording.
BLOCK, SHORT = 24, 20
#: Bytes that all wordings together must save on a candidate, and the share of its own best, or of the best that a block of
#: words can save, by which one wording must.
JOINT, SHARE = 5, 0.3
#: Words before a wording among which no negation may be.
BEFORE = 3


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def spans(have: list[str], want: list[str], most: int) -> list[tuple[int, int, int]]:
    """(differing words, start, end) of the stretches that differ from ``want`` by at most ``most`` words, the best
    start for every end."""
    cost, start = list(range(len(want) + 1)), [0] * (len(want) + 1)
    found, wanted_words = [], set(want)
    for at, word in enumerate(have):
        up, up_start = cost[0], start[0]
        start[0] = at + 1
        for i, wanted in enumerate(want, 1):
            old, old_start = cost[i], start[i]
            if word == wanted:
                cost[i], start[i] = up, up_start if i > 1 else at
            elif cost[i - 1] + 1 <= old + 1:
                cost[i], start[i] = cost[i - 1] + 1, start[i - 1]
            else:
                cost[i] = old + 1
            up, up_start = old, old_start
        if word in wanted_words and cost[-1] <= most:
            found.append((cost[-1], start[-1], at + 1))
    return found


def trimmed(have: list[str], want: list[str], start: int, end: int) -> tuple[int, int]:
    """The stretch without the words before the first and after the last that it shares with ``want``."""
    same = [m for m in SequenceMatcher(None, have[start:end], want, autojunk=False).get_matching_blocks() if m.size]
    return (start + same[0].a, start + same[-1].a + same[-1].size) if same else (start, end)


def alike(a: str, b: str) -> bool:
    return SequenceMatcher(None, a, b, autojunk=False).ratio() >= SPELLING


def one_word(missing: list[str], extra: list[str]) -> bool:
    """Whether the difference is one word spelt otherwise, or one linking word."""
    if len(missing) == len(extra) == 1:
        return alike(missing[0], extra[0])
    return len(missing) + len(extra) == 1 and LINKING.issuperset(missing + extra)


def differences(block: str, template: str) -> tuple[list[str], list[str]]:
    """Words of the template that the block lacks, and words that it has in between."""
    return differing_words(tokens(block), tokens(template))


def differing_words(have: list[str], want: list[str]) -> tuple[list[str], list[str]]:
    same = [m for m in SequenceMatcher(None, have, want, autojunk=False).get_matching_blocks() if m.size]
    if not same:
        return want, []
    kept = {i for m in same for i in range(m.b, m.b + m.size)}
    inside = {i for m in same for i in range(m.a, m.a + m.size)}
    between = range(same[0].a, same[-1].a + same[-1].size)
    return [w for i, w in enumerate(want) if i not in kept], [have[i] for i in between if i not in inside]


class Wording:
    def __init__(self, license: str, text: str, tolerance: float, scanner: Scanner):
        self.license, self.words = license, tokens(text)
        self.numbers = any(w[0].isdigit() for w in self.words) and len(self.words) < 3 * SHORT
        self.short = len(self.words) < SHORT
        self.allowed = 2 if self.short else int(tolerance * len(self.words))
        plain = " ".join(self.words).encode()
        self.given = scanner.compressor(plain)
        self.most = scanner.saving(self.given, plain)
        first = " ".join(self.words[:BLOCK]).encode()
        self.least = SHARE * min(self.most, scanner.saving(self.given, first))

    def explains(self, missing: list[str], extra: list[str]) -> bool:
        """Whether a stretch with these differing words is still this wording."""
        for word in (*missing, *extra):
            if word in NAMES or word in NEGATIONS or self.numbers and word[0].isdigit():
                return False
        if self.short:
            return not missing + extra or one_word(missing, extra)
        return len(missing) + len(extra) <= self.allowed or one_word(missing, extra)

    def confirmed(self, have: list[str], first: int, last: int) -> list[tuple]:
        """(differing words, start, end, missing, extra) of the stretches within have[first:last] that are this wording."""
        found = []
        for _, start, end in spans(have[first:last], self.words, self.allowed):
            start, end = trimmed(have, self.words, first + start, first + end)
            missing, extra = differing_words(have[start:end], self.words)
            if not extra and missing == self.words[-1:] and end < len(have) and alike(missing[0], have[end]):
                extra, end = [have[end]], end + 1
            elif not extra and missing == self.words[:1] and start and alike(missing[0], have[start - 1]):
                extra, start = [have[start - 1]], start - 1
            if self.explains(missing, extra) and NEGATIONS.isdisjoint(have[max(0, start - BEFORE) : start]):
                found.append((len(missing) + len(extra), start, end, tuple(missing), tuple(extra)))
        return found


class Scanner:
    def __init__(self, templates: dict[str, list[str]], tolerance: float):
        import zstandard

        self.zstd = zstandard
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.wordings = [Wording(name, text, tolerance, self) for name, texts in sorted(templates.items()) for text in texts]
        distinct = sorted({" ".join(w.words) for w in self.wordings}, key=len)
        # A wording that another one holds adds nothing to the joint dictionary.
        joint = [t for n, t in enumerate(distinct) if not any(t in longer for longer in distinct[n + 1 :])]
        self.joint = self.compressor(" ".join(joint).encode())

    def compressor(self, dictionary: bytes):
        raw = self.zstd.ZstdCompressionDict(dictionary, dict_type=self.zstd.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=LEVEL)
        return self.zstd.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False)

    def saving(self, given, block: bytes) -> int:
        return len(self.plain.compress(block)) - len(given.compress(block))

    def candidates(self, words: list[str]) -> list[tuple[int, int]]:
        """The blocks that the wordings together shrink."""
        found = []
        plain, joint = self.plain.compress, self.joint.compress
        for first in range(0, max(1, len(words) - BLOCK // 2), BLOCK // 2):
            block = " ".join(words[first : first + BLOCK]).encode("utf-8", "surrogatepass")
            if len(plain(block)) - len(joint(block)) >= JOINT:
                found.append((first, min(len(words), first + BLOCK)))
        return found

    def ranked(self, words: list[str], block: tuple[int, int]) -> list[tuple[int, int]]:
        """(bytes saved, wording) of those that shrink a candidate enough, the greatest reduction first."""
        text = " ".join(words[slice(*block)]).encode("utf-8", "surrogatepass")
        size = len(self.plain.compress(text))
        saved = [(size - len(w.given.compress(text)), n) for n, w in enumerate(self.wordings)]
        return sorted((s for s in saved if s[0] >= self.wordings[s[1]].least), key=lambda s: (-s[0], s[1]))

    def places(self, words: list[str], blocks: list[tuple[int, int]]) -> dict[int, list[list[int]]]:
        """Of each wording the regions in which it is looked for: round the blocks that it shrinks, joined where they meet."""
        found: dict[int, list[list[int]]] = {}
        for block in blocks:
            for _, n in self.ranked(words, block):
                reach = len(self.wordings[n].words) + self.wordings[n].allowed
                first, last = max(0, block[0] - reach), min(len(words), block[1] + reach)
                regions = found.setdefault(n, [])
                if regions and regions[-1][1] >= first:
                    regions[-1][1] = last
                else:
                    regions.append([first, last])
        return found

    def scan(self, text: bytes) -> tuple[int, list[tuple]]:
        """Number of candidates, and (license, block, share saved, missing, extra) of every stretch that a wording
        explains, by place."""
        whole_text = text.decode("utf-8", "ignore")
        words = tokens(whole_text)
        blocks = self.candidates(words) if words else []
        regions = self.places(words, blocks) if blocks else {}
        return len(blocks), self.findings(whole_text, words, regions)

    def findings(self, whole_text: str, words: list[str], regions: dict[int, list[list[int]]]) -> list[tuple]:
        options = set()
        for n, places in regions.items():
            for first, last in places:
                for differing, start, end, missing, extra in self.wordings[n].confirmed(words, first, last):
                    saved = self.saving(self.wordings[n].given, " ".join(words[start:end]).encode("utf-8", "surrogatepass"))
                    options.add((-saved, differing, self.wordings[n].license, n, start, end, missing, extra))
        if not options:
            return []
        # A few letters are cut otherwise when lower-cased; such a text is quoted in lower case.
        at = [m.span() for m in TOKEN.finditer(whole_text)]
        if len(at) != len(words):
            whole_text = whole_text.lower()
            at = [m.span() for m in TOKEN.finditer(whole_text)]
        taken, found = set(), []
        for saved, _, license, n, start, end, missing, extra in sorted(options):
            if taken.isdisjoint(range(start, end)):
                taken.update(range(start, end))
                block = whole_text[at[start][0] : at[end - 1][1]]
                share = -saved / max(1, self.wordings[n].most)
                found.append((start, end, (license, block, share, list(missing), list(extra))))
        once = {}
        for start, end, finding in sorted(found):
            once.setdefault((finding[0], *words[start:end]), finding)
        return list(once.values())


def scan(
    docs: DataFrame,
    templates: dict[str, list[str]] | None = None,
    tolerance: float = 0.1,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """One row per document: id, ``candidates`` (blocks that were compressed with each wording) and ``findings`` (array of
    license, block, share saved of what the wording can save, missing and extra words)."""
    chosen = templates or TEMPLATES
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), whole(F.col(f"`{text_col}`")).cast("binary").alias("text"))
    parts = [("license", pa.string()), ("block", pa.string()), ("saved", pa.float64())]
    kind = pa.list_(pa.struct([*parts, ("missing", pa.list_(pa.string())), ("extra", pa.list_(pa.string()))]))

    def task(batches):
        scanner = Scanner(chosen, tolerance)
        names = ("license", "block", "saved", "missing", "extra")
        for batch in (part for whole_batch in batches for part in slices(whole_batch)):
            scanned = [scanner.scan(t) for t in batch.column("text").to_pylist()]
            tried = [n for n, _ in scanned]
            found = [[dict(zip(names, f, strict=True)) for f in each] for _, each in scanned]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(tried, pa.int32()), pa.array(found, kind)], ["id", "candidates", "findings"]
            )

    id_kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(
        task,
        f"id {id_kind}, candidates int, findings array<struct<license:string,block:string,saved:double,"
        "missing:array<string>,extra:array<string>>>",
    ).withColumnRenamed("id", id_col)
