"""License scans: exact set-similarity join of text blocks with license templates.

A block is any run of consecutive words of a text, SLACK times as many as the template has, wherever lines end: a window
that slides over the whole text word by word. As sets of words, a block meets a template if it holds at least CONTAINMENT
of the template's words; `find` finds every template that some block meets, and the best block's containment.

Words are ordered by the number of documents that hold them, over all documents, rarest first. Words that no template
holds can't be common to both sides, so blocks are ordered sets of the templates' words. Per template T of which `need`
words are wanted:

- prefix filter: a block that meets T holds one of T's first |T| - need + 1 words. Only windows around places of such words
  are looked at;
- length filter: these windows together must have `need` words of templates;
- positional filter: if the prefix word is the block's first common word, at place i of T and j of the block, no more than
  1 + min(|T| - i - 1, |B| - j - 1) words are common; that must reach `need`.

What passes is verified by counting the distinct common words of every window in one sweep. Templates are few and fixed, so
the join needs no shuffle: their index rides along with the scan. Only the templates' words are counted, so the counts that
reach the driver are bounded by the templates, not by the corpus.

Nulls and empty texts: no words, no labels, score 0. Ties in frequency are broken by the word. Repeated rows give one row
each; an empty table gives an empty result; columns other than doc_id and text are ignored. Texts are read whole; the work
grows with a text's words and the places of prefix words in it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loopweaver.llm.common import table

CONTAINMENT = 0.9
#: Words of a block for each word of the template.
SLACK = 1.25

# Phrases that name a license by themselves.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Notices and texts of common licenses, as their publishers state them.
TEMPLATES = {
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-terms": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "lgpl-notice": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0",
    "mit-release": "Released under the MIT License",
    "all-rights-reserved": "Copyright All rights reserved",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
        "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "bsd-2-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "bsd-3-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
        "the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "This notice may not be removed or altered from any source distribution."
    ),
    "gpl-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be "
        "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details. You should have received a copy of the GNU General Public License along with this program."
    ),
    "apache-2.0-text": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy "
        "of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License."
    ),
}

#: Lower-cases A-Z; bytes of no word become blanks.
_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def fold(text: str | None) -> bytes:
    return (text or "").encode().translate(_FOLD)


def words(text: str | None) -> list[bytes]:
    return fold(text).split()


class Index:
    """Templates under a global order of words, with the filters of the join."""

    def __init__(self, counts: dict[bytes, int], templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT, slack: float = SLACK):
        texts = {k: words(t) for k, t in templates.items()}
        #: Rank of each word of the templates, rarest first.
        self.rank = {w: i for i, w in enumerate(sorted({w for t in texts.values() for w in t}, key=lambda w: (counts.get(w, 0), w)))}
        self.sets = {k: sorted({self.rank[w] for w in t}) for k, t in texts.items() if t}
        self.need = {k: max(1, math.ceil(containment * len(s) - 1e-9)) for k, s in self.sets.items()}
        self.window = {k: math.ceil(slack * len(texts[k])) for k in self.sets}
        #: Templates whose prefix holds each word, with the word's place.
        self.prefix: dict[int, list[tuple[str, int]]] = {}
        for k, s in self.sets.items():
            for at, r in enumerate(s[: len(s) - self.need[k] + 1]):
                self.prefix.setdefault(r, []).append((k, at))
        self.rare = {w for w, r in self.rank.items() if r in self.prefix}
        self.member = {k: np.isin(np.arange(len(self.rank)), s) for k, s in self.sets.items()}
        #: Pairs of a template and a place that came as far as each filter, and that were verified.
        self.seen: Counter = Counter()

    def candidates(self, at: np.ndarray, rank: np.ndarray) -> set[str]:
        """Templates that some place of a prefix word leaves possible. at, rank: places and ranks of templates' words."""
        out: set[str] = set()
        for i in np.flatnonzero(np.isin(rank, list(self.prefix))).tolist():
            r = int(rank[i])
            for k, place in self.prefix[r]:
                if k in out:
                    continue
                need, reach = self.need[k], self.window[k]
                self.seen["prefix"] += 1
                lo, hi = np.searchsorted(at, [at[i] - reach + 1, at[i] + reach])
                if hi - lo < need:
                    continue
                self.seen["length"] += 1
                block = np.unique(rank[lo:hi])
                if 1 + min(len(self.sets[k]) - place - 1, len(block) - int(np.searchsorted(block, r)) - 1) < need:
                    continue
                self.seen["position"] += 1
                out.add(k)
        return out

    def best(self, k: str, at: np.ndarray, rank: np.ndarray) -> int:
        """Most distinct words of a template that one window of a text holds."""
        mine = self.member[k][rank]
        q, r = at[mine], rank[mine]
        if not len(q):
            return 0
        order = np.lexsort((q, r))
        before = np.full(len(q), -(1 << 62))
        same = r[order[1:]] == r[order[:-1]]
        before[order[1:][same]] = q[order[:-1][same]]
        # A word's place counts for the windows that start after its place before, and within reach.
        start, stop = np.maximum(before, q - self.window[k]) + 1, q + 1
        steps = np.concatenate([start, stop])
        change = np.repeat([1, -1], len(q))
        order = np.lexsort((change, steps))  # at equal places ends come first
        return int(np.cumsum(change[order]).max())


def find(index: Index, ws: list[bytes]) -> dict[str, float]:
    """Best containment of each template that some block of the text meets."""
    out: dict[str, float] = {}
    if index.rare.isdisjoint(ws):
        return out
    rank = np.fromiter((index.rank.get(w, -1) for w in ws), np.int64, len(ws))
    at = np.flatnonzero(rank >= 0)
    rank = rank[at]
    for k in index.candidates(at, rank):
        common = index.best(k, at, rank)
        if common >= index.need[k]:
            index.seen["met"] += 1
            out[k] = common / len(index.sets[k])
    return out


_PHRASES = [(tuple(p.encode().split()), label) for p, label in PHRASES.items()]


def places(folded: bytes, ws: list[bytes]) -> list[tuple[int, str]]:
    """Word positions where a phrase stands, and its label."""
    out = []
    for phrase, label in _PHRASES:
        if all(w in folded for w in phrase):
            at = -1
            try:
                while True:
                    at = ws.index(phrase[0], at + 1)
                    if tuple(ws[at : at + len(phrase)]) == phrase:
                        out.append((at, label))
            except ValueError:
                pass
    return sorted(out)


def word_counts(documents: DataFrame, templates: dict[str, str] = TEMPLATES) -> dict[bytes, int]:
    """Documents, of all, that hold each word of the templates: one row for each word and partition is shuffled."""
    wanted = {w for t in templates.values() for w in words(t)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                seen.update(wanted.intersection(words(t.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    rows = documents.select("text").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n")).collect()
    return {bytes(r[0]): r[1] for r in rows}


def scan(documents: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT, slack: float = SLACK) -> DataFrame:
    """Phrases and templates found in each whole text. score: 1 with a phrase, else the best template's containment."""
    index = Index(word_counts(documents, templates), templates, containment, slack)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column(1):
                folded = fold(t.as_py())
                ws = folded.split()
                base, more = places(folded, ws), find(index, ws)
                names = {x for _, x in base}
                out.append((len(ws), len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted(names)), ",".join(sorted(names | more.keys())), 1.0 if base else max(more.values(), default=0.0)))
            cols = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, cols, kinds)], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
