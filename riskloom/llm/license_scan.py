"""License scans: phrases where they stand, and templates by an exact set-similarity join.

The join takes every text block (a line, or a paragraph: the lines up to an empty one) that contains a template to the threshold: the share
of the template's distinct tokens that the block has. Tokens are ordered by their frequency over all
documents, rare first. A block that reaches ceil(t * |T|) tokens of T has one of the first
|T| - ceil(t * |T|) + 1 of them (prefix filter); it has that many distinct tokens itself (length
filter); and what can still follow the first common token bounds the overlap (positional filter).
What passes is counted exactly.

Two checks follow the join. A template of few words is no notice if its words are scattered over a block, so they have to stand in a window that
is little longer than the template. And where a block meets a template and another that holds all its words, the more specific one counts if
the block has the words that tell them apart, else the other.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import slices, small_batches, table, tidied

#: Phrase and label pairs (fixed values).
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
#: Notices as they are customarily put into files, and the paragraphs of licence texts, by SPDX name (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0",
    "GPL-3.0": "Released under the GNU General Public License version 3",
    "GPL-2.0": "Released under the GNU General Public License version 2",
    "LGPL": "Released under the GNU Lesser General Public License",
    "LGPL-2.1": "Released under the GNU Lesser General Public License version 2.1",
    "LGPL-3.0": "Released under the GNU Lesser General Public License version 3",
    "AGPL-3.0": "Released under the GNU Affero General Public License version 3",
    "BSD-3-Clause": "Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "MIT-text": "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MIT-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT-warranty": "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software.",
    "BSD-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "BSD-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-warranty": "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "Apache-2.0-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
CONTAINMENT = 0.9
#: Words of a template that has to stand together, and how many others may stand between them.
SHORT, BETWEEN = 12, 2
#: Bytes that part words: ASCII other than letters and digits; A-Z become a-z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_BLOCK = re.compile(rb"\n")


def words(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD).split()


class TemplateIndex:
    """Prefix lists of the templates' tokens under a global frequency order."""

    def __init__(self, frequency: dict[bytes, int], threshold: float = CONTAINMENT):
        sets = {name: frozenset(words(t.encode())) for name, t in TEMPLATES.items()}
        vocab = frozenset().union(*sets.values())
        self.rank = {w: n for n, w in enumerate(sorted(vocab, key=lambda w: (frequency.get(w, 0), w)))}
        self.vocab = vocab
        self.templates = []
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for name, tokens in sorted(sets.items()):
            ordered = sorted(self.rank[w] for w in tokens)
            need = -(-round(threshold * 1000) * len(tokens) // 1000)
            by_rank = {self.rank[w]: w for w in tokens}
            for at, r in enumerate(ordered[: len(ordered) - need + 1]):
                self.prefix.setdefault(by_rank[r], []).append((len(self.templates), at))
            self.templates.append((name, tokens, ordered, need))
        self.by_name = {name: (tokens, need, len(words(TEMPLATES[name].encode()))) for name, tokens, _, need in self.templates}

    def search(self, block: list[bytes]) -> list[tuple[str, float]]:
        """Templates that the block contains to the threshold, with the share of tokens found."""
        have = self.vocab.intersection(block)
        if not have:
            return []
        ranks, seen, out = sorted(self.rank[w] for w in have), set(), []
        for w in sorted(have, key=self.rank.__getitem__):
            for t, at in self.prefix.get(w, ()):
                if t in seen:
                    continue
                seen.add(t)
                name, tokens, ordered, need = self.templates[t]
                if len(have) < need:  # length
                    continue
                if min(len(ordered) - at, len(ranks) - bisect.bisect_left(ranks, ordered[at])) < need:  # position of the first common token
                    continue
                if (common := len(tokens & have)) >= need:
                    out.append((name, common / len(tokens)))
        return out


    def specific(self, block: list[bytes], matches: list[tuple[str, float]]) -> list[tuple[str, float]]:
        """The matches of a block whose words stand together, without those that a more specific one explains."""
        kept = {}
        for name, share in matches:
            tokens, need, length = self.by_name[name]
            if length <= SHORT:
                held = [w if w in tokens else None for w in block]
                n = max(len(set(held[k : k + length + BETWEEN]) - {None}) for k in range(len(held)))
                if n < need:
                    continue
                share = n / len(tokens)
            kept[name] = share
        have, gone = set(block), set()
        for a in kept:
            for b in kept:
                small, large = self.by_name[a][0], self.by_name[b][0]
                if small < large:
                    gone.add(a if large - small <= have else b)
        return [(name, share) for name, share in kept.items() if name not in gone]


def token_frequencies(docs: DataFrame, text_col: str = "text") -> dict[bytes, int]:
    """How often each template token stands in all documents (a result of the templates' size)."""
    vocab = frozenset(w for t in TEMPLATES.values() for w in words(t.encode()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for b in slices(batches):
            for text in b.column(0).to_pylist():
                if text:
                    seen.update(filter(vocab.__contains__, words(text.encode())))
        yield pa.record_batch([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["w", "n"])

    rows = docs.select(text_col).mapInArrow(tidied(count), "w binary, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["w"]): r["n"] for r in rows}


def phrase_places(found: list[bytes]) -> list[tuple[int, int, str]]:
    """(first word, last word, label) of every place of a phrase."""
    out = []
    for phrase, label in PHRASES:
        parts = phrase.encode().split()
        at = -1
        try:
            while True:
                at = found.index(parts[0], at + 1)
                if found[at : at + len(parts)] == parts:
                    out.append((at, at + len(parts) - 1, label))
        except ValueError:
            pass
    return sorted(out)


def block_matches(ix: TemplateIndex, raw: bytes) -> list[tuple[int, str, float]]:
    """(line, template, share) of the lines, and of the paragraphs (by their first line) where no line has as much."""
    out: list[tuple[int, str, float]] = []
    start, all_words, best = 0, [], {}
    lines = _BLOCK.split(raw)
    for k, line in enumerate([*lines, b""]):
        if line.strip():
            held = words(line)
            for name, share in ix.specific(held, ix.search(held)):
                out.append((k, name, share))
                best[name] = max(share, best.get(name, 0.0))
            all_words += held
            continue
        if k - start > 1:
            out += [(start, name, share) for name, share in ix.specific(all_words, ix.search(all_words)) if share > best.get(name, 0.0)]
        start, all_words, best = k + 1, [], {}
    return sorted(out)


def scan(docs: DataFrame, frequency: dict[bytes, int], threshold: float = CONTAINMENT) -> DataFrame:
    """Per row: doc_id, n_words, places (first, last, label), matches (block, template, share).

    A null text counts as empty and has no places and no matches; a null doc_id stays null; repeated rows give repeated
    results; any length of text is read whole; an empty table gives no rows; other columns are not carried.
    """
    small_batches(docs.sparkSession)
    index = docs.sparkSession.sparkContext.broadcast(TemplateIndex(frequency, threshold))
    kind = docs.schema["doc_id"].dataType.simpleString()
    place = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string())])
    match = pa.struct([("block", pa.int64()), ("template", pa.string()), ("share", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        for b in slices(batches):
            n, places, matches = [], [], []
            for text in b.column(1).to_pylist():
                raw = (text or "").encode()
                found = words(raw)
                n.append(len(found))
                places.append([{"first": a, "last": z, "label": x} for a, z, x in phrase_places(found)])
                hits = []
                if len(ix.vocab.intersection(found)) >= 2:
                    hits = [{"block": k, "template": name, "share": s} for k, name, s in block_matches(ix, raw)]
                matches.append(hits)
            yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(places, pa.list_(place)), pa.array(matches, pa.list_(match))], names=["doc_id", "n_words", "places", "matches"])

    return docs.select("doc_id", "text").mapInArrow(tidied(run), f"doc_id {kind}, n_words long, places array<struct<first:long,last:long,label:string>>, matches array<struct<block:long,template:string,share:double>>")


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    x = scan(docs, token_frequencies(docs))
    base = F.transform("places", lambda p: p["label"])
    label = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return x.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["first"])).alias("last_word"),
        label(base).alias("base_labels"),
        label(F.concat(base, F.transform("matches", lambda m: m["template"]))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0))).alias("score"),
    )
