"""Licence scan by a positional index of rare licence words.

Templates are licence texts (or notices) with key phrases that must stand in a
file for the licence to count.  Words' document frequencies come from all files.

1. The index posts, of each template, the places of the words with the highest
   inverse document frequency.  With m words and a share of ``least`` asked for,
   that are so many places that any alignment with this share holds at least
   ``agree`` of them: m - ceil(least * m) + agree.
2. A file's words are looked up there.  A place in the file minus a place in the
   template is an alignment; alignments are counted in cells of ``slack``
   (longer for long templates), each cell reaching over the one before it, so
   words may be inserted or missing.  Postings are intersected: only cells that
   ``agree`` of a template's posted places vote for are candidates.
3. In a candidate every key phrase must stand word by word within the cell's
   alignments.
4. Its score is the share of template words found in order (longest common
   subsequence within the cell's alignments, bit-parallel), at least ``least``.

So the index loses nothing: it finds what scoring every cell of every template
would find, and words elsewhere in the file neither add nor hide a licence.

A short notice is its own only key phrase: each place of its rarest word in
the file is tried, so every place of the notice is found.

Defined cases: null and empty texts have no words, no labels and score 0;
null ids stay null; repeated rows give repeated results; other columns are
ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, small_batches, text_bytes

REPORT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, evidence string"
)

# Letters of words: 0-9, a-z (A-Z lower-cased) and every byte of a non-ASCII character.
_WORD_BYTES = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)


def licence_words(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False


# Whole public licences, as words in lower case.
MIT_TEXT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
    "notice and this permission notice shall be included in all copies or substantial portions of the software the "
    "software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors "
    "or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or "
    "otherwise arising from out of or in connection with the software or the use or other dealings in the software"
)
ISC_TEXT = (
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies the software is "
    "provided as is and the author disclaims all warranties with regard to this software including all implied "
    "warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect "
    "or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an "
    "action of contract negligence or other tortious action arising out of or in connection with the use or "
    "performance of this software"
)
BSD_2_TEXT = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met 1 redistributions of source code must retain the above copyright notice this list "
    "of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright "
    "notice this list of conditions and the following disclaimer in the documentation and or other materials provided "
    "with the distribution this software is provided by the copyright holders and contributors as is and any express "
    "or implied warranties including but not limited to the implied warranties of merchantability and fitness for a "
    "particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any "
    "direct indirect incidental special exemplary or consequential damages including but not limited to procurement "
    "of substitute goods or services loss of use data or profits or business interruption however caused and on any "
    "theory of liability whether in contract strict liability or tort including negligence or otherwise arising in "
    "any way out of the use of this software even if advised of the possibility of such damage"
)
ZLIB_TEXT = (
    "this software is provided as is without any express or implied warranty in no event will the authors be held "
    "liable for any damages arising from the use of this software permission is granted to anyone to use this "
    "software for any purpose including commercial applications and to alter it and redistribute it freely subject to "
    "the following restrictions 1 the origin of this software must not be misrepresented you must not claim that you "
    "wrote the original software if you use this software in a product an acknowledgment in the product documentation "
    "would be appreciated but is not required 2 altered source versions must be plainly marked as such and must not "
    "be misrepresented as being the original software 3 this notice may not be removed or altered from any source "
    "distribution"
)
UNLICENSE_TEXT = (
    "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
    "compile sell or distribute this software either in source code form or as a compiled binary for any purpose "
    "commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or "
    "authors of this software dedicate any and all copyright interest in the software to the public domain"
)
APACHE_TEXT = (
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
    "the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
    "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
    "without warranties or conditions of any kind either express or implied see the license for the specific language "
    "governing permissions and limitations under the license"
)
GPL_TEXT = (
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 3 of the license or at your option any later "
    "version this program is distributed in the hope that it will be useful but without any warranty without even the "
    "implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for "
    "more details you should have received a copy of the gnu general public license along with this program"
)

# The base phrases, then notices and opening sentences of public licences, then the whole texts.
TEMPLATES = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "deal in the software without restriction"),
    ),
    Template(
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license",
        ("apache license version 2 0", "except in compliance with the license"),
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        ("gnu general public license",),
    ),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template("mpl", "mozilla public license"),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted",
        ("permission to use copy modify", "with or without fee is hereby granted"),
    ),
    Template(
        "unlicense", "this is free and unencumbered software released into the public domain",
        ("released into the public domain",),
    ),
    Template("cc-by", "cc by 4 0"),
    Template("cc-by-nc", "cc by nc 4 0"),
    Template("cc-by-sa", "cc by sa 4 0"),
    Template("proprietary", "all rights reserved"),
    Template("mit", MIT_TEXT, ("without restriction", "the software is provided as is")),
    Template("isc", ISC_TEXT, ("with or without fee is hereby granted",)),
    Template("bsd", BSD_2_TEXT, ("redistribution and use in source and binary forms",)),
    Template("zlib", ZLIB_TEXT, ("must not be misrepresented",)),
    Template("unlicense", UNLICENSE_TEXT, ("released into the public domain",)),
    Template("apache", APACHE_TEXT, ("apache license version 2 0",)),
    Template("gpl", GPL_TEXT, ("gnu general public license",)),
)


class Index:
    """Templates as word lists, and the postings of their rare words."""

    def __init__(self, templates=TEMPLATES, slack: int = 6, least: float = 0.6, agree: int = 3) -> None:
        self.templates, self.least = templates, least
        self.words = [t.text.encode().split() for t in templates]
        self.keys = [[k.encode().split() for k in t.keys] or [w] for t, w in zip(templates, self.words, strict=True)]
        self.notice = [k == [w] for k, w in zip(self.keys, self.words, strict=True)]
        self.key_places = [
            [[i for i in range(len(w)) if _phrase_at(w, i, k)] for k in keys] for w, keys in zip(self.words, self.keys, strict=True)
        ]
        self.slack = [max(slack, len(w) // 16) for w in self.words]
        self.asked = [math.ceil(least * len(w) - 1e-9) for w in self.words]
        self.agree = [min(agree, n) for n in self.asked]
        self.bits: list[dict[bytes, int]] = []  # each template's places of a word, as a bit set
        for words in self.words:
            at: dict[bytes, int] = {}
            for i, w in enumerate(words):
                at[w] = at.get(w, 0) | 1 << i
            self.bits.append(at)
        self.vocabulary = sorted({w for words in self.words for w in words})

    def postings(self, idf: dict[bytes, float]) -> dict[bytes, list[tuple[int, int]]]:
        """(template, place) of the rarest places of each longer template, by word."""
        out: dict[bytes, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            if not self.notice[t]:
                ranked = sorted(range(len(words)), key=lambda i: (-idf[words[i]], i))
                for i in ranked[: len(words) - self.asked[t] + self.agree[t]]:
                    out.setdefault(words[i], []).append((t, i))
        return out


def _phrase_at(words: list[bytes], at: int, phrase: list[bytes]) -> bool:
    return at >= 0 and words[at : at + len(phrase)] == phrase


def candidates(where: dict[bytes, list[int]], index: Index, postings: dict[bytes, list[tuple[int, int]]]) -> dict[int, list[int]]:
    """Cells of each template for which enough posted places vote; ``where``:
    places of each licence word in the file."""
    votes: dict[tuple[int, int], int] = defaultdict(int)
    for w in where.keys() & postings.keys():
        for t, i in postings[w]:
            slack = index.slack[t]
            for cell in {(p - i) // slack + d for p in where[w] for d in (0, 1)}:
                votes[t, cell] |= 1 << i
    found: dict[int, list[int]] = {}
    for (t, cell), places in sorted(votes.items()):
        if places.bit_count() >= index.agree[t]:
            found.setdefault(t, []).append(cell)
    return found


def scan(words: list[bytes], index: Index, idf: dict[bytes, float], postings: dict[bytes, list[tuple[int, int]]]):
    """[(template number, place, score)]: all places of notices, the best
    alignment of longer templates (at ties the first), placed at its first key
    phrase."""
    where: dict[bytes, list[int]] = {}
    for i, w in enumerate(words):
        if w in idf:
            where.setdefault(w, []).append(i)
    found = []
    if not where:
        return found
    for t, template in enumerate(index.words):
        if index.notice[t] and all(w in where for w in template):
            found += [(t, s, 1.0) for s in _places(words, template, where, idf)]
    for t, cells in candidates(where, index, postings).items():
        if any(w not in where for key in index.keys[t] for w in key):
            continue  # a key phrase lacks a word
        stands = [_places(words, key, where, idf) for key in index.keys[t]]
        best = None
        for cell in cells:
            place = _keys_at(index, t, stands, cell)
            if place is not None:
                score = _in_order(index, t, words, cell) / len(index.words[t])
                if score >= index.least and (best is None or score > best[2]):
                    best = (t, place, score)
        if best:
            found.append(best)
    return found


def _places(words: list[bytes], phrase: list[bytes], where: dict[bytes, list[int]], idf: dict[bytes, float]) -> list[int]:
    """Places of ``phrase`` in ``words``, in order, looked up by its rarest word."""
    at = max(range(len(phrase)), key=lambda i: idf[phrase[i]])
    return [p - at for p in where[phrase[at]] if _phrase_at(words, p - at, phrase)]


def _reach(index: Index, t: int, cell: int) -> tuple[int, int]:
    """The first alignment of a cell, and the first past it."""
    return (cell - 1) * index.slack[t], (cell + 1) * index.slack[t]


def _keys_at(index: Index, t: int, stands: list[list[int]], cell: int) -> int | None:
    """The first place of the key phrases within the cell, None if one lacks."""
    lo, hi = _reach(index, t, cell)
    first = None
    for places, in_template in zip(stands, index.key_places[t], strict=True):
        here = []
        for i in in_template:
            at = bisect_left(places, lo + i)
            if at < len(places) and places[at] < hi + i:
                here.append(places[at])
        if not here:
            return None
        first = min(here) if first is None else min(first, *here)
    return first


def _in_order(index: Index, t: int, words: list[bytes], cell: int) -> int:
    """Longest common subsequence of template and file within the cell's
    alignments, bit-parallel over the template."""
    (lo, hi), size, bits = _reach(index, t, cell), len(index.words[t]), index.bits[t]
    full = (1 << size) - 1
    v = full
    for p in range(max(lo, 0), min(hi + size, len(words))):
        m = bits.get(words[p], 0)
        if m:
            m &= (1 << max(p - lo + 1, 0)) - 1  # place in the template at most p - lo ...
            m &= -1 << max(p - hi + 1, 0)  # ... and above p - hi
            u = v & m
            v = (v + u | v - u) & full
    return size - v.bit_count()


def word_frequencies(docs: DataFrame, index: Index) -> tuple[dict[bytes, int], int]:
    """Files per licence word, and files, over all of ``docs``."""
    vocabulary = frozenset(index.vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, files = Counter(), 0
        for batch in small_batches(batches):
            for text in text_bytes(batch.column(0)):
                files += 1
                total.update(vocabulary.intersection(licence_words(text)))
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array([None, *(w.decode() for w in total)], pa.string()), "files": pa.array([files, *total.values()], pa.int64())}
        )

    sums = docs.select("text").mapInArrow(count, "word string, files long").groupBy("word").agg(F.sum("files").alias("files"))
    counts = {r["word"]: r["files"] for r in sums.collect()}  # one row per licence word at most
    files = counts.pop(None, 0)
    return {w.encode(): n for w, n in counts.items()}, files


def licence_report(docs: DataFrame, templates=TEMPLATES, slack: int = 6, least: float = 0.6, agree: int = 3) -> DataFrame:
    """One row per document: words, places of the base phrases, labels, score.

    ``score`` is 1 for a notice found word by word, else the best template
    coverage; ``evidence`` lists label@word place of each finding.
    """
    index = Index(templates, slack, least, agree)
    bound_batches(docs.sparkSession)
    counts, files = word_frequencies(docs, index)
    idf = {w: math.log((1 + files) / (1 + counts.get(w, 0))) + 1 for w in index.vocabulary}
    postings = index.postings(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out: dict[str, list] = {c.split()[0]: [] for c in REPORT.split(", ")}
            for doc_id, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                words = licence_words(text)
                found = scan(words, index, idf, postings)
                base = [(templates[t].label, s) for t, s, _ in found if templates[t].base]
                starts = [s for _, s in base]
                row = (
                    doc_id, len(words), len(base), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted({label for label, _ in base})),
                    ",".join(sorted({templates[t].label for t, _, _ in found})),
                    max((s for _, _, s in found), default=0.0),
                    ",".join(f"{templates[t].label}@{s}" for t, s, _ in sorted(found, key=lambda x: (x[1], x[0]))),
                )
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)
            kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in REPORT.split(", ")]))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, REPORT)
