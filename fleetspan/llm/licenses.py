"""License scan with a positional index of rare words.

Templates are license texts, each with a mandatory key phrase. Document frequencies of their
words are counted over all documents, whose rarity is the IDF. The index holds every
template's word with its positions (postings). In each file, the licence words that it has are looked up, and for every
template the two key words of highest IDF are taken: their postings, moved by their place
in the template, tell where the template would begin, and a place counts only if both
agree on it (the intersection by relative position). There the key phrase is verified word
for word, and the score is the share of the template's words, weighted by rarity, that
stand at their places. Key words must all be there, so the intersection loses no key phrase.

The base phrases are templates whose key phrase is the whole phrase, so all their
places are found.

Null and empty texts have no words. Repeated rows give repeated results. Texts
are scanned whole. With no documents there are no frequencies and no rows. Other columns,
clashing names included, are not looked at.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.llm.words import pieces, words_of

BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
"""Fixed values: phrase and label."""
# Texts of licenses and notices as words, each with its label and key phrase.
_FULL = {
    "mit": (
        "permission is hereby granted",
        """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation the rights to
        use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the
        software is furnished to do so subject to the following conditions the above copyright notice and this permission notice
        shall be included in all copies or substantial portions of the software the software is provided as is without warranty
        of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular
        purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other
        liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or
        the use or other dealings in the software""",
    ),
    "isc": (
        "permission to use copy modify",
        """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
        provided that the above copyright notice and this permission notice appear in all copies the software is provided as is
        and the author disclaims all warranties with regard to this software including all implied warranties of merchantability
        and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages
        whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action
        arising out of or in connection with the use or performance of this software""",
    ),
    "bsd": (
        "redistribution and use",
        """redistribution and use in source and binary forms with or without modification are permitted provided that the following
        conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the
        following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions
        and the following disclaimer in the documentation and or other materials provided with the distribution this software is
        provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to
        the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the
        copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages
        including but not limited to procurement of substitute goods or services loss of use data or profits or business
        interruption however caused and on any theory of liability whether in contract strict liability or tort including
        negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such
        damage""",
    ),
    "zlib": (
        "altered source versions",
        """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any
        damages arising from the use of this software permission is granted to anyone to use this software for any purpose including
        commercial applications and to alter it and redistribute it freely subject to the following restrictions 1 the origin of this
        software must not be misrepresented you must not claim that you wrote the original software if you use this software in a
        product an acknowledgment in the product documentation would be appreciated but is not required 2 altered source versions
        must be plainly marked as such and must not be misrepresented as being the original software 3 this notice may not be removed
        or altered from any source distribution""",
    ),
    "unlicense": (
        "free and unencumbered",
        """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell
        or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial
        and by any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all
        copyright interest in the software to the public domain we make this dedication for the benefit of the public at large and to
        the detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment in perpetuity of all
        present and future rights to this software under copyright law""",
    ),
    "apache-2.0": (
        "in compliance with the license",
        """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you
        may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in
        writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind
        either express or implied see the license for the specific language governing permissions and limitations under the license""",
    ),
    "gpl": (
        "at your option any later version",
        """this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as
        published by the free software foundation either version 3 of the license or at your option any later version this program is
        distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability
        or fitness for a particular purpose see the gnu general public license for more details you should have received a copy of
        the gnu general public license along with this program""",
    ),
    "mpl-2.0": (
        "mozilla public license",
        """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with
        this file you can obtain one at http mozilla org mpl 2 0""",
    ),
}
_LINES = [
    ("mit", "released under the mit license", "mit license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc", "licensed under a creative commons attribution license", "creative commons"),
]
TEMPLATES = [(label, " ".join(text.split()), key) for label, (key, text) in _FULL.items()] + _LINES
"""Label, text, key phrase."""
BETWEEN = np.isin(np.arange(256), [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
"""Bytes between words, after A-Z are lower case: all of ASCII but digits and letters."""


class Index:
    """Templates by the positions of their words."""

    def __init__(self, frequency: dict[str, int], documents: int, templates=None):
        base = [(label, phrase, phrase) for phrase, label in BASE_PHRASES.items()]
        self.templates = [*base, *(TEMPLATES if templates is None else templates)]
        self.n_base = len(base)
        self.idf = {w: math.log((documents + 1) / (frequency.get(w, 0) + 1)) + 1 for w in vocabulary(self.templates)}
        self.words = [t.split() for _, t, _ in self.templates]
        self.hashes = [hashes_of(w) for w in self.words]
        self.key = [next(i for i in range(len(w)) if w[i : i + len(k.split())] == k.split()) for w, (_, _, k) in zip(self.words, self.templates, strict=True)]
        self.key_size = [len(k.split()) for _, _, k in self.templates]
        self.weight = [np.array([self.idf[x] for x in w]) for w in self.words]
        # The two key words of highest IDF, each with its place in the template; one if the key has one only.
        self.rarest = []
        for t, words in enumerate(self.words):
            first = {w: i for i, w in reversed(list(enumerate(words))) if self.key[t] <= i < self.key[t] + self.key_size[t]}
            self.rarest.append(sorted(first.items(), key=lambda x: (-self.idf[x[0]], x[1]))[:2])
        known = sorted({w for chosen in self.rarest for w, _ in chosen})
        order = np.argsort(hashes_of(known))
        self.known_hash, self.known = hashes_of(known)[order], [known[i] for i in order]

    def candidates(self, words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(template, first word, score) of all places where a template's key phrase stands."""
        value = words.hashes()
        at = np.minimum(np.searchsorted(self.known_hash, value), len(self.known_hash) - 1)
        hit = np.flatnonzero(self.known_hash[at] == value)
        by_word = np.argsort(at[hit], kind="stable")
        bounds = np.searchsorted(at[hit][by_word], np.arange(len(self.known) + 1))
        places = {w: hit[by_word[a:b]] for w, a, b in zip(self.known, bounds, bounds[1:], strict=False)}
        found = []
        for t, chosen in enumerate(self.rarest):
            starts = [places[w] - i for w, i in chosen]
            begin = np.intersect1d(*starts) if len(starts) > 1 else starts[0]
            if not len(begin):
                continue
            doc = words.doc[begin + chosen[0][1]]
            size, hashes = len(self.words[t]), self.hashes[t]
            place = begin[:, None] + np.arange(size)
            inside = (place >= words.first[doc][:, None]) & (place < words.first[doc + 1][:, None])
            same = inside & (value[np.clip(place, 0, len(value) - 1)] == hashes)
            key = same[:, self.key[t] : self.key[t] + self.key_size[t]].all(1)
            score = (same @ self.weight[t]) / self.weight[t].sum()
            found.append((np.full(key.sum(), t), begin[key] + self.key[t], score[key]))
        if not found:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def vocabulary(templates) -> list[str]:
    return sorted({w for _, text, _ in templates for w in text.split()})


def hashes_of(words: list[str]) -> np.ndarray:
    return words_of(pa.array([" ".join(words)]), BETWEEN).hashes()


def _frequencies(words: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = hashes_of(words)
        order = np.argsort(wanted)
        sorted_ = wanted[order]
        for piece in pieces(batches):
            found = words_of(piece.column("text"), BETWEEN, lower=True)
            value = found.hashes()
            at = np.minimum(np.searchsorted(sorted_, value), len(sorted_) - 1)
            hit = np.flatnonzero(sorted_[at] == value)
            pairs = np.unique(found.doc[hit] * len(words) + order[at[hit]])
            count = np.bincount(pairs % len(words), minlength=len(words))
            yield pa.record_batch([pa.array([*words, None]), pa.array([*count.tolist(), piece.num_rows], pa.int64())], names=["word", "n"])

    return run


def _scan(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = [t[0] for t in index.templates]
        for piece in pieces(batches):
            words = words_of(piece.column("text"), BETWEEN, lower=True)
            template, place, score = index.candidates(words)
            doc = words.doc[place]
            base = template < index.n_base
            n = piece.num_rows
            n_base = np.bincount(doc[base], minlength=n)
            first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            at = place - words.first[doc]
            np.minimum.at(first, doc[base], at[base])
            np.maximum.at(last, doc[base], at[base])
            best = np.zeros(n)
            np.maximum.at(best, doc, score)
            own, all_ = [set() for _ in range(n)], [set() for _ in range(n)]
            for d, t in zip(doc.tolist(), template.tolist(), strict=True):
                all_[d].add(labels[t])
                if t < index.n_base:
                    own[d].add(labels[t])
            none = n_base == 0
            yield pa.record_batch(
                [
                    piece.column("doc_id"),
                    pa.array(np.diff(words.first)),
                    pa.array(n_base),
                    pa.array(first, mask=none),
                    pa.array(last, mask=none),
                    pa.array([",".join(sorted(s)) for s in own], pa.string()),
                    pa.array([",".join(sorted(s)) for s in all_], pa.string()),
                    pa.array(np.minimum(best, 1.0)),
                ],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return run


def license_scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    base = [(label, phrase, phrase) for phrase, label in BASE_PHRASES.items()]
    words = vocabulary([*base, *(TEMPLATES if templates is None else templates)])
    counted = docs.select("text").mapInArrow(_frequencies(words), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    frequency = {r["word"]: r["n"] for r in counted.collect()}  # a row for each word of the templates
    index = Index(frequency, frequency.get(None, 0), templates)
    kind = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return docs.mapInArrow(_scan(index), kind)
