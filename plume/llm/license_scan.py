"""License scan with a positional rare-token index.

Template notices are indexed by their highest-IDF words, with IDF from the
document frequencies of the whole corpus. A file's occurrences of those words
are looked up; postings of a template that agree on its relative position in
the file, up to :data:`DRIFT` of its length, give a place. There template and
file are aligned word by word, in order: equal stretches are chained over the
shifts that inserted and missing words cause. A place counts if every mandatory
key phrase of the template stands in it unbroken and the chain holds enough of
the template's IDF weight. Beside it, the base phrases are found wherever their
words stand in a row.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of all
non-ASCII characters.

Defined results: null and empty texts have no words, empty label strings,
null positions and score 0; repeated rows are judged alike; among alignments
of one template the best score counts; label strings are distinct, sorted and
comma-joined. Extra columns are ignored, null ids carried through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plume.llm import textbatch as tb
from plume.llm.common import map_batches, text_columns

#: Phrases whose words, in a row, give a label by themselves.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Whole licence texts, as words.
MIT = """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation
files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish
distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the
following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the
software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of
merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any
claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software
or the use or other dealings in the software"""
_BSD_HEAD = """redistribution and use in source and binary forms with or without modification are permitted provided that the following
conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following
disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in
the documentation and or other materials provided with the distribution"""
_BSD_THIRD = """3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission"""
_BSD_TAIL = """this software is provided by the copyright holders and contributors as is and any express or implied warranties including but
not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright
holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to
procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability
whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if
advised of the possibility of such damage"""
ISC = """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that
the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all
warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable
for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an
action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"""
APACHE = """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you
may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software
distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the
license for the specific language governing permissions and limitations under the license"""
GPL = """this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as
published by the free software foundation either version {0} of the license or at your option any later version this program is distributed in
the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular
purpose see the gnu general public license for more details you should have received a copy of the gnu general public license along with this
program if not see"""
UNLICENSE = """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile
sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any
means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the
software to the public domain we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors
we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright
law"""

#: Label, notice, mandatory key phrases (all within the notice).
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction",
     ["permission is hereby granted free of charge", "without restriction"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the "
                 "license at http www apache org licenses license 2 0", ["apache org licenses license 2 0"]),
    ("gpl-3", "this work is licensed under the gnu general public license version 3",
     ["gnu general public license version 3"]),
    ("gpl-2", "this work is licensed under the gnu general public license version 2",
     ["gnu general public license version 2"]),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
              "general public license as published by the free software foundation either version 3 of the license",
     ["gnu general public license", "version 3"]),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3",
     ["gnu lesser general public license version 3"]),
    ("agpl-3", "licensed under the gnu affero general public license version 3",
     ["gnu affero general public license version 3"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ["mozilla public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", ["permission to use copy modify and or distribute this software"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution 4 0 international"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["free and unencumbered software", "public domain"]),
    ("mit", MIT, ["permission is hereby granted free of charge", "without restriction"]),
    ("bsd", f"{_BSD_HEAD} {_BSD_TAIL}", ["redistribution and use in source and binary forms"]),
    ("bsd", f"{_BSD_HEAD} {_BSD_THIRD} {_BSD_TAIL}", ["redistribution and use in source and binary forms", "endorse or promote products"]),
    ("isc", ISC, ["permission to use copy modify and or distribute this software"]),
    ("apache-2", APACHE, ["apache license version 2 0"]),
    ("gpl-2", GPL.format(2), ["gnu general public license", "either version 2"]),
    ("gpl-3", GPL.format(3), ["gnu general public license", "either version 3"]),
    ("unlicense", UNLICENSE, ["free and unencumbered software", "public domain"]),
]

#: Index words a template gets, and how many of them must agree on an alignment.
ANCHORS, AGREE = 4, 2
#: Share of the template's IDF weight that must match at the place.
MATCH_AT = 0.8
#: How far a template's words may shift against each other, as a share of its length.
DRIFT = 0.1

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double")


@dataclass(frozen=True)
class Template:
    label: str
    hashes: np.ndarray
    weights: np.ndarray  # share of the template's IDF weight
    phrases: list[tuple[int, int]]  # word ranges of the mandatory phrases


def vocabulary() -> list[str]:
    return sorted({word for _, notice, _ in TEMPLATES for word in notice.split()})


def document_frequencies(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """Documents in all, and documents with each template word; the result is as small as the vocabulary."""
    known = vocabulary()
    hashes = np.array([tb.hash_word(word) for word in known], tb.U64)
    order = np.argsort(hashes)
    ranked = hashes[order]

    def count(part: pa.RecordBatch) -> dict:
        texts = tb.as_texts(part.column("text"))
        w = tb.words(texts, tb.ALNUM, fold=True)
        at = np.searchsorted(ranked, w.hash).clip(max=len(ranked) - 1)
        hit = np.flatnonzero(ranked[at] == w.hash)
        pairs = np.unique((np.searchsorted(w.first, hit, "right") - 1) * len(known) + order[at[hit]])
        n = np.bincount(pairs % len(known), minlength=len(known))
        return {"word": np.append(np.arange(len(known)), -1), "n": np.append(n, len(texts))}

    rows = map_batches(text_columns(docs, "text"), count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    by_word = {r["word"]: r["n"] for r in rows.collect()}
    return by_word.get(-1, 0), {word: by_word.get(i, 0) for i, word in enumerate(known)}


def build_index(n_docs: int, frequency: dict[str, int]) -> tuple[list[Template], dict[int, list[tuple[int, int]]]]:
    """Templates, and postings (template, position) of their highest-IDF words by word hash."""
    idf = {word: math.log((n_docs + 1) / (n + 0.5)) + 1e-6 for word, n in frequency.items()}
    templates, postings = [], {}
    for number, (label, notice, phrases) in enumerate(TEMPLATES):
        own = notice.split()
        weight = np.array([max(idf[word], 0.05) for word in own])
        ranges = []
        for phrase in phrases:
            part = phrase.split()
            start = next(i for i in range(len(own)) if own[i:i + len(part)] == part)
            ranges.append((start, start + len(part)))
        templates.append(Template(label, np.array([tb.hash_word(word) for word in own], tb.U64),
                                  weight / weight.sum(), ranges))
        for word in sorted(set(own), key=lambda word: (-idf[word], word))[:ANCHORS]:
            spots = [(number, i) for i, other in enumerate(own) if other == word]
            postings.setdefault(tb.hash_word(word), []).extend(spots)
    return templates, postings


def places(spots: np.ndarray, hashes: np.ndarray, postings: dict, templates: list[Template]) -> list[tuple[int, int, int]]:
    """(template, least shift, largest shift) where AGREE index words of a template or more stand in nearly its order."""
    votes: dict[int, list[tuple[int, int]]] = {}
    for at in spots:
        word = int(hashes[at])
        for number, place in postings[word]:
            votes.setdefault(number, []).append((int(at) - place, word))
    out = []
    for number, own in votes.items():
        drift = _drift(templates[number])
        own.sort()
        low = 0
        for k in range(1, len(own) + 1):
            if k == len(own) or own[k][0] - own[k - 1][0] > drift:
                if len({word for _, word in own[low:k]}) >= AGREE:
                    out.append((number, own[low][0], own[k - 1][0]))
                low = k
    return out


def _drift(t: Template) -> int:
    return max(1, round(DRIFT * len(t.hashes)))


def chained(t: Template, window: np.ndarray) -> float:
    """The largest weight of template words that stand in the window in the template's order."""
    best = np.zeros(len(window) + 1)
    for word, weight in zip(t.hashes, t.weights):
        hit = np.flatnonzero(window == word)
        if len(hit):
            best[hit + 1] = np.maximum(best[hit + 1], best[hit] + weight)
            np.maximum.accumulate(best, out=best)
    return min(float(best[-1]), 1.0)


def _holds(window: np.ndarray, phrase: np.ndarray) -> bool:
    start = np.flatnonzero(window[:max(0, len(window) - len(phrase) + 1)] == phrase[0])
    return any((window[i:i + len(phrase)] == phrase).all() for i in start)


def _align(hashes: np.ndarray, spots: np.ndarray, postings: dict, templates: list[Template]) -> dict[str, float]:
    """Labels of one file with their scores. ``spots``: where index words stand. A row of overlapping places, as a file of
    repeated notices has, is looked at one template's length at a time."""
    found: dict[str, float] = {}
    for number, least, largest in places(spots, hashes, postings, templates):
        t = templates[number]
        drift, size = _drift(t), len(t.hashes)
        for begin in range(least - drift, largest + 1, 2 * size):
            window = hashes[max(0, begin):max(0, min(begin + 3 * size, largest + size) + drift)]
            if found.get(t.label, 0.0) >= 1.0 or not len(window) or not all(_holds(window, t.hashes[a:b]) for a, b in t.phrases):
                continue
            score = chained(t, window)
            if score >= MATCH_AT:
                found[t.label] = max(found.get(t.label, 0.0), score)
    return found


def scan(docs: DataFrame) -> DataFrame:
    """One row per document."""
    index = build_index(*document_frequencies(docs))
    shared = docs.sparkSession.sparkContext.broadcast(index)  # as small as TEMPLATES
    phrases = [([tb.hash_word(word) for word in phrase.split()], label) for phrase, label in BASE_PHRASES.items()]

    def judge(part: pa.RecordBatch) -> dict:
        templates, postings = shared.value
        texts = tb.as_texts(part.column("text"))
        n = len(texts)
        w = tb.words(texts, tb.ALNUM, fold=True)
        n_base, first, last = np.zeros(n, np.int64), np.full(n, len(w.hash) + 1), np.full(n, -1)
        labels: list[set[str]] = [set() for _ in range(n)]
        for own, label in phrases:
            # Begin at the last word, the rarest one of each phrase.
            start = np.flatnonzero(w.hash == tb.U64(own[-1])) - len(own) + 1
            start = start[start >= 0]
            for k, word in enumerate(own):
                start = start[w.hash[start + k] == tb.U64(word)]
            text = np.searchsorted(w.first, start, "right") - 1
            inside = start + len(own) <= w.first[text + 1]
            start, text = start[inside], text[inside]
            n_base += np.bincount(text, minlength=n)
            place = start - w.first[text]
            np.minimum.at(first, text, place)
            np.maximum.at(last, text, place)
            for i in np.unique(text):
                labels[i].add(label)
        base = [",".join(sorted(x)) for x in labels]
        score = np.zeros(n)
        ranked = np.sort(np.array(list(postings), tb.U64))
        at = np.searchsorted(ranked, w.hash).clip(max=len(ranked) - 1)
        hit = np.flatnonzero(ranked[at] == w.hash)
        text = np.searchsorted(w.first, hit, "right") - 1
        for i in np.flatnonzero(np.bincount(text, minlength=n) >= AGREE):
            spots = hit[text == i] - w.first[i]
            found = _align(w.hash[w.first[i]:w.first[i + 1]], spots, postings, templates)
            labels[i] |= set(found)
            score[i] = max(found.values(), default=0.0)
        none = n_base == 0
        return {"doc_id": part.column("doc_id"), "n_words": w.per_text, "n_base": n_base,
                "first_word": pa.array(first, pa.int64(), mask=none), "last_word": pa.array(last, pa.int64(), mask=none),
                "base_labels": base, "labels": [",".join(sorted(x)) for x in labels], "score": score}

    return map_batches(text_columns(docs, "doc_id", "text"), judge, SCHEMA)
