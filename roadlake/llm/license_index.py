"""License scans by a positional index of rare words.

License notices are kept as templates. The index holds, for each template's rarest words, postings (template, position).
Rarity is measured over all documents (inverse document frequency of the templates' words). A file's rare licence words
are looked up; each posting proposes a start for its template, and starts on which a template's rare words agree
are kept. At such a start the mandatory key phrases must stand, and the share of template words in place is the score.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.llm.common import map_text

# Phrases that the contract names, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Fixed values: (label, wording of a public licence notice, phrases that must be there word for word).
TEMPLATES = [
    ("agpl-3.0", "GNU Affero General Public License version 3", ["affero general public license"]),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ["apache license version 2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ["www apache org licenses license 2 0"]),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products", ["neither the name of"]),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License", ["creative commons attribution 4 0"]),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ["cc by nc 4 0"]),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ["cc by sa 4 0"]),
    ("cc0-1.0", "Creative Commons Zero v1.0 Universal public domain dedication", ["creative commons zero"]),
    ("gpl-2.0", "under the terms of the GNU General Public License version 2", ["general public license version 2"]),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3", ["general public license version 3"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee is hereby granted"]),
    ("lgpl-3.0", "GNU Lesser General Public License version 3", ["lesser general public license"]),
    ("mit", "Released under the MIT License", ["mit license"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted free of charge"]),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ["mozilla public license"]),
    ("unlicense", "This is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]

#: A template's rare words that propose places, and how many of them must agree (all, if it has fewer).
ANCHORS = 4
AGREE = 3
#: Least share of a template's words in place.
COVER = 0.6

_FOLD = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if 0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def license_words(text: bytes) -> list[bytes]:
    """Words of digits, letters (A-Z lower-cased) and anything beyond ASCII."""
    return text.translate(_FOLD).split()


def places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Starts where the phrase's words stand one after another."""
    out, at, n = [], -1, len(phrase)
    try:
        while True:
            at = words.index(phrase[0], at + 1)
            if words[at : at + n] == phrase:
                out.append(at)
    except ValueError:
        return out


class TemplateIndex:
    """Postings of every template's rarest words. df: document frequencies over n_docs documents."""

    def __init__(self, templates: list[tuple[str, str, list[str]]], df: dict[bytes, int], n_docs: int) -> None:
        self.templates = [(label, license_words(text.encode()), [license_words(p.encode()) for p in phrases]) for label, text, phrases in templates]
        self.idf = {w: log((n_docs + 1) / (df.get(w, 0) + 1)) for _, words, _ in self.templates for w in words}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.need = []
        for t, (_, words, _) in enumerate(self.templates):
            rare = sorted(set(words), key=lambda w: (-self.idf[w], w))[:ANCHORS]
            self.need.append(min(AGREE, len(rare)))
            for p, w in enumerate(words):
                if w in rare:
                    self.postings[w].append((t, p))
        self.rare = frozenset(self.postings)

    def scan(self, words: list[bytes]) -> list[tuple[str, int, float]]:
        """(label, start, share of the template in place) for every verified place."""
        if self.rare.isdisjoint(words):
            return []
        agreed: dict[tuple[int, int], set[bytes]] = defaultdict(set)
        rare, postings = self.rare, self.postings
        for i, w in enumerate(words):
            if w in rare:
                for t, p in postings[w]:
                    agreed[t, i - p].add(w)
        found = []
        for (t, start), anchors in agreed.items():
            if len(anchors) < self.need[t]:
                continue
            label, template, phrases = self.templates[t]
            low, high = max(0, start), max(0, start + len(template))
            window = words[low:high]
            cover = sum(a == b for a, b in zip(template[low - start :], window, strict=False)) / len(template)
            if cover >= COVER and all(places(window, p) for p in phrases):
                found.append((label, low, cover))
        return found


def document_frequencies(docs: DataFrame, templates: list[tuple[str, str, list[str]]], text_col: str = "text") -> tuple[dict[bytes, int], int]:
    """In how many documents each word of the templates stands, and the number of documents; one small row per word and task."""
    vocabulary = frozenset(w for _, text, _ in templates for w in license_words(text.encode()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        n = 0
        for batch in batches:
            for x in batch.column(0):
                n += 1
                counts.update(vocabulary.intersection(license_words(x.as_py() or b"")))
        words = [*counts, b""]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([*counts.values(), n], pa.int64())], names=["w", "n"])

    rows = docs.select(F.col(text_col).cast("binary").alias("t")).mapInArrow(run, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))
    got = {bytes(r.w): r.n for r in rows.collect()}  # at most one row for each word of the templates
    return got, got.pop(b"", 0)


SCAN = [
    ("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType()),
    ("base_labels", T.StringType()), ("labels", T.StringType()), ("score", T.DoubleType()), ("n_templates", T.LongType()),
]


def scan_licenses(docs: DataFrame, keep: list[str], templates: list[tuple[str, str, list[str]]] | None = None, text_col: str = "text") -> DataFrame:
    """Kept columns, n_words, n_base, first_word, last_word, base_labels, labels, score, n_templates of every row.

    score: 1 where a base phrase stands, else the best template's share of words in place, else 0. A null text is empty
    (no words, no labels: empty strings). Repeated rows are scanned alike. An empty table gives an empty result.
    """
    templates = templates or TEMPLATES
    df, n_docs = document_frequencies(docs, templates, text_col)
    index = TemplateIndex(templates, df, n_docs)
    base = [(license_words(p.encode()), label) for p, label in PHRASES.items()]

    def rows(texts: list[bytes]) -> list[list]:
        out: list[list] = [[] for _ in SCAN]
        for b in texts:
            words = license_words(b)
            at: list[int] = []
            labels = set()
            for phrase, label in base:
                if got := places(words, phrase):
                    at += got
                    labels.add(label)
            found = index.scan(words)
            row = (
                len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {x[0] for x in found})),
                1.0 if at else max((x[2] for x in found), default=0.0), len(found),
            )
            for column, value in zip(out, row, strict=True):
                column.append(value)
        return out

    return map_text(docs, keep, SCAN, rows, text_col)
