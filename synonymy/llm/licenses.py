"""License scan by a positional rare-token index.

Templates are short word sequences.  The index posts the places of each word in each
template, and ranks words by inverse document frequency over all documents.  In each
file the licence words of highest inverse document frequency that stand in it are
looked up, template by template; their postings, intersected by relative position,
propose where the template would begin.  Several of them must agree on that place,
and the template's mandatory key phrases must stand there word by word.

A file without all words of a template's key phrases is not looked up for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_WORDS, Words, chunks, column, hash_word, only

#: Base phrases; every place counts.
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
#: Label, template, key phrases that must stand in it.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license",)),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("except in compliance with the license",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("hereby granted free of charge", "obtaining a copy")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms", "conditions are met")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ("free software", "gnu general public license")),
    ("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license", ("affero general public license",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by", "creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights", ("waived all copyright",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
    ("warranty", "the software is provided as is without warranty of any kind express or implied", ("without warranty of any kind",)),
)
#: Of each template, so many of its rarest words that stand in a file are looked up there.
ANCHORS = 4
#: Words by which an edited template may be longer or shorter.
SLACK = 3


class Index:
    """Templates (base phrases first) as word numbers, and postings of their rarest words."""

    def __init__(self):
        self.labels = [*BASE, *(t[0] for t in TEMPLATES)]
        texts = [*BASE.values(), *(t[1] for t in TEMPLATES)]
        self.words = sorted({w for t in texts for w in t.split()})
        number = {w: i for i, w in enumerate(self.words)}
        self.templates = [np.array([number[w] for w in t.split()]) for t in texts]
        self.keys = [[np.array([number[w] for w in k.split()]) for k in (t[2])] for t in TEMPLATES]
        h = np.array([hash_word(w) for w in self.words], np.uint64)
        self.order = np.argsort(h)
        self.hashes = h[self.order]

    def rank(self, df: dict[int, int]) -> None:
        """Rank each template's words, rarest first; equal frequencies by place.  Base phrases are looked up by their rarest word alone."""
        self.ranked, self.postings = [], []
        for t in self.templates:
            places: dict[int, list[int]] = {}
            for p, w in enumerate(t.tolist()):
                places.setdefault(w, []).append(p)
            self.ranked.append(sorted(places, key=lambda w: (df.get(w, 0), places[w][0])))
            self.postings.append(places)

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Each word's number, -1 for other words."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.order[at], -1)


def _document_frequency(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, m = np.zeros(len(index.words), np.int64), len(index.words)
        for whole in batches:
            for batch in chunks(whole):
                w = Words(column(batch, "text"), ALNUM_WORDS)
                v = index.numbers(w.hashes())
                seen = np.unique(w.doc[v >= 0] * m + v[v >= 0])
                n += np.bincount(seen % m, minlength=m)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(m)), pa.array(n)], names=["word", "n"])

    return run


def _stands(v: np.ndarray, doc: np.ndarray, start: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Which of the places hold the words of t, all in one document."""
    ok = (start >= 0) & (start + len(t) <= len(v))
    s = np.where(ok, start, 0)
    e = np.minimum(s + len(t) - 1, len(v) - 1)
    ok &= doc[s] == doc[e]
    for i, word in enumerate(t):
        ok &= v[np.minimum(s + i, len(v) - 1)] == word
    return ok


class Hits:
    """Where licence words stand in a slice, and which of them stand in which document."""

    def __init__(self, index: Index, w: Words):
        self.v, self.doc, self.first = index.numbers(w.hashes()), w.doc, w.first
        hit = np.flatnonzero(self.v >= 0)
        hit = hit[np.argsort(self.v[hit], kind="stable")]
        edges = np.searchsorted(self.v[hit], np.arange(len(index.words) + 1))
        self.spot = [hit[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        self.docs, place = np.unique(self.doc[hit], return_inverse=True)
        self.has = np.zeros((len(self.docs), len(index.words)), bool)
        self.has[place, self.v[hit]] = True


def _matched(index: Index, hits: Hits, i: int) -> Iterator[tuple[int, float]]:
    """(document, share of the template's words) where template i holds; each document by itself."""
    t, keys, ranked = index.templates[i], index.keys[i - len(BASE)], index.ranked[i]
    able = np.flatnonzero(hits.has[:, np.unique(np.concatenate(keys))].all(axis=1))
    if not len(able):
        return
    present = hits.has[np.ix_(able, ranked)]
    looked_up = present & (np.cumsum(present, axis=1) <= ANCHORS)
    start, doc, word = [], [], []
    for k, w in enumerate(ranked):
        at = hits.spot[w]
        which = np.searchsorted(hits.docs[able], hits.doc[at])
        which = np.minimum(which, len(able) - 1)
        at = at[(hits.docs[able[which]] == hits.doc[at]) & looked_up[which, k]]
        for p in index.postings[i][w]:
            start.append(at - p), doc.append(hits.doc[at]), word.append(np.full(len(at), w))
    start, doc, word = np.concatenate(start), np.concatenate(doc), np.concatenate(word)
    order = np.lexsort((start, doc))
    start, doc, word = start[order], doc[order], word[order]
    edges = np.flatnonzero(np.r_[True, (np.diff(start) > SLACK) | (np.diff(doc) > 0)]) if len(start) else ()
    for a, b in zip(edges, np.r_[edges[1:], len(start)] if len(start) else (), strict=True):
        if len(set(word[a:b].tolist())) < min(2, len(ranked)):
            continue
        low, high = hits.first[doc[a]], hits.first[doc[a] + 1]
        window = hits.v[max(low, start[a] - SLACK) : min(high, start[b - 1] + len(t) + SLACK)]
        if all(any(np.array_equal(window[x : x + len(k)], k) for x in range(len(window) - len(k) + 1)) for k in keys):
            share = max(float(np.mean([low <= x + j < high and hits.v[x + j] == w for j, w in enumerate(t)])) for x in set(start[a:b].tolist()))
            yield int(doc[a]), share


def _scanned(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole):
                w = Words(column(batch, "text"), ALNUM_WORDS)
                hits, n = Hits(index, w), w.rows
                base = np.zeros(n, np.int64)
                low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                score, base_labels, labels = np.zeros(n), [set() for _ in range(n)], [set() for _ in range(n)]
                for i, t in enumerate(index.templates[: len(BASE)]):
                    rarest = index.ranked[i][0]
                    start = hits.spot[rarest] - index.postings[i][rarest][0]
                    start = start[_stands(hits.v, w.doc, start, t)] if len(start) else start
                    d = w.doc[start]
                    np.add.at(base, d, 1)
                    np.minimum.at(low, d, start - w.first[d])
                    np.maximum.at(high, d, start - w.first[d])
                    for x in np.unique(d):
                        base_labels[x].add(index.labels[i])
                        labels[x].add(index.labels[i])
                        score[x] = 1.0
                for i in range(len(BASE), len(index.templates)):
                    for d, share in _matched(index, hits, i):
                        labels[d].add(index.labels[i])
                        score[d] = max(score[d], share)
                yield pa.RecordBatch.from_arrays(
                    [
                        column(batch, "doc_id"), pa.array(np.diff(w.first)), pa.array(base), pa.array(low, mask=base == 0), pa.array(high, mask=base == 0),
                        pa.array([",".join(sorted(x)) for x in base_labels]), pa.array([",".join(sorted(x)) for x in labels]), pa.array(score),
                    ],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
                )

    return run


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of ``docs`` (doc_id, text).

    Null or empty texts have no words and no labels (empty strings, score 0).  Null or
    repeated doc_ids are scanned row by row.  Words of equal frequency rank by their
    place in the template.  Columns other than doc_id and text are ignored.
    """
    docs, index = only(docs, "doc_id", "text"), Index()
    got = docs.mapInArrow(_document_frequency(index), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()  # a row for each word of the templates
    index.rank({r["word"]: r["n"] for r in got})
    return docs.mapInArrow(_scanned(index), "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def op1_license_scan(spark, sf_dir):
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
