"""Licence scan with a positional index over rare words.

Templates are short licence texts with the phrases that must be there. The words of all templates
form a small vocabulary; one pass over the corpus counts in how many documents each of them
occurs, and a template's words of highest IDF are its anchors. The index maps an anchor to its
postings: template and position. A second pass looks up each document's anchors, turns every hit
into the place where that template would begin, intersects the hits of a template by that place
(so words in the right order and distance support each other), and verifies the key phrases from
there. Phrases of a few words are templates whose key phrase is the whole of them, with their
rarest word as the only anchor: every place of the phrase holds the anchor, so none is missed.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_columns

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: bytes) -> list[bytes]:
    """Words of a text, A-Z lower-cased: runs of ASCII digits, letters and all other code points."""
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Template:
    """A licence text and its label; ``keys`` are the phrases that must stand at their places."""
    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False


# The four phrases of the scan and their labels.
BASE = (
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
)

# Sentences of well-known public licences, with the phrases that decide.
TEXTS = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files the software to deal in the software without restriction",
             ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use copy modify", "with or without fee is hereby granted")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
             "the following conditions are met",
             ("redistribution and use in source and binary forms", "are permitted provided that the following conditions are met")),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
             "http www apache org licenses license 2 0",
             ("except in compliance with the license", "www apache org licenses license 2 0")),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
             "license as published by the free software foundation",
             ("this program is free software", "under the terms of the gnu general public license")),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation",
             ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the gnu affero general public license as published by the free software foundation",
             ("gnu affero general public license",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("subject to the terms of the mozilla public license v 2 0",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license",
             ("creative commons attribution 4 0 international license",)),
    Template("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software released into the public domain",)),
)


@dataclass(frozen=True)
class _Entry:
    label: str
    words: tuple[bytes, ...]
    keys: tuple[tuple[int, tuple[bytes, ...]], ...]     # (place in the template, words)
    base: bool


def _compile(templates: tuple[Template, ...]) -> list[_Entry]:
    out = []
    for t in templates:
        ws = tuple(words(t.text.encode()))
        keys = []
        for k in t.keys or (t.text,):
            kw = tuple(words(k.encode()))
            at = next((i for i in range(len(ws) - len(kw) + 1) if ws[i:i + len(kw)] == kw), None)
            if at is None or not kw:
                raise ValueError(f"key phrase {k!r} is not in its template")
            keys.append((at, kw))
        out.append(_Entry(t.label, ws, tuple(keys), t.base))
    return out


def document_frequency(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> tuple[dict[bytes, int], int]:
    """In how many of all documents each template word occurs, and the number of documents.

    Counted in the tasks and summed by word: a row per word and task is shuffled, and as many
    numbers as the templates have words reach the driver.
    """
    c_text, = scratch_columns(docs, "_text")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = Counter(), 0
        for f in frames:
            for text in f[c_text]:
                seen.update(vocabulary.intersection(words(bytes(text))))
                n += 1
        yield pd.DataFrame({"word": [b"", *seen], "n": [n, *seen.values()]})
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias(c_text)).mapInPandas(count, "word binary, n long")
    found = {bytes(r["word"]): r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return found, found.pop(b"", 0)


class Index:
    """Anchors of the templates by IDF, with their postings. Its size depends on the templates only."""

    def __init__(self, entries: list[_Entry], df: dict[bytes, int], n: int, anchors: int = 4):
        self.entries = entries
        self.idf = {w: math.log((n + 1) / (df.get(w, 0) + 1)) for e in entries for w in e.words}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.n_anchors, self.weight = [], []
        for t, e in enumerate(entries):
            ranked = sorted(set(e.words), key=lambda w: (-self.idf[w], w))
            # words inside the key phrases only: a verified place always has them
            inside = [w for w in ranked if any(w in k for _, k in e.keys)]
            chosen = inside[:1] if len(e.keys) == 1 and len(e.keys[0][1]) == len(e.words) else inside[:anchors]
            # a word that stands twice in a template votes from its first place inside a key phrase only,
            # which every verified place has; outside the key phrases another word may stand
            for w in chosen:
                self.postings[w].append((t, min(at + k.index(w) for at, k in e.keys if w in k)))
            self.n_anchors.append(len(chosen))
            self.weight.append(sum(self.idf[w] for w in e.words) + 1e-9 * len(e.words))
        self.postings = dict(self.postings)

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words, and ``(template, first word, share of the template's IDF that stands there)``
        of every verified place."""
        ws, postings = words(text), self.postings
        hits: dict[tuple[int, int], int] = defaultdict(int)
        if not postings.keys().isdisjoint(ws):
            for i, w in enumerate(ws):
                if w in postings:
                    for t, p in postings[w]:
                        hits[(t, i - p)] += 1
        found = []
        for (t, start), votes in sorted(hits.items()):
            e = self.entries[t]
            if votes < self.n_anchors[t]:           # all anchors, at one relative position
                continue
            if all(start + at >= 0 and tuple(ws[start + at:start + at + len(k)]) == k for at, k in e.keys):
                there = sum(self.idf[w] + 1e-9 for j, w in enumerate(e.words) if 0 <= start + j < len(ws) and ws[start + j] == w)
                found.append((t, start, min(1.0, there / self.weight[t])))
        return len(ws), found


RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEXTS, base: tuple[Template, ...] = BASE,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its words, the places of the base phrases (their number, the
    smallest and the largest first word), the base labels, all labels (both distinct, sorted,
    comma-joined) and a score.

    The score is the largest share of a verified template's IDF weight that stands at its place: 1
    for a whole template or base phrase, less where words outside the key phrases differ, 0 without
    a find. Null and empty texts have no words and no find; null ids stay null; repeated rows get
    a row each; an empty table gives no rows.
    """
    entries = _compile(base + templates)
    df, n = document_frequency(docs, {w for e in entries for w in e.words}, text_col)
    index = Index(entries, df, n)
    c_id, c_text = scratch_columns(docs, "_id", "_text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for doc, text in zip(f[c_id], f[c_text]):
                n_words, found = index.scan(bytes(text))
                starts = [s for t, s, _ in found if entries[t].base]
                base_labels = sorted({entries[t].label for t, _, _ in found if entries[t].base})
                labels = sorted({entries[t].label for t, _, _ in found})
                rows.append((doc, n_words, len(starts), min(starts, default=None), max(starts, default=None), ",".join(base_labels),
                             ",".join(labels), max((s for _, _, s in found), default=0.0)))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])
            yield out.astype({"doc_id": "Int64", "first_word": "Int64", "last_word": "Int64", "score": float})
    rows = docs.select(F.col(id_col).cast("long").alias(c_id), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias(c_text))
    return rows.mapInPandas(run, RESULT)
