"""License labels of texts: phrases, and templates found by a set-similarity join.

Blocks are lines, and runs of as many words as the template has, across line breaks, as
licence texts are wrapped. A block matches a template when it holds at least
``MIN_CONTAINMENT`` percent of the template's distinct words. The search is exact:

1. Template words are ordered by how many lines of all documents hold them, rarest first.
2. Prefix: a block that misses all of the first ``|T| - needed + 1`` words of template T
   cannot hold ``needed`` of them, so only those words are looked up.
3. Length: a block with fewer distinct words than ``needed`` cannot match.
4. Position: with the first shared word at place p of the ordered template, at most
   ``|T| - p`` words can be shared.
5. What passes is compared exactly. Runs are tried around each prefix word with enough
   template words close by.

Two passes read the texts: one counts template words (a few hundred rows a task are
summed), one scans. Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased,
compared by 64-bit hash.

Defined results: a null or empty text has no words, no labels, null places and score 0;
repeated rows are scanned one by one; ``labels`` and ``base_labels`` are empty texts where
nothing is found; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countermill.llm.wordhash import BY_PUNCTUATION, words

MIN_CONTAINMENT = 85

#: Base phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Opening or typical sentences of public licences and notices.
TEMPLATES = {
    "agpl": ("GNU Affero General Public License",),
    "apache": (
        "Licensed under the Apache License, Version 2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
    ),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "cc": ("Licensed under Creative Commons Attribution", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0",),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "This work is licensed under the GNU General Public License, version 3",
    ),
    "lgpl": ("GNU Lesser General Public License",),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Released under the MIT License",
    ),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "proprietary": ("All rights reserved. No part of this publication may be reproduced without prior written permission",),
}


def _hashes(text: str) -> np.ndarray:
    return next(words(pa.array([text]), BY_PUNCTUATION)).hashes


class Templates:
    """Templates as word-hash arrays, ordered by the blocks that hold each word."""

    def __init__(self, templates: dict[str, tuple[str, ...]], percent: int) -> None:
        named = [(label, text) for label, texts in templates.items() for text in texts]
        self.labels = [label for label, _ in named]
        self.sets = [np.unique(_hashes(text)) for _, text in named]
        self.lengths = [len(_hashes(text)) for _, text in named]
        self.needed = [-(-percent * len(s) // 100) for s in self.sets]
        self.vocabulary = np.unique(np.concatenate(self.sets)) if named else np.zeros(0, np.uint64)

    def order_by(self, blocks: dict[int, int]) -> None:
        """Sort each template by the blocks that hold its words; index the prefixes."""
        rank = np.array([blocks.get(int(v), 0) for v in self.vocabulary.view(np.int64)])
        self.prefix_of: dict[int, list[tuple[int, int]]] = {}
        self.prefixes: list[np.ndarray] = []
        for t, found in enumerate(self.sets):
            by_count = found[np.lexsort((found, rank[np.searchsorted(self.vocabulary, found)]))]
            self.sets[t] = by_count
            self.prefixes.append(by_count[: len(by_count) - self.needed[t] + 1])
            for place, word in enumerate(by_count[: len(by_count) - self.needed[t] + 1]):
                self.prefix_of.setdefault(int(word), []).append((t, place))
        self.prefix_words = np.array(sorted(self.prefix_of), dtype=np.uint64)

    def match(self, block: np.ndarray) -> list[tuple[int, float]]:
        """(template, share of it held) for the distinct sorted words of a block."""
        if len(self.prefix_words) == 0 or len(block) == 0:
            return []
        at = np.minimum(np.searchsorted(self.prefix_words, block), len(self.prefix_words) - 1)
        first: dict[int, int] = {}
        for word in block[self.prefix_words[at] == block]:
            for t, place in self.prefix_of[int(word)]:
                first[t] = min(place, first.get(t, place))
        out = []
        for t, place in first.items():
            whole = self.sets[t]
            if len(block) < self.needed[t] or len(whole) - place < self.needed[t]:
                continue
            shared = int(np.isin(whole, block).sum())
            if shared >= self.needed[t]:
                out.append((t, shared / len(whole)))
        return sorted(out)

    def match_runs(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, float]]:
        """(row, template, best share of it held) by the runs of words of some rows, row i
        having words ``first[i]:first[i + 1]``."""
        out = []
        places = np.flatnonzero(_member(self.vocabulary, hashes))
        found = hashes[places]
        for t, whole in enumerate(self.sets):
            n, needed = self.lengths[t], self.needed[t]
            at = places[np.isin(found, self.prefixes[t])]
            if len(at) == 0:
                continue
            mine = places[np.isin(found, whole)]
            row = np.searchsorted(first, at, side="right") - 1
            low, high = np.maximum(at - n + 1, first[row]), np.minimum(at + n, first[row + 1])
            enough = np.searchsorted(mine, high) - np.searchsorted(mine, low) >= needed
            best: dict[int, int] = {}
            for p, r, begin, end in zip(*(x[enough].tolist() for x in (at, row, low, high))):
                if best.get(r, 0) == len(whole):
                    continue
                near = mine[np.searchsorted(mine, begin) : np.searchsorted(mine, end)]
                words_near = hashes[near].tolist()
                for start in near[near <= p].tolist():  # a run may as well begin at a template word
                    held = {w for w, x in zip(words_near, near.tolist()) if start <= x < start + n}
                    best[r] = max(best.get(r, 0), len(held))
            out += [(r, t, held / len(whole)) for r, held in best.items() if held >= needed]
        return out


def _blocks(part) -> tuple[np.ndarray, np.ndarray]:
    """Line number of each word in a slice of texts, and the line a row begins with."""
    feeds = np.flatnonzero(part.data == 0x0A)
    line = np.searchsorted(feeds, part.starts)
    return line, feeds


def _member(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if len(vocabulary) == 0:
        return np.zeros(len(hashes), dtype=bool)
    return vocabulary[np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)] == hashes


def _count(vocabulary: np.ndarray):
    """Blocks that hold each template word, one row for each word and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for part in words(batch.column("text"), BY_PUNCTUATION):
                line, _ = _blocks(part)
                row = np.searchsorted(part.first, np.arange(len(part.hashes)), side="right")
                found = np.flatnonzero(_member(vocabulary, part.hashes))
                place = np.searchsorted(vocabulary, part.hashes[found])
                # one for each block and word: lines restart with each row
                key = (line[found] + row[found]) * len(vocabulary) + place
                total += np.bincount(np.unique(key) % len(vocabulary), minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays(
            [pa.array(vocabulary.view(np.int64)), pa.array(total)], names=["word", "n"]
        )

    return run, "word bigint, n bigint"


def _scan(model):
    kinds = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64())]
    kinds += [("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates: Templates = model.value
        phrases = [(_hashes(phrase), label) for phrase, label in PHRASES.items()]
        for batch in batches:
            rows = []
            for part in words(batch.column("text"), BY_PUNCTUATION):
                h = part.hashes
                row_of = np.searchsorted(part.first, np.arange(len(h)), side="right") - 1
                line, _ = _blocks(part)
                base: dict[int, list[tuple[int, str]]] = {}
                for phrase, label in phrases:
                    here = np.flatnonzero(h == phrase[0])
                    here = here[here + len(phrase) <= len(h)]
                    for k, word in enumerate(phrase[1:], 1):
                        here = here[h[here + k] == word]
                    here = here[row_of[here] == row_of[here + len(phrase) - 1]]
                    for at in here.tolist():
                        base.setdefault(int(row_of[at]), []).append((at, label))
                matched: dict[int, list[tuple[int, float]]] = {}
                candidates = np.flatnonzero(_member(templates.prefix_words, h))
                seen = set()
                for at in candidates.tolist():
                    row = int(row_of[at])
                    if (row, int(line[at])) in seen:
                        continue
                    seen.add((row, int(line[at])))
                    first = max(int(np.searchsorted(line, line[at])), int(part.first[row]))
                    last = min(int(np.searchsorted(line, line[at], side="right")), int(part.first[row + 1]))
                    if found := templates.match(np.unique(h[first:last])):
                        matched.setdefault(row, []).extend(found)
                for row, t, share in templates.match_runs(h, part.first):
                    matched.setdefault(row, []).append((t, share))
                for row in range(len(part.first) - 1):
                    n = int(part.first[row + 1] - part.first[row])
                    places = [at - int(part.first[row]) for at, _ in base.get(row, [])]
                    own = {label for _, label in base.get(row, [])}
                    more = matched.get(row, [])
                    every = own | {templates.labels[t] for t, _ in more}
                    score = 1.0 if own else max([0.0, *(share for _, share in more)])
                    rows.append(
                        (
                            n,
                            len(places),
                            min(places, default=None),
                            max(places, default=None),
                            ",".join(sorted(own)),
                            ",".join(sorted(every)),
                            round(score, 6),
                        )
                    )
            columns = list(zip(*rows)) if rows else [[]] * 7
            arrays = [pa.array(c, t.type) for c, t in zip(columns, list(schema)[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], schema=schema)

    columns = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint"
    return run, columns + ", base_labels string, labels string, score double"


def scan(
    docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, percent: int = MIN_CONTAINMENT
) -> DataFrame:
    """For each document its words, places of base phrases, labels and the best share of a
    template held (1 where a base phrase stands)."""
    model = Templates(TEMPLATES if templates is None else templates, percent)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    counted = texts.select("text").mapInArrow(*_count(model.vocabulary)).groupBy("word").agg(F.sum("n"))
    model.order_by({r[0]: r[1] for r in counted.collect()})  # as many rows as template words
    return texts.mapInArrow(*_scan(docs.sparkSession.sparkContext.broadcast(model)))


def brute_force(text: str | None, percent: int = MIN_CONTAINMENT) -> tuple[int, str, str]:
    """(places of base phrases, base labels, labels) of one text by comparing every line
    and every run of words with every template; for tests."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, own = 0, set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        hits = sum(found[i : i + len(parts)] == parts for i in range(len(found)))
        places += hits
        own |= {label} if hits else set()
    every = set(own)
    lines = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line) for line in low.split("\n")]
    for label, texts in TEMPLATES.items():
        for template in texts:
            parts = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", template.lower())
            runs = [found[i : i + len(parts)] for i in range(len(found))]
            if any(100 * len(set(parts) & set(block)) >= percent * len(set(parts)) for block in lines + runs):
                every.add(label)
    return places, ",".join(sorted(own)), ",".join(sorted(every))
