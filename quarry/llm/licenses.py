"""License scan: winnowed fingerprints of templates in an inverted index pick candidates,
then banded sequence alignment reports matched coverage and spans.

A template is posted under the least hash of every ``WINNOW`` neighbouring ``GRAM``-word
runs, so any ``GRAM + WINNOW - 1`` words shared with a text share a fingerprint. The index
is as large as the templates (a parameter) and goes to the tasks with the code; texts are
scanned where they lie, without a shuffle. Around each run of hits the template is aligned
with the text, word by word, within a band of ``BAND`` words about the hits' diagonal.

In a template of fewer than ``SHORT`` words one changed word can spoil every run, and one word
makes another license of it. Such a template is posted under its first identifying word
(license name or version) instead, hits without enough of its words around are dropped,
and an alignment counts only if all identifying words stand in it, and no word that
names a variant of the license.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.textops import LOWER_AZ, Words, mix, slices, span_hashes, window_hashes

GRAM = 3
WINNOW = 2
BAND = 8
COVERAGE = 0.8
SHORT = 15

# fixed values: words of a license statement that don't tell which license it is, and words that make another license of a name
GENERIC = frozenset("""a an the this that these work works is are be been licensed license licence licenced under released version
international unported of to in on for and or with terms conditions software file files code project content document documentation
program page site text distributed available published provided""".split())
QUALIFIERS = frozenset("""lesser affero library sharealike share alike noncommercial commercial noderivatives noderivs derivatives derivs
nc nd sa""".split())

#: fixed values: wording of common license statements, by name
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
        "or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."),
    "MIT": "Released under the MIT License",
    "MIT notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "BSD notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met"),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
}

_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def plain_words(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end, hash) of the words trimmed of outer ASCII punctuation and lower-cased;
    words of punctuation alone are left out."""
    solid = np.flatnonzero(_ALNUM[w.data])
    lo, hi = np.searchsorted(solid, w.start), np.searchsorted(solid, w.end)
    keep = np.flatnonzero(hi > lo)
    start, end = solid[lo[keep]], solid[hi[keep] - 1] + 1
    return w.row[keep], start, end, span_hashes(LOWER_AZ[w.data], start, end)


def statement_tokens(text: str) -> list[str]:
    """Lower-cased words and versions of a statement, hyphens split; v3 and 3.0 are 3."""
    return [re.sub(r"^v(?=\d)|(?:\.0)+$", "", t) for t in re.findall(r"[^\W_]+(?:\.\d+)*", text.lower())]


def identified(statement: str, required: list[str]) -> bool:
    """Whether the identifying words stand in order in a statement without others' qualifiers."""
    tokens = statement_tokens(statement)
    rest = iter(tokens)
    return all(w in rest for w in required) and QUALIFIERS.isdisjoint(set(tokens) - set(required))


def winnowed(words: np.ndarray) -> np.ndarray:
    """(position, hash) of the winnowed word runs of one template; all of a short one's runs."""
    runs = mix(window_hashes(words, GRAM))
    if len(runs) <= WINNOW:
        return np.arange(len(runs)), runs
    neighbours = np.lib.stride_tricks.sliding_window_view(runs, WINNOW)
    at = np.unique(np.arange(len(neighbours)) + neighbours.argmin(axis=1))
    return at, runs[at]


class Index:
    """Inverted index: fingerprint to (template, position); ``required`` has the identifying words
    of each short template, ``anchors`` the (template, position, word) it is posted under."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = list(templates)
        self.words: list[np.ndarray] = []
        self.required: dict[int, list[str]] = {}
        self.anchors: list[tuple[int, int, np.uint64]] = []
        posts: list[tuple[int, int, int]] = []
        # the ways to write a version
        bases = {re.sub(r"(?:\.0)+$", "", v) for text in templates.values() for v in re.findall(r"(?<![\w.])\d+(?:\.\d+)*(?![\w])", text)}
        ways = sorted((int(h), int(self._hash(base)[0])) for base in bases for h in self._hash(f"{base} {base}.0 v{base} v{base}.0"))
        self.way = np.array([w for w, _ in ways], dtype=np.uint64)
        self.base = np.array([b for _, b in ways], dtype=np.uint64)
        for t, text in enumerate(templates.values()):
            words = self.versions(self._hash(text))
            if len(words) < GRAM:
                raise ValueError(f"template {self.names[t]!r} has fewer than {GRAM} words")
            self.words.append(words)
            if len(words) < SHORT:
                self.required[t] = [w for w in statement_tokens(text) if w not in GENERIC]
                name = [h for w in self.required[t] if w.isalpha() for h in self._hash(w) if h in words][:1]
                self.anchors += [(t, i, h) for i, h in enumerate(words) if not name or h == name[0]]
                continue
            posts += [(int(h), t, int(p)) for p, h in zip(*winnowed(words))]
        posts.sort()
        self.hashes = np.array([h for h, _, _ in posts], dtype=np.uint64)
        self.template = np.array([t for _, t, _ in posts])
        self.position = np.array([p for _, _, p in posts])

    @staticmethod
    def _hash(text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        return plain_words(Words(raw, np.array([0, len(raw)])))[3]

    def versions(self, words: np.ndarray) -> np.ndarray:
        """The words with each version of a template in one way of writing."""
        if not len(self.way):
            return words
        at = np.minimum(np.searchsorted(self.way, words), len(self.way) - 1)
        return np.where(self.way[at] == words, self.base[at], words)

    def short_hits(self, words: np.ndarray, first: np.ndarray, row: np.ndarray, coverage: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, template, position) of every anchor with enough words of its template nearby."""
        out = [(np.zeros(0, np.int64),) * 3]
        for t, position, anchor in self.anchors:
            at = np.flatnonzero(words == anchor)
            if not len(at):
                continue
            size = len(self.words[t])
            lo = np.maximum(first[row[at]], at - position - BAND)
            hi = np.minimum(first[row[at] + 1], at - position + size + 2 * BAND)
            near = np.zeros(len(at), dtype=np.int64)
            for word, times in Counter(self.words[t].tolist()).items():
                places = np.flatnonzero(words == np.uint64(word))
                near += np.minimum(np.searchsorted(places, hi) - np.searchsorted(places, lo), times)
            at = at[near >= math.ceil(coverage * size - 1e-9)]
            out.append((at, np.full(len(at), t), np.full(len(at), position)))
        return tuple(np.concatenate(x) for x in zip(*out))

    def hits(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(run, template, position) of every text run that is a fingerprint."""
        lo, hi = np.searchsorted(self.hashes, runs, "left"), np.searchsorted(self.hashes, runs, "right")
        found = np.flatnonzero(hi > lo)
        times = (hi - lo)[found]
        run = np.repeat(found, times)
        post = np.arange(len(run)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo[found], times)
        return run, self.template[post], self.position[post]


def align(template: np.ndarray, words: np.ndarray, diagonal: int, band: int = BAND) -> tuple[int, int, int]:
    """Best local alignment of ``template`` with ``words`` within ``band`` of ``diagonal`` (text
    position less template position): (matched words, first, end) in ``words``. A match
    scores 2, a mismatch, an added or a missing word -1."""
    width = 2 * band + 1
    score, match = np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
    origin = np.zeros(width, dtype=np.int64)
    best = (0, 0, 0, 0)
    for i, word in enumerate(template):
        new_score, new_match, new_origin = np.zeros_like(score), np.zeros_like(match), np.zeros_like(origin)
        for k in range(width):
            j = i + diagonal + k - band
            if j < 0 or j >= len(words):
                continue
            same = words[j] == word
            options = [(score[k] + (2 if same else -1), match[k] + same, origin[k] if score[k] > 0 else j)]
            if k + 1 < width:  # a word of the template is missing in the text
                options.append((score[k + 1] - 1, match[k + 1], origin[k + 1]))
            if k > 0:  # the text has an added word
                options.append((new_score[k - 1] - 1, new_match[k - 1], new_origin[k - 1]))
            top = max(options, key=lambda o: (o[0], o[1]))
            if top[0] > 0:
                new_score[k], new_match[k], new_origin[k] = top
                if (top[0], top[1]) > best[:2]:
                    best = (int(top[0]), int(top[1]), int(top[2]), j + 1)
        score, match, origin = new_score, new_match, new_origin
    return best[1], best[2], best[3]


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, key: str = "doc_id", text: str = "text",
                  coverage: float = COVERAGE) -> DataFrame:
    """One row per license statement found: (key, license, matched_words, coverage,
    first_word, end_word), words counted without those of punctuation alone.

    A statement is reported if ``coverage`` or more of its template's words match in order; one
    of a short template only if license name and version are among them. Null, empty and
    short texts, and texts without a fingerprint, have no rows; repeated
    rows and null keys are reported like others. Other columns are not carried.
    """
    index = Index(templates)
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in slices(batches, "_text"):
            row, start, end, words = plain_words(Words(data, offs))
            words = index.versions(words)
            first = np.searchsorted(row, np.arange(part.num_rows + 1))
            inside = row[GRAM - 1:] == row[:len(row) - GRAM + 1] if len(row) >= GRAM else np.zeros(0, dtype=bool)
            at, template, position = index.hits(mix(window_hashes(words, GRAM)))
            good = inside[at]
            short = index.short_hits(words, first, row, coverage)
            at, template, position = (np.concatenate((x[good], y)) for x, y in zip((at, template, position), short))
            diagonal = at - position
            out: list[tuple] = []
            order = np.lexsort((at, template, row[at]))
            place = (-1, -1)
            for i in order:
                r, t, d, here = int(row[at[i]]), int(template[i]), int(diagonal[i]), int(at[i])
                if (r, t) != place:
                    place, taken, refused = (r, t), int(first[r]), (0, 0)
                # inside a reported span, or in a band that has been aligned in vain
                if here < taken or here < refused[1] and abs(d - refused[0]) <= BAND // 2:
                    continue
                lo = max(taken, d - BAND)
                hi = min(int(first[r + 1]), d + len(index.words[t]) + 2 * BAND)
                # a short one's neighbour may fit as well: closer about the anchor then
                for band in (BAND, BAND // 2, BAND // 4) if t in index.required else (BAND,):
                    n, a, b = align(index.words[t], words[lo:hi], d - lo, band)
                    share = n / len(index.words[t])
                    fits = share >= coverage and (t not in index.required or identified(
                        data[start[lo + a]:end[lo + b - 1]].tobytes().decode(errors="replace"), index.required[t]))
                    if fits:
                        break
                if fits:
                    taken = lo + b
                    out.append((r, index.names[t], n, share, int(lo - first[r] + a), int(lo - first[r] + b)))
                else:
                    refused = (d, hi)
            rows, names, n, share, a, b = zip(*out) if out else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(rows, pa.int64())), pa.array(names, pa.string()), pa.array(n, pa.int32()),
                 pa.array(share, pa.float64()), pa.array(a, pa.int32()), pa.array(b, pa.int32())],
                [key, "license", "matched_words", "coverage", "first_word", "end_word"])

    return docs.select(key, F.col(text).alias("_text")).mapInArrow(
        run, f"`{key}` {kind}, license string, matched_words int, coverage double, first_word int, end_word int")
