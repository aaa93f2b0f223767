"""License scans by template markup.

A template is the wording of a license text or notice with markup: ``[...]`` is an optional region (regions may nest) and
``<name a-b>`` a replaceable one of a to b words of any kind, as for copyright holders. Each template is compiled into a
token automaton: a state per token, an edge per mandatory word, empty edges around optional regions and edges for any
word inside replaceable ones. A text is accepted where a run of its words leads to the final state, so all mandatory
wording must match exactly, in order, with nothing between that the markup does not admit. Phrases of the base are templates
without markup and go through the same automata.

Words are lower-case (A-Z only) runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. Word pairs by which an automaton can begin are
looked up by hash over whole texts at once; automata run, on the words themselves, from those places only. Subsets of states are
kept per (subset, word), so a repeated step is one lookup. Texts never leave the task that reads them.

Defined results: null and wordless texts have no words, no places and a score of 0; repeated rows are scanned each for itself;
of several ends from one start the longest counts. The score is w / (w + 4) for the w mandatory words of the longest
template accepted anywhere. Columns that clash with outputs are not used.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .textnum import Words, column_bytes, slices

#: Phrases of the contract and their labels: fixed values.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Wording of public licenses and notices: (label, template).
TEMPLATES = [
    ("mit", "[the] [mit license] [copyright [c] <holder 1-12>] permission is hereby granted free of charge to any person obtaining a copy of this software"
            " and associated documentation files the software to deal in the software without restriction including without limitation the rights to use"
            " copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"
            " subject to the following conditions the above copyright notice and this permission notice [including the next paragraph] shall be included in all"
            " copies or substantial portions of the software [the software is provided as is without warranty of any kind]"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above"
            " copyright notice and this permission notice appear in all copies [the software is provided as is]"),
    ("bsd-2-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are"
                     " met [1] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer [2]"
                     " redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the"
                     " documentation and or other materials provided with the distribution"),
    ("bsd-3-clause", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the"
                     " documentation and or other materials provided with the distribution [3] neither the name of <holder 1-12> nor the names of [its]"
                     " contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("apache-2.0", "licensed under the apache license version 2 0 [the license] [you may not use this file except in compliance with the license]"),
    ("mit", "[released] [licensed] under the [terms of the] mit license"),
    ("gpl-3.0", "licensed under the [terms of the] gnu general public license [as published by the free software foundation] [either] version 3 [of the license]"
                " [or at your option any later version]"),
    ("gpl-2.0", "licensed under the [terms of the] gnu general public license [as published by the free software foundation] [either] version 2 [of the license]"
                " [or at your option any later version]"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free"
            " software foundation [either] version <number 1-1> of the license [or at your option any later version]"),
    ("lgpl", "under the terms of the gnu [lesser] [library] general public license as published by the free software foundation"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("cc-by-nc-4.0", "licensed under [a] [the] [creative commons] cc by nc 4 0 [international] [license]"),
    ("cc-by-4.0", "licensed under [a] [the] creative commons attribution 4 0 international [license]"),
    ("cc-by-sa-4.0", "licensed under [a] [the] creative commons attribution sharealike 4 0 international [license]"),
    ("spdx", "spdx license identifier <id 1-4>"),
]

_MARKUP = re.compile(r"\[|\]|<\w+ (\d+)-(\d+)>|[^\[\]<> ]+")
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
ANY = None


class Automaton:
    """States from 0 to ``final``; ``edges[s]`` lists (word or ANY, next), ``empty[s]`` next states without a word."""

    def __init__(self, label: str, template: str, base: bool = False):
        self.label, self.base, self.mandatory = label, base, 0
        self.edges: list[list[tuple[bytes | None, int]]] = [[]]
        self.empty: list[list[int]] = [[]]
        open_, now = [], 0
        for token in _MARKUP.finditer(template):
            if token[0] == "[":
                open_.append(now)
            elif token[0] == "]":
                self.empty[open_.pop()].append(now)
            elif token[1]:
                least, most = int(token[1]), int(token[2])
                skips = []
                for k in range(most):
                    if k >= least:
                        skips.append(now)
                    now = self._edge(now, ANY)
                for s in skips:
                    self.empty[s].append(now)
            else:
                self.mandatory += not open_
                now = self._edge(now, token[0].encode())
        if open_:
            raise ValueError(f"an optional region of {label} does not end")
        self.final = now
        self.begin = self._closed({0})
        if self.final in self.begin:
            raise ValueError(f"a template needs mandatory words: {label}")
        self._steps: dict[tuple[frozenset, bytes], frozenset] = {}
        self._words = {w for edges in self.edges for w, _ in edges}

    def _edge(self, state: int, word: bytes | None) -> int:
        self.edges.append([])
        self.empty.append([])
        self.edges[state].append((word, len(self.edges) - 1))
        return len(self.edges) - 1

    def _closed(self, states: set[int]) -> frozenset:
        todo = list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return frozenset(states)

    def step(self, states: frozenset, word: bytes) -> frozenset:
        if word not in self._words:
            word = b""  # all words that no edge names take the same step
        known = self._steps.get((states, word))
        if known is None:
            known = self._closed({t for s in states for w, t in self.edges[s] if w is ANY or w == word})
            self._steps[states, word] = known
        return known

    def pairs(self) -> set[tuple[bytes | None, bytes | None]]:
        """The (first, second) words by which it can begin; the second is ANY where the first may be the last."""
        out = set()
        for s in self.begin:
            for first, t in self.edges[s]:
                after = self._closed({t})
                if self.final in after:
                    out.add((first, ANY))
                out |= {(first, w) for u in after for w, _ in self.edges[u]}
        return out

    def end(self, words: list[bytes], at: int, stop: int) -> int:
        """End of the longest accepted run of ``words`` that begins at ``at``, or -1."""
        states, found = self.begin, -1
        while states and at < stop:
            states = self.step(states, words[at])
            at += 1
            if self.final in states:
                found = at
        return found


@lru_cache(maxsize=1)
def automata() -> list[Automaton]:
    return [Automaton(label, phrase, True) for phrase, label in BASE.items()] + [Automaton(label, text) for label, text in TEMPLATES]


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return Words(words, lower=False, separator=~_IS_WORD).hash


class Openings:
    """Which automata may begin at a word, from its hash and the next one's."""

    def __init__(self, found: list[Automaton]):
        self.by_pair: dict[tuple[int, int | None], list[int]] = {}
        for k, one in enumerate(found):
            for first, second in one.pairs():
                if first is ANY:
                    raise ValueError(f"a template must begin with a word: {one.label}")
                a = int(_word_hashes([first])[0])
                b = None if second is ANY else int(_word_hashes([second])[0])
                self.by_pair.setdefault((a, b), []).append(k)
        self.first = np.array(sorted({a for a, _ in self.by_pair}), dtype=np.uint64)

    def places(self, words: Words) -> list[tuple[int, list[int]]]:
        """(index of the word, automata to run)."""
        out = []
        some = np.flatnonzero(np.isin(words.hash, self.first))
        n = len(words.hash)
        for i, a in zip(some.tolist(), words.hash[some].tolist(), strict=True):
            b = int(words.hash[i + 1]) if i + 1 < n and words.doc[i + 1] == words.doc[i] else None
            run = self.by_pair.get((a, None), [])
            if b is not None:
                run = run + self.by_pair.get((a, b), [])
            if run:
                out.append((i, sorted(set(run))))
        return out


def matches(texts: list[bytes]) -> tuple[np.ndarray, list[list[tuple[int, int, int]]]]:
    """Words of each text, and for each its (automaton, first word, word after the last), by place."""
    found = automata()
    openings = _openings()
    counts, out = [], []
    for a, b in slices(texts):
        words = Words(texts[a:b], lower=True, separator=~_IS_WORD)
        counts.append(words.count)
        here: list[list[tuple[int, int, int]]] = [[] for _ in range(b - a)]
        data, split = words.data.tobytes(), {}
        for i, run in openings.places(words):
            d = int(words.doc[i])
            if d not in split:  # the words of one text, made once where it has an opening at all
                split = {d: [data[s:e] for s, e in zip(words.start[words.first[d] : words.first[d + 1]].tolist(), words.end[words.first[d] : words.first[d + 1]].tolist(), strict=True)]}
            at = i - int(words.first[d])
            for k in run:
                end = found[k].end(split[d], at, len(split[d]))
                if end >= 0:
                    here[d].append((k, at, end))
        out += here
    return (np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)), out


@lru_cache(maxsize=1)
def _openings() -> Openings:
    return Openings(automata())


_SPAN = pa.list_(pa.struct([("label", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("mandatory", pa.int32())]))


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = automata()
    for batch in batches:
        count, hits = matches(column_bytes(batch.column(1)))
        spans = [[{"label": found[k].label, "begin": a, "end": b, "base": found[k].base, "mandatory": found[k].mandatory} for k, a, b in row] for row in hits]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), pa.array(spans, _SPAN)], names=["doc_id", "n_words", "spans"])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, spans) of every document: accepted templates with their words from 0, end exclusive."""
    common.ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _scanned, "doc_id bigint, n_words bigint, spans array<struct<label: string, begin: bigint, end: bigint, base: boolean, mandatory: int>>"
    )


def verdicts(scanned: DataFrame) -> DataFrame:
    """Places of the base phrases, labels and score of each document."""
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["begin"])

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    most = F.coalesce(F.array_max(F.transform("spans", lambda s: s["mandatory"])), F.lit(0)).cast("double")
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"), (most / (most + 4)).alias("score"),
    )


def query(spark, sf_dir):
    return verdicts(scan(common.table(spark, sf_dir, "documents")))


def pattern(template: str) -> str:
    """A template as a regular expression over words that each have one blank behind."""
    out = []
    for token in _MARKUP.finditer(template):
        if token[1]:
            out.append(f"(?:[^ ]+ ){{{token[1]},{token[2]}}}")
        else:
            out.append({"[": "(?:", "]": ")?"}.get(token[0], token[0] + " "))
    return "".join(out)


def _sql() -> str:
    """Words as one blank-separated line, templates as regular expressions over it."""
    every = [(a.label, a.mandatory, t, a.base) for a, t in zip(automata(), [*BASE, *(t for _, t in TEMPLATES)], strict=True)]
    tests = ", ".join(f"CASE WHEN regexp_matches(line, ' {pattern(t)}') THEN {{'label': '{name}', 'mandatory': {n}, 'base': {base}}} END" for name, n, t, base in every)
    starts = ", ".join(
        f"list_filter(range(0, len(w)), lambda i: w[i + 1 : i + {len(p.split())}] = {p.split()})" for p in BASE
    )
    return f"""
WITH s AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), l AS (
  SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS line FROM s
), f AS (
  SELECT doc_id, len(w) AS n_words, list_filter([{tests}], lambda x: x IS NOT NULL) AS found,
    CASE WHEN regexp_matches(line, '{"|".join(f" {p} " for p in BASE)}') THEN flatten([{starts}]) ELSE [] END AS starts
  FROM l
)
SELECT doc_id, n_words, len(starts) AS n_base, list_min(starts) AS first_word, list_max(starts) AS last_word,
  array_to_string(list_sort(list_distinct(list_transform(list_filter(found, lambda x: x.base), lambda x: x.label))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_transform(found, lambda x: x.label))), ',') AS labels,
  coalesce(list_max(list_transform(found, lambda x: x.mandatory)), 0)::DOUBLE / (coalesce(list_max(list_transform(found, lambda x: x.mandatory)), 0) + 4) AS score
FROM f
"""


SQL = _sql()
