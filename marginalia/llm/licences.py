"""Licence scan: a generalised suffix automaton of licence wordings, streamed over whole texts.

The automaton holds every wording as a word sequence. A text is read once, word by word; at each word
the automaton gives the matching statistic, the length of the longest run of words ending there that
occurs in some wording. Runs of at least ``min_match`` words are chained, in order and with small gaps, into
spans of a wording; a wording of which a chain covers at least ``min_cover`` labels the text. The base
phrases are wordings too: one stands at a word if its state is on the suffix path of the current state
and the current match is as long as the phrase, which finds every place, overlapping ones included.

Null or empty text: no words, no places, empty labels, score 0. A null id is handed on. Repeated rows
give repeated results. An empty table gives an empty table. Only id and text are read, so further
columns of any name do no harm. Work and memory per text are linear in its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from marginalia.llm.common import arrow_schema, batches_of, byte_words, id_and_text

#: Fixed phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Common wordings of licence notices, by label.
WORDINGS = {
    "gpl": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        "this work is licensed under the gnu general public license version 3",
    ],
    "lgpl": ["under the terms of the gnu lesser general public license as published by the free software foundation"],
    "apache": ["licensed under the apache license version 2 0 you may not use this file except in compliance with the license"],
    "mit": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files to deal in the software without restriction",
        "released under the mit license",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met"
    ],
    "mpl": ["this source code form is subject to the terms of the mozilla public license"],
    "cc-by": ["this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-nc": ["licensed under cc by nc 4 0"],
    "cc-by-sa": ["licensed under cc by sa 4 0"],
}

MIN_MATCH, MAX_GAP, MIN_COVER = 4, 8, 0.6

SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, spans array<struct<label: string, start: bigint, end: bigint, cover: double>>"
)


class Automaton:
    """Generalised suffix automaton over words, with the wordings and base phrases of its states."""

    def __init__(self, base: dict[str, str], wordings: dict[str, list[str]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ids: dict[bytes, int] = {}
        self.phrases = [(tuple(map(self._word, p.split())), label) for p, label in base.items()]
        self.wordings = [(tuple(map(self._word, w.split())), label) for label, ws in wordings.items() for w in ws]
        for words, _ in [*self.phrases, *self.wordings]:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.places = self._wording_places()
        self.ending = self._phrase_ends()

    def _word(self, word: str) -> int:
        return self.ids.setdefault(word.encode(), len(self.ids))

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """The state for the strings of ``q`` that are no longer than one word beyond ``p``."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, word, self.next[p][word])
        return new

    def _wording_places(self) -> list[dict[int, int]]:
        """For each state the wordings that hold its strings, each with its first end there."""
        places: list[dict[int, int]] = [{} for _ in self.next]
        for k, (words, _) in enumerate(self.wordings):
            state = 0
            for end, word in enumerate(words, 1):
                state = self.next[state][word]
                up = state
                while up > 0 and k not in places[up]:
                    places[up][k] = end
                    up = self.link[up]
        return places

    def _phrase_ends(self) -> list[tuple[tuple[int, int], ...]]:
        """For each state the (length, phrase) of the base phrases on its suffix path."""
        own: dict[int, list[tuple[int, int]]] = {}
        for k, (words, _) in enumerate(self.phrases):
            state = 0
            for word in words:
                state = self.next[state][word]
            own.setdefault(state, []).append((len(words), k))
        ends = []
        for state in range(len(self.next)):
            found, up = [], state
            while up > 0:
                found += own.get(up, [])
                up = self.link[up]
            ends.append(tuple(found))
        return ends

    def matches(self, words: list[bytes], min_match: int):
        """Places of base phrases as (start, phrase), and long maximal matches as (end, length, state)."""
        nexts, link, length, ending = self.next, self.link, self.length, self.ending
        hits, long = [], []
        state = size = 0
        for i, word in enumerate(map(self.ids.get, words)):
            if word is None:
                if size:
                    if size >= min_match:
                        long.append((i, size, state))
                    state = size = 0
                continue
            edges = nexts[state]
            if word not in edges and size >= min_match:
                long.append((i, size, state))
            while word not in edges and state:
                state = link[state]
                size = length[state]
                edges = nexts[state]
            if word in edges:
                state = edges[word]
                size += 1
                for n, k in ending[state]:
                    if size >= n:
                        hits.append((i - n + 1, k))
            else:
                size = 0
        if size >= min_match:
            long.append((len(words), size, state))
        return hits, long

    def spans(self, long, max_gap: int, min_cover: float) -> list[tuple[str, int, int, float]]:
        """Chains of long matches of one wording, in order in text and wording, that cover enough of it."""
        chains: dict[int, list[list[int]]] = {}
        for end, size, state in long:
            for k, at in self.places[state].items():
                own = chains.setdefault(k, [])
                if own:
                    chain = own[-1]
                    skipped = max(0, chain[1] - (end - size), chain[2] - (at - size))
                    if at > chain[2] and size > skipped and end - size - chain[1] <= max_gap and at - size - chain[2] <= max_gap:
                        chain[1], chain[2], chain[3] = end, at, chain[3] + size - skipped
                        continue
                own.append([end - size, end, at, size])
        found = []
        for k, own in sorted(chains.items()):
            words, label = self.wordings[k]
            found += [(label, c[0], c[1], c[3] / len(words)) for c in own if c[3] >= min_cover * len(words)]
        return sorted(found, key=lambda s: (s[1], s[2], s[0]))


def scan_licences(
    docs: DataFrame,
    base: dict[str, str] = BASE,
    wordings: dict[str, list[str]] = WORDINGS,
    min_match: int = MIN_MATCH,
    max_gap: int = MAX_GAP,
    min_cover: float = MIN_COVER,
) -> DataFrame:
    """Base places, labels, score and covered spans of every row of ``docs(doc_id, text)``.

    ``score`` is the largest covered share of a wording, 1 where a base phrase stands. ``start`` and ``end``
    of a span count words from 0, the end exclusive.
    """
    schema = arrow_schema(SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(base, wordings)
        for batch in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            out["doc_id"] = batch.column(0).to_pylist()
            for text in batch.column(1):
                words = byte_words(text.as_py())
                hits, long = automaton.matches(words, min_match)
                spans = automaton.spans(long, max_gap, min_cover)
                starts = [s for s, _ in hits]
                labels = {automaton.phrases[k][1] for _, k in hits}
                out["n_words"].append(len(words))
                out["n_base"].append(len(hits))
                out["first_word"].append(min(starts, default=None))
                out["last_word"].append(max(starts, default=None))
                out["base_labels"].append(",".join(sorted(labels)))
                out["labels"].append(",".join(sorted(labels | {s[0] for s in spans})))
                out["score"].append(1.0 if hits else float(max((s[3] for s in spans), default=0.0)))
                out["spans"].append([dict(zip(("label", "start", "end", "cover"), s)) for s in spans])
            yield batches_of(out, schema)

    return id_and_text(docs).mapInArrow(run, SCHEMA)
