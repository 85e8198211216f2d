"""Licence scans by a generalised suffix automaton over licence tokens.

The automaton holds every factor of every template. A text streams through it once; at each token it knows the longest
match that ends there (matching statistics). Matches of at least MIN_MATCH tokens become template spans, spans of one
template are chained in order, and the share of the template that a chain covers is its score.

Null and empty texts have no words, no labels and score 0. Equal rows give equal results; an empty table an empty one.
Texts are looked at whole. Input columns other than the id and the text are not read.
"""

from __future__ import annotations

import heapq
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import engine, narrowed

# Base phrases and their labels, as the contract has them.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Wording of public licences and of usual licence notices.
TEMPLATES = {
    "mit": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "released under the mit license",
        "licensed under the mit license",
    ],
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ],
    "gpl-3.0": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    ],
    "gpl-2.0": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 2",
        "licensed under the gnu general public license version 2",
    ],
    "bsd-3-clause": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    ],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "cc-by-nc-4.0": ["licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc-by-4.0": ["this work is licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc-by-sa-4.0": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}
#: Tokens that a match needs, and the share of a template that its label needs.
MIN_MATCH, MIN_COVER = 4, 0.6

#: Bytes to lower case, all but word bytes to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Words of the contract: runs of digits, letters and characters beyond ASCII, A-Z in lower case."""
    return text.encode().translate(_FOLD).split()


class SuffixAutomaton:
    """All factors of several token sequences. Each state knows one place (sequence, end) of its factors."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.place = [-1], [0], [(0, 0)]
        for k, tokens in enumerate(sequences):
            last = 0
            for at, token in enumerate(tokens):
                last = self._extend(last, token, (k, at + 1))

    def _state(self, length: int, place: tuple[int, int], moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.place.append(place)
        return len(self.next) - 1

    def _split(self, parent: int, token: int, child: int) -> int:
        """A copy of child for the factors as long as parent's and one more."""
        copy = self._state(self.length[parent] + 1, self.place[child], dict(self.next[child]), self.link[child])
        while parent >= 0 and self.next[parent].get(token) == child:
            self.next[parent][token] = copy
            parent = self.link[parent]
        self.link[child] = copy
        return copy

    def _extend(self, last: int, token: int, place: tuple[int, int]) -> int:
        if token in self.next[last]:
            child = self.next[last][token]
            return child if self.length[child] == self.length[last] + 1 else self._split(last, token, child)
        state = self._state(self.length[last] + 1, place, {}, 0)
        while last >= 0 and token not in self.next[last]:
            self.next[last][token] = state
            last = self.link[last]
        if last >= 0:
            child = self.next[last][token]
            self.link[state] = child if self.length[child] == self.length[last] + 1 else self._split(last, token, child)
        return state

    def statistics(self, tokens: list[int]) -> list[tuple[int, int]]:
        """(length, state) of the longest factor that ends at each token."""
        out, state, length = [], 0, 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state = self.next[state][token]
                length += 1
            out.append((length, state))
        return out


class Scanner:
    def __init__(self, templates: dict[str, list[str]] = TEMPLATES, phrases: dict[str, str] = BASE_PHRASES, min_match: int = MIN_MATCH):
        self.min_match = min_match
        sequences = [(label, text.encode().split()) for label, texts in templates.items() for text in texts]
        self.vocabulary: dict[bytes, int] = {}
        for words in [w for _, w in sequences] + [p.encode().split() for p in phrases]:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        self.templates = [(label, [self.vocabulary[w] for w in words]) for label, words in sequences]
        self.automaton = SuffixAutomaton([tokens for _, tokens in self.templates])
        self._places: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
        self.phrases = [([self.vocabulary[w] for w in p.encode().split()], label) for p, label in phrases.items()]

    def tokens(self, text: str) -> np.ndarray:
        """Token of every word, 0 for words of no template."""
        words = words_of(text)
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))

    def base(self, tokens: np.ndarray) -> list[tuple[int, str]]:
        """(first word, label) of every place of a base phrase."""
        out = []
        for phrase, label in self.phrases:
            n = len(tokens) - len(phrase) + 1
            if n > 0:
                hit = tokens[:n] == phrase[0]
                for k in range(1, len(phrase)):
                    hit &= tokens[k : n + k] == phrase[k]
                out += [(int(i), label) for i in np.flatnonzero(hit)]
        return out

    def spans(self, tokens: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Maximal matches (word, template, first template token, length) of at least min_match tokens."""
        known = np.flatnonzero(tokens)
        if len(known) < self.min_match:
            return []
        out, runs = [], np.split(known, np.flatnonzero(np.diff(known) > 1) + 1)
        for run in runs:
            if len(run) < self.min_match:
                continue
            found = self.automaton.statistics(tokens[run].tolist())
            for i, (length, state) in enumerate(found):
                if length >= self.min_match and (i + 1 == len(found) or found[i + 1][0] <= length):
                    template, stop = self.automaton.place[state]
                    out.append((int(run[i]) - length + 1, template, stop - length, length))
        return out

    def places(self, template: int, first: int, length: int) -> list[tuple[int, int]]:
        """(template, first token) of every place in the templates that holds these tokens of one of them."""
        key = (template, first, length)
        if key not in self._places:
            part = self.templates[template][1][first : first + length]
            self._places[key] = [(k, i) for k, (_, own) in enumerate(self.templates) for i in range(len(own) - length + 1) if own[i : i + length] == part]
        return self._places[key]

    def cover(self, spans: list[tuple[int, int, int, int]]) -> dict[str, float]:
        """By label the largest share of one of its templates that a chain of spans covers. A span counts at each place of
        each template that holds it; chains go forward in the text and in the template."""
        placed: dict[int, list[tuple[int, int, int]]] = {}
        for word, template, first, length in spans:
            for k, at in self.places(template, first, length):
                placed.setdefault(k, []).append((word, at, length))
        best: dict[str, float] = {}
        for k, own in placed.items():
            label, tokens = self.templates[k]
            best[label] = max(best.get(label, 0.0), chained(own, len(tokens)) / len(tokens))
        return best


def chained(placed: list[tuple[int, int, int]], size: int) -> int:
    """Most template tokens that a chain of spans (word, first template token, length) covers, each span behind the one
    before it in the text and in the template of that size. Spans are taken by their words; those that have ended wait in
    a table of the best chain up to each template token, so the work is spans times the template's size at most."""
    reach = [0] * (size + 1)  # of chains that end at or before a template token
    ended: list[tuple[int, int, int]] = []
    best = 0
    for word, at, length in sorted(placed):
        while ended and ended[0][0] <= word:
            _, stop, covered = heapq.heappop(ended)
            for t in range(stop, size + 1):
                if reach[t] >= covered:
                    break
                reach[t] = covered
        total = reach[at] + length
        heapq.heappush(ended, (word + length, at + length, total))
        best = max(best, total)
    return best


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_cover: float = MIN_COVER) -> DataFrame:
    """(id, n_words, base: [(word, label)], spans: [(word, label, template token, length)], cover: label -> share)."""

    def run(batches):
        scanner = engine("license-scanner", Scanner)
        for batch in batches:
            n_words, base, spans, cover = [], [], [], []
            for text in batch.column(1).to_pylist():
                tokens = scanner.tokens(text or "")
                n_words.append(len(tokens))
                known = bool(tokens.any())
                base.append([{"word": w, "label": label} for w, label in sorted(scanner.base(tokens))] if known else [])
                matches = scanner.spans(tokens) if known else []
                spans.append([{"word": w, "label": scanner.templates[t][0], "at": a, "length": n} for w, t, a, n in matches])
                cover.append(list(scanner.cover(matches).items()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(base, pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))),
                 pa.array(spans, pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string()), ("at", pa.int32()), ("length", pa.int32())]))), pa.array(cover, pa.map_(pa.string(), pa.float64()))],
                [id_col, "n_words", "base", "spans", "cover"],
            )

    return narrowed(df, **{id_col: (id_col, "long"), "text": (text_col, "string")}).mapInArrow(
        run, f"`{id_col}` long, n_words long, base array<struct<word: long, label: string>>, spans array<struct<word: long, label: string, at: int, length: int>>, cover map<string, double>"
    )


def op5(docs: DataFrame, min_cover: float = MIN_COVER) -> DataFrame:
    found = scan(docs)
    base = F.array_distinct(F.transform("base", lambda b: b["label"]))
    own = F.map_keys(F.map_filter("cover", lambda _, share: share >= min_cover))
    best = F.coalesce(F.array_max(F.map_values("cover")), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["word"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["word"])).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.greatest(best, F.when(F.size("base") > 0, 0.5).otherwise(0.0)).alias("score"),
        F.size("spans").cast("long").alias("n_spans"),
    )
