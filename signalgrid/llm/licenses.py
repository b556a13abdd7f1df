"""Licences in texts, by templates with optional and replaceable regions.

A template is its wording with markup: ``[...]`` is a region that may be left out, ``{a,b}`` stands
for any ``a`` to ``b`` words; the rest is mandatory and must stand word for word. Punctuation, case
of A-Z and line ends do not count. Phrases without markup are templates too.

All templates are compiled together into one automaton over words: positions in the templates,
determinised by subset construction. Words of a text become numbers in the templates' vocabulary
(compared byte by byte where their hash is one of it); from every word that a template can begin
with, the automaton runs until no template goes on, all such places of a piece side by side. A place
is the longest way a template matches from there. A run is no longer than the longest template, so
time grows with the text.

Null and empty texts have no words, no places and score 0. Repeated rows get a row each. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from signalgrid.llm.arrays import pieces, text_bytes, word_hashes, word_spans

#: The phrases every scan begins with.
BASE = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
#: Published notices and texts beyond the base.
MORE = [
    ("agpl", "gnu affero general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("gpl-2.0", "gnu general public license [as published by the free software foundation] [either] version 2"),
    ("gpl-3.0", "gnu general public license [as published by the free software foundation] [either] version 3"),
    ("apache-2.0", "licensed under the apache license [version] 2 0"),
    ("cc-nc", "cc by nc [{1,1} 0]"),
    ("cc-sa", "cc by [nc] sa [{1,1} 0]"),
    ("cc-nd", "cc by [nc] nd [{1,1} 0]"),
    ("mit-notice", "released under [the terms of] the mit license"),
    ("mpl-2.0", "mozilla public license [v] [version] 2 0"),
    ("spdx", "spdx license identifier {1,3}"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    (
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to"
        " permit persons to whom the software is furnished to do so subject to the following conditions"
        " [the above copyright notice and this permission notice [including the next paragraph] shall be included in"
        " all copies or substantial portions of the software]"
        " [the software is provided as is without warranty of any kind express or implied including but not limited"
        " to the warranties of merchantability fitness for a particular purpose and noninfringement]",
    ),
    (
        "isc-text",
        "permission to use copy modify and [or] distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies"
        " [the software is provided as is and {1,12} disclaims all warranties]",
    ),
    (
        "bsd-text",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met [1] redistributions of source code must retain the above copyright notice"
        " this list of conditions and the following disclaimer [2] redistributions in binary form must reproduce the"
        " above copyright notice this list of conditions and the following disclaimer in the documentation and or"
        " other materials provided with the distribution",
    ),
    (
        "bsd-names",
        "neither the name of {1,12} nor the names of [its] contributors may be used to endorse or promote products"
        " derived from this software without specific prior written permission",
    ),
]

#: Bytes of words: ASCII letters and digits, and all that is not ASCII.
INSIDE = np.zeros(256, bool)
INSIDE[48:58] = INSIDE[65:91] = INSIDE[97:123] = INSIDE[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SEED = 12
#: Automata beyond this many states say that a template is too ambiguous.
MOST_STATES = 100_000
#: Places that run side by side.
PLACES = 1 << 16


def parse(markup: str) -> list:
    """Words, ``(a, b)`` for replaceable words and lists for optional regions."""
    stack: list[list] = [[]]
    for token in markup.replace("[", " [ ").replace("]", " ] ").replace("{", " {").split():
        if token == "[":
            stack.append([])
        elif token == "]":
            if len(stack) == 1:
                raise ValueError(f"region without a beginning: {markup}")
            done = stack.pop()
            stack[-1].append(done)
        elif token[0] == "{":
            low, _, high = token[1:-1].partition(",")
            stack[-1].append((int(low), int(high)))
        else:
            stack[-1].append(token.lower())
    if len(stack) != 1:
        raise ValueError(f"region without an end: {markup}")
    return stack[0]


class _Positions:
    """Nondeterministic automaton; ``steps[s]`` = (word or None for any, target), ``free[s]`` = targets."""

    def __init__(self) -> None:
        self.steps: list[tuple[str | None, int] | None] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append(None)
        self.free.append([])
        return len(self.steps) - 1

    def word(self, start: int, word: str | None) -> int:
        begin, end = self.state(), self.state()
        self.free[start].append(begin)
        self.steps[begin] = (word, end)
        return end

    def add(self, items: list, start: int) -> int:
        for item in items:
            if isinstance(item, str):
                start = self.word(start, item)
            elif isinstance(item, tuple):
                least, most = item
                end = self.state()
                for i in range(most):
                    if i >= least:
                        self.free[start].append(end)
                    start = self.word(start, None)
                self.free[start].append(end)
                start = end
            else:
                end = self.add(item, start)
                self.free[start].append(end)
                start = end
        return start

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        seen, stack = set(states), list(states)
        while stack:
            for target in self.free[stack.pop()]:
                if target not in seen:
                    seen.add(target)
                    stack.append(target)
        return frozenset(seen)


@dataclass
class Templates:
    """``step[state, word]`` is the next state, 0 is dead, word 0 is any other; ``accepts[state,
    template]`` tells which templates end."""

    labels: list[str]
    words: list[str]
    step: np.ndarray
    accepts: np.ndarray
    start: int


def compile_templates(templates: list[tuple[str, str]]) -> Templates:
    build = _Positions()
    root = build.state()
    ends = []
    for _, markup in templates:
        items = parse(markup)
        if not any(isinstance(item, str) for item in items):
            raise ValueError(f"no mandatory wording: {markup}")
        begin = build.state()
        build.free[root].append(begin)
        ends.append(build.add(items, begin))
    words = sorted({step[0] for step in build.steps if step and step[0] is not None})
    number = {word: i + 1 for i, word in enumerate(words)}
    begin = build.closure([root])
    known, order, rows = {frozenset(): 0, begin: 1}, [frozenset(), begin], []
    for subset in order:
        anyone, own = set(), {}
        for state in subset:
            if build.steps[state] is not None:
                word, target = build.steps[state]
                (anyone if word is None else own.setdefault(number[word], set())).add(target)
        row = np.zeros(len(words) + 1, np.int32)
        for word, targets in [(None, set()), *own.items()]:
            reached = build.closure(targets | anyone)
            if reached not in known:
                if len(order) >= MOST_STATES:
                    raise ValueError("templates are too ambiguous for one automaton")
                known[reached] = len(order)
                order.append(reached)
            row[slice(None) if word is None else word] = known[reached]
        rows.append(row)
    accepts = np.array([[end in subset for end in ends] for subset in order])
    return Templates([label for label, _ in templates], words, np.array(rows), accepts, 1)


class _Vocabulary:
    """Numbers of words: equal hashes find a candidate, equal bytes confirm it."""

    def __init__(self, words: list[str]):
        raw = [word.encode() for word in words]
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        self.ends = np.cumsum([len(word) for word in raw])
        self.starts = self.ends - [len(word) for word in raw]
        hashes = word_hashes(self.data, self.starts, self.ends, SEED, fold=True)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashes = word_hashes(data, starts, ends, SEED, fold=True)
        spot = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        word = self.order[spot]
        lengths = ends - starts
        maybe = np.flatnonzero((self.hashes[spot] == hashes) & (self.ends[word] - self.starts[word] == lengths))
        result = np.zeros(len(starts), np.int64)
        if len(maybe):
            sizes = lengths[maybe]
            firsts = np.cumsum(sizes) - sizes
            within = np.arange(int(sizes.sum())) - np.repeat(firsts, sizes)
            same = _LOWER[data[within + np.repeat(starts[maybe], sizes)]] == self.data[
                within + np.repeat(self.starts[word[maybe]], sizes)
            ]
            equal = maybe[np.logical_and.reduceat(same, firsts)]
            result[equal] = word[equal] + 1
        return result


class Matcher:
    """Places of the templates in the texts of a piece."""

    def __init__(self, templates: Templates):
        self.templates = templates
        self.vocabulary = _Vocabulary(templates.words)

    def places(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(words of each text; text, template, first word and end of each place), places by text,
        first word and template."""
        data, offsets = text_bytes(column)
        starts, ends = word_spans(data, offsets, INSIDE)
        text = np.searchsorted(offsets, starts, side="right") - 1
        counts = np.bincount(text, minlength=len(column)).astype(np.int64)
        numbers = self.vocabulary.numbers(data, starts, ends) if len(starts) else np.empty(0, np.int64)
        after = np.cumsum(counts)
        found = []
        begins = np.flatnonzero(self.templates.step[self.templates.start, numbers])
        for low in range(0, len(begins), PLACES):
            at = begins[low : low + PLACES]
            live, state, spot, stop = np.arange(len(at)), np.full(len(at), self.templates.start), at.copy(), after[text[at]]
            longest = np.zeros((len(at), len(self.templates.labels)), np.int32)
            while len(live):
                state = self.templates.step[state, numbers[spot]]
                spot = spot + 1
                place, kind = np.nonzero(self.templates.accepts[state])
                longest[live[place], kind] = (spot - at[live])[place]
                going = (state != 0) & (spot < stop[live])
                live, state, spot = live[going], state[going], spot[going]
            place, kind = np.nonzero(longest)
            found.append((at[place], kind, longest[place, kind]))
        first, kind, length = (np.concatenate(x) if found else np.empty(0, np.int64) for x in (zip(*found) if found else [()] * 3))
        own = text[first] if len(first) else np.empty(0, np.int64)
        first = first - (after - counts)[own]
        return counts, own, kind, first, first + length


def covered(counts: np.ndarray, own: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For each text, how many of its words lie in places."""
    begin = np.cumsum(counts) - counts
    change = np.zeros(int(counts.sum()) + 1, np.int64)
    np.add.at(change, begin[own] + first, 1)
    np.add.at(change, begin[own] + stop, -1)
    inside = np.append(0, np.cumsum(np.cumsum(change[:-1]) > 0))
    return inside[begin + counts] - inside[begin]


def find_licenses(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] | None = None
) -> DataFrame:
    """(id, n_words, n_covered, places) of every row; places are (label, start, stop) in words from
    0, the end exclusive, by start, then order of templates. Matching nothing gives no place."""
    compiled = compile_templates([*BASE, *MORE] if templates is None else templates)
    kind_of_id = docs.schema[id_column].dataType.simpleString()
    shape = pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(compiled)
        for batch in batches:
            for piece in pieces(batch, text, 4 << 20):
                counts, own, kind, first, stop = matcher.places(piece.column(text))
                edges = np.append(0, np.cumsum(np.bincount(own, minlength=piece.num_rows)))
                labels = pa.array(compiled.labels, pa.string()).take(pa.array(kind, pa.int64()))
                each = pa.StructArray.from_arrays(
                    [labels, pa.array(first, pa.int64()), pa.array(stop, pa.int64())], fields=list(shape)
                )
                yield pa.record_batch(
                    [
                        piece.column(id_column),
                        pa.array(counts),
                        pa.array(covered(counts, own, first, stop)),
                        pa.ListArray.from_arrays(pa.array(edges, pa.int32()), each),
                    ],
                    [id_column, "n_words", "n_covered", "places"],
                )

    return docs.select(id_column, text).mapInArrow(
        run,
        f"{id_column} {kind_of_id}, n_words long, n_covered long,"
        " places array<struct<label: string, start: bigint, stop: bigint>>",
    )
