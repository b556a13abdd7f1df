"""Secrets in texts, found by one deterministic automaton for all rules.

All rules' short forms are compiled together. Texts are cut at bytes that no rule can read, so no
match spans a cut, and the parts run through the transition table side by side, every byte once.
In the few parts where a rule ends, that rule's own automaton finds the exact spans: leftmost,
longest, without overlaps within a kind; those whose measured part is too short are dropped.

Spans are in code points, the end exclusive. Null and empty texts have none. Work grows with the
length of a text, whatever it holds: no place is walked twice in the same state. Repeated rows each
get their spans, columns beside id and text are not read, an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from signalgrid.llm.arrays import pieces, text_bytes, word_spans
from signalgrid.llm.automaton import Automaton, compile_patterns


@dataclass(frozen=True)
class Rule:
    """``head`` then ``body``, both as long as they go; the body has ``least`` bytes or more.
    ``short`` matches somewhere in every such secret. A head ends in bytes a body cannot take
    over."""

    kind: str
    head: str
    body: str
    least: int
    short: str
    fold: bool = False


_ASSIGN = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
_VALUE = "[A-Za-z0-9+/_.=-]"
#: The rules every scan begins with.
BASE = [
    Rule("assign", _ASSIGN, _VALUE + "+", 6, _ASSIGN + _VALUE + "{6}", fold=True),
    Rule("access", "", "AKIA[A-Z0-9]+", 20, "AKIA[A-Z0-9]{16}"),
    Rule("hex", "", "[0-9a-f]+", 24, "[0-9a-f]{24}"),
]
#: Published token formats beyond the base.
MORE = [
    Rule("forge", "", "gh[pousr]_[A-Za-z0-9]+", 40, "gh[pousr]_"),
    Rule("chat", "", "xox[abprs]-[A-Za-z0-9-]+", 15, "xox[abprs]-"),
    Rule("cloud", "", "AIza[A-Za-z0-9_-]+", 39, "AIza"),
    Rule("jwt", "", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40, "eyJ"),
    Rule("private", "", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", 27, "PRIVATE KEY-----"),
]
#: Parts longer than this are walked byte by byte instead of side by side.
LONG = 4096
#: Failed runs of so few bytes are cheaper walked again than remembered.
SHORT_TAIL = 16


@dataclass
class Scanner:
    """Compiled rules: all short forms together, and head and body of each by itself."""

    rules: list[Rule]
    together: Automaton
    heads: list[Automaton | None]
    bodies: list[Automaton]
    readable: np.ndarray


def compile_rules(rules: list[Rule]) -> Scanner:
    heads = [compile_patterns([(r.head, r.fold)], True) if r.head else None for r in rules]
    bodies = [compile_patterns([(r.body, r.fold)], True) for r in rules]
    together = compile_patterns([(r.short, r.fold) for r in rules], False)
    readable = together.used.copy()
    for part in [*heads, *bodies]:
        if part:
            readable |= part.used
    return Scanner(rules, together, heads, bodies, readable)


class _Walk:
    """One automaton over one part. Of each state it remembers the places from which nothing more
    was accepted; a later run that comes there stops, so the runs of all starts together cost a
    step per state and byte at most."""

    def __init__(self, tables: tuple[tuple[list, list, list], int, int], data: bytes, begin: int, stop: int):
        (self.classes, self.step, self.accepts), self.start, self.width = tables
        self.data, self.begin, self.stop = data, begin, stop
        self.dead: dict[int, bytearray] = {}

    def longest(self, at: int) -> int:
        """End of the longest match from ``at`` on, -1 without one."""
        state, end, tail = self.start, -1, []
        while at < self.stop:
            state = self.step[state + self.classes[self.data[at]]]
            if not state:
                break
            at += 1
            if self.accepts[state // self.width]:
                end, tail = at, []
                continue
            dead = self.dead.get(state)
            if dead and dead[at - self.begin]:
                at -= 1
                break
            tail.append(state)
        if len(tail) > SHORT_TAIL:
            for passed in set(tail) - self.dead.keys():
                self.dead[passed] = bytearray(self.stop - self.begin + 1)
            for place, passed in enumerate(tail, at - len(tail) + 1 - self.begin):
                self.dead[passed][place] = 1
        return end


class _Finder:
    """Spans of the texts of a piece; one object per task holds the tables as lists."""

    def __init__(self, scanner: Scanner):
        self.scanner = scanner
        self.walks = [
            tuple((a.lists(), a.start, a.width) if a else None for a in pair)
            for pair in zip(scanner.heads, scanner.bodies)
        ]
        self.all = scanner.together.lists()

    def marks(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """For each part the rules whose short form it holds, as bits."""
        table = self.scanner.together
        sizes = stops - starts
        result = np.zeros(len(starts), np.int64)
        order = np.argsort(-sizes, kind="stable")
        long = int(np.searchsorted(-sizes[order], -LONG, side="left"))
        raw = data.tobytes() if long else b""
        classes, step, accepts = self.all
        for part in order[:long].tolist():
            state, seen = table.start, 0
            for byte in raw[starts[part] : stops[part]]:
                state = step[state + classes[byte]]
                seen |= accepts[state // table.width]
            result[part] = seen
        order = order[long:]
        if len(order):
            kinds = table.classes[data]
            accept = np.repeat(table.accepts, table.width)
            state = np.full(len(order), table.start)
            seen = np.zeros(len(order), np.int64)
            at, left = starts[order].copy(), -sizes[order]
            for i in range(int(-left[0])):
                active = int(np.searchsorted(left, -i, side="left"))
                now = table.step[state[:active] + kinds[at[:active]]]
                seen[:active] |= accept[now]
                state[:active] = now
                at[:active] += 1
            result[order] = seen
        return result

    def spans(self, rule: int, data: bytes, at: int, stop: int) -> list[tuple[int, int]]:
        """Leftmost longest matches of a rule in one part that do not overlap."""
        head, body = (_Walk(tables, data, at, stop) if tables else None for tables in self.walks[rule])
        found = []
        while at < stop:
            begin = head.longest(at) if head else at
            end = body.longest(begin) if begin >= 0 else -1
            if end < 0:
                at += 1
                continue
            if end - begin >= self.scanner.rules[rule].least:
                found.append((at, end))
            at = end
        return found

    def scan(self, column: pa.Array) -> list[list[dict]]:
        data, offsets = text_bytes(column)
        result: list[list[dict]] = [[] for _ in range(len(column))]
        if not len(data):
            return result
        starts, stops = word_spans(data, offsets, self.scanner.readable)
        marks = self.marks(data, starts, stops)
        rows = np.searchsorted(offsets, starts, side="right") - 1
        flagged = np.flatnonzero(marks)
        raw = data.tobytes() if len(flagged) else b""
        for part in flagged.tolist():
            for rule, name in enumerate(self.scanner.rules):
                if marks[part] >> rule & 1:
                    for a, b in self.spans(rule, raw, int(starts[part]), int(stops[part])):
                        result[rows[part]].append({"kind": name.kind, "start": a, "stop": b, "rank": rule})
        for row in np.unique(rows[flagged]).tolist():
            begin = int(offsets[row])
            # Code points before each byte of the text.
            points = np.append(0, np.cumsum((data[begin : offsets[row + 1]] & 0xC0) != 0x80))
            for span in result[row]:
                span["start"] = int(points[span["start"] - begin])
                span["stop"] = int(points[span["stop"] - begin])
            result[row].sort(key=lambda span: (span["start"], span["rank"]))
        return result


def find_secrets(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", rules: list[Rule] | None = None
) -> DataFrame:
    """(id, spans) of every row; spans are (kind, start, stop), by start, then order of rules."""
    scanner = compile_rules(rules or [*BASE, *MORE])
    kind = docs.schema[id_column].dataType.simpleString()
    shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Finder(scanner)
        for batch in batches:
            for piece in pieces(batch, text, 4 << 20):
                spans = [
                    [{name: span[name] for name in ("kind", "start", "stop")} for span in row]
                    for row in finder.scan(piece.column(text))
                ]
                yield pa.record_batch([piece.column(id_column), pa.array(spans, shape)], [id_column, "spans"])

    return docs.select(id_column, text).mapInArrow(
        run, f"{id_column} {kind}, spans array<struct<kind: string, start: bigint, stop: bigint>>"
    )
