"""Regular expressions over bytes, compiled into one minimal deterministic automaton.

The patterns know literals, escapes (``\\x20``), classes, groups, alternatives and the repeats
``? * + {m} {m,} {m,n}``. A position automaton is determinised by subset construction over
classes of bytes that no pattern tells apart, and minimised by refining a partition.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEAD = 0


class _Builder:
    """Nondeterministic automaton; ``steps[s]`` = (mask of bytes, target), ``free[s]`` = targets."""

    def __init__(self) -> None:
        self.steps: list[tuple[int, int] | None] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append(None)
        self.free.append([])
        return len(self.steps) - 1

    def add(self, node: tuple, start: int) -> int:
        """Build ``node`` from ``start`` on; returns its end."""
        kind = node[0]
        if kind == "bytes":
            end = self.state()
            if self.steps[start] is not None or self.free[start]:
                fresh = self.state()
                self.free[start].append(fresh)
                start = fresh
            self.steps[start] = (node[1], end)
            return end
        if kind == "all":
            for part in node[1]:
                start = self.add(part, start)
            return start
        if kind == "any":
            end = self.state()
            for part in node[1]:
                begin = self.state()
                self.free[start].append(begin)
                self.free[self.add(part, begin)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop, end = self.state(), self.state()
            self.free[start].append(loop)
            begin = self.state()
            self.free[loop] += [begin, end]
            self.free[self.add(part, begin)].append(loop)
            return end
        end = self.state()
        for _ in range(most - least):
            self.free[start].append(end)
            begin = self.state()
            self.free[start].append(begin)
            start = self.add(part, begin)
        self.free[start].append(end)
        return end

    def closure(self, state: int) -> int:
        seen, stack = 1 << state, [state]
        while stack:
            for target in self.free[stack.pop()]:
                if not seen >> target & 1:
                    seen |= 1 << target
                    stack.append(target)
        return seen


class _Parser:
    def __init__(self, pattern: str, fold: bool):
        self.text, self.at, self.fold = pattern, 0, fold

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def either(self) -> tuple:
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("any", parts)

    def sequence(self) -> tuple:
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated(self.atom()))
        return ("all", parts)

    def repeated(self, node: tuple) -> tuple:
        sign = self.peek()
        if sign and sign in "?*+":
            self.take()
            return ("times", node, int(sign == "+"), 1 if sign == "?" else None)
        if sign == "{":
            stop = self.text.index("}", self.at)
            least, comma, most = self.text[self.at + 1 : stop].partition(",")
            self.at = stop + 1
            return ("times", node, int(least), int(most) if most else None if comma else int(least))
        return node

    def escaped(self) -> int:
        sign = self.take()
        if sign == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return {"n": 10, "r": 13, "t": 9}.get(sign, ord(sign))

    def byte(self) -> int:
        sign = self.take()
        return self.escaped() if sign == "\\" else ord(sign)

    def folded(self, values: set[int]) -> tuple:
        if self.fold:
            values |= {v ^ 32 for v in values if 65 <= v & ~32 <= 90}
        return ("bytes", sum(1 << v for v in values))

    def atom(self) -> tuple:
        if self.peek() == "(":
            self.take()
            node = self.either()
            self.take()
            return node
        if self.peek() != "[":
            return self.folded({self.byte()})
        self.take()
        inverse = self.peek() == "^"
        if inverse:
            self.take()
        values: set[int] = set()
        while self.peek() != "]":
            low = self.byte()
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                values |= set(range(low, self.byte() + 1))
            else:
                values.add(low)
        self.take()
        return self.folded(set(range(256)) - values if inverse else values)


@dataclass
class Automaton:
    """``step[state * width + classes[byte]]`` is the next state times ``width``; state 0 is
    dead. ``accepts[state]`` has bit ``i`` set where pattern ``i`` ends."""

    classes: np.ndarray
    width: int
    step: np.ndarray
    accepts: np.ndarray
    start: int
    used: np.ndarray

    def lists(self) -> tuple[list[int], list[int], list[int]]:
        """The same as lists, for byte by byte walks."""
        return self.classes.tolist(), self.step.tolist(), self.accepts.tolist()


def _minimal(step: np.ndarray, accepts: np.ndarray) -> np.ndarray:
    """Class of each state; states of a class accept alike and step to like classes."""
    _, group = np.unique(accepts, return_inverse=True)
    while True:
        key = np.column_stack([group, group[step]])
        _, finer = np.unique(key, axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == group.max():
            return finer
        group = finer


def compile_patterns(patterns: list[tuple[str, bool]], anchored: bool) -> Automaton:
    """One automaton of (pattern, whether letters of either case match). Unless ``anchored``,
    a match may begin at any byte."""
    build = _Builder()
    root = build.state()
    ends = []
    for pattern, fold in patterns:
        begin = build.state()
        build.free[root].append(begin)
        ends.append(build.add(_Parser(pattern, fold).either(), begin))
    masks = sorted({step[0] for step in build.steps if step})
    signature = [tuple(mask >> byte & 1 for mask in masks) for byte in range(256)]
    kinds = {key: number for number, key in enumerate(dict.fromkeys(signature))}
    classes = np.array([kinds[key] for key in signature])
    sample = {number: signature.index(key) for key, number in kinds.items()}
    closures = [build.closure(state) for state in range(len(build.steps))]
    # For each state and class of bytes: the states reached.
    moves = [
        {kind: closures[step[1]] for kind, byte in sample.items() if step[0] >> byte & 1} if step else None
        for step in build.steps
    ]
    begin = closures[root]
    numbers = {0: DEAD, begin: 1}
    order, rows = [0, begin], []
    for subset in order:
        reached = [0] * len(kinds)
        rest = subset
        while rest:
            low = rest & -rest
            rest ^= low
            for kind, targets in (moves[low.bit_length() - 1] or {}).items():
                reached[kind] |= targets
        row = []
        for targets in reached:
            if not anchored and subset:
                targets |= begin
            if targets not in numbers:
                numbers[targets] = len(order)
                order.append(targets)
            row.append(numbers[targets])
        rows.append(row)
    step = np.array(rows)
    accepts = np.array([sum(1 << i for i, end in enumerate(ends) if subset >> end & 1) for subset in order])
    group = _minimal(step, accepts)
    # Dead stays state 0.
    rank = np.full(group.max() + 1, -1)
    for number in [group[DEAD], *group]:
        if rank[number] < 0:
            rank[number] = rank.max() + 1
    group = rank[group]
    _, firsts = np.unique(group, return_index=True)
    width = len(kinds)
    used = np.zeros(256, bool)
    for mask in masks:
        used |= np.array([bool(mask >> byte & 1) for byte in range(256)])
    return Automaton(
        classes, width, (group[step[firsts]] * width).ravel(), accepts[firsts], int(group[1]) * width, used
    )
