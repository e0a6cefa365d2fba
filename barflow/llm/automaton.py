"""Regular expressions over bytes compiled into one minimal deterministic automaton.

Supported syntax: literals, ``\\xHH`` and backslash escapes, classes, groups,
``|``, ``?``, ``*``, ``+``, ``{m}``, ``{m,}`` and ``{m,n}``. The steps are the
textbook ones: Thompson construction per rule, subset construction over all
rules together, then minimisation by partition refinement. The result is a
transition array over byte classes, plus a bit mask of rules for each state.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class _Parser:
    """Recursive descent over the pattern; nodes are nested tuples."""

    def __init__(self, pattern: str):
        self.p, self.i = pattern, 0

    def peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def alternation(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return ("alt", options) if len(options) > 1 else options[0]

    def sequence(self):
        items = []
        while self.peek() and self.peek() not in "|)":
            items.append(self.repeated())
        return ("seq", items)

    def repeated(self):
        node = self.atom()
        while self.peek() and self.peek() in "?*+{":
            op = self.take()
            if op == "{":
                close = self.p.index("}", self.i)
                low, comma, high = self.p[self.i:close].partition(",")
                self.i = close + 1
                lo, hi = int(low), (int(high) if high else None) if comma else int(low)
            else:
                lo, hi = {"?": (0, 1), "*": (0, None), "+": (1, None)}[op]
            node = ("rep", node, lo, hi)
        return node

    def atom(self):
        c = self.take()
        if c == "(":
            node = self.alternation()
            if self.take() != ")":
                raise ValueError(f"unclosed group in {self.p!r}")
            return node
        if c == "[":
            return ("set", self.char_class())
        if c == "\\":
            return ("set", frozenset([self.escaped()]))
        if c in ".^$":
            raise ValueError(f"{c!r} is not supported")
        return ("set", frozenset([ord(c)]))

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2:self.i], 16)
        return ord(c)

    def char_class(self) -> frozenset[int]:
        out: set[int] = set()
        while self.peek() != "]":
            c = self.take()
            low = self.escaped() if c == "\\" else ord(c)
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.take()
                c = self.take()
                high = self.escaped() if c == "\\" else ord(c)
                out.update(range(low, high + 1))
            else:
                out.add(low)
        self.take()
        return frozenset(out)


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.step: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.step.append(None)
        return len(self.empty) - 1

    def add(self, node, start: int, reverse: bool) -> int:
        """States for ``node`` from ``start`` on; returns the end state."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            fresh = self.state()
            self.empty[start].append(fresh)
            self.step[fresh] = (node[1], end)
            return end
        if kind == "seq":
            for item in (reversed(node[1]) if reverse else node[1]):
                start = self.add(item, start, reverse)
            return start
        if kind == "alt":
            end = self.state()
            for option in node[1]:
                fresh = self.state()
                self.empty[start].append(fresh)
                self.empty[self.add(option, fresh, reverse)].append(end)
            return end
        _, inner, low, high = node
        for _ in range(low):
            start = self.add(inner, start, reverse)
        if high is None:
            loop, end = self.state(), self.state()
            self.empty[start].append(loop)
            self.empty[self.add(inner, loop, reverse)].append(loop)
            self.empty[loop].append(end)
            return end
        end = self.state()
        self.empty[start].append(end)
        for _ in range(high - low):
            start = self.add(inner, start, reverse)
            self.empty[start].append(end)
        return end


@dataclass(frozen=True)
class Automaton:
    """``table[state, byte]`` is the next state; ``accepts[state]`` the bits of rules that end there."""

    table: np.ndarray
    accepts: np.ndarray
    start: int

    @property
    def states(self) -> int:
        return len(self.accepts)


def compile_rules(patterns: list[str], search: bool = True, reverse: bool = False) -> Automaton:
    """One minimal automaton for all patterns.

    ``search``: a match may begin at any byte. ``reverse``: it reads matches from
    their last byte to their first.
    """
    nfa = _Nfa()
    root, finals = nfa.state(), {}
    for k, pattern in enumerate(patterns):
        parser = _Parser(pattern)
        node = parser.alternation()
        if parser.peek():
            raise ValueError(f"unbalanced {pattern!r}")
        first = nfa.state()
        nfa.empty[root].append(first)
        finals[nfa.add(node, first, reverse)] = 1 << k

    def closure(states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for x in nfa.empty[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(x for x in seen if nfa.step[x] or x in finals)

    symbol_of = _byte_classes([s[0] for s in nfa.step if s])
    n_symbols = int(symbol_of.max()) + 1
    sample = [int(np.flatnonzero(symbol_of == k)[0]) for k in range(n_symbols)]
    begin = closure([root])
    number, rows, todo = {begin: 0}, [], [begin]
    for current in todo:
        row = []
        for byte in sample:
            into = [nfa.step[x][1] for x in current if nfa.step[x] and byte in nfa.step[x][0]]
            target = closure([*into, root] if search else into)
            if target not in number:
                number[target] = len(number)
                todo.append(target)
            row.append(number[target])
        rows.append(row)
    moves = np.array(rows, dtype=np.int64)
    accepts = np.array([sum({finals[x] for x in s if x in finals}) for s in todo], dtype=np.int64)
    part = _minimise(moves, accepts)
    chosen = np.unique(part, return_index=True)[1]
    table = part[moves[chosen]][:, symbol_of].astype(np.int32)
    return Automaton(np.ascontiguousarray(table), accepts[chosen], int(part[0]))


def _byte_classes(sets: list[frozenset[int]]) -> np.ndarray:
    """Bytes that no set tells apart get the same number."""
    signs: dict[tuple, int] = {}
    distinct = list(dict.fromkeys(sets))
    return np.array([signs.setdefault(tuple(b in s for s in distinct), len(signs)) for b in range(256)])


def _minimise(moves: np.ndarray, accepts: np.ndarray) -> np.ndarray:
    """Block number of each state of the coarsest partition that transitions respect."""
    part = np.unique(accepts, return_inverse=True)[1]
    while True:
        signature = np.column_stack([part, part[moves]])
        finer = np.unique(signature, axis=0, return_inverse=True)[1].ravel()
        if finer.max() == part.max():
            return part
        part = finer


def run_segments(auto: Automaton, raw: np.ndarray, width: int = 2048) -> np.ndarray:
    """The state after each byte of ``raw``, read from the start state.

    The bytes are cut into ``width`` segments that advance together, each from the
    start state; then a segment whose true entry state differs is read again until
    both runs meet, so the result is that of one pass from left to right.
    """
    n = len(raw)
    flat = auto.table.ravel()
    length = -(-n // max(1, min(width, n // 16 or 1)))
    lanes = -(-n // length)
    padded = np.zeros(lanes * length, dtype=np.uint8)
    padded[:n] = raw
    columns = np.ascontiguousarray(padded.reshape(lanes, length).T)
    states = np.empty((length, lanes), dtype=np.int32)
    now = np.full(lanes, auto.start, dtype=np.int32)
    for t in range(length):
        now = flat[(now << 8) + columns[t]]
        states[t] = now
    out = np.ascontiguousarray(states.T).ravel()[:n]
    for lane in range(1, lanes):
        i = lane * length
        state, stop = int(out[i - 1]), min(n, i + length)
        if state == auto.start:
            continue
        while i < stop:
            state = int(flat[(state << 8) + int(raw[i])])
            if state == out[i]:
                break
            out[i] = state
            i += 1
    return out
