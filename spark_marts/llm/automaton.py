"""Several regular expressions as one minimised deterministic automaton over bytes.

``Automaton(rules)`` parses each rule (literals, classes, groups, ``(?i:...)``, ``|``, ``? * + {m,n}``),
joins their Thompson automata and determinises them together. A state is a list of *threads*, oldest
first: the set of places that matches begun at one byte have reached. A place belongs to the oldest
thread that reaches it, and a match ends every younger thread of its rule, so each rule's matches come
out leftmost, longest and non-overlapping from a single pass. Which thread stems from which is kept
beside the transition; the start of a match is read back along the visited states.

``scan`` moves many stretches of a buffer at once, one table look-up per byte. A stretch begins behind
a byte that leads every state to the start state, so nothing is read twice.

Rules whose longest match would need reading on without a match (``ab(cd)*``), or that match nothing,
are refused with ``ValueError``.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np

ALL = (1 << 256) - 1
STRETCH, LONG = 512, 1 << 15
ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "f": "\f", "v": "\v"}


class Parser:
    """Recursive descent over a pattern; builds places ``arcs[place] = (byte set, next)`` and empty moves."""

    def __init__(self):
        self.arcs: list = []
        self.empty: list[list[int]] = []

    def place(self, arc=None) -> int:
        self.arcs.append(arc)
        self.empty.append([])
        return len(self.arcs) - 1

    def add(self, pattern: str) -> tuple[int, int]:
        self.p, self.at = pattern, 0
        tree = self.either(False)
        if self.at < len(pattern):
            raise ValueError(f"cannot read {pattern!r} at {self.at}")
        start = self.place()
        return start, self.build(tree, start)

    def peek(self, s: str) -> bool:
        return self.p.startswith(s, self.at)

    def either(self, fold: bool):
        ways = [self.row(fold)]
        while self.peek("|"):
            self.at += 1
            ways.append(self.row(fold))
        return ("either", ways)

    def row(self, fold: bool):
        parts = []
        while self.at < len(self.p) and self.p[self.at] not in "|)":
            part = self.one(fold)
            while m := re.compile(r"[?*+]|\{(\d+)(,?)(\d*)\}").match(self.p, self.at):
                self.at = m.end()
                if m[1]:
                    least, most = int(m[1]), int(m[3]) if m[3] else None if m[2] else int(m[1])
                else:
                    least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[m[0]]
                part = ("repeat", part, least, most)
            parts.append(part)
        return ("row", parts)

    def one(self, fold: bool):
        if self.peek("("):
            head = next(h for h in ("(?i:", "(?:", "(") if self.peek(h))
            self.at += len(head)
            tree = self.either(fold or head == "(?i:")
            if not self.peek(")"):
                raise ValueError(f"no ) in {self.p!r}")
            self.at += 1
            return tree
        if self.peek("["):
            self.at += 1
            inverse = self.peek("^")
            self.at += inverse
            found = 0
            while not self.peek("]"):
                low = high = self.byte()
                if self.peek("-") and self.p[self.at + 1 : self.at + 2] != "]":
                    self.at += 1
                    high = self.byte()
                for b in range(low, high + 1):
                    found |= 1 << b
            self.at += 1
            return ("set", ALL & ~found if inverse else self.folded(found) if fold else found)
        return ("set", self.folded(1 << self.byte()) if fold else 1 << self.byte())

    def byte(self) -> int:
        if self.at >= len(self.p):
            raise ValueError(f"{self.p!r} ends early")
        c = self.p[self.at]
        self.at += 1
        if c == "\\":
            c = self.p[self.at]
            self.at += 1
            if c == "x":
                self.at += 2
                return int(self.p[self.at - 2 : self.at], 16)
            c = ESCAPES.get(c, c)
        if ord(c) > 127:
            raise ValueError("rules are ASCII")
        return ord(c)

    @staticmethod
    def folded(found: int) -> int:
        for b in range(65, 91):
            if found >> b & 1 or found >> (b + 32) & 1:
                found |= 1 << b | 1 << (b + 32)
        return found

    def build(self, tree, at: int) -> int:
        kind = tree[0]
        if kind == "set":
            end = self.place()
            mid = self.place((tree[1], end))
            self.empty[at].append(mid)
            return end
        if kind == "row":
            for part in tree[1]:
                at = self.build(part, at)
            return at
        if kind == "either":
            end = self.place()
            for way in tree[1]:
                begin = self.place()
                self.empty[at].append(begin)
                self.empty[self.build(way, begin)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            at = self.build(part, at)
        if most is None:
            loop = self.place()
            self.empty[at].append(loop)
            self.empty[self.build(part, loop)].append(loop)
            return loop
        ends = [at]
        for _ in range(most - least):
            at = self.build(part, at)
            ends.append(at)
        end = self.place()
        for e in ends:
            self.empty[e].append(end)
        return end


class Automaton:
    """``rules``: patterns in order. ``table[state * classes + class of byte]`` is the next state.

    Rules in ``runs`` open a thread only while they have none. That changes nothing for runs of one
    class of bytes (``[0-9]{8,}``), which else would have a thread open for each byte of the run.
    """

    def __init__(self, rules: list[str], runs: tuple[int, ...] = ()):
        nfa, starts, self.rule_of_end, rule_of = Parser(), [], {}, {}
        for r, pattern in enumerate(rules):
            first = len(nfa.arcs)
            start, end = nfa.add(pattern)
            starts.append(start)
            self.rule_of_end[end] = r
            rule_of.update(dict.fromkeys(range(first, len(nfa.arcs)), r))
        sets = sorted({arc[0] for arc in nfa.arcs if arc})
        kinds: dict = {}
        self.class_of = np.array([kinds.setdefault(tuple(s >> b & 1 for s in sets), len(kinds)) for b in range(256)], np.uint8)
        sample = [int(np.flatnonzero(self.class_of == c)[0]) for c in range(len(kinds))]
        self.classes = len(sample)
        reached: dict[int, frozenset] = {}

        def closure(place: int) -> frozenset:
            if place not in reached:
                seen, todo = {place}, [place]
                while todo:
                    for p in nfa.empty[todo.pop()]:
                        if p not in seen:
                            seen.add(p)
                            todo.append(p)
                reached[place] = frozenset(p for p in seen if nfa.arcs[p] or p in self.rule_of_end)
            return reached[place]

        fresh = frozenset().union(*(closure(s) for s in starts))
        if fresh & self.rule_of_end.keys():
            raise ValueError("a rule matches the empty string")

        ends = frozenset(self.rule_of_end)

        def ended(thread) -> set:
            return {self.rule_of_end[p] for p in thread & ends}

        @cache
        def moved(thread: frozenset, byte: int) -> frozenset:
            return frozenset().union(*(closure(nfa.arcs[p][1]) for p in thread if nfa.arcs[p] and nfa.arcs[p][0] >> byte & 1))

        alone = frozenset(p for p, r in rule_of.items() if r in runs)

        @cache
        def opened(state: tuple) -> frozenset:
            held = {rule_of[p] for thread in state for p in thread & alone}
            return frozenset(p for p in fresh if rule_of[p] not in held)

        def step(state: tuple, byte: int) -> tuple[tuple, tuple, tuple]:
            threads, seen = [], set()
            for k, old in enumerate((*state, opened(state))):
                new = moved(old, byte) - seen
                seen |= new
                threads.append([k if k < len(state) else -1, new])
            for i, (_, thread) in enumerate(threads):
                for r in ended(thread):
                    if any(rule_of[p] == r for _, older in threads[:i] for p in older):
                        raise ValueError(f"rule {r} can match inside a match that is still open")
                    for younger in threads[i + 1 :]:
                        younger[1] = frozenset(p for p in younger[1] if rule_of[p] != r)
            done = []
            for k, old in enumerate(state):
                new = threads[k][1]
                for r in ended(old) - ended(new):
                    if any(rule_of[p] == r for p in new):
                        raise ValueError(f"rule {r} reads on behind a match without matching")
                    done.append((r, k))
            threads = [(k, t) for k, t in threads if t]
            return tuple(t for _, t in threads), tuple(k for k, _ in threads), tuple(done)

        number, states, rows = {(): 0}, [()], []
        for state in states:  # grows while it is read
            row = []
            for byte in sample:
                new, came, done = step(state, byte)
                if new not in number:
                    number[new] = len(states)
                    states.append(new)
                row.append((number[new], came, done))
            rows.append(row)
        self.states_before = len(states)
        self.minimise(rows)

    def minimise(self, rows: list) -> None:
        """Moore: states part by what their transitions report, then by the parts these lead to."""
        target = np.array([[x[0] for x in row] for row in rows])
        kinds: dict = {}
        label = np.array([kinds.setdefault(tuple(x[1:] for x in row), len(kinds)) for row in rows])
        parts = 0
        while len(kinds) > parts:
            parts, kinds = len(kinds), {}
            label = np.array([kinds.setdefault(row.tobytes(), len(kinds)) for row in np.column_stack([label, label[target]])])
        keep = np.unique(label, return_index=True)[1]  # labels count from the start state, 0, on
        self.states = len(keep)
        self.table = label[target[keep]].reshape(-1).astype(np.int32)
        reports = list(dict.fromkeys(x[1:] for s in keep for x in rows[s]))
        place = {x: i for i, x in enumerate(reports)}
        self.came = [came for came, _ in reports]
        self.done = [done for _, done in reports]
        self.report = np.array([place[x[1:]] for s in keep for x in rows[s]], np.int32)  # of each transition
        self.ends = np.array([bool(done) for done in self.done])[self.report]
        self.resets = (self.table.reshape(self.states, -1) == 0).all(axis=0)
        if not self.resets[self.class_of[255]]:
            raise ValueError("byte 255 must end every match")

    def scan(self, data: np.ndarray):
        """``(rule, start, end)`` of every match in a buffer whose last byte is 255, in order of their ends."""
        kind = self.class_of[data]
        n, width = len(data), self.classes
        resets = np.flatnonzero(self.resets[kind])
        at = resets[np.searchsorted(resets, np.arange(STRETCH, n, STRETCH))] + 1
        starts = np.unique(np.append(0, at[at < n]))
        sizes = np.diff(np.append(starts, n))
        steps = np.empty(n, np.int32)  # the transition taken at each byte
        for i in np.flatnonzero(sizes > LONG):
            steps[starts[i] : starts[i] + sizes[i]] = self.alone(kind[starts[i] : starts[i] + sizes[i]])
        starts, sizes = starts[sizes <= LONG], sizes[sizes <= LONG]
        by = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[by], sizes[by]
        state = np.zeros(len(starts), np.int32)
        active = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")
        for j, m in enumerate(active.tolist()):
            here = starts[:m] + j
            step = state[:m] * width + kind[here]
            steps[here] = step
            state = self.table[step]
        for p in np.flatnonzero(self.ends[steps]).tolist():
            for rule, thread in self.done[self.report[steps[p]]]:
                start = p
                while thread >= 0:
                    start -= 1
                    thread = self.came[self.report[steps[start]]][thread]
                yield rule, start, p

    def alone(self, kind: np.ndarray) -> list:
        """Transitions of one long stretch."""
        table, width, state, out = self.table.tolist(), self.classes, 0, []
        for k in kind.tolist():
            step = state * width + k
            out.append(step)
            state = table[step]
        return out
