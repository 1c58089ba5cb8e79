"""Regular expressions over bytes as one minimal deterministic automaton.

The dialect: literals, ``\\xHH`` and escaped punctuation, classes, groups, ``|``, ``* + ?`` and ``{m,n}``.
Rules become an NFA by Thompson's construction, a DFA by subset construction, and the smallest such
DFA by partition refinement. ``Scanner`` runs the reversed rules over the reversed text, which finds
in one pass, for all rules at once, every place where some match starts; the longest match from a
start then comes from the rule's own anchored automaton.
"""

from __future__ import annotations

from dataclasses import dataclass

_ALL = frozenset(range(256))


class _Parser:
    def __init__(self, pattern: str, fold: bool):
        self.s, self.i, self.fold = pattern, 0, fold

    def more(self) -> bool:
        return self.i < len(self.s)

    def take(self) -> str:
        self.i += 1
        return self.s[self.i - 1]

    def union(self):
        arms = [self.sequence()]
        while self.more() and self.s[self.i] == "|":
            self.i += 1
            arms.append(self.sequence())
        return arms[0] if len(arms) == 1 else ("or", arms)

    def sequence(self):
        parts = []
        while self.more() and self.s[self.i] not in "|)":
            parts.append(self.repeated())
        return ("seq", parts)

    def repeated(self):
        node = self.atom()
        while self.more() and self.s[self.i] in "*+?{":
            c = self.take()
            if c == "{":
                end = self.s.index("}", self.i)
                low, comma, high = self.s[self.i : end].partition(",")
                self.i = end + 1
                bounds = (int(low), int(high) if high else None if comma else int(low))
            else:
                bounds = {"*": (0, None), "+": (1, None), "?": (0, 1)}[c]
            node = ("rep", node, *bounds)
        return node

    def escape(self) -> int:
        c = self.take()
        if c == "x":
            self.i += 2
            return int(self.s[self.i - 2 : self.i], 16)
        if c.isalnum():
            raise ValueError(f"escape \\{c} is not of this dialect")
        return ord(c)

    def one(self) -> int:
        c = self.take()
        return self.escape() if c == "\\" else ord(c)

    def folded(self, values: set[int]) -> frozenset[int]:
        if self.fold:
            values |= {ord(f(chr(v))) for v in list(values) if chr(v).isascii() and chr(v).isalpha() for f in (str.lower, str.upper)}
        return frozenset(values)

    def atom(self):
        c = self.take()
        if c == "(":
            node = self.union()
            assert self.take() == ")"
            return node
        if c == ".":
            return ("set", _ALL)
        if c != "[":
            self.i -= 1
            return ("set", self.folded({self.one()}))
        negated = self.s[self.i] == "^"
        self.i += negated
        values: set[int] = set()
        while self.s[self.i] != "]":
            low = high = self.one()
            if self.s[self.i] == "-" and self.s[self.i + 1] != "]":
                self.i += 1
                high = self.one()
            values |= set(range(low, high + 1))
        self.i += 1
        return ("set", _ALL - self.folded(values) if negated else self.folded(values))


def _reverse(node):
    kind = node[0]
    if kind == "set":
        return node
    if kind == "or":
        return ("or", [_reverse(x) for x in node[1]])
    if kind == "seq":
        return ("seq", [_reverse(x) for x in reversed(node[1])])
    return ("rep", _reverse(node[1]), *node[2:])


class _Nfa:
    """Thompson's construction: edges[s] = [(byte set, target)], empty[s] = targets without a byte."""

    def __init__(self):
        self.edges: list[list] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def add(self, node, at: int) -> int:
        """The state reached from ``at`` by node."""
        kind = node[0]
        if kind == "set":
            to = self.state()
            self.edges[at].append((node[1], to))
            return to
        if kind == "seq":
            for x in node[1]:
                at = self.add(x, at)
            return at
        if kind == "or":
            to = self.state()
            for x in node[1]:
                begin = self.state()
                self.empty[at].append(begin)
                self.empty[self.add(x, begin)].append(to)
            return to
        _, inner, low, high = node
        for _ in range(low):
            at = self.add(inner, at)
        if high is None:
            loop = self.state()
            self.empty[at].append(loop)
            self.empty[self.add(inner, loop)].append(loop)
            return loop
        ends = [at]
        for _ in range(high - low):
            at = self.add(inner, at)
            ends.append(at)
        to = self.state()
        for x in ends:
            self.empty[x].append(to)
        return to

    def closure(self, states) -> frozenset[int]:
        found, stack = set(states), list(states)
        while stack:
            for t in self.empty[stack.pop()]:
                if t not in found:
                    found.add(t)
                    stack.append(t)
        return frozenset(found)


@dataclass
class Dfa:
    """table[state * 256 + byte] is the next state times 256; states from ``accepting`` on accept the rules in masks."""

    table: list[int]
    masks: list[int]
    start: int
    accepting: int


def compile_rules(patterns: list[tuple[str, bool]], reverse: bool = False, anywhere: bool = False) -> Dfa:
    """One minimal automaton for all (pattern, fold case) rules; a state's mask has a bit for each rule that it accepts."""
    nfa = _Nfa()
    root = nfa.state()
    if anywhere:
        nfa.edges[root].append((_ALL, root))
    final: dict[int, int] = {}
    for k, (pattern, fold) in enumerate(patterns):
        parser = _Parser(pattern, fold)
        node = parser.union()
        assert not parser.more(), f"unread: {pattern[parser.i:]}"
        begin = nfa.state()
        nfa.empty[root].append(begin)
        final[nfa.add(_reverse(node) if reverse else node, begin)] = 1 << k
    # Bytes that no rule tells apart share a class.
    sets = list({s for edges in nfa.edges for s, _ in edges})
    by_kind: dict[tuple, list[int]] = {}
    for b in range(256):
        by_kind.setdefault(tuple(b in s for s in sets), []).append(b)
    classes = list(by_kind.values())
    # Subset construction.
    first = nfa.closure([root])
    number, rows, todo = {first: 0}, [], [first]
    while todo:
        states = todo.pop(0)
        row = []
        for c in classes:
            to = nfa.closure({t for s in states for on, t in nfa.edges[s] if c[0] in on})
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        rows.append(row)
    masks = [0] * len(number)
    for states, k in number.items():
        for s in states:
            masks[k] |= final.get(s, 0)
    # Minimisation: blocks are split until equal states have equal successors.
    block = [sorted(set(masks)).index(m) for m in masks]
    while True:
        keys = [(block[k], *[block[t] for t in rows[k]]) for k in range(len(rows))]
        order = {key: i for i, key in enumerate(dict.fromkeys(keys))}
        new = [order[key] for key in keys]
        if len(order) == len(set(block)):
            break
        block = new
    count = len(set(block))
    sample = {b: k for k, b in reversed(list(enumerate(block)))}
    ranked = sorted(range(count), key=lambda b: (masks[sample[b]] != 0, b))
    place = {b: i for i, b in enumerate(ranked)}
    table = [0] * (count * 256)
    for b, i in place.items():
        for c, t in zip(classes, rows[sample[b]]):
            for byte in c:
                table[i * 256 + byte] = place[block[t]] * 256
    out_masks = [masks[sample[b]] for b in ranked]
    accepting = next((i for i, m in enumerate(out_masks) if m), count)
    return Dfa(table, out_masks, place[block[0]] * 256, accepting * 256)


class Scanner:
    """Leftmost-longest, non-overlapping matches of every rule, each rule on its own.

    A rule is a pattern and the pattern of those matches that are kept. Both are accepted by the states of
    the rule's one automaton: a match that isn't kept still takes its place from later ones.
    """

    def __init__(self, patterns: list[tuple[str, str]]):
        self.starts = compile_rules([(p, False) for p, _ in patterns], reverse=True, anywhere=True)
        self.rules = [compile_rules([(p, False), (keep or p, False)]) for p, keep in patterns]
        self.dead = [next((s * 256 for s in range(len(d.masks)) if not d.masks[s] and set(d.table[s * 256 : s * 256 + 256]) == {s * 256}), -1) for d in self.rules]

    def longest(self, rule: int, data: bytes, at: int) -> tuple[int, bool]:
        """The end of the longest match of the rule that starts at ``at``, and whether it is kept."""
        dfa = self.rules[rule]
        table, accepting, state, end, last, dead = dfa.table, dfa.accepting, dfa.start, -1, 0, self.dead[rule]
        for i in range(at, len(data)):
            state = table[state + data[i]]
            if state >= accepting:
                end, last = i + 1, state
            elif state == dead:
                break
        return end, bool(dfa.masks[last >> 8] & 2)

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule, start, end) in bytes of the matches that are kept, by rule and start."""
        table, state, accepting = self.starts.table, self.starts.start, self.starts.accepting
        hits = []
        for i, byte in enumerate(data[::-1]):
            state = table[state + byte]
            if state >= accepting:
                hits.append((i, state))
        if not hits:
            return []
        out, n, masks = [], len(data), self.starts.masks
        hits = [(n - 1 - i, masks[s >> 8]) for i, s in reversed(hits)]
        for rule in range(len(self.rules)):
            done = 0
            for at, mask in hits:
                if mask >> rule & 1 and at >= done:
                    done, kept = self.longest(rule, data, at)
                    if kept:
                        out.append((rule, at, done))
        return out
