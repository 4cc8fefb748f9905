"""Minimum-cost repair of symbol sequences by a generalised LR parser.

An SLR automaton is built from the grammar.  Its stacks form a graph: nodes are interned
by (state, node below), so stacks share what they have in common.  A frontier holds the
tops that are alive after a row, the cheapest of each state: each row is kept, deleted or
given another role, and symbols may be inserted before it, and of equal stack tops the
one with the least (cost, audit) stays.  Merging by the top's state is exact for the role
grammar, as what may follow depends on that state alone.

An audit is the string of the edits' initials.  The audits of a frontier's tops all have
one D, K or R a row and end in one, so none is the beginning of another, and a frontier
only keeps their order, not their text: (order of the audit before, new letters) decides.
A step then depends on the frontier, relative costs and the row's kind only, and is looked
up the second time; the letters come from the steps, walked backwards.

An insertion before a deletion could follow it at the same cost with a smaller audit, so
only kept and reroled rows are preceded by insertions, and the end.  A top that costs more
than ``_WIDEST`` over the cheapest cannot win: two insertions bring the cheapest to any
point inside the pairs, and what that top alone could take up is one system row.
"""

from __future__ import annotations

from typing import NamedTuple

ROLE_GRAMMAR = (("S", ()), ("S", ("T",)), ("S", ("s", "T")), ("T", ("P",)), ("T", ("T", "P")), ("P", ("u", "a")))
ROLE_NAMES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
_WIDEST = 16
FORCED = None        # the kind of a row that has to be deleted


class Node:
    """A stack: the top's state and the stack below."""

    __slots__ = ("state", "below")

    def __init__(self, state: int, below: Node | None):
        self.state, self.below = state, below


class Run(NamedTuple):
    """Tops in the order of their audits, with costs over ``cost``, and the steps."""
    tops: tuple
    cost: int
    steps: list


class RepairParser:
    def __init__(self, grammar=ROLE_GRAMMAR, names=None):
        self.names = ROLE_NAMES if names is None else names
        self.rules = [("", (grammar[0][0],)), *grammar]
        self.heads = {h for h, _ in grammar}
        self._tables()
        self._nodes: dict = {}
        self._steps: dict = {}
        self.root = self._node(0, None)
        self.starts = {}                # a stack for each state that can be a top
        todo = [self.root]
        while todo:
            node = todo.pop()
            if node.state not in self.starts:
                self.starts[node.state] = node
                todo += [n for t in sorted(self.terminals) for n in self.advance(node, t)]

    # ---- the automaton
    def _closure(self, items: frozenset) -> frozenset:
        items = set(items)
        grown = True
        while grown:
            heads = {self.rules[r][1][d] for r, d in items if d < len(self.rules[r][1])}
            more = {(r, 0) for r, (h, _) in enumerate(self.rules) if h in heads} - items
            items |= more
            grown = bool(more)
        return frozenset(items)

    def _follow(self) -> dict:
        empty: set = set()
        first: dict = {h: set() for h in self.heads}
        follow: dict = {h: set() for h in [*self.heads, ""]}
        follow[""].add("$")
        starts = lambda x: first[x] if x in self.heads else {x}
        while True:
            size = (len(empty), sum(map(len, first.values())), sum(map(len, follow.values())))
            for head, body in self.rules:
                if head and all(x in empty for x in body):
                    empty.add(head)
                for k, x in enumerate(body):
                    if head and all(y in empty for y in body[:k]):
                        first[head] |= starts(x)
                    if x in self.heads:
                        rest = body[k + 1:]
                        for j, y in enumerate(rest):
                            if all(z in empty for z in rest[:j]):
                                follow[x] |= starts(y)
                        if all(y in empty for y in rest):
                            follow[x] |= follow[head]
            if size == (len(empty), sum(map(len, first.values())), sum(map(len, follow.values()))):
                return follow

    def _tables(self) -> None:
        self.terminals = {x for _, body in self.rules for x in body if x not in self.heads}
        follow = self._follow()
        states = [self._closure(frozenset({(0, 0)}))]
        self.actions, self.goto = [], []
        for items in states:               # grows while it is read
            actions: dict = {}
            goto: dict = {}
            for x in sorted({self.rules[r][1][d] for r, d in items if d < len(self.rules[r][1])}):
                nxt = self._closure(frozenset((r, d + 1) for r, d in items if self.rules[r][1][d:d + 1] == (x,)))
                if nxt not in states:
                    states.append(nxt)
                if x in self.heads:
                    goto[x] = states.index(nxt)
                else:
                    actions.setdefault(x, []).append(("shift", states.index(nxt)))
            for r, d in sorted(items):
                if d == len(self.rules[r][1]):
                    for t in follow[self.rules[r][0]]:
                        actions.setdefault(t, []).append(("reduce", r))
            self.actions.append(actions)
            self.goto.append(goto)

    # ---- the stacks
    def _node(self, state: int, below: Node | None) -> Node:
        got = self._nodes.get((state, below))
        if got is None:
            got = self._nodes[state, below] = Node(state, below)
        return got

    def advance(self, node: Node, terminal: str) -> list[Node]:
        """The stacks after ``terminal``; for the end, the stacks that accept."""
        out, todo = [], [node]
        while todo:
            node = todo.pop()
            for what, x in self.actions[node.state].get(terminal, ()):
                if what == "shift":
                    out.append(self._node(x, node))
                elif x == 0:
                    out.append(node)
                else:
                    head, body = self.rules[x]
                    below = node
                    for _ in body:
                        below = below.below
                    todo.append(self._node(self.goto[below.state][head], below))
        return out

    # ---- repairing
    def _inserted(self, frontier: tuple) -> list[tuple]:
        """(cost, order, insertions, node): the tops after any insertions, the least of each state."""
        best = {node.state: (cost, k, 0, node) for k, (node, cost) in enumerate(frontier)}
        todo = list(best.values())
        while todo:
            cost, k, n, node = todo.pop(0)
            for t in self.names:
                for nxt in self.advance(node, t):
                    new = (cost + INSERT, k, n + 1, nxt)
                    if nxt.state not in best or new[:3] < best[nxt.state][:3]:
                        best[nxt.state] = new
                        todo.append(new)
        return list(best.values())

    def _step(self, frontier: tuple, kind: tuple) -> tuple:
        initial, late = kind[0], TRUNCATED if kind[1] else 0
        found = [(cost + DELETE, k, "D", node) for k, (node, cost) in enumerate(frontier)]
        for cost, k, n, node in self._inserted(frontier):
            if initial in self.terminals:
                found += [(cost + late, k, "I" * n + "K", nxt) for nxt in self.advance(node, initial)]
            found += [(cost + late + REROLE, k, "I" * n + "R", nxt) for t in self.names for nxt in self.advance(node, t)]
        best: dict = {}
        for x in found:
            if x[3].state not in best or x[:3] < best[x[3].state][:3]:
                best[x[3].state] = x
        low = min(x[0] for x in best.values())
        kept = sorted((x for x in best.values() if x[0] - low <= _WIDEST), key=lambda x: x[1:3])
        return tuple((x[3], x[0] - low) for x in kept), low, tuple(x[1:3] for x in kept)

    def run(self, kinds: list, start: int = 0) -> Run:
        """Rows as (kind, times): kind is (initial, truncated), or FORCED; from a top's state."""
        frontier, cost, steps = ((self.starts[start], 0),), 0, []
        for kind, times in kinds:
            if kind is FORCED:
                cost += DELETE * times
                steps.append(times)
                continue
            got = self._steps.get((frontier, kind))
            if got is None:
                got = self._steps[frontier, kind] = self._step(frontier, kind)
            frontier = got[0]
            cost += got[1]
            steps.append(got[2])
        return Run(frontier, cost, steps)

    def ending(self, state: int) -> int:
        """Insertions that a top of this state needs before the end."""
        nodes, n = [self.starts[state]], 0
        while not any(self.advance(x, "$") for x in nodes):
            nodes, n = [y for x in nodes for t in self.names for y in self.advance(x, t)], n + 1
        return n

    def best(self, tops: list[tuple[int, int]]) -> tuple[int, int, int]:
        """(cost, order, insertions at the end) of the best of (state, cost) in the audits' order."""
        return min((cost + INSERT * self.ending(state), k, self.ending(state)) for k, (state, cost) in enumerate(tops))

    @staticmethod
    def audit(run: Run, order: int) -> str:
        """Letters of one of the run's tops."""
        out = []
        for step in reversed(run.steps):
            if isinstance(step, int):
                out.append("D" * step)
            else:
                order, letters = step[order]
                out.append(letters)
        return "".join(reversed(out))

    def apply(self, audit: str, rows, start: int = 0) -> list[tuple[str, str]]:
        """Repaired (role, text) of ``rows`` (role, text, copies) by an audit."""
        node, out, at = self.starts[start], [], 0

        def expected():
            return next((t, nodes[0]) for t in self.names if (nodes := self.advance(node, t)))

        def inserts(at, node):
            return at < len(audit) and audit[at] == "I"

        for role, text, copies in rows:
            while inserts(at, node):
                t, node = expected()
                out.append((self.names[t], ""))
                at += 1
            if audit[at] == "K":
                node = self.advance(node, role[:1])[0]
                out.append((role, text))
            elif audit[at] == "R":
                t, node = expected()
                out.append((self.names[t], text))
            at += copies                    # further copies are deleted
        while inserts(at, node):
            t, node = expected()
            out.append((self.names[t], ""))
            at += 1
        return out
