"""Minimised acyclic acceptors, and their composition with a transducer of exactly one edit.

``near_pairs`` walks acceptor x one-edit transducer x acceptor depth first. The transducer copies
symbols, then replaces one or inserts one, then copies again. A replacement goes to the larger
symbol, and an insertion is not followed by a copy of its own symbol, so each unordered
pair has one accepting path. Only states from which the rest of the first string can end are
entered. Walks hold a stack, not Python frames: strings may be long.
"""

from __future__ import annotations

from collections.abc import Iterator


class Acceptor:
    """The least deterministic automaton of sorted distinct strings: by state its arcs and the lengths of what it accepts."""

    def __init__(self, strings: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.rests: list[set[int]] = []
        known: dict[tuple, int] = {}

        def settle(arcs: dict[str, int], final: bool) -> int:
            name = (final, *arcs.items())
            if name not in known:
                known[name] = len(self.arcs)
                self.arcs.append(arcs)
                rests = {k + 1 for to in arcs.values() for k in self.rests[to]}
                self.rests.append(rests | {0} if final else rests)
            return known[name]

        # The path of the string last added: its states are open, all others are settled.
        path: list[tuple[dict[str, int], bool]] = [({}, False)]
        last = ""
        for text in strings:
            same, most = 0, min(len(text), len(last))
            while same < most and text[same] == last[same]:
                same += 1
            for i in range(len(last), same, -1):
                arcs, final = path.pop()
                path[-1][0][last[i - 1]] = settle(arcs, final)
            path += [({}, False) for _ in range(len(text) - same)]
            path[-1] = (path[-1][0], True)
            last = text
        for i in range(len(last), 0, -1):
            arcs, final = path.pop()
            path[-1][0][last[i - 1]] = settle(arcs, final)
        self.start = settle(*path[0])


COPY, EDITED, INSERTED = 0, 1, 2


def near_pairs(acceptor: Acceptor, size: int, open_end: bool) -> Iterator[tuple[str, str]]:
    """All pairs of accepted strings with one replacement or insertion between them, the first of length ``size``, each once.

    The first of a pair is the shorter one, or has the smaller symbol. Without ``open_end`` an
    inserted symbol must be followed by a copied one.
    """
    arcs, rests = acceptor.arcs, acceptor.rests
    one: list[str] = []
    two: list[str] = []
    # Transducer's state, both acceptors' states, the lengths before, the symbols read and written.
    stack = [(COPY, acceptor.start, acceptor.start, 0, 0, "", "")]
    while stack:
        mode, p, q, before, there, a, b = stack.pop()
        del one[before:], two[there:]
        if a:
            one.append(a)
        if b:
            two.append(b)
        m, n = len(one), len(two)
        rest = size - m
        if mode == COPY:
            out = list(arcs[p].items())
            longer = rest + 1 in rests[p]
            for i, (c, to) in enumerate(out):
                if longer and rest in rests[to] and rest in rests[p]:
                    stack.append((INSERTED, p, to, m, n, "", c))
                if rest - 1 in rests[to]:
                    stack.append((COPY, to, to, m, n, c, c))
                    stack += [(EDITED, to, other, m, n, c, d) for d, other in out[i + 1 :] if rest - 1 in rests[other]]
        elif rest:
            banned = b if mode == INSERTED else ""
            those = arcs[q]
            for c, to in arcs[p].items():
                if c in those and c != banned and rest - 1 in rests[to] and rest - 1 in rests[those[c]]:
                    stack.append((EDITED, to, those[c], m, n, c, c))
        elif mode == EDITED or open_end:
            yield "".join(one), "".join(two)
