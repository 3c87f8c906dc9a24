"""Weighted finite-state transducers over word kinds, and their composition.

A transducer here is sequential: a state and an input symbol give at most one arc, with an output symbol, a
weight and a next state. A symbol without an arc passes unchanged, at no weight, to the state's default next
state. Composition feeds the output of one machine to the next and adds the weights.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

Symbol = tuple[str, ...]  # a word kind followed by the marks that machines have added to it
Arc = tuple[Symbol, float, int]


@dataclass(frozen=True)
class Transducer:
    """``arcs`` by (state, kind, marks); ``default`` is the next state of each state for other symbols."""

    arcs: dict[tuple[int, Symbol], Arc]
    default: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, symbol: Symbol) -> Arc:
        arc = self.arcs.get((state, symbol))
        return arc if arc else (symbol, 0.0, self.default.get(state, state))


def window(trigger: str, kind: str, mark: str, weight: float, reach: int, reset: str) -> Transducer:
    """Marks a ``kind`` that follows a ``trigger`` by at most ``reach`` words; ``reset`` ends the reach.

    State 0 waits for a trigger, state k > 0 has seen one k - 1 words ago.
    """
    arcs: dict[tuple[int, Symbol], Arc] = {}
    for state in range(reach + 1):
        arcs[state, (trigger,)] = ((trigger,), 0.0, 1)
        arcs[state, (reset,)] = ((reset,), 0.0, 0)
        if state:
            arcs[state, (kind,)] = ((kind, mark), weight, (state + 1) % (reach + 1))
    return Transducer(arcs, {state: (state + 1) % (reach + 1) if state else 0 for state in range(reach + 1)})


def marked_inputs(machine: Transducer, marks: Iterable[str]) -> Transducer:
    """The machine also for symbols that earlier machines have marked; it adds its own mark to theirs."""
    arcs = dict(machine.arcs)
    for (state, symbol), (out, weight, after) in machine.arcs.items():
        for mark in marks:
            marked = (symbol[0], mark)
            arcs[state, marked] = ((*marked, *out[1:]), weight, after)
    return Transducer(arcs, machine.default)


def compose(first: Transducer, second: Transducer, alphabet: Iterable[Symbol]) -> Transducer:
    """One machine that does what ``second`` does with the output of ``first``, for the given inputs."""
    pairs, arcs, waiting = {(0, 0): 0}, {}, [(0, 0)]
    default: dict[int, int] = {}
    symbols = list(alphabet)
    while waiting:
        a, b = pair = waiting.pop()
        for symbol in [*symbols, ("",)]:  # the empty kind stands for any other word
            middle, w1, after1 = first.step(a, symbol)
            out, w2, after2 = second.step(b, middle)
            after = (after1, after2)
            if after not in pairs:
                pairs[after] = len(pairs)
                waiting.append(after)
            if symbol == ("",):
                default[pairs[pair]] = pairs[after]
            else:
                arcs[pairs[pair], symbol] = (out, w1 + w2, pairs[after])
    return Transducer(arcs, default)
