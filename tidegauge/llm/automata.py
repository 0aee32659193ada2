"""Small deterministic automata that run over many start places at once."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from dataclasses import dataclass

import numpy as np


@dataclass
class Automaton:
    """``table[state, symbol]`` is the next state; state 0 is dead, state 1 the start.

    ``label[state]`` is an index into ``labels``, the sets of results accepted in a state.
    """

    table: np.ndarray
    label: np.ndarray
    labels: list[frozenset]


def determinise(
    start: Iterable[Hashable],
    step: Callable[[Hashable, int], Iterable[Hashable]],
    accept: Callable[[Hashable], Hashable | None],
    symbols: int,
) -> Automaton:
    """Subset construction; ``step`` must follow empty moves already, as must ``start``."""
    first = frozenset(start)
    number = {frozenset(): 0, first: 1}
    order = [frozenset(), first]
    rows = []
    at = 0
    while at < len(order):
        row = []
        for symbol in range(symbols):
            after = frozenset(y for x in order[at] for y in step(x, symbol))
            if after not in number:
                number[after] = len(order)
                order.append(after)
            row.append(number[after])
        rows.append(row)
        at += 1
    results = [frozenset(r for x in state if (r := accept(x)) is not None) for state in order]
    labels = sorted(set(results), key=lambda s: (len(s), sorted(map(str, s))))
    return Automaton(np.array(rows, dtype=np.int32), np.array([labels.index(r) for r in results]), labels)


def run(automaton: Automaton, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole: bool):
    """Run from every start up to its end; yield (index of start, label) where one accepts.

    ``whole``: accept only at the end; otherwise after every symbol.
    """
    index = np.flatnonzero(starts < ends)
    state = np.ones(len(index), dtype=np.int32)
    at = starts[index]
    while len(index):
        state = automaton.table[state, symbols[at]]
        at = at + 1
        done = at >= ends[index]
        label = automaton.label[state]
        told = (label > 0) & (done if whole else True)
        if told.any():
            yield index[told], label[told]
        go = (state > 0) & ~done
        index, state, at = index[go], state[go], at[go]
