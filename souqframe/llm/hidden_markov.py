"""A hidden Markov model over classes of words: Baum-Welch counts and exact likelihoods, many sequences at once.

Sequences are taken in groups, longest first, and step by step through time: at each step all sequences
that still go on move together. Probabilities are scaled every few steps and the logarithms of the scales
add up to the likelihood, so nothing runs out of range however long a text is. Training looks back over
bounded stretches of time, whose first states are kept; within a stretch they are worked out again.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

GROUP = 1 << 19  # symbols of a group of sequences, about; a longer sequence ends its group
STRETCH = 1 << 16  # symbols whose states are held while looking back, few enough for a processor's cache
LONG = 1 << 11  # symbols of a sequence from which on it is long
WAITING = 1 << 22  # symbols of long sequences that wait for each other
EVERY = 8  # steps from one scaling to the next
SMOOTH = 0.1  # added to each expected count


@dataclass(frozen=True)
class Model:
    """First states, moves between states, and symbols of each state: rows add up to 1."""

    first: np.ndarray  # states
    moves: np.ndarray  # states x states
    symbols: np.ndarray  # symbols x states

    @property
    def states(self) -> int:
        return len(self.first)


@dataclass
class Counts:
    """Expected counts, and the likelihood (natural logarithm) of what was counted."""

    first: np.ndarray
    moves: np.ndarray
    symbols: np.ndarray
    likelihood: float = 0.0

    @classmethod
    def none(cls, states: int, symbols: int) -> "Counts":
        return cls(np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states)))


def start(symbol_counts: np.ndarray, states: int, seed: int = 0) -> Model:
    """A model to begin with: every state has the counted symbols, each made more or less likely at random.

    States tend to stay, so that what stands together in texts drifts to the same state.
    """
    random = np.random.default_rng(seed)
    share = (symbol_counts + SMOOTH) / (symbol_counts + SMOOTH).sum()
    symbols = share[:, None] * np.exp(random.normal(0, 1, (len(share), states)))
    moves = np.full((states, states), 0.2 / max(1, states - 1))
    np.fill_diagonal(moves, 0.8 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), moves, symbols / symbols.sum(axis=0))


def estimate(counts: Counts) -> Model:
    """The model that the expected counts make likeliest, with SMOOTH added to each."""
    first, moves, symbols = counts.first + SMOOTH, counts.moves + SMOOTH, counts.symbols + SMOOTH
    return Model(first / first.sum(), moves / moves.sum(axis=1, keepdims=True), symbols / symbols.sum(axis=0))


def _groups(lengths: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Sequences in groups of similar length, longest first; empty ones are left out."""
    order = np.argsort(-lengths, kind="stable")
    at, total = 0, 0
    order = order[lengths[order] > 0]
    for end, length in enumerate(lengths[order].tolist(), start=1):
        total += length
        if total >= size:
            yield order[at:end]
            at, total = end, 0
    if at < len(order):
        yield order[at:]


class _Group:
    """The symbols of some sequences, longest first, time step by time step: `reach[t]` is where step t begins."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.lengths = lengths
        self.going = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), "right")
        self.reach = np.concatenate([[0], self.going.cumsum()])
        which = np.repeat(np.arange(len(lengths)), lengths)
        step = np.arange(len(which)) - np.repeat(lengths.cumsum() - lengths, lengths)
        self.symbols = np.empty(len(which), symbols.dtype)
        self.symbols[self.reach[step] + which] = symbols[np.repeat(starts, lengths) + step]

    def stretches(self) -> list[tuple[int, int]]:
        """Steps (from, to) that hold some STRETCH symbols each."""
        cuts, last = [0], 0
        for step in range(1, len(self.going)):
            if self.reach[step + 1] - self.reach[last] > STRETCH:
                cuts.append(step)
                last = step
        return list(zip(cuts, [*cuts[1:], len(self.going)], strict=True))


def _forward(model: Model, group: _Group, seen: np.ndarray, first: int, last: int, before: np.ndarray | None):
    """States at the steps first..last-1, and the scales by step; `before` has the states of the step in front.

    Scales are taken out at one step in EVERY, which is enough to stay in range and saves most of the calls.
    """
    reach, base = group.reach, group.reach[first]
    states, scales = np.empty((reach[last] - base, model.states)), {}
    for step in range(first, last):
        at, end = reach[step] - base, reach[step + 1] - base
        here = states[at:end]
        if before is None:
            np.multiply(seen[at:end], model.first, out=here)
        else:
            np.matmul(before[: end - at], model.moves, out=here)
            here *= seen[at:end]
        if step % EVERY == EVERY - 1:
            scales[step] = scale = here.sum(axis=1, keepdims=True)
            here /= scale
        before = here
    return states, scales


def _ends(group: _Group, first: int, last: int) -> tuple[slice, np.ndarray]:
    """The sequences that end at the steps first..last-1, and where those ends stand from `first` on."""
    which = slice(group.going[last] if last < len(group.going) else 0, group.going[first])
    return which, group.reach[group.lengths[which] - 1] + np.arange(which.start, which.stop) - group.reach[first]


def likelihoods(model: Model, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The natural logarithm of each sequence's probability; the sequences stand one behind the other."""
    starts, found = lengths.cumsum() - lengths, np.zeros(len(lengths))
    for which in _groups(lengths, GROUP):
        group, before, total = _Group(symbols, starts[which], lengths[which]), None, np.zeros(len(which))
        for first, last in group.stretches():
            seen = model.symbols[group.symbols[group.reach[first] : group.reach[last]]]
            states, scales = _forward(model, group, seen, first, last, before)
            before = states[group.reach[last - 1] - group.reach[first] :].copy()
            for scale in scales.values():
                total[: len(scale)] += np.log(scale[:, 0])
            ended, places = _ends(group, first, last)
            total[ended] += np.log(states[places].sum(axis=1))
        found[which] = total
    return found


def count(model: Model, symbols: np.ndarray, lengths: np.ndarray, counts: Counts, group: int | None = None) -> None:
    """Adds the sequences' expected counts under the model to `counts`."""
    starts = lengths.cumsum() - lengths
    for which in _groups(lengths, group or GROUP):
        _count_group(model, _Group(symbols, starts[which], lengths[which]), counts)


class Counter:
    """Counts sequences as they come. Long ones wait for others, as a step takes as long for one as for many."""

    def __init__(self, model: Model, symbols: int):
        self.model, self.counts = model, Counts.none(model.states, symbols)
        self.waiting, self.size = [], 0

    def add(self, symbols: np.ndarray, lengths: np.ndarray) -> None:
        long = lengths > LONG
        which = np.repeat(long, lengths)
        count(self.model, symbols[~which], lengths[~long], self.counts)
        if long.any():
            self.waiting.append((symbols[which], lengths[long]))
            self.size += int(lengths[long].sum())
            if self.size > WAITING:
                self._count_waiting()

    def _count_waiting(self) -> None:
        if self.waiting:
            symbols, lengths = map(np.concatenate, zip(*self.waiting, strict=True))
            count(self.model, symbols, lengths, self.counts, len(symbols))
            self.waiting, self.size = [], 0

    def result(self) -> Counts:
        self._count_waiting()
        return self.counts


def _count_group(model: Model, group: _Group, counts: Counts) -> None:
    reach, going, stretches = group.reach, group.going, group.stretches()
    before, borders, held = None, [], None
    for first, last in stretches:
        borders.append(before)
        seen = model.symbols[group.symbols[reach[first] : reach[last]]]
        held = _forward(model, group, seen, first, last, before)
        before = held[0][reach[last - 1] - reach[first] :].copy()
    onward, back = model.moves.T.copy(), None
    for number in range(len(stretches) - 1, -1, -1):
        (first, last), base = stretches[number], reach[stretches[number][0]]
        part = group.symbols[base : reach[last]]
        seen = model.symbols[part]
        states, scales = held if held is not None else _forward(model, group, seen, first, last, borders[number])
        held = None
        # What follows a step, given its state, next to how likely all of it is.
        after = np.empty_like(states)
        _, ends = _ends(group, first, last)
        total = states[ends].sum(axis=1, keepdims=True)
        after[ends] = 1 / total
        counts.likelihood += float(np.log(total).sum()) + sum(float(np.log(scale).sum()) for scale in scales.values())
        for step in range(last - 1, first - 1, -1):
            at, end = reach[step] - base, reach[step + 1] - base
            if back is not None:
                np.matmul(back, onward, out=after[at : at + len(back)])
            back = seen[at:end]
            back *= after[at:end]
            if step in scales:
                back /= scales[step]
        # `seen` now holds symbol and future of each step: what the step before it is paired with.
        inner = reach[first + 1] - base
        counts.moves += model.moves * _pairs(states, seen, going[first:last], inner)
        if number:
            counts.moves += model.moves * (borders[number][: len(back)].T @ back)
        else:
            counts.first += (states[:inner] * after[:inner]).sum(axis=0)
        states *= after
        for state in range(model.states):
            counts.symbols[:, state] += np.bincount(part, states[:, state], len(counts.symbols))


def _pairs(states: np.ndarray, onward: np.ndarray, going: np.ndarray, inner: int) -> np.ndarray:
    """Sum over neighbouring steps of what states stand before what goes on."""
    ends = len(states) - going[-1]
    kept = going[1:].sum()
    if kept == ends:  # no sequence ends in between
        return states[:ends].T @ onward[inner:]
    # Of each step, the sequences that go on to the next one stand first.
    row = np.arange(kept) - np.repeat(going[1:].cumsum() - going[1:], going[1:])
    place = np.repeat(going[:-1].cumsum() - going[:-1], going[1:]) + row
    return states[place].T @ onward[inner:]
