"""A small gated recurrent network over word numbers, in numpy: windows of many documents side by side."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np

#: Word numbers of the end of a document and of every word outside the vocabulary.
END, RARE = 0, 1
#: Steps of a window, and documents that are read side by side.
STEPS, LANES = 32, 512
F32 = np.float32
#: Rows whose class logits are computed together, few enough to stay in the processor's cache.
ROWS = 2048
#: Slope of the gates, which are straight lines cut off at 0 and 1.
GATE = F32(0.25)


@dataclass
class Parameters:
    """``gates``: what each input word adds to update, reset and candidate; ``recurrent``: what the state adds.

    Output is factored: a class first, then the word among those of its class. Words are numbered so that a class
    is a range of numbers; ``cuts`` are its bounds.
    """

    gates: np.ndarray
    recurrent: np.ndarray
    classes: np.ndarray
    class_bias: np.ndarray
    words: np.ndarray
    word_bias: np.ndarray

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, f.name).ravel() for f in fields(self)])

    def like(self, flat: np.ndarray) -> Parameters:
        """Arrays of these shapes with the values of ``flat``, or zeros if it has none."""
        if not flat.size:
            return Parameters(*[np.zeros_like(getattr(self, f.name)) for f in fields(self)])
        made, at = [], 0
        for f in fields(self):
            own = getattr(self, f.name)
            made.append(flat[at : at + own.size].reshape(own.shape).astype(F32))
            at += own.size
        return Parameters(*made)


def class_cuts(counts: np.ndarray, classes: int) -> np.ndarray:
    """Bounds of ranges of words with about equal shares of the square roots of their counts.

    The end and the rare word are a class of their own each.
    """
    mass = np.sqrt(np.maximum(counts[2:], 1).astype(float))
    share = np.cumsum(mass) / max(mass.sum(), 1.0)
    at = np.searchsorted(share, np.arange(1, classes) / classes) + 3
    inner = [int(x) for x in np.unique(at) if 2 < x < len(counts)]
    return np.array([0, 1, 2, *inner, len(counts)] if len(counts) > 2 else [0, 1, 2])


def first_parameters(counts: np.ndarray, cuts: np.ndarray, hidden: int, seed: int) -> Parameters:
    """Small random weights, and biases with which the untrained network gives every word its share of the corpus."""
    draw = np.random.default_rng(seed)
    counts = counts.astype(float) + 0.5
    totals = np.add.reduceat(counts, cuts[:-1])
    within = np.log(counts / np.repeat(totals, np.diff(cuts)))
    k, c = len(counts), len(totals)

    def small(*shape: int) -> np.ndarray:
        return (0.1 * draw.standard_normal(shape)).astype(F32)

    return Parameters(
        3 * small(k, 3 * hidden), 2 * small(hidden, 3 * hidden), small(hidden, c),
        np.log(totals / totals.sum()).astype(F32), small(k, hidden), within.astype(F32),
    )


@dataclass
class Lanes:
    """Documents put one after the other on lanes of about equal length, longest lane first."""

    targets: np.ndarray
    inputs: np.ndarray
    opens: np.ndarray
    owner: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, documents: list[np.ndarray], lanes: int = LANES) -> Lanes:
        """``documents`` are word numbers, each with its end."""
        lengths = np.array([len(d) for d in documents])
        order = np.argsort(-lengths, kind="stable")
        lanes = min(lanes, len(documents))
        load, at = np.zeros(lanes, dtype=np.int64), np.empty(len(documents), dtype=np.int64)
        for first in range(0, len(order), lanes):
            # The longest of the next documents goes to the lane that is shortest so far.
            some = order[first : first + lanes]
            free = np.argsort(load, kind="stable")[: len(some)]
            load[free] += lengths[some]
            at[some] = free
        rank = np.argsort(-load, kind="stable")
        position = np.empty(lanes, dtype=np.int64)
        position[rank] = np.arange(lanes)
        placed = order[np.argsort(position[at[order]], kind="stable")]
        targets = np.concatenate([documents[i] for i in placed])
        opens = np.zeros(len(targets), dtype=bool)
        opens[np.concatenate([[0], np.cumsum(lengths[placed])[:-1]])] = True
        inputs = np.where(opens, END, np.roll(targets, 1))
        ends = np.cumsum(load[rank])
        return cls(targets, inputs, opens, np.repeat(placed.astype(np.int32), lengths[placed]), ends - load[rank], ends)

    def windows(self, steps: int = STEPS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions (steps, lanes still running) of each window, and which of them exist."""
        longest = int((self.ends - self.starts).max())
        for t in range(0, longest, steps):
            running = int((self.ends - self.starts > t).sum())
            at = self.starts[:running] + t + np.arange(min(steps, longest - t))[:, None]
            yield np.minimum(at, self.ends[:running] - 1), at < self.ends[:running]


class Network:
    def __init__(self, parameters: Parameters, cuts: np.ndarray) -> None:
        self.p, self.cuts = parameters, cuts
        self.class_of = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        self.hidden = parameters.recurrent.shape[0]

    # ---- states ----

    def _states(self, inputs: np.ndarray, opens: np.ndarray, state: np.ndarray, keep: list | None) -> np.ndarray:
        """States after each step; what the way back needs goes to ``keep``."""
        n, p = self.hidden, self.p
        table = p.gates.copy()
        table[:, : 2 * n] *= GATE
        table[:, : 2 * n] += F32(0.5)
        gates = table[inputs]
        out = np.empty((*inputs.shape, n), dtype=F32)
        both, own = p.recurrent[:, : 2 * n] * GATE, p.recurrent[:, 2 * n :].copy()
        for t in range(len(inputs)):
            if opens[t].any():
                state = state * ~opens[t][:, None]
            zr = state @ both
            zr += gates[t, :, : 2 * n]
            np.clip(zr, F32(0), F32(1), out=zr)
            reset = zr[:, n:] * state
            new = reset @ own
            new += gates[t, :, 2 * n :]
            np.tanh(new, out=new)
            np.subtract(new, state, out=out[t])
            out[t] *= zr[:, :n]
            out[t] += state
            if keep is not None:
                keep.append((state, zr, reset, new))
            state = out[t]
        return out

    # ---- output ----

    def _groups(self, targets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """An order of the targets by class, and the stretch of each class in it."""
        order, ends = _sorted_numbers(self.class_of[targets], len(self.cuts) - 1)
        starts = [0, *ends[:-1].tolist()]
        return order, [(c, a, int(b)) for c, (a, b) in enumerate(zip(starts, ends)) if b > a]

    def _log_probability(
        self, states: np.ndarray, targets: np.ndarray, groups: list[tuple[int, int, int]], slope: Parameters | None
    ) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural logarithms for states and targets that are sorted by class.

        With ``slope`` the gradients of the output go there, and those of the states are returned.
        """
        p = self.p
        out, classes = np.empty(len(targets)), self.class_of[targets]
        back = None if slope is None else np.empty_like(states)
        for a in range(0, len(targets), ROWS):
            some = states[a : a + ROWS]
            logits = some @ p.classes
            logits += p.class_bias
            out[a : a + ROWS] = _log_softmax_at(logits, classes[a : a + ROWS], slope is not None)
            if slope is not None:
                slope.classes += some.T @ logits
                slope.class_bias += np.ones(len(some), dtype=F32) @ logits
                back[a : a + ROWS] = logits @ p.classes.T
        for c, a, b in groups:
            low, high = self.cuts[c], self.cuts[c + 1]
            if high - low == 1:
                continue
            inner = states[a:b] @ p.words[low:high].T
            inner += p.word_bias[low:high]
            out[a:b] += _log_softmax_at(inner, targets[a:b] - low, slope is not None)
            if slope is not None:
                slope.words[low:high] = inner.T @ states[a:b]
                slope.word_bias[low:high] = np.ones(b - a, dtype=F32) @ inner
                back[a:b] += inner @ p.words[low:high]
        return out, back

    def score(self, documents: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each whole document, its end included."""
        out = np.zeros(len(documents))
        if not documents:
            return out
        lanes = Lanes.of(documents)
        state = np.zeros((len(lanes.starts), self.hidden), dtype=F32)
        for at, valid in lanes.windows():
            state = state[: at.shape[1]]
            states = self._states(lanes.inputs[at], lanes.opens[at] & valid, state, None)
            state = states[-1]
            rows = np.flatnonzero(valid)
            here = at.ravel()[rows]
            order, groups = self._groups(lanes.targets[here])
            rows, here = rows[order], here[order]
            logs, _ = self._log_probability(states.reshape(-1, self.hidden)[rows], lanes.targets[here], groups, None)
            np.add.at(out, lanes.owner[here], logs)
        return out

    # ---- training ----

    def train(self, documents: list[np.ndarray], memory: Parameters, rate: float) -> float:
        """One pass by truncated backpropagation: gradients stay inside a window, states go on to the next.

        ``memory`` holds the squared gradients that scale each parameter's steps. Returns the summed log probability.
        """
        lanes, total = Lanes.of(documents), 0.0
        state = np.zeros((len(lanes.starts), self.hidden), dtype=F32)
        for at, valid in lanes.windows():
            state = state[: at.shape[1]]
            inputs, opens = lanes.inputs[at], lanes.opens[at] & valid
            keep: list = []
            states = self._states(inputs, opens, state, keep)
            slope = self.p.like(np.zeros(0))
            order, groups = self._groups(lanes.targets[at[valid]])
            rows = np.flatnonzero(valid)[order]
            flat = states.reshape(-1, self.hidden)
            logs, back = self._log_probability(flat[rows], lanes.targets[at.ravel()[rows]], groups, slope)
            total += float(logs.sum())
            pull = np.zeros_like(flat)
            pull[rows] = back
            self._back(inputs, opens, pull.reshape(states.shape), keep, slope)
            self._step(slope, memory, rate, len(rows))
            state = states[-1]
        return total

    def _back(self, inputs: np.ndarray, opens: np.ndarray, pull: np.ndarray, keep: list, slope: Parameters) -> None:
        """The way back through the steps of a window."""
        n, p = self.hidden, self.p
        gates = np.empty((*inputs.shape, 3 * n), dtype=F32)
        both, own = p.recurrent[:, : 2 * n].T.copy(), p.recurrent[:, 2 * n :].T.copy()
        d = np.zeros_like(pull[0])
        for t in range(len(inputs) - 1, -1, -1):
            state, zr, reset, new = keep[t]
            z, r = zr[:, :n], zr[:, n:]
            d += pull[t]
            at, wide = gates[t], gates[t, :, : 2 * n]
            np.multiply(new, new, out=at[:, 2 * n :])
            np.subtract(F32(1), at[:, 2 * n :], out=at[:, 2 * n :])
            moved = d * z
            at[:, 2 * n :] *= moved
            d_reset = at[:, 2 * n :] @ own
            np.subtract(new, state, out=at[:, :n])
            at[:, :n] *= d
            np.multiply(d_reset, state, out=at[:, n : 2 * n])
            wide *= (zr > 0) & (zr < 1)
            wide *= GATE
            d -= moved
            d_reset *= r
            d += d_reset
            d += wide @ both
            if opens[t].any():
                d *= ~opens[t][:, None]
        flat = gates.reshape(-1, 3 * n)
        slope.recurrent[:, : 2 * n] = np.concatenate([k[0] for k in keep]).T @ flat[:, : 2 * n]
        slope.recurrent[:, 2 * n :] = np.concatenate([k[2] for k in keep]).T @ flat[:, 2 * n :]
        order, ends = _sorted_numbers(inputs.ravel(), len(p.gates))
        starts = np.concatenate([[0], ends[:-1]])
        numbers = np.flatnonzero(ends > starts)
        slope.gates[numbers] = np.add.reduceat(flat[order], starts[numbers], axis=0)

    def _step(self, slope: Parameters, memory: Parameters, rate: float, tokens: int) -> None:
        for f in fields(Parameters):
            g, m, own = getattr(slope, f.name), getattr(memory, f.name), getattr(self.p, f.name)
            g *= F32(1 / tokens)
            m += g * g
            size = np.sqrt(m)
            size += F32(1e-6)
            g /= size
            g *= F32(rate)
            own -= g


def _sorted_numbers(numbers: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of small whole numbers, and the end of each number's stretch in it. Short types sort by digits."""
    short = numbers.astype(np.uint8 if most <= 256 else np.uint16 if most <= 65536 else np.int64)
    return np.argsort(short, kind="stable"), np.cumsum(np.bincount(numbers, minlength=most))


def _log_softmax_at(logits: np.ndarray, at: np.ndarray, slopes: bool) -> np.ndarray:
    """The logarithms at the targets; with ``slopes`` the logits become their own gradients."""
    rows = np.arange(len(at))
    if logits.max() > 60 or logits.min() < -80:
        logits -= logits.max(axis=1, keepdims=True)
    chosen = logits[rows, at].astype(float)
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], dtype=F32)
    if slopes:
        logits *= (F32(1) / total)[:, None]
        logits[rows, at] -= 1
    return chosen - np.log(total.astype(float))
