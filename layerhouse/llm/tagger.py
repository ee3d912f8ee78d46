"""A character tagger in numpy: bidirectional LSTM, linear emissions, CRF transitions."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Punctuation with a class of its own (fixed values: ASCII punctuation in code order).
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

#: Classes: padding, digit, lower, upper, other letter, space, line end, other, then punctuation.
CLASSES = 8 + len(PUNCTUATION)


def _table() -> np.ndarray:
    table = np.full(0x250, 7, "u1")
    for code in range(0x250):
        char = chr(code)
        if char in PUNCTUATION:
            table[code] = 8 + PUNCTUATION.index(char)
        elif char in "0123456789":
            table[code] = 1
        elif char.isalpha():
            table[code] = 4 if code > 127 else 2 if char.islower() else 3
        elif char in "\n\r":
            table[code] = 6
        elif char.isspace():
            table[code] = 5
    return table


TABLE = _table()


def classes(text: str) -> np.ndarray:
    """The class of each code point; those beyond the table are other letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < len(TABLE), TABLE[np.minimum(points, len(TABLE) - 1)], 4).astype("u1")


class Tagger(NamedTuple):
    """Weights; ``cells`` and ``shifts`` have the forward and the backward direction."""

    embed: np.ndarray
    cells: tuple[np.ndarray, np.ndarray]
    shifts: tuple[np.ndarray, np.ndarray]
    out: np.ndarray
    bias: np.ndarray
    moves: np.ndarray

    def flat(self) -> list[np.ndarray]:
        return [self.embed, *self.cells, *self.shifts, self.out, self.bias, self.moves]

    @staticmethod
    def of(parts: list[np.ndarray]) -> Tagger:
        return Tagger(parts[0], (parts[1], parts[2]), (parts[3], parts[4]), parts[5], parts[6], parts[7])


def fresh(tags: int, width: int = 12, units: int = 20, seed: int = 5) -> Tagger:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.normal(0, 1 / np.sqrt(shape[0]), shape)).astype("f4")
    shift = np.zeros(4 * units, "f4")
    shift[units:2 * units] = 1.0  # forget gates begin open
    return Tagger(draw(CLASSES, width), (draw(width + units, 4 * units), draw(width + units, 4 * units)),
                  (shift.copy(), shift.copy()), draw(2 * units, tags), np.zeros(tags, "f4"), np.zeros((tags, tags), "f4"))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _run(x: np.ndarray, cell: np.ndarray, shift: np.ndarray, keep: bool):
    """Hidden states of one direction over ``x`` (time, rows, width), and what the gradient needs."""
    times, rows, width = x.shape
    units = cell.shape[1] // 4
    from_input = x.reshape(-1, width) @ cell[:width] + shift
    from_input = from_input.reshape(times, rows, -1)
    h, c = np.zeros((rows, units), "f4"), np.zeros((rows, units), "f4")
    states, trace = np.empty((times, rows, units), "f4"), []
    for t in range(times):
        z = from_input[t] + h @ cell[width:]
        gates = _sigmoid(z[:, :3 * units])
        i, f, o = gates[:, :units], gates[:, units:2 * units], gates[:, 2 * units:]
        g = np.tanh(z[:, 3 * units:])
        before, last = c, h
        c = f * c + i * g
        squashed = np.tanh(c)
        h = o * squashed
        states[t] = h
        if keep:
            trace.append((i, f, o, g, before, squashed, last))
    return states, trace


def _back(x: np.ndarray, cell: np.ndarray, trace: list, d_states: np.ndarray):
    """Gradients of ``_run`` by its input, cell and shift."""
    times, rows, width = x.shape
    units = cell.shape[1] // 4
    d_cell, d_z = np.zeros_like(cell), np.empty((times, rows, 4 * units), "f4")
    dh, dc = np.zeros((rows, units), "f4"), np.zeros((rows, units), "f4")
    for t in range(times - 1, -1, -1):
        i, f, o, g, before, squashed, last = trace[t]
        dh = dh + d_states[t]
        dc = dc + dh * o * (1 - squashed**2)
        d_z[t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o),
                                 dc * i * (1 - g**2)], axis=1)
        d_cell[width:] += last.T @ d_z[t]
        dh, dc = d_z[t] @ cell[width:].T, dc * f
    flat = d_z.reshape(-1, 4 * units)
    d_cell[:width] = x.reshape(-1, width).T @ flat
    return (flat @ cell[:width].T).reshape(x.shape), d_cell, flat.sum(axis=0)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _lattice(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward log sums of a CRF (time, rows, tags) and the log partition."""
    ahead, behind = np.empty_like(scores), np.zeros_like(scores)
    ahead[0] = scores[0]
    onward = np.exp(moves)

    def step(logs: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        top = logs.max(axis=1, keepdims=True)
        return top + np.log(np.exp(logs - top) @ matrix)

    for t in range(1, len(scores)):
        ahead[t] = scores[t] + step(ahead[t - 1], onward)
    for t in range(len(scores) - 2, -1, -1):
        behind[t] = step(scores[t + 1] + behind[t + 1], onward.T)
    return ahead, behind, _logsum(ahead[-1], 1)


def emissions(net: Tagger, chars: np.ndarray, keep: bool = False):
    """Tag scores (time, rows, tags) of windows of character classes (time, rows)."""
    x = net.embed[chars]
    ahead, trace_a = _run(x, net.cells[0], net.shifts[0], keep)
    behind, trace_b = _run(x[::-1], net.cells[1], net.shifts[1], keep)
    both = np.concatenate([ahead, behind[::-1]], axis=2)
    return both @ net.out + net.bias, (x, both, trace_a, trace_b)


def log_marginals(net: Tagger, chars: np.ndarray) -> np.ndarray:
    """Log probability of every tag at every place of windows (time, rows)."""
    scores, _ = emissions(net, chars)
    ahead, behind, total = _lattice(scores, net.moves)
    return ahead + behind - total[:, None]


def gradient(net: Tagger, chars: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean negative log likelihood of the tags (time, rows) and its gradient."""
    times, rows = chars.shape
    scores, (x, both, trace_a, trace_b) = emissions(net, chars, keep=True)
    ahead, behind, total = _lattice(scores, net.moves)
    column = np.arange(rows)
    own = scores[np.arange(times)[:, None], column, tags].sum(axis=0) + net.moves[tags[:-1], tags[1:]].sum(axis=0)
    d_scores = np.exp(ahead + behind - total[:, None])
    d_scores[np.arange(times)[:, None], column, tags] -= 1
    d_scores /= rows
    pairs = np.exp(ahead[:-1, :, :, None] + net.moves + (scores[1:] + behind[1:])[:, :, None, :] - total[None, :, None, None])
    d_moves = pairs.sum(axis=(0, 1))
    np.subtract.at(d_moves, (tags[:-1].ravel(), tags[1:].ravel()), 1)
    units = net.cells[0].shape[1] // 4
    flat = d_scores.reshape(-1, d_scores.shape[2])
    d_both = d_scores @ net.out.T
    dx_a, d_cell_a, d_shift_a = _back(x, net.cells[0], trace_a, d_both[:, :, :units])
    dx_b, d_cell_b, d_shift_b = _back(x[::-1], net.cells[1], trace_b, d_both[::-1, :, units:])
    d_embed = np.zeros_like(net.embed)
    np.add.at(d_embed, chars.ravel(), (dx_a + dx_b[::-1]).reshape(-1, x.shape[2]))
    return float((total - own).mean()), [d_embed, d_cell_a, d_cell_b, d_shift_a, d_shift_b,
                                         both.reshape(-1, both.shape[2]).T @ flat, flat.sum(axis=0), d_moves / rows]


def train(chars: np.ndarray, tags: np.ndarray, number: int, steps: int = 350, batch: int = 48,
          rate: float = 0.01, seed: int = 5) -> Tagger:
    """Adam on windows (rows, time); the same windows give the same tagger."""
    parts, rng = fresh(number, seed=seed).flat(), np.random.default_rng(seed)
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, steps + 1):
        pick = rng.integers(len(chars), size=batch)
        _, grads = gradient(Tagger.of(parts), chars[pick].T, tags[pick].T)
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads))
        slow = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, (p, g) in enumerate(zip(parts, grads, strict=True)):
            g = g * np.float32(min(1.0, 5 / (norm + 1e-9)))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            p -= (slow * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype("f4")
    return Tagger.of(parts)


def best_path(unary: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Viterbi over one region (time, tags)."""
    back = np.empty(unary.shape, "i4")
    score = unary[0]
    for t in range(1, len(unary)):
        all_ways = score[:, None] + moves
        back[t] = all_ways.argmax(axis=0)
        score = unary[t] + all_ways.max(axis=0)
    path = np.empty(len(unary), "i4")
    path[-1] = score.argmax()
    for t in range(len(unary) - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path
