"""Character tagger: bidirectional LSTM with CRF transitions, in numpy.

A text is a row of letter classes. Two LSTMs, one each way, read it; their
states give a score for every tag at every place, and the CRF adds a score for
every pair of neighbouring tags. Training maximises the likelihood of labelled
tag rows (forward-backward for the CRF, back propagation through time for the
LSTMs, Adam steps); decoding finds the best tag row (Viterbi).

Tags: 0 is outside; kind k begins with tag 1 + 2k and goes on with 2 + 2k.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Classes: 0 no text, 1 white space, 2 digit, 3 other letter, 4 anything else, then ASCII signs and a-z one by one, A-Z as one.
PAD, BLANK, DIGIT, LETTER, OTHER, UPPER = 0, 1, 2, 3, 4, 5
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CLASSES = 6 + len(SIGNS) + 26
_TABLE_SIZE = 0x250


def _class_table() -> np.ndarray:
    table = np.full(_TABLE_SIZE, OTHER, dtype=np.uint8)
    for code in range(_TABLE_SIZE):
        c = chr(code)
        if c.isspace():
            table[code] = BLANK
        elif c in SIGNS:
            table[code] = 6 + SIGNS.index(c)
        elif "0" <= c <= "9":
            table[code] = DIGIT
        elif "a" <= c <= "z":
            table[code] = 6 + len(SIGNS) + code - ord("a")
        elif "A" <= c <= "Z":
            table[code] = UPPER
        elif c.isalpha():
            table[code] = LETTER
    return table


_CLASS_OF = _class_table()


def classes_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(codes < _TABLE_SIZE, _CLASS_OF[np.minimum(codes, _TABLE_SIZE - 1)], LETTER).astype(np.uint8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class Tagger:
    """Weights by name; see :func:`new_tagger`."""

    hidden: int
    weights: dict[str, np.ndarray]

    @property
    def tags(self) -> int:
        return len(self.weights["out_bias"])

    # --- scores ---

    def states(self, classes: np.ndarray, way: str) -> np.ndarray:
        """(T, B, hidden) states of one LSTM over (T, B) classes, row 0 first; a column's padding must come last."""
        h = self.hidden
        table, recurrent = self.weights[f"in_{way}"].copy(), self.weights[f"rec_{way}"].copy()
        table[:, :3 * h] *= 0.5  # a sigmoid is a tanh of half its argument
        recurrent[:, :3 * h] *= 0.5
        steps, width = classes.shape
        live = (classes != PAD).sum(axis=1)
        out = np.zeros((steps, width, h), dtype=np.float32)
        cell, state = np.zeros((width, h), np.float32), np.zeros((width, h), np.float32)
        for t in range(steps):
            n = live[t]  # columns come longest first
            if not n:
                break
            z = state[:n] @ recurrent
            z += table[classes[t, :n]]
            np.tanh(z, out=z)
            gates = z[:, :3 * h]
            gates *= 0.5
            gates += 0.5
            cell = cell[:n]
            cell *= gates[:, h:2 * h]
            cell += gates[:, :h] * z[:, 3 * h:]
            state = np.tanh(cell)
            state *= gates[:, 2 * h:]
            out[t, :n] = state
        return out

    def emissions(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """(length, tags) scores of each row of classes; rows of any length, at least one."""
        order = sorted(range(len(rows)), key=lambda i: -len(rows[i]))
        steps = len(rows[order[0]])
        ahead, back = np.zeros((2, steps, len(rows)), dtype=np.uint8)
        for column, i in enumerate(order):
            ahead[:len(rows[i]), column] = rows[i]
            back[:len(rows[i]), column] = rows[i][::-1]
        up = self.states(ahead, "up") @ self.weights["out_up"]
        down = self.states(back, "down") @ self.weights["out_down"]
        found: list = [None] * len(rows)
        for column, i in enumerate(order):
            n = len(rows[i])
            found[i] = up[:n, column] + down[:n, column][::-1] + self.weights["out_bias"]
        return found

    def best_tags(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """The best tag row for each (length, tags) array of scores; texts begin and end as if outside."""
        order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
        lengths = np.array([len(scores[i]) for i in order])
        moves = self.weights["moves"]
        width, steps = len(order), int(lengths[0])
        laid = np.zeros((steps, width, self.tags), dtype=np.float32)
        for column, i in enumerate(order):
            laid[:lengths[column], column] = scores[i]
        came = np.zeros((steps, width, self.tags), dtype=np.uint8)
        score = moves[0] + laid[0]
        final = score.copy()
        for t in range(1, steps):
            n = int((lengths > t).sum())
            ways = score[:n, :, None] + moves
            came[t, :n] = ways.argmax(axis=1)
            score = ways.max(axis=1) + laid[t, :n]
            final[:n] = score
        found: list = [None] * width
        tag = (final + moves[:, 0]).argmax(axis=1)
        tags = np.zeros((steps, width), dtype=np.uint8)
        columns = np.arange(width)
        for t in range(steps - 1, -1, -1):
            live = lengths > t
            tags[t, live] = tag[live]
            if t:
                tag = np.where(live, came[t, columns, tag], tag)
        for column, i in enumerate(order):
            found[i] = tags[:lengths[column], column]
        return found

    # --- training ---

    def loss_and_gradient(self, classes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood per column of (T, B) classes and tags without padding, and its gradient."""
        w, h = self.weights, self.hidden
        steps, width = classes.shape
        runs = {"up": self._forward(classes, "up"), "down": self._forward(classes[::-1], "down")}
        up, down = runs["up"][0], runs["down"][0][::-1]
        scores = up @ w["out_up"] + down @ w["out_down"] + w["out_bias"]
        moves, k = w["moves"], self.tags
        alpha, beta = np.empty_like(scores), np.empty_like(scores)
        alpha[0] = moves[0] + scores[0]
        for t in range(1, steps):
            alpha[t] = log_sum(alpha[t - 1][:, :, None] + moves, axis=1) + scores[t]
        beta[-1] = moves[:, 0]
        for t in range(steps - 2, -1, -1):
            beta[t] = log_sum(moves + (scores[t + 1] + beta[t + 1])[:, None, :], axis=2)
        total = log_sum(alpha[-1] + beta[-1], axis=1)
        own = np.eye(k, dtype=scores.dtype)[tags]
        marginal = np.exp(alpha + beta - total[:, None])
        pairs = np.zeros_like(moves)
        for t in range(1, steps):
            pairs += np.exp(alpha[t - 1][:, :, None] + moves + (scores[t] + beta[t])[:, None, :] - total[:, None, None]).sum(axis=0)
        np.subtract.at(pairs, (tags[:-1], tags[1:]), 1)
        pairs[0] += (marginal[0] - own[0]).sum(axis=0)
        pairs[:, 0] += (marginal[-1] - own[-1]).sum(axis=0)
        path = (scores * own).sum(axis=(0, 2)) + moves[0, tags[0]] + moves[tags[-1], 0]
        path = path + moves[tags[:-1], tags[1:]].sum(axis=0)
        d_scores = (marginal - own) / width
        gradient = {"moves": pairs / width, "out_bias": d_scores.sum(axis=(0, 1)),
                    "out_up": np.einsum("tbh,tbk->hk", up, d_scores), "out_down": np.einsum("tbh,tbk->hk", down, d_scores)}
        for way, d_states, row in (("up", d_scores @ w["out_up"].T, classes), ("down", (d_scores @ w["out_down"].T)[::-1], classes[::-1])):
            gradient |= self._backward(way, row, runs[way], d_states, h)
        return float((total - path).mean()), gradient

    def _forward(self, classes: np.ndarray, way: str):
        h = self.hidden
        table, recurrent = self.weights[f"in_{way}"], self.weights[f"rec_{way}"]
        steps, width = classes.shape
        states, cells = np.zeros((2, steps + 1, width, h), dtype=table.dtype)
        gates = np.empty((steps, width, 4 * h), dtype=table.dtype)
        for t in range(steps):
            z = table[classes[t]] + states[t] @ recurrent
            gates[t, :, :3 * h], gates[t, :, 3 * h:] = _sigmoid(z[:, :3 * h]), np.tanh(z[:, 3 * h:])
            cells[t + 1] = gates[t, :, h:2 * h] * cells[t] + gates[t, :, :h] * gates[t, :, 3 * h:]
            states[t + 1] = gates[t, :, 2 * h:3 * h] * np.tanh(cells[t + 1])
        return states[1:], states, cells, gates

    def _backward(self, way: str, classes: np.ndarray, run, d_states: np.ndarray, h: int) -> dict[str, np.ndarray]:
        _, states, cells, gates = run
        recurrent = self.weights[f"rec_{way}"]
        d_state, d_cell = np.zeros_like(states[0]), np.zeros_like(states[0])
        d_z = np.empty_like(gates)
        for t in range(len(classes) - 1, -1, -1):
            i, f, o, g = (gates[t, :, j * h:(j + 1) * h] for j in range(4))
            wide = np.tanh(cells[t + 1])
            d_state = d_state + d_states[t]
            d_cell = d_cell + d_state * o * (1 - wide * wide)
            z = d_z[t]
            z[:, :h] = d_cell * g * i * (1 - i)
            z[:, h:2 * h] = d_cell * cells[t] * f * (1 - f)
            z[:, 2 * h:3 * h] = d_state * wide * o * (1 - o)
            z[:, 3 * h:] = d_cell * i * (1 - g * g)
            d_cell = d_cell * f
            d_state = z @ recurrent.T
        flat = d_z.reshape(-1, 4 * h)
        read = np.eye(CLASSES, dtype=flat.dtype)[classes.reshape(-1)]
        return {f"in_{way}": read.T @ flat, f"rec_{way}": states[:-1].reshape(-1, h).T @ flat}


def new_tagger(kinds: int, hidden: int, seed: int) -> Tagger:
    """Small random weights; forget gates start open, the CRF forbids a kind to go on that has not begun."""
    random, tags = np.random.default_rng(seed), 1 + 2 * kinds
    weights = {}
    for way in ("up", "down"):
        weights[f"in_{way}"] = random.normal(0, 0.3, (CLASSES, 4 * hidden)).astype(np.float32)
        weights[f"in_{way}"][:, hidden:2 * hidden] += 1
        weights[f"rec_{way}"] = random.normal(0, hidden ** -0.5, (hidden, 4 * hidden)).astype(np.float32)
        weights[f"out_{way}"] = random.normal(0, hidden ** -0.5, (hidden, tags)).astype(np.float32)
    weights["out_bias"] = np.zeros(tags, np.float32)
    weights["out_bias"][0] = 1
    moves = np.zeros((tags, tags), np.float32)
    for k in range(kinds):
        for before in range(tags):
            if before not in (1 + 2 * k, 2 + 2 * k):
                moves[before, 2 + 2 * k] = FORBIDDEN
    weights["moves"] = moves
    return Tagger(hidden, weights)


FORBIDDEN = -50.0


def train(tagger: Tagger, batches, rate: float, decay_steps: int) -> list[float]:
    """Adam over (classes, tags) batches; the rate falls linearly to a tenth over ``decay_steps``. Returns the losses."""
    first = {k: np.zeros_like(v) for k, v in tagger.weights.items()}
    second = {k: np.zeros_like(v) for k, v in tagger.weights.items()}
    forbidden = tagger.weights["moves"] == FORBIDDEN
    losses = []
    for step, (classes, tags) in enumerate(batches, start=1):
        loss, gradient = tagger.loss_and_gradient(classes, tags)
        losses.append(loss)
        gradient["moves"][forbidden] = 0
        norm = float(np.sqrt(sum((g * g).sum() for g in gradient.values())))
        scale, pace = min(1.0, 5 / max(norm, 1e-9)), rate * max(0.1, 1 - 0.9 * step / decay_steps)
        for name, g in gradient.items():
            g = g * scale
            first[name] += 0.1 * (g - first[name])
            second[name] += 0.01 * (g * g - second[name])
            lean = first[name] / (1 - 0.9 ** step)
            tagger.weights[name] -= (pace * lean / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return losses
