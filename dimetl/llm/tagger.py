"""Character-level bidirectional LSTM with a linear-chain CRF, in numpy.

A small tagger over windows of characters: class embeddings, one LSTM in each
direction, a linear layer to tag scores and a CRF over tag transitions.  It is
trained by maximum likelihood (exact gradients, Adam) and decoded by Viterbi.
All steps work on a batch of equally long windows.
"""

from __future__ import annotations

import numpy as np

_FORBIDDEN = -1e4
#: Windows that go through the network together: few enough that a step stays in the processor's cache, and no power of two,
#: whose rows would share few lines of it.
_BLOCK = 528


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Parameters in ``self.p``; ``allowed[i, j]``: tag j may follow tag i."""

    def __init__(self, classes: int, tags: int, allowed: np.ndarray, start_allowed: np.ndarray, embed: int = 8, hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)

        def matrix(rows: int, cols: int) -> np.ndarray:
            return (rng.standard_normal((rows, cols)) / np.sqrt(rows)).astype(np.float32)

        self.hidden, self.tags = hidden, tags
        self.p = {"E": matrix(classes, embed), "O": matrix(2 * hidden, tags), "o": np.zeros(tags, np.float32)}
        for d in "fb":
            self.p[f"X{d}"], self.p[f"H{d}"] = matrix(embed, 4 * hidden), matrix(hidden, 4 * hidden)
            self.p[f"c{d}"] = np.zeros(4 * hidden, np.float32)
            self.p[f"c{d}"][hidden : 2 * hidden] = 1.0  # the forget gate starts open
        self.p["T"] = np.zeros((tags, tags), np.float32)
        self.p["S"] = np.zeros(tags, np.float32)
        self.blocked = np.where(allowed, 0.0, _FORBIDDEN).astype(np.float32)
        self.start_blocked = np.where(start_allowed, 0.0, _FORBIDDEN).astype(np.float32)

    # ----------------------------------------------------------- LSTM

    def _lstm(self, inputs: np.ndarray, d: str, keep: bool):
        """Hidden states (n, length, h) of inputs (n, length, e); ``keep`` returns what the gradient needs."""
        n, length, _ = inputs.shape
        h, c = np.zeros((n, self.hidden), np.float32), np.zeros((n, self.hidden), np.float32)
        pre = inputs @ self.p[f"X{d}"] + self.p[f"c{d}"]
        out, saved, k = np.empty((n, length, self.hidden), np.float32), [], self.hidden
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            z = pre[:, t] + h @ self.p[f"H{d}"]
            gates = _sigmoid(z[:, : 3 * k])
            new = np.tanh(z[:, 3 * k :])
            i, f, o = gates[:, :k], gates[:, k : 2 * k], gates[:, 2 * k :]
            before, h_before = c, h
            c = f * c + i * new
            squashed = np.tanh(c)
            h = o * squashed
            out[:, t] = h
            if keep:
                saved.append((t, h_before, before, i, f, o, new, squashed))
        return out, saved

    def _lstm_back(self, inputs: np.ndarray, grad: np.ndarray, d: str, saved: list, into: dict) -> np.ndarray:
        n = len(inputs)
        dh, dc = np.zeros((n, self.hidden), np.float32), np.zeros((n, self.hidden), np.float32)
        dz_all = np.empty((*inputs.shape[:2], 4 * self.hidden), np.float32)
        for t, h_before, before, i, f, o, new, squashed in reversed(saved):
            dh = dh + grad[:, t]
            dc = dc + dh * o * (1 - squashed**2)
            dz = np.concatenate(
                [dc * new * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - new**2)], axis=1
            )
            dz_all[:, t] = dz
            into[f"H{d}"] += h_before.T @ dz
            dh, dc = dz @ self.p[f"H{d}"].T, dc * f
        flat, dz_flat = inputs.reshape(-1, inputs.shape[2]), dz_all.reshape(-1, dz_all.shape[2])
        into[f"X{d}"] += flat.T @ dz_flat
        into[f"c{d}"] += dz_flat.sum(0)
        return dz_all @ self.p[f"X{d}"].T

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Tag scores (n, length, tags)."""
        return np.ascontiguousarray(self._scores(x).transpose(2, 0, 1))

    def _scores(self, x: np.ndarray) -> np.ndarray:
        """Tag scores (length, tags, n)."""
        scores = np.empty((x.shape[1], self.tags, len(x)), np.float32)
        for i in range(0, len(x), _BLOCK):
            self._block_scores(x[i : i + _BLOCK], scores[:, :, i : i + _BLOCK])
        return scores

    def _block_scores(self, x: np.ndarray, scores: np.ndarray) -> None:
        """Fills ``scores``; both directions in one loop, windows last so that a step's gates are blocks."""
        n, length = x.shape
        k, x = self.hidden, np.ascontiguousarray(x.T, np.intp)
        # Gates are 1 / (1 + 2 ** -z) and tanh(z) is 2 / (1 + 2 ** (-2 z)) - 1, with z times log2(e): the factors stand in the
        # weights, and the cells are kept times -2 log2(e). Powers of two take less time than exponentials and tanh.
        unit = np.float32(np.log2(np.e))
        factor = np.repeat(np.float32([-1, -1, -1, -2]) * unit, k)[:, None]
        # A step's input, as one block: the state before it, the character's embedding, a one for the bias. The product's last
        # rows are the tag scores of the state before.
        wide = self.p["E"].shape[1]
        weights = np.zeros((2, 4 * k + self.tags, k + wide + 1), np.float32)
        for own, d, tail in zip(weights, "fb", self.p["O"].reshape(2, k, self.tags), strict=True):
            own[: 4 * k] = np.concatenate([self.p[f"H{d}"], self.p[f"X{d}"], self.p[f"c{d}"][None]]).T * factor
            own[4 * k :, :k] = tail.T
        weights[0, 4 * k :, -1] = self.p["o"]
        chars = np.ones((length, wide + 1, n), np.float32)
        for own, classes in zip(chars, x, strict=True):
            own[:wide] = self.p["E"].take(classes, axis=0, mode="clip").T
        # Only this step's blocks are held, so they stay in the processor's cache.
        step, c = np.zeros((2, k + wide + 1, n), np.float32), np.zeros((2, k, n), np.float32)
        z, squashed = np.empty((2, 4 * k + self.tags, n), np.float32), np.empty((2, k, n), np.float32)
        state, gates, tail = step[:, :k], z[:, : 4 * k], z[:, 4 * k :]
        into, forget, out, new = (z[:, i * k : (i + 1) * k] for i in range(4))
        # A power too large for float32 is a gate of 0.
        with np.errstate(over="ignore"):
            for t in range(length + 1):
                if t < length:
                    step[0, k:], step[1, k:] = chars[t], chars[length - 1 - t]
                np.matmul(weights[0], step[0], out=z[0])
                np.matmul(weights[1], step[1], out=z[1])
                if t:
                    # A position's first half is set, its second added.
                    if 2 * t <= length + 1:
                        scores[t - 1] = tail[0]
                    else:
                        scores[t - 1] += tail[0]
                    if 2 * t <= length:
                        scores[length - t] = tail[1]
                    else:
                        scores[length - t] += tail[1]
                np.exp2(gates, out=gates)
                gates += 1
                np.divide(4 * unit, new, out=new)
                np.subtract(2 * unit, new, out=new)
                new /= into
                c /= forget
                c += new
                np.exp2(c, out=squashed)
                squashed += 1
                np.divide(2, squashed, out=squashed)
                squashed -= 1
                np.divide(squashed, out, out=state)

    # ----------------------------------------------------------- training

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of tags ``y`` for windows ``x`` (both n x length), and its gradients."""
        n, length = x.shape
        inputs = self.p["E"][x]
        (hf, sf), (hb, sb) = self._lstm(inputs, "f", True), self._lstm(inputs, "b", True)
        both = np.concatenate([hf, hb], axis=2)
        scores = both @ self.p["O"] + self.p["o"]
        trans, start = self.p["T"] + self.blocked, self.p["S"] + self.start_blocked

        alpha, beta = np.empty_like(scores), np.empty_like(scores)
        alpha[:, 0] = start + scores[:, 0]
        for t in range(1, length):
            alpha[:, t] = _logsumexp(alpha[:, t - 1][:, :, None] + trans, 1) + scores[:, t]
        beta[:, -1] = 0
        for t in range(length - 2, -1, -1):
            beta[:, t] = _logsumexp(trans + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        log_z = _logsumexp(alpha[:, -1], 1)

        rows, at = np.arange(n)[:, None], np.arange(length)
        gold = scores[rows, at, y].sum(1) + start[y[:, 0]] + trans[y[:, :-1], y[:, 1:]].sum(1)
        out = {k: np.zeros_like(v) for k, v in self.p.items()}
        d_scores = np.exp(alpha + beta - log_z[:, None, None])
        out["S"] = d_scores[:, 0].sum(0)
        for t in range(1, length):
            pair = alpha[:, t - 1][:, :, None] + trans + (scores[:, t] + beta[:, t])[:, None, :] - log_z[:, None, None]
            out["T"] += np.exp(pair).sum(0)
        d_scores[rows, at, y] -= 1
        np.add.at(out["S"], y[:, 0], -1)
        np.add.at(out["T"], (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)

        out["O"] = both.reshape(-1, both.shape[2]).T @ d_scores.reshape(-1, self.tags)
        out["o"] = d_scores.sum((0, 1))
        d_both = d_scores @ self.p["O"].T
        d_in = self._lstm_back(inputs, d_both[:, :, : self.hidden], "f", sf, out)
        d_in += self._lstm_back(inputs, d_both[:, :, self.hidden :], "b", sb, out)
        np.add.at(out["E"], x.ravel(), d_in.reshape(-1, d_in.shape[2]))
        return float((log_z - gold).mean()), {k: v / n for k, v in out.items()}

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 400, batch: int = 64, rate: float = 0.01, seed: int = 7) -> list[float]:
        """``steps`` of Adam over shuffled batches; returns the mean loss of each pass over the windows."""
        rng, step, history = np.random.default_rng(seed), 0, []
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        while step < steps:
            losses = []
            order = rng.permutation(len(x))
            for i in range(0, min(len(x), (steps - step) * batch), batch):
                rows = order[i : i + batch]
                loss, grads = self.gradients(x[rows], y[rows])
                losses.append(loss)
                step += 1
                norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / max(norm, 1e-9))
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.999 * square[k] + 0.001 * g * g
                    move = (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
                    self.p[k] -= (rate * move).astype(np.float32)
            history.append(float(np.mean(losses)))
        return history

    # ----------------------------------------------------------- decoding

    def _calm(self, scores: np.ndarray) -> np.ndarray:
        """Windows (of scores length, tags, n) no path of which beats tag 0 throughout: the forward pass of Viterbi, without pointers."""
        trans, start = self.p["T"] + self.blocked, self.p["S"] + self.start_blocked
        best = start[:, None] + scores[0]
        outside = best[0]
        paths = np.empty((self.tags, *best.shape), np.float32)
        for row in scores[1:]:
            np.add(best[:, None], trans[:, :, None], out=paths)
            best = paths.max(0) + row
            outside = (outside + trans[0, 0]) + row[0]
        return best.max(0) <= outside

    def _flat(self, scores: np.ndarray) -> np.ndarray:
        """Windows that a more lenient forward pass, which needs fewer sums, finds calm; all of them are calm.

        Scores are gains over staying outside, and a calm window's outside stays
        at 0.  Tags that only some tags may precede form a group with these; a
        group is entered at the cost of its cheapest step and keeps one sum, its
        best tag's, to which every tag of the group may add the most it can.
        """
        trans, start = self.p["T"] + self.blocked - self.p["T"][0, 0], self.p["S"] + self.start_blocked
        few = [j for j in range(1, self.tags) if (self.blocked[1:, j] < 0).any()]
        group = np.arange(self.tags)
        for j in few:
            for i in (self.blocked[:, j] == 0).nonzero()[0]:
                group[group == group[i]] = group[j]
        groups = [(group == g).nonzero()[0] for g in dict.fromkeys(group[1:])]
        if any(g[0] == 0 for g in groups):
            return np.zeros(scores.shape[2], bool)  # such a tag may follow tag 0 as well: no shorter way
        length, _, n = scores.shape
        enter, stay = np.full((2, length, len(groups), n), _FORBIDDEN, np.float32)
        best, leave = np.empty((len(groups), n), np.float32), np.empty((len(groups), 1), np.float32)
        own = np.empty((length, n), np.float32)
        for k, tags in enumerate(groups):
            leave[k] = trans[tags, 0].max()
            best[k] = (scores[0, tags] + (start[tags] - start[0])[:, None]).max(0) - scores[0, 0]
            for j in tags:
                into, cost = (stay, trans[tags, j].max()) if j in few else (enter, trans[:, j].max())
                np.subtract(scores[:, j], scores[:, 0], out=own)
                own += cost
                np.maximum(into[:, k], own, out=into[:, k])
        most, top = np.full_like(best, _FORBIDDEN), np.empty(n, np.float32)
        for entered, stayed in zip(enter[1:], stay[1:], strict=True):
            np.maximum(most, best, out=most)
            best.max(0, out=top)
            np.maximum(top, 0, out=top)
            best += stayed
            entered += top
            np.maximum(best, entered, out=best)
        # The hundredth covers what adding up a window's scores may round.
        return (best.max(0) < -0.01) & ((most + leave).max(0) < -0.01)

    def stirred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of all windows ``x``, the numbers of those in which some path beats tag 0 throughout, and their tag scores (n, length, tags)."""
        scores = self._scores(x)
        rest = (~self._flat(scores)).nonzero()[0]
        scores = scores[:, :, rest]
        moved = (~self._calm(scores)).nonzero()[0] if len(rest) else rest
        return rest[moved], np.ascontiguousarray(scores[:, :, moved].transpose(2, 0, 1))

    def decode(self, x: np.ndarray, at_once: int = 2 * _BLOCK) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi tags (n x length) and each position's score margin over tag 0.

        ``at_once`` windows go through the short pass together; the few that
        some path stirs are traced all at once.
        """
        tags, margin = np.zeros(x.shape, np.int8), np.zeros(x.shape, np.float32)
        found = [(i, *self.stirred(x[i : i + at_once])) for i in range(0, len(x), at_once)]
        if any(len(rest) for _, rest, _ in found):
            rest = np.concatenate([i + rest for i, rest, _ in found])
            tags[rest], margin[rest] = self._viterbi(np.concatenate([scores for _, _, scores in found]))
        return tags, margin

    def _viterbi(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, length, _ = scores.shape
        trans, back = self.p["T"] + self.blocked, np.empty(scores.shape, np.int8)
        best = self.p["S"] + self.start_blocked + scores[:, 0]
        for t in range(1, length):
            paths = best[:, :, None] + trans
            back[:, t] = paths.argmax(1)
            best = paths.max(1) + scores[:, t]
        tags = np.empty((n, length), np.int8)
        tags[:, -1] = best.argmax(1)
        rows = np.arange(n)
        for t in range(length - 1, 0, -1):
            tags[:, t - 1] = back[rows, t, tags[:, t]]
        margin = np.take_along_axis(scores, tags[:, :, None].astype(np.int64), 2)[:, :, 0] - scores[:, :, 0]
        return tags, margin
