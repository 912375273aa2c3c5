"""Sequence tagger over characters: a bidirectional LSTM under a CRF, in numpy.

Windows are rows of ``WINDOW`` symbols, many at a time. A symbol is a letter
without its case, a sign, a digit (all alike) or a class of other characters. Both
directions run in one loop. The CRF scores neighbouring tags; pairs of tags that no
span can have are ruled out.
"""

from __future__ import annotations

import numpy as np

WINDOW = 80
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~ "
PAD, DIGIT, BREAK, LETTER, OTHER = 0, 1, 2, 3, 4
SYMBOLS = 5 + 26 + len(_SIGNS)
#: Symbol of each ASCII character.
_ASCII = np.full(128, OTHER, dtype=np.uint8)
_ASCII[[ord(c) for c in "0123456789"]] = DIGIT
_ASCII[[9, 10, 11, 12, 13]] = BREAK
for _i in range(26):
    _ASCII[[65 + _i, 97 + _i]] = 5 + _i
for _i, _c in enumerate(_SIGNS):
    _ASCII[ord(_c)] = 31 + _i

KINDS = ("email", "ip", "card", "phone")
#: Tags: outside, then first and further characters of each kind.
TAGS = 1 + 2 * len(KINDS)
HIDDEN = 12
#: Windows a step, steps, size of the first steps.
BATCH, STEPS, STEP = 64, 600, 0.02
_NEVER = -1e4
_GAMMA = np.array([0.5] * (3 * HIDDEN) + [1.0] * HIDDEN, dtype=np.float32)


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.full(len(points), LETTER, dtype=np.uint8)
    low = points < 128
    out[low] = _ASCII[points[low]]
    out[points >= 0x2000] = OTHER
    return out


def _ruled_out() -> np.ndarray:
    """[TAGS, TAGS]: whether the second tag can't follow the first."""
    out = np.zeros((TAGS, TAGS), dtype=bool)
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = True
        out[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = False
    return out


class Tagger:
    """Weights: ``inputs`` [2, SYMBOLS, 4H], ``again`` [2, H, 4H], ``out`` [2H, TAGS], ``bias`` [TAGS], ``moves`` [TAGS, TAGS]."""

    NAMES = ("inputs", "again", "out", "bias", "moves")
    SHAPES = ((2, SYMBOLS, 4 * HIDDEN), (2, HIDDEN, 4 * HIDDEN), (2 * HIDDEN, TAGS), (TAGS,), (TAGS, TAGS))

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights
        self.never = np.where(_ruled_out(), np.float32(_NEVER), np.float32(0))

    @staticmethod
    def new(seed: int = 7) -> Tagger:
        rng = np.random.default_rng(seed)
        w = {n: rng.normal(0, 0.3 if n == "again" else 0.1, s).astype(np.float32) for n, s in zip(Tagger.NAMES, Tagger.SHAPES, strict=True)}
        w["inputs"][:, :, HIDDEN : 2 * HIDDEN] += 1  # memory is kept at first
        return Tagger(w)

    def to_bytes(self) -> bytes:
        return b"".join(self.w[n].tobytes() for n in self.NAMES)

    @staticmethod
    def from_bytes(data: bytes) -> Tagger:
        flat, at, w = np.frombuffer(data, dtype=np.float32), 0, {}
        for name, shape in zip(Tagger.NAMES, Tagger.SHAPES, strict=True):
            size = int(np.prod(shape))
            w[name] = flat[at : at + size].reshape(shape)
            at += size
        return Tagger(w)

    # forward ---------------------------------------------------------------

    def _run(self, ids: np.ndarray, keep: bool = False):
        """Hidden values [L, 2, B, H], the second direction from the end on; with ``keep`` what the way back needs."""
        ids = ids.T.astype(np.intp)
        both = np.stack((ids, ids[::-1]), axis=1)  # [L, 2, B]
        length, _, n = both.shape
        h = c = np.zeros((2, n, HIDDEN), dtype=np.float32)
        hidden = np.empty((length, 2, n, HIDDEN), dtype=np.float32)
        gates = np.empty((length, 2, n, 4 * HIDDEN), dtype=np.float32) if keep else None
        cells = np.empty((length, 2, n, HIDDEN), dtype=np.float32) if keep else None
        inputs, again = self.w["inputs"], self.w["again"]
        for t in range(length):
            z = h @ again
            z[0] += inputs[0][both[t, 0]]
            z[1] += inputs[1][both[t, 1]]
            z *= _GAMMA
            np.tanh(z, out=z)
            z[:, :, : 3 * HIDDEN] = 0.5 * z[:, :, : 3 * HIDDEN] + 0.5  # in, forget, out by the logistic function; then the new value
            c = z[:, :, HIDDEN : 2 * HIDDEN] * c + z[:, :, :HIDDEN] * z[:, :, 3 * HIDDEN :]
            h = z[:, :, 2 * HIDDEN : 3 * HIDDEN] * np.tanh(c)
            hidden[t] = h
            if keep:
                gates[t], cells[t] = z, c
        return hidden, gates, cells, both

    def _emissions(self, hidden: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        joined = np.concatenate((hidden[:, 0], hidden[::-1, 1]), axis=2)  # [L, B, 2H]
        return joined @ self.w["out"] + self.w["bias"], joined

    def _marginals(self, scores: np.ndarray):
        """Log likelihood of all taggings [B], marginals [L, B, TAGS], expected pairs [TAGS, TAGS]."""
        length, n, _ = scores.shape
        moves = np.exp(self.w["moves"] + self.never)  # ruled-out pairs are zero
        peak = scores.max(axis=2, keepdims=True)
        local = np.exp(scores - peak)
        ahead, back = np.empty_like(local), np.empty_like(local)
        total = peak.sum(axis=(0, 2)).astype(np.float64)
        first = local[0].copy()
        first[:, 2::2] = 0  # no span starts before its window
        for t in range(length):
            a = first if t == 0 else (ahead[t - 1] @ moves) * local[t]
            size = a.sum(axis=1, keepdims=True)
            total += np.log(size[:, 0])
            ahead[t] = a / size
        back[-1] = 1
        pairs = np.zeros((TAGS, TAGS), dtype=np.float64)
        for t in range(length - 2, -1, -1):
            b = back[t + 1] * local[t + 1]
            b /= b.sum(axis=1, keepdims=True)
            after = b @ moves.T
            size = (ahead[t] * after).sum(axis=1, keepdims=True)
            pairs += (ahead[t] / size).T @ b * moves
            back[t] = after / after.sum(axis=1, keepdims=True)
        both = ahead * back
        return total, both / both.sum(axis=2, keepdims=True), pairs

    def best(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of each window [B, L], and the probability of each of them."""
        scores, _ = self._emissions(self._run(ids)[0])
        length, n, _ = scores.shape
        moves = self.w["moves"] + self.never
        value = scores[0].copy()
        value[:, 2::2] = _NEVER
        came = np.empty((length, n, TAGS), dtype=np.uint8)
        for t in range(1, length):
            ways = value[:, :, None] + moves
            came[t] = ways.argmax(axis=1)
            value = ways.max(axis=1) + scores[t]
        tags = np.empty((length, n), dtype=np.uint8)
        tags[-1] = value.argmax(axis=1)
        rows = np.arange(n)
        for t in range(length - 1, 0, -1):
            tags[t - 1] = came[t][rows, tags[t]]
        _, likely, _ = self._marginals(scores)
        return tags.T, np.take_along_axis(likely, tags[:, :, None].astype(np.intp), axis=2)[:, :, 0].T

    # learning --------------------------------------------------------------

    def gradient(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss per window and its derivatives."""
        hidden, gates, cells, both = self._run(ids, keep=True)
        scores, joined = self._emissions(hidden)
        length, n, _ = scores.shape
        tags = tags.T.astype(np.intp)
        total, likely, pairs = self._marginals(scores)
        rows = np.arange(n)
        given = np.take_along_axis(scores, tags[:, :, None], axis=2).sum() + self.w["moves"][tags[:-1], tags[1:]].sum()
        loss = float(total.sum() - given) / n

        d_scores = likely.astype(np.float32)
        for t in range(length):
            d_scores[t, rows, tags[t]] -= 1
        d_scores /= n
        seen = np.zeros((TAGS, TAGS))
        np.add.at(seen, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        flat = d_scores.reshape(-1, TAGS)
        out = {
            "moves": ((pairs - seen) / n).astype(np.float32) * ~_ruled_out(), "bias": flat.sum(axis=0),
            "out": joined.reshape(-1, 2 * HIDDEN).T @ flat,
        }
        d_joined = d_scores @ self.w["out"].T
        d_hidden = np.stack((d_joined[:, :, :HIDDEN], d_joined[::-1, :, HIDDEN:]), axis=1)  # [L, 2, B, H]

        d_z = np.empty_like(gates)
        d_h = d_c = np.zeros((2, n, HIDDEN), dtype=np.float32)
        turned = self.w["again"].transpose(0, 2, 1)
        for t in range(length - 1, -1, -1):
            z, c = gates[t], cells[t]
            i, f, o, g = (z[:, :, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
            d_h = d_h + d_hidden[t]
            bent = np.tanh(c)
            d_c = d_c + d_h * o * (1 - bent * bent)
            before = cells[t - 1] if t else np.zeros_like(c)
            d = d_z[t]
            d[:, :, :HIDDEN] = d_c * g * i * (1 - i)
            d[:, :, HIDDEN : 2 * HIDDEN] = d_c * before * f * (1 - f)
            d[:, :, 2 * HIDDEN : 3 * HIDDEN] = d_h * bent * o * (1 - o)
            d[:, :, 3 * HIDDEN :] = d_c * i * (1 - g * g)
            d_h, d_c = d @ turned, d_c * f
        d_inputs = np.zeros_like(self.w["inputs"])
        d_again = np.zeros_like(self.w["again"])
        for k in range(2):
            flat_z = d_z[:, k].reshape(-1, 4 * HIDDEN)
            at = both[:, k].ravel()
            order = np.argsort(at, kind="stable")
            used, starts = np.unique(at[order], return_index=True)
            d_inputs[k][used] = np.add.reduceat(flat_z[order], starts, axis=0)
            d_again[k] = hidden[:-1, k].reshape(-1, HIDDEN).T @ d_z[1:, k].reshape(-1, 4 * HIDDEN)
        out["inputs"], out["again"] = d_inputs, d_again
        return loss, out


def train(ids: np.ndarray, tags: np.ndarray, steps: int = STEPS) -> Tagger:
    """Tagger of windows [n, WINDOW] and their tags, by adaptive moments; the same windows give the same tagger."""
    rng = np.random.default_rng(11)
    tagger = Tagger.new()
    mean = {n: np.zeros_like(w) for n, w in tagger.w.items()}
    square = {n: np.zeros_like(w) for n, w in tagger.w.items()}
    order = np.zeros(0, dtype=np.intp)
    for k in range(1, steps + 1):
        if len(order) < BATCH:
            order = np.concatenate((order, rng.permutation(len(ids))))
        part, order = order[:BATCH], order[BATCH:]
        _, grads = tagger.gradient(ids[part], tags[part])
        rate = STEP * (1 - 0.95 * k / steps)
        for name, g in grads.items():
            g = np.clip(g, -5, 5)
            mean[name] = 0.9 * mean[name] + 0.1 * g
            square[name] = 0.99 * square[name] + 0.01 * g * g
            tagger.w[name] -= (rate * (mean[name] / (1 - 0.9**k)) / (np.sqrt(square[name] / (1 - 0.99**k)) + 1e-8)).astype(np.float32)
    return tagger
