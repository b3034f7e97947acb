"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's features describe it and its two neighbours; transitions tie
the labels of a text together. Forward and backward passes give each line's marginal, and the
marginals, weighted by the lengths of the lines, give the quality of the document, put on a
0-to-1 scale by a logistic curve.

Labels exist for documents only. Lines of good documents are good; of a bad document those lines
are bad that a model of single lines finds bad (at least the worst one). The fit uses a bounded,
hash-drawn sample on the driver, which receives the features of all lines of the whole texts;
texts are scored whole, in Arrow batches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientbook.llm.common import is_held_out, table
from clientbook.llm.fitting import calibrated, scored_texts, sigmoid, training_sample
from clientbook.llm.minhash import _word_hashes as word_hashes

THRESHOLD = 0.5
#: Score of a text without lines.
EMPTY = 0.5
_SYMBOLS = b"#$%&*@~^=+<>{}[]\\_"
_PIECE = 8 << 20
_CELLS = 1 << 18


def _classes() -> np.ndarray:
    of = np.zeros(256, dtype=np.int64)
    of[[*range(65, 91)]] = 1
    of[[*range(97, 123)]] = 2
    of[list(_SYMBOLS)] = 3
    of[ord("!")] = 4
    of[ord("|")] = 5
    of[48:58] = 6
    return of


_CLASS = _classes()
_OWN = 7
N_FEATURES = 1 + 3 * _OWN


def _own_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines, _OWN) features and the length in bytes of every non-empty line."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    if not len(data):
        return np.zeros((0, _OWN)), np.zeros(0)
    is_break = data == 10
    starts = np.concatenate(([0], np.flatnonzero(is_break) + 1))
    ends = np.concatenate((starts[1:] - 1, [len(data)]))
    counts = np.zeros((len(starts), 7))
    words, same = np.zeros(len(starts)), np.zeros(len(starts))
    first = 0
    for at in range(0, len(data), _PIECE):  # bounds the memory that one long text takes
        piece = data[at : at + _PIECE]
        line = np.cumsum(is_break[at : at + _PIECE])
        last = first + int(line[-1])
        here = slice(first, last + 1)
        counts[here] += np.bincount(line * 7 + _CLASS[piece], minlength=7 * (last + 1 - first)).reshape(-1, 7)
        hashes, where = word_hashes(piece, np.zeros(1, np.int64))
        if len(hashes):
            of = line[where]
            words[here] += np.bincount(of, minlength=last + 1 - first)
            again = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
            same[here] += np.bincount(of[1:][again], minlength=last + 1 - first)
        first = last
    filled = ends > starts
    if not filled.any():
        return np.zeros((0, _OWN)), np.zeros(0)
    size, counts = (ends - starts)[filled].astype(float), counts[filled]
    words, same = words[filled], same[filled]
    letters = np.maximum(counts[:, 1] + counts[:, 2], 1)
    own = np.column_stack(
        [
            counts[:, 1] / letters,
            np.sqrt(counts[:, 3] / size),
            np.sqrt(counts[:, 4] / size),
            np.sqrt(counts[:, 5] / size),
            np.sqrt(counts[:, 6] / size),
            same / np.maximum(words, 1),
            np.minimum(np.log1p(size) / 8, 1.5),
        ]
    )
    return own, size


def _with_neighbours(own: np.ndarray) -> np.ndarray:
    """(lines, N_FEATURES): a constant, a line's own features, and those of the lines around it."""
    if not len(own):
        return np.zeros((0, N_FEATURES))
    none = np.zeros((1, _OWN))
    before, after = np.vstack([none, own[:-1]]), np.vstack([own[1:], none])
    return np.column_stack([np.ones(len(own)), own, before, after])


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines, N_FEATURES) features and the length in bytes of every non-empty line."""
    own, size = _own_features(text)
    return _with_neighbours(own), size


def features(text: str | None) -> bytes:
    """Own features and length of every non-empty line."""
    return np.column_stack(_own_features(text)).tobytes()


def _lines(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """What ``line_features`` returns, from what ``features`` packed."""
    rows = np.frombuffer(packed).reshape(-1, _OWN + 1)
    return _with_neighbours(rows[:, :_OWN]), rows[:, _OWN]


@dataclass(frozen=True)
class Model:
    """Log odds of a good line per feature, log potentials of (from, to), and the final curve."""

    weights: tuple[float, ...]
    transitions: tuple[tuple[float, float], tuple[float, float]]
    scale: float
    shift: float

    def quality(self, features: np.ndarray, size: np.ndarray) -> float:
        """Length-weighted mean of the lines' marginals of being good."""
        good = marginals(features @ np.array(self.weights), self.transitions)
        return float((good * size).sum() / size.sum())

    def score(self, text: str | None) -> float:
        features, size = line_features(text)
        if not len(size):
            return EMPTY
        return float(sigmoid(self.scale * self.quality(features, size) + self.shift))


def marginals(odds: np.ndarray, transitions) -> np.ndarray:
    """P(good) of each line by a forward and a backward pass over log odds."""
    (bb, bg), (gb, gg) = transitions

    def passed(o: float, to_bad: tuple[float, float], to_good: tuple[float, float]) -> float:
        return _add(to_good[0], to_good[1] + o) - _add(to_bad[0], to_bad[1] + o)

    n, values = len(odds), odds.tolist()
    ahead, behind = [0.0] * n, [0.0] * n
    for t in range(1, n):
        ahead[t] = passed(ahead[t - 1] + values[t - 1], (bb, gb), (bg, gg))
    for t in range(n - 2, -1, -1):
        behind[t] = passed(behind[t + 1] + values[t + 1], (bb, bg), (gb, gg))
    return sigmoid(np.array(ahead) + odds + np.array(behind))


def _add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 400) -> np.ndarray:
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, steps + 1):
        grad = x.T @ (weight * (sigmoid(x @ w) - y)) + 1e-4 * w
        w, m, v = _adam(w, m, v, grad, step)
    return w


def _adam(w, m, v, grad, step, rate=0.1):
    m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
    return w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9), m, v


def _expected(odds: np.ndarray, trans: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (documents, lines) and summed pair marginals of padded chains, all at once."""
    n, length = odds.shape
    node = np.stack([np.zeros_like(odds), odds], axis=2)
    ahead, behind = np.zeros((n, length, 2)), np.zeros((n, length, 2))
    for t in range(1, length):
        ahead[:, t] = np.logaddexp.reduce((ahead[:, t - 1] + node[:, t - 1])[:, :, None] + trans, axis=1)
    for t in range(length - 2, -1, -1):
        passed = np.logaddexp.reduce((behind[:, t + 1] + node[:, t + 1])[:, None, :] + trans, axis=2)
        behind[:, t] = np.where(live[:, t + 1, None], passed, 0.0)
    total = ahead + node + behind
    good = sigmoid(total[:, :, 1] - total[:, :, 0])
    pairs = np.zeros((2, 2))
    if length > 1:
        joint = (ahead + node)[:, :-1, :, None] + trans + (behind + node)[:, 1:, None, :]
        joint -= np.logaddexp.reduce(np.logaddexp.reduce(joint, axis=3), axis=2)[:, :, None, None]
        pairs = (np.exp(joint) * live[:, 1:, None, None]).sum(axis=(0, 1))
    return good, pairs


def _blocks(lengths: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Chains in blocks of similar length: (live, lines), both (chains, longest), lines being row numbers.

    Padding takes less than half of a block, and a block of several chains has at most _CELLS cells.
    """
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
    blocks, block = [], []

    def close():
        longest = lengths[block].max()
        live = np.arange(longest) < lengths[block][:, None]
        blocks.append((live, np.where(live, firsts[block][:, None] + np.arange(longest), 0)))
        block.clear()

    for i in np.argsort(-lengths, kind="stable"):
        if block and (2 * lengths[i] <= lengths[block[0]] or lengths[block[0]] * (len(block) + 1) > _CELLS):
            close()
        block.append(int(i))
    close()
    return blocks


def fit(texts: list[str | None], quality: list[int], steps: int = 60) -> Model:
    """Learn from labelled texts. Without both classes every text gets the score of the share of good ones."""
    return fit_features([features(text) for text in texts], quality, steps)


def fit_features(packed: list[bytes], quality: list[int], steps: int = 60) -> Model:
    """Learn from what ``features`` makes of labelled texts."""
    rows = [(*_lines(each), y) for each, y in zip(packed, quality, strict=True) if each]
    y = np.array([r[2] for r in rows], dtype=np.int64)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return Model((0.0,) * N_FEATURES, ((0.0, 0.0), (0.0, 0.0)), 0.0, float(np.log(share / (1 - share))))
    x = np.vstack([r[0] for r in rows])
    of = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    share = np.concatenate([r[1] / r[1].sum() for r in rows])
    weight = share * np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())[of]
    alone = sigmoid(x @ _logistic(x, y[of].astype(float), weight))
    worst = np.full(len(rows), np.inf)
    np.minimum.at(worst, of, alone)
    label = np.where(y[of] == 1, 1.0, ((alone > 0.5) & (alone > worst[of])).astype(float))

    blocks = _blocks(np.bincount(of))
    truth = np.zeros((2, 2))
    joined = of[:-1] == of[1:]
    for a in (0, 1):
        for b in (0, 1):
            truth[a, b] = ((label[:-1] == a) & (label[1:] == b) & joined).sum()
    w, trans = _logistic(x, label, np.full(len(label), 1 / len(label))), np.zeros((2, 2))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(trans), np.zeros_like(trans)]
    for step in range(1, steps + 1):
        odds, good, pairs = x @ w, np.zeros(len(label)), np.zeros((2, 2))
        for live, lines in blocks:
            found, both = _expected(np.where(live, odds[lines], 0.0), trans, live)
            good[lines[live]] = found[live]
            pairs += both
        grad = x.T @ (good - label) / len(label) + 1e-4 * w
        grad_trans = (pairs - truth) / len(label) + 1e-3 * trans
        w, *moments[:2] = _adam(w, *moments[:2], grad, step)
        trans, *moments[2:] = _adam(trans, *moments[2:], grad_trans, step)
    plain = Model(tuple(w.tolist()), tuple(map(tuple, trans.tolist())), 1.0, 0.0)
    found = np.array([plain.quality(x, size) for x, size, _ in rows])
    return Model(plain.weights, plain.transitions, *calibrated(found, y))


def scored(documents: DataFrame, model: Model, name: str = "quality") -> DataFrame:
    """``documents`` with the score of each whole text; null, empty and blank-line texts get EMPTY."""

    def scorer(held: Model):
        return lambda texts: [held.score(t) for t in texts.to_pylist()]

    return scored_texts(documents, model, scorer, name)


def query(spark, folder: str) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; a row without an id is not held out."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = fit_features(*training_sample(documents, table(spark, folder, "labels"), "quality", features))
    judged = scored(documents, model, "score")
    return judged.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
