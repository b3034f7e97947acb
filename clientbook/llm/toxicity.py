"""A toxicity classifier with counterfactual regularisation.

A text is as toxic as its most toxic sentence: score = sigmoid(scale * max(w . x) + shift), x
being the distinct known terms of a sentence: its words, and their beginnings of four to six
letters, which stand for inflected forms. The sentence weights are learned from documents'
labels by multiple-instance rounds: of a toxic document its currently worst sentences count.
Labelled sentences that mention a group are also read with the mentioning word swapped for
others, before terms are made of it, and the squared difference of the two scores is a penalty. Neutral mentions then carry no weight of
their own, however often they occur in toxic sentences.

The fit uses a bounded, hash-drawn sample of labelled rows on the driver, which receives the words
of each sentence of the whole texts; texts are scored whole, in Arrow batches, one sentence at a time.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientbook.llm.common import is_held_out, table
from clientbook.llm.fitting import calibrated, scored_texts, sigmoid, training_sample

#: Groups of terms that may be swapped for one another.
IDENTITY_GROUPS = (
    ("men", "women"),
    ("man", "woman"),
    ("boys", "girls"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "hispanic", "african", "european"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("immigrants", "foreigners", "refugees", "natives", "citizens"),
    ("old", "young", "elderly", "teenage"),
    ("disabled", "blind", "deaf", "autistic"),
    ("männer", "frauen"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("einwanderer", "ausländer", "flüchtlinge", "einheimische"),
    ("hommes", "femmes"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("immigrés", "étrangers", "réfugiés", "citoyens"),
    ("hombres", "mujeres"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("inmigrantes", "extranjeros", "refugiados", "ciudadanos"),
)
#: Weight of the squared score change under swaps against the mean loss of the sentences.
FAIRNESS = 20.0
#: At most so many terms are learned; a term must be in so many documents (fewer in small samples).
MOST_TERMS = 20_000
LEAST_DOCUMENTS = 8
#: Log odds that a term must surely have (two standard errors) to be learned from.
SURE_ODDS = 0.5
THRESHOLD = 0.7

_SENTENCE = re.compile(r"[.!?\n\r]+")
_WORD = re.compile(r"[^\W\d_]+")
_BEGINNINGS = (4, 5, 6)
_MEMO_WORDS = 200_000


def _terms(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in _BEGINNINGS if len(word) >= n)]


class _Terms(dict):
    """Word to all its terms; equal terms are one object, which keeps a sample's sentences small."""

    def __missing__(self, word: str) -> tuple[str, ...]:
        self[word] = found = tuple(map(sys.intern, _terms(word)))
        return found


class _Known(dict):
    """Word to its known terms, worked out once per word; emptied when it gets large."""

    def __init__(self, known):
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= _MEMO_WORDS:
            self.clear()
        self[word] = found = tuple(t for t in _terms(word) if t in self.known)
        return found


@dataclass(frozen=True)
class Model:
    """Weight per term, and the scale and shift that turn the worst sentence into a score."""

    weights: dict[str, float]
    scale: float
    shift: float

    def worst(self, text: str | None, memo: _Known | None = None) -> float:
        """Largest sentence sum of the weights of its distinct known terms; at least 0."""
        memo = _Known(self.weights) if memo is None else memo
        if not text:
            return 0.0
        text = text.lower()
        if not any(map(memo.__getitem__, _WORD.findall(text))):
            return 0.0
        most = 0.0
        for sentence in _SENTENCE.split(text):
            found = {t for word in _WORD.findall(sentence) for t in memo[word]}
            if found:
                most = max(most, sum(self.weights[t] for t in sorted(found)))
        return most

    def score(self, text: str | None, memo: _Known | None = None) -> float:
        return float(sigmoid(self.scale * self.worst(text, memo) + self.shift))


def _swaps(groups: tuple[tuple[str, ...], ...]) -> dict[str, tuple[str, ...]]:
    """Each term with the others of all groups that hold it."""
    found: dict[str, dict[str, None]] = {}
    for group in groups:
        for term in group:
            found.setdefault(term, {}).update(dict.fromkeys(o for o in group if o != term))
    return {term: tuple(others) for term, others in found.items()}


class _Rows:
    """Sparse 0/1 rows: term ids of all rows one after the other."""

    def __init__(self, rows: list[list[int]]):
        self.term = np.array([t for row in rows for t in row], dtype=np.int64)
        self.row = np.repeat(np.arange(len(rows)), [len(row) for row in rows])
        self.n = len(rows)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=weights[self.term], minlength=self.n)

    def back(self, values: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.term, weights=values[self.row], minlength=width)


def _fit_weights(x: _Rows, y, weight, swapped: _Rows, origin, width, ridge, fairness, start, steps=150):
    """Logistic loss + ridge + fairness * squared change of the score under swaps, by Adam."""
    w, bias = start
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        p = sigmoid(x.dot(w) + bias)
        error = weight * (p - y)
        grad, grad_bias = x.back(error, width) + ridge * w, error.sum()
        if swapped.n:
            q = sigmoid(swapped.dot(w) + bias)
            gap = fairness / swapped.n * 2 * (p[origin] - q)
            here = np.bincount(origin, weights=gap * p[origin] * (1 - p[origin]), minlength=x.n)
            there = gap * q * (1 - q)
            grad += x.back(here, width) - swapped.back(there, width)
            grad_bias += here.sum() - there.sum()
        g = np.append(grad, grad_bias)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return w, bias


def features(text: str | None) -> bytes:
    """The distinct words of each sentence: numbers of words, -1 after each sentence, then the words."""
    known: dict[str, int] = {}
    found = []
    for sentence in _SENTENCE.split((text or "").lower()):
        if sentence.strip():
            found += sorted({known.setdefault(word, len(known)) for word in _WORD.findall(sentence)})
            found.append(-1)
    return np.array([len(found), *found], "<i4").tobytes() + "\n".join(known).encode("utf-8", "surrogatepass")


def _sentences(packed: bytes) -> list[tuple[str, ...]]:
    """What ``features`` packed; equal words are one object."""
    size = 4 + 4 * int(np.frombuffer(packed, "<i4", 1)[0])
    words = [sys.intern(word) for word in packed[size:].decode("utf-8", "surrogatepass").split("\n")]
    ids = np.frombuffer(packed[4:size], "<i4")
    ends = np.flatnonzero(ids < 0)
    starts = [0, *(ends[:-1] + 1)]
    return [tuple(words[i] for i in ids[a:b]) for a, b in zip(starts, ends, strict=False)]


def fit(
    texts: list[str | None],
    toxic: list[int],
    fairness: float = FAIRNESS,
    rounds: int = 3,
    groups: tuple[tuple[str, ...], ...] = IDENTITY_GROUPS,
) -> Model:
    """Learn from labelled texts. Without both classes the score is the share of toxic texts."""
    return fit_features([features(text) for text in texts], toxic, fairness, rounds, groups)


def fit_features(
    packed: list[bytes],
    toxic: list[int],
    fairness: float = FAIRNESS,
    rounds: int = 3,
    groups: tuple[tuple[str, ...], ...] = IDENTITY_GROUPS,
) -> Model:
    """Learn from what ``features`` makes of labelled texts; lower-case terms of a group are swapped for one another."""
    terms_of = _Terms()
    split = [_sentences(each) for each in packed]
    toxic = np.array(toxic, dtype=np.int64)
    if not len(toxic) or toxic.min() == toxic.max():
        share = float(np.clip(toxic.mean() if len(toxic) else 0.0, 0.01, 0.99))
        return Model({}, 1.0, float(np.log(share / (1 - share))))
    own = _without_near_copies(split)
    seen = (Counter(), Counter())
    for i in own:
        seen[toxic[i]].update({t for word in {word for s in split[i] for word in s} for t in terms_of[word]})
    n = np.bincount(toxic[own], minlength=2)
    odds, sure = {}, {}
    for t in seen[0].keys() | seen[1].keys():
        if seen[0][t] + seen[1][t] >= min(LEAST_DOCUMENTS, max(5, len(own) // 100)):
            odds[t] = np.log((seen[1][t] + 0.5) / (n[1] + 1)) - np.log((seen[0][t] + 0.5) / (n[0] + 1))
            error = (1 / (seen[1][t] + 0.5) + 1 / (seen[0][t] + 0.5)) ** 0.5
            sure[t] = abs(odds[t]) - 2 * error
    terms = sorted((t for t in odds if sure[t] > SURE_ODDS), key=lambda t: (-sure[t], t))[:MOST_TERMS]
    others = _swaps(groups)
    chosen_terms = set(terms)
    partners = {o for word in others if not chosen_terms.isdisjoint(terms_of[word]) for o in others[word]}
    terms += sorted({t for o in partners for t in terms_of[o]} - chosen_terms)
    at = {t: i for i, t in enumerate(terms)}
    width = len(terms)

    def row_of(words) -> list[int]:
        return sorted({at[t] for word in words for t in terms_of[word] if t in at})

    ids = [[row_of(words) for words in sentences] for sentences in split]
    # Of each sentence the rows that it becomes by a swap; rows that a swap leaves as they are say nothing.
    swaps = [
        [
            [
                new
                for word in words if word in others
                for other in others[word] if (new := row_of({*words, other} - {word})) != row
            ]
            for words, row in zip(sentences, rows, strict=True)
        ]
        for sentences, rows in zip(split, ids, strict=True)
    ]
    del split, terms_of
    # A term that many toxic documents share starts ahead of one that a few copies share.
    w = np.array([max(0.0, odds.get(t, 0.0)) * np.log1p(seen[1][t]) / np.log1p(n[1]) for t in terms])
    bias = -3.0
    for _ in range(rounds):
        chosen, changed, label, weight = [], [], [], []
        for sentences, new, is_toxic in zip(ids, swaps, toxic, strict=True):
            if not sentences:
                continue
            if is_toxic:
                sums = [sum(w[row]) for row in sentences]
                worst = [i for i, x in enumerate(sums) if x >= 0.3 * max(sums)]
                chosen += [sentences[i] for i in worst]
                changed += [new[i] for i in worst]
                label += [1.0] * len(worst)
                weight += [0.5 / n[1] / len(worst)] * len(worst)
            else:
                chosen += sentences
                changed += new
                label += [0.0] * len(sentences)
                weight += [0.5 / n[0] / len(sentences)] * len(sentences)
        swapped = [row for new in changed for row in new]
        origin = [i for i, new in enumerate(changed) for _ in new]
        w, bias = _fit_weights(
            _Rows(chosen), np.array(label), np.array(weight), _Rows(swapped),
            np.array(origin, dtype=np.int64), width, 1e-4, fairness, (w, bias),
        )
    weights = {t: float(round(x, 6)) for t, x in zip(terms, w, strict=True) if abs(x) > 0.02}
    final = [weights.get(t, 0.0) for t in terms]
    worst = [max([0.0, *(sum(final[t] for t in row) for row in sentences)]) for sentences in ids]
    return Model(weights, *calibrated(np.array(worst), toxic))


def _without_near_copies(split: list[list[tuple[str, ...]]]) -> list[int]:
    """Texts of which at least half the sentences are new; copies would count a text's words often."""
    known: set[int] = set()
    kept = []
    for i, sentences in enumerate(split):
        keys = {hash(frozenset(s)) for s in sentences if s}
        if not keys or 2 * len(keys & known) <= len(keys):
            kept.append(i)
        known |= keys
    return kept


def scored(documents: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """``documents`` with the score of each whole text as column ``name``, which must not be there yet.

    Null and empty texts score like harmless ones. Each row is scored by its own text, so repeated rows
    score alike; texts of any length are read whole, and an empty table gives an empty one.
    """

    def scorer(held: Model):
        memo = _Known(held.weights)
        return lambda texts: [held.score(t, memo) for t in texts.to_pylist()]

    return scored_texts(documents, model, scorer, name)


def query(spark, folder: str) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; a row without an id is not held out."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = fit_features(*training_sample(documents, table(spark, folder, "labels"), "toxic", features))
    judged = scored(documents, model, "score")
    return judged.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
