"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One vector of weights over hashed text features gives a document a place on
a line; ordered thresholds cut the line into grades: P(grade <= k) =
sigmoid(threshold_k - place).  From these come the expected grade and the
tail probability P(grade >= k) that selection uses.

Features.  A word's shape (runs of lower, upper, digit and other
characters), its last character if that's no letter, and whether it repeats
the word before count as shares of the words, times ``SHARES``: junk is a
matter of degree.  The word itself and its first three, four and five letters
count once if the text has them at all: one word of hundreds can tell a
grade, and a mean would dilute it.  Of these, only features are used whose
presence differs between a grade and the others by ``TELLING`` standard
errors in the sample; the rest have weight zero, so long texts don't add up
noise.  A word's share and its telling features are kept in bounded tables.

Ratings of the query: 0 for quality 0, 1 for quality 1 with toxic 1, 2 for
quality 1 with toxic 0.  A document is kept if P(grade >= 1) >= 0.5.

The model is fitted on the driver on a bounded sample of rated rows outside
the held-out fold (``PER_GRADE``, ``MAX_CHARS``); grades weigh as the power
``EVEN`` of their share among all rated rows, so that a rare grade is heard.

Defined results: null and empty texts have place zero on the line before
the thresholds; without ratings of two grades at least every document has
the one grade that there is (grade 0 without any, and then all are kept,
since nothing speaks against them); a null id is not held out; repeated
rows are scored alike; an empty table gives an empty result.  Only the
named columns are read.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.labelled import in_fold, sample_labelled
from sievework.llm.workers import map_batches, slices

#: Rated documents the model is fitted on, by grade, and their characters in all.
PER_GRADE, MAX_CHARS = 1500, 16_000_000
SIZE = 1 << 15
ROUNDS, RATE, SHRINK = 120, 0.15, 1e-3
#: Words whose share a worker keeps.
REMEMBERED = 300_000
#: Weight of shares against presences, standard errors of a telling feature, and the power of a grade's share.
SHARES, TELLING, EVEN = 20.0, 8.0, 0.25
_RUNS = ((re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+"), "a"), (re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile(r"\d+"), "9"))
_STRIP = "\"'`.,;:!?()[]{}<>#$%&*|"


def shape_of(word: str) -> str:
    """Runs of lower, upper, digit and other characters, each as one letter; others as they are, each run once."""
    if word.isalpha() and word.islower():
        return "a"
    for pattern, letter in _RUNS:
        word = pattern.sub(letter, word)
    return re.sub(r"(.)\1+", r"\1", word)


def _hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % (SIZE - 1) + 1


_PLAIN_END = _hash("l")


@functools.lru_cache(maxsize=10_000)
def _hash_shape(shape: str) -> int:
    return _hash("s" + shape)


def degrees(word: str) -> tuple[int, int]:
    """Hashed features of one word that count as shares."""
    last = word[-1]
    if last.isalnum():
        return _hash_shape(shape_of(word)), _PLAIN_END
    body = word[:-1]
    shape = "a" + last if body.isalpha() and body.islower() else shape_of(word)
    return _hash_shape(shape), _hash("l" + last)


def signs(word: str) -> set[int]:
    """Hashed features of one word that count once in a text."""
    bare = word.lower().strip(_STRIP)
    return {_hash("w" + bare), *(_hash(f"{n}{bare[:n]}") for n in (3, 4, 5))} if bare else set()


#: The feature of a word that repeats the one before.
AGAIN = 0


def text_features(text: str | None) -> tuple[dict[int, float], set[int]]:
    """(shares by feature, features that are there) of a whole text."""
    words = (text or "").split()
    shares = Counter({AGAIN: sum(map(str.__eq__, words, words[1:]))})
    found: set[int] = set()
    for word, n in Counter(words).items():
        for f in degrees(word):
            shares[f] += n
        found |= signs(word)
    return {f: SHARES * n / max(1, len(words)) for f, n in shares.items()}, found


def telling(found: list[set[int]], grade: np.ndarray, grades: int) -> np.ndarray:
    """Which features are present at rates that differ between a grade and the others by ``TELLING`` standard errors."""
    present, size = np.zeros((grades, SIZE)), np.bincount(grade, minlength=grades)
    for f, g in zip(found, grade, strict=True):
        present[g, list(f)] += 1
    out = np.zeros(SIZE, bool)
    for g in range(grades):
        here, there, n, m = present[g], present.sum(0) - present[g], size[g], size.sum() - size[g]
        pooled = (here + there) / (n + m)
        out |= np.abs(here / n - there / m) >= TELLING * np.sqrt(np.maximum(pooled * (1 - pooled), 1e-9) * (1 / n + 1 / m))
    return out


class Model:
    """Weights and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray, only: int | None = None, used: np.ndarray | None = None):
        self.weights, self.thresholds, self.only = weights, thresholds, only
        self.used = np.zeros(len(weights), bool) if used is None else used

    def tails(self, place: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... of places on the line."""
        return 1 / (1 + np.exp(-np.clip(place[:, None] - self.thresholds[None, :], -40, 40)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def loss_and_gradients(place: np.ndarray, cuts: np.ndarray, grade: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The weighted negative log-likelihood of grades at places on the line, and its gradients by place and by cut."""
    n, i = len(place), np.arange(len(place))
    below = np.concatenate([np.zeros((n, 1)), _sigmoid(cuts[None, :] - place[:, None]), np.ones((n, 1))], axis=1)
    steep = below * (1 - below)
    p = np.maximum(below[i, grade + 1] - below[i, grade], 1e-12)
    upper, lower = steep[i, grade + 1] / p, steep[i, grade] / p  # d log p / d cut above, and minus that of the cut below
    to_cuts = np.bincount(grade + 1, -weight * upper, minlength=len(cuts) + 2) + np.bincount(grade, weight * lower, minlength=len(cuts) + 2)
    return float(-(weight * np.log(p)).sum()), weight * (upper - lower), to_cuts[1:-1]


def fit(rows: list[tuple[int, str]], share: dict[int, float] | None = None) -> Model:
    """Fit rows (grade, text); ``share`` is the grades' share among all rated rows."""
    grades = sorted({r[0] for r in rows})
    if len(grades) < 2:
        return Model(np.zeros(SIZE), np.zeros(0), grades[0] if grades else None)
    grade = np.searchsorted(grades, [r[0] for r in rows])
    made = [text_features(text) for _, text in rows]
    used = telling([f for _, f in made], grade, len(grades))
    merged = [Counter(shares) + Counter({f: 1.0 for f in found if used[f]}) for shares, found in made]
    column, value = np.array([f for m in merged for f in m], np.int64), np.array([v for m in merged for v in m.values()])
    row = np.repeat(np.arange(len(rows)), [len(m) for m in merged])
    weight = np.array([(share or {}).get(g, 1.0) ** EVEN / (grade == i).sum() for i, g in enumerate(grades)])[grade]
    weight = weight / weight.sum()
    weights, cuts = np.zeros(SIZE), np.linspace(-1, 1, len(grades) - 1) if len(grades) > 2 else np.zeros(1)
    first, gaps = cuts[0], np.log(np.maximum(np.diff(cuts), 1e-3))  # cuts = first + sums of exp(gaps): ordered by construction
    moments = [[np.zeros(SIZE), np.zeros(SIZE)], [np.zeros(len(cuts)), np.zeros(len(cuts))]]
    for step in range(1, ROUNDS + 1):
        cuts = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        place = np.bincount(row, weights[column] * value, minlength=len(rows))
        _, to_place, to_cuts = loss_and_gradients(place, cuts, grade, weight)
        inner = np.concatenate([[to_cuts.sum()], [to_cuts[k + 1 :].sum() * np.exp(gaps[k]) for k in range(len(gaps))]])
        outer = np.bincount(column, to_place[row] * value, minlength=SIZE) + SHRINK * weights
        rate = RATE * (1 - step / (ROUNDS + 1))
        out = []
        for g, m in ((outer, moments[0]), (inner, moments[1])):
            m[0] += 0.1 * (g - m[0])
            m[1] += 0.02 * (g * g - m[1])
            out.append(rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.98**step)) + 1e-10))
        weights -= out[0]
        first -= out[1][0]
        gaps -= out[1][1:]
    return Model(weights, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]), used=used)


class Placer:
    """Places whole texts on the line."""

    def __init__(self, model: Model):
        self.weights = model.weights
        self.used = {int(f): float(model.weights[f]) for f in np.flatnonzero(model.used)}
        self.share: dict[str, float] = {}
        self.tells: dict[str, tuple[int, ...]] = {}

    def _learn(self, words: set[str]) -> None:
        if len(self.share) > REMEMBERED:
            self.share, self.tells = {}, {}
        weights, used = self.weights, self.used
        for w in words:
            if w not in self.share:
                a, b = degrees(w)
                self.share[w] = float(weights[a] + weights[b])
                if found := [f for f in signs(w) if f in used]:
                    self.tells[w] = tuple(found)

    def place(self, text: str | None) -> float:
        words = (text or "").split()
        if not words:
            return 0.0
        different = set(words)
        if not different <= self.share.keys():
            self._learn(different)
        share, tells = self.share, self.tells
        total = sum([share[w] for w in words]) + float(self.weights[AGAIN]) * sum(map(str.__eq__, words, words[1:]))
        there = {f for w in different if w in tells for f in tells[w]}
        return SHARES * total / len(words) + sum([self.used[f] for f in sorted(there)])


def grade_column():
    """The rating of a row of ``labels``."""
    return F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)


def train(docs: DataFrame, labels: DataFrame, text_col="text") -> Model:
    """Fit the model on rated documents (``labels``: doc_id, quality, toxic)."""
    share = {r["g"]: float(r["n"]) for r in labels.select(grade_column().alias("g")).where("g is not null").groupBy("g").agg(F.count("*").alias("n")).collect()}  # a row a grade
    rows = sample_labelled(docs, labels, grade_column(), dict.fromkeys((0, 1, 2), PER_GRADE), MAX_CHARS, text_col=text_col)
    return fit(rows, share)


def rate(docs: DataFrame, model: Model, id_col="doc_id", text_col="text") -> DataFrame:
    """Per document: doc_id, held_out, expected_grade, p_usable = P(grade >= 1), p_best = P(highest grade), kept."""

    def run(batches):
        placer = Placer(model)
        for part in slices(batches):
            place = np.array([placer.place(t) for t in part.column(1).to_pylist()])
            if len(model.thresholds):
                tails = model.tails(place)
                grade, usable, best = tails.sum(1), tails[:, 0], tails[:, -1]
            else:
                grade = np.full(len(place), float(model.only or 0))
                usable = best = np.full(len(place), 1.0 if model.only is None or model.only >= 1 else 0.0)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, pa.float64()) for x in (grade, usable, best))], ["doc_id", "expected_grade", "p_usable", "p_best"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rated = map_batches(narrow, run, "doc_id long, expected_grade double, p_usable double, p_best double")
    return rated.select("doc_id", in_fold(F.col("doc_id")).alias("held_out"), "expected_grade", "p_usable", "p_best", (F.col("p_usable") >= 0.5).alias("kept"))
