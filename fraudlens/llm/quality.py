"""Quality by a weak-label model.

Several overlapping heuristics vote on each text: good, bad or nothing.  The
votes of all texts are counted by pattern, and expectation-maximisation over
these counts estimates how often each heuristic is right on good and on bad texts,
without any labels.  The posterior of a text's votes then is its soft label, and
a linear scorer over hashed features of word shapes learns it.

The number of patterns is bounded by 3 to the number of heuristics, whatever the
size of the corpus; the scorer is fitted on a bounded sample of texts.

Results in odd cases: a null or empty text has no features and no votes, and is
kept, as nothing speaks against it; a row whose id is null is scored; repeated rows
are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import map_slices, sampled, texts_of

#: Texts that the scorer is fitted on at most; the votes of all texts are counted.
SAMPLE_ROWS = 8000
DIMENSIONS = 1 << 12
ROUNDS = 100
EPOCHS = 60

#: Upper and lower case letters, digits and white space by class; bytes of other
#: alphabets as lower case; marks as themselves.
_CLASS = bytes(
    65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c > 127 else 48 if 48 <= c <= 57 else 32 if c in b" \t\n\v\f\r" else c
    for c in range(256)
)
_USUAL_END = frozenset(b"Aa0.,;:?)\"'-")


@dataclass
class Profile:
    """What the heuristics and features of a text read."""

    words: int
    shapes: Counter
    repeats: float  # share of words equal to the one before
    distinct: float  # distinct words among all
    capitals: float  # share of words in capitals only
    marks: float  # share of words that end in an unusual mark
    bars: float  # share of words that are a mark alone
    lines: float  # distinct lines among all
    length: float  # bytes of a word


def profile(text: str) -> Profile:
    data = text.encode("utf-8", "replace")
    words = data.split()
    n = len(words)
    if not n:
        return Profile(0, Counter(), 0, 1, 0, 0, 0, 1, 0)
    kinds = np.frombuffer(data.translate(_CLASS), np.uint8)
    # runs of one class become one letter: a word turns into its shape
    shapes = Counter(kinds[np.r_[True, kinds[1:] != kinds[:-1]]].tobytes().split())
    lines = [x for x in data.split(b"\n") if x.strip()]
    capitals = sum(c for s, c in shapes.items() if s[0] == 65 and 97 not in s)
    marks = sum(c for s, c in shapes.items() if s[-1] not in _USUAL_END or s.endswith(b"!") and s[0] == 65)
    bars = sum(c for s, c in shapes.items() if not {65, 97, 48} & set(s))
    return Profile(
        n, shapes, sum(map(eq, words, words[1:])) / n, len(set(words)) / n, capitals / n, marks / n, bars / n,
        len(set(lines)) / max(1, len(lines)), sum(map(len, words)) / n,
    )


def _junk(value: float, most: float) -> int:
    """-1 (bad) above ``most``, else nothing: a text free of one kind of junk may
    be full of another."""
    return -1 if value > most else 0


def _range(value: float, bad: float, good: float) -> int:
    """-1 below ``bad``, 1 from ``good`` on, nothing between."""
    return -1 if value < bad else 1 if value >= good else 0


#: name -> vote of a profile of LEAST_WORDS words or more.
HEURISTICS = {
    "repeats": lambda p: _junk(p.repeats, 0.1),
    "distinct": lambda p: _range(p.distinct * min(1.0, p.words / 100), 0.08, 0.35) if p.words >= 60 else 0,
    "capitals": lambda p: _junk(p.capitals, 0.15),
    "marks": lambda p: _junk(p.marks, 0.1),
    "bars": lambda p: _junk(p.bars, 0.08),
    "lines": lambda p: _junk(1 - p.lines, 0.6),
    "plain": lambda p: _range(sum(c for s, c in p.shapes.items() if s in _PLAIN_SHAPES) / p.words, 0.6, 0.93),
    "sentences": lambda p: _range(sum(c for s, c in p.shapes.items() if s[-1] in b".?") / p.words, 0.005, 0.02) if p.words >= 80 else 0,
    "opening": lambda p: _range(1 - sum(c for s, c in p.shapes.items() if s.startswith(b"Aa")) / p.words, 0.3, 0.6) if p.words >= 30 else 0,
}
LEAST_WORDS = 8
_PLAIN_SHAPES = frozenset({b"a", b"Aa", b"A", b"a,", b"a.", b"Aa.", b"Aa,", b"0", b"a-a", b"a'a", b"aAa", b"aA", b"aAa,", b"aAa."})


def votes(p: Profile) -> bytes:
    """A letter for each heuristic: + - or 0."""
    return bytes(b"0+-"[vote(p)] for vote in HEURISTICS.values()) if p.words >= LEAST_WORDS else b"0" * len(HEURISTICS)


def features(p: Profile) -> dict[int, float]:
    """Hashed features: logarithms of the shares of word shapes, and steps of the rates."""
    out: dict[int, float] = {}
    if p.words:
        for shape, count in p.shapes.items():
            at = zlib.crc32(shape[:8]) % DIMENSIONS
            out[at] = out.get(at, 0) + count / p.words
        out = {k: math.log1p(20 * v) for k, v in out.items()}
        for name in ("repeats", "capitals", "marks", "bars"):
            step = f"{name}{int(min(getattr(p, name), 0.5) * 20)}".encode()
            out[zlib.crc32(step) % DIMENSIONS] = 1.0
            out[zlib.crc32(name.encode()) % DIMENSIONS] = math.log1p(20 * getattr(p, name))
    return out


@dataclass
class LabelModel:
    """Chance of each vote (0 + -) given a good (row 1) or bad (row 0) text."""

    chances: np.ndarray  # heuristics x 2 x 3
    good: float

    def posterior(self, patterns: list[bytes]) -> np.ndarray:
        """The chance that a text with these votes is good."""
        seen = np.array([list(p) for p in patterns], np.uint8).reshape(len(patterns), -1)
        seen = np.select([seen == ord("+"), seen == ord("-")], [1, 2], 0)
        log = np.log([1 - self.good, self.good])[None, :].repeat(len(patterns), axis=0)
        for h in range(seen.shape[1]):
            log += np.log(self.chances[h][:, seen[:, h]]).T
        log -= log.max(axis=1, keepdims=True)
        return np.exp(log[:, 1]) / np.exp(log).sum(axis=1)


def fit_labels(counts: dict[bytes, int]) -> LabelModel:
    """Expectation-maximisation over the counts of vote patterns.  It starts
    from heuristics that are right more often than wrong, which tells the two
    classes apart; texts without votes say nothing about them."""
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], np.float64)
    width = len(HEURISTICS)
    start = np.array([[0.3, 0.2, 0.5], [0.3, 0.65, 0.05]])  # bad: 0 + -; good: 0 + -
    model = LabelModel(np.repeat(start[None], width, axis=0), 0.8)
    if not patterns:
        return model
    seen = np.array([list(p) for p in patterns], np.uint8)
    seen = np.select([seen == ord("+"), seen == ord("-")], [1, 2], 0)
    n = n * (seen != 0).any(axis=1)
    if not n.sum():
        return model
    for _ in range(ROUNDS):
        q = model.posterior(patterns)
        weight = np.stack([(1 - q) * n, q * n])
        chances = np.empty_like(model.chances)
        for h in range(width):
            tally = np.stack([np.bincount(seen[:, h], w, minlength=3) for w in weight])
            # a few made-up votes keep chances off 0 and each heuristic on its side
            tally += 0.02 * n.sum() ** 0.5 * start
            chances[h] = tally / tally.sum(axis=1, keepdims=True)
        good = float(np.clip(weight[1].sum() / n.sum(), 0.05, 0.99))
        if abs(good - model.good) < 1e-7 and np.abs(chances - model.chances).max() < 1e-7:
            break
        model = LabelModel(chances, good)
    return model


@dataclass
class Scorer:
    weights: np.ndarray
    intercept: float

    def score(self, p: Profile) -> float:
        x = self.intercept + sum(self.weights[k] * v for k, v in features(p).items())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x)))) if p.words else 1.0


def fit_scorer(rows: list[dict[int, float]], target: np.ndarray, rate: float = 0.3, decay: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels by gradient steps of their own size
    for each weight; both classes weigh the same."""
    weights, intercept = np.zeros(DIMENSIONS), 0.0
    if not rows:
        return Scorer(weights, 1.0)
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([k for r in rows for k in r], np.int64)
    val = np.array([v for r in rows for v in r.values()])
    mass = max(1e-9, target.sum()), max(1e-9, (1 - target).sum())
    weight = target * 0.5 / mass[0] + (1 - target) * 0.5 / mass[1]
    square, square0 = np.full(DIMENSIONS, 1e-8), 1e-8
    for _ in range(EPOCHS * 5):
        x = intercept + np.bincount(at, val * weights[col], len(rows))
        error = (1 / (1 + np.exp(-np.clip(x, -30, 30))) - target) * weight
        g = np.bincount(col, val * error[at], DIMENSIONS) + decay * weights
        square += g * g
        weights -= rate * g / np.sqrt(square)
        square0 += error.sum() ** 2
        intercept -= rate * error.sum() / square0**0.5
    return Scorer(weights, float(intercept))


def vote_table(docs: DataFrame) -> DataFrame:
    """doc_id and votes of rows of doc_id and text."""

    def run(batch: pa.RecordBatch) -> dict:
        found = [votes(profile(t)).decode() for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "votes": found}

    return map_slices(docs, run, "doc_id long, votes string")


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[LabelModel, Scorer]:
    """Label model from the votes of all rows, scorer from a sample.  ``docs``
    has doc_id and text."""
    counted = vote_table(docs).groupBy("votes").count().collect()  # bounded: 3 ** heuristics
    counts = {r["votes"].encode(): r["count"] for r in counted}
    total = sum(counts.values())
    model = fit_labels(counts)
    if sample_rows < total:
        docs = docs.where(sampled(sample_rows / total, "doc_id", F.length("text")))
    chosen = docs.limit(sample_rows * 5 // 4)

    def run(batch: pa.RecordBatch) -> dict:
        own = [profile(t) for t in batch.column("text").to_pylist()]
        hashed = [features(p) for p in own]
        return {
            "votes": [votes(p).decode() for p in own],
            "at": [list(h) for h in hashed],
            "value": [list(map(float, h.values())) for h in hashed],
        }

    rows = map_slices(chosen, run, "votes string, at array<int>, value array<double>").collect()
    if total and not rows:
        raise ValueError(f"no sample of {total} rows; are their ids and lengths all equal?")
    rows = [r for r in rows if r["at"]]
    rows.sort(key=lambda r: (r["votes"], r["at"], r["value"]))
    target = model.posterior([r["votes"].encode() for r in rows]) if rows else np.zeros(0)
    return model, fit_scorer([dict(zip(r["at"], r["value"], strict=True)) for r in rows], target)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, votes, score (0 to 1, higher: better) and kept of every row.  A text
    is rejected if its score is below 0.5 and some heuristic found it bad."""
    docs = texts_of(docs, id_col, text_col)
    _, scorer = train(docs, sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # DIMENSIONS weights

    def run(batch: pa.RecordBatch) -> dict:
        own = [profile(t) for t in batch.column("text").to_pylist()]
        scores, voted = [shared.value.score(p) for p in own], [votes(p).decode() for p in own]
        return {
            "doc_id": batch.column("doc_id"),
            "votes": voted,
            "score": scores,
            "kept": [s >= 0.5 or "-" not in v for s, v in zip(scores, voted, strict=True)],
        }

    return map_slices(docs, run, "doc_id long, votes string, score double, kept boolean")
