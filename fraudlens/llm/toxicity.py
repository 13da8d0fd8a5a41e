"""Toxicity by a convolutional text classifier in numpy.

A word's vector is the sum of three rows of an embedding table: two independent
hashes of the lower-case word and one of its first bytes.  Filters of several
widths run over the words of the whole text, each filter keeps its maximum, and
a linear layer gives the logit.  The gradient of a maximum touches only the words
under it, so training updates few rows of the table.  One component of the
table starts as the words' smoothed log odds in the sample.

Thresholds are calibrated by language: the language is guessed from function
words of the text alone, and the threshold found on labelled rows of a fold that
training left out is subtracted from the logit, so that 0.5 is the threshold
everywhere.

Results in odd cases: a null or empty text has no words and scores as an empty
pool does; a row whose id is null is scored and not held out; repeated rows are
scored each; without labelled rows of both classes every score is the share of
toxic ones (0 without any); an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import map_slices, sampled, texts_of, written
from fraudlens.llm.words import joined, mixed, owners, span_hashes, word_spans

#: Labelled rows of each class in the training sample at most, and the longest
#: text in it; the bytes of a class's texts, about.  What is scored has no limit.
SAMPLE_ROWS = 3000
SAMPLE_CHARS = 200_000
SAMPLE_BYTES = 48_000_000
BUCKETS = 1 << 17  # rows of the table for each of the three hashes
SIZE = 8
WIDTHS = (1, 2, 3)
FILTERS = 6  # of each width
EPOCHS = 4
BLOCK = 100_000  # words worked on at once
PREFIX = 4
LEFT_OUT = 1  # remainder of the fold that calibrates

#: Frequent function words of each language.
FUNCTION_WORDS = {
    "en": "the of and to in is was that it with for be on are",
    "de": "der die und das ist nicht mit auf ein eine den von zu im",
    "fr": "le les des et une est que dans pour sur du un aux qui",
    "es": "el los las que por con una para es del se lo como al",
}

#: Everything but letters, digits and bytes of other alphabets becomes a blank.
_PLAIN = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def word_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table rows (words x 3), word hashes, and the text each word is in."""
    buffer, begins = joined([t.lower().encode("utf-8", "replace").translate(_PLAIN) for t in texts])
    starts, ends = word_spans(buffer)
    hashes, prefixes = span_hashes(buffer, starts, ends, PREFIX)
    top = np.uint64(BUCKETS - 1)
    rows = np.stack(
        [
            (hashes & top).astype(np.int32),
            ((hashes >> np.uint64(32)) & top).astype(np.int32) + BUCKETS,
            (prefixes & top).astype(np.int32) + 2 * BUCKETS,
        ],
        axis=1,
    )
    return rows, hashes, owners(starts, begins)


def _hash_of(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(data, np.array([0]), np.array([len(data)]))[0])


_LANGUAGES = list(FUNCTION_WORDS)
_LISTED = np.array(sorted({_hash_of(w) for words in FUNCTION_WORDS.values() for w in words.split()}), np.uint64)
_IN_LANGUAGE = np.array(
    [[float(h in {_hash_of(w) for w in FUNCTION_WORDS[lang].split()}) for lang in _LANGUAGES] for h in _LISTED.tolist()], np.float32
)


def languages(hashes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` texts the number of the language whose function words
    it has most of; one past the last if it has none."""
    at = np.minimum(np.searchsorted(_LISTED, hashes), len(_LISTED) - 1)
    hit = _LISTED[at] == hashes
    votes = np.zeros((n, len(_LANGUAGES)), np.float32)
    np.add.at(votes, text[hit], _IN_LANGUAGE[at[hit]])
    return np.where(votes.max(axis=1) > 0, votes.argmax(axis=1), len(_LANGUAGES))


@dataclass
class Model:
    table: np.ndarray | None
    filters: dict[int, np.ndarray] = field(default_factory=dict)  # width -> (width * SIZE, FILTERS)
    bias: np.ndarray | None = None  # of the filters
    weights: np.ndarray | None = None
    intercept: float = 0.0
    thresholds: np.ndarray | None = None  # by language, in logits
    share: float = 0.0

    def pooled(self, rows: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        """The maximum of each filter over each of ``n`` texts, 0 at least."""
        pool = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        lead = max(WIDTHS) - 1
        for at in range(0, len(rows), BLOCK):
            part, of = rows[at : at + BLOCK + lead], text[at : at + BLOCK + lead]
            vectors = self.table[part[:, 0]] + self.table[part[:, 1]] + self.table[part[:, 2]]
            for k, width in enumerate(WIDTHS):
                m = min(len(part) - width + 1, BLOCK)
                if m < 1:
                    continue
                out = np.zeros((m, FILTERS), np.float32)
                for j in range(width):
                    out += vectors[j : j + m] @ self.filters[width][j * SIZE : (j + 1) * SIZE]
                out += self.bias[k * FILTERS : (k + 1) * FILTERS]
                out[of[:m] != of[width - 1 : width - 1 + m]] = 0  # over the end of a text
                first = np.flatnonzero(np.r_[True, of[1:m] != of[: m - 1]])
                most = np.maximum.reduceat(out, first, axis=0)
                own = pool[of[first], k * FILTERS : (k + 1) * FILTERS]
                pool[of[first], k * FILTERS : (k + 1) * FILTERS] = np.maximum(own, most)
        return pool

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows, hashes, text = word_rows(texts)
        return self.pooled(rows, text, len(texts)) @ self.weights + self.intercept, languages(hashes, text, len(texts))

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.table is None:
            return np.full(len(texts), self.share)
        logit, language = self.logits(texts)
        return 1 / (1 + np.exp(-np.clip(logit - self.thresholds[language], -30, 30).astype(np.float64)))


def fit(texts: list[str], toxic: np.ndarray, left_out: np.ndarray, seed: int = 7) -> Model:
    """Train on the rows outside ``left_out`` and calibrate on those inside."""
    share = float(toxic.mean()) if len(toxic) else 0.0
    train = np.flatnonzero(~left_out)
    if len(set(toxic[train].tolist())) < 2:
        return Model(None, share=share)
    random = np.random.default_rng(seed)
    rows, _, text = word_rows(texts)
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    target = toxic.astype(np.float32)

    # log odds of a row of the table: texts of either class that have it
    seen = [np.zeros(3 * BUCKETS, np.float32), np.zeros(3 * BUCKETS, np.float32)]
    for i in train.tolist():
        own = rows[bounds[i] : bounds[i + 1]]
        seen[int(target[i])][np.unique(own)] += 1
    n = [max(1.0, float((target[train] == k).sum())) for k in (0, 1)]
    odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
    odds[(seen[0] + seen[1]) < 2] = 0
    table = random.normal(0, 0.05, (3 * BUCKETS, SIZE)).astype(np.float32)
    table[:, 0] = np.clip(odds, -6, 6) / 6

    filters = {w: random.normal(0, 0.1, (w * SIZE, FILTERS)).astype(np.float32) for w in WIDTHS}
    for w in WIDTHS:
        filters[w][::SIZE, 0] += 1.0 / w ** 0.5
    bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
    weights = random.normal(0, 0.1, len(bias)).astype(np.float32)
    weights[::FILTERS] += 1.0
    model = Model(table, filters, bias, weights, -1.0, np.zeros(len(_LANGUAGES) + 1, np.float32), share)

    # stochastic gradients with a step for each parameter (sums of squares)
    rate, tiny = 0.1, 1e-6
    squares = {"table": np.zeros(len(table), np.float32), "bias": np.zeros_like(bias), "weights": np.zeros_like(weights), "intercept": 0.0}
    squares |= {w: np.zeros_like(filters[w]) for w in WIDTHS}
    balance = [0.5 * len(train) / n[0], 0.5 * len(train) / n[1]]
    for _ in range(EPOCHS):
        for i in random.permutation(train).tolist():
            own = rows[bounds[i] : bounds[i + 1]]
            vectors = table[own[:, 0]] + table[own[:, 1]] + table[own[:, 2]]
            pool = np.zeros(len(bias), np.float32)
            best = np.full(len(bias), -1)
            for k, w in enumerate(WIDTHS):
                m = len(own) - w + 1
                if m < 1:
                    continue
                at = slice(k * FILTERS, (k + 1) * FILTERS)
                out = bias[at] + sum(vectors[j : j + m] @ filters[w][j * SIZE : (j + 1) * SIZE] for j in range(w))
                top = out.argmax(axis=0)
                most = out[top, np.arange(FILTERS)]
                pool[at] = np.maximum(most, 0)
                best[at] = np.where(most > 0, top, -1)
            logit = float(pool @ weights) + model.intercept
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target[i]) * balance[int(target[i])]
            if abs(error) < 0.02:
                continue
            back = error * weights
            g = error * pool
            squares["weights"] += g * g
            weights -= rate * g / (np.sqrt(squares["weights"]) + tiny)
            squares["intercept"] += error * error
            model.intercept -= rate * error / (squares["intercept"] ** 0.5 + tiny)
            for f in np.flatnonzero(best >= 0).tolist():
                w = WIDTHS[f // FILTERS]
                b, at = best[f], f % FILTERS
                window = vectors[b : b + w].ravel()
                g_filter = back[f] * window
                g_words = (back[f] * filters[w][:, at]).reshape(w, SIZE)
                squares[w][:, at] += g_filter * g_filter
                filters[w][:, at] -= rate * g_filter / (np.sqrt(squares[w][:, at]) + tiny)
                squares["bias"][f] += back[f] ** 2
                bias[f] -= rate * back[f] / (squares["bias"][f] ** 0.5 + tiny)
                touched = own[b : b + w]
                power = (g_words * g_words).mean(axis=1)
                for j in range(w):
                    r = touched[j]
                    squares["table"][r] += power[j]
                    table[r] -= (rate * 0.3) * g_words[j] / (np.sqrt(squares["table"][r]) + tiny)[:, None]

    inside = np.flatnonzero(left_out) if left_out.any() and len(set(toxic[left_out].tolist())) == 2 else train
    logit, language = model.logits([texts[i] for i in inside.tolist()])
    found = best_threshold(logit, target[inside], 0.0)
    model.thresholds[:] = found
    for k in range(len(_LANGUAGES)):
        model.thresholds[k] = best_threshold(logit[language == k], target[inside][language == k], found)
    return model


def best_threshold(logit: np.ndarray, target: np.ndarray, default: float, least: int = 5) -> float:
    """The middle of the logits between which most rows fall on their side,
    classes weighing the same; ``default`` with too few rows of a class."""
    n = [int((target == k).sum()) for k in (0, 1)]
    if min(n) < least:
        return default
    order = np.argsort(logit, kind="stable")
    x, y = logit[order], target[order]
    # right if rows from position i on count as toxic
    right = np.r_[0, np.cumsum(y == 0)] / n[0] + (n[1] - np.r_[0, np.cumsum(y == 1)]) / n[1]
    edges = np.r_[x[0] - 1, (x[1:] + x[:-1]) / 2, x[-1] + 1]
    top = np.flatnonzero(right >= right.max() - 1e-9)
    return float((edges[top[0]] + edges[top[-1]]) / 2)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str) -> DataFrame:
    """Text and label of a bounded sample of labelled documents outside the held-out
    fold: for each class those with the least hashes of the id, as far as SAMPLE_ROWS
    and SAMPLE_BYTES go.

    Shares are of the labelled documents that have a text to learn from (labels of
    ids that ``docs`` lacks don't count).  A class that has labelled documents, but none of
    SAMPLE_CHARS or fewer, is an error.
    """
    marked = (
        labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("target"))
        .where((fold(F.col("doc_id")) != 0) & F.col("target").isin(0, 1))
    )
    sizes = docs.where("doc_id IS NOT NULL").select("doc_id", F.length("text").alias("chars"), F.octet_length("text").alias("bytes"))
    marked = written(sizes.join(marked, "doc_id"), "labelled")
    usable = F.col("chars") <= SAMPLE_CHARS
    classes = marked.groupBy("target").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(usable).alias("usable"), F.sum(F.when(usable, F.col("bytes"))).alias("bytes")
    )
    parts = []
    for k, rows, n, size in classes.collect():
        if not n:
            raise ValueError(f"each of the {rows} documents labelled {k} has more than {SAMPLE_CHARS} characters")
        part = marked.where(usable & (F.col("target") == k)).select("doc_id", "target")
        share = min(SAMPLE_ROWS / n, SAMPLE_BYTES / max(size, 1))
        if share < 1:
            part = part.where(sampled(share, "doc_id")).limit(SAMPLE_ROWS * 5 // 4)
            if part.isEmpty():
                raise ValueError(f"no sample of the {n} rows labelled {k}")
        parts.append(part)
    chosen = parts[0] if parts else marked.select("doc_id", "target").limit(0)
    for p in parts[1:]:
        chosen = chosen.unionByName(p)
    chosen = written(chosen.distinct(), "sample")  # rows that repeat an id share its label
    texts = docs.where(F.length("text") <= SAMPLE_CHARS)
    return texts.join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "text", "target", (fold(F.col("doc_id")) == LEFT_OUT).alias("left_out")
    )


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model:
    table = labelled_sample(texts_of(docs, id_col, text_col), labels, label_col).toArrow().sort_by("doc_id")
    left_out = np.array(table.column("left_out").to_pylist(), bool)
    return fit(table.column("text").to_pylist(), np.array(table.column("target").to_pylist(), np.int64), left_out)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "score": shared.value.scores(batch.column("text").to_pylist())}

    return map_slices(texts_of(docs, id_col, text_col), run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out (never trained or calibrated on), score and predicted."""
    scored = score(docs, train(docs, labels, label_col, id_col, text_col), id_col, text_col)
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
