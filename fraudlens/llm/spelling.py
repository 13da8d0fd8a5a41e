"""Spelling variants: words one edit apart, found by search schemes on FM-indexes.

Words are runs of letters of all texts, some of them with a letter deleted by a fixed rule
(see :func:`words`), counted over all documents.  Two words are near if they differ by one
inserted, deleted or replaced code point.

A pair is looked for from its shorter word u (either, if equally long) of m code points, cut
into halves of m // 2 and the rest.  The edit is in one half, so the other one stands in both
words, at the start or at the end.  Words are therefore dealt into buckets by m and their
first half, and by m and their last half, where m is a word's own length, or one
less if it is the longer word.  Near words share a bucket.  A bucket of more than MOST
words is dealt again by half of what is still open between the fixed ends, until none is
larger: at one open code point the alphabet bounds it.

Buckets are read sorted, a few thousand words at a time; these form a delimited
vocabulary, indexed by its suffix array: the bidirectional FM-index is two such
indexes, one of the words and one of the reversed words.  Buckets of first halves need its
rightward half only (words reversed), those of last halves the leftward one.  A search
starts at the delimiter, matches the fixed half exactly, and goes on across the other half
with one error allowed: an interval of suffix ranks without an error is kept for each
word, those with one replaced or inserted letter branch off it at each place, and all are
extended letter by letter, as arrays for all words of one length.  An interval that
reaches the delimiter on the other side is a near word.

Results in odd cases: null and empty texts have no words; a row without an id counts as if
its id were an empty text; repeated rows count each; an empty table, or one without
repeated words, gives an empty result; other columns are ignored; a word of any length is
indexed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import written
from fraudlens.operators.joins import checked_broadcast

LEAST_CHARS = 7
#: Words of a bucket before it is dealt again; the letters of two open places are fewer.
MOST = 10_000
#: Words of a vocabulary that is indexed at once, and of one search.
CHUNK, SEARCHED = 20_000, 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PAIRS = "word string, n long, near string, near_n long"


def words(docs: DataFrame, least_chars: int = LEAST_CHARS, least_n: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n: runs of letters (A-Z lower-cased) of ``least_chars`` code points that occur
    ``least_n`` times.  Where 31 divides the crc32 of ``<id>:<run>``, the run first loses its
    code point of that number, counted around."""
    # a shorter run can't give a word, and a maximal run is found whole
    runs = F.explode(F.regexp_extract_all(F.col(text_col), F.lit("[A-Za-zÀ-ÿ]{%d,}" % least_chars), F.lit(0)))
    lower = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    lower = lower.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = lower.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = "CAST(h % length(run) AS INT)"
    less = F.expr(f"concat(substring(run, 1, {at}), substring(run, {at} + 2))")
    word = F.when(F.col("h") % 31 == 0, less).otherwise(F.col("run")).alias("word")
    counted = hashed.select(word).where(F.length("word") >= least_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_n)


def _keyed(entries: DataFrame) -> DataFrame:
    """The bucket of each entry: side, length and the fixed ends."""
    ends = F.expr("concat_ws('|', side, m, front, back, substring(word, 1, front), substring(word, length(word) - back + 1, back))")
    return entries.withColumn("bucket", ends)


def buckets(vocabulary: DataFrame, least_chars: int, most: int = MOST) -> DataFrame:
    """Entries of words (word, n) in their buckets: side (first or last), bucket, word, n, m."""
    own = F.expr(f"filter(array(length(word), length(word) - 1), m -> m >= {least_chars})")
    halves = F.expr("array(struct('first' AS side, m div 2 AS front, 0L AS back), struct('last' AS side, 0L AS front, m - m div 2 AS back))")
    entries = _keyed(vocabulary.select("word", "n", F.explode(own).alias("m")).select("*", F.inline(halves)))
    done = None
    while True:
        entries = written(entries, "entries")
        full = written(entries.groupBy("bucket").count().where(F.col("count") > most).select("bucket"), "full")
        if full.isEmpty():
            return entries if done is None else done.unionByName(entries)
        full = checked_broadcast(full)
        kept = entries.join(full, "bucket", "left_anti")
        done = kept if done is None else done.unionByName(kept)
        # what is open in the shorter word, in two parts: one of them holds no edit
        opened = entries.join(full, "bucket", "left_semi").withColumn("open", F.expr("m - front - back"))
        parts = F.expr("array(struct(front + open div 2 AS front, back AS back), struct(front AS front, back + open - open div 2 AS back))")
        entries = _keyed(opened.select("word", "n", "m", "side", F.inline(parts)))


class FmIndex:
    """Suffix ranks of a delimited vocabulary (arrays of symbols from 1; 0 delimits)."""

    def __init__(self, vocabulary: list[np.ndarray]):
        delimiter = np.zeros(1, np.int64)
        self.text = np.concatenate([delimiter, *(x for w in vocabulary for x in (w, delimiter))])
        lengths = np.array([len(w) + 1 for w in vocabulary])
        self.begins = np.cumsum(lengths) - lengths  # the delimiter before each word
        n = self.n = len(self.text)
        rank, step = self.text, 1
        while True:  # prefix doubling
            following = np.zeros(n, np.int64)
            following[: max(n - step, 0)] = rank[step:] + 1
            key = rank * (n + 2) + following
            self.order = np.argsort(key, kind="stable")
            ordered = key[self.order]
            rank = np.empty(n, np.int64)
            rank[self.order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            if rank[self.order[-1]] == n - 1:
                break
            step *= 2
        self.before = self.text[self.order - 1]  # the transform: the symbol before each suffix
        by_symbol = np.argsort(self.before, kind="stable")
        self.ranks = self.before[by_symbol] * (n + 1) + by_symbol
        self.symbols = int(self.text.max()) + 1

    def extended(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of suffixes with ``symbol`` put before those of the intervals."""
        base = symbol * (self.n + 1)
        return np.searchsorted(self.ranks, base + low), np.searchsorted(self.ranks, base + high)

    def branches(self, low: np.ndarray, high: np.ndarray, but: np.ndarray | None):
        """Each interval with each letter that stands before one of its suffixes, except
        ``but``: number of the interval, and the new interval."""
        size = high - low
        few = np.flatnonzero((size > 0) & (size <= self.symbols))
        many = np.flatnonzero(size > self.symbols)
        which = np.repeat(few, size[few])
        row = np.arange(len(which)) - np.repeat(np.cumsum(size[few]) - size[few], size[few]) + low[which]
        pairs = np.unique(which * self.symbols + self.before[row])
        which = np.concatenate([pairs // self.symbols, np.repeat(many, self.symbols)])
        letter = np.concatenate([pairs % self.symbols, np.tile(np.arange(self.symbols), len(many))])
        ok = letter > 0
        if but is not None:
            ok &= letter != but[which]
        which, letter = which[ok], letter[ok]
        low, high = self.extended(letter, low[which], high[which])
        ok = high > low
        return which[ok], low[ok], high[ok]

    def near(self, queries: np.ndarray, opened: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``queries``, word) where the word is the query with one letter replaced
        or inserted among the first ``opened``; ``queries`` are words of one length."""
        length = queries.shape[1]
        low = np.zeros(len(queries), np.int64)
        high = np.full(len(queries), len(self.begins) + 1)
        for i in range(length - 1, opened - 1, -1):
            low, high = self.extended(queries[:, i], low, high)
        which, w_low, w_high = self.branches(low, high, None)
        for i in range(opened - 1, -1, -1):
            letter = queries[:, i]
            w_low, w_high = self.extended(letter[which], w_low, w_high)
            replaced = self.branches(low, high, letter)
            low, high = self.extended(letter, low, high)
            inserted = self.branches(low, high, None)
            which, w_low, w_high = (np.concatenate(x) for x in zip((which, w_low, w_high), replaced, inserted, strict=True))
            alive = w_high > w_low
            which, w_low, w_high = which[alive], w_low[alive], w_high[alive]
        w_low, w_high = self.extended(np.zeros(len(which), np.int64), w_low, w_high)
        found = w_high > w_low  # one suffix each, as words differ and are delimited on both sides
        word = np.searchsorted(self.begins, self.order[w_low[found]])
        return which[found], word


def _search(side: str, rows: list[tuple[str, int, int]]) -> Iterator[tuple]:
    """Near pairs of the words in ``rows`` (word, n, m) of whole buckets of one side."""
    vocabulary = list({w: n for w, n, _ in rows}.items())
    points = [np.frombuffer(w.encode("utf-32-le"), "<u4") for w, _ in vocabulary]
    letters = np.unique(np.concatenate(points))
    # the rightward half of the index reads words backwards
    coded = [np.searchsorted(letters, p[:: -1 if side == "first" else 1]) + 1 for p in points]
    index = FmIndex(coded)
    asked = {w for w, _, m in rows if len(w) == m}
    by_length: dict[int, list[int]] = {}
    for i, (w, _) in enumerate(vocabulary):
        if w in asked:
            by_length.setdefault(len(w), []).append(i)
    for length, members in by_length.items():
        opened = length - length // 2 if side == "first" else length // 2
        for at in range(0, len(members), SEARCHED):
            part = members[at : at + SEARCHED]
            which, word = index.near(np.stack([coded[i] for i in part]), opened)
            pairs = np.unique(np.stack([np.array(part)[which], word]), axis=1)
            for a, b in pairs.T.tolist():
                yield (*vocabulary[a], *vocabulary[b])
                yield (*vocabulary[b], *vocabulary[a])


def near_pairs(entries: DataFrame) -> DataFrame:
    """word, n, near and near_n of each two near words, both ways, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        side, group, chunk = None, [], []

        def flushed(everything: bool):
            if chunk and (everything or len(chunk) >= CHUNK):
                out.extend(_search(side, chunk))
                chunk.clear()

        def closed():
            # a bucket needs two words, and one to search from
            if len(group) > 1 and any(len(w) == m for w, _, m in group):
                chunk.extend(group)
            group.clear()

        last = None
        for batch in batches:
            for s, bucket, *row in zip(*(batch.column(c).to_pylist() for c in ("side", "bucket", "word", "n", "m")), strict=True):
                if bucket != last:
                    closed()
                    flushed(s != side)
                    side, last = s, bucket
                group.append(tuple(row))
            if out:
                yield _pairs(out)
                out.clear()
        closed()
        flushed(True)
        if out:
            yield _pairs(out)

    sorted_rows = entries.select("side", "bucket", "word", "n", "m").repartition("bucket").sortWithinPartitions("side", "bucket")
    return sorted_rows.mapInArrow(run, PAIRS).distinct()


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0]), pa.array(columns[1], pa.int64()), pa.array(columns[2]), pa.array(columns[3], pa.int64())],
        names=["word", "n", "near", "near_n"],
    )


def roots(forms: DataFrame) -> DataFrame:
    """word and root of ``forms`` (word, form): forms followed to the last, in rounds that
    double the way.  A form is more frequent than its word, so there is no circle."""
    found = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = checked_broadcast(found.select(F.col("word").alias("root"), F.col("root").alias("next")))
        stepped = written(found.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        found = stepped.select("word", "root")
        if stepped.where("next IS NOT NULL").isEmpty():
            return found


def spelling(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_n: int = 2, ratio: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``docs``.  A word's form is its
    most frequent near word (of equals the first in code-point order) if that is ``ratio``
    times as frequent; its root is where forms lead, itself without one."""
    vocabulary = written(words(docs, least_chars, least_n, id_col, text_col), "vocabulary")
    pairs = near_pairs(buckets(vocabulary, least_chars))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    nearest = written(pairs.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best), "nearest")
    large = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    formed = nearest.select("word", "n_near", F.when(large, F.col("best.near")).alias("form"), F.when(large, -F.col("best.less")).alias("form_n"))
    followed = roots(formed.where("form IS NOT NULL").select("word", "form"))
    return (
        vocabulary.join(formed, "word", "left")
        .join(followed, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )
