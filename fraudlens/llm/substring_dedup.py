"""Removal of long passages that occur more than once, exactly.

A window is ``k`` consecutive words of one document.  Equal windows have equal
minimisers (the smallest hash of the ``m``-word runs in them), so consecutive
windows that share a minimiser form a super-k-mer, and windows can only be equal
where two super-k-mers have the same minimiser.

1. Every document is cut into super-k-mers; only minimisers, 8 bytes each, are
   counted.  A super-k-mer whose minimiser is nowhere else holds no repeated
   window and goes no further.  No window is lost by this, as it is exact.
2. The others travel as one packed string of words each to the bucket of their
   minimiser.  Equal strings of an Arrow batch travel as one, with their count.
3. A bucket sorts its windows and counts equal ones, comparing their bytes, and
   says for each string which of its windows occur again.
4. These marks go back to the strings' places, and each document drops the words
   under marked windows.

A minimiser that more than ``SPLIT`` super-k-mers share (a passage in a third
of all documents) would make one large bucket.  Its windows travel one by one,
keyed by their own hash as well: equal windows meet map-side, different ones
are spread over many tasks.

Results in odd cases: a null or empty text has no words and an empty kept text;
texts shorter than a window lose nothing; repeated rows repeat all their
windows; rows without an id, or with one that others have, are rows like others; an
empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import map_slices, restricted, slices, texts_of, written
from fraudlens.llm.words import joined, owners, rolling, span_hashes, word_spans

WINDOW = 35
#: Words of the runs that minimisers are taken from: rare enough, and short
#: enough that about 14 windows share one.
RUN = 8
SPLIT = 4096


def _cut(batch: pa.RecordBatch, k: int, m: int) -> dict:
    """Super-k-mers of each text: minimiser, first window, and whether the
    minimiser occurs again inside (weight 2), in order; they cover all windows."""
    texts = [t.encode("utf-8", "replace") for t in batch.column("text").to_pylist()]
    buffer, begins = joined(texts)
    starts, ends = word_spans(buffer)
    text = owners(starts, begins)
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    n_words = np.diff(first)
    minimisers, windows, weights = ([[] for _ in texts] for _ in range(3))
    if len(starts) >= k:
        runs = rolling(span_hashes(buffer, starts, ends), m)
        spread = k - m + 1  # runs in a window
        low, done = runs, 1
        while done < spread:  # minimum of `done` consecutive runs
            step = min(done, spread - done)
            low = np.minimum(low[: len(low) - step], low[step:])
            done += step
        whole = text[: len(low)] == text[k - 1 :]
        at = np.flatnonzero(whole)
        if len(at):
            value, of = low[at], text[at]
            new = np.r_[True, (value[1:] != value[:-1]) | (of[1:] != of[:-1])]
            begin = np.flatnonzero(new)
            # cut every `spread` windows, so that a string has a bounded length
            offset = np.arange(len(at)) - np.repeat(begin, np.diff(np.r_[begin, len(at)]))
            begin = np.flatnonzero(offset % spread == 0)
            size = np.diff(np.r_[begin, len(at)])
            reach = np.arange(2 * spread - 1)
            where = np.minimum(at[begin][:, None] + reach, len(runs) - 1)
            inside = reach < (size + spread - 1)[:, None]
            again = ((runs[where] == value[begin][:, None]) & inside).sum(axis=1) > 1
            owner = of[begin]
            edge = np.searchsorted(owner, np.arange(len(texts) + 1))
            own = at[begin] - first[owner]
            for i in np.unique(owner).tolist():
                part = slice(edge[i], edge[i + 1])
                minimisers[i] = value[begin][part].view(np.int64)
                windows[i] = own[part]
                weights[i] = again[part] + 1
    return {
        "doc_id": batch.column("doc_id"),
        "n_words": n_words,
        "sha256": [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts],
        "minimisers": minimisers,
        "windows": windows,
        "weights": weights,
    }


def _windows_of(n_words: int, k: int) -> int:
    return max(0, n_words - k + 1)


def _strings(row: dict, k: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(minimiser, sub-bucket, first window, packed string) of a document's
    candidates.  Sub-bucket 0 holds whole super-k-mers; windows of a minimiser in
    very many of them go by their own hash."""
    words = row["text"].encode("utf-8", "replace").split()
    for c in row["cut"]:
        if not c["hot"]:
            yield c["minimiser"], 0, c["window"], b" ".join(words[c["window"] : c["window"] + c["size"] + k - 1])
            continue
        for w in range(c["window"], c["window"] + c["size"]):
            string = b" ".join(words[w : w + k])
            sub = int.from_bytes(hashlib.blake2b(string, digest_size=8).digest(), "little", signed=True)
            yield c["minimiser"], sub | 1, w, string


def _digest(minimiser: int, string: bytes) -> bytes:
    return hashlib.blake2b(string, digest_size=16, key=minimiser.to_bytes(8, "little", signed=True)).digest()


_PACKED = pa.schema([("minimiser", pa.int64()), ("sub", pa.int64()), ("packed", pa.binary()), ("n", pa.int64())])
_PLACES = pa.schema([("digest", pa.binary()), ("doc_id", pa.int64()), ("window", pa.int32())])
_MARKS = pa.schema([("digest", pa.binary()), ("mask", pa.int64())])


def _pack(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            seen: dict[tuple[int, int, bytes], int] = {}
            for row in batch.to_pylist():
                for minimiser, sub, _, string in _strings(row, k):
                    seen[minimiser, sub, string] = seen.get((minimiser, sub, string), 0) + 1
            rows = list(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], _PACKED.field(i).type) for i in range(3)] + [pa.array(seen.values(), pa.int64())],
                schema=_PACKED,
            )

    return run


def _place(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [(_digest(m, s), row["doc_id"], w) for row in batch.to_pylist() for m, _, w, s in _strings(row, k)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], _PLACES.field(i).type) for i in range(3)], schema=_PLACES
            )

    return run


def _mark(rows: list[tuple[int, int, bytes, int]], k: int) -> list[tuple[bytes, int]]:
    """(digest, bits of repeated windows) of the strings of whole buckets.
    Equal strings follow each other."""
    strings: list[bytes] = []
    bucket: list[int] = []
    count: list[int] = []
    key: list[int] = []
    last = None
    for minimiser, sub, packed, n in rows:
        if last == (minimiser, sub, packed):
            count[-1] += n
            continue
        if last is None or last[:2] != (minimiser, sub):
            bucket.append(len(strings))
        last = (minimiser, sub, packed)
        strings.append(packed)
        count.append(n)
        key.append(minimiser)
    buffer, begins = joined(strings)
    starts, ends = word_spans(buffer)
    text = owners(starts, begins)
    if len(starts) < k:
        return []
    whole = np.flatnonzero(text[: len(text) - k + 1] == text[k - 1 :])
    of = text[whole]
    group = np.searchsorted(np.array(bucket), of, side="right")
    window = rolling(span_hashes(buffer, starts, ends), k)[whole]
    order = np.lexsort((window, group))
    same = (window[order][1:] == window[order][:-1]) & (group[order][1:] == group[order][:-1])
    weight = np.array(count, np.int64)[of[order]]
    # equal hashes: compare the bytes of neighbours; a window stands before its equals
    begin, end = starts[whole][order], ends[whole + k - 1][order]
    raw = buffer.tobytes()
    repeated = weight > 1
    pairs = np.flatnonzero(same)
    unequal = False
    for i in pairs.tolist():
        if raw[begin[i] : end[i]] == raw[begin[i + 1] : end[i + 1]]:
            repeated[i] = repeated[i + 1] = True
        else:
            unequal = True
    if unequal:  # two texts with one hash lie mixed: count their bytes
        tally: dict[tuple[int, bytes], int] = {}
        for g, a, b, w in zip(group[order].tolist(), begin.tolist(), end.tolist(), weight.tolist(), strict=True):
            tally[g, raw[a:b]] = tally.get((g, raw[a:b]), 0) + w
        repeated = np.array([tally[g, raw[a:b]] > 1 for g, a, b in zip(group[order].tolist(), begin.tolist(), end.tolist(), strict=True)])
    hit = order[repeated]
    offset = whole - np.searchsorted(text, np.arange(len(strings)))[of]
    mask = np.zeros(len(strings), np.int64)
    np.bitwise_or.at(mask, of[hit], np.int64(1) << offset[hit])
    return [(_digest(key[i], strings[i]), int(mask[i])) for i in np.flatnonzero(mask).tolist()]


def _count(k: int, most: int = 2_000_000):
    """Buckets arrive sorted; whole ones are worked on together, about ``most``
    bytes at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            found = _mark(rows, k)
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], _MARKS.field(i).type) for i in range(2)], schema=_MARKS)

        held: list[tuple[int, int, bytes, int]] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[-1][:3] == row[:3]:  # equal strings take no more room
                    held[-1] = (*row[:3], held[-1][3] + row[3])
                    continue
                if size > most and held[-1][:2] != row[:2]:
                    yield out(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield out(held)

    return run


def _keep(k: int):
    def run(batch: pa.RecordBatch) -> dict:
        removed, digests = [], []
        for row in batch.to_pylist():
            words = row["text"].encode("utf-8", "replace").split()
            cover = np.zeros(len(words) + 1, np.int64)
            for mark in row["marks"]:
                for j in range(mark["mask"].bit_length()):
                    if mark["mask"] >> j & 1:
                        cover[mark["window"] + j] += 1
                        cover[mark["window"] + j + k] -= 1
            gone = np.cumsum(cover)[:-1] > 0
            removed.append(int(gone.sum()))
            digests.append(hashlib.sha256(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])).hexdigest())
        return {"doc_id": batch.column("doc_id"), "removed": removed, "kept": digests}

    return run


def substring_dedup(docs: DataFrame, k: int = WINDOW, m: int = RUN, split: int = SPLIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each row: the words left
    after removing all that a window covers whose words occur again anywhere.
    ``k - m`` must be below 63."""
    # rows are told apart by a number of their own, given once; doc_id is only carried along
    docs = texts_of(docs, id_col, text_col).withColumnRenamed("doc_id", "own_id")
    docs = written(docs.withColumn("doc_id", F.monotonically_increasing_id()), "numbered")
    cuts = written(
        map_slices(
            docs, lambda b: {**_cut(b, k, m), "own_id": b.column("own_id")},
            "doc_id long, own_id long, n_words long, sha256 string, minimisers array<long>, windows array<int>, weights array<byte>",
        ),
        "superkmers",
    )
    shared = (
        cuts.select(F.explode(F.arrays_zip("minimisers", "weights")).alias("c"))
        .groupBy(F.col("c.minimisers").alias("minimiser"))
        .agg(F.sum("c.weights").alias("n"))
        .where("n > 1")
    )
    # a super-k-mer ends where the next begins, the last with the last window
    last = F.col("n_words") - (k - 1)
    following = F.concat(F.slice("windows", 2, F.greatest(F.size("windows"), F.lit(1))), F.array(last.cast("int")))
    pieces = (
        cuts.where(F.size("windows") > 0)
        .select("doc_id", F.explode(F.arrays_zip("minimisers", "windows", following.alias("ends"))).alias("c"))
        .select("doc_id", F.col("c.minimisers").alias("minimiser"), F.col("c.windows").alias("window"), F.col("c.ends").alias("end"))
    )
    candidates = written(
        pieces.join(shared, "minimiser")
        .groupBy("doc_id")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("window", (F.col("end") - F.col("window")).alias("size"), "minimiser", (F.col("n") > split).alias("hot"))
                )
            ).alias("cut")
        ),
        "candidates",
    )
    texts = restricted(docs, candidates, "doc_id")
    found = texts.join(candidates, "doc_id").select("doc_id", "text", "cut")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marks = (
        found.mapInArrow(_pack(k), "minimiser long, sub long, packed binary, n long")
        .repartition(partitions, "minimiser", "sub")
        .sortWithinPartitions("minimiser", "sub", "packed")
        .mapInArrow(_count(k), "digest binary, mask long")
    )
    places = found.mapInArrow(_place(k), "digest binary, doc_id long, window int")
    marked = places.join(marks, "digest").groupBy("doc_id").agg(F.collect_list(F.struct("window", "mask")).alias("marks"))
    changed = written(map_slices(texts.join(marked, "doc_id"), _keep(k), "doc_id long, removed long, kept string"), "kept")
    return cuts.join(changed, "doc_id", "left").select(
        F.col("own_id").alias("doc_id"),
        "n_words",
        F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept", "sha256").alias("kept_sha256"),
    )
