"""Jaccard self-join of word n-gram sets by a partitioned universe.

Sizes fall into bands.  The scheme of a band deals the universe of shingles by
hash into segments; a document takes part in the scheme of its own band, and in
that of the band below if documents there are large enough to be its partners.

Two sets of Jaccard similarity 0.8 or more differ in at most a ninth of the sum of
their sizes, H shingles.  If a set has more than H segments that are worth
something, an equal partner segment must be among them (pigeonhole).  What a
document allocates follows from cost:

* small sets index every segment that isn't empty, which leaves many to spare;
* large ones, which make up most of the shingles, index segments of two shingles
  or more, as these are rare, and those of one only if the others are not more
  than H;
* if all that aren't empty are still too few, each counts twice by its one-deletion
  neighbourhood, which finds a partner segment one shingle away, empty or not;
* if even that is too few (very small sets in very few segments), the
  document goes to one bucket for such documents of the scheme.

It suffices that one of two partners has allocated enough, as both index what
either relies on.  Documents that meet in a bucket are compared by their words.
One document of each class of equal sets is indexed.

Before words are compared, sketches are: a sketch holds, for each of SKETCH_BITS parts
of the universe, whether the set has an odd number of shingles in it.  Shared shingles
cancel out, so two sets differ by at least as many shingles as their sketches by
bits, and a pair with more than H such bits is no link.  That loses none.

A bucket of many members first compares each with the first one only.  Links found
are joined to components.  Where such a bucket still spans several components, its
members outside the largest component are paired with a member of it.  What is
left goes by prefixes: all but H of a set's indexed segments are in each linked
set, so two of them share one of their H + 1 rarest segments.  Of the buckets
that are still open, a document needs the smallest only, as many as its other
segments are short of H + 1.  Of the pairs in those, only such leave the join
whose differences to the bucket's first set are alike (the difference is a
metric) and whose sketches are.  No link is lost by either.

Results in odd cases: null and empty texts have no shingles, link with
nothing and are their own component; repeated rows and copies are one class;
rows without an id are returned with their own size and no component; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.llm.common import map_slices, release_unused, restricted, texts_of, without, written
from fraudlens.llm.components import close_links, components, star_pairs
from fraudlens.llm.words import joined, mixed, owners, rolling, span_hashes, word_spans

WORDS = 5
#: Shingles of a segment in the largest sets of a band, about; then 1.3 in the smallest.
LOAD = 2.6
LEAST_SEGMENTS = 8
#: Up to this band's top, segments of one shingle are indexed as well.
SMALL = 511
#: Members of a bucket that are all paired at once.
ALL_PAIRS = 12
ROUNDS = 1
#: Shingles of the sets that a verifying task keeps, about 100 bytes each.
KEPT_SHINGLES = 500_000
#: Bits of a set's sketch; sets of some thousands of shingles need the words.
SKETCH_BITS = 1024
_SALT = np.uint64(0xD6E8FEB86659FD93)
_SKETCH_SALT = np.uint64(0xA0761D6478BD642F)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def band_top(size: int) -> int:
    """The largest size of a size's band; bands are 1, 2-3, 4-7, 8-15, ..."""
    return (1 << size.bit_length()) - 1


def segments_of(top: int) -> int:
    return max(LEAST_SEGMENTS, round(top / LOAD))


def reach(size: int, other: int) -> int:
    """The largest symmetric difference of linked sets of these sizes."""
    return (size + other) // 9


def shingle_sets(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text and the text of each, in order."""
    buffer, begins = joined([t.encode("utf-8", "replace").translate(_LOWER) for t in texts])
    starts, ends = word_spans(buffer)
    text = owners(starts, begins)
    words = span_hashes(buffer, starts, ends)
    hashes, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(words) >= n:
        runs = rolling(words, n)
        whole = text[: len(runs)] == text[n - 1 :]
        hashes, of = runs[whole], text[: len(runs)][whole]
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        own = [rolling(words[first[i] : first[i + 1]], int(count[i]))[0] + np.uint64(count[i]) for i in short.tolist()]
        hashes, of = np.r_[hashes, np.array(own, np.uint64)], np.r_[of, short]
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    if len(hashes):
        new = np.r_[True, (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])]
        hashes, of = hashes[new], of[new]
    return hashes, of


def _segments(hashes: np.ndarray, of: np.ndarray, scheme: np.ndarray):
    """Segments that aren't empty: key, text, number of shingles, segment and
    the order of the shingles they come from.  ``scheme`` is the band's top for
    each text (0: not in)."""
    many = np.array([segments_of(t) if t else 0 for t in scheme.tolist()], np.int64)
    taken = np.flatnonzero(many[of] > 0)
    h, d = hashes[taken], of[taken]
    segment = ((mixed(h ^ _SALT) >> np.uint64(33)).astype(np.int64)) % many[d]
    order = np.lexsort((segment, d))
    h, d, segment, taken = h[order], d[order], segment[order], taken[order]
    if not len(h):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, none, taken
    begin = np.flatnonzero(np.r_[True, (segment[1:] != segment[:-1]) | (d[1:] != d[:-1])])
    size = np.diff(np.r_[begin, len(h)])
    total = np.add.reduceat(mixed(h), begin)
    return _key(total, scheme[d[begin]], segment[begin], size), d[begin], size, segment[begin], begin, taken


def _key(total, top, segment, size, space: int = 0):
    where = mixed(np.asarray(top).astype(np.uint64) * np.uint64(1 << 34) + np.asarray(segment).astype(np.uint64) + np.uint64(space))
    return mixed(np.asarray(total, np.uint64) + where + mixed(np.asarray(size).astype(np.uint64) + where))


def allocate(hashes: np.ndarray, of: np.ndarray, sizes: np.ndarray, scheme: np.ndarray, need: np.ndarray):
    """Keys that each text indexes in its scheme, the text of each, and the slack of
    each text: indexed segments beyond those needed (below 0: too few)."""
    key, text, size, segment, begin, taken = _segments(hashes, of, scheme)
    n = len(sizes)
    strong = np.bincount(text[size > 1], minlength=n)
    filled = np.bincount(text, minlength=n)
    small = scheme <= SMALL
    weak = ~small & (strong <= need)  # these index segments of one shingle too
    chosen = (size > 1) | (small | weak)[text]
    # partners needn't index the segments of one shingle of weak ones, so those settle nothing
    slack = np.where(small, filled, np.where(weak, 0, strong)) - need - 1
    keys, texts = [key[chosen]], [text[chosen]]
    thin = np.flatnonzero((scheme > 0) & (filled <= need) & (sizes > 0))
    for i in thin.tolist():  # few and small
        own = np.flatnonzero(text == i)
        top, extra = int(scheme[i]), []
        empty = np.setdiff1d(np.arange(segments_of(top)), segment[own])
        extra += [_key(0, top, s, 0, 1 << 33) for s in empty.tolist()]
        for j in own.tolist():
            members = mixed(hashes[taken[begin[j] : begin[j] + size[j]]])
            whole = members.sum(dtype=np.uint64)
            extra.append(_key(whole, top, segment[j], size[j], 1 << 33))
            extra += [_key(whole - x, top, segment[j], size[j] - 1, 1 << 33) for x in members]
        if 2 * filled[i] <= need[i]:
            extra.append(_key(0, top, 0, 0, 1 << 32))
        keys.append(np.array(extra, np.uint64).ravel())
        texts.append(np.full(len(keys[-1]), i))
    return np.concatenate(keys), np.concatenate(texts), slack


def own_scheme(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The band of each size and the difference to partners as large or larger."""
    top = np.array([band_top(int(s)) if s else 0 for s in sizes], np.int64)
    return top, np.array([reach(int(s), int(s) * 5 // 4) for s in sizes], np.int64)


def lower_scheme(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The band below, for sizes that have partners in it."""
    top = np.array([band_top(int(s)) // 2 if s else 0 for s in sizes], np.int64)
    top = np.where(top * 5 >= sizes * 4, top, 0)
    return top, np.array([reach(int(s), int(t)) for s, t in zip(sizes, top, strict=True)], np.int64)


def sketches(hashes: np.ndarray, of: np.ndarray, texts: int) -> np.ndarray:
    """A row of 64-bit words for each text: the parity of its shingles in each part."""
    part = mixed(hashes ^ _SKETCH_SALT) % np.uint64(SKETCH_BITS)
    out = np.zeros((texts, SKETCH_BITS // 64), np.uint64)
    np.bitwise_xor.at(out, (of, (part >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (part & np.uint64(63)))
    return out.view(np.int64)


def _alike(x: str, y: str, total: Column) -> Column:
    """Whether two sketches differ by no more bits than linked sets do by shingles."""
    apart = reduce(add, [F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(SKETCH_BITS // 64)])
    return 9 * apart <= total


def plausible(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) that sizes and sketches don't rule out; ``reps`` has doc_id,
    n_shingles and sketch."""
    for c in ("a", "b"):
        pairs = pairs.join(reps.select(F.col("doc_id").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")), c)
    total = F.col("n_a") + F.col("n_b")
    return pairs.where((9 * F.abs(F.col("n_a") - F.col("n_b")) <= total) & _alike("sketch_a", "sketch_b", total)).select("a", "b")


def _facts(n: int):
    def run(batch: pa.RecordBatch) -> dict:
        texts = batch.column("text").to_pylist()
        hashes, of = shingle_sets(texts, n)
        sizes = np.bincount(of, minlength=len(texts))
        edge = np.searchsorted(of, np.arange(len(texts) + 1))
        top, need = own_scheme(sizes)
        _, _, slack = allocate(hashes, of, sizes, top, need)
        _, _, lower = allocate(hashes, of, sizes, *lower_scheme(sizes))
        digests = [hashlib.blake2b(hashes[edge[i] : edge[i + 1]].tobytes(), digest_size=16).digest() for i in range(len(texts))]
        sketch = pa.ListArray.from_arrays(np.arange(len(texts) + 1, dtype=np.int32) * (SKETCH_BITS // 64), pa.array(sketches(hashes, of, len(texts)).ravel()))
        return {"doc_id": batch.column("doc_id"), "n_shingles": sizes, "digest": digests, "slack": slack, "lower_slack": lower, "sketch": sketch}

    return run


def _keys(n: int):
    """Rows of key and member; a member is twice the id, plus one in the scheme of
    the document's own band."""

    def run(batch: pa.RecordBatch) -> dict:
        texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        hashes, of = shingle_sets(texts, n)
        sizes = np.bincount(of, minlength=len(texts))
        made = [allocate(hashes, of, sizes, *own_scheme(sizes)), allocate(hashes, of, sizes, *lower_scheme(sizes))]
        return {
            "key": np.concatenate([m[0] for m in made]).view(np.int64),
            "member": np.concatenate([ids[m[1]] * 2 + 1 - k for k, m in enumerate(made)]),
        }

    return run


def _shingles(text: str, n: int) -> set:
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def _verify(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, set] = {}  # sets of documents seen lately: members of a group come often
        total = 0

        def of(member: int, text: pa.StringScalar) -> set:
            nonlocal total
            own = kept.get(member)
            if own is None:
                own = _shingles(text.as_py(), n)
                total += len(own)
                if total > KEPT_SHINGLES:
                    kept.clear()
                    total = len(own)
                kept[member] = own
            return own

        for batch in batches:
            found: list[tuple[int, int, int, bool]] = []
            first, second = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            for a, b, x, y in zip(first, second, batch.column("text_a"), batch.column("text_b"), strict=True):
                left, right = of(a, x), of(b, y)
                both = len(left & right)
                union = len(left) + len(right) - both
                found.append((a, b, union - both, 100 * both >= 80 * union > 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], pa.bool_() if i == 3 else pa.int64()) for i in range(4)],
                names=["a", "b", "differ", "linked"],
            )
        release_unused()

    return run


def measured(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """Pairs (a, b) with the size of their symmetric difference (differ) and whether
    their Jaccard similarity is 0.8 or more (linked), by the words."""
    ends = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
    own = restricted(texts, ends, "doc_id")
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = pairs.join(own.withColumnsRenamed({"doc_id": "a", "text": "text_a"}), "a")
    # the work is more than the bytes tell, so these partitions are not coalesced
    both = left.repartition(partitions, "b").join(own.withColumnsRenamed({"doc_id": "b", "text": "text_b"}), "b")
    found = both.select("a", "b", "text_a", "text_b").mapInArrow(_verify(n), "a long, b long, differ long, linked boolean")
    return written(found, "measured")


def links(docs: DataFrame, facts: DataFrame, n: int = WORDS) -> DataFrame:
    """Links (a, b) between classes of equal sets that have all components of the
    exact join.  ``facts`` has doc_id, rep (of the class), n_shingles, slack,
    lower_slack and sketch."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = without(docs, facts.where("doc_id <> rep"), "doc_id")
    reps = facts.where("doc_id = rep")
    met = written(star_pairs(map_slices(docs, _keys(n), "key long, member long"), "key", "member", ALL_PAIRS, partitions), "buckets")
    met = met.select("bucket", F.shiftright("a", 1).alias("a"), F.shiftright("b", 1).alias("b"), F.col("b").bitwiseAND(1).alias("own"))
    tried = met.where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max(F.col("bucket").isNotNull()).alias("large"))
    tried = written(tried, "pairs")
    # differences to the first of a large bucket are needed, of linked sets or not
    near = tried.where("large").select("a", "b").unionByName(plausible(tried.where("NOT large").select("a", "b"), reps))
    tried = tried.select("a", "b")
    known = measured(written(near, "near"), docs, n)
    found = known.where("linked").select("a", "b")
    large = met.where("bucket IS NOT NULL")
    if large.isEmpty():
        return found

    # members of large buckets with their difference to the bucket's first
    large = large.groupBy("bucket", F.col("a").alias("first"), F.col("b").alias("member")).agg(F.max("own").alias("own"))
    large = large.withColumns({"a": F.least("first", "member"), "b": F.greatest("first", "member")})
    large = written(
        large.join(known.select("a", "b", "differ"), ["a", "b"], "left")
        .join(reps.select(F.col("doc_id").alias("member"), F.col("n_shingles").alias("n")), "member")
        .select("bucket", "member", "own", "n", F.coalesce("differ", F.lit(0)).alias("differ")),
        "large",
    )
    spare = reps.select(
        F.col("doc_id").alias("member"),
        F.explode(F.array(F.struct(F.lit(1).alias("own"), "slack"), F.struct(F.lit(0).alias("own"), F.col("lower_slack").alias("slack")))).alias("s"),
    ).select("member", F.col("s.own").cast("bigint").alias("own"), F.col("s.slack").alias("slack"))

    def rest(rows: DataFrame) -> DataFrame:
        """Pairs by prefixes and by differences to a third set: linked sets that meet
        in large buckets only share one among the smallest of either, as many as its
        other segments leave open, and differ from any set by numbers that differ by
        no more than their own difference."""
        size = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
        mine = Window.partitionBy("member", "own")  # at most the segments of a document
        ranked = rows.join(size, "bucket").join(spare, ["member", "own"]).withColumns(
            {"used": F.count(F.lit(1)).over(mine), "turn": F.row_number().over(mine.orderBy("size", "bucket"))}
        )
        short = ranked.where("turn <= used - slack").select("bucket", "member", "own", "component", "n", "differ")
        prefix = written(short.join(reps.select(F.col("doc_id").alias("member"), "sketch"), "member"), "prefix")
        x = prefix.where("own = 1").select("bucket", F.col("member").alias("a"), F.col("component").alias("of_a"), F.col("n").alias("n_a"), F.col("differ").alias("to_a"), F.col("sketch").alias("sketch_a"))
        y = prefix.select("bucket", "own", F.col("member").alias("b"), F.col("component").alias("of_b"), F.col("n").alias("n_b"), F.col("differ").alias("to_b"), F.col("sketch").alias("sketch_b"))
        near = (9 * F.abs(F.col("n_a") - F.col("n_b")) <= F.col("n_a") + F.col("n_b")) & (
            9 * F.abs(F.col("to_a") - F.col("to_b")) <= F.col("n_a") + F.col("n_b")
        )
        apart = (F.col("of_a") < F.col("of_b")) | ((F.col("own") == 0) & (F.col("of_a") > F.col("of_b")))
        alike = _alike("sketch_a", "sketch_b", F.col("n_a") + F.col("n_b"))
        return x.join(y, (x["bucket"] == y["bucket"]) & near & apart & alike).select("a", "b")

    def linked(pairs: DataFrame) -> DataFrame:
        return measured(written(plausible(pairs, reps), "near"), docs, n).where("linked").select("a", "b")

    return close_links(large, found, tried, linked, rest, ROUNDS)


def ngram_join(docs: DataFrame, n: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id that links reach) of
    each row."""
    docs = texts_of(docs, id_col, text_col)
    facts = written(map_slices(docs, _facts(n), "doc_id long, n_shingles long, digest binary, slack long, lower_slack long, sketch array<long>"), "facts")
    filled = facts.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = filled.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = written(
        filled.join(reps, "digest").groupBy("doc_id", "rep").agg(*[F.min(c).alias(c) for c in ("n_shingles", "slack", "lower_slack", "sketch")]),
        "classes",
    )
    label = components(links(docs.where("doc_id IS NOT NULL"), classes, n)).withColumnRenamed("node", "rep")
    named = classes.join(label, "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component_id"))
    return facts.join(named, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
