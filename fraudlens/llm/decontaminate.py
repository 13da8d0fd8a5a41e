"""Benchmark decontamination by template windows.

A text becomes a sequence of tokens in which numbers (with a unit or without)
and names are typed placeholders: the same question with other numbers or names
has the same template.  Windows of ``n`` template tokens of documents and
items meet in a hash join.  Two readings of a text are joined, one in which names
are placeholders and one in which they are words, so that a passage whose case was
changed is found as well.

The windows that a document and an item share are then checked along their
alignment (a fixed distance between the positions in both).  A window with the
item's own values counts in any case, one with other values if the alignment's
names map one to one.  Numbers need not: equal ones may be so by chance, and become
different ones, or the other way.  A document is contaminated by an item if the
counted windows are at least ``share`` of the item's, or if ``RUN`` tokens in a row
are covered by windows of one alignment, as a long item may be quoted in part.

An item without such windows (mostly numbers, as windows need LEAST_LITERAL words) is
searched by exact windows of all its words and numbers, as they stand.  In scripts
without blanks each character is a word.

Before the join, a bit map of the item windows' hashes (a fixed 2 MB, whatever
the size of the benchmark) drops document windows that cannot match.

Results in odd cases: null and empty texts match nothing; an item of fewer than
``n`` tokens is one shorter window, and one of fewer than ``LEAST_WORDS`` tokens is not
searched, as chance would find it everywhere, and a warning says how many these are
(:func:`unsearched` lists them); repeated rows give repeated pairs
once; rows without an id match nothing; empty tables give an empty result.
"""

from __future__ import annotations

import re
import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.common import map_slices, texts_of, written
from fraudlens.llm.words import joined, mixed, owners, rolling, span_hashes, word_spans

WINDOW = 5
SHARE = 0.5
#: Tokens in a row that are a leak by themselves, whatever share of the item they are.
RUN = 13
LEAST_WORDS = 4
#: Words, not slots, in a window of WINDOW at least; less would match by chance.
LEAST_LITERAL = 3
MAP_BITS = 24

#: Unit words that belong to the number before them.
UNITS = (
    "km m cm mm mi ft in kg g mg lb oz l ml s ms min h hr hrs hours hour minutes minute seconds second days day weeks week months month "
    "years year percent dollars dollar euros euro cents cent pounds pound miles mile meters meter metres metre feet inches "
    "grams gram kilograms liters liter litres mph kph kmh usd eur gbp degrees"
).split()

#: Marks become blanks; a decimal point or comma does too, and the parts of a
#: number then count as one.
_PLAIN = bytes(c if chr(c).isalnum() and c < 128 or c > 127 else 32 for c in range(256))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_IS_END = np.zeros(256, np.int32)
_IS_END[list(b".!?:\n\"'()[]|")] = 1
_IS_DIGIT = np.zeros(256, bool)
_IS_DIGIT[48:58] = True
_IS_CAPITAL = np.zeros(256, bool)
_IS_CAPITAL[65:91] = True


#: Characters of scripts without blanks (Thai, Lao, Burmese, Khmer, kana, Han), and their marks.
_ALONE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_WIDE_MARKS = re.compile("[\u3000-\u303f\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")
#: Added to the hash of an exact window, so that it meets exact windows only.
EXACT = np.uint64(0x5EED0E8AC7)


def _apart(text: str) -> str:
    """The text with blanks around each character of a script without blanks."""
    if text.isascii() or not _ALONE.search(text):
        return text
    return _ALONE.sub(r" \g<0> ", _WIDE_MARKS.sub(" ", text))


def _hash_of(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(data, np.array([0]), np.array([len(data)]))[0])


_UNIT_HASHES = np.array(sorted(map(_hash_of, UNITS)), np.uint64)
NUMBER, NAME = np.uint64(_hash_of("<number>")), np.uint64(_hash_of("<name>"))


class Tokens:
    """Template tokens of several texts: ``plain`` with slots for numbers only,
    ``named`` with slots for names too, the hash of the ``value`` of each token, and
    the number of the ``text`` it is in.  ``word`` and ``word_text`` have the hash and
    text of each word or part of a number, as it stands."""

    def __init__(self, texts: list[str]):
        raw = [_apart(t).encode("utf-8", "replace") for t in texts]
        original, begins = joined(raw)
        buffer = np.frombuffer(original.tobytes().translate(_PLAIN).translate(_LOWER), np.uint8)
        starts, ends = word_spans(buffer)
        text = owners(starts, begins)
        value = span_hashes(buffer, starts, ends)
        self.word, self.word_text = value, text
        self.word_first = np.searchsorted(text, np.arange(len(texts) + 1))
        number = _IS_DIGIT[buffer[starts]] if len(starts) else np.zeros(0, bool)
        # a unit right after a number, and further parts of a number, belong to it
        after = np.zeros(len(starts), bool)
        if len(starts):
            near = (text[1:] == text[:-1]) & number[:-1]
            gap = starts[1:] - ends[:-1]
            after[1:] = near & ((number[1:] & (gap == 1) & _between(original, ends[:-1])) | (np.isin(value[1:], _UNIT_HASHES) & (gap <= 1)))
        head = np.flatnonzero(~after)
        if len(head):
            combined = value.copy()
            part = np.cumsum(~after) - 1
            extra = np.zeros(len(head), np.uint64)
            np.add.at(extra, part[after], mixed(value[after]))
            combined = value[head] + extra
        else:
            combined = value[:0]
        ended = np.r_[0, np.cumsum(_IS_END[original])]
        first = np.zeros(len(starts), bool)
        if len(starts):
            first[0] = True
            first[1:] = (text[1:] != text[:-1]) | (ended[starts[1:]] > ended[ends[:-1]])
        name = (_IS_CAPITAL[original[starts]] & ~first & ~number)[head] if len(head) else np.zeros(0, bool)
        self.text, self.value = text[head], combined
        self.number = number[head]
        self.plain = np.where(self.number, NUMBER, combined)
        self.named = np.where(name, NAME, self.plain)
        self.slot_plain, self.slot_named = self.number, self.number | name
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))


def _between(original: np.ndarray, at: np.ndarray) -> np.ndarray:
    """True where the byte at a gap is a decimal or group mark."""
    return (original[at] == 46) | (original[at] == 44)


def windows(tokens: Tokens, n: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For both readings: the windows' hashes, first tokens and slots (bits).
    The second reading gives only windows that hold a name."""
    out = []
    literal_least = min(LEAST_LITERAL, n)
    for kind, slot in ((tokens.plain, tokens.slot_plain), (tokens.named, tokens.slot_named)):
        if len(kind) < n:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)))
            continue
        m = len(kind) - n + 1
        hashes = rolling(kind, n) + np.uint64(n)
        bits = sum(slot[j : m + j].astype(np.int64) << j for j in range(n))
        literal = n - sum(slot[j : m + j].astype(np.int64) for j in range(n))
        whole = (tokens.text[:m] == tokens.text[n - 1 :]) & (literal >= literal_least)
        if out:
            whole &= bits != sum(tokens.slot_plain[j : m + j].astype(np.int64) << j for j in range(n))
        at = np.flatnonzero(whole)
        out.append((hashes[at], at, bits[at]))
    return out


def _slots(tokens: Tokens, at: np.ndarray, bits: np.ndarray) -> list[list[int]]:
    """Values that fill the slots of each window, in order; those of names are odd."""
    if not bits.any():
        return [[]] * len(at)
    value = (tokens.value & ~np.uint64(1) | (~tokens.number).astype(np.uint64)).view(np.int64)
    return [[int(value[a + j]) for j in range(b.bit_length()) if b >> j & 1] if b else [] for a, b in zip(at.tolist(), bits.tolist(), strict=True)]


def exact_windows(tokens: Tokens, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first words of the windows of ``n`` words and numbers as they stand."""
    if len(tokens.word) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(tokens.word_text[: len(tokens.word) - n + 1] == tokens.word_text[n - 1 :])
    return mixed(rolling(tokens.word, n)[at] + np.uint64(n) + EXACT), at


_COLUMNS = "id long, n_tokens long, exact boolean, position int, key long, slots array<long>"


def _rows(tokens: Tokens, ids: list, sizes: list[int], exact_sizes: list[int], keep, keep_exact) -> dict:
    out = {name: [] for name in ("id", "n_tokens", "exact", "position", "key", "slots")}
    length = np.diff(tokens.first)
    for n in sizes:
        for hashes, at, bits in windows(tokens, n):
            chosen = keep(hashes, at, n)
            hashes, at, bits = hashes[chosen], at[chosen], bits[chosen]
            of = tokens.text[at]
            out["id"] += [ids[i] for i in of.tolist()]
            out["n_tokens"] += length[of].tolist()
            out["position"] += (at - tokens.first[of]).tolist()
            out["key"] += hashes.view(np.int64).tolist()
            out["slots"] += _slots(tokens, at, bits)
    out["exact"] = [False] * len(out["id"])
    have = set(out["id"])
    length = np.diff(tokens.word_first)
    for n in exact_sizes:
        hashes, at = exact_windows(tokens, n)
        chosen = keep_exact(hashes, at, n, have)
        hashes, at = hashes[chosen], at[chosen]
        of = tokens.word_text[at]
        out["id"] += [ids[i] for i in of.tolist()]
        out["n_tokens"] += length[of].tolist()
        out["exact"] += [True] * len(at)
        out["position"] += (at - tokens.word_first[of]).tolist()
        out["key"] += hashes.view(np.int64).tolist()
        out["slots"] += [[]] * len(at)
    return out


def item_windows(items: DataFrame, n: int) -> DataFrame:
    """Windows of the benchmark: ``n`` tokens, or the whole of a shorter item; exact
    ones of an item that has no others."""

    def run(batch: pa.RecordBatch) -> dict:
        tokens = Tokens(batch.column("text").to_pylist())
        length = np.diff(tokens.first)

        def keep(hashes, at, size):
            own = length[tokens.text[at]]
            return own >= n if size == n else own == size

        ids = batch.column("doc_id").to_pylist()
        words = np.diff(tokens.word_first)

        def keep_exact(hashes, at, size, have):
            of = tokens.word_text[at]
            without = np.array([i not in have for i in ids], bool)
            return without[of] & ((words[of] >= n) if size == n else (words[of] == size))

        sizes = [*range(LEAST_WORDS, n), n]
        return _rows(tokens, ids, sizes, sizes, keep, keep_exact)

    return map_slices(items, run, _COLUMNS)


def unsearched(items: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id and text of the items that have no window at all."""
    return items.join(benchmark.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_anti")


def document_windows(docs: DataFrame, sizes: list[int], exact_sizes: list[int], bit_map: np.ndarray) -> DataFrame:
    """Windows of documents whose hash the bit map has."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_map)

    def run(batch: pa.RecordBatch) -> dict:
        tokens = Tokens(batch.column("text").to_pylist())

        def keep(hashes, at, size):
            place = hashes >> np.uint64(64 - MAP_BITS)
            return (shared.value[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0

        return _rows(tokens, batch.column("doc_id").to_pylist(), sizes, exact_sizes, keep, lambda hashes, at, size, have: keep(hashes, at, size))

    return map_slices(docs, run, _COLUMNS)


def _bit_map(found: DataFrame) -> np.ndarray:
    """One bit for each value of a hash's first MAP_BITS bits, set where an item
    window has it.  At most 2 ** (MAP_BITS - 6) rows reach the driver."""
    place = F.shiftrightunsigned("key", 64 - MAP_BITS)
    words = (
        found.groupBy(F.shiftright(place, 6).alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - MAP_BITS}) & 63 as int))")).alias("bits"))
        .collect()
    )
    out = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    for r in words:
        out[r["word"]] = np.uint64(r["bits"] & 0xFFFFFFFFFFFFFFFF)
    return out


def decontaminate(
    docs: DataFrame, items: DataFrame, n: int = WINDOW, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, windows (of the item found in the document), item_windows,
    share and changed (True if a slot's value differs) of each contaminated pair."""
    docs = texts_of(docs, id_col, text_col).where(F.col("doc_id").isNotNull())
    items = texts_of(items, item_col, item_text_col).where(F.col("doc_id").isNotNull()).distinct()
    benchmark = written(item_windows(items, n), "items")
    left = unsearched(items, benchmark).count()
    if left:
        warnings.warn(f"{left} benchmark items have fewer than {LEAST_WORDS} words and are not searched", stacklevel=2)
    # the lengths of windows: few numbers, up to n
    used = benchmark.select("exact", F.least("n_tokens", F.lit(n)).alias("s")).distinct().collect()
    sizes, exact_sizes = [[r["s"] for r in used if r["exact"] == e] for e in (False, True)]
    total = benchmark.groupBy("id").agg(F.countDistinct("position").alias("item_windows"))
    ours = benchmark.select(F.col("id").alias("item_id"), F.col("position").alias("item_position"), "key", F.col("slots").alias("item_slots"))
    theirs = document_windows(docs, sizes, exact_sizes, _bit_map(benchmark)).select(F.col("id").alias("doc_id"), "position", "key", "slots")
    met = theirs.join(ours, "key").where(F.size("slots") == F.size("item_slots"))
    pair = ["doc_id", "item_id", (F.col("position") - F.col("item_position")).alias("distance")]
    # one alignment has at most one window of a position and reading, so at most
    # as many values as the item has tokens
    values = F.array_distinct(F.flatten(F.collect_list(F.arrays_zip("item_slots", "slots"))))
    own = F.col("item_slots") == F.col("slots")
    aligned = met.groupBy(*pair).agg(
        F.collect_set("item_position").alias("all"), F.collect_set(F.when(own, F.col("item_position"))).alias("own"), values.alias("filled")
    )
    names = F.filter("filled", lambda v: v["slots"] % 2 != 0)
    aligned = aligned.withColumn("names", names)
    one_to_one = (F.size(F.array_distinct("names.item_slots")) == F.size("names")) & (F.size(F.array_distinct("names.slots")) == F.size("names"))
    changed = F.exists("filled", lambda v: v["item_slots"] != v["slots"])
    aligned = aligned.withColumn("found", F.array_sort(F.when(one_to_one, F.col("all")).otherwise(F.col("own"))))
    row = max(RUN - n, 0)  # windows after the first that cover RUN tokens
    long = F.exists(F.transform("found", lambda p, i: F.get("found", i + row) == p + row), lambda x: F.coalesce(x, F.lit(False)))
    return (
        aligned.select("doc_id", "item_id", changed.alias("changed"), long.alias("long"), F.explode("found").alias("p"))
        .groupBy("doc_id", "item_id")
        .agg(F.countDistinct("p").alias("windows"), F.min("changed").alias("changed"), F.max("long").alias("long"))
        .join(total.withColumnRenamed("id", "item_id"), "item_id")
        .withColumn("share", F.col("windows") / F.col("item_windows"))
        .where((F.col("share") >= share) | F.col("long"))
        .select("doc_id", "item_id", "windows", "item_windows", "share", "changed")
    )
