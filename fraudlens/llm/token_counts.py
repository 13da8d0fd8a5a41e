"""Token counts by byte-pair merging with a heap and a linked list.

A text is cut at the strings of special tokens (each is one token), the rest
into pre-tokens by the vocabulary's pattern.  The bytes of a pre-token are its
first symbols; the adjacent pair of the lowest rank is popped from a heap and
merged in a doubly linked list until no pair has a rank.  A pre-token counts as
its initial symbols minus its merges; no identifiers are made.

Results in odd cases: a null or empty text has 0 bytes and 0 tokens; a row
whose id is null keeps it; repeated rows are counted each; an empty table gives
an empty result; columns besides id and text are ignored.
"""

from __future__ import annotations

import heapq
import json
import sys
import unicodedata
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
import tokenizers
from pyspark.sql import DataFrame

from fraudlens.llm.common import map_slices, texts_of

#: Counts kept for each Python worker, so that a frequent pre-token is merged once.
CACHE_ENTRIES = 300_000
#: Longer pre-tokens are rare and not kept.
CACHE_CHARS = 40


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 as itself, the others as the letters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class MergeCounter:
    """Counts the tokens of a text for a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.pattern = regex.compile(pattern)
        specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.specials = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        letters = byte_letters()
        number = {s: i for i, s in enumerate(dict.fromkeys([*letters, *spec["model"]["vocab"]]))}
        self.byte_symbol = [number[x] for x in letters]
        self.ranks: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault(number[a] << 20 | number[b], (rank, number[a + b]))
        self.kept: dict[str, int] = {}
        self.high = regex.compile("[\u0530-\U0010ffff]")
        self.newer: regex.Pattern | None = None
        self.splitter = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens.  The pattern's letter and number classes follow the newest
        Unicode version; a text with a character that an older version leaves
        unassigned is cut by the vocabulary's own library."""
        if not text.isascii() and self.high.search(text):
            if self.newer is None:
                every = "".join(chr(c) for c in range(0x530, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
                found = (c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn")
                self.newer = regex.compile("[" + "".join(map(regex.escape, found)) + "]")
            if self.newer.search(text):
                return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def merged(self, piece: bytes) -> int:
        """Symbols left of one pre-token."""
        n = len(piece)
        if n < 2:
            return n
        ranks = self.ranks
        symbol = [self.byte_symbol[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [-1] * n  # the rank of the pair that begins at each node now
        heap = []
        for i in range(n - 1):
            found = ranks.get(symbol[i] << 20 | symbol[i + 1])
            if found:
                pair[i] = found[0]
                heap.append(found[0] << 32 | i)
        heapq.heapify(heap)
        left = n
        while heap:
            top = heapq.heappop(heap)
            rank, i = top >> 32, top & 0xFFFFFFFF
            if pair[i] != rank:
                continue  # one of its two symbols has been merged meanwhile
            j = after[i]
            symbol[i] = ranks[symbol[i] << 20 | symbol[j]][1]
            pair[j] = -1
            k = after[i] = after[j]
            left -= 1
            pair[i] = -1
            if k < n:
                before[k] = i
                found = ranks.get(symbol[i] << 20 | symbol[k])
                if found:
                    pair[i] = found[0]
                    heapq.heappush(heap, found[0] << 32 | i)
            h = before[i]
            if h >= 0:
                found = ranks.get(symbol[h] << 20 | symbol[i])
                pair[h] = found[0] if found else -1
                if found:
                    heapq.heappush(heap, found[0] << 32 | h)
        return left

    def count(self, text: str) -> int:
        total = 0
        parts = [text]
        if self.specials:
            parts = self.specials.split(text)
            total = len(parts) - 1
        kept = self.kept
        for part in parts:
            for piece in self.pieces(part):
                n = kept.get(piece)
                if n is None:
                    n = self.merged(piece.encode("utf-8"))
                    if len(piece) <= CACHE_CHARS:
                        if len(kept) >= CACHE_ENTRIES:
                            kept.clear()
                        kept[piece] = n
                total += n
        return total


@lru_cache(maxsize=2)
def merge_counter(path: str, pattern: str) -> MergeCounter:
    return MergeCounter(path, pattern)


def token_counts(
    docs: DataFrame, vocabulary: str, pattern: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) for each
    row of ``docs``.  ``vocabulary`` is the path of a byte-level BPE file that
    every executor can read."""

    def count(batch: pa.RecordBatch) -> dict:
        counter = merge_counter(vocabulary, pattern)
        texts = batch.column("text").to_pylist()
        tokens = [counter.count(t) for t in texts]
        return {
            "doc_id": batch.column("doc_id"),
            "n_bytes": pc.binary_length(batch.column("text")).cast(pa.int64()),
            "n_tokens": tokens,
            "over_limit": [n > limit for n in tokens],
        }

    return map_slices(texts_of(docs, id_col, text_col), count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
