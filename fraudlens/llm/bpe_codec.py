"""Byte-level BPE encoding and decoding through a sentencepiece model.

The model is serialised here from a rank file, nothing is trained: every token
becomes a piece whose bytes are written as one letter each, scored by the
negative rank, with identity normalisation.  sentencepiece then merges the best
scored adjacent pair first, which is the order of the ranks.  Each match of the
pre-token pattern is encoded by itself, and pieces are numbered so that a piece
id is the token's rank.  Decoding maps ids back to their bytes.

Results in odd cases: a null or empty text has no ids; a row whose id is null
keeps it; repeated rows are encoded each; an empty table gives an empty result;
columns besides id and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from fraudlens.llm.common import map_slices, texts_of

#: Letters of the 256 bytes: a block without white space, case or combining marks.
FIRST_LETTER = 0x4E00
#: Encoded pre-tokens kept for each Python worker.
CACHE_ENTRIES = 300_000
CACHE_CHARS = 40


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protocol-buffer field: bytes (wire type 2), int (0) or float (5)."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def written_bytes(data: bytes) -> str:
    """The letters of ``data``, one for each byte."""
    return (np.frombuffer(data, np.uint8).astype("<u2") + FIRST_LETTER).tobytes().decode("utf-16-le")


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece ModelProto of BPE type.  Piece ids are ranks, so the
    ranks must be 0, 1, 2, ...; the unknown piece, which every model needs,
    comes last."""
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    normal, unknown = 1, 2  # SentencePiece.Type
    pieces = [_field(1, written_bytes(t).encode()) + _field(2, -float(r)) + _field(3, normal) for r, t in enumerate(tokens)]
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown))
    # model_type BPE; ids of unk, bos, eos, pad (-1: absent)
    absent = (1 << 64) - 1
    trainer = _field(3, 2) + _field(40, len(tokens)) + _field(41, absent) + _field(42, absent) + _field(43, absent)
    # identity: no character map, no dummy prefix, no removed or escaped white space
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes texts to ranks and ranks to bytes."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.ranks))
        self.token = sorted(self.ranks, key=self.ranks.get)
        self.decimal = list(map(str, range(len(self.token))))
        self.kept: dict[str, list[int]] = {}

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ranks of each text.  Pre-tokens that are new are encoded by one call for all."""
        found = [self.pattern.findall(t) for t in texts]
        kept = self.kept
        new = list(set().union(*found).difference(kept))
        own: dict[str, list[int]] = {}
        if new:
            raw = [p.encode("utf-8") for p in new]
            # a pre-token that is itself a token is never cut
            whole = list(map(self.ranks.get, raw))
            own = {p: [r] for p, r in zip(new, whole, strict=True) if r is not None}
            rest = [i for i, r in enumerate(whole) if r is None]
            coded = self.pieces.encode([written_bytes(raw[i]) for i in rest], num_threads=1) if rest else []
            own.update((new[i], ids) for i, ids in zip(rest, coded, strict=True))
            if len(kept) + len(own) > CACHE_ENTRIES:
                # what these texts need stays; the others are encoded again when met
                self.kept = kept = {p: kept[p] for p in set().union(*found) if p in kept}
            kept.update((p, ids) for p, ids in own.items() if len(p) <= CACHE_CHARS)
            if any(len(p) > CACHE_CHARS for p in new):
                kept = kept | own
        return [list(chain.from_iterable(map(kept.__getitem__, f))) for f in found]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of each row's text.  ``vocabulary`` is the
    path of a rank file that every executor can read."""

    def run(batch: pa.RecordBatch) -> dict:
        c = codec(vocabulary, pattern)
        return {"doc_id": batch.column("doc_id"), "ids": c.encode_all(batch.column("text").to_pylist())}

    return map_slices(texts_of(docs, id_col, text_col), run, "doc_id long, ids array<int>")


def decode(coded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id and decoded (binary) of rows of doc_id and ids."""

    def run(batches):
        c = codec(vocabulary, pattern)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([c.decode(x or []) for x in ids], pa.binary())], names=["doc_id", "decoded"]
            )

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by one space) and
    decoded_sha256 (bytes decoded from the ids) of each row, in one pass."""

    def run(batch: pa.RecordBatch) -> dict:
        c = codec(vocabulary, pattern)
        n, of_ids, of_bytes = [], [], []
        for ids in c.encode_all(batch.column("text").to_pylist()):
            n.append(len(ids))
            of_ids.append(hashlib.sha256(" ".join(map(c.decimal.__getitem__, ids)).encode()).hexdigest())
            of_bytes.append(hashlib.sha256(c.decode(ids)).hexdigest())
        return {"doc_id": batch.column("doc_id"), "n_tokens": n, "ids_sha256": of_ids, "decoded_sha256": of_bytes}

    return map_slices(
        texts_of(docs, id_col, text_col), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
