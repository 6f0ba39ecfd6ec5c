"""Byte-level BPE encoding and decoding.

Encoding: the text is cut at added-token strings, then into pieces by the tokenizer's pattern; each piece is a doubly
linked list of symbols whose adjacent pairs wait in a priority queue by merge rank.  Entries whose pair has changed
since are stale and skipped.  Decoding: the bytes of the vocabulary's tokens are taken by id and concatenated.

A piece never spans the end of a non-space run, so encodings are cached per ``white space + word`` chunk (bounded
cache), as packed ids; the concatenation over chunks is the encoding of the whole text.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import struct
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quayside.llm.common import TwoGenerationCache, arrow_map

# Fixed value: the split pattern of byte-level BPE.
PIECE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: the code points of Unicode's White_Space property.
UNICODE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                                  0x202F, 0x205F, 0x3000]))
CHUNKS = re.compile(f"[{UNICODE_SPACE}]*[^{UNICODE_SPACE}]+|[{UNICODE_SPACE}]+")
# Bounds of the caches per Python worker, in keys of at most 64 characters per generation (two generations of each are kept).
CHUNK_KEYS, PIECE_KEYS = 450_000, 250_000
# Ids of a text that are written out and decoded at once.
SPAN_IDS = 1 << 20


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself when printable, else the
    next character from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ByteBpe:
    """Encoder and decoder over a vocabulary file of the ``tokenizers`` library (byte-level, no normalizer)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in spec["model"]["merges"]]
        # per left id: right id -> rank; and the merged id of each rank
        follow: dict[int, dict[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            follow.setdefault(vocab[a], {})[vocab[b]] = rank
        self.merged = [vocab[a + b] for a, b in pairs]
        alphabet = byte_alphabet()
        self.byte_ids = [vocab[alphabet[b]] for b in range(256)]
        of_id = {i: b for b, i in enumerate(self.byte_ids)}
        self.byte_ranks = {(of_id[a], of_id[b]): rank for a, ranks in follow.items() if a in of_id
                           for b, rank in ranks.items() if b in of_id}
        to_byte = {c: b for b, c in alphabet.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes = {i: bytes(to_byte[c] for c in s) for s, i in vocab.items()}
        self.token_bytes |= {i: s.encode() for s, i in self.added.items()}
        n_ids = max(self.token_bytes) + 1
        none: dict[int, int] = {}
        self.rank_after = [follow.get(i, none).get for i in range(n_ids)]
        self.id_bytes = pa.array([self.token_bytes.get(i, b"") for i in range(n_ids)], pa.binary())
        self.id_digits = pa.array([b",%d" % i for i in range(n_ids)], pa.binary())
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_re = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.pieces = regex.compile(PIECE_PATTERN)
        self.piece_ids = TwoGenerationCache(lambda piece: packed(self.encode_piece(piece.encode())), PIECE_KEYS)
        self.cache = TwoGenerationCache(self._chunk, CHUNK_KEYS)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece: merges in order of rank, leftmost first among equals."""
        byte_ids, n = self.byte_ids, len(piece)
        ids = [byte_ids[b] for b in piece]
        # rank of the pair that begins at each symbol; none where the symbol is gone, ends the list or merges with no follower
        ranks = [*map(self.byte_ranks.get, zip(piece, piece[1:])), None]
        bits = n.bit_length()
        queue = [rank << bits | i for i, rank in enumerate(ranks) if rank is not None]
        if not queue:
            return ids
        heapify(queue)
        rank_after, merged, low = self.rank_after, self.merged, (1 << bits) - 1
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        while queue:
            entry = heappop(queue)
            at, rank = entry & low, entry >> bits
            if ranks[at] != rank:
                continue  # stale: the pair has changed
            right = after[at]
            ids[at] = here = merged[rank]
            ids[right] = -1
            ranks[right] = None
            follower = after[at] = after[right]
            if follower >= 0:
                before[follower] = at
                rank = ranks[at] = rank_after[here](ids[follower])
                if rank is not None:
                    heappush(queue, rank << bits | at)
            else:
                ranks[at] = None
            left = before[at]
            if left >= 0:
                rank = ranks[left] = rank_after[ids[left]](here)
                if rank is not None:
                    heappush(queue, rank << bits | left)
        return [i for i in ids if i >= 0]

    def _chunk(self, chunk: str) -> bytes:
        pieces, cache = self.pieces.findall(chunk), self.piece_ids
        return cache[chunk] if len(pieces) == 1 else b"".join([cache[p] for p in pieces])

    def _ids(self, text: str) -> bytes:
        """The ids of the text, packed."""
        chunk = self.cache.__getitem__
        if self.added_re is None or not self.added_re.search(text):
            return b"".join(map(chunk, CHUNKS.findall(text)))
        return b"".join([packed([self.added[span]]) if k % 2 else b"".join(map(chunk, CHUNKS.findall(span)))
                         for k, span in enumerate(self.added_re.split(text))])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self._ids(text), "<u4").tolist()

    def count(self, text: str) -> int:
        """Number of tokens of the text."""
        return len(self._ids(text)) // 4

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.token_bytes[i] for i in ids]).decode("utf-8", "replace")

    def digest(self, text: str) -> tuple[int, str, str]:
        """Token count, SHA-256 of the decimal ids joined by commas, SHA-256 of the decoded text."""
        ids = self._ids(text)
        n, buffer = len(ids) // 4, pa.py_buffer(ids)
        digits, back, decoder = hashlib.sha256(), hashlib.sha256(), codecs.getincrementaldecoder("utf-8")("replace")
        for at in range(0, n, SPAN_IDS):
            span = pa.Array.from_buffers(pa.uint32(), min(SPAN_IDS, n - at), [None, buffer], offset=at)
            digits.update(joined(self.id_digits, span)[0 if at else 1:])
            back.update(decoder.decode(joined(self.id_bytes, span)).encode())
        back.update(decoder.decode(b"", True).encode())
        return n, digits.hexdigest(), back.hexdigest()


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def joined(strings: pa.BinaryArray, at: pa.Array) -> memoryview:
    """The strings at the positions ``at`` (one or more), one after the other."""
    _, ends, data = strings.take(at).buffers()
    return memoryview(data)[:np.frombuffer(ends, "<i4")[len(at)]]


_LOADED: dict[str, ByteBpe] = {}


def loaded(path: str) -> ByteBpe:
    """The encoder of ``path``, read once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, ids, decoded)`` of every row of ``docs (doc_id, text)``: token ids and the text they decode to.

    A null text is empty (no ids); a null ``doc_id`` and repeated rows stay as they are, one row out per row in.
    Other columns are ignored.  An empty table gives an empty result.  ``vocabulary`` is read on the workers."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = loaded(vocabulary)
        ids = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([bpe.decode(x) for x in ids], pa.string())],
            names=["doc_id", "ids", "decoded"])

    return arrow_map(docs.select(docs["doc_id"].cast("long"), docs["text"]), fn,
                     "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` per row: the digests of what ``encode`` gives, without
    moving the ids out of the worker.  Nulls, repeats and empty tables as for ``encode``."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = loaded(vocabulary)
        rows = [bpe.digest(t.as_py() or "") for t in batch.column(1)]
        n, ids, back = zip(*rows)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(back)],
                                          names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return arrow_map(docs.select(docs["doc_id"].cast("long"), docs["text"]), fn,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
