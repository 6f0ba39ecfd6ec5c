"""Token counts of whole texts by a SentencePiece BPE model.

Huge documents are encoded in overlapping chunks with token offsets.  Two neighbouring chunks are spliced at a boundary
both encodings share and that is proven stable: the two characters around it stand next to each other in no piece of the
vocabulary, and every merge makes a vocabulary piece, so no merge of the whole text can span it.  Where an overlap holds
no such boundary, it is doubled, and in the end the chunk itself grows, so the count is that of the whole text always.
"""

from __future__ import annotations

import bisect
from itertools import accumulate

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from quayside.llm.common import arrow_map

# Texts of more characters are encoded in chunks of this size, neighbours overlapping by OVERLAP characters at first.
CHUNK, OVERLAP = 24_000, 256
META = "▁"  # the model's mark for a space


class ChunkedCounter:
    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, overlap
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        byte = [self.model.is_byte(i) for i in range(len(pieces))]
        # bytes of the text under each token (a space is one byte in the text)
        self.width = [1 if b else len(p.replace(META, " ").encode()) for p, b in zip(pieces, byte)]
        self.adjacent = {p[i:i + 2].replace(META, " ") for p, b in zip(pieces, byte) if not b for i in range(len(p) - 1)}
        self.widenings = 0

    def count(self, text: str) -> int:
        if len(text) <= self.chunk:
            return len(self.model.encode(text))
        return self._count_long(text.replace(META, " "))

    def _ends(self, span: str) -> list[int]:
        """Byte offset in ``span`` of the end of each token.  The model puts a space of its own before a text, which
        lies before offset 0."""
        width = self.width
        return [end - 1 for end in accumulate(width[i] for i in self.model.encode(span))]

    def _stable(self, text: str, left: int, right: int) -> int | None:
        """The proven stable position nearest to the middle of ``(left, right)``."""
        middle = (left + right) // 2
        for step in range(right - left):
            for at in (middle + step, middle - step):
                if left < at < right and text[at - 1:at + 1] not in self.adjacent:
                    return at
        return None

    def _from(self, text: str, begin: int, start: int, end: int) -> list[int] | None:
        """Token ends of ``text[begin:end]`` after the boundary ``start``, relative to it; None where no token ends there.
        Before ``start`` the encoding may differ from the whole text's, for the chunk begins anywhere."""
        ends = self._ends(text[begin:end])
        if start == 0:
            return ends
        cut = len(text[begin:start].encode())
        at = bisect.bisect_left(ends, cut)
        if at == len(ends) or ends[at] != cut:
            return None
        return [x - cut for x in ends[at + 1:]]

    def _count_long(self, text: str) -> int:
        total, begin, start, end = 0, 0, 0, self.chunk
        ends = self._ends(text[:end])
        while end < len(text):
            # ``ends`` are of the tokens after ``start``: the beginning, or a stable boundary inside the chunk begin..end
            overlap, following = self.overlap, None
            while following is None and overlap < end - start:
                splice = self._stable(text, end - overlap, end)
                if splice is not None:
                    # the next chunk begins before the splice and must show a token end there, as this one does
                    until = min(len(text), end + max(self.chunk - overlap, self.chunk // 2))
                    here = len(text[start:splice].encode())
                    at = bisect.bisect_left(ends, here)
                    if at < len(ends) and ends[at] == here:
                        following = self._from(text, end - overlap, splice, until)
                if following is None:
                    self.widenings += 1
                    overlap *= 2
            if following is None:  # no shared stable boundary in the whole chunk: it grows
                self.widenings += 1
                end = min(len(text), 2 * end - begin)  # doubles, so a text without boundaries costs twice its encoding
                ends = self._from(text, begin, start, end)
            else:
                total += at + 1
                begin, start, end, ends = end - overlap, splice, until, following
        return total + len(ends)


_LOADED: dict[str, ChunkedCounter] = {}


def loaded(path: str) -> ChunkedCounter:
    if path not in _LOADED:
        _LOADED[path] = ChunkedCounter(path)
    return _LOADED[path]


def count_tokens(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row of ``docs (doc_id, text)``; ``n_bytes`` in UTF-8.

    A null text is empty (0, 0, false); null ids and repeated rows stay, one row out per row in; other columns are
    ignored; an empty table gives an empty result."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = loaded(model)
        texts = batch.column(1).to_pylist()
        n_tokens = [counter.count(t or "") for t in texts]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len((t or "").encode()) for t in texts], pa.int64()),
             pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return arrow_map(docs.select(docs["doc_id"].cast("long"), docs["text"]), fn,
                     "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
