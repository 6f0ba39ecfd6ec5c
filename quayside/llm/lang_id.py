"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of lower-cased training text.  A text is compressed with every
dictionary, block by block so that the dictionary counts throughout; the language with the smallest total wins.  The
score is the relative margin to the runner-up; a narrow margin is a rejection.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, Window

from quayside.llm.common import arrow_map, prepare, stored

# Bounds of the sample a classifier learns from: snippets per language and of all languages, characters per snippet.  Every
# language is learned: with more than MODEL_SNIPPETS / SNIPPETS (64) of them, each has fewer snippets, one at least.
SNIPPETS, MODEL_SNIPPETS, SNIPPET_CHARS = 512, 64 * 512, 400
LEVEL, BLOCK = 6, 1 << 15
MIN_MARGIN = 0.003
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2 (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame) -> dict[str, bytes]:
    """Dictionary content for every language of the training rows ``(doc_id, text, lang)``: null texts and languages are
    passed over.  The sample is bounded (see the constants above), chosen by hash, and gathered on the driver."""
    rows = docs.where("text is not null and lang is not null and length(text) > 0").select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    counts = stored(rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(F.pmod("h", F.lit(1 << 30))).alias("least")))
    languages = counts.count()
    if not languages:
        return {}
    snippets_each = max(1, min(SNIPPETS, MODEL_SNIPPETS // languages))
    # about four times the snippets wanted pass the hash filter, whatever the number of rows, and of each language one at least
    share = F.least(F.lit(1.0), F.lit(float(4 * snippets_each)) / F.col("n"))
    hashed = F.pmod("h", F.lit(1 << 30))
    passed = rows.join(counts, "lang").where((hashed < share * (1 << 30)) | (hashed == F.col("least")))
    start = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - SNIPPET_CHARS, F.lit(0)) + 1) + 1
    snippets = passed.select("lang", "h", F.substring("text", start.cast("int"), F.lit(SNIPPET_CHARS)).alias("s"))
    first = Window.partitionBy("lang").orderBy("h", "s")
    chosen = snippets.withColumn("k", F.row_number().over(first)).where(F.col("k") <= snippets_each).collect()
    found: dict[str, list] = {}
    for r in sorted(chosen, key=lambda r: (r["lang"], r["k"])):
        found.setdefault(r["lang"], []).append(r["s"])
    return {lang: "\n".join(parts).lower().encode() for lang, parts in found.items()}


@functools.lru_cache(maxsize=4)
def _compressors(model: tuple[tuple[str, bytes], ...]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    for lang, content in model:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False,
                                                   write_dict_id=False)))
    return out


def classify(text: str | None, model: tuple[tuple[str, bytes], ...]) -> tuple[str, float]:
    """Language and relative margin; the first by name among equals."""
    if text is None or not model or not _LETTER.search(text):
        return UNKNOWN, 0.0
    data = text.lower().encode()
    sizes = sorted((sum(len(c.compress(data[at:at + BLOCK])) for at in range(0, len(data), BLOCK)), lang)
                   for lang, c in _compressors(model))
    if len(sizes) == 1:
        return sizes[0][1], 1.0
    return sizes[0][1], 1.0 - sizes[0][0] / sizes[1][0]


def identify(docs: DataFrame, model: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """``(doc_id, lang_pred, score, accepted)`` per row of ``docs (doc_id, text)``.

    A text that is null or has no letter is ``und`` with score 0, and rejected; so is every text where nothing was learned.
    Other texts have a learned language; ``accepted`` is false where the margin is under ``min_margin``.  Null ids and
    repeated rows stay; other columns are ignored; an empty table gives an empty result."""
    learned = tuple(sorted(model.items()))

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [classify(t.as_py(), learned) for t in batch.column(1)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([x[0] for x in found]), pa.array([x[1] for x in found]),
             pa.array([x[0] != UNKNOWN and x[1] >= min_margin for x in found])],
            names=["doc_id", "lang_pred", "score", "accepted"])

    return arrow_map(docs.select(docs["doc_id"].cast("long"), docs["text"]), fn,
                     "doc_id long, lang_pred string, score double, accepted boolean")


def predictions(docs: DataFrame, min_margin: float = MIN_MARGIN) -> DataFrame:
    """``identify`` for all ``docs (doc_id, text, lang)`` with what their rows that are not held out teach, and
    ``held_out``."""
    model = learn(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    return identify(docs, model, min_margin).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


def keep_identified(docs: DataFrame, min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with their columns as they are."""
    model = tuple(sorted(learn(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())).items()))
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            kept = [c[0] != UNKNOWN and c[1] >= min_margin for c in (classify(t.as_py(), model) for t in batch.column(at))]
            yield batch.filter(pa.array(kept, pa.bool_()))

    prepare(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
