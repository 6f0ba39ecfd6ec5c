"""Mixing sources to target weights, in DataFrame functions only.

Sources, in code-point order, have the weights in turn and share the words of all sources by them; a target ends at
``EPOCHS`` times its source's words, and what is over is shared anew by weight.  That settles where all sources under
their end stand at one level per weight: in the order of words per weight, a source is at its end when the level that the rest would have
without it is over its own.  The documents of a source lie in the order of a hash of their id and size; running sums
of words over that order, computed in ranges, place every document, and the source's budget cuts them exactly: whole epochs of all its
documents, then its first words once more, the document at the cut in part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from quayside.llm.common import stored
from quayside.llm.ordered import running_sums

WEIGHTS = (1, 2, 3)
EPOCHS = 3
COPIES = 1024  # rows equal in id, source and size that share a place in the order
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"


def sizes(documents: DataFrame) -> DataFrame:
    """``(doc_id, source, size)`` per row; size is the number of words (null text: 0)."""
    trimmed = F.btrim(F.coalesce("text", F.lit("")), F.lit(SPACE_CHARS))
    words = F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACES)))
    return documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), words.cast("long").alias("size"))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``(source, source_size, start, target)`` of ``sources (source, source_size)``, one row each (null is a source, the
    last); ``start`` is the number of words of all sources before."""
    ranked = running_sums(sources, [F.col("source").asc_nulls_last()], {"rank": F.lit(1), "start": F.col("source_size")})
    weight = F.get(F.array(*[F.lit(int(w)) for w in weights]), F.pmod("rank", F.lit(len(weights))).cast("int"))
    weighed = stored(ranked.withColumn("weight", weight.cast("long")).withColumn("end", epochs * F.col("source_size")))
    exact = "decimal(19,0)"
    both = weighed.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()  # one row
    words, weight = both.words or 0, both.weight or 0
    filled = stored(running_sums(weighed, [F.col("end") / F.col("weight"), F.col("source").asc_nulls_last()],
                                 {"ends": F.col("end"), "weights": F.col("weight")}).withColumn(
        "full", (F.lit(words) - F.col("ends")).cast(exact) * F.col("weight").cast(exact)
        > F.col("end").cast(exact) * (F.lit(weight) - F.col("weights")).cast(exact)))
    rest = filled.where("not full").agg(F.sum("weight").alias("weight")).first().weight
    taken = filled.where("full").agg(F.sum("end").alias("words")).first().words or 0
    level = (F.col("weight") * F.lit(words - taken)).cast("double") / F.lit(float(rest or 1))
    return filled.select("source", "source_size", "start", F.when(F.col("full"), F.col("end").cast("double")).otherwise(level).alias("target"))


def mix(documents: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` per row of ``documents (doc_id, source, text)``.

    ``size`` counts the words of the whole text (null or empty: 0, and nothing is taken), ``target`` is the word budget of the
    row's source, ``taken`` the words of the row in the mix, at most ``epochs`` times its size; per source they add up to
    the target rounded to a whole number.  A null source is a source, the last; null ids and repeated rows are rows like
    any other (equal rows differ only in which of them takes more).  A corpus without words has targets of zero.  Reruns agree, however
    the input is split.  Other columns are ignored; an empty table gives an empty result."""
    rows = sizes(documents).groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    # equal rows become one, a large number of them several with places of their own
    dealt = rows.withColumn("part", F.explode(F.expr(f"sequence(0L, (n - 1) div {COPIES})"))) \
        .withColumn("n", F.least(F.col("n") - F.col("part") * COPIES, F.lit(COPIES)))
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"), F.col("part").cast("string")))
    placed = stored(dealt.withColumn("key", key))
    of = targets(placed.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, epochs)
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("doc_id"), F.col("size"), F.col("part")]
    at = running_sums(placed, order, {"at": F.col("size") * F.col("n")})
    s = of.withColumnRenamed("source", "__source")
    joined = at.join(s, F.col("source").eqNullSafe(F.col("__source")))
    budget = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0).cast("long"))
    one = joined.withColumn("budget", budget).withColumn("whole", whole) \
        .withColumn("copy", F.explode(F.expr("sequence(0L, n - 1)")))
    left = F.col("budget") - F.col("whole") * F.col("source_size") - (F.col("at") - F.col("start") + F.col("copy") * F.col("size"))
    taken = F.col("whole") * F.col("size") + F.least(F.greatest(left, F.lit(0)), "size")
    return one.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))
