"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Each rule rejects documents whose metric is over a cutoff; a stratum (a language) has one cutoff per rule or none, a
joint cutoff.  On the labelled documents of a stratum, the false rejections of good documents by the rules together are
binomial; a joint cutoff is certified where the exact binomial test rejects a false-rejection rate of ``RISK`` or more.
Half of a stratum's error is spent on a path fixed beforehand, from the most lenient joint cutoff to the strictest: along it
rejections only grow, so the test of its first joint cutoff over ``RISK`` is the only one that can go wrong.  The other half
covers every joint cutoff: whenever one over ``RISK`` passes, so does a most lenient one of those over ``RISK``; none of
these is stricter than another, so there are at most ``WIDTH`` of them (the largest rank of a product of chains), and
the half is divided by that.  The error is divided by the strata that have good labels enough to certify anything.
Hence, with probability ``1 - ERROR``, no stratum loses more than ``RISK`` of its good documents to the rules together.  Of the
certified joint cutoffs the one that best separates the labels is used (a false rejection weighs as much as ``COST`` right
ones), the most lenient of equals; without one the rules reject nothing there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from quayside.llm.common import durable, stored

RISK = 0.05        # of a stratum's good documents, all rules together
ERROR = 0.05       # probability that any certificate is wrong
COST = 10          # right rejections, as a share of bad documents, that outweigh a false one, as a share of good ones
OTHER = "(other)"  # the stratum of languages that are pooled on request
# Metric -> cutoffs, ascending.  A document is rejected where its metric is over the chosen cutoff.
CUTOFFS = {
    "symbol_ratio": [0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0, 2.0],
    "bang_ratio": [0.05, 0.1, 0.2, 0.3, 0.5, 1.0, 1.5],
    "dup_line_ratio": [0.1, 0.2, 0.3, 0.4, 0.5, 0.7],
    "mean_word_chars": [8.0, 10.0, 12.0, 15.0, 20.0, 30.0],
}
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SPACES = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
# Level of a joint cutoff per rule: from 1, the strictest cutoff, to one more than there are cutoffs, none.
LEVELS = {r: len(c) + 1 for r, c in CUTOFFS.items()}


def _width() -> int:
    """Most joint cutoffs of which none is stricter than another: the largest number that share a sum of levels."""
    by_sum = {0: 1}
    for n in LEVELS.values():
        by_sum = {t: sum(by_sum.get(t - k, 0) for k in range(n)) for t in range(max(by_sum) + n)}
    return max(by_sum.values())


def _path() -> list[tuple[int, ...]]:
    """The fixed path: the rules are tightened in turn, a cutoff at a time."""
    at, path = dict(LEVELS), []
    while max(at.values()) > 1:
        for r in at:
            if at[r] > 1:
                at[r] -= 1
                path.append(tuple(at.values()))
    return path


WIDTH, PATH = _width(), _path()
POSITION_BITS = 31  # positions of words in a sort key: any index of an array


def _repeat_positions(words: str, packed: str) -> Column:
    """Sorted positions of the three-word windows found twice or more.

    ``packed`` holds, sorted, the upper hash bits of each window and its position; windows that share those bits with a
    neighbour are candidates, few as a rule, and are compared by their words."""
    candidates = f"""transform(filter({packed}, (x, k) ->
        shiftright(x, {POSITION_BITS}) = shiftright(get({packed}, k - 1), {POSITION_BITS})
        or shiftright(x, {POSITION_BITS}) = shiftright(get({packed}, k + 1), {POSITION_BITS})),
        x -> cast(x & {(1 << POSITION_BITS) - 1} as int))"""
    return F.expr(f"""sort_array(transform({candidates}, p -> struct(
        struct(get({words}, p) as a, get({words}, p + 1) as b, get({words}, p + 2) as c) as gram, p as at)))""")


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base features and rule metrics of ``text`` as a struct column ``__f``: n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed and the metrics of ``CUTOFFS``."""
    t = F.coalesce(F.col("__t"), F.lit(""))
    d = docs.withColumn("__t", F.col(text)).withColumn("__t", t)
    d = d.withColumn("__w", F.filter(F.split(F.btrim("__t", F.lit(" \t\n\x0b\f\r")), SPACES + "+"), lambda w: w != ""))
    d = d.withColumn("__n", F.size("__w"))
    d = d.withColumn("__p", F.expr(f"""case when __n >= 4 then sort_array(transform(sequence(0, __n - 3), i ->
        shiftleft(shiftright(xxhash64(get(__w, i), get(__w, i + 1), get(__w, i + 2)), {POSITION_BITS}), {POSITION_BITS}) | i))
        else cast(array() as array<bigint>) end"""))
    d = d.withColumn("__g", _repeat_positions("__w", "__p"))
    d = d.withColumn("__r", F.expr("""sort_array(transform(filter(__g, (x, k) ->
        coalesce(x.gram = get(__g, k - 1).gram, false) or coalesce(x.gram = get(__g, k + 1).gram, false)), x -> x.at))"""))
    repeat = F.expr("""aggregate(transform(__r, (p, k) -> coalesce(least(3, get(__r, k + 1) - p), 3)), 0L, (s, x) -> s + x)""")
    d = d.withColumn("__lines", F.filter(F.split("__t", "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\f\r")) != ""))
    length = F.length("__t")
    d = d.withColumn("__b", F.struct(
        F.col("__n").cast("long").alias("n_words"),
        F.length(F.translate("__t", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (length - F.length(F.translate("__t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        repeat.cast("long").alias("n_repeat_words"),
        (length - F.length(F.replace("__t", F.lit("!"), F.lit("")))).cast("long").alias("n_bangs"),
        F.size("__lines").cast("long").alias("n_lines")))
    b = F.col("__b")
    per_word = F.greatest(b["n_words"], F.lit(1))
    return d.withColumn("__f", F.struct(
        "__b.*",
        ((b["n_words"] < MIN_WORDS) | (100 * b["n_repeat_words"] > MAX_REPEAT_PERCENT * b["n_words"])).alias("base_failed"),
        (b["n_symbols"] / per_word).alias("symbol_ratio"), (b["n_bangs"] / per_word).alias("bang_ratio"),
        (b["n_dup_lines"] / F.greatest(b["n_lines"], F.lit(1))).alias("dup_line_ratio"),
        (b["word_chars"] / per_word).alias("mean_word_chars"))).drop("__t", "__w", "__n", "__p", "__g", "__r", "__lines", "__b")


def log_binomial_tail(k: Column, n: Column, risk: float) -> Column:
    """Logarithm of P(X <= k) for X binomial with ``n`` trials of probability ``risk``: the exact sum, term by term."""
    odds = F.log(F.lit(risk / (1 - risk)))
    first = n * F.log(F.lit(1 - risk))

    def step(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1) / i) + odds
        high, low = F.greatest(term, s["total"]), F.least(term, s["total"])
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    summed = F.aggregate(F.sequence(F.lit(1).cast("long"), k), F.struct(first.alias("term"), first.alias("total")), step)["total"]
    return F.when(k == 0, first).when(k > risk * n, F.lit(0.0)).otherwise(summed)


def most_false(n: Column, risk: float, log_error: Column) -> Column:
    """The largest k of which ``log_binomial_tail(k, n, risk)`` is at most ``log_error``; -1 where there is none."""
    odds = F.log(F.lit(risk / (1 - risk)))
    first = n * F.log(F.lit(1 - risk))

    def step(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1) / i) + odds
        high, low = F.greatest(term, s["total"]), F.least(term, s["total"])
        total = high + F.log1p(F.exp(low - high))
        return F.struct(term.alias("term"), total.alias("total"), F.when(total <= log_error, i).otherwise(s["k"]).alias("k"))

    start = F.struct(first.alias("term"), first.alias("total"), F.lit(0).cast("long").alias("k"))
    most = F.floor(n * risk)
    return F.when(first > log_error, F.lit(-1).cast("long")).when(most < 1, F.lit(0).cast("long")).otherwise(
        F.aggregate(F.sequence(F.lit(1).cast("long"), most), start, step)["k"])


def fit(labelled: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Certified cutoffs: ``(stratum, c_<rule>...)``, null where a rule rejects nothing; strata that reject nothing
    are left out.  ``labelled`` has ``stratum_key`` (null is a stratum too), ``good`` (boolean) and the metrics."""
    rows = labelled.withColumnRenamed("stratum_key", "stratum")
    rules = list(CUTOFFS)

    def over(rule: str) -> Column:  # of how many cutoffs the metric is over; rejected at levels up to that
        return reduce(lambda a, c: a + (F.col(rule) > c).cast("int"), CUTOFFS[rule], F.lit(0))

    # a document is kept at a joint cutoff where each level is above its own: it is counted at the least such level per rule
    counts = rows.select("stratum", "good", *[(over(r) + 1).alias(r) for r in rules]).groupBy("stratum", *rules).agg(
        F.count(F.when(F.col("good"), 1)).alias("good"), F.count(F.when(~F.col("good"), 1)).alias("bad"))
    counts = durable(counts)
    totals = counts.groupBy("stratum").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad")) \
        .where(F.col("n_good") * F.log(F.lit(1 - risk)) <= F.log(F.lit(error / 2)))
    strata = F.count("*").over(Window.partitionBy("one"))  # one row per stratum that can be certified
    totals = totals.withColumn("one", F.lit(1)).withColumn("each", F.log(F.lit(error / 2) / strata)) \
        .withColumn("on_path", most_false(F.col("n_good"), risk, F.col("each"))) \
        .withColumn("anywhere", most_false(F.col("n_good"), risk, F.col("each") - F.log(F.lit(float(WIDTH))))).where("on_path >= 0")
    cells = totals.select("stratum")
    for r in rules:
        cells = cells.withColumn(r, F.explode(F.sequence(F.lit(1), F.lit(LEVELS[r]))))
    found = counts.select(F.col("stratum").alias("s"), *[F.col(r).alias(f"at_{r}") for r in rules], "good", "bad")
    same = reduce(lambda a, r: a & (F.col(r) == F.col(f"at_{r}")), rules, F.col("stratum").eqNullSafe(F.col("s")))
    kept = cells.join(found, same, "left").select("stratum", *rules, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "bad")])
    for r in rules:  # running sums along each rule in turn: all documents kept at the joint cutoff
        along = Window.partitionBy("stratum", *[x for x in rules if x != r]).orderBy(r).rowsBetween(Window.unboundedPreceding, 0)
        kept = kept.withColumn("good", F.sum("good").over(along)).withColumn("bad", F.sum("bad").over(along))
    t = totals.withColumnRenamed("stratum", "s")
    steps = kept.join(t, F.col("stratum").eqNullSafe(F.col("s"))) \
        .withColumn("k_good", F.col("n_good") - F.col("good")).withColumn("k_bad", F.col("n_bad") - F.col("bad"))
    here = F.concat_ws(",", *[F.col(r).cast("string") for r in rules]).isin([",".join(map(str, p)) for p in PATH])
    certified = steps.where(F.col("k_good") <= F.when(here, F.col("on_path")).otherwise(F.col("anywhere")))
    gain = F.col("k_bad") / F.greatest("n_bad", F.lit(1)) - COST * F.col("k_good") / F.greatest("n_good", F.lit(1))
    lenience = reduce(lambda a, r: a + F.col(r), rules, F.lit(0))
    best = certified.withColumn("gain", gain).where("gain > 0").groupBy("stratum").agg(
        F.max(F.struct("gain", lenience.alias("lenience"), *rules)).alias("best"))
    return best.select("stratum", *[F.get(F.array(*map(F.lit, CUTOFFS[r])), F.col(f"best.{r}") - 1).alias(f"c_{r}") for r in rules])


def calibrate(documents: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``fit`` on the documents ``(doc_id, stratum_key, metrics)`` that ``labels (doc_id, quality)`` cover; a document
    with several labels is good where all say so; null labels are ignored."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        (F.min("quality") >= 1).alias("good"))
    return fit(documents.join(known, "doc_id").select("stratum_key", "good", *CUTOFFS), **settings)


def verdict(docs: DataFrame, cutoffs: DataFrame, stratum_key: Column, metrics: dict[str, Column], base_failed: Column,
            name: str) -> DataFrame:
    """``docs`` with the boolean ``name``: false where the base check failed or a rule of the stratum rejects."""
    c = cutoffs.select(F.col("stratum").alias("__s"), F.struct(*[f"c_{r}" for r in CUTOFFS]).alias("__c"))
    joined = docs.join(c, stratum_key.eqNullSafe(F.col("__s")), "left")
    rejected = reduce(lambda a, b: a | b, [F.coalesce(m > F.col(f"__c.c_{r}"), F.lit(False)) for r, m in metrics.items()])
    # one condition with both sides of the join in it: a filter on it stays above the join, where the features are computed
    # columns; pushed below, it would repeat their expressions inside itself
    passed = F.when(F.col("__c").isNull() & base_failed, F.lit(False)).when(base_failed | rejected, F.lit(False)).otherwise(F.lit(True))
    return joined.withColumn(name, passed).drop("__s", "__c")


def pooled(rows: DataFrame, labels: DataFrame, max_strata: int | None, doc_id: str, key: str) -> DataFrame:
    """``rows`` as they are, or, with ``max_strata``, with ``OTHER`` for the ``key`` of all but that many best labelled strata."""
    if max_strata is None:
        return rows
    known = labels.where("quality is not null").select(F.col("doc_id").alias(doc_id)).distinct()
    own = rows.where(F.col(key).isNotNull()).join(known, doc_id, "left_semi").groupBy(key).agg(F.count("*").alias("n")) \
        .orderBy(F.desc("n"), key).limit(max_strata).select(F.col(key).alias("__own"))
    return rows.join(durable(own), F.col(key) == F.col("__own"), "left").withColumn(key, F.coalesce("__own", F.lit(OTHER))).drop("__own")


def quality(documents: DataFrame, labels: DataFrame, max_strata: int | None = None, **settings) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)`` and the metrics, per
    row of ``documents (doc_id, text, lang)``.

    A null text has no words (and fails the base check).  Every language is a stratum, also the null one (with
    ``max_strata``, all but so many best labelled share one); where no joint cutoff is certified, only the base check rejects.
    Null ids have no label; repeated rows are judged alike, each a row of its own.  Without labels only the base check
    rejects.  Other columns are ignored; an empty table gives an empty result."""
    base = features(documents.select(F.col("doc_id").cast("long"), "text", F.col("lang").alias("stratum_key")))
    rows = pooled(durable(base.select("doc_id", "stratum_key", "__f.*")), labels, max_strata, "doc_id", "stratum_key")
    cutoffs = stored(calibrate(rows, labels, **settings))
    judged = verdict(rows, cutoffs, F.col("stratum_key"), {r: F.col(r) for r in CUTOFFS}, F.col("base_failed"), "kept")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", *CUTOFFS)


def keep_good(documents: DataFrame, labels: DataFrame, max_strata: int | None = None, **settings) -> DataFrame:
    """The rows of ``documents`` that ``quality`` keeps, with their columns as they are."""
    whole = documents.select(F.struct("*").alias("__row"), F.col("doc_id").cast("long").alias("__id"),
                             F.col("text").alias("__text"), F.col("lang").alias("__lang"))
    # rows and features are written once: the calibration reads the features of the labelled ones, the verdict those of all
    judged = stored(features(pooled(whole, labels, max_strata, "__id", "__lang"), "__text").drop("__text"))
    sample = judged.select(F.col("__id").alias("doc_id"), F.col("__lang").alias("stratum_key"), "__f.*")
    cutoffs = stored(calibrate(sample, labels, **settings))
    kept = verdict(judged, cutoffs, F.col("__lang"), {r: F.col(f"__f.{r}") for r in CUTOFFS}, F.col("__f.base_failed"), "__kept")
    return kept.where("__kept").select("__row.*")
