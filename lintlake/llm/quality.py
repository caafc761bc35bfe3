"""Quality rules with risk-controlled thresholds.

Each rule measures how bad a text is as a share; a reference cutoff per rule puts the shares on one scale. A document's
badness is the largest share over its reference cutoff, and one multiplier per stratum (language) turns the reference
cutoffs into the cutoffs that apply.

The multiplier is learned from the labelled documents of good quality of the stratum. Multipliers are tried from the most
lenient to the strictest. One is accepted if the exact binomial test rejects "more than ``MAX_FALSE_REJECTION`` of the good
documents are rejected": P(Bin(n, MAX_FALSE_REJECTION) <= rejected) <= ``ERROR`` / strata. The walk ends at the first one
that is not accepted, so within a stratum no further correction is needed; between strata Bonferroni's is applied. Of the
accepted ones the best at telling good from bad labelled documents applies. A stratum with too few labels to prove
anything rejects nothing beyond the base rules.

All of it is DataFrame expressions. A text is read once and stays in its row; only counts per (stratum, multiplier)
are shuffled.

Defined results: a null text has no words and fails the base rules, as do empty texts; a null language is a stratum of
its own; a document with several label rows counts as good only if all of them say 1; null labels are ignored; without
labels only the base rules apply; columns of the input beyond doc_id, text and lang are ignored, unless they are carried
(``carry``): then they come back as column ``carried``, one struct, so that no name of theirs can clash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lintlake.functions.scale import stage
from lintlake.llm.tables import stage_compressed

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
MAX_FALSE_REJECTION = 0.02
ERROR = 0.05
#: Shares at which a rule would reject on the reference scale.
REFERENCE = {"symbols": 0.2, "capitals": 0.3, "dup_lines": 0.5, "repeats": 0.3}
#: Multipliers of the reference cutoffs, from lenient to strict.
MULTIPLIERS = [round(4 * 2 ** (-i / 4), 6) for i in range(25)]
UNKNOWN = "\x00none"


def _bound(value: Column, body) -> Column:
    """body(value) with value computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _repeated_words(words: Column) -> Column:
    """Words inside windows of eight that occur twice or more, each word counted once."""
    last = F.size(words) - WINDOW  # where the last window starts

    def covered(hashes: Column) -> Column:
        tagged = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(pairs: Column) -> Column:
            twice = F.filter(
                F.transform(
                    pairs,
                    lambda p, k: F.when(
                        (p["h"] == F.get(pairs, k + 1)["h"]) | (p["h"] == F.get(pairs, k - 1)["h"]), p["i"]
                    ),
                ),
                lambda i: i.isNotNull(),
            )
            return F.sort_array(twice)

        def length(at: Column) -> Column:
            steps = F.transform(at, lambda p, k: F.coalesce(F.least(F.lit(WINDOW), F.get(at, k + 1) - p), F.lit(WINDOW)))
            return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

        return _bound(_bound(tagged, starts), length)

    hashes = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    )
    repeated = _bound(
        hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))
    )
    return F.when(last < 0, F.lit(0)).otherwise(repeated)


def measures(documents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals.

    With ``carry`` also ``carried``: a struct of these columns, untouched.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    all_of_text = _bound(
        F.struct(text.alias("t"), _words(text).alias("w"), F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines")),
        lambda x: F.struct(
            F.size(x["w"]).cast("long").alias("n_words"),
            F.length(F.array_join(x["w"], "")).cast("long").alias("word_chars"),
            F.regexp_count(x["t"], F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
            (F.size(x["lines"]) - F.size(F.array_distinct(x["lines"]))).cast("long").alias("n_dup_lines"),
            _repeated_words(x["w"]).cast("long").alias("n_repeat_words"),
            F.size(x["lines"]).cast("long").alias("n_lines"),
            F.regexp_count(x["t"], F.lit(r"\p{Lu}{2,}")).cast("long").alias("n_capitals"),
        ),
    )
    carried = [F.struct(*carry).alias("carried")] if carry else []
    measured = documents.select("doc_id", F.col("lang").cast("string").alias("lang"), all_of_text.alias("m"), *carried)
    return measured.select("doc_id", "lang", "m.*", *(["carried"] if carry else []))


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


def _level() -> Column:
    """How many multipliers the document's badness exceeds when tried from the strictest on: 0 for a clean text."""
    badness = F.greatest(
        _share("n_symbols", "n_words") / REFERENCE["symbols"],
        _share("n_capitals", "n_words") / REFERENCE["capitals"],
        _share("n_dup_lines", "n_lines") / REFERENCE["dup_lines"],
        _share("n_repeat_words", "n_words") / REFERENCE["repeats"],
    )
    over = [F.when(badness > F.lit(m), 1).otherwise(0) for m in MULTIPLIERS]
    return sum(over[1:], over[0])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def _log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function for x >= 1: Stirling's series at x + 8."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    product = x
    for i in range(1, 8):
        product = product * (x + i)
    return series - F.log(product)


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(Bin(n, rate) <= k), exact up to rounding; 1 where k is not below the mean."""
    n, k = n.cast("double"), k.cast("double")
    top = F.exp(
        _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1)
        + k * math.log(rate) + (n - k) * math.log1p(-rate)
    )
    # Below the mean the terms fall from k on; after this many they are below any double's last digit.
    terms = F.least(k, F.ceil(40 * F.sqrt(n * rate)) + 100).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(state: Column, j: Column) -> Column:
        i = k - j + 1
        term = state["term"] * i * (1 - rate) / ((n - i + 1) * rate)
        return F.struct(term.alias("term"), (state["sum"] + term).alias("sum"))

    total = F.aggregate(F.sequence(F.lit(1), terms), start, step)["sum"]
    total = F.when(terms < 1, F.lit(1.0)).otherwise(total)
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(top * total)


def thresholds(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """Per stratum: its labelled documents and ``chosen``, the number of the multiplier that applies (null: none).

    Of the multipliers proven safe, the one that best separates the labelled documents: the largest share of bad ones
    rejected less the share of good ones rejected, the more lenient of equal ones. The proof holds for all of them at
    once, so the choice costs nothing. One row per language.
    """
    # min: one label row that says 0 is enough for a document not to count as good.
    labelled = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    count = lambda value: F.sum(F.when(F.col("quality") == value, 1).otherwise(0)).cast("long")
    strata = (
        measured.filter(~base_failed())
        .select("doc_id", F.coalesce("lang", F.lit(UNKNOWN)).alias("stratum"), _level().alias("level"))
        .join(labelled, "doc_id")
        .groupBy("stratum", "level")
        .agg(count(1).alias("good"), count(0).alias("bad"))
        .groupBy("stratum")
        .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.collect_list(F.struct("level", "good", "bad")).alias("counts"))
        .withColumn("strata", F.count("*").over(Window.partitionBy()))
    )
    # Multiplier j, counted from the lenient end, rejects the levels that exceed it: those of at least len - j.
    rejected = lambda kind: F.aggregate(
        "counts", F.lit(0).cast("long"),
        lambda total, c: total + F.when(c["level"] >= F.lit(len(MULTIPLIERS)) - F.col("j"), c[kind]).otherwise(0),
    )
    tried = strata.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(len(MULTIPLIERS) - 1)))).withColumns(
        {"good_rejected": rejected("good"), "bad_rejected": rejected("bad")}
    )
    unsafe = binomial_tail(F.col("good"), F.col("good_rejected"), MAX_FALSE_REJECTION) > F.lit(ERROR) / F.col("strata")
    walked = Window.partitionBy("stratum").orderBy("j").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gain = F.coalesce(F.try_divide("bad_rejected", "bad"), F.lit(0.0)) - F.try_divide("good_rejected", "good")
    proven = tried.withColumn("safe", F.max(unsafe.cast("int")).over(walked) == 0)
    return proven.groupBy("stratum").agg(
        F.first("good").alias("labelled_good"), F.first("bad").alias("labelled_bad"),
        F.max_by("j", F.when(F.col("safe"), F.struct(gain.alias("gain"), -F.col("j")))).alias("chosen"),
    )


def judge(documents: DataFrame, labels: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The measures of every document, base_failed, and kept by the proven cutoffs of its language.

    Every row is judged by itself, whatever its id. What is to be kept or dropped with it travels in ``carried``: that
    costs one staged copy and spares a join by id, which null or shared ids would not survive.
    """
    if carry:
        measured = stage_compressed(measures(documents, carry), "quality-measures")
    else:
        measured = stage(measures(documents), "quality-measures")
    proven = thresholds(measured, labels).select("stratum", "chosen")
    rejects = F.col("level") >= F.lit(len(MULTIPLIERS)) - F.col("chosen")
    return (
        measured.withColumn("level", _level())
        .withColumn("stratum", F.coalesce("lang", F.lit(UNKNOWN)))
        .join(proven, "stratum", "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(rejects, F.lit(False)))
    )
