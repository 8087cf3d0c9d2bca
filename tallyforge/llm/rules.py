"""Quality rules with risk-controlled thresholds.

Every document gets counts of words, symbols, repeated lines and repeated five-word windows. A fixed base rule rejects very
short and very repetitive texts. The other rules compare a ratio with a cutoff; the cutoffs of all rules form one sequence of
``STEPS`` settings from lenient to strict, each rejecting what the one before does. On labelled documents the settings are tried in this order, per
stratum, and the last one is taken for which the exact binomial test still shows, at ``error`` / number of strata, that all rules
together reject at most a share ``risk`` of the good documents that pass the base rule. A fixed order needs no further
correction, as the first setting that fails ends it; the split over strata is Bonferroni's, so with probability 1 - ``error`` no
stratum loses more than ``risk``.

Strata are the languages of ``STRATA`` and all others. Those with fewer good labels than the test needs to pass at all
(75 with the defaults) are pooled into one, which the bound then holds for as a whole; if that is too small as well, only the base rule acts.

DataFrame operations only. Null texts have no words and fail the base rule; texts of any length are counted whole; repeated
rows are counted and judged each by itself; labels that repeat a document count once, with the lowest mark; without labels
only the base rule acts; other columns are kept whatever their names; without documents there are no rows.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import _base as B

#: Values above the cutoff are rejected. Setting i holds the i-th cutoff of each rule; no list rises.
RULES = {
    "symbols_per_word": [4.0, 3.0, 2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1],
    "dup_line_share": [0.9, 0.8, 0.7, 0.65, 0.6, 0.55, 0.5, 0.48, 0.45, 0.42, 0.4, 0.38, 0.36, 0.34],
    "repeat_word_share": [0.2, 0.2, 0.2, 0.2, 0.2, 0.2, 0.2, 0.2, 0.19, 0.19, 0.18, 0.18, 0.17, 0.16],
    "capital_share": [0.95, 0.9, 0.8, 0.7, 0.6, 0.55, 0.5, 0.48, 0.45, 0.42, 0.4, 0.38, 0.35, 0.3],
    "exclamations_per_word": [2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.18, 0.15, 0.1],
    "mean_word_chars": [60.0, 40.0, 30.0, 25.0, 22.0, 20.0, 18.0, 17.0, 16.0, 15.0, 14.5, 14.0, 13.0, 12.0],
}
STEPS = 14
#: Labelled documents up to which their ids are broadcast: 2,000,000 longs, some 32 MB.
BROADCAST_LABELS = 2_000_000
STRATA = ("en", "fr", "de", "es")
POOL = "other"
RISK = 0.06
ERROR = 0.05
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(ws: Column) -> Column:
    """Words in five-word windows found twice or more; ``ws`` is a variable of ``let``."""
    covered = lambda starts: F.aggregate(
        F.transform(starts, lambda x, k: F.least(F.lit(5), F.coalesce(F.get(starts, k + 1) - x, F.lit(5))).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x
    )
    twins = lambda s: F.filter(s, lambda e, i: F.coalesce(F.get(s, i - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False)))
    among = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
        B.let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), lambda s: B.let(F.sort_array(F.transform(twins(s), lambda e: e["i"])), covered))
    )
    return B.let(B.window_hashes(ws, 5), among)


def counted(docs: DataFrame, *more: str) -> DataFrame:
    """The columns ``more`` of docs and one row of counts and ratios a document, named ``q_*``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    left_out = lambda pattern: (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")
    lines = B.let(
        F.filter(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(B.TRIMMED))) > 0),
        lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")),
    )
    by_words = B.let(B.words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeat")))
    made = docs.select(
        *more,
        by_words.alias("q_w"),
        lines.alias("q_l"),
        F.length(F.regexp_replace(text, B.SPACE + "+", "")).cast("long").alias("q_word_chars"),
        left_out(r"[#*$%&|<>]+").alias("q_n_symbols"),
        left_out(r"\p{Lu}+").alias("q_capitals"),
        left_out("!+").alias("q_exclamations"),
    )
    share = lambda a, b: a / F.greatest(b, F.lit(1)).cast("double")
    n = F.col("q_w.n")
    made = made.select(
        *more,
        n.alias("q_n_words"),
        "q_word_chars",
        "q_n_symbols",
        F.col("q_l.dup").alias("q_n_dup_lines"),
        F.col("q_w.repeat").alias("q_n_repeat_words"),
        share(F.col("q_n_symbols"), n).alias("q_symbols_per_word"),
        share(F.col("q_l.dup"), F.col("q_l.n")).alias("q_dup_line_share"),
        share(F.col("q_w.repeat"), n).alias("q_repeat_word_share"),
        share(F.col("q_capitals"), F.col("q_word_chars")).alias("q_capital_share"),
        share(F.col("q_exclamations"), n).alias("q_exclamations_per_word"),
        share(F.col("q_word_chars"), n).alias("q_mean_word_chars"),
    )
    return made.withColumn("q_base_failed", (F.col("q_n_words") < 10) | (100 * F.col("q_n_repeat_words") > 20 * F.col("q_n_words"))).withColumn("q_step", step())


def step() -> Column:
    """The first setting that rejects a document, STEPS if none does."""
    return F.least(*[functools.reduce(lambda c, e: c.when(F.col(f"q_{rule}") > e[1], e[0]), enumerate(cuts), F).otherwise(STEPS) for rule, cuts in RULES.items()])


def stratum(lang: Column) -> Column:
    return F.when(lang.cast("string").isin(*STRATA), lang.cast("string")).otherwise(POOL)


def log_binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """ln P(X <= k) of X ~ Bin(n, p), summed exactly in log space."""
    odds = F.lit(p / (1 - p))
    first = n * F.log(F.lit(1 - p))
    added = lambda a, t: F.greatest(a, t) + F.log1p(F.exp(-F.abs(a - t)))
    step = lambda acc, i: B.let(
        acc["term"] + F.log((n - i + F.lit(1)) / i * odds), lambda t: F.struct(t.alias("term"), added(acc["total"], t).alias("total"))
    )
    start = F.struct(first.alias("term"), first.alias("total"))
    summed = F.aggregate(F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")), start, step, lambda acc: acc["total"])
    return summed


def good_labels(labels: DataFrame) -> DataFrame:
    """q_doc of the documents that are labelled good."""
    marks = labels.select(F.col("doc_id").cast("long").alias("q_doc"), F.col("quality").cast("int").alias("q_mark")).where("q_doc is not null and q_mark is not null")
    return marks.groupBy("q_doc").agg(F.min("q_mark").alias("q_mark")).where("q_mark = 1").select("q_doc")


def fewest(risk: float, error: float) -> int:
    """Good labels that the test needs to pass when none of them is rejected."""
    return math.ceil(math.log(error / (len(STRATA) + 1)) / math.log(1 - risk))


def thresholds(features: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """q_stratum, a row for each, and q_cut, the last safe setting (null: none is)."""
    good = features.where(~F.col("q_base_failed")).join(good_labels(labels), F.col("doc_id") == F.col("q_doc"), "left_semi")
    hits = [F.sum((F.col("q_step") <= i).cast("long")).alias(f"k{i}") for i in range(STEPS)]
    told = good.groupBy(stratum(F.col("lang")).alias("q_of")).agg(F.count(F.lit(1)).alias("q_n"), *hits)
    every = labels.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in (*STRATA, POOL)])).alias("q_stratum"))
    own = every.join(told, F.col("q_of") == F.col("q_stratum"), "left").withColumn("q_pool", F.when(F.col("q_n") >= fewest(risk, error), F.col("q_stratum")).otherwise(POOL))
    pools = own.groupBy(F.col("q_pool").alias("q_of_pool")).agg(F.coalesce(F.sum("q_n"), F.lit(0)).alias("n"), *[F.coalesce(F.sum(f"k{i}"), F.lit(0)).alias(f"k{i}") for i in range(STEPS)])
    n, level = F.col("n"), math.log(error / (len(STRATA) + 1))
    safe = lambda i: (F.col(f"k{i}") <= n * F.lit(risk)) & (log_binomial_cdf(F.col(f"k{i}"), n, risk) <= F.lit(level))
    # False rejections only grow along the settings, so the safe ones come first.
    cut = F.array_max(F.array(*[F.when(safe(i), i) for i in range(STEPS)]))
    cuts = pools.select("q_of_pool", cut.alias("q_cut"))
    return own.select("q_stratum", "q_pool").join(cuts, F.col("q_pool") == F.col("q_of_pool")).select("q_stratum", "q_cut")


def judged(features: DataFrame, cuts: DataFrame) -> DataFrame:
    """features with ``q_kept``. cuts has a row for each of the strata, so it can be broadcast."""
    rejected = F.col("q_base_failed") | F.coalesce(F.col("q_step") <= F.col("q_cut"), F.lit(False))
    return features.withColumn("q_in", stratum(F.col("lang"))).join(F.broadcast(cuts), F.col("q_in") == F.col("q_stratum"), "left").withColumn("q_kept", ~rejected)


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept, a row for each document."""
    features = B.written(counted(docs.select("doc_id", "lang", "text"), "doc_id", "lang"), "features")
    done = judged(features, thresholds(features, labels))
    return done.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(f"q_{c}").alias(c) for c in COUNTS], F.col("q_base_failed").alias("base_failed"), F.col("q_kept").alias("kept"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns.

    Only documents that are labelled good are counted twice, for the thresholds and to be judged; no text is written or, while
    the labels are few enough to be broadcast, shuffled."""
    known = B.written(good_labels(labels), "good_labels")
    known = F.broadcast(known) if known.count() <= BROADCAST_LABELS else known
    held = docs.select("doc_id", "lang", "text").join(known, F.col("doc_id").cast("long") == F.col("q_doc"), "left_semi")
    cuts = B.written(thresholds(counted(held, "doc_id", "lang"), labels), "cutoffs")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("q_row"), "lang", "text")
    return judged(counted(row, "q_row", "lang"), cuts).where("q_kept").select("q_row.*")
