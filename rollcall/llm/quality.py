"""Quality rules whose cutoffs are certified on labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import broadcast_if_small, free_name, staged, text_or_empty, words

# What counts as a symbol, and the two base rules.
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

#: Whole per-mille statistics a rule can reject on when they are over its cutoff, in the order in
#: which rules are tried: the most trusted first.
STATISTICS = {
    "symbol_rate": ("n_symbols", "word_chars"),
    "shout_rate": ("n_shouts", "n_words"),
    "repeat_rate": ("n_repeat_words", "n_words"),
    "dup_line_rate": ("n_dup_lines", "n_lines"),
}
#: Cutoffs tried for each statistic, per mille, from loose to strict.
CUTOFFS = tuple(range(980, -1, -20))
STEPS = len(STATISTICS) * len(CUTOFFS)
FALSE_REJECTION = 0.02
RISK = 0.05


def _windows(parts: Column) -> Column:
    """Hashes of all three-word windows, by place."""
    hashes = F.transform(parts, lambda w, i: F.xxhash64(w, F.get(parts, i + 1), F.get(parts, i + 2)))
    return F.slice(hashes, 1, F.greatest(F.size(parts) - 2, F.lit(0)))


def document_features(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_shouts.

    Words are runs of characters other than white space; null and empty texts have none.
    n_dup_lines counts lines that hold a word and equal an earlier line; n_lines counts all that
    hold a word.  n_shouts counts words that end in two exclamation marks.  Three-word windows
    are compared by a 64-bit hash.  A text of any length is handled within its row.
    """
    text = text_or_empty()
    own_text, own_words, own_windows, own_lines = (free_name(docs, n) for n in ("_text", "_words", "_windows", "_lines"))
    base = docs.withColumn(own_text, text).withColumn(own_words, words(F.col(own_text)))
    parts = F.col(own_words)
    base = base.withColumn(own_windows, _windows(parts))
    lines = F.filter(F.split(own_text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    base = base.withColumn(own_lines, lines)
    placed = F.sort_array(F.transform(own_windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # A window equal to a neighbour in hash order is repeated.  Over the sorted places of these,
    # each adds the words it covers up to the next: three at most.
    # The sorted windows are kept as a variable of a one-element transform so they are made once.
    repeated = F.flatten(
        F.transform(
            F.array(placed),
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        s,
                        lambda w, k: (F.get(s, k - 1)["h"] == w["h"]) | (F.get(s, k + 1)["h"] == w["h"]),
                    ),
                    lambda w: w["i"],
                )
            ),
        )
    )
    covered = F.aggregate(
        repeated,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")
        ),
        lambda acc: acc["n"],
    )
    base = base.withColumns(
        {
            "n_words": F.size(own_words).cast("bigint"),
            "word_chars": F.length(F.regexp_replace(own_text, r"[\x20\x09-\x0D]", "")).cast("bigint"),
            "n_symbols": F.regexp_count(own_text, F.lit(SYMBOLS)).cast("bigint"),
            "n_lines": F.size(own_lines).cast("bigint"),
            "n_dup_lines": (F.size(own_lines) - F.size(F.array_distinct(own_lines))).cast("bigint"),
            "n_shouts": F.regexp_count(own_text, F.lit(r"!!(?=[\x20\x09-\x0D]|\z)")).cast("bigint"),
            "n_repeat_words": F.when(
                F.size(own_windows) == F.size(F.array_distinct(own_windows)), F.lit(0).cast("bigint")
            ).otherwise(covered),
        }
    )
    return base.drop(own_text, own_words, own_windows, own_lines)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def statistic(name: str) -> Column:
    """The statistic in whole per mille; 0 where its base is 0."""
    part, whole = (F.col(c) for c in STATISTICS[name])
    return F.when(whole > 0, F.call_function("div", part * 1000, whole)).otherwise(F.lit(0).cast("bigint"))


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), summed term by term in logarithms."""
    step = F.log(F.lit(p / (1 - p)))
    start = F.struct((n * F.log(F.lit(1 - p))).alias("term"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        F.sequence(F.lit(0).cast("bigint"), k),
        start,
        lambda acc, j: F.struct(
            F.when(j < n, acc["term"] + F.log((n - j).cast("double")) - F.log((j + 1).cast("double")) + step)
            .otherwise(acc["term"])
            .alias("term"),
            (acc["sum"] + F.exp(acc["term"])).alias("sum"),
        ),
        lambda acc: F.least(acc["sum"], F.lit(1.0)),
    )


def first_rejection() -> Column:
    """The first step of the path, from 1, whose rules reject the document; null if none does.

    A step's rules are all cutoffs of the statistics before its own, and its own statistic's down
    to its cutoff, so the rules of a step reject all that those of the steps before it do.
    """

    def passed(value: Column) -> Column:
        return F.size(F.filter(F.array(*[F.lit(c) for c in CUTOFFS]), lambda cutoff: cutoff >= value))

    own = [passed(statistic(name)) for name in STATISTICS]
    return F.least(*[F.when(n < len(CUTOFFS), n + k * len(CUTOFFS) + 1) for k, n in enumerate(own)])


def certified_steps(
    featured: DataFrame,
    labels: DataFrame,
    stratum: str,
    false_rejection: float = FALSE_REJECTION,
    risk: float = RISK,
) -> DataFrame:
    """(stratum, holdout, step, false_rejections, p_value) and a cutoff of each statistic, null if it has none.

    The holdout of a stratum is its documents labelled quality 1 that the base rules keep.  Steps
    are tested from the loosest on, and the first that fails ends the path.  A step passes when,
    were the true share of good documents its rules reject as high as ``false_rejection``, so few
    false rejections as were seen would have a chance of at most ``risk`` / m: the exact lower
    tail of the binomial.  The order is fixed before the labels are seen, so the steps of a
    stratum need no correction among themselves; m corrects for the strata, less those whose
    holdouts are too small to pass any test at that level (Tarone's count).  With chance 1 -
    ``risk`` no stratum loses more than ``false_rejection`` of its good documents to all rules
    together.  A stratum with too few labels stays at step 0, where nothing is rejected.
    """
    good = labels.where("quality = 1").select(F.col("doc_id").alias("_labelled")).distinct()
    held = featured.join(good, featured["doc_id"] == good["_labelled"], "left_semi").where(~base_failed())
    # Rows per step first: at most one more than there are steps for each stratum, whatever the labels.
    counts = held.select(F.col(stratum).alias("stratum"), F.coalesce(first_rejection(), F.lit(STEPS + 1)).alias("step"))
    counts = counts.groupBy("stratum", "step").agg(F.count("*").alias("rows"))
    so_far = Window.partitionBy("stratum").orderBy("step")
    # A row for each step at which the count of false rejections grows, and one before them all.
    seen = counts.withColumns(
        {"holdout": F.sum("rows").over(Window.partitionBy("stratum")), "rejected": F.sum("rows").over(so_far)}
    )
    strata = seen.groupBy("stratum").agg(F.max("holdout").alias("holdout"))
    strata = strata.withColumn("least_p", F.pow(F.lit(1 - false_rejection), F.col("holdout")))
    # The least m such that no more than m strata can pass at risk / m.  One row per stratum.
    ranked = Window.orderBy("least_p")
    ranks = strata.select(F.row_number().over(ranked).alias("m"), F.lead("least_p").over(ranked).alias("next"))
    level = ranks.where(F.col("next").isNull() | (F.col("next") * F.col("m") > risk)).agg((F.lit(risk) / F.min("m")).alias("level"))
    tests = seen.where(F.col("step") <= STEPS).select("stratum", "step", "holdout", "rejected")
    tests = tests.unionByName(strata.select("stratum", F.lit(0).alias("step"), "holdout", F.lit(0).cast("bigint").alias("rejected")))
    p_value = F.when(F.col("rejected") > F.col("holdout") * false_rejection, F.lit(1.0)).otherwise(
        binomial_tail(F.col("holdout"), F.col("rejected"), false_rejection)
    )
    tests = tests.withColumn("p_value", p_value).join(F.broadcast(level))
    passed = F.col("p_value") <= F.col("level")
    # Counts only grow along the path, so the tests passed are those before the first that fails.
    ended = tests.groupBy("stratum").agg(
        F.max("holdout").alias("holdout"),
        F.greatest(F.coalesce(F.min(F.when(~passed, F.col("step"))) - 1, F.lit(STEPS)), F.lit(0)).alias("step"),
        F.coalesce(F.max(F.when(passed, F.col("rejected"))), F.lit(0).cast("bigint")).alias("false_rejections"),
        F.max(F.when(passed, F.col("p_value"))).alias("p_value"),
    )
    cutoffs = F.array(*[F.lit(c) for c in CUTOFFS])
    return ended.select(
        "*",
        *[
            F.get(cutoffs, F.least(F.col("step") - k * len(CUTOFFS), F.lit(len(CUTOFFS))) - 1).alias(f"{name}_cutoff")
            for k, name in enumerate(STATISTICS)
        ],
    )


def judge(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", false_rejection: float = FALSE_REJECTION, risk: float = RISK
) -> DataFrame:
    """The columns of ``docs`` but text, with the features, base_failed and kept.

    Texts are read once: their features are staged, and cutoffs and verdicts come from those.
    A document is dropped that fails a base rule or is over a certified cutoff of its stratum.
    A null stratum is a stratum of its own.  Labels of unknown documents, repeated labels and
    null labels change nothing.  Columns of ``docs`` named like a result are replaced by it.  An
    empty table gives an empty result.
    """
    features = document_features(docs).drop("text").withColumn("base_failed", base_failed())
    featured = staged(features, "quality-features")
    certified = staged(certified_steps(featured, labels, stratum, false_rejection, risk), "quality-cutoffs")
    of, last = free_name(featured, "_stratum"), free_name(featured, "_step")
    steps = certified.select(F.col("stratum").alias(of), F.col("step").alias(last))
    joined = featured.join(broadcast_if_small(steps), featured[stratum].eqNullSafe(steps[of]), "left")
    over = F.coalesce(first_rejection() <= F.col(last), F.lit(False))
    return joined.withColumn("kept", ~(F.col("base_failed") | over)).drop(of, last)
