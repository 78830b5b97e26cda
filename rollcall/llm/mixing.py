"""Mixing sources to target weights by budgets that flow down a domain-language-source tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import broadcast_if_small, staged, text_or_empty, words

LEVELS = ("domain", "lang", "source")
#: The order within an epoch is cut into so many buckets; only the bucket that holds a leaf's
#: cut is sorted.
BUCKETS = 4096
KEY_BITS = 60


def _whole(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share_budget(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Divide each parent's ``budget`` among its children by ``weight``, none over its ``capacity``.

    Children are taken by capacity over weight.  While one cannot use its share of what is left,
    it gets its capacity, and what it leaves goes to its siblings; the rest share by weight,
    rounded so that the parts add up.  A parent's budget is at most its children's capacity, so
    a shortage leaves the siblings' level only when no sibling can take it up.
    """
    order = [(F.col("capacity") / F.col("weight")), F.col(name).asc_nulls_first()]
    upto = Window.partitionBy(*parent).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.partitionBy(*parent).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    running = Window.partitionBy(*parent).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(*parent)
    taken = F.coalesce(F.sum("capacity").over(upto), F.lit(0))
    full = _whole(F.col("capacity")) * F.sum("weight").over(onward) <= _whole(
        F.col("budget") - taken
    ) * F.col("weight")
    marked = children.withColumn("_full", full)
    free_weight = F.when(F.col("_full"), 0).otherwise(F.col("weight"))
    marked = marked.withColumns(
        {
            "_rest": F.col("budget") - F.sum(F.when(F.col("_full"), F.col("capacity")).otherwise(0)).over(every),
            "_all": F.sum(free_weight).over(every),
            "_upto": F.sum(free_weight).over(running),
        }
    )
    rest = _whole(F.col("_rest"))
    upper = _div(rest * F.col("_upto"), F.col("_all"))
    lower = _div(rest * (F.col("_upto") - F.col("weight")), F.col("_all"))
    share = F.when(F.col("_full"), F.col("capacity")).otherwise(upper - lower).cast("bigint")
    return marked.withColumn("budget", share).drop("_full", "_rest", "_all", "_upto")


def leaf_budgets(leaves: DataFrame, weights: dict[str, Column], budget: Column, max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, budget) of each leaf with tokens; others cost nothing and have none.

    ``leaves``: domain, lang, source, tokens (bigint).  ``weights``: for each level a positive
    whole number as a Column over the columns of that level and above.  ``budget``: a Column
    over ``tokens``, the tokens of the whole corpus.  A leaf can be used ``max_epochs`` times.
    """
    leaves = leaves.where("tokens > 0").withColumn("capacity", F.col("tokens") * max_epochs)
    total = leaves.agg(F.sum("tokens").alias("tokens"), F.sum("capacity").alias("capacity")).where("tokens > 0")
    above = total.select(F.least(budget.cast("bigint"), "capacity").alias("budget"))
    for depth in range(1, len(LEVELS) + 1):
        path, parent = list(LEVELS[:depth]), list(LEVELS[: depth - 1])
        level = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        level = level.withColumn("weight", weights[path[-1]].cast("bigint"))
        up = above.select(*[F.col(c).alias(f"_{c}") for c in parent], "budget")
        on = [level[c].eqNullSafe(up[f"_{c}"]) for c in parent]
        joined = level.join(up, on) if on else level.join(F.broadcast(up))
        joined = joined.drop(*[f"_{c}" for c in parent])
        above = share_budget(joined, parent, path[-1]).select(*path, "tokens", "budget")
    return above


def order_key(seed: str, epoch: Column, doc_id: Column, text: Column) -> Column:
    """A 60-bit number that places a document in an epoch, from the seed alone."""
    digest = F.sha2(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")), F.sha2(text, 256)), 256)
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("bigint")


def mix(
    docs: DataFrame,
    domain: Column,
    weights: dict[str, Column],
    budget: Column,
    seed: str,
    max_epochs: int = 2,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The chosen rows with all columns of ``docs``, ``_mix_domain``, ``_mix_tokens`` and ``_mix_epoch``.

    Tokens are words.  A leaf gives whole epochs while its budget lasts, then, of the next
    epoch's seeded order, the longest prefix that fits; a row chosen in k epochs comes out k
    times, numbered from 1.  Null domains, languages and sources are leaves of their own.  Texts
    without words weigh nothing and go with the prefix they stand in: with a full epoch, or
    before the cut; a leaf of such texts alone is taken once.  A null doc_id orders by its text.  Repeated rows are separate rows that
    stand next to each other.

    A leaf may hold most rows, so no leaf is sorted: its tokens are summed per bucket of the
    order, the sums show the bucket of the cut, and only that bucket's rows are sorted.
    """
    names = {"_mix_domain": domain.cast("string"), "_mix_lang": F.col("lang").cast("string"), "_mix_source": F.col("source").cast("string")}
    rows = docs.withColumns(names | {"_mix_tokens": F.size(words(text_or_empty())).cast("bigint")})
    as_level = [F.col(f"_mix_{c}").alias(c) for c in LEVELS]
    leaves = staged(rows.groupBy(*as_level).agg(F.sum("_mix_tokens").alias("tokens")), "mix-leaves")
    plans = staged(leaf_budgets(leaves, weights, budget, max_epochs), "mix-budgets")
    plan = broadcast_if_small(
        plans.select(
            *[F.col(c).alias(f"_leaf_{c}") for c in LEVELS],
            _div(F.col("budget"), F.col("tokens")).alias("_full"),
            (F.col("budget") % F.col("tokens")).alias("_rest"),
        )
    )
    on = [F.col(f"_mix_{c}").eqNullSafe(F.col(f"_leaf_{c}")) for c in LEVELS]
    key = order_key(seed, F.col("_full") + 1, F.col("doc_id"), text_or_empty())
    placed = rows.join(plan, on, "left").drop(*[f"_leaf_{c}" for c in LEVELS])
    placed = placed.withColumns({"_full": F.coalesce("_full", F.lit(1)), "_rest": F.coalesce("_rest", F.lit(0))})
    placed = placed.withColumn("_key", key)
    placed = placed.withColumn("_bucket", F.shiftright("_key", KEY_BITS - (buckets.bit_length() - 1)))
    leaf = [f"_mix_{c}" for c in LEVELS]
    sums = placed.where("_rest > 0").groupBy(*leaf, "_bucket", "_rest").agg(F.sum("_mix_tokens").alias("_sum"))
    upto = Window.partitionBy(*leaf).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("_after", F.sum("_sum").over(upto))
    cuts = staged(
        sums.where("_after > _rest").groupBy(*leaf).agg(F.min_by(F.struct("_bucket", F.expr("_after - _sum").alias("before")), "_bucket").alias("_cut"))
        .select(*[F.col(c).alias(f"_cut{c}") for c in leaf], F.col("_cut._bucket").alias("_cut_bucket"), F.col("_cut.before").alias("_before")),
        "mix-cuts",
    )
    cut_on = [F.col(c).eqNullSafe(F.col(f"_cut{c}")) for c in leaf]
    placed = placed.join(broadcast_if_small(cuts), cut_on, "left")
    outside = placed.where("_cut_bucket is null or _bucket != _cut_bucket").withColumn(
        "_times", F.col("_full") + F.when(F.col("_bucket") < F.col("_cut_bucket"), 1).otherwise(0)
    )
    order = ["_key", "doc_id", F.xxhash64("text")]
    running = Window.partitionBy(*leaf).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.where("_bucket = _cut_bucket").withColumn("_sum", F.sum("_mix_tokens").over(running))
    inside = inside.withColumn(
        "_times", F.col("_full") + F.when(F.col("_before") + F.col("_sum") <= F.col("_rest"), 1).otherwise(0)
    ).drop("_sum")
    chosen = outside.unionByName(inside).where("_times > 0")
    chosen = chosen.withColumn("_mix_epoch", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
    return chosen.select(*docs.columns, "_mix_domain", "_mix_tokens", "_mix_epoch")
