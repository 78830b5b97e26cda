"""Chat formatting in budgeted windows of whole turns, with a loss mask.

A conversation is a run of turns, and the prefix sums of their tokens place each turn without
walking through them.  The sums are cut into cells of one stride: turns that lie within a cell
make a window, and a turn that crosses into another cell makes one by itself.  A window holds the
conversation's system turn, as much of the turns before it as its history allows, and its own
turns, and all that fits the budget unless a single turn is too long for it.  Assistant texts of
its own turns are the targets; what a window repeats is masked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template and its escapes.
TURN_START, TURN_END = "### ", "</turn>\n"
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"
#: Windows after its own that can repeat a turn.
LATER = 3


@dataclass(frozen=True)
class Budget:
    """Tokens a window may hold: the system turn, then history, then its own turns.

    What the system turn leaves is divided: ``history`` of it, but no more than a third, for
    repeated turns, the rest for its own.
    """

    tokens: int = 512
    history: int = 128

    def stride(self, system: Column) -> Column:
        """Tokens for a window's own turns, given those of the system turn; at least one."""
        return F.greatest(F.lit(self.tokens) - system - self.reach(system), F.lit(1)).cast("bigint")

    def reach(self, system: Column) -> Column:
        """Tokens of history, never more than half the stride."""
        return F.greatest(F.least(F.lit(self.history), F.floor((F.lit(self.tokens) - system) / 3)), F.lit(0)).cast("bigint")


def token_count(text: Column) -> Column:
    """An estimate: a token for every four characters begun, and four for the turn's marks."""
    return (F.floor((F.length(text) + 3) / 4) + 4).cast("bigint")


def escape(text: Column) -> Column:
    r"""Backslashes doubled and one put into ``#`` and ``</``, so no mark can occur in a text."""
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("#"), F.lit("\\#")), F.lit("</"), F.lit("<\\/"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\:"))


def format_windows(conversations: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """(conv_id, window, text, n_context, loss_spans, n_tokens, over_budget) for each window, in order from 0.

    ``text`` is ``### role: text</turn>`` and a line end for each turn; ``n_context`` counts the
    repeated turns it begins with; ``loss_spans`` are (start, stop) in code points of ``text``.
    Turns are ordered by turn, role and text, nulls first; a null role or text is empty; rows
    without a conv_id make one conversation; repeated rows are repeated turns.  A system turn
    is retained if it is the first.  Turns are never cut: ``over_budget`` marks the windows of
    more than ``budget.tokens``, which hold one turn of their own too long for what the system
    turn leaves, or a system turn that leaves nothing.  Columns other than conv_id, turn, role
    and text are not looked at.

    Prefix sums run over a conversation sorted and spilled by Spark; only the turns of one
    window are gathered in a row.
    """
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    turns = turns.withColumn("tokens", token_count(F.col("text")))
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = turns.withColumn("place", F.row_number().over(ordered).cast("bigint"))
    turns = turns.withColumn("is_system", (F.col("place") == 1) & (F.lower("role") == SYSTEM_ROLE))
    # The system turn has its own part of the budget and does not count in the prefix sums.
    counted = F.when(F.col("is_system"), 0).otherwise(F.col("tokens"))
    whole = Window.partitionBy("conv_id").orderBy("place")
    so_far = whole.rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.withColumns(
        {"end": F.sum(counted).over(so_far), "system": F.sum(F.when(F.col("is_system"), F.col("tokens")).otherwise(0)).over(so_far)}
    )
    stride = budget.stride(F.col("system"))
    turns = turns.withColumn("start", F.col("end") - counted)
    cell = F.call_function("div", F.col("start"), stride)
    turns = turns.withColumn("cell", cell.cast("bigint")).withColumn(
        "crosses", F.when(F.col("is_system"), F.lit(False)).otherwise(F.col("end") > (F.col("cell") + 1) * stride)
    )
    # Turns of a window are neighbours, so each change of cell or crossing begins the next window.
    # A crossing turn ends its cell, so no two of a cell cross.
    before = F.lag(F.struct("cell", "crosses")).over(whole)
    opens = before.isNotNull() & (before != F.struct("cell", "crosses")) & ~((F.col("place") == 2) & (F.col("system") > 0))
    turns = turns.withColumn("opens", opens.cast("bigint"))
    turns = turns.withColumn("window", F.sum("opens").over(so_far))
    # The windows that begin within a turn's reach: it is no longer than half a stride, so there
    # are three at most, those of the crossing and the cells on both sides of it.
    by_window = Window.partitionBy("conv_id").orderBy("window")
    turns = turns.withColumn("later", F.array(*[F.min("start").over(by_window.rangeBetween(k, k)) for k in range(1, LATER + 1)]))
    reach = budget.reach(F.col("system"))
    own = F.array(F.struct(F.col("window").alias("window"), F.lit(2).alias("part")))
    repeats = F.filter(
        F.transform("later", lambda s, k: F.struct((F.col("window") + k + 1).alias("window"), F.lit(1).alias("part"), s.alias("s"))),
        lambda w: w["s"].isNotNull() & (F.col("start") >= w["s"] - reach),
    )
    repeats = F.transform(repeats, lambda w: F.struct(w["window"].alias("window"), w["part"].alias("part")))
    copies = F.when(F.col("is_system"), own).otherwise(F.concat(own, repeats))
    parts = ["conv_id", "place", "role", "text", "tokens"]
    placed = turns.select(*parts, F.inline(copies))
    # The retained system turn, once for each later window of its conversation.
    windows = turns.where("window > 0").select("conv_id", "window").distinct()
    head = turns.where("is_system").select(F.col("conv_id").alias("_conv"), "place", "role", "text", "tokens")
    kept = windows.join(head, windows["conv_id"].eqNullSafe(head["_conv"])).select(*parts, "window", F.lit(0).alias("part"))
    gathered = placed.unionByName(kept).groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("part", "place", "role", "text"))).alias("turns"), F.sum("tokens").alias("n_tokens")
    )
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(TURN_START), _role(t["role"]), F.lit(": ")).alias("head"),
            escape(t["text"]).alias("body"),
            ((t["part"] == 2) & (t["role"] == TARGET_ROLE)).alias("target"),
        ),
    )
    gathered = gathered.withColumn("pieces", pieces)
    end = len(TURN_END)
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"]) + end).alias("at"),
            F.when(
                p["target"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(p["head"])).alias("start"),
                            (acc["at"] + F.length(p["head"]) + F.length(p["body"])).alias("stop"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return gathered.select(
        "conv_id",
        "window",
        F.concat_ws("", F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(TURN_END)))).alias("text"),
        F.size(F.filter("turns", lambda t: t["part"] < 2)).alias("n_context"),
        spans.alias("loss_spans"),
        "n_tokens",
        (F.col("n_tokens") > budget.tokens).alias("over_budget"),
    )


def read_turns(text: Column) -> Column:
    """The (role, text) turns of a formatted window, as they went in."""
    marked = F.split(text, "</turn>\n")
    marked = F.slice(marked, 1, F.size(marked) - 1)

    def parse(turn: Column) -> Column:
        # The first colon without a backslash before it ends the role.
        head = F.regexp_extract(turn, r"(?s)^### ((?:\\.|[^:\\])*): ", 1)
        return F.struct(
            unescape(head).alias("role"),
            unescape(F.substring(turn, F.length(head) + len(TURN_START) + 3, F.length(turn))).alias("text"),
        )

    return F.transform(marked, parse)


def read_targets(text: Column, spans: Column) -> Column:
    """The texts under the mask, unescaped."""
    return F.transform(spans, lambda s: unescape(F.substring(text, s["start"] + 1, s["stop"] - s["start"])))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """What the windows of a conversation hold, read back: turns once each, targets, lengths, and its windows."""
    own = F.expr("slice(_turns, n_context + 1, size(_turns))")
    read = windows.select(
        "conv_id", "window", "n_context", "over_budget", F.length("text").alias("chars"), read_turns(F.col("text")).alias("_turns"),
        F.concat_ws("", read_targets(F.col("text"), F.col("loss_spans"))).alias("targets"),
    )
    read = read.select("conv_id", "window", "over_budget", "chars", "targets", own.alias("own"))
    lines = F.concat_ws("", F.transform("own", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    read = read.select("conv_id", "window", "over_budget", "chars", "targets", F.size("own").alias("turns"), lines.alias("lines"))
    joined = read.groupBy("conv_id").agg(
        F.sum("turns").cast("bigint").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("window", "lines", "targets"))).alias("all"),
        F.sum("chars").cast("bigint").alias("formatted_chars"),
        F.count("*").alias("n_windows"),
        F.count_if("over_budget").alias("n_over_budget"),
    )
    loss = F.concat_ws("", F.transform("all", lambda w: w["targets"]))
    return joined.select(
        "conv_id",
        "n_turns",
        F.sha2(F.concat_ws("", F.transform("all", lambda w: w["lines"])), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
        "n_over_budget",
    )
