"""Spelling variants by asymmetric q-chunks: groups of words one edit apart.

A word of L code points is cut into two disjoint chunks, its halves; a word of L or L + 1 code
points gives all its positional grams of these chunks' lengths.  One edit leaves one of the two
chunks whole, at most one place away, so every pair of words one edit apart meets where a chunk
equals a gram within shift one, and an exact comparison decides.  The shorter word of a pair
always gives the chunks, or either one where lengths are equal.

A chunk that many words share would compare all of them with all its grams.  There the half that
is not the chunk is cut in the same way: the edit lies in it, so one of its own two halves is
whole in the other word, next to the chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import broadcast_if_small, staged, text_or_empty

# Letters of a word, its least length and count, and how often a run loses a letter.
MIN_LENGTH, MIN_COUNT = 5, 3
LETTERS = f"[A-Za-z\\u00C0-\\u00FF]{{{MIN_LENGTH},}}"
TYPO_EVERY = 97
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: How much more often a form must occur than the word it is the form of.
FORM_FACTOR = 2
#: Comparisons of one chunk up to which its words are compared without a second cut.
CROWDED = 4_096


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run): each run of letters of ``MIN_LENGTH`` or more, A-Z lowered.

    Null texts have none.  Rows that repeat count again.  Other columns are not looked at.
    """
    found = F.regexp_extract_all(text_or_empty(), F.lit(LETTERS), F.lit(0))
    split = docs.select("doc_id", F.explode(found).alias("run"))
    return split.withColumn("run", F.translate("run", UPPER, LOWER))


def with_typos(found: DataFrame, every: int = TYPO_EVERY) -> DataFrame:
    """(word): runs, of which about one in ``every`` loses the letter that its hash points at.

    The hash is the CRC-32 of ``<doc_id>:<run>``; a null doc_id counts as no text.
    """
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    code = F.crc32(F.concat(doc_id, F.lit(":"), F.col("run")).cast("binary"))
    at = F.expr("cast(code % length(run) as int)")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return found.withColumn("code", code).select(F.when(F.col("code") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def word_counts(words: DataFrame) -> DataFrame:
    """(word, n) of words long and frequent enough; counted in each task before the shuffle."""
    counts = words.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= MIN_COUNT)


def _part(word: Column, start: Column, stop: Column) -> Column:
    return F.substring(word, start + 1, stop - start)


def _places(word: Column, length: Column, shift: Column) -> Column:
    """Both halves of a word of ``length``, as they stand in ``word``, each with the two halves of the rest.

    In ``word``, a word of ``length`` or one more, the second half starts ``shift`` further on
    where the extra letter is in the first.  Each entry is (half, chunk, rests); a rest names
    which half of the other half it is.
    """
    middle = F.floor(length / 2).cast("int")
    quarter, three = F.floor(middle / 2).cast("int"), (middle + F.floor((length - middle) / 2)).cast("int")
    zero = F.lit(0)

    def entry(half: int, chunk: Column, rests: list[tuple[int, Column]]) -> Column:
        named = [F.concat(F.lit(f"{k}"), rest) for k, rest in rests]
        return F.struct(F.lit(half).alias("half"), chunk.alias("chunk"), F.array_distinct(F.array(*named)).alias("rests"))

    # The edit is in the second half: the first starts both words.
    first = entry(
        0,
        _part(word, zero, middle),
        [(0, _part(word, middle, three)), (1, _part(word, three + shift, length + shift))],
    )
    # The edit is in the first half: the second ends both words.
    second = entry(
        1,
        _part(word, middle + shift, length + shift),
        [(0, _part(word, zero, quarter)), (1, _part(word, quarter + shift, middle + shift))],
    )
    return F.array(first, second)


def _chunks(words: DataFrame) -> DataFrame:
    """(word, length, half, chunk, rests): the two chunks of each word."""
    length = F.length("word")
    return words.select("word", length.alias("length"), F.inline(_places(F.col("word"), length, F.lit(0))))


def _grams(words: DataFrame) -> DataFrame:
    """(gram_word, length, half, chunk, rests): the grams that can equal a chunk within shift one.

    ``length`` is that of the word that gives the chunk.  Of all positional grams these are the
    ones at the chunk's place, and for a chunk of a word one shorter at the place one further on.
    """
    word, length = F.col("word"), F.length("word")
    same = words.select(word.alias("gram_word"), length.alias("length"), F.inline(_places(word, length, F.lit(0))))
    longer = words.where(length > MIN_LENGTH)
    shifted = longer.select(
        word.alias("gram_word"), (length - 1).alias("length"), F.inline(_places(word, length - 1, F.lit(1)))
    )
    return same.unionAll(shifted)


def near_pairs(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(word, near): all pairs of distinct ``word`` one inserted, deleted or replaced code point apart, both ways."""
    chunks, grams = _chunks(words), _grams(words)
    key = ["length", "half", "chunk"]
    sizes = chunks.groupBy(*key).agg(F.count("*").alias("n_chunks"))
    sizes = sizes.join(grams.groupBy(*key).agg(F.count("*").alias("n_grams")), key)
    full = staged(sizes.where(F.col("n_chunks") * F.col("n_grams") > crowded).select(*key), "spelling-crowded")
    full = broadcast_if_small(full)

    def sides(how: str) -> tuple[DataFrame, DataFrame]:
        return chunks.join(full, key, how), grams.join(full, key, how)

    def meet(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        pairs = left.join(right, on).select("word", F.col("gram_word").alias("near"))
        return pairs.where((F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1))

    open_left, open_right = sides("left_anti")
    full_left, full_right = (side.withColumn("rest", F.explode("rests")).drop("rests") for side in sides("left_semi"))
    found = meet(open_left.drop("rests"), open_right.drop("rests"), key).unionAll(
        meet(full_left, full_right, [*key, "rest"])
    )
    return found.unionAll(found.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct()


def spelling_forms(counts: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(word, n, form, form_n, n_near, root) for each (word, n).

    A word's form is its near word of largest n, ties to the smallest in code-point order, if
    that n is at least ``FORM_FACTOR`` times its own.  The root is where forms end; n doubles
    with every step, so the way there is short and has no circles.
    """
    counts = staged(counts, "spelling-words")
    near = staged(near_pairs(counts.select("word"), crowded), "spelling-near")
    sized = near.join(counts.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = sized.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    )
    chosen = counts.join(best, "word", "left").withColumn("best_n", -F.col("best.less"))
    has_form = F.col("best_n") >= FORM_FACTOR * F.col("n")
    formed = staged(
        chosen.select(
            "word",
            "n",
            F.when(has_form, F.col("best.near")).alias("form"),
            F.when(has_form, F.col("best_n")).alias("form_n"),
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        ),
        "spelling-formed",
    )
    # Only words that have a form are followed; each round doubles the way behind them.
    ways = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = staged(
            ways.join(broadcast_if_small(onward), "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "spelling-ways",
        )
        moved = ways.where("moved").limit(1).count()
        ways = ways.drop("moved")
        if not moved:
            break
    rooted = formed.join(ways, "word", "left")
    return rooted.select("word", "n", "form", "form_n", "n_near", F.coalesce("root", "word").alias("root"))
