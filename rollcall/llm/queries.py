"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import (
    chat,
    decontamination,
    licenses,
    mixing,
    prefix_trie,
    quality,
    sharding,
    simhash,
    spelling,
    spherical,
    substrings,
    tokens,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

N_SHARDS = 40
SHARD_KEY = "rollcall-shards"
MIX_SEED = "rollcall-mix"
MIX_EPOCHS = 2


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op3_simhash_near_dedup(spark, sf):
    groups = simhash.near_duplicate_groups(table(spark, sf, "documents"))
    digits = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


@register
def op8_feistel_sharding(spark, sf):
    sizes = sharding.document_sizes(table(spark, sf, "documents"))
    order = ["doc_id", "size", "text_crc32", "text_hash"]
    placed = sharding.shard_rows(sizes, N_SHARDS, SHARD_KEY, order)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def mix_domain() -> Column:
    """Four domains by the last number of the source's name; other sources share one."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]{1,9})$", 1)
    return F.when(number == "", "other").otherwise(
        F.concat(F.lit("domain"), (F.when(number != "", number).cast("int") % 4).cast("string"))
    )


def mix_weights() -> dict[str, Column]:
    domain, lang = F.col("domain"), F.col("lang")
    return {
        "domain": F.when(domain == "domain0", 4).when(domain == "domain1", 3).when(domain == "domain2", 2).otherwise(1),
        "lang": F.when(lang == "en", 5).when(lang == "de", 2).when(lang == "fr", 2).otherwise(1),
        "source": F.lit(1),
    }


def mixed(docs: DataFrame) -> DataFrame:
    """Six tenths of the corpus, each document at most twice."""
    budget = F.expr("tokens * 6 div 10")
    return mixing.mix(docs, mix_domain(), mix_weights(), budget, MIX_SEED, MIX_EPOCHS)


@register
def op10_hierarchical_mix(spark, sf):
    return mixed(table(spark, sf, "documents")).select(
        "doc_id",
        F.col("_mix_domain").alias("domain"),
        "lang",
        "source",
        F.col("_mix_tokens").alias("n_tokens"),
        F.col("_mix_epoch").alias("epoch"),
    )


@register
def op9_certified_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    judged = quality.judge(docs, table(spark, sf, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@register
def op2_simhash_decontamination(spark, sf):
    return decontamination.leaked_windows(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@register
def op5_substring_dedup(spark, sf):
    return substrings.remove_repeats(table(spark, sf, "documents"))


@register
def op1_string_kernel_toxicity(spark, sf):
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


#: A conversation whose texts are made of the template's own marks.
TRICKY = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


@register
def op4_budgeted_chat(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame(TRICKY, "conv_id bigint, turn bigint, role string, text string")
    return chat.conversation_digests(chat.format_windows(turns.unionByName(tricky)))


ORDER_KEY = "rollcall-order"


@register
def op6_training_order(spark, sf):
    return tokens.training_records(table(spark, sf, "documents"), ORDER_KEY)


def document_path() -> Column:
    """Documents as files: a folder for each source and language, and in it one for each thousand ids."""
    folder = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")))
    return F.concat(folder, F.lit("/"), F.floor(F.col("doc_id") / 1000).cast("string"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))


@register
def op7_license_scan(spark, sf):
    """A document whose first line is a licence header serves as its folder's licence file."""
    files = table(spark, sf, "documents").select("doc_id", document_path().alias("path"), "text")
    opens = F.exists("matches", lambda m: (m["kind"] == "file") | (m["line"] == 0))
    return licenses.file_licenses(files, opens)


#: Conversations of one hundred share the opening of the first, up to fewer than so many turns.
OPENING_OF, OPENING_TURNS = 100, 6


@register
def op11_conversation_trie(spark, sf):
    turns = prefix_trie.conversation_turns(table(spark, sf, "conversations"))
    conv = F.col("conv_id")
    taken = F.crc32(conv.cast("string").cast("binary")) % OPENING_TURNS
    shared = prefix_trie.with_shared_openings(turns, conv - conv % OPENING_OF, taken, OPENING_TURNS - 1)
    return prefix_trie.prefix_nodes(prefix_trie.sequences(shared))


@register
def op12_spelling_variants(spark, sf):
    words = spelling.with_typos(spelling.runs(table(spark, sf, "documents")))
    return spelling.spelling_forms(spelling.word_counts(words))


@register
def op13_embedding_near_dedup(spark, sf):
    return spherical.near_duplicate_vectors(table(spark, sf, "embeddings"))
