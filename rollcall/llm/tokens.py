"""Training-order materialisation: token sequences of one length, each with a global slot."""

from __future__ import annotations

import base64
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import batched, groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.config import scratch_dir
from rollcall.llm.common import small_batches, staged, text_or_empty
from rollcall.llm.feistel import permute

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how text is split before merges, as the rank files were made.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_TEXT = 50_256
SEQUENCE_TOKENS = 1024
SHARD_SEQUENCES = 4096
TOKEN_BYTES = 2
#: Neighbouring shards that one task puts in order, 8 MB each by default.
SHARDS_A_TASK = 16
#: Bytes of ids that a task gathers by shard before it sends them, and that go in one bundle.
HELD_BYTES = 16 << 20
BUNDLE_BYTES = 1 << 18
BUNDLE_LEVEL = 3
#: Bundles of one batch, of those that are left at a task's end.
BATCH_BUNDLES = 64
BUNDLE = "shard int, slots array<bigint>, sequences array<bigint>, ats array<int>, sizes array<int>, doc_ids array<bigint>, ids binary"
BUNDLE_NAMES = ["shard", "slots", "sequences", "ats", "sizes", "doc_ids", "ids"]
BUNDLE_KINDS = [pa.int32(), *map(pa.list_, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())), pa.binary()]


def load_encoder(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})


# The white space that the split rule's \\s stands for.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 1_000
_LONG_RUNS = re.compile(f"[{BLANKS}]{{{LONG_RUN},}}")


def encode_text(encoder, text: str) -> list[int]:
    """Ids of a text, special tokens as ordinary text.

    The rule takes a run of white space as one piece, less its last character if more text
    follows; its matcher cannot take very long runs, so these are cut out and encoded as the
    pieces they are.
    """
    ids, at = [], 0
    for run in _LONG_RUNS.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoder.encode_ordinary(text[at : run.start()])
        ids += encoder._encode_single_piece(text[run.start() : stop])
        at = stop
    return ids + encoder.encode_ordinary(text[at:])


def _encode(ranks: bytes):
    """Ids of each text and the end mark, and where they begin among those of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = load_encoder(ranks), TaskContext.get().partitionId(), 0
        for batch in batches:
            starts, sizes, ids = [], [], []
            for text in batch.column("text").to_pylist():
                got = np.array(array("H", [*encode_text(encoder, text), END_OF_TEXT]), "<u2")
                starts.append(at)
                sizes.append(got.size)
                ids.append(got.tobytes())
                at += got.size
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([part] * len(ids), pa.int32()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "part", "start", "n_tokens", "tokens"],
            )

    return run


def encode_documents(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, part, start, n_tokens, tokens) of each row, written once; tokens are 16-bit ids.

    Special tokens in a text are ordinary text.  A null or empty text is its end mark alone.
    """
    with open(tokenizer, "rb") as file:
        ranks = file.read()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    with small_batches(docs.sparkSession):
        return staged(
            texts.mapInArrow(_encode(ranks), "doc_id bigint, part int, start bigint, n_tokens bigint, tokens binary"), "token-ids", "zstd"
        )


def _bundle(length: int, shard_sequences: int):
    """Cut each text's ids at the sequence borders of the whole stream; pieces of one shard go in bundles, their ids compressed together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=BUNDLE_LEVEL)
        held: dict[int, tuple[list, ...]] = {}
        sizes: dict[int, int] = {}

        def close(shard: int) -> tuple:
            *about, ids = held.pop(shard)
            del sizes[shard]
            return (shard, *about, codec.compress(b"".join(ids), asbytes=True))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), BUNDLE_KINDS, strict=True)], BUNDLE_NAMES)

        for batch in batches:
            rows, total = [], sum(sizes.values())
            for doc, start, ids, slots in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "tokens", "slots")), strict=True):
                size, taken = len(ids) // TOKEN_BYTES, 0
                for slot in slots:
                    at = (start + taken) % length
                    take = min(length - at, size - taken)
                    shard, piece = slot // shard_sequences, ids[taken * TOKEN_BYTES : (taken + take) * TOKEN_BYTES]
                    pieces = held.setdefault(shard, ([], [], [], [], [], []))
                    for values, value in zip(pieces, (slot, (start + taken) // length, at, take, doc, piece), strict=True):
                        values.append(value)
                    sizes[shard] = sizes.get(shard, 0) + len(piece)
                    total += len(piece)
                    taken += take
                    if sizes[shard] >= BUNDLE_BYTES:
                        total -= sizes[shard]
                        rows.append(close(shard))
                    if total >= HELD_BYTES:
                        total = 0
                        rows.extend([close(k) for k in list(held)])
            if rows:
                yield batch_of(rows)
        for some in batched(list(held), BATCH_BUNDLES):
            yield batch_of([close(shard) for shard in some])

    return run


def _shard_file(shard: int, records: Iterable[tuple]) -> pa.RecordBatch:
    """The file of a shard, from (tokens, sequence, n_tokens, doc_ids) in slot order: the tokens, then the index and its size."""
    held, index = [], []
    for tokens, *about in records:
        held.append(tokens)
        index.append(about)
    about = json.dumps(index, separators=(",", ":")).encode()
    content = b"".join([*held, about, b"%016x" % len(about)])
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([content], pa.binary())], ["shard", "content"])


def _join_pieces(pieces: list[tuple], length: int) -> Iterator[tuple]:
    """Records of (slot, at, sequence, doc_id, ids) in slot order; the last sequence is padded."""
    pieces.sort(key=lambda piece: piece[:2])
    for _, own in groupby(pieces, key=lambda piece: piece[0]):
        _, _, sequences, docs, ids = zip(*own, strict=True)
        ids = b"".join(ids)
        n_tokens = len(ids) // TOKEN_BYTES
        yield ids + np.full(length - n_tokens, END_OF_TEXT, "<u2").tobytes(), sequences[0], n_tokens, docs


def _unbundle(length: int):
    """The file of each shard, whose bundles arrive one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, now, pieces = pa.Codec("zstd"), None, []
        for batch in batches:
            for shard, slots, sequences, ats, sizes, docs, packed in zip(*(batch.column(c).to_pylist() for c in BUNDLE_NAMES), strict=True):
                if now is not None and now != shard:
                    yield _shard_file(now, _join_pieces(pieces, length))
                    pieces = []
                now, ids, begin = shard, codec.decompress(packed, sum(sizes) * TOKEN_BYTES, asbytes=True), 0
                for slot, sequence, at, size, doc in zip(slots, sequences, ats, sizes, docs, strict=True):
                    end = begin + size * TOKEN_BYTES
                    pieces.append((slot, at, sequence, doc, ids[begin:end]))
                    begin = end
        if now is not None:
            yield _shard_file(now, _join_pieces(pieces, length))

    return run


RECORD = "shard int, slot bigint, byte_offset bigint, sequence bigint, n_tokens int, doc_ids array<bigint>, tokens binary"


def training_records(
    docs: DataFrame,
    key: str,
    tokenizer: str = TOKENIZER,
    sequence_tokens: int = SEQUENCE_TOKENS,
    shard_sequences: int = SHARD_SEQUENCES,
) -> DataFrame:
    """(shard, slot, byte_offset, sequence, n_tokens, doc_ids, tokens) for each sequence, read back from shard files.

    The ids of all texts, an end mark after each, make one stream in the order the table is
    read, cut every ``sequence_tokens``; the last sequence is padded with end marks.  The keyed
    permutation of sequence numbers gives each its slot in training order; a shard holds
    ``shard_sequences`` slots in a row, and a record lies at slot within shard times the stride.
    Shards are dealt in ranges of neighbours; each is one task's sorted rows and one file in the
    shared scratch folder; the rows returned are those of the files.  Every column but doc_id and text is left behind; a null
    doc_id is a null in doc_ids; an empty table gives no sequences.

    Texts are encoded once into a staged table; only cut ids are shuffled, and once.  A task
    holds ``HELD_BYTES`` of ids until it sends them in compressed bundles, one or more a shard.
    """
    encoded = encode_documents(docs, tokenizer)
    sizes = encoded.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    if not total:
        return docs.sparkSession.createDataFrame([], RECORD)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = encoded.join(F.broadcast(bases), "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "tokens")
    sequences = -(-total // sequence_tokens)
    touched = F.sequence(F.expr(f"start div {sequence_tokens}"), F.expr(f"(start + n_tokens - 1) div {sequence_tokens}"))
    slots = F.transform(touched, lambda sequence: permute(sequence, max(1, sequences), key))
    bundles = placed.select("doc_id", "start", "tokens", slots.alias("slots")).mapInArrow(_bundle(sequence_tokens, shard_sequences), BUNDLE)
    dealt = _by_range(bundles, -(-sequences // shard_sequences)).sortWithinPartitions("shard")
    path = scratch_dir(docs.sparkSession, "training-shards")
    _write_files(dealt.mapInArrow(_unbundle(sequence_tokens), "shard int, content binary"), path)
    return read_shards(docs.sparkSession, path, sequence_tokens, shard_sequences)


def _by_range(rows: DataFrame, shards: int) -> DataFrame:
    """Rows in ranges of neighbouring shards, at most ``SHARDS_A_TASK`` in one, a shard never divided."""
    ranges = max(-(-shards // SHARDS_A_TASK), min(shards, rows.sparkSession.sparkContext.defaultParallelism))
    return rows.repartitionById(ranges, F.floor(F.col("shard").cast("bigint") * ranges / shards).cast("int"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The file of each shard, whose records arrive in slot order."""
    now, records = None, []
    for batch in batches:
        names = ("shard", "tokens", "sequence", "n_tokens", "doc_ids")
        for shard, *record in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if now is not None and now != shard:
                yield _shard_file(now, records)
                records = []
            now = shard
            records.append(record)
    if now is not None:
        yield _shard_file(now, records)


def _write_files(files: DataFrame, path: str) -> None:
    with small_batches(files.sparkSession):
        files.select("shard", F.col("content").cast("string").alias("value")).write.partitionBy("shard").text(path)


def write_shards(records: DataFrame, path: str) -> None:
    """One file for each shard: records in slot order, one after the other, so of one stride, and their index.

    Record k of a shard begins at k x bytes of a record.  Behind the last one are, as JSON, the
    sequence, size and doc_ids of each, and the size of that in 16 digits.  Spark's text writer
    puts out the bytes as they are and a line feed, on any store, and commits a shard when its
    task has succeeded.
    """
    shards = (records.agg(F.max("shard")).first()[0] or 0) + 1
    dealt = _by_range(records, shards).sortWithinPartitions("slot")
    files = dealt.select("shard", "tokens", "sequence", "n_tokens", "doc_ids").mapInArrow(_pack, "shard int, content binary")
    _write_files(files, path)


def _unpack(stride: int, shard_sequences: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "slot", "byte_offset", "sequence", "n_tokens", "doc_ids", "tokens"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                content = content.as_py()
                # The text writer's line feed is last.
                size = int(content[-17:-1], 16)
                end = len(content) - 17 - size
                about = json.loads(content[end : end + size])
                if end != len(about) * stride:
                    raise ValueError(f"shard {shard}: {end} bytes of records, {len(about)} of {stride} expected")
                for low in range(0, len(about), 1024):
                    part = range(low, min(low + 1024, len(about)))
                    rows = [(shard, shard * shard_sequences + k, k * stride, *about[k], content[k * stride : (k + 1) * stride]) for k in part]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def read_shards(spark, path: str, sequence_tokens: int = SEQUENCE_TOKENS, shard_sequences: int = SHARD_SEQUENCES, from_slot: int = 0) -> DataFrame:
    """The written records from ``from_slot`` on, as ``training_records`` has them: a run resumes where it stopped.

    Whole shards before the slot are pruned by folder.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    files = files.where(F.col("shard") >= from_slot // shard_sequences).select(F.col("shard").cast("int").alias("shard"), "content")
    return files.mapInArrow(_unpack(sequence_tokens * TOKEN_BYTES, shard_sequences), RECORD).where(F.col("slot") >= from_slot)
