"""Exact substring removal: Burrows-Wheeler interval expansion over the fragments that may repeat.

A string of ``length`` bytes that occurs in two texts has the same anchor in both: the least of
the hashes of its 20-byte pieces.  So a text is cut into fragments, maximal runs of windows with
one anchor, and windows can only be equal inside fragments of one anchor.  Anchors that one text
alone holds are dropped; the rest are dealt out by anchor, and each part is a bounded text whose
Burrows-Wheeler transform is expanded breadth-first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import small_batches, staged, text_or_empty

LENGTH = 50
#: Bytes hashed together: a run of 16 and one of 4.
PIECE, LONG, SHORT = 20, 16, 4
#: Text bytes an anchor bucket, and fragment bytes a transform, are made for.
BUCKET_BYTES = 32 << 20
FRAGMENT_BYTES = 1 << 20
#: Bytes of text hashed at once; longer texts are taken in overlapping stretches.
STRETCH = 1 << 20
#: Documents up to which a list of their ids is broadcast to leave texts out of a shuffle.
LISTED_DOCS = 1_000_000

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * _M2
    return values ^ (values >> np.uint64(29))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    extra = width - reach
    return np.minimum(values[: values.size - extra], values[extra:]) if extra else values


def window_anchors(data: np.ndarray, length: int) -> np.ndarray:
    """The anchor of each window of ``length`` bytes: the least mixed hash of its 20-byte pieces."""
    with np.errstate(over="ignore"):
        hashes, multiplier, size = (data.astype(np.uint64) + np.uint64(1)) * _M2, _M1, 1
        while size < LONG:
            hashes = hashes[:-size] * multiplier + hashes[size:]
            multiplier, size = multiplier * multiplier, size * 2
            if size == SHORT:
                short, shift = hashes, multiplier
        count = data.size - PIECE + 1
        hashes = hashes[:count] * shift + short[LONG : LONG + count]
        return _sliding_min(_mix(hashes), length - PIECE + 1)


def _runs(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the maximal runs of windows with one anchor, closed by the window count; their anchors."""
    count = len(text) - length + 1
    if count <= 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint64)
    data = np.frombuffer(text, np.uint8)
    starts, anchors = [], []
    for at in range(0, count, STRETCH):
        got = window_anchors(data[at : at + STRETCH + length - 1], length)
        cut = np.flatnonzero(np.concatenate(([True], got[1:] != got[:-1])))
        starts.append(cut + at)
        anchors.append(got[cut])
    start, anchor = np.concatenate(starts), np.concatenate(anchors)
    fresh = np.concatenate(([True], anchor[1:] != anchor[:-1]))
    with np.errstate(over="ignore"):
        # Least hashes crowd near zero; another mix spreads them evenly for dealing out.
        return np.append(start[fresh], count), _mix(anchor[fresh] * _M1)


def _blocks(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of many texts at once: (text, start, end, anchor); texts share one hashed stretch."""
    owner, begin, end, anchor = [], [], [], []
    small: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal small, held
        if not small:
            return
        sizes = np.array([len(texts[i]) for i in small])
        data = np.frombuffer(b"".join(texts[i] for i in small), np.uint8)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        if data.size >= length:
            got = window_anchors(data, length)
            changed = got[1:] != got[:-1]
            inner = begins[1:]
            changed[inner[inner < got.size] - 1] = True
            first = np.concatenate(([0], np.flatnonzero(changed) + 1))
            last = np.append(first[1:], got.size)
            text = np.searchsorted(ends, first, side="right")
            inside = first + length <= ends[text]
            first, last, text = first[inside], last[inside], text[inside]
            last = np.minimum(last, ends[text] - length + 1)
            owner.append(np.array(small)[text])
            begin.append(first - begins[text])
            end.append(last - begins[text])
            with np.errstate(over="ignore"):
                anchor.append(_mix(got[first] * _M1))
        small, held = [], 0

    for i, text in enumerate(texts):
        if len(text) > STRETCH:
            start, anchors = _runs(text, length)
            owner.append(np.full(anchors.size, i))
            begin.append(start[:-1])
            end.append(start[1:])
            anchor.append(anchors)
        elif len(text) >= length:
            small.append(i)
            held += len(text)
            if held >= STRETCH // 4:
                flush()
    flush()
    if not owner:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    return np.concatenate(owner), np.concatenate(begin), np.concatenate(end), np.concatenate(anchor)


def _bytes_of(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted table's rows begin to differ from the row before."""
    if not columns[0].size:
        return np.zeros(0, np.int64)
    differs = np.zeros(columns[0].size - 1, bool)
    for c in columns:
        differs |= c[1:] != c[:-1]
    return np.flatnonzero(np.concatenate(([True], differs)))


def _binary_batch(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in schema])


ANCHOR_LISTS = "bucket int, told boolean, texts binary, counts binary, anchors binary"


def _named(bucket: np.ndarray, low: np.ndarray) -> np.ndarray:
    """An anchor's name: its bucket and 32 bits of its hash.  Two anchors of one name only cost work."""
    return (bucket.astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)


def _anchor_names(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return _named((anchor >> np.uint64(32)) % np.uint64(buckets), anchor & np.uint64(0xFFFFFFFF))


def _anchor_lists(buckets: int, length: int):
    """Anchors of each batch by bucket: keys of texts, how many anchors each has, and those.

    An anchor that one text of the batch holds goes to its bucket with that text.  Of one that
    several hold, the bucket gets two of the texts, enough to know that it repeats, and all of
    them are told apart, in a list that any bucket can pass on.
    """
    kinds = [("bucket", pa.int32()), ("told", pa.bool_()), ("texts", pa.binary()), ("counts", pa.binary()), ("anchors", pa.binary())]

    def listed(bucket: int, told: bool, key: np.ndarray, name: np.ndarray) -> tuple:
        first = _changes(key)
        counts = np.diff(np.append(first, key.size)).astype(np.int32)
        names = name if told else name.astype(np.uint32)
        return (bucket, told, key[first].tobytes(), counts.tobytes(), names.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, _, _, anchor = _blocks(_bytes_of(batch.column("text")), length)
            key = batch.column("key").to_numpy(zero_copy_only=False)[owner]
            name = _anchor_names(anchor, buckets)
            order = np.lexsort((key, name))
            key, name = key[order], name[order]
            fresh = _changes(name, key)
            key, name = key[fresh], name[fresh]
            first = _changes(name)
            sizes = np.diff(np.append(first, name.size))
            several = np.repeat(sizes > 1, sizes)
            sent = np.arange(name.size) - np.repeat(first, sizes) < 2
            rows = []
            if several.any():
                order = np.argsort(key[several], kind="stable")
                told_key, told = key[several][order], name[several][order]
                rows.append(listed(int(told[0] % np.uint64(buckets)), True, told_key, told))
            key, name = key[sent], name[sent]
            order = np.lexsort((key, name >> np.uint64(32)))
            key, name = key[order], name[order]
            edges = np.searchsorted(name >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                rows.append(listed(b, False, key[edges[b] : edges[b + 1]], name[edges[b] : edges[b + 1]]))
            if rows:
                yield _binary_batch(kinds, rows)

    return run


def _repeated_anchors(lists: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: for each text, the anchors that other texts hold too."""

    def read(rows: pd.DataFrame, kind) -> tuple[np.ndarray, np.ndarray]:
        texts = np.frombuffer(b"".join(rows["texts"]), np.int64)
        counts = np.frombuffer(b"".join(rows["counts"]), np.int32)
        return np.repeat(texts, counts), np.frombuffer(b"".join(rows["anchors"]), kind)

    known_key, known = read(lists[lists["told"]], np.uint64)
    key, low = read(lists[~lists["told"]], np.uint32)
    order = np.argsort(low, kind="stable")
    key, low = key[order], low[order]
    first = _changes(low)
    if first.size:
        sizes = np.diff(np.append(first, low.size))
        repeated = np.repeat(np.minimum.reduceat(key, first) != np.maximum.reduceat(key, first), sizes)
        key, low = key[repeated], low[repeated]
    bucket = np.uint64(lists["bucket"].iloc[0])
    key, name = np.concatenate((key, known_key)), np.concatenate((_named(np.full(low.size, bucket), low), known))
    order = np.argsort(key, kind="stable")
    key, name = key[order], name[order]
    starts = _changes(key)
    ends = np.append(starts[1:], key.size)
    return pd.DataFrame({"key": key[starts], "anchors": [name[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]})


PIECES = "anchor bigint, fragment binary, docs array<bigint>, keys array<smallint>, begins array<int>"


def _fragments(buckets: int, length: int):
    """Per batch: each distinct fragment with a repeated anchor, and where it stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _bytes_of(batch.column("text"))
            docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
            keys = batch.column("key").to_numpy(zero_copy_only=False).astype(np.int16)
            wanted = [np.frombuffer(b"".join(x), np.uint64) for x in batch.column("anchors").to_pylist()]
            owner, begin, end, anchor = _blocks(texts, length)
            with np.errstate(over="ignore"):
                name = _anchor_names(anchor, buckets)
                salt = _mix(np.arange(len(texts), dtype=np.uint64) * _M1)
                known = [a ^ salt[i] for i, a in enumerate(wanted)]
                keep = np.flatnonzero(np.isin(name ^ salt[owner], np.concatenate(known) if known else name[:0]))
            owner, begin, end, name = owner[keep], begin[keep], end[keep], name[keep]
            number: dict[bytes, int] = {}
            which = [
                number.setdefault(texts[i][a:b], len(number))
                for i, a, b in zip(owner.tolist(), begin.tolist(), (end + (length - 1)).tolist(), strict=True)
            ]
            if not which:
                continue
            which = np.array(which)
            order = np.argsort(which, kind="stable")
            first = _changes(which[order])
            offsets = pa.array(np.append(first, order.size).astype(np.int32))
            places = [
                pa.ListArray.from_arrays(offsets, pa.array(c[order]))
                for c in (docs[owner], keys[owner], begin.astype(np.int32))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[order[first]].view(np.int64)), pa.array(list(number), pa.binary()), *places],
                ["anchor", "fragment", "docs", "keys", "begins"],
            )

    return run


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols or more, by prefix doubling.

    Only suffixes that still tie are sorted again; they keep the places their group has.
    """
    taken = 7
    padded = np.concatenate((symbols.astype(np.uint64), np.zeros(taken, np.uint64)))
    key = padded[: symbols.size]
    for k in range(1, taken):
        key = (key << np.uint64(9)) | padded[k : k + symbols.size]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    fresh = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    while taken < depth:
        tied = np.flatnonzero(~fresh | ~np.append(fresh[1:], True))
        if not tied.size:
            break
        rank = np.zeros(order.size + 1, np.int64)
        rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(order.size), 0)) + 1
        here = order[tied]
        key = (rank[here] << 32) | rank[np.minimum(here + taken, order.size)]
        by = np.argsort(key, kind="stable")
        order[tied] = here[by]
        ranked = key[by]
        fresh[tied] = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        taken *= 2
    return order


def equal_prefix_classes(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order, and for each place in it the class of suffixes with one ``length``-symbol prefix.

    Breadth-first over the transform: the intervals of strings of k + 1 symbols come from those
    of k by one step of backward extension.  Neighbours in order that begin with one symbol stay
    together if what follows lies in one interval.  A boundary first seen at step k is where the
    common prefix is k - 1 long, so prefix lengths appear in increasing order; after ``length``
    steps every pair still together shares ``length`` symbols, and no step goes further.
    """
    order = suffix_order(symbols, length)
    transform = symbols[order - 1]
    extended = np.argsort(transform, kind="stable")
    leading = transform[extended]
    edge = np.concatenate(([True], leading[1:] != leading[:-1]))
    undecided = np.flatnonzero(~edge)
    for _ in range(1, length):
        interval = np.cumsum(edge, dtype=np.int32)
        parted = interval[extended[undecided]] != interval[extended[undecided - 1]]
        if not parted.any():
            break
        edge[undecided[parted]] = True
        undecided = undecided[~parted]
    return order, np.cumsum(edge, dtype=np.int64) - 1


def _first_docs(length: int):
    """Per part: for the windows of each distinct fragment, the least doc_id that holds the same bytes.

    Rows are (from, upto, first) over the windows of fragments some window of which is earlier
    than their own last document.
    """

    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        merged = pieces.groupby("fragment", sort=False).agg(fid=("fid", "first"), low=("first_doc", "min"), high=("last_doc", "max"))
        fragments, fids = merged.index.tolist(), merged["fid"].to_numpy()
        low, high = merged["low"].to_numpy(np.int64), merged["high"].to_numpy(np.int64)
        sizes = np.array([len(f) + 1 for f in fragments])
        starts = np.cumsum(sizes) - sizes
        symbols = np.zeros(int(sizes.sum()), np.uint16)
        owner = np.repeat(np.arange(sizes.size), sizes)
        inside = np.ones(symbols.size, bool)
        inside[starts + sizes - 1] = False
        symbols[inside] = np.frombuffer(b"".join(fragments), np.uint8).astype(np.uint16) + 1
        order, classes = equal_prefix_classes(symbols, length)
        of = owner[order]
        begins = order - starts[of] < (sizes - length)[of]
        doc = np.where(begins, low[of], np.iinfo(np.int64).max)
        firsts = np.empty(symbols.size, np.int64)
        firsts[order] = np.minimum.reduceat(doc, _changes(classes))[classes]
        window = np.arange(symbols.size) - starts[owner]
        valid = window < (sizes - length)[owner]
        owner, window, firsts = owner[valid], window[valid], firsts[valid]
        at = _changes(owner, firsts)
        mine, begin, first = owner[at], window[at], firsts[at]
        upto = window[np.append(at[1:], owner.size) - 1] + 1
        earlier = first < high[mine]
        mine, begin, upto, first = mine[earlier], begin[earlier], upto[earlier], first[earlier]
        return pd.DataFrame({"fid": fids[mine], "from": begin, "upto": upto, "first": first})

    return run


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove the covered bytes of each text."""
    names = ["doc_id", "key", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        rows = []
        for doc, key, text, ranges in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "text", "ranges")), strict=True):
            text = text.encode() if isinstance(text, str) else text
            cover = sorted((r["start"], r["stop"]) for r in ranges)
            kept, at, removed, spans = [], 0, 0, 0
            for start, stop in cover:
                if start > at or not spans:
                    kept.append(text[at:start])
                    spans += 1
                    at = start
                if stop > at:
                    removed += stop - at
                    at = stop
            kept.append(text[at:])
            rows.append((doc, key, removed, spans, hashlib.sha256(b"".join(kept)).hexdigest()))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield _binary_batch(list(zip(names, kinds, strict=True)), rows)


def _listed(texts: DataFrame, places: DataFrame) -> DataFrame:
    """Texts whose doc_id is among the places, if a list of those is small enough to send; else all.

    The join that follows takes the same rows either way; a short list spares the shuffle the rest.
    """
    ids = places.select("_doc").distinct()
    if ids.limit(LISTED_DOCS + 1).count() > LISTED_DOCS:
        return texts
    return texts.join(F.broadcast(ids.withColumnRenamed("_doc", "_listed")), F.col("doc_id") == F.col("_listed"), "left_semi")


def remove_repeats(docs: DataFrame, length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES, fragment_bytes: int = FRAGMENT_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row.

    A byte of a text's UTF-8 form is removed if a string of ``length`` bytes that covers it also
    starts in a document with a lesser doc_id.  Equal texts are known by their SHA-256: all but
    those with the least doc_id are covered whole, and only one of them is searched.  A null text
    is empty.  A null doc_id is neither less nor more than another: its row is kept whole and
    covers nothing.  Repeated rows get equal results; rows that share a doc_id but not a text do
    not cover each other.

    Buckets of anchors and parts of fragments grow in number, not in size.  An anchor that very
    many texts hold reaches its bucket as two rows for each batch of texts at most, and a
    fragment reaches its part once for each batch.
    """
    text = text_or_empty()
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key"))
    facts = staged(
        keyed.select("doc_id", "key", F.sha2(text, 256).alias("sha"), F.octet_length("text").cast("bigint").alias("n_bytes")), "repeat-facts"
    )
    firsts = facts.groupBy("sha", "key", "n_bytes").agg(F.min("doc_id").alias("first"))
    total = firsts.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(16, -(-total // bucket_bytes))
    # Enough of the key to tell apart texts that share a doc_id.
    short_key = F.col("key").bitwiseAND(F.lit(0x7FFF)).cast("smallint")
    with small_batches(docs.sparkSession, "6m"):
        searched = keyed.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length))
        lists = searched.select("key", "text").mapInArrow(_anchor_lists(buckets, length), ANCHOR_LISTS)
        found = lists.groupBy("bucket").applyInPandas(_repeated_anchors, "key bigint, anchors binary")
        repeated = found.groupBy("key").agg(F.collect_list("anchors").alias("anchors"))
        places = staged(
            firsts.where("first is not null").join(repeated, "key").select(F.col("first").alias("_doc"), F.col("key").alias("_key"), "anchors"),
            "repeat-anchors",
        )
        held = _listed(searched, places)
        held = held.join(places, (held["doc_id"] == places["_doc"]) & (held["key"] == places["_key"]))
        held = held.select("doc_id", short_key.alias("key"), "text", "anchors")
        pieces = held.mapInArrow(_fragments(buckets, length), PIECES).withColumn("fid", F.xxhash64("fragment", "anchor"))
        pieces = staged(pieces, "repeat-pieces", compression="zstd")
        bulk = pieces.agg(F.sum(F.octet_length("fragment").cast("bigint"))).first()[0] or 0
        parts = max(1, -(-bulk // fragment_bytes))
        dealt = pieces.select(
            "fid",
            "fragment",
            F.array_min("docs").alias("first_doc"),
            F.array_max("docs").alias("last_doc"),
            F.pmod(F.xxhash64("anchor"), F.lit(parts)).cast("int").alias("part"),
        )
        earlier = dealt.groupBy("part").applyInPandas(_first_docs(length), "fid bigint, from int, upto int, first bigint")
        stands = pieces.select("fid", F.inline(F.arrays_zip("docs", "keys", "begins")))
        hit = stands.join(earlier, "fid").where(F.col("first") < F.col("docs"))
        span = F.struct(
            (F.col("begins") + F.col("from")).cast("bigint").alias("start"),
            (F.col("begins") + F.col("upto") + (length - 1)).cast("bigint").alias("stop"),
        )
        ranges = hit.groupBy(F.col("docs").alias("_doc"), F.col("keys").alias("_key")).agg(F.collect_list(span).alias("ranges"))
        ranges = staged(ranges, "repeat-ranges")
        texts = _listed(searched, ranges).withColumn("short", short_key)
        cut = texts.join(ranges, (texts["doc_id"] == ranges["_doc"]) & (texts["short"] == ranges["_key"]))
        cut = cut.select("doc_id", "key", "text", "ranges").mapInArrow(
            _cut_out, "doc_id bigint, key bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
        )
        cut = staged(cut, "repeat-cut").dropDuplicates(["doc_id", "key"]).withColumnsRenamed({"doc_id": "_doc", "key": "_key"})
    owners = firsts.select(F.col("sha").alias("_sha"), "first")
    row = facts.join(owners, facts["sha"] == owners["_sha"]).join(
        cut, (facts["doc_id"] == cut["_doc"]) & (facts["key"] == cut["_key"]), "left"
    )
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_bytes") >= length)
    return row.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
