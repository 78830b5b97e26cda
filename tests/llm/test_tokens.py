import json
from collections import Counter

import numpy as np
import pyarrow as pa

from rollcall.llm import tokens as K


def decoded(records):
    encoder = K.load_encoder(open(K.TOKENIZER, "rb").read())
    rows = sorted(records, key=lambda r: r["sequence"])
    ids = np.concatenate([np.frombuffer(r["tokens"], "<u2")[: r["n_tokens"]] for r in rows]) if rows else []
    texts, start = [], 0
    for end in np.flatnonzero(np.array(ids) == K.END_OF_TEXT):
        texts.append(encoder.decode(ids[start:end].tolist()))
        start = end + 1
    return texts


def test_records_hold_every_text_in_one_stream(spark, docs, tmp_path):
    texts = ["", None, "hello <|endoftext|> world", "é😀 " * 200, "one two", "one two", "z" * 5000, *[f"text number {i}" for i in range(300)]]
    frame = docs([(i if i else None, t) for i, t in enumerate(texts)], tokens=1, slot=2, part=3)
    records = K.training_records(frame, "key", sequence_tokens=64, shard_sequences=8)
    rows = records.collect()
    assert Counter(decoded(rows)) == Counter(t or "" for t in texts)
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    assert all(len(r["tokens"]) == 128 and r["shard"] == r["slot"] // 8 and r["byte_offset"] == r["slot"] % 8 * 128 for r in rows)
    assert all(r["n_tokens"] == 64 for r in rows if r["sequence"] < len(rows) - 1)
    assert {d for r in rows for d in r["doc_ids"]} == {i if i else None for i in range(len(texts))}
    assert [r["sequence"] for r in sorted(rows, key=lambda r: r["slot"])] != list(range(len(rows)))
    K.write_shards(records, str(tmp_path / "shards"))
    back = {r["slot"]: r["tokens"] for r in K.read_shards(spark, str(tmp_path / "shards"), 64, 8).collect()}
    assert back == {r["slot"]: r["tokens"] for r in rows}
    resumed = K.read_shards(spark, str(tmp_path / "shards"), 64, 8, from_slot=13)
    assert sorted(r["slot"] for r in resumed.collect()) == list(range(13, len(rows)))


def test_rows_come_from_files_and_lie_at_their_offsets(spark, docs, monkeypatch):
    paths = []
    make = K.scratch_dir
    monkeypatch.setattr(K, "scratch_dir", lambda spark, name: paths.append(make(spark, name)) or paths[-1])
    rows = K.training_records(docs([(i, f"text number {i}\n é " * 9) for i in range(200)]), "key", sequence_tokens=64, shard_sequences=8).collect()
    assert len(rows) > 16 and len(paths) == 1
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(paths[0]).collect()
    content = {int(r["shard"]): bytes(r["content"]) for r in files}
    assert len(files) == len(content) == len({r["shard"] for r in rows})
    for r in rows:
        assert content[r["shard"]][r["byte_offset"] : r["byte_offset"] + 128] == bytes(r["tokens"])
        assert r["doc_ids"] and r["doc_ids"] == sorted(r["doc_ids"])


def test_an_empty_table(docs):
    assert K.training_records(docs([]), "key").count() == 0


def test_long_runs_of_white_space_encode_as_the_rule_says(monkeypatch):
    import re

    encoder = K.load_encoder(open(K.TOKENIZER, "rb").read())
    texts = [a + run + b for a in ("", "word", "1 ") for b in ("", "next", "\nx", "?!") for run in (" " * 9, "\n" * 7, " \n\t     ", "\r\n" * 5)]
    monkeypatch.setattr(K, "_LONG_RUNS", re.compile(f"[{K.BLANKS}]{{3,}}"))
    for text in texts:
        assert K.encode_text(encoder, text) == encoder.encode_ordinary(text)


def test_very_long_runs_survive(spark, docs):
    texts = [" " * 10_000_000, "a" + "\n" * 10_000_000 + "b", "x" * 10_000_000, "end"]
    rows = K.training_records(docs(list(enumerate(texts))), "key").collect()
    assert Counter(decoded(rows)) == Counter(texts)


def test_shards_are_dealt_in_ranges(spark, monkeypatch):
    rows = spark.range(1000).selectExpr("CAST(id % 50 AS INT) AS shard")
    for a_task, ranges in ((16, 4), (5, 10), (1, 50)):
        monkeypatch.setattr(K, "SHARDS_A_TASK", a_task)
        dealt = K._by_range(rows, 50).selectExpr("shard", "spark_partition_id() AS task").distinct().collect()
        tasks = [task for _, task in sorted(map(tuple, dealt))]
        assert len(tasks) == 50 and tasks == sorted(tasks) and len(set(tasks)) == ranges
        assert max(Counter(tasks).values()) <= max(a_task, -(-50 // ranges))


def test_pieces_of_a_shard_travel_in_compressed_bundles(monkeypatch):
    monkeypatch.setattr(K, "HELD_BYTES", 6000)
    monkeypatch.setattr(K, "BUNDLE_BYTES", 2500)
    length, a_shard = 64, 4
    stream = np.tile(np.arange(50, dtype="<u2"), 400)[:19_990]
    cuts = [0, 0, 1, 63, 64, 65, 900, 12_000, stream.size]
    docs = [(i if i % 3 else None, a, stream[a:b].tobytes()) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
    slot_of = lambda sequence: sequence * 5 % 313
    slots = [[slot_of(k) for k in range(a // length, (a + len(ids) // 2 - 1) // length + 1)] for _, a, ids in docs]
    rows = [pa.array(c, k) for c, k in zip([*zip(*docs, strict=True), slots], (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())), strict=True)]
    whole = pa.RecordBatch.from_arrays(rows, ["doc_id", "start", "tokens", "slots"])
    sent = list(K._bundle(length, a_shard)(iter([whole.slice(0, 3), whole.slice(3)])))
    bundles = [b for batch in sent for b in batch.to_pylist()]
    assert len(bundles) > len({b["shard"] for b in bundles})
    assert sum(len(b["ids"]) for b in bundles) < 0.7 * stream.nbytes
    assert all(sum(b["sizes"]) * 2 <= 2500 + length * 2 for b in bundles)
    table = pa.Table.from_batches(sent).sort_by("shard").to_batches(max_chunksize=3)
    files = [(f["shard"], f["content"]) for batch in K._unbundle(length)(iter(table)) for f in batch.to_pylist()]
    assert len(files) == len({shard for shard, _ in files})
    records = {}
    for shard, content in files:
        size = int(content[-16:], 16)
        for k, (sequence, n_tokens, doc_ids) in enumerate(json.loads(content[-16 - size : -16])):
            records[sequence] = (shard, n_tokens, doc_ids, content[k * length * 2 : (k + 1) * length * 2])
    assert sorted(records) == list(range(313))
    for sequence, (shard, n_tokens, doc_ids, ids) in records.items():
        low, high = sequence * length, min((sequence + 1) * length, stream.size)
        assert shard == slot_of(sequence) // a_shard and n_tokens == high - low
        assert ids == stream[low:high].tobytes() + np.full(length - n_tokens, K.END_OF_TEXT, "<u2").tobytes()
        assert doc_ids == [d for d, a, own in docs if a < high and a + len(own) // 2 > low]
