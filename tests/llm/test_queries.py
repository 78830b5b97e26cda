"""The registered corpus queries against SQL, and the pipeline against its parts."""

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import __spark_entry__ as spark_entry  # noqa: E402
import check_oracles  # noqa: E402
import corpus_pipeline  # noqa: E402
from rollcall.llm.sql import ORACLES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
NAMES = [f"op{n}_" for n in range(1, 14)]


def test_every_operator_is_registered():
    names = set(spark_entry.queries())
    assert "pipeline" in names and all(sum(q.startswith(n) for q in names) == 1 for n in NAMES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    duck = check_oracles.open_duckdb(SF_DIR)
    assert check_oracles.difference(spark, duck, SF_DIR, name, ORACLES[name]) is None


def test_each_stage_works_on_what_its_predecessor_kept(spark, tmp_path):
    from rollcall.llm import decontamination, simhash, tokens, toxicity

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs
        if name != "training_order":
            assert docs.columns == before.columns
            assert docs.select("doc_id").distinct().join(before, "doc_id", "left_anti").count() == 0
    start = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    scored = toxicity.toxicity(start, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert ids(kept["toxicity"]) == ids(scored.where("predicted = 0"))
    groups = simhash.near_duplicate_groups(kept["toxicity"])
    assert ids(kept["near_duplicates"]) == ids(groups.where("doc_id = component_id"))
    leaks = decontamination.leaked_windows(kept["near_duplicates"], spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))
    assert ids(kept["decontamination"]) == ids(kept["near_duplicates"]) - ids(leaks) and ids(leaks)
    from test_tokens import decoded

    assert Counter(decoded(kept["training_order"].collect())) == Counter(r["text"] for r in kept["mixing"].collect())
    assert tokens.SEQUENCE_TOKENS * 2 == len(kept["training_order"].first()["tokens"])
