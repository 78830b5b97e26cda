from pyspark.sql import functions as F

from rollcall.llm import mixing

def flat():
    return {"domain": F.lit(1), "lang": F.lit(1), "source": F.lit(1)}


def test_shortages_go_to_siblings_before_ancestors(spark):
    leaves = [("a", "en", "s1", 10), ("a", "en", "s2", 1000), ("a", "de", "s1", 1000), ("b", "en", "s1", 1000), ("c", None, None, 0)]
    frame = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens bigint")
    found = {tuple(r)[:3]: r["budget"] for r in mixing.leaf_budgets(frame, flat(), F.lit(800), 1).collect()}
    # a and b get 400 each; a's languages 200 each; s1 has 10, so its sibling takes the other 190.
    assert found == {("a", "en", "s1"): 10, ("a", "en", "s2"): 190, ("a", "de", "s1"): 200, ("b", "en", "s1"): 400}
    every = mixing.leaf_budgets(frame, flat(), F.lit(10**9), 1).agg(F.sum("budget")).first()[0]
    assert every == 3010


def test_prefixes_fit_and_epochs_repeat(docs):
    rows = [(i, "w " * (1 + i % 5), "en", "hot") for i in range(300)] + [(1000 + i, "v " * 4, "de", "cold") for i in range(10)]
    rows += [(None, "n n", None, None), (2000, None, "en", "hot"), (2001, "", "de", "cold"), (5, "w", "en", "hot"), (5, "w", "en", "hot")]
    chosen = mixing.mix(docs(rows, tokens=1, budget=2, key=3), F.lit("d"), flat(), F.lit(400), "seed", max_epochs=2, buckets=16)
    found = chosen.collect()
    spent = {}
    for r in found:
        spent[r["source"]] = spent.get(r["source"], 0) + r["_mix_tokens"]
    # Three languages share 400: the null one and the cold one have 4 and 80 at two epochs.
    assert spent["cold"] == 80 and spent[None] == 4 and 310 <= spent["hot"] <= 316
    assert max(r["_mix_epoch"] for r in found if r["source"] == "cold") == 2
    assert chosen.columns[: len(docs(rows).columns)] == docs(rows).columns
    for buckets in (2, 4096):
        again = mixing.mix(docs(rows[::-1], tokens=1, budget=2, key=3), F.lit("d"), flat(), F.lit(400), "seed", 2, buckets)
        assert sorted(map(str, again.collect())) == sorted(map(str, found))
    assert mixing.mix(docs([]), F.lit("d"), flat(), F.lit(400), "seed").count() == 0


def test_a_leaf_without_tokens_is_kept_once(docs):
    rows = [(1, "a b", "en", "s1"), (2, "", "en", "s2"), (3, None, None, None), (4, "  ", "de", "s1"), (5, "c", None, "s1")]
    for budget in (0, 10**9):
        chosen = mixing.mix(docs(rows), F.lit("d"), flat(), F.lit(budget), "seed", max_epochs=2).collect()
        assert sorted(r["doc_id"] for r in chosen if r["_mix_tokens"] == 0) == [2, 3, 4]
        assert len(chosen) == (3 if budget == 0 else 7)
    assert mixing.mix(docs([(1, ""), (1, None)]), F.lit("d"), flat(), F.lit(5), "seed").count() == 2
