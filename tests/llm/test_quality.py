import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from rollcall.llm import quality


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    count = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i, t in enumerate(zip(words, words[1:], words[2:], strict=False)) if count[t] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_features_match_the_plain_form(docs):
    texts = [None, "", " \n\t", "a b c a b c", "x x x x", "one\ntwo\none\n\n\none ", "a#b $$ <c>", "é é é", "a b c d a b c ", "w " * 3000, "p q r s p q r t q r s"]
    featured = quality.document_features(docs(list(enumerate(texts)), lines=1)).collect()
    for r in featured:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain(texts[r["doc_id"]])
    assert quality.document_features(docs([])).count() == 0


def test_the_binomial_tail_is_exact(spark):
    for n, k, p in ((10, 3, 0.2), (500, 2, 0.01), (3, 3, 0.5), (20000, 60, 0.005)):
        tail = spark.range(1).select(quality.binomial_tail(F.lit(n).cast("bigint"), F.lit(k).cast("bigint"), p)).first()[0]
        exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log(1 - p)) for j in range(k + 1))
        assert math.isclose(tail, exact, rel_tol=1e-9)


def test_cutoffs_are_certified_where_labels_suffice(spark, docs):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{good} v{i}", "en", "s") for i in range(3000)] + [(5000 + i, f"{good} #%#%#%#% u{i}", "en", "s") for i in range(20)]
    rows += [(6000, f"{good} ####", "de", "s"), (6001, "short", "en", "s"), (None, good, "en", "s"), (6002, "a b c " * 40, None, "s"), (5, f"{good} v5", "en", "s")]
    labels = spark.createDataFrame([(i, 1) for i in range(3000)] + [(5001, 0), (9999, 1), (7, None), (None, 1), (3, 1)], "doc_id bigint, quality int")
    judged = quality.judge(docs(rows, kept=1) .drop("kept"), labels).collect()
    kept = {r["doc_id"]: r["kept"] for r in judged}
    assert len(judged) == len(rows)
    assert all(kept[i] for i in range(3000)) and not any(kept[5000 + i] for i in range(20))
    assert kept[6000] and kept[None] and not kept[6001] and not kept[6002]
    assert all(r["kept"] for r in quality.judge(docs(rows[:2]), labels.where("false")).collect())


def plain_step(row):
    """The first rule set that rejects, tried one after the other."""
    rates = {
        "symbol_rate": row["n_symbols"] * 1000 // row["word_chars"],
        "shout_rate": row["n_shouts"] * 1000 // row["n_words"],
        "repeat_rate": row["n_repeat_words"] * 1000 // row["n_words"],
        "dup_line_rate": row["n_dup_lines"] * 1000 // row["n_lines"],
    }
    path = [(name, cutoff) for name in rates for cutoff in range(980, -1, -20)]
    return next((k for k, (name, cutoff) in enumerate(path, 1) if rates[name] > cutoff), None)


def plain_certified(steps, strata, share=0.02, risk=0.05):
    """The last step before the first that fails, of each stratum, by exact sums."""

    def tail(n, k):
        return sum(math.comb(n, j) * share**j * (1 - share) ** (n - j) for j in range(k + 1))

    held = {s: [x for x, of in zip(steps, strata, strict=True) if of == s] for s in set(strata)}
    m = next(m for m in range(1, len(held) + 1) if sum(tail(len(v), 0) * m <= risk for v in held.values()) <= m)
    out = {}
    for s, v in held.items():
        out[s] = 0
        if tail(len(v), 0) <= risk / m:
            for step in range(1, 201):
                if tail(len(v), sum(x is not None and x <= step for x in v)) > risk / m:
                    break
                out[s] = step
    return out


def test_steps_match_tests_one_after_the_other(spark):
    rng = random.Random(9)
    rows, sizes = [], {"en": 900, "de": 320, "fr": 230, "es": 150, None: 180, "it": 40}
    for lang, size in sizes.items():
        for _ in range(size):
            odd = rng.random()
            rows.append(
                {
                    "doc_id": len(rows), "lang": lang, "n_words": 100, "word_chars": 500, "n_lines": 10,
                    "n_symbols": rng.randrange(60) if odd < 0.004 else 0, "n_shouts": rng.randrange(30) if odd > 0.995 else 0,
                    "n_repeat_words": rng.randrange(50) if 0.5 < odd < 0.53 else 0, "n_dup_lines": rng.randrange(5) if odd < 0.02 else 0,
                }
            )
    featured = spark.createDataFrame(
        rows, "doc_id long, lang string, n_words long, word_chars long, n_lines long, n_symbols long, n_shouts long, n_repeat_words long, n_dup_lines long"
    )
    got = {r["doc_id"]: r["s"] for r in featured.select("doc_id", quality.first_rejection().alias("s")).collect()}
    steps = [plain_step(r) for r in rows]
    assert [got[r["doc_id"]] for r in rows] == steps
    certified = {r["stratum"]: r for r in quality.certified_steps(featured, featured.selectExpr("doc_id", "1 AS quality"), "lang").collect()}
    want = plain_certified(steps, [r["lang"] for r in rows])
    assert {s: r["step"] for s, r in certified.items()} == want
    assert want["en"] > 50 and want["it"] == 0 and certified["it"]["symbol_rate_cutoff"] is None
    assert certified["en"]["symbol_rate_cutoff"] == 0 and certified["en"]["holdout"] == 900
    assert quality.certified_steps(featured, featured.selectExpr("doc_id", "0 AS quality"), "lang").count() == 0


def test_columns_named_like_results_are_replaced(spark, docs):
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    rows = docs([(1, "a b"), (2, "w " * 60)], n_words=7, kept="'x'", step=3, stratum="'z'", _step=1, _stratum=2, _text="'t'", _lines=4)
    got = {r["doc_id"]: (r["n_words"], r["kept"], r["step"], r["_step"], r["_text"], r["_lines"]) for r in quality.judge(rows, labels).collect()}
    assert got[1] == (2, False, 3, 1, "t", 4) and got[2][0] == 60
