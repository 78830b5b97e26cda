import random

import numpy as np

from rollcall.llm import toxicity as T

INSULTS = ["gromblat", "snivok", "durf"]


def sentence(rng, word=None):
    parts = ["".join(rng.choice(("ta", "lo", "mi", "re", "sa", "ne")) for _ in range(rng.randint(1, 4))) for _ in range(8)]
    if word:
        parts[rng.randrange(8)] = word
    return " ".join(parts) + "."


def corpus(n, seed, change=lambda w, rng: w):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        toxic = i % 3 == 0
        texts = [sentence(rng) for _ in range(4)]
        if toxic:
            texts[rng.randrange(4)] = sentence(rng, change(rng.choice(INSULTS), rng))
        rows.append((i, " ".join(texts), int(toxic)))
    return rows


def right(model, rows):
    scores = T.score_texts([r[1] for r in rows], model, T.Kernel(list(model.landmarks)))
    return float(np.mean((scores >= 0.5) == np.array([r[2] == 1 for r in rows])))


def test_held_out_accuracy_and_gapped_insults():
    rows = corpus(300, 1)
    model = T.train([r[1] for r in rows], [r[2] for r in rows])
    assert right(model, corpus(150, 2)) > 0.97
    assert right(model, corpus(150, 3, lambda w, rng: " ".join(w))) > 0.97  # g r o m b l a t
    assert right(model, corpus(150, 4, lambda w, rng: ".".join(w))) > 0.97
    inserted = lambda w, rng: (lambda k: w[:k] + "x" + w[k:])(len(w) - 1)
    assert right(model, corpus(150, 5, inserted)) > 0.85


def recall(model, change):
    rows = [r for r in corpus(300, 6, change) if r[2]]
    return right(model, rows), right(model, [r for r in corpus(300, 8) if not r[2]])


def test_every_number_of_inserted_letters_and_short_runs():
    rows = corpus(300, 1)
    model = T.train([r[1] for r in rows], [r[2] for r in rows])
    for count in range(1, 8):

        def put(word, rng, letter, count=count):
            gaps = set(rng.sample(range(1, len(word)), min(count, len(word) - 1)))
            return "".join((letter(rng) if i in gaps else "") + c for i, c in enumerate(word))

        for letter in (lambda rng: "x", lambda rng: rng.choice("abcdefghijklmnopqrstuvwxyz")):
            found, clean = recall(model, lambda w, rng, f=letter, put=put: put(w, rng, f))
            print(count, found, clean)
            assert found > 0.95 and clean > 0.97
    for change in (lambda w, rng: " ".join(w[i : i + 2] for i in range(0, len(w), 2)), lambda w, rng: f"{w[:2]} {w[2:4]} " + " ".join(w[4:])):
        found, clean = recall(model, change)
        print(found, clean)
        assert found > 0.9 and clean > 0.97


def test_the_kernel_counts_weighted_common_subsequences():
    kernel = T.Kernel(["abc"])
    same, gapped, other = kernel.similarities(["abc", "axbc", "xyz"])[:, 0]
    assert abs(same - 1) < 1e-6 and 0.3 < gapped < 1 and other == 0
    long = kernel.similarities(["qabcq"])[0, 0]
    assert long < 1


def test_operator_edges(spark, docs):
    rows = corpus(120, 7)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows] + [(None, 1), (500, None), (9999, 1)], "doc_id bigint, toxic int")
    more = [(500, None), (501, ""), (502, "12 %% !"), (None, sentence(random.Random(1), "snivok")), (3, rows[3][1]), (503, "ta lo " * 50_000)]
    frame = docs([(i, t) for i, t, _ in rows] + more, score=1, toxicity=2, toxic=0)
    found = T.toxicity(frame, labels).collect()
    assert len(found) == len(rows) + len(more)
    by = {r["doc_id"]: r for r in found}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    assert by[None]["predicted"] == 1 and not by[None]["held_out"]
    assert by[500]["score"] == by[501]["score"] == by[502]["score"] < 0.5 and by[503]["predicted"] == 0
    kept = T.without_toxic(frame, labels)
    assert kept.columns == frame.columns and kept.count() == sum(r["predicted"] == 0 for r in found)
    assert T.toxicity(docs([]), labels).count() == 0
    one = T.toxicity(frame, labels.where("false")).select("score").distinct().count()
    assert one == 1


def test_landmarks_and_features_equal_the_plain_way():
    rows = corpus(120, 9)
    texts, labels = [r[1] for r in rows], np.array([r[2] for r in rows])
    counts = [{}, {}]
    for text, label in zip(texts, labels, strict=True):
        words = {w for s in T._sentences(text) for w in s}
        for gram in {w[i : i + n] for w in words for n in range(4, T.WINDOW + 1) for i in range(len(w) - n + 1)}:
            counts[label][gram] = counts[label].get(gram, 0) + 1
    n = [(labels == k).sum() for k in (0, 1)]

    def telling(gram):
        p, q = counts[1].get(gram, 0) / n[1], counts[0].get(gram, 0) / n[0]
        return ((p - q) / ((p + q) / 2 + 0.01) ** 0.5, len(gram), gram)

    chosen = T._landmarks(texts, labels, T.LANDMARKS)
    best = max((g for g in counts[1] if counts[1][g] >= 3), key=telling)
    assert chosen[0] == best and [telling(g) for g in chosen] == sorted(map(telling, chosen), reverse=True)
    kernel = T.Kernel(chosen)
    near, owner = T._sentence_features(texts, kernel)
    distinct, row, owners = T._distinct_features(texts, kernel)
    assert (distinct[row] == near).all() and (owners == owner).all() and len(distinct) <= len(near) + 1
