import hashlib
import random

from rollcall.llm import chat

TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_windows_round_trip_and_train_each_answer_once(spark):
    nasty = ["\\### Assistant: </turn> ok", "</turn>\n### user: x", "a\\", "#", "<\\/turn>", "", None, "é😀" * 300, "<</turn>"]
    rows = [(1, i, ("user", "assistant")[i % 2], nasty[i % len(nasty)]) for i in range(60)]
    rows += [(2, 0, "system", "be brief"), *[(2, i, "assistant" if i % 2 == 0 else "us:er", f"turn {i} " + "y" * 500) for i in range(1, 20)]]
    rows += [(3, 0, None, "hello"), (3, None, "assistant", "first"), (None, 0, "assistant", "no id"), (4, 0, "assistant", "long " * 2000), (2, 5, "user", "tie")]
    windows = chat.format_windows(spark.createDataFrame(rows, TURNS)).persist()
    digests = {r["conv_id"]: r for r in chat.conversation_digests(windows).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv))
        text = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        got = digests[conv]
        assert got["n_turns"] == len(own)
        assert got["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert (got["loss_chars"], got["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    mine = sorted((r for r in windows.collect() if r["conv_id"] == 2), key=lambda r: r["window"])
    assert len(mine) > 3
    assert all(r["text"].startswith("### system: be brief</turn>\n") for r in mine)
    assert mine[0]["n_context"] == 0 and all(r["n_context"] >= 1 for r in mine[1:])
    assert any(r["n_context"] == 1 for r in mine[1:]) or any(r["n_context"] > 1 for r in mine[1:])


def test_history_is_limited_and_masked(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], "z" * 80) for i in range(40)]
    budget = chat.Budget(tokens=150, history=50)
    windows = chat.format_windows(spark.createDataFrame(rows, TURNS), budget).collect()
    assert max(r["n_context"] for r in windows) == 2  # 24 tokens each
    assert max(r["n_tokens"] for r in windows) <= 150 and not any(r["over_budget"] for r in windows)
    assert sum(len(r["loss_spans"]) for r in windows) == 20


def plain_windows(turns, budget, history):
    """(tokens, own places, repeated places) of each window, turn after turn; ``turns`` are (role, tokens)."""
    system = turns[0][1] if turns[0][0] == "system" else 0
    reach = max(min(history, (budget - system) // 3), 0)
    stride = max(budget - system - reach, 1)
    start, starts, keys = 0, [], []
    for k, (_, size) in enumerate(turns):
        starts.append(start)
        if k == 0 and system:
            keys.append((0, False))
            continue
        keys.append((start // stride, start + size > (start // stride + 1) * stride))
        start += size
    windows = [[0]]
    for k in range(1, len(turns)):
        if keys[k] == keys[k - 1] or (k == 1 and system):
            windows[-1].append(k)
        else:
            windows.append([k])
    out = []
    for n, own in enumerate(windows):
        again = [k for k in range(own[0]) if starts[k] >= starts[own[0]] - reach and not (k == 0 and system)]
        total = sum(turns[k][1] for k in own + again) + (system if n else 0)
        out.append((total, own, again))
    return out


def test_windows_fit_the_budget_and_match_the_plain_form(spark):
    rng = random.Random(4)
    rows, plain = [], {}
    for conv in range(60):
        sizes = [rng.choice([1, 4, 20, 60, 200, 700, 1500]) for _ in range(rng.randrange(1, 40))]
        roles = [("user", "assistant")[i % 2] for i in range(len(sizes))]
        if conv % 3 == 0:
            roles[0] = "system"
        rows += [(conv, i, role, "q" * size) for i, (role, size) in enumerate(zip(roles, sizes, strict=True))]
        plain[conv] = plain_windows([(r, (n + 3) // 4 + 4) for r, n in zip(roles, sizes, strict=True)], 160, 40)
    got = {}
    for r in chat.format_windows(spark.createDataFrame(rows, TURNS), chat.Budget(tokens=160, history=40)).collect():
        got[r["conv_id"], r["window"]] = r
    assert len(got) == sum(map(len, plain.values()))
    fits = 0
    for conv, windows in plain.items():
        system = conv % 3 == 0
        for n, (total, own, again) in enumerate(windows):
            r = got[conv, n]
            assert (r["n_tokens"], r["over_budget"], r["n_context"]) == (total, total > 160, len(again) + (1 if system and n else 0))
            assert r["text"].count("</turn>") == len(own) + r["n_context"]
            if total > 160:
                assert len(own) - (1 if system and n == 0 else 0) <= 1
            fits += total <= 160 and len(own) > 1
    assert fits > 50


def test_a_system_turn_beyond_the_budget(spark):
    rows = [(1, 0, "system", "s" * 4000), (1, 1, "user", "a"), (1, 2, "assistant", "b")]
    windows = sorted(chat.format_windows(spark.createDataFrame(rows, TURNS)).collect(), key=lambda r: r["window"])
    assert [r["over_budget"] for r in windows] == [True, True]
    assert all(r["text"].startswith("### system: sss") for r in windows)


def test_an_empty_table(spark):
    windows = chat.format_windows(spark.createDataFrame([], TURNS))
    assert chat.conversation_digests(windows).count() == 0
