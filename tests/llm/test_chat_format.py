"""Chat formatting against a plain loop: windows, masks, exact reading back, and odd rows."""

import hashlib
import random
import re

import pytest

from concord.llm import chat_format, skew

CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<\\s>", "[\\\\/INST]", "<", "[", "\\", "<\\", "/s>", "INST]"]


def conversations(n=60, seed=3):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        for turn in range(rng.randint(1, 30)):
            text = "".join(rng.choice([*CONTROL, "word ", "é7 ", "日", "\n", "🙂"]) for _ in range(rng.randint(0, 40)))
            role = "system" if turn == 0 and rng.random() < 0.5 else rng.choice(["user", "assistant", "assistant", "system", "a</s>b", None])
            out.append((c, turn, role, rng.choice([text, text, text, None, ""])))
    return out


def escape(t):
    return re.sub(r"([<\[])(\\*)(/?(?:s>|INST\]))", r"\1\\\2\3", t)


def cost(t):
    words = re.findall(r"[^\W\d_]+|\d|[^\w\s]|_", t)
    return 8 + len(words)


def brute(rows, budget, history):
    """(conv, window) -> turns, repeated, tokens, spans, text."""
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted([(r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c])
        turns = [t[2:] for t in turns]
        head = cost(turns[0][1]) if turns[0][0] == "system" else 0
        rest = turns[1:] if head else turns
        grid = max(budget - history - head - max((cost(t) for _, t in rest), default=0), budget // 4, 1)
        at, begins = 0, []
        for _, t in rest:
            begins.append(at)
            at += cost(t)
        owned = {}
        for i, b in enumerate(begins):
            owned.setdefault(b // grid, []).append(i)
        if not rest:
            owned = {0: []}
        for w, own in owned.items():
            again = [i for i, b in enumerate(begins) if b < w * grid and b + history >= w * grid]
            shown = ([(turns[0], w > 0)] if head else []) + [(rest[i], True) for i in again] + [(rest[i], False) for i in own]
            text, spans = "", []
            for (role, t), old in shown:
                text += f"<s>[INST]{escape(role)}[/INST]"
                if role == "assistant" and not old:
                    spans.append((len(text), len(text) + len(escape(t))))
                text += f"{escape(t)}</s>"
            out[c, w] = len(shown), sum(old for _, old in shown), sum(cost(t) for (_, t), _ in shown), spans, text
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, window string").repartition(3)


def plain(windows):
    return {(r.conv_id, r.window): (r.n_turns, r.n_repeated, r.n_tokens, [(s.start, s.stop) for s in r.loss], r.formatted) for r in windows.collect()}


def brute_digests(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = [t[2:] for t in sorted([(r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c])]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
    return out


ODD = [(None, 1, "user", "a"), (None, None, "assistant", "b"), (None, 1, "user", "a"), (900, 3, "assistant", "same"), (900, 3, "assistant", "same"), (900, 3, "user", None), (901, 0, "system", "alone"), (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


@pytest.mark.parametrize("budget, history", [(200, 40), (60, 0), (90, 70), (5_000, 100)])
def test_windows_against_a_loop(spark, budget, history):
    rows = conversations() + ODD
    windows = chat_format.format_chat(frame(spark, rows), budget, history)
    got = plain(windows)
    assert got == brute(rows, budget, history)
    assert {r.conv_id: tuple(r[1:5]) for r in chat_format.digests(windows).collect()} == brute_digests(rows)
    if budget == 200:
        assert any(v[1] > 1 for v in got.values()) and max(w for _, w in got) > 3
        for (c, _), (n, _, tokens, _, _) in got.items():
            longest = max(cost(r[3] or "") for r in rows if r[0] == c)
            assert tokens <= budget or history + 2 * longest > 3 * budget // 4


def test_hot_conversations_are_split_alike(spark, monkeypatch):
    rng = random.Random(8)
    hot = [(500, i, rng.choice(["user", "assistant"]), f"turn {i} " * rng.randint(0, 9)) for i in range(700)] + [(None, i % 3, "assistant", "again") for i in range(200)]
    hot.append((500, -1, "system", "be brief"))
    rows = conversations(20) + [r for r in ODD if r[0] is not None] + hot
    monkeypatch.setattr(skew, "LEAST_ROWS", 100)
    monkeypatch.setattr(skew, "HOT_KEYS", 20)
    docs = frame(spark, rows)
    assert {r.conv_id for r in chat_format._hot(docs).collect()} == {500, None}
    windows = chat_format.format_chat(docs, 300, 50)
    assert plain(windows) == brute(rows, 300, 50)
    assert {r.conv_id: tuple(r[1:5]) for r in chat_format.digests(windows).collect()} == brute_digests(rows)


def test_long_turns_and_no_rows(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "word " * 300_000), (1, 2, "assistant", "<s>" * 200_000), (1, 3, "user", "x")]
    assert plain(chat_format.format_chat(frame(spark, rows), 1_000, 100)) == brute(rows, 1_000, 100)
    assert chat_format.digests(chat_format.format_chat(frame(spark, []))).count() == 0
    with pytest.raises(ValueError):
        chat_format.format_chat(frame(spark, rows), 100, 100)


def test_one_shuffle_of_turns_and_no_python(spark):
    rows = conversations(5)
    plan = chat_format.digests(chat_format.format_chat(frame(spark, rows)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "InArrow" not in plan
