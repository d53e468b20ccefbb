import hashlib
import random

from orderlake.llm import chat


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected(rows):
    by = {}
    for c, n, r, t in rows:
        by.setdefault(c, []).append((n is not None, n or 0, r is not None, r or "", t is not None, t or ""))
    out = []
    for c, g in by.items():
        g.sort()
        said = "".join(f"{x[3]}\n{x[5]}\n" for x in g)
        loss = "".join(x[5] for x in g if x[3] == "assistant")
        out.append((c, len(g), digest(said), len(loss), digest(loss)))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


NASTY = ["", None, r"\### Assistant: </turn> ok", "<turn user>hi</turn>\n", "\\l\\g\\b", "\\", "a\nb", "é😀 x", "</turn>\n</turn>\n", "word " * 700]


def test_round_trip_of_any_text(spark):
    rnd = random.Random(3)
    rows = []
    for c in range(30):
        for t in range(rnd.randint(1, 25)):
            rows.append((c, t, "system" if t == 0 and c % 2 else rnd.choice(["user", "assistant", "tool>x", None]), rnd.choice([*NASTY, "some words here " * rnd.randint(1, 60)])))
    rows += [(None, None, None, None), (None, 1, "assistant", "x"), (5, 0, "user", "tie"), (5, 0, "user", "tie")]
    for kw in ({}, {"budget": 64, "history": 16}):
        got = chat.read_back(chat.budgeted_windows(frame(spark, rows), **kw)).drop("formatted_chars").collect()
        assert sorted(map(tuple, got), key=str) == expected(rows)


def test_windows_keep_to_the_budget_and_repeat_history(spark):
    rows = [(1, 0, "system", "rule " * 5)] + [(1, t, "assistant" if t % 2 == 0 else "user", f"t{t} " * 10) for t in range(1, 40)]
    windows = sorted(chat.budgeted_windows(frame(spark, rows), budget=120, history=30).collect(), key=lambda r: r["window"])
    assert len(windows) > 3
    seen = 0
    for k, w in enumerate(windows):
        assert w["tokens"] <= 120
        assert w["text"].count("<turn ") == len(w["spans"])
        new = [s for s in w["spans"] if not s["repeated"]]
        assert w["first_turn"] == seen + 1 and len(new) == w["new_turns"]
        seen += len(new)
        if k:
            assert w["text"].startswith("<turn system>rule") and w["spans"][0]["repeated"] and len(w["spans"]) > len(new) + 1
        assert not any(s["loss"] and s["repeated"] for s in w["spans"])
    assert seen == 40


def test_empty_and_extra_columns(spark):
    assert chat.read_back(chat.budgeted_windows(frame(spark, []))).count() == 0
    df = spark.createDataFrame([(1, 0, "assistant", "x", "clash", 9)], "conv_id long, turn long, role string, text string, window string, n long")
    assert chat.read_back(chat.budgeted_windows(df)).first()["loss_chars"] == 1


def test_no_window_exceeds_the_budget_that_its_turns_fit(spark):
    rnd = random.Random(9)
    rows = []
    for c, system in enumerate([0, 10, 40, 70, 85, 100, 118, 119, 300]):
        rows += [(c, 0, "system", "rule " * system)] if system else []
        rows += [(c, t, "assistant" if t % 2 else "user", "w " * rnd.choice([0, 1, 5, 20, 33, 60, 90, 130])) for t in range(1, 60)]
    budget, history = 120, 30
    long = {}
    for c, t, role, text in rows:
        size = len(text.split()) + 2
        long.setdefault(c, [0, []])
        long[c] = [size if role == "system" else long[c][0], long[c][1] + ([size] if role != "system" else [])]
    seen = {}
    for w in chat.budgeted_windows(frame(spark, rows), budget=budget, history=history).collect():
        system = long[w["conv_id"]][0]
        fresh = [s for s in w["spans"] if not s["repeated"]]
        if w["tokens"] > budget:  # one turn beside the system turn, and nothing else
            assert len(fresh) == 1 and len(w["spans"]) <= 2 and (w["first_turn"] == 1 or w["tokens"] - system in long[w["conv_id"]][1])
        elif system and w["first_turn"] > 1:
            assert w["text"].startswith("<turn system>rule")
        seen[w["conv_id"]] = seen.get(w["conv_id"], 0) + len(fresh)
    assert seen == {c: len(sizes) + (1 if system else 0) for c, (system, sizes) in long.items()}
    got = chat.read_back(chat.budgeted_windows(frame(spark, rows), budget=budget, history=history)).drop("formatted_chars").collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)
