"""Structure repair against plain versions: all edits of tiny conversations, a table of whole strings for longer ones."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orderlake.llm import queries as Q
from orderlake.llm import repair as R
from orderlake.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def every(steps, inserts=3):
    """The best (cost, audit) over all edit strings with few insertions."""
    best = None
    for slots in itertools.product(range(inserts + 1), repeat=len(steps) + 1):
        if sum(slots) > inserts:
            continue
        for ops in itertools.product("DKR", repeat=len(steps)):
            cost, audit, kept = 5 * sum(slots), "", []
            for k, (op, (initial, must, cut)) in enumerate(zip(ops, steps)):
                audit += "I" * slots[k] + op
                kept += ["?"] * slots[k] + ({"D": [], "K": [initial], "R": ["?"]}[op])
                cost += 2 if op == "D" else (1 if op == "R" else 0) + (5 if cut else 0)
                if must and op != "D":
                    cost = 10**9
            audit += "I" * slots[-1]
            kept += ["?"] * slots[-1]
            text = "".join(kept[1:] if kept[:1] == ["s"] else kept)
            if kept == ["s"] or len(text) % 2 or any(c not in "?" + "ua"[i % 2] for i, c in enumerate(text)):
                continue
            if best is None or (cost, audit) < best:
                best = (cost, audit)
    return best


def table_of_strings(steps):
    """The best (cost, audit) by keeping whole strings."""
    def close(b):
        for _ in range(4):
            for s, t in ((0, 2), (1, 2), (3, 2), (2, 3)):
                if s in b:
                    b[t] = min(b.get(t, (10**9, "")), (b[s][0] + 5, b[s][1] + "I"))
        return b
    best = close({0: (0, "")})
    for initial, must, cut in steps:
        new = {}
        for s, (c, a) in best.items():
            ways = [(s, c + 2, a + "D")]
            if not must:
                ways.append((3 if s == 2 else 2, c + 1 + 5 * cut, a + "R"))
                to = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(initial, {}).get(s)
                if to is not None:
                    ways.append((to, c + 5 * cut, a + "K"))
            for t, c2, a2 in ways:
                new[t] = min(new.get(t, (10**9, "")), (c2, a2))
        best = close(new)
    return min(best[s] for s in (0, 3) if s in best)


def plain(rows):
    """{conv: result} of damaged rows, in plain Python."""
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    out = {}
    for conv, rs in by.items():
        rs.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:64], hashlib.sha256(r[3].encode()).hexdigest()))
        turns = [r[1] for r in rs if r[1] is not None]
        counts, seen, steps = [0, 0, 0], set(), []
        for _, _, role, text in rs:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            steps.append((role[:1], fault in (0, 1), fault == 2))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(steps, steps[1:]))
        cost, audit = table_of_strings(steps)
        said, state, i = [], "", 0
        for op in audit:
            nxt = "assistant" if state[-1:] == "u" else "user"
            if op == "I":
                said.append(nxt + ":")
                state += nxt[0]
                continue
            _, _, role, text = rs[i]
            i += 1
            if op != "D":
                role = nxt if op == "R" else role
                said.append(f"{role}:{text}")
                state += role[0]
        assert re.fullmatch("(s?(ua)+)?", state)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        sp = lambda x: " " if x is None else str(x)
        k = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = sp(role), sp(text)
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def results(df):
    cols = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = df.collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r[c] for c in cols) for r in got}


def steps_of(rng, n):
    return [(rng.choice("uuaasx"), rng.random() < 0.2, rng.random() < 0.25) for _ in range(n)]


def test_all_edits_of_tiny_conversations():
    rng = random.Random(5)
    for _ in range(60):
        steps = steps_of(rng, rng.randint(0, 4))
        steps = [(i, m, c and not m) for i, m, c in steps]
        trails, best = R.solve(steps, 0)
        cost, _, node = R.finish(trails, best)
        assert (cost, trails.text(node)) == every(steps) == table_of_strings(steps)


@pytest.mark.parametrize("mod", [R._MOD, 7])  # with so small a modulus most hashes collide
def test_trails_compare_as_strings(mod):
    rng = random.Random(2)
    t, texts = R.Trails(base=3, mod=mod), [""]
    for _ in range(300):
        p = rng.randrange(len(texts))
        piece = "".join(rng.choice("DIK") for _ in range(rng.choice((1, 1, 1, 2, 5))))
        t.add(p, piece)
        texts.append(texts[p] + piece)
    for _ in range(3000):
        a, b = rng.randrange(len(texts)), rng.randrange(len(texts))
        x, y = (rng.choice(("", "D", "K", "IKD")) for _ in range(2))
        common = next((i for i, (c, d) in enumerate(zip(texts[a], texts[b])) if c != d), min(len(texts[a]), len(texts[b])))
        assert t.common(a, b) == common
        assert t.less(a, x, b, y) == (texts[a] + x < texts[b] + y)


def test_long_conversation_by_strings():
    rng = random.Random(9)
    for mod in (R._MOD, 11):
        steps = [(i, m, c and not m) for i, m, c in steps_of(rng, 400)]
        trails, best = R.solve(steps, 0, R.Trails(mod=mod))
        cost, _, node = R.finish(trails, best)
        assert (cost, trails.text(node)) == table_of_strings(steps)


def test_given_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = plain(damaged(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert results(Q.op11_conversation_repair(spark, SF)) == {c: want.get(c, nothing) for c in {r[0] for r in rows}}


def odd_rows():
    rng = random.Random(4)
    said = ["Yes.", "no", "", " \t\n", "Really?", "x" * 70 + ".", "x" * 70 + "!", "Ünd "]
    rows = [(c, rng.choice((None, *range(9))), rng.choice(("user", "assistant", "system", "", "tool")), rng.choice(said)) for c in (1, 2, 3, None) for _ in range(25)]
    return rows + rows[:9]


@pytest.mark.parametrize("block", [4, 2048])
def test_blocks_and_odd_rows(spark, block):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", audit string, blank long")
    assert results(R.repair(df, block=block)) == plain(rows)


def test_hot_conversation_in_blocks(spark):
    rng = random.Random(8)
    rows = [(1, t, rng.choice(("user", "assistant", "user", "assistant", "system")), rng.choice(("a.", "b!", f"c{t}.", f"d{t}", ""))) for t in range(700)]
    rows += [(2, t, "ua"[t % 2].replace("u", "user").replace("a", "assistant") if t else "system", f"t{t}.") for t in range(9)]
    assert results(R.repair(spark.createDataFrame(rows, SCHEMA).repartition(5), block=64)) == plain(rows)


def test_damage_and_empty(spark):
    rows = [(c, t, r, x) for c in (1, 2, None) for t in (None, 0, 1, 2, 3, 5) for r, x in (("user", "Hi. You!"), (None, None))]
    got = sorted(map(str, (tuple(r) for r in R.damage(spark.createDataFrame(rows, SCHEMA)).collect())))
    assert got == sorted(map(str, damaged(rows)))
    empty = spark.createDataFrame([], SCHEMA)
    assert R.repair(R.damage(empty)).collect() == [] and R.with_empty(R.repair(R.damage(empty)), empty).collect() == []
    gone = next(t for t in range(100) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(5, gone, "user", "Hi.")], SCHEMA)
    assert results(R.with_empty(R.repair(R.damage(one)), one)) == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
