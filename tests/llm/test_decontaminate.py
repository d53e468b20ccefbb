import random

import numpy as np

from orderlake.llm import decontaminate as D
from orderlake.llm import textbytes as B


def run(spark, docs, items):
    d = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): (r["edits"], r["start"], r["end"]) for r in D.contaminated(d, b).collect()}


ITEMS = [(i, " ".join(f"q{random.Random(i * 100 + k).randrange(10**5)}" for k in range(25))) for i in range(30)]


def edited(text, edits, seed):
    rnd = random.Random(seed)
    for _ in range(edits):
        k = rnd.randrange(len(text))
        text = text[:k] + rnd.choice(["", "x", text[k] + "y"]) + text[k + 1 :]
    return text


def test_exact_reflowed_and_edited_passages(spark):
    filler = " ".join(f"z{i}" for i in range(300))
    docs = [(1, filler + " " + ITEMS[3][1] + " " + filler), (2, filler), (3, "é" + ITEMS[4][1].upper().replace(" ", ",\n")), (4, edited(ITEMS[5][1], 8, 1)), (5, None), (6, ""), (7, ITEMS[6][1][: len(ITEMS[6][1]) // 2])]
    docs += [(None, ITEMS[7][1]), (9, ITEMS[8][1] + ITEMS[9][1]), (9, ITEMS[8][1])]
    got = run(spark, docs, [*ITEMS, (99, None), (98, ""), (97, "short")])
    assert set(got) == {(1, 3), (3, 4), (4, 5), (None, 7), (9, 8), (9, 9)}
    start = len(filler) + 1
    assert got[1, 3] == (0, start, start + len(ITEMS[3][1]))
    assert got[3, 4][:2] == (0, 1)
    assert run(spark, docs, []) == {} and run(spark, [], ITEMS) == {}


def test_blocks_of_items_and_filter(spark):
    docs = [(i, f"before {t} after") for i, t in ITEMS] + [(100, "clean")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    old, D.BLOCK_BYTES = D.BLOCK_BYTES, 500
    try:
        assert {(r["doc_id"], r["item_id"]) for r in D.contaminated(d, b).collect()} == {(i, i) for i, _ in ITEMS}
        assert [tuple(r) for r in D.drop_contaminated(d, b).collect()] == [(100, "clean")]
    finally:
        D.BLOCK_BYTES = old
    assert len(list(D.item_blocks(b, 500))) > 3


def distance(p, t):
    row = [0] * (len(t) + 1)
    for i, x in enumerate(p, 1):
        new = [i] + [0] * len(t)
        for j, y in enumerate(t, 1):
            new[j] = min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1)
        row = new
    return min(row)


def test_no_passage_within_the_budget_is_lost():
    items = D.Items(ITEMS)
    rnd = random.Random(9)
    for k in range(200):
        i = rnd.randrange(len(ITEMS))
        text = D.squeeze((f"{rnd.random()} pad " * 5 + edited(ITEMS[i][1], rnd.randrange(20), k) + " tail").encode())[0]
        got = D.matches(items, text).get(i)
        least = distance(items.texts[i].tolist(), text.tolist())
        assert (got is not None) == (least <= items.edits[i])
        if got:
            assert got[0] == least


def test_banded_alignment_is_edit_distance():
    rnd = random.Random(1)
    for _ in range(100):
        p = np.array([rnd.randint(0, 3) for _ in range(rnd.randint(1, 15))])
        t = np.array([rnd.randint(0, 3) for _ in range(rnd.randint(0, 25))], int)
        assert B.banded_alignment(p, t, -len(p) - 1, len(t) + 1)[0] == distance(p, t)
