import random

import numpy as np

from orderlake.llm import jaccard_join as J


def word_sets(texts, n=4):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    return out


def expected(rows, percent=85):
    sets = word_sets([t for _, t in rows])
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), (min(ids) if ids else None) if sets[i] else d))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id long, text string, n long, sid string")
    return sorted(map(tuple, J.jaccard_components(df, **kw).collect()), key=str)


def family(rnd, size, words, edits, vocabulary=4000):
    base = [f"w{rnd.randrange(vocabulary)}" for _ in range(words)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            w[rnd.randrange(len(w))] = f"w{rnd.randrange(vocabulary)}"
        out.append(" ".join(w))
    return out


def test_against_brute_force(spark):
    rnd = random.Random(11)
    texts = [None, "", " ", "a", "A", "a b c", "a  b\tC", "a b c d", "e f g h i j k l m n"]
    for size, words, edits in ((90, 60, 4), (6, 400, 30), (4, 30, 2), (3, 1500, 60), (10, 9, 1)):
        texts += family(rnd, size, words, edits)
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [" ".join(f"u{rnd.randrange(10**6)}" for _ in range(rnd.randrange(3, 80))) + " " + passage for _ in range(100)]
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    rows = list(zip(ids, texts, strict=True)) + [(10_000, texts[12]), (None, texts[20]), (None, "alone and without a name"), (3, "repeated id"), (3, "repeated id")]
    assert run(spark, rows) == expected(rows)


def test_family_in_blocks_and_texts_joined_by_shuffle(spark):
    rows = list(enumerate(family(random.Random(3), 90, 60, 4)))
    old = J.BLOCK, J.BROADCAST_IDS
    J.BLOCK, J.BROADCAST_IDS = 1_000, 0
    try:
        assert run(spark, rows) == expected(rows)
    finally:
        J.BLOCK, J.BROADCAST_IDS = old


def test_empty_table(spark):
    assert run(spark, []) == []


def test_trie_finds_every_link():
    rnd = np.random.default_rng(4)
    base = rnd.integers(0, 10**9, 120)
    sets = [np.unique(np.where(rnd.random(120) < p, rnd.integers(0, 10**9, 120), base)) for p in rnd.uniform(0, 0.2, 80)]
    sets += [np.unique(rnd.integers(0, 300, rnd.integers(1, 60))) for _ in range(60)]
    everything = np.arange(len(sets))
    links = {(min(a, int(b)), max(a, int(b))) for a, found in J.Trie(sets, everything, everything, 85).links() for b in found}
    want = set()
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                want.add((j, i))
    assert links == want and len(want) > 20


def test_components_of_paths(spark):
    nodes = [f"{i * 37 % 101:03d}" for i in range(40)]
    edges = [(nodes[i], nodes[i + 1]) for i in range(19)] + [(nodes[30], nodes[31]), (nodes[31], nodes[30]), (nodes[35], nodes[35])]
    got = dict(map(tuple, J.components(spark.createDataFrame(edges, "a string, b string")).collect()))
    assert got == {n: min(nodes[:20]) for n in nodes[:20]} | {n: min(nodes[30:32]) for n in nodes[30:32]}


def test_rounds_of_components_do_not_shuffle_small_files(spark):
    edges = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(0, 40, 2)], "a string, b string").repartition(16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would put small partitions together by itself
    try:
        got = J.components(edges)
        assert got.rdd.getNumPartitions() == 1 and got.count() == 40
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_filter_keeps_one_of_each_group(spark):
    text = " ".join(f"x{i}" for i in range(50))
    rows = [(4, text), (2, text + " more"), (9, "something else"), (None, text), (7, None)]
    df = spark.createDataFrame([(*r, "keep me") for r in rows], "doc_id long, text string, extra string")
    got = J.drop_near_copies(df)
    assert got.columns == df.columns and sorted((r["doc_id"] for r in got.collect()), key=str) == [2, 7, 9, None]
