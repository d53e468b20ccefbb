"""The pipeline's near-copy stage against a brute-force join of word 5-grams at 80 %."""

import random

import corpus_pipeline
from orderlake.llm import jaccard_join as J
from orderlake.llm.common import table

SF = "/root/testdata/sf0.001"


def five_word_sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def similar(a, b):
    return a and b and 100 * len(a & b) >= 80 * len(a | b)


def kept_by_brute_force(rows):
    """Identifiers (unique, not null) that stay: the smallest one of each component."""
    sets = five_word_sets([t for _, t in rows])
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if similar(sets[i], sets[j]):
                root[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        best[find(i)] = min(d, best.get(find(i), d))
    return sorted(best.values())


def stage(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, df, SF).collect())


def edited(rnd, base, edits):
    w = list(base)
    for k in rnd.sample(range(len(w)), edits):
        w[k] = f"e{rnd.randrange(10**9)}"
    return " ".join(w)


def test_stage_links_what_the_contract_of_op7_would_not(spark):
    rnd = random.Random(21)
    texts = []
    for words, most in ((30, 2), (45, 3), (52, 3), (60, 4), (100, 6), (400, 18), (1500, 60)):
        for edits in range(most + 1):
            base = [f"w{rnd.randrange(10**6)}" for _ in range(words)]
            texts += [" ".join(base), edited(rnd, base, edits)]
    texts += [None, "", "one two", "One  two", "a b c d e", "a b c d e f"]
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    rows = list(zip(ids, texts, strict=True))
    want = kept_by_brute_force(rows)
    assert stage(spark, rows) == want
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(want) < J.drop_near_copies(df).count()


def test_stage_with_hot_hashes(spark):
    """Sets made mostly of passages that many texts hold link through hot hashes, between 80 and 85 % as well."""
    rnd = random.Random(22)
    passage = [f"p{i}" for i in range(200)]
    texts = []
    for own in range(10, 90):
        texts.append(" ".join([*passage, *(f"u{rnd.randrange(10**9)}" for _ in range(own))]))
    for _ in range(80):
        start = rnd.randrange(100)
        texts.append(" ".join([*passage[start : start + 60], *(f"u{rnd.randrange(10**9)}" for _ in range(rnd.randrange(5, 20)))]))
    rows = list(enumerate(texts))
    assert stage(spark, rows) == kept_by_brute_force(rows)


def test_stage_on_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    assert stage(spark, rows) == kept_by_brute_force(rows)


def test_one_row_of_each_component_whatever_the_identifiers(spark):
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join(f"b{i}" for i in range(60))
    c = " ".join(f"c{i}" for i in range(60))
    rows = [
        (5, a), (5, a + " more"),  # two near copies under one identifier
        (3, b), (2, "another text of that name"), (2, b + " more"),  # the copy's identifier has a text of its own too
        (None, a + " unnamed"), (None, c), (None, c + " unnamed"),
        (8, "x y z"), (8, "x y z"), (None, None), (9, ""),
    ]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, note string")
    for limit in (J.BROADCAST_IDS, 0):
        old, J.BROADCAST_IDS = J.BROADCAST_IDS, limit
        try:
            out = corpus_pipeline.drop_near_copies(spark, df, SF)
            assert out.columns == df.columns
            got = [(r["doc_id"], r["text"]) for r in out.collect()]
        finally:
            J.BROADCAST_IDS = old
        assert len(got) == 7 and {g for g in got if g[0] in (2, 8, 9)} == {(2, "another text of that name"), (2, b + " more"), (8, "x y z"), (9, "")}
        assert sum(g[0] == 5 for g in got) == 1 and (None, None) in got
        assert sum(g[0] is None and g[1] is not None and g[1].startswith("c0 ") for g in got) == 1
        assert not any(g[0] is None and g[1] is not None and g[1].startswith("a0 ") for g in got)
