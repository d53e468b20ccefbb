import random

from pyspark.sql import functions as F

from orderlake.llm import toxicity as X
from orderlake.llm.common import table

SF = "/root/testdata/sf0.1"


def brute_segments(scores):
    """Maximal scoring segments by repeated search of the best stretch."""
    out = []

    def search(a, b):
        best = None
        for i in range(a, b):
            total = 0
            for j in range(i, b):
                total += scores[j]
                if total > 1e-9 and (best is None or total > best[0] + 1e-9):
                    best = (total, i, j)
        if best:
            out.append(best)
            search(a, best[1])
            search(best[2] + 1, b)

    search(0, len(scores))
    return sorted((a, b, round(s, 6)) for s, a, b in out)


def test_segments_are_the_maximal_ones():
    rnd = random.Random(2)
    for _ in range(200):
        words = [rnd.choice(["bad", "vile", "plain", "plain", "plain"]) for _ in range(rnd.randint(0, 25))]
        m = X.Model({"bad": 1.37, "vile": 2.9}, -0.731)
        n, got = m.segments(" ".join(words))
        want = brute_segments([m.weight(w) or m.other for w in words])
        assert n == len(words) and [(a, b, round(s, 6)) for s, a, b in got] == want


def test_held_out_rule(spark):
    import zlib

    ids = list(range(200)) + [-5]
    got = {r[0]: r[1] for r in spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", X.held_out(F.col("doc_id"))).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}


def test_nulls_repeats_empty_and_extra_columns(spark):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(400):
        toxic = i % 8 == 0
        docs.append((i, " ".join(rnd.choices(words, k=60) + ["scumbag!"] * toxic), "clash", 2.0))
        labels.append((i, None, int(toxic)))
    docs += [(None, None, "c", 1.0), (None, "a Scumbag here", "c", 1.0), (1000, "", "c", 1.0), (1001, "scumbag " * 50_000, "c", 1.0), (1001, "w1", "c", 1.0)]
    labels += [(None, 1, 1), (5, 1, None), (7, 1, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, segments string, score double")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = X.train(d, lab)
    got = X.score(d, model).collect()
    assert len(got) == len(docs)
    by = {(r["doc_id"], r["predicted"]) for r in got}
    assert {(None, 0), (None, 1), (1000, 0), (1001, 1), (1001, 0)} <= by
    assert all(r["predicted"] == int(r["doc_id"] % 8 == 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 400)
    kept = X.drop_toxic(d, model)
    assert kept.columns == d.columns and kept.count() == sum(r["predicted"] == 0 for r in got)
    assert X.score(d.where("false"), model).count() == 0
    assert X.score(d, X.train(d, lab.where("false"))).agg(F.max("score")).first()[0] < 0.01


def test_labels_of_held_out_rows_have_no_part(spark):
    docs, labels = table(spark, SF, "documents").limit(1500), table(spark, SF, "labels")
    flipped = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert X.train(docs, labels).weights == X.train(docs, flipped).weights


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = X.score(docs, X.train(docs, labels)).where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    hit = sum(r["toxic"] == 1 and r["predicted"] == 1 for r in rows)
    assert hit >= 0.9 * sum(r["toxic"] == 1 for r in rows)
    assert sum(r["toxic"] == 0 and r["predicted"] == 1 for r in rows) <= 0.01 * len(rows)
