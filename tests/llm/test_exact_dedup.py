import hashlib
import random
import re

from pyspark.sql import functions as F

from orderlake.llm import exact_dedup


def expected(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    by = {}
    for i, t in rows:
        by.setdefault(norm(t), []).append((-len(t or ""), i is None, i))
    out = []
    for i, t in rows:
        g = by[norm(t)]
        c, _, keep = min(g, key=lambda x: (x[0], x[1], x[2] if x[2] is not None else 0))
        out.append((i, keep, len(g), i == keep and -c == len(t or ""), hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted([tuple(r) for r in exact_dedup.content_sort(df, **kw).collect()], key=str)


def test_against_brute_force(spark):
    rnd = random.Random(5)
    pool = ["", " ", None, "a b", "ab", "a\tb", "a b", "é x", "éx", "long " * 500, "long" * 500, "zz\x0b\x0c\r\n", "Ab"]
    rows = [(rnd.choice([*range(40), None]), rnd.choice(pool)) for _ in range(200)]
    assert run(spark, rows) == expected(rows)


def test_hot_group_spreads_over_runs(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(600)]
    assert run(spark, rows) == expected(rows)
    for sampling in ({"sample": 1, "shown": 3, "run": 8}, {"sample": 2, "shown": 1, "run": 1}):
        assert run(spark, rows, **sampling) == expected(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    cut = exact_dedup.content_runs(df, sample=1, shown=3, run=8).where("salted")
    assert cut.count() == 400 and cut.where("run_row = 1").count() > 25 and cut.agg(F.max("run_size")).first()[0] < 40


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "a", 7, "x"), (2, "a ", 8, "y")], "doc_id long, text string, kept long, sha string")
    assert sorted(tuple(r) for r in exact_dedup.content_sort(df).select("doc_id", "keep_id", "kept").collect()) == [(1, 2, False), (2, 2, True)]
    assert [tuple(r) for r in exact_dedup.drop_exact_copies(df).collect()] == [(2, "a ", 8, "y")]


def test_filter_keeps_one_row_of_each_text(spark):
    rows = [(1, "a"), (1, "a"), (None, "b"), (None, "b"), (3, None), (4, ""), (5, "c"), (5, "d")]
    got = exact_dedup.drop_exact_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "a"), (None, "b"), (3, None), (5, "c"), (5, "d")], key=str)


def test_neighbours_settle_every_copy_outside_hot_texts(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i % 500} " * 9) for i in range(3000)]
    runs = exact_dedup.content_runs(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), sample=4, shown=50, run=100)
    cold = runs.where(~F.col("salted")).agg(F.count_if(F.col("run_row") == 1).alias("texts"), F.count_if(F.col("run_row") > 1).alias("copies")).first()
    different = {t for _, t in rows if t != "hot"}
    assert (cold.texts, cold.copies) == (len(different), 2000 - len(different))
    assert runs.where("salted").count() == 1000


def test_plan_is_native_and_ranges(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = exact_dedup.content_runs(df)._jdf.queryExecution().toString()
    assert "Python" not in plan.split("Physical Plan")[1].replace("applySchemaToPythonRDD", "") and "rangepartitioning(prefix" in plan
    assert "Python" not in exact_dedup.content_sort(df)._jdf.queryExecution().optimizedPlan().toString()
