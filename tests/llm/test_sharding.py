import zlib

import numpy as np

from orderlake.llm import sharding


def run(spark, rows, shards):
    return sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), shards).collect()


def check(rows, got, shards):
    text = lambda t: (t or "").encode()
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in got) == sorted((i or -1, len(text(t)) + 8, zlib.crc32(text(t))) for i, t in rows)
    for s in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_balanced_in_bytes_words_and_rows(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, "word " * int(rnd.integers(1, 200))) for i in range(3000)]
    got = run(spark, rows, 8)
    check(rows, got, 8)
    for f in (lambda r: r["size"], lambda r: r["tokens"], lambda r: 1):
        sums = [sum(f(r) for r in got if r["shard"] == s) for s in range(8)]
        assert max(sums) < 1.05 * min(sums)


def test_equal_texts_share_a_shard_unless_too_large(spark):
    rows = [(i, f"text {i // 3} " * 9) for i in range(900)]
    got = run(spark, rows, 4)
    assert all(len({r["shard"] for r in got if r["text_crc32"] == zlib.crc32(t.encode())}) == 1 for t in {t for _, t in rows})
    hot = [(i, "copy " * 50 if i % 3 == 0 else f"text {i} " * 30) for i in range(3000)]
    got = run(spark, hot, 12)
    check(hot, got, 12)
    sums = [sum(r["size"] for r in got if r["shard"] == s) for s in range(12)]
    assert max(sums) < 1.1 * min(sums)


def test_nulls_ties_and_empty_tables(spark):
    rows = [(None, None), (None, None), (1, ""), (1, "a"), (1, "a"), (2, "é" * 10_000)]
    check(rows, run(spark, rows, 3), 3)
    assert run(spark, [], 3) == []
    df = spark.createDataFrame([(1, "a", 5, "x")], "doc_id long, text string, shard int, bundle string")
    assert sharding.shard_documents(df, 2).count() == 1


def test_place_takes_the_highest_dot_product():
    v = np.array([[4.0, 0, 0], [0, 4.0, 0], [4.0, 0, 0], [0, 4.0, 0]])
    shard = sharding.place(v, 2, np.array([4.0, 4.0, 0.0]))
    assert shard[0] != shard[2] and shard[1] != shard[3]
