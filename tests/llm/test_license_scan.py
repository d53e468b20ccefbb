from orderlake.llm import license_scan as L

MIT = L.TEMPLATES[2][1]


def run(spark, docs):
    df = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id long, text string, license string")
    return sorted(((r["doc_id"], r["license"], round(r["coverage"], 2), r["start"], r["end"]) for r in L.scan(df).collect()), key=str)


def test_notices_and_spans(spark):
    head = "Ein é Anfang.\n"
    docs = [
        (1, head + "Released under the MIT License.\nrest"), (2, "released UNDER\tthe  mit license"), (3, "under the license of the sea"), (4, None), (5, ""),
        (6, "x " * 5000 + MIT.replace("without restriction", "with no restriction") + " y" * 5000), (None, "Licensed under CC BY-NC 4.0."),
        (8, "Licensed under the Apache License, Version 2.0. Released under the MIT License. Released under the MIT License."), (9, "mit"), (9, "Released under the MIT License"),
    ]
    got = run(spark, docs)
    assert (1, "MIT", 1.0, len(head), len(head) + 30) in got
    assert [g[:2] for g in got if g[0] == 8] == [(8, "Apache-2.0"), (8, "MIT"), (8, "MIT")]
    assert {g[0] for g in got} == {1, 2, 6, 8, 9, None}
    six = next(g for g in got if g[0] == 6)
    assert six[1] == "MIT" and 0.9 < six[2] < 1 and six[3] == 10_000
    assert (None, "CC-BY-NC-4.0", 1.0, 0, 27) in got
    assert run(spark, []) == []


def test_every_template_finds_itself(spark):
    docs = [(i, "some words before, " + t + " and after") for i, (_, t) in enumerate(L.TEMPLATES)]
    got = run(spark, docs)
    assert {(g[0], g[1]) for g in got if g[2] == 1.0} >= {(i, n) for i, (n, _) in enumerate(L.TEMPLATES)}


def test_winnowing_shares_a_fingerprint_of_any_long_enough_run():
    t = L.Templates()
    for n, words in zip(t.names, t.words, strict=True):
        kept, h = L.winnow(words)
        assert len(kept) and all(any(k <= p < k + L.W for p in kept) for k in range(len(words) - L.K - L.W + 2)), n
