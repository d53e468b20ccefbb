from orderlake.llm import html_extract as H

SCHEMA = "page_id long, url string, html string, text string, host string"


def run(spark, rows, **kw):
    got = H.extract(spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA), **kw).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    return {r["page_id"]: r["text"] for r in got}


def test_article_without_furniture():
    page = """<!doctype html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
    <header>Site</header><nav><ul><li>Menu</ul></nav><div class="cookie-notice">We use cookies</div><!-- <p>no --> <div class=ad>Buy</div>
    <article><h1>Head &amp; <i>line</i></h1><p>One&nbsp;  two<br>three<p>Unclosed <b>bold<p>Next &lt;tag&gt; &#233;</p>
    <aside>Side</aside><form><p>Sign</p></form><ul><li>first<li>second</ul><section id="comments"><p>Reader says</p></section></article>
    <div class="sidebar"><p>More</p></div><footer>&copy; x</footer></body>"""
    assert H.main_text(page) == "Head & line\nOne two three\nUnclosed bold\nNext <tag> é\nfirst\nsecond"


def test_broken_and_odd_markup():
    assert H.main_text(None) == "" and H.main_text("") == "" and H.main_text("<") == "<"
    assert H.main_text("plain  text\n here") == "plain text here"
    assert H.main_text("<p>a</p></div></p>b<script>never closed <p>c") == "a\nb"
    assert H.main_text("<body><main><p>in</main><p>out") == "in"
    assert H.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert H.main_text("<article><table><tr><td>a<td>b<tr><td>c</table></article>") == "a\nb\nc"
    assert H.main_text('<article><p>x</p><img alt="a>b"><p title=\'>\'>y</p></article>') == "x\ny"


def test_recurring_subtrees_of_a_host_go(spark):
    page = lambda i, k: f"<body><div><span>Subscribe to our letter {k}</span></div><article><p>Common line.</p><p>Story {i}</p><div><span>Boiler {k}</span></div></article></body>"
    rows = [(i, f"http://one.example/{i}", page(i, "one")) for i in range(12)]
    rows += [(100 + i, f"http://h{i}.example/", page(i, "one")) for i in range(6)]
    got = run(spark, rows)
    assert all(got[i] == f"Common line.\nStory {i}" for i in range(12))
    assert all(got[100 + i] == f"Common line.\nStory {i}\nBoiler one" for i in range(6))
    old, H.BLOCK = H.BLOCK, 1
    try:
        assert run(spark, rows) == got
    finally:
        H.BLOCK = old


def test_nulls_repeats_and_empty_table(spark):
    assert run(spark, []) == {}
    got = run(spark, [(1, None, "<p>a</p>"), (None, "x", None), (2, "http://a/", ""), (2, "http://a/", "")])
    assert got == {1: "a", None: "", 2: ""}


def test_stray_end_tags_cost_the_length_of_the_page():
    import time
    n = 20_000
    for page in ("<div>" * n + "</x>" * n + "deep", "<x><article>" + "<span>" * n + "</x>" * n + "deep", "<span>" * n + "<p>" * n + "deep"):
        start = time.time()
        assert H.main_text(page) == "deep"
        assert time.time() - start < 5
