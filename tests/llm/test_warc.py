import base64
import hashlib

from orderlake.llm import warc
from orderlake.llm.common import filesystem, new_folder

SCHEMA = "page_id long, url string, html string, digest string, file string"


def run(spark, rows):
    return warc.page_records(spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)).collect()


def expected(rows):
    out = []
    for i, url, h in rows:
        raw = (h or "").encode()
        same = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        best = max(same, default=None)
        revisit = best is not None and i != best
        out.append((i, url, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", best if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/1", "<p>x"), (2, "http://a/2", "<p>x"), (9, None, "<p>x"), (3, "http://a/3 with space\r\nX: y", None), (4, "", ""), (5, "http://é", "é😀" * 3000),
    (None, "http://n", "<p>x"), (None, "http://n", "only null"), (6, "http://r", "HTTP/1.1\r\n\r\nWARC/1.1\r\n\r\n"), (7, "u", "z" * 3_000_000), (8, "u", "twin"), (8, "u", "twin"),
]


def test_round_trip_against_brute_force(spark):
    assert sorted(map(tuple, run(spark, ROWS)), key=str) == expected(ROWS)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_selected_records_by_range(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * 50) for i in range(300)], "page_id long, url string, html string").repartition(3)
    folder = new_folder(spark, "warc-test")
    index = warc.write_archives(pages, folder)
    rows = warc.read_records(index.where("page_id % 7 = 0"), folder).collect()
    assert sorted((r["page_id"], r["payload"].decode()) for r in rows) == [(i, f"page {i} " * 50) for i in range(0, 300, 7)]
    r = index.orderBy("file", "offset").first()
    store, _ = filesystem(folder)
    with store.open_input_file(r["file"]) as f:
        headers, payload = warc.parse(f.read_at(r["length"], r["offset"]))
    assert headers["WARC-Type"] == "response" and warc.payload_digest(payload) == r["digest"]
