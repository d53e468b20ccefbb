import zlib

import numpy as np
import pytest

from orderlake.llm import packing

TEXTS = [None, "", " \n", "It's I'LL <|endoftext|> a b \x1c x² ½ Σας İstanbul é don't!! 12345 \x00 😀ok", "Straße übermäßig, ÇA VA? " * 40, "word " * 9000, "a" * 5000]


@pytest.fixture(scope="module")
def path():
    pytest.importorskip("public_tokenizers")
    return packing.tokenizer_path()


def check(rows, got, path, window):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    want = sorted(np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4").tobytes() for _, x in rows)
    docs, pieces = [], {}
    for r in sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["start"])):
        pieces.setdefault(r["doc_id"], []).append(r)
    for p in pieces.values():
        raw, at = b"", 0
        for r in p:
            if r["start"] == 0:
                raw, at = b"", 0
            piece = np.array(r["ids"], "<u4").tobytes()
            assert r["start"] == at and r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(piece)
            raw, at = raw + piece, at + r["length"]
            if at == r["doc_tokens"]:
                docs.append(raw)
    assert sorted(docs) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:k]) for k in range(len(s))] and sum(n for _, n in s) <= window
    return sequences


def test_ids_cover_each_document_once(spark, path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(i + 100, f"some text number {i} " * (i % 70)) for i in range(400)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), path, window=512, with_ids=True).collect()
    sequences = check(rows, got, path, 512)
    assert sum(r["length"] for r in got) > 0.97 * 512 * len(sequences)


def test_small_groups_null_identifiers_and_extra_columns(spark, path):
    df = spark.createDataFrame([(None, "a b", 1, 2), (3, "c", 1, 2)], "doc_id long, text string, start int, row int")
    got = packing.pack(df, path, with_ids=True, group_rows=1).collect()
    check([(None, "a b"), (3, "c")], got, path, 2048)
    assert packing.pack(df.where("false"), path).count() == 0


def test_whole_and_short_way_agree(path):
    words = packing.Words(path)
    assert words.fast
    for w in ["they're", "''s's", "ÀÉÿß", "x'LL", "a1b22", "!!", "'", "l'été", "'D", "÷×"]:
        short = words._short(w) if words.PLAIN.fullmatch(w) else words._whole(w)
        assert short == words._whole(w), w


def test_best_fit_decreasing_takes_the_tightest_window():
    rnd = np.random.default_rng(2)
    lengths = rnd.integers(1, 65, 500)
    bins, offsets, n = packing.best_fit_decreasing(lengths, 64)
    left = []
    for k in np.argsort(-lengths, kind="stable"):
        fits = [c for c in left if c >= lengths[k]]
        if fits:
            left.remove(min(fits))
            left.append(min(fits) - lengths[k])
        else:
            left.append(64 - lengths[k])
    assert n == len(left) and sorted(64 - np.bincount(bins, lengths).astype(int)) == sorted(left)


def test_the_pipeline_packs_small_chunks_to_the_same_pieces(spark, path, monkeypatch):
    import corpus_pipeline

    df = spark.createDataFrame([(i, f"some text number {i} " * (i % 70)) for i in range(100)], "doc_id long, text string")
    want, seen, pack = {tuple(r) for r in packing.pack(df, path).collect()}, [], packing.pack
    monkeypatch.setattr(corpus_pipeline, "PACK_BYTES", 900)  # an executor of the pipeline was stopped beyond 3,000 MB with the chunk of op9
    monkeypatch.setattr(packing, "pack", lambda *a, **k: seen.append(k["chunk_bytes"]) or pack(*a, **k))
    assert {tuple(r) for r in corpus_pipeline.pack(spark, df, "").collect()} == want and seen == [900]
