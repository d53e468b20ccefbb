"""LM scoring: counts against plain Python, the network against a plain forward pass, gradients against differences, probabilities that add up."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from orderlake.llm import attention as A
from orderlake.llm import lm_scoring as L
from orderlake.llm import queries as Q
from orderlake.llm.common import table
from orderlake.llm.wordchunks import chunks

SF = "/root/testdata/sf0.001"
PATH = L.tokenizer_path()


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def base_of(rows):
    count = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        ws = tokens(t)
        out.append((i, held(i), len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)))
    return sorted(out, key=str)


def shown(df):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in df.collect()), key=str)


def test_given_table(spark):
    docs = table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = Q.op13_lm_scoring(spark, SF)
    assert shown(got) == base_of(rows)
    # A list of a few words leaves the other counts to the join: the same scores.
    few = {r["doc_id"]: r for r in L.lm_scores(docs, PATH, hot_words=50).collect()}
    for r in got.collect():
        assert math.isclose(r["score"], few[r["doc_id"]]["score"], rel_tol=1e-6)
        assert -20 * r["n_tokens"] < r["score"] < 0


def test_odd_rows(spark):
    rows = [(1, "A a  b\tB\x0bc\n"), (2, None), (3, ""), (None, "é É <|endoftext|> x"), (3, "a b"), (3, "a b"), (4, " \t\r\n"), (5, "y" * 5000), (6, "z " * 9000)]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    got = L.lm_scores(df, PATH)
    assert shown(got) == base_of(rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got.collect())
    assert L.lm_scores(df.limit(0), PATH).collect() == []
    alone = [i for i in range(200) if held(i)][:3]
    only_held = spark.createDataFrame([(i, "a b") for i in alone], "doc_id long, text string")
    assert shown(L.lm_scores(only_held, PATH)) == base_of([(i, "a b") for i in alone])


@pytest.fixture(scope="module")
def model(spark):
    return L.train(table(spark, SF, "documents"), PATH)[0]


def plain_log_probs(m, ids):
    """Every position by itself: one query, its window of keys, true exponentials."""
    w, rows = {k: x.astype(float) for k, x in m.weights.items()}, [m.row_of[-1], *m.row_of[ids[:-1]]]
    x = w["embed"][rows]
    out = []
    for t in range(len(ids)):
        low = max(0, (t // A.SPAN - 1) * A.SPAN)
        s = np.array([x[t] @ w["query"] @ (x[j] @ w["key"]) + w["near"][t - j] for j in range(low, t + 1)])
        a = np.exp(s - s.max())
        seen = (a / a.sum()) @ (x[low : t + 1] @ w["value"])
        before = w["embed"][rows[t - 1] if t else m.row_of[-1]]
        hidden = np.maximum(x[t] @ w["w_now"] + before @ w["w_before"] + seen @ w["w_seen"] + w["b_hidden"], 0)
        logits = hidden @ w["w_out"] + m.table[rows[t]]
        out.append((logits - np.log(np.exp(logits).sum()))[m.class_of[ids[t]]])
    return np.array(out)


def ids_of(m, texts):
    codes, distinct, sizes = L.words(pa.chunked_array([pa.array(texts)]))
    return (codes, distinct, sizes), m.ids(codes, distinct, sizes)


def test_windows_against_plain_version(model):
    texts = ["the and of " * 60 + "x1 y2", "", "Étion dans le çouelle", "a"]
    (_, _, sizes), (ids, per_text, per_word, _) = ids_of(model, texts)
    assert per_text.sum() == len(ids) == per_word.sum()
    b = model.blocks(ids, per_text)
    got = A.Scorer(model.weights, model.table, model.opening).log_probs(b)[0][b.slot]
    at = 0
    for n in per_text:
        want = plain_log_probs(model, ids[at : at + n])
        # The exponential in straight pieces is up to 6 % off, the share a little less.
        assert np.abs(got[at : at + n] - want).max() < 0.08
        at += n
    # Each text by itself gives the same, so nothing is seen across texts or later in a text.
    ends = np.cumsum(per_text)
    alone = model.blocks(ids[ends[0] : ends[2]], per_text[1:3])
    assert np.allclose(A.Scorer(model.weights, model.table, model.opening).log_probs(alone)[0][alone.slot], got[ends[0] : ends[2]], atol=1e-5)


def test_later_words_change_nothing_before(model):
    one, two = "the man went to the house and " * 9, "the man went to the house and " * 8 + "zz qq " * 30
    seen = []
    for t in (one, two):
        _, (ids, per_text, _, _) = ids_of(model, [t])
        b = model.blocks(ids, per_text)
        seen.append((ids, A.Scorer(model.weights, model.table, model.opening).log_probs(b)[0][b.slot]))
    same = next(i for i, (a, b) in enumerate(zip(seen[0][0], seen[1][0])) if a != b)
    assert same > 40 and np.allclose(seen[0][1][:same], seen[1][1][:same], atol=1e-5)


def test_probabilities_add_up(model):
    _, (ids, per_text, _, _) = ids_of(model, ["the and of a"])
    b = model.blocks(ids, per_text)
    shares, total, _ = A.Scorer(model.weights, model.table, model.opening).shares(b.now, b.before, b.opens, None)
    within = np.bincount(model.class_of, np.exp(model.log_within), A.CLASSES)
    used = np.bincount(model.class_of, minlength=A.CLASSES) > 0
    assert np.allclose(within[used], 1)
    assert np.allclose(shares.sum(axis=1), total[:, 0], rtol=1e-4)
    assert np.allclose(shares[:, model.opening > 0].sum(axis=1), total[:, 1], rtol=1e-4)
    # A class opens words with all of its ids or with none.
    opens = L.subwords(PATH).opens
    assert all(len(set(opens[model.class_of == c])) == 1 for c in np.flatnonzero(used))


def test_gradient(model):
    random = np.random.default_rng(0)
    _, (ids, per_text, _, _) = ids_of(model, ["the and of " * 30, "Le çouelle", "x"])
    b = model.blocks(ids, per_text)
    w = {k: x + 0.2 * random.standard_normal(x.shape).astype(np.float32) for k, x in model.weights.items()}
    room = A.Room()
    _, n, g = A.gradient(w, model.table, room, b.now, b.before, b.kind, b.real, b.opens)
    for k in w:
        d = g[k] / (np.linalg.norm(g[k]) + 1e-12)
        up, down = (A.gradient({**w, k: w[k] + s * np.float32(0.01) * d}, model.table, room, b.now, b.before, b.kind, b.real, b.opens)[0] / n for s in (1, -1))
        assert math.isclose((up - down) / 0.02, float((g[k] * d).sum()), rel_tol=0.03, abs_tol=2e-4), k


def test_learning_lowers_the_loss(model):
    _, (ids, per_text, _, _) = ids_of(model, ["one two three four five six seven " * 40] * 6)
    b = model.blocks(ids, per_text)
    adam = A.Adam({k: x.copy() for k, x in model.weights.items()}, 4e-3)
    losses = [A.learn(adam, model.table, b)[0] for _ in range(12)]
    assert losses[-1] < 0.7 * losses[0]


def test_every_training_text_is_walked_once(spark, monkeypatch):
    walked, averaged = [], L._averaged

    def spy(texts, model, rate):
        walked.append([r["doc_id"] for r in texts.select("doc_id").collect()])
        return averaged(texts, model, rate)

    monkeypatch.setattr(L, "_averaged", spy)
    L.train(spark.createDataFrame([(None if i == 7 else i // 2, "a b " * (i % 5)) for i in range(120)], "doc_id long, text string"), PATH)
    assert len(walked) == L.ROUNDS and all(walked)
    assert sorted((i for w in walked for i in w), key=str) == sorted((None if i == 7 else i // 2 for i in range(120)), key=str)


def test_words_and_chunks():
    texts = pa.array(["A bCÉ  d", None, "", "  x ", "\x1c y z"])
    codes, distinct, sizes = L.words(pa.chunked_array([texts]))
    assert [distinct[c].as_py() for c in codes] == ["a", "bcÉ", "d", "x", "\x1c", "y z"] and sizes.tolist() == [3, 0, 0, 1, 2]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["aaaa", "b" * 20, "", None, "cc", "dddd"])], ["i", "t"])
    parts = [c.column(0).to_pylist() for c in chunks([batch, batch.slice(0, 1)], 8)]
    assert [i for p in parts for i in p] == [0, 1, 2, 3, 4, 5, 0]
    assert parts == [[0], [1], [2, 3, 4, 5], [0]]


def test_words_are_encoded_as_if_alone():
    sub = L.subwords(PATH)
    calls = []

    class Spy:
        def encode_ordinary(self, text):
            calls.append(text)
            return sub.encoding.encode_ordinary(text)

    spy = L.Subwords.__new__(L.Subwords)
    spy.encoding, spy.end, spy.opens = Spy(), sub.end, sub.opens
    plain = ["the", "it's", "'s", "été,", "y" * 300, "x1y2", "a_b", "...", "日本", "😀", "<|endoftext|>"] * 300
    odd = ["a\u00a0", "\u00a0b", "\u3000", "\x1c", "\x85x", ""]
    for some in (plain, odd, plain[:5] + odd + plain[:5], ["one"], []):
        alone = [sub.encoding.encode_ordinary(" " + w) for w in some]
        sizes, ids = spy.encode(some)
        assert sizes.tolist() == [len(x) for x in alone] and ids.tolist() == [i for x in alone for i in x]
        assert (sizes.dtype, ids.dtype) == (np.int64, np.int32)
    calls.clear()
    spy.encode(plain)
    assert len(calls) < 10


def plain_steps(w, table, b, rate):
    """Weights after Adam over dense gradients, every moment kept, as in the formula."""
    w = {k: x.copy() for k, x in w.items()}
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    for t, at in enumerate(range(0, b.n, A.STEP), 1):
        cut, opens = slice(at * A.SPAN, (at + A.STEP) * A.SPAN), b.opens[at : at + A.STEP].copy()
        opens[0] = True
        g = A.gradient(w, table, A.Room(), b.now[cut], b.before[cut], b.kind[cut], b.real[cut], opens)[2]
        for k, x in w.items():
            m[k] = np.float32(0.9) * m[k] + np.float32(0.1) * g[k]
            v[k] = np.float32(0.99) * v[k] + np.float32(0.01) * g[k] * g[k]
            x -= np.float32(rate * math.sqrt(1 - 0.99**t) / (1 - 0.9**t)) * m[k] / (np.sqrt(v[k]) + np.float32(1e-8))
    return w


def test_rows_that_were_read_once_hold_no_denormal_moments(model):
    # Ids of the first text are not seen again for more than a thousand steps: 0.9 to the power of 1000 is below the smallest float.
    _, (ids, per_text, _, _) = ids_of(model, ["the and of a in to " * 90, *["x y " * 250] * 1100])
    b = model.blocks(ids, per_text)
    adam = A.Adam({k: x.copy() for k, x in model.weights.items()}, 4e-3)
    A.learn(adam, model.table, b)
    assert adam.t > 1000
    for moment in (adam.m, adam.v):
        some = np.concatenate([np.ravel(x) for x in moment.values()]) if isinstance(moment, dict) else moment
        assert not ((some != 0) & (np.abs(some) < np.finfo(np.float32).tiny)).any()
    want = plain_steps(model.weights, model.table, b, 4e-3)
    assert all(np.array_equal(adam.w[k], want[k]) for k in want)


def test_logits_and_scores_beyond_the_limit_are_held(model):
    _, (ids, per_text, _, _) = ids_of(model, ["the and of " * 30, "x"])
    b = model.blocks(ids, per_text)
    args = b.now, b.before, b.kind, b.real, b.opens
    high = model.table.copy()
    high[:, 3] += 200  # its exponential is beyond the largest float
    held_table = np.where(np.arange(A.CLASSES) == 3, np.float32(1000), model.table)
    w = {**model.weights, "w_out": np.zeros_like(model.weights["w_out"])}
    one, two = (A.gradient(w, t, A.Room(), *args) for t in (high, held_table))
    assert math.isfinite(one[0]) and one[0] == two[0] and all(np.array_equal(one[2][k], two[2][k]) for k in w)
    near = {**model.weights, "near": np.full(2 * A.SPAN, 500, np.float32)}
    loss, _, g = A.gradient(near, model.table, A.Room(), *args)
    # All scores are at the limit, so all keys weigh the same.
    flat = A.gradient({**near, "near": np.zeros(2 * A.SPAN, np.float32), "query": np.zeros_like(near["query"])}, model.table, A.Room(), *args)
    assert math.isclose(loss, flat[0], rel_tol=1e-5) and all(np.isfinite(g[k]).all() for k in g)
