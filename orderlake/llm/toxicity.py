"""Toxicity by maximum-scoring segments over token log-odds.

Training: for each feature of a word (the word, its first four and five
characters) the log-odds between toxic and clean labelled documents, with a
Dirichlet prior that is the feature's share of all documents.  Features whose
log-odds are significant are the model; every other token scores the small
negative log-odds of an ordinary token.

Scoring: a linear scan finds all maximal segments of a text (Ruzzo and Tompa).
Extreme-value statistics say how many segments like the significant ones a
clean text of that length has by chance; the logarithm of that is the text's
excess, and a logistic curve over it, fitted on labelled documents that had no
part in the weights, is the score.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import checkpoint, forget, map_arrow

#: Labelled rows that training uses at most; a larger table is thinned by a hash of the identifier.
MAX_LABELLED = 200_000
#: Tasks that share these rows; each sends one row per feature that it meets.
LABEL_TASKS = 12
#: A feature is listed if this many toxic training texts have it, and used if the signed root of its likelihood ratio is above MIN_Z.
MIN_TEXTS, MIN_Z = 4, 4.0
#: Weight of the prior in documents: the same for each feature, and shared out as the features are over all documents.
FLAT, PRIOR = 1.0, 20.0
#: One labelled document in so many is kept for calibration and not used for the weights.
CALIBRATE = 5
#: Share of clean labelled texts that may be labelled wrongly; so many of the best clean segments don't count for K.
LABEL_NOISE = 0.002
#: The excess of a text without any segment, and the largest that counts.
NONE, MOST = -12.0, 40.0
#: Words whose weight a task remembers at most.
CACHE = 200_000

_STRIP = string.punctuation + "“”‘’«»¡¿…"


def features(word: str) -> list[str]:
    """Features of a word; none for one without letters or digits."""
    w = word.lower().strip(_STRIP)
    if not w:
        return []
    return [w, *(f"^{w[:n]}" for n in (4, 5) if len(w) >= n)]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def count_features(texts: DataFrame, listed: set[str] | None) -> DataFrame:
    """(feature, n): the number of texts that have each feature, with ``listed`` of those only."""
    sent = None if listed is None else texts.sparkSession.sparkContext.broadcast(listed)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = None if sent is None else sent.value
        known: dict[str, tuple[str, ...]] = {}
        counts: Counter = Counter()
        emit = lambda: pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["feature", "n"])
        for batch in batches:
            for text in batch.column(0).to_pylist():
                has: set[str] = set()
                for w in set((text or "").split()):
                    f = known.get(w)
                    if f is None:
                        forget(known, CACHE)
                        f = known[w] = tuple(x for x in features(w) if keep is None or x in keep)
                    if f:
                        has.update(f)
                counts.update(has)
            if len(counts) > CACHE:
                yield emit()
                counts = Counter()
        yield emit()

    return map_arrow(texts.select("text"), count, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def training_texts(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """(text, toxic, later) of the labelled rows to learn from: not held out, one for each different text.

    ``later`` marks those that are kept for calibration.  At most
    ``max_labelled`` texts, so they are read from ``docs`` once and kept in
    LABEL_TASKS partitions for all later steps.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if n > max_labelled:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(0.98e6 * max_labelled / n))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sha = F.sha2(F.encode("text", "UTF-8"), 256)
    # ``known`` has at most max_labelled rows of two numbers.
    found = texts.join(F.broadcast(known), "doc_id").withColumn("sha", sha).repartition(LABEL_TASKS, "sha")
    later = F.pmod(F.xxhash64("doc_id", F.lit("later")), F.lit(CALIBRATE)) == 0
    one = Window.partitionBy("sha").orderBy("doc_id", "toxic")
    return checkpoint(found.withColumn("at", F.row_number().over(one)).where("at = 1").select("text", "toxic", later.alias("later")))


class Model:
    """Weights of the significant features, the score of all other tokens, and the EVD constant."""

    def __init__(self, weights: dict[str, float], other: float, k: float = 0.0, slope: float = 0.0, offset: float = -20.0):
        self.weights, self.other, self.k, self.slope, self.offset = weights, other, k, slope, offset
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def weight(self, word: str) -> float:
        w = self.known.get(word)
        if w is None:
            forget(self.known, CACHE)
            w = self.known[word] = max((self.weights.get(f, 0.0) for f in features(word)), default=0.0)
        return w

    def segments(self, text: str | None) -> tuple[int, list[tuple[float, int, int]]]:
        """Number of tokens, and (score, first token, last token) of all maximal segments, in order."""
        words = (text or "").split()
        known, weight = self.known, self.weight
        hits = [(i, s) for i, s in enumerate([known.get(w) if w in known else weight(w) for w in words]) if s > 0]
        total, out, last = 0.0, [], -1  # out: [left sum, right sum, first, last]
        for i, s in hits:
            total += self.other * (i - last - 1)
            last = i
            seg = [total, total + s, i, i]
            total += s
            # Join with the nearest earlier segment that starts lower, as long as the join ends higher.
            j = len(out) - 1
            while True:
                while j >= 0 and out[j][0] >= seg[0]:
                    j -= 1
                if j < 0 or out[j][1] >= seg[1]:
                    out.append(seg)
                    break
                seg = [out[j][0], seg[1], out[j][2], seg[3]]
                del out[j:]
                j = len(out) - 1
        return len(words), [(r - l, a, b) for l, r, a, b in out]

    def excess(self, n: int, segments: list[tuple[float, int, int]]) -> float:
        """Extreme-value excess of a text: minus the logarithm of the number of such segments expected by chance.

        A clean text of n tokens has K n exp(-S) segments of score S or more;
        each further significant segment adds its own excess over ln(K n).
        """
        if not segments:
            return NONE
        space = math.log(max(self.k * max(n, 1), 1e-12))
        each = sorted((s - space for s, _, _ in segments), reverse=True)
        return min(max(each[0] + sum(max(0.0, e) for e in each[1:]), NONE), MOST)

    def score(self, n: int, segments: list[tuple[float, int, int]]) -> float:
        """Probability of the toxic label at this excess."""
        return 1 / (1 + math.exp(-(self.slope * self.excess(n, segments) + self.offset)))


def root_ratio(y1: int, y0: int, n1: int, n0: int) -> float:
    """Signed root of the likelihood ratio of y1 in n1 against y0 in n0."""
    e1, e0 = (y1 + y0) * n1 / (n1 + n0), (y1 + y0) * n0 / (n1 + n0)
    g = 2 * sum(y * math.log(y / e) for y, e in ((y1, e1), (y0, e0)) if y)
    return math.copysign(math.sqrt(max(g, 0.0)), y1 - e1)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Fit on the labelled rows that aren't held out; the prior comes from all documents.

    The score of other tokens, the EVD constant and the logistic curve come
    from the labelled rows set aside for calibration (one in CALIBRATE, of at
    most ``max_labelled`` rows), which have no part in the weights.
    """
    rows = training_texts(docs, labels, max_labelled)
    fit = rows.where("NOT later")
    n = {r["toxic"]: r["n"] for r in fit.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        return Model({}, -0.01)  # no evidence: every score is next to 0
    toxic = count_features(fit.where("toxic = 1"), None).where(F.col("n") >= MIN_TEXTS)
    in_toxic = {r["feature"]: r["n"] for r in toxic.collect()}  # features of max_labelled texts
    in_clean = {r["feature"]: r["n"] for r in count_features(fit.where("toxic = 0"), set(in_toxic)).collect()}
    # Whether a feature tells the labels apart needs no prior, so only those that do are counted over all documents.
    told = {f: (n1, in_clean.get(f, 0)) for f, n1 in in_toxic.items() if root_ratio(n1, in_clean.get(f, 0), n_toxic, n_clean) >= MIN_Z}
    n_all = docs.count()
    weights = {}
    for r in count_features(docs.select(F.col("text").cast("string").alias("text")), set(told)).collect():
        n1, n2 = told[r["feature"]]
        share = r["n"] / max(n_all, 1)
        a = FLAT + PRIOR * share
        y1, y0 = n1 + a, n2 + a
        odds = math.log(y1 / max(n_toxic + FLAT + PRIOR - y1, 0.5)) - math.log(y0 / max(n_clean + FLAT + PRIOR - y0, 0.5))
        if odds > 1:
            weights[r["feature"]] = odds
    model = Model(weights, 0.0)
    # Calibrated on documents that had no part in the weights.
    toxic_share, clean_share, clean_hits, tokens = _calibrate(rows.where("later"), model)
    model.other = math.log((1 - toxic_share) / (1 - min(clean_share, 0.5 * toxic_share))) if toxic_share > 0 else -0.01
    model.other = min(model.other, -1e-3)
    # K: the largest K for which K N exp(-S) is the number of clean segments of score S or more (one half added).
    scores = np.sort(np.array(clean_hits))[::-1]
    k = 0.5 * math.exp(min(weights.values(), default=0.0)) / max(tokens, 1)
    noise = int(LABEL_NOISE * n_clean / CALIBRATE)
    for rank, s in enumerate(scores[noise:], 1):
        k = max(k, (rank + 0.5) * math.exp(min(s, 50.0)) / max(tokens, 1))
    model.k = k
    model.slope, model.offset = _logistic(_excesses(rows.where("later"), model))
    return model


def _excesses(rows: DataFrame, model: Model) -> list[tuple[float, int, int]]:
    """(excess in steps of 1/4, label, number of documents) of the calibration documents."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, out = sent.value, Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out[round(4 * m.excess(*m.segments(text))) / 4, toxic] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in out], pa.float64()), pa.array([y for _, y in out], pa.int32()), pa.array(list(out.values()), pa.int64())], ["x", "toxic", "n"]
        )

    found = map_arrow(rows.select("text", "toxic"), scan, "x double, toxic int, n long").groupBy("x", "toxic").agg(F.sum("n").alias("n"))
    return [(r["x"], r["toxic"], r["n"]) for r in found.collect()]  # a few hundred steps at most


def _logistic(rows: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and offset of the label's log-odds by the excess (ridge 0.01, Newton's method; the slope is never negative)."""
    x, y, n = (np.array([r[i] for r in rows], float) for i in range(3))
    if not len(rows) or not (y * n).sum() or not ((1 - y) * n).sum():
        return 1.0, 0.0  # one label only: even odds where one such segment is expected by chance
    a, b = 0.5, -1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(n * (y - p) * x).sum() - 0.01 * a, (n * (y - p)).sum() - 0.01 * b])
        w = n * p * (1 - p)
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-6:
            break
    return max(float(a), 0.0), float(b)


def _calibrate(rows: DataFrame, model: Model) -> tuple[float, float, list[float], int]:
    """Shares of tokens with weight in toxic and clean texts; the scores of clean segments, rounded and counted; clean tokens."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, out = sent.value, Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, segments = m.segments(text)
                out[f"n{toxic}", 0.0] += n
                for s, a, b in segments:
                    # Without a cost for other tokens one segment holds all hits: its score is that of the text.
                    out[f"h{toxic}", 0.0] += sum(1 for w in text.split()[a : b + 1] if m.weight(w) > 0)
                    out[f"s{toxic}", round(s, 1)] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in out], pa.string()), pa.array([x for _, x in out], pa.float64()), pa.array(list(out.values()), pa.int64())], ["kind", "x", "n"]
        )

    found = map_arrow(rows.select("text", "toxic"), scan, "kind string, x double, n long").groupBy("kind", "x").agg(F.sum("n").alias("n")).collect()
    get = lambda kind: sum(r["n"] for r in found if r["kind"] == kind)
    clean = [r["x"] for r in found if r["kind"] == "s0" for _ in range(r["n"])]
    return get("h1") / max(get("n1"), 1), get("h0") / max(get("n0"), 1), clean, get("n0")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, and segments (start and end token, score) for every row.

    Null and empty texts have no segment and get the lowest score; null or
    repeated identifiers are rows like any other; without labels of both kinds
    every score is next to 0; an empty table
    gives no rows; extra columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int, segments array<struct<first:int,last:int,score:double>>"

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            scores, found = [], []
            for text in batch.column(2).to_pylist():
                n, segments = m.segments(text)
                scores.append(m.score(n, segments))
                found.append([{"first": a, "last": b, "score": s} for s, a, b in segments])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(found, kind)],
                ["doc_id", "held_out", "score", "predicted", "segments"],
            )

    return map_arrow(rows, scan, schema)


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text is not predicted toxic, all columns kept; no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            clean = [m.score(*m.segments(text)) < 0.5 for text in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return map_arrow(docs, keep, docs.schema)
