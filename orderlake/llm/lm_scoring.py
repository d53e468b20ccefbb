"""LM scoring: a causal self-attention model over subword ids, beside a word unigram.

1. Words of all training texts are counted (one shuffle of distinct words per task).
2. The counts of subword ids follow from the words' counts.  The most frequent
   ids are classes of their own; the others are grouped by the ids that stand
   beside them in words.
3. The attention model (``attention``) learns from every training text, in
   ROUNDS rounds that share the texts out: in each, every task walks its texts
   from the same weights, and Spark averages what the tasks learned, weighted
   by their positions.
4. Every text is scored in overlapping windows.  The network spells a word as
   its ids and the opening of the next word; the model's probability of a word
   mixes that with the word's share of the training tokens, so it
   adds up to one over all words.  Frequent words are looked up in a broadcast
   list; the counts of all other words are joined.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm import attention
from orderlake.llm.common import checkpoint, map_arrow, sum_vectors
from orderlake.llm.wordchunks import chunks, coded_words, gather

#: Words that are sent to all tasks at most; the counts of the others are joined.
HOT_WORDS = 200_000
#: Every training text is walked in one of ROUNDS rounds, at these rates.
RATES = (4e-3, 1.5e-3)
ROUNDS = len(RATES)
#: Bytes of text that a task counts or scores at once (a longer text is taken alone).
COUNT_BYTES, SCORE_BYTES = 8_000_000, 2_000_000
#: Words that the tokenizer takes in one call.
ENCODED = 1000
#: Weight of a word's share of the training tokens; the rest is the network's.
MIX = 0.3
#: Added to a word's count, and to an id's count within its class.
SMOOTH = 0.1


def crc_of(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8"))


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """A byte-level tokenizer: its ids spell the text, so different texts have different ids."""
    import public_tokenizers

    return public_tokenizers.path(name)


# --- words ----------------------------------------------------------------------------


def words(texts: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes of all words in order, the distinct words, and the number of words of each text; A-Z become a-z."""
    return coded_words(pc.ascii_lower(pc.fill_null(texts.combine_chunks(), "")))


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts; the null word is the end of a text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in chunks(batches, COUNT_BYTES):
            codes, distinct, sizes = words(t.column(0))
            n = np.bincount(codes, minlength=len(distinct))
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([distinct, pa.nulls(1, pa.string())]), pa.array(np.append(n, len(sizes)))], ["word", "n"])

    return map_arrow(texts.select(F.col("text").cast("string").alias("text")), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# --- subwords -------------------------------------------------------------------------


class Subwords:
    """Ids of words; each is encoded with the space before it, as it stands in a text."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1  # a number of its own for the end of a text
        # A word has no space inside, so the ids that start with one, and the end, are those that open a word.
        self.opens = np.ones(self.end + 1, bool)
        for piece, i in ranks.items():
            self.opens[i] = piece.startswith(b" ")

    def encode(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids in order."""
        sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for at in range(0, len(some), ENCODED):
            part = some[at : at + ENCODED]
            text = " ".join(part)
            # Many words in one call: its ids are those of the words if no word has white space of any kind inside.
            out = [self.encoding.encode_ordinary(" " + w) for w in ([text] if text.split() == part else part)]
            ids += [np.array(x, np.int32) for x in out]
            sizes.append(np.fromiter(map(len, out), np.int64, len(out)) if len(out) == len(part) else np.diff(np.flatnonzero(self.opens[ids[-1]]), append=len(ids[-1])))
        return np.concatenate(sizes), np.concatenate(ids)


_subwords: dict[str, Subwords] = {}


def subwords(path: str) -> Subwords:
    if path not in _subwords:
        _subwords[path] = Subwords(path)
    return _subwords[path]


def encode_words(counts: DataFrame, path: str) -> DataFrame:
    """``counts`` with the ids of each word; the null word is the end."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sub = subwords(path)
        for b in batches:
            some = b.column(0).to_pylist()
            known = [w for w in some if w is not None]
            sizes, ids = sub.encode(known)
            if len(known) < len(some):  # one word at most is null
                at = some.index(None)
                ids = np.insert(ids, int(sizes[:at].sum()), sub.end)
                sizes = np.insert(sizes, at, 1)
            offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))], ["word", "n", "ids"])

    return map_arrow(counts.select("word", "n"), run, "word string, n long, ids array<int>")


def _id_runs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of (n, ids): each word's count and number of ids, and all ids."""
    n, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
    return n, pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten().to_numpy(zero_copy_only=False)


def count_ids(encoded: DataFrame, size: int) -> np.ndarray:
    """Training occurrences of each of ``size`` ids, from the words' counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            n, sizes, ids = _id_runs(b)
            total += np.bincount(ids, np.repeat(n, sizes), size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used].astype(np.int64))], ["id", "n"])

    found = map_arrow(encoded.select("n", "ids"), run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # at most the vocabulary
    out = np.zeros(size, np.int64)
    for r in found:
        out[r["id"]] = r["n"]
    return out


def _summed(encoded: DataFrame, cells, rows: int, wide: int) -> np.ndarray:
    """A table of rows x wide: ``cells`` gives flat places and weights for the words of a batch; only used rows are sent."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(rows * wide), [], 0

        def add() -> None:
            if held:
                place, weight = (np.concatenate(c) for c in zip(*held, strict=True))
                np.add(total, np.bincount(place, weight, len(total)), out=total)
                held.clear()

        for b in batches:
            for pair in cells(*_id_runs(b)):
                held.append(pair)
                size += len(pair[0])
            if size > len(total):  # a table's worth of entries at a time
                add()
                size = 0
        add()
        total = total.reshape(rows, wide)
        used = np.flatnonzero(total.any(axis=1))
        part = [TaskContext.get().partitionId()] * len(used)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(part, pa.int64()), pa.array(list(total[used]), pa.list_(pa.float64()))], ["key", "part", "values"])

    words_only = encoded.where("word IS NOT NULL").select("n", "ids")
    found = sum_vectors(map_arrow(words_only, run, "key long, part long, values array<double>")).toArrow()  # ``rows`` rows at most
    out = np.zeros((rows, wide))
    out[found.column("key").to_numpy()] = pc.list_flatten(found.column("values")).to_numpy().reshape(-1, wide)
    return out


def beside(encoded: DataFrame, rank: np.ndarray) -> np.ndarray:
    """For each of the ROWS most frequent ids, how often each SINGLE id stands before and after it in words."""
    wide = 2 * (attention.SINGLE + 1)

    def cells(n: np.ndarray, sizes: np.ndarray, ids: np.ndarray):
        r, weight = np.minimum(rank[ids], attention.ROWS), np.repeat(n, sizes)
        opens = np.zeros(len(ids) + 1, bool)
        opens[np.cumsum(sizes) - sizes] = True
        single = np.minimum(r, attention.SINGLE)
        own = np.flatnonzero((r < attention.ROWS) & ~opens[:-1])
        yield r[own] * wide + single[own - 1], weight[own]
        own = np.flatnonzero((r[:-1] < attention.ROWS) & ~opens[1:-1])
        yield r[own] * wide + attention.SINGLE + 1 + single[own + 1], weight[own]

    return _summed(encoded, cells, attention.ROWS, wide)


def follows(encoded: DataFrame, opens: np.ndarray, row_of: np.ndarray, class_of: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How often each class follows each row of the embedding.

    Inside words these are counts.  After the last id of a word comes an
    opening id, whatever the word: those are shared out by the classes' shares
    of openings.
    """
    wide = attention.CLASSES + 1

    def cells(times: np.ndarray, sizes: np.ndarray, ids: np.ndarray):
        after = np.append(class_of[ids[1:]], wide - 1)
        after[(np.cumsum(sizes) - 1)[sizes > 0]] = wide - 1
        yield row_of[ids].astype(np.int64) * wide + after[: len(ids)], np.repeat(times, sizes)

    out = _summed(encoded, cells, attention.ROWS + 1, wide)
    out[row_of[-1], -1] += n[-1]  # the end of a text, too, is followed by an opening
    opening = np.bincount(class_of[opens], n[opens] + SMOOTH, attention.CLASSES)
    return out[:, :-1] + out[:, -1:] * opening / opening.sum()


def classes(n: np.ndarray, opens: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Class of each id: the SINGLE most frequent are alone, the others are grouped by their neighbours (spherical k-means).

    Ids that open a word and ids that don't are never in one class; the last
    two classes have the ids beyond ROWS.
    """
    order = np.argsort(-n, kind="stable")
    out = np.where(opens, attention.CLASSES - 1, attention.CLASSES - 2)
    out[order[: attention.SINGLE]] = np.arange(attention.SINGLE)
    tail = order[attention.SINGLE : attention.ROWS]
    x = np.sqrt(context[attention.SINGLE : attention.SINGLE + len(tail)])
    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-12
    weight = np.sqrt(n[tail] + 1.0)[:, None]
    room = attention.CLASSES - attention.SINGLE - 2
    at = attention.SINGLE
    for kind, k in ((True, room // 2), (False, room - room // 2)):
        own = np.flatnonzero(opens[tail] == kind)
        if len(own):
            out[tail[own]] = at + _k_means(x[own], weight[own], min(k, len(own)))
        at += k
    return out


def _k_means(x: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """Groups of unit rows around k centres, which start among the first quarter of the rows."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int) // 4]
    centres = centres + 0.01 * np.random.default_rng(5).standard_normal(centres.shape)
    group = np.zeros(len(x), np.int64)
    for _ in range(15):
        group = (x @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, group, x * weight)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(size > 0, total / (size + 1e-12), centres)
    return group


# --- model ----------------------------------------------------------------------------


class Model:
    """What scoring needs: the frequent words with their counts and ids, the ids' classes and shares, and the weights."""

    def __init__(self, path: str, hot: pa.Array, hot_n: np.ndarray, ends: int, tokens: int, distinct: int, n: np.ndarray, class_of: np.ndarray, row_of: np.ndarray):
        self.path, self.hot, self.hot_n, self.ends, self.tokens, self.distinct = path, hot, hot_n, ends, tokens, distinct
        self.class_of, self.row_of = class_of.astype(np.int32), row_of.astype(np.int32)
        self.opening = np.zeros(attention.CLASSES)
        self.opening[class_of[subwords(path).opens]] = 1
        mass = np.bincount(class_of, n + SMOOTH, attention.CLASSES)
        self.log_within = np.log((n + SMOOTH) / mass[class_of])  # an id's share of its class
        self.share = np.maximum(mass, SMOOTH) / np.maximum(mass, SMOOTH).sum()
        self.weights: dict[str, np.ndarray] = {}
        self.table = np.zeros((attention.ROWS + 1, attention.CLASSES), np.float32)
        self.hot_sizes, self.hot_ids = subwords(path).encode(hot.to_pylist())

    def ids(self, codes: np.ndarray, distinct: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Subword ids of all texts of a chunk, each closed by the end; their number per text, and per word (the end is one).

        Last, each distinct word's place in the list (or -1).
        """
        sub = subwords(self.path)
        at = pc.fill_null(pc.index_in(distinct, value_set=self.hot), -1).to_numpy(zero_copy_only=False)
        rare = np.flatnonzero(at < 0)
        rare_sizes, rare_ids = sub.encode(distinct.take(pa.array(rare)).to_pylist())
        # The ids of the distinct words in their order: from the list, or just encoded.
        every, hot = np.concatenate([self.hot_ids, rare_ids]), np.flatnonzero(at >= 0)
        length, start = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
        hot_start = np.cumsum(self.hot_sizes) - self.hot_sizes
        length[hot], start[hot] = self.hot_sizes[at[hot]], hot_start[at[hot]]
        length[rare], start[rare] = rare_sizes, len(self.hot_ids) + np.cumsum(rare_sizes) - rare_sizes
        of_words = every[np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))]
        return *gather(codes, sizes, length, of_words, sub.end), at

    def blocks(self, ids: np.ndarray, per_text: np.ndarray) -> attention.Blocks:
        return attention.Blocks(ids, per_text, self.row_of, self.class_of, len(self.row_of) - 1)


def _averaged(texts: DataFrame, model: Model, rate: float) -> dict[str, np.ndarray] | None:
    """Weights after a round: every task learns on its texts from the model's weights; their mean, weighted by positions (None: no texts)."""
    sent = texts.sparkSession.sparkContext.broadcast(model)
    block = 4096

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        adam, room, seen = attention.Adam({k: x.copy() for k, x in m.weights.items()}, rate), attention.Room(), 0.0
        for t in chunks(batches, SCORE_BYTES):
            ids, per_text, _, _ = m.ids(*words(t.column(0)))
            seen += attention.learn(adam, m.table, m.blocks(ids, per_text), room)[1]
        if seen:
            all_weights = np.append(attention.flat(adam.w), 1.0) * seen
            rows = [all_weights[i : i + block] for i in range(0, len(all_weights), block)]
            part = [TaskContext.get().partitionId()] * len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(rows)), pa.int64()), pa.array(part, pa.int64()), pa.array(rows, pa.list_(pa.float64()))], ["key", "part", "values"]
            )

    rows = sum_vectors(map_arrow(texts.select("text"), run, "key long, part long, values array<double>")).orderBy("key").collect()  # the size of the weights
    if not rows:
        return None
    total = np.concatenate([np.array(r["values"]) for r in rows])
    return attention.unflat(total[:-1] / total[-1])


def train(texts: DataFrame, path: str, hot_words: int = HOT_WORDS) -> tuple[Model, DataFrame]:
    """The model of the training texts (doc_id, text), and the counts of the words that it doesn't list."""
    counts = checkpoint(encode_words(count_words(texts), path))
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.when(F.col("word").isNull(), F.col("n"))).alias("e")).first()
    # The list is cut at a count, found from a histogram of the counts' logarithms (16 steps to a factor of 2).
    level = F.floor(F.log2(F.col("n")) * 16)
    known = counts.where("word IS NOT NULL")
    steps = known.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("level")).collect()  # a thousand at most
    least, room = math.inf, hot_words
    for r in steps:
        room -= r["words"]
        if room < 0:
            break
        least = r["level"]
    listed = level >= F.lit(float(least))
    hot = known.where(listed).select("word", "n").orderBy("word").toArrow()  # hot_words at most
    hot_word = pa.concat_arrays([c.cast(pa.string()) for c in hot.column("word").chunks]) if hot.num_rows else pa.array([], pa.string())
    sub = subwords(path)
    n = count_ids(counts, sub.end + 1)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(n), np.int64)
    rank[order] = np.arange(len(n))
    row_of = np.minimum(rank, attention.ROWS)
    class_of = classes(n, sub.opens, beside(counts, rank))
    model = Model(path, hot_word, hot.column("n").to_numpy().astype(np.int64), int(total["e"] or 0), int(total["n"] or 0), int(total["v"]), n, class_of, row_of)
    after = follows(counts, sub.opens, row_of, class_of, n)
    model.table, model.weights = attention.bigrams(after, model.share), attention.initial(after, model.share)
    part = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("fit")), F.lit(ROUNDS))
    for k, rate in enumerate(RATES):
        model.weights = _averaged(texts.where(part == k), model, rate) or model.weights
    return model, known.where(~listed)


def score(docs: DataFrame, model: Model, rest: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row, in the order of no column.

    ``rest`` has the counts of the words that the model doesn't list; they are joined to the words of each text that need them.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        scorer = attention.Scorer(m.weights, m.table, m.opening)
        hot_log, hot_share = np.log10(m.hot_n + SMOOTH), m.hot_n / max(m.tokens, 1)
        for t in chunks(batches, SCORE_BYTES):
            codes, distinct, sizes = words(t.column(2))
            ids, per_text, per_word, at = m.ids(codes, distinct, sizes)
            spelled, ends = _spelled(m, scorer, ids, per_text, per_word, sizes)
            closing = np.log10(MIX * m.ends / max(m.tokens, 1) + (1 - MIX) * np.exp(ends))
            text_of = np.repeat(np.arange(len(sizes)), sizes)
            hot = np.flatnonzero(at[codes] >= 0)
            place = at[codes[hot]]
            mixed = np.log10(MIX * hot_share[place] + (1 - MIX) * np.exp(spelled[hot]))
            total = np.bincount(text_of[hot], mixed, len(sizes)) + closing
            base = np.bincount(text_of[hot], hot_log[place], len(sizes)) + math.log10(m.ends + SMOOTH)
            known = np.bincount(text_of[hot], minlength=len(sizes)) + (1 if m.ends else 0)
            # The other words of each text, with the network's logarithm for each.
            rest_of = np.flatnonzero(at[codes] < 0)
            offsets = pa.array(np.searchsorted(text_of[rest_of], np.arange(len(sizes) + 1)).astype(np.int32))
            others = pa.StructArray.from_arrays([distinct.take(pa.array(codes[rest_of])), pa.array(spelled[rest_of])], ["word", "spelled"])
            yield pa.RecordBatch.from_arrays(
                [
                    t.column(0).combine_chunks(), t.column(1).combine_chunks(), pa.array(sizes + 1), pa.array(known.astype(np.int64)), pa.array(base), pa.array(total),
                    pa.ListArray.from_arrays(offsets, others),
                ],
                ["row", "doc_id", "n_tokens", "known", "base", "score", "others"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    schema = f"row long, doc_id {kind}, n_tokens long, known long, base double, score double, others array<struct<word:string,spelled:double>>"
    scored = checkpoint(map_arrow(rows, run, schema))
    others = scored.select("row", F.explode("others").alias("o")).select("row", "o.word", "o.spelled")
    c = F.coalesce(F.col("n"), F.lit(0))
    added = others.join(rest.select("word", "n"), "word", "left").groupBy("row").agg(
        F.sum(F.log10(c + SMOOTH)).alias("more"),
        F.sum((c > 0).cast("long")).alias("more_known"),
        F.sum(_log_mix(c / max(model.tokens, 1), F.col("spelled"))).alias("more_score"),
    )
    norm = math.log10(model.tokens + SMOOTH * (model.distinct + 1))
    return scored.join(added, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def _log_mix(share: Column, spelled: Column) -> Column:
    """log10 of the mixture; a word that was never counted keeps the network's part, however small."""
    return F.when(share > 0, F.log10(MIX * share + (1 - MIX) * F.exp(spelled))).otherwise((spelled + math.log(1 - MIX)) / math.log(10))


def _spelled(m: Model, scorer: attention.Scorer, ids: np.ndarray, per_text: np.ndarray, per_word: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Natural logarithm of the network's probability of each word, and of each text's end.

    A word is its ids, given that a word opens, and the opening of the next
    one; with that last part the words' probabilities add up to one.
    """
    b = m.blocks(ids, per_text)
    each, opening = (x[b.slot].astype(float) for x in scorer.log_probs(b))
    each += m.log_within[ids]
    first = np.cumsum(per_word) - per_word
    word = np.add.reduceat(each, first) if len(first) else np.zeros(0)
    word -= opening[first]
    closes = np.zeros(len(first), bool)
    closes[np.cumsum(sizes + 1) - 1] = True
    inner = np.flatnonzero(~closes)
    word[inner] += opening[first[inner + 1]]
    return word[inner], word[closes]


def lm_scores(docs: DataFrame, path: str, hot_words: int = HOT_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row of ``docs``.

    Rows whose crc32(doc_id as text) is divisible by 10 are held out; all
    others are learned from.  A null text is empty (its end is its only
    token), a null identifier counts as empty text for the remainder; repeated
    rows are scored and learned each.  Without training texts every count is
    zero and the model keeps its first weights.  Other columns are ignored.
    """
    held = crc_of(F.col("doc_id")) % 10 == 0
    texts = docs.where(~held).select("doc_id", F.col("text").cast("string").alias("text"))
    model, rest = train(texts, path, hot_words)
    out = score(docs.select("doc_id", "text"), model, rest)
    return out.select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
