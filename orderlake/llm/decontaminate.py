"""Benchmark decontamination by q-gram lemma filtering.

Texts are compared by their letters and digits in lower case (white space and
punctuation left out, so a passage survives re-flowing).  An item of m such
bytes with at most e edits shares at least ``m - q + 1 - q * e`` of its q-grams
with its copy, all of them within e diagonals of each other.  So q-gram hits
are counted in overlapping diagonal bands, bands below that bound are dropped,
and what remains is verified by a banded alignment.

Only whole items are matched: the budget of edits is that of the whole item, so
a part of an item, however long, is no match.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm import textbytes as B
from orderlake.llm.common import map_arrow

Q = 8
#: Share of an item's letters and digits that may be edited.
RATE = 0.08
#: Item text in one broadcast; more items are matched in blocks, a scan of the documents for each.
BLOCK_BYTES = 8 << 20


def squeeze(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Letters and digits in lower case, and their places in the text."""
    raw = np.frombuffer(text, np.uint8)
    at = np.flatnonzero(B.ALNUM[raw])
    return B.LOWER[raw[at]], at


class Items:
    """Index of a block of benchmark items by q-gram."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = RATE):
        self.ids = [i for i, _ in items]
        self.texts = [squeeze(t.encode("utf-8", "surrogatepass"))[0] for _, t in items]
        self.edits = np.array([min(int(rate * len(t)), max(0, (len(t) - Q) // Q)) for t in self.texts], np.int64)
        self.least = np.array([len(t) - Q + 1 - Q * e for t, e in zip(self.texts, self.edits, strict=True)], np.int64)
        grams = [B.byte_grams(t) for t in self.texts]
        n = [len(g) for g in grams]
        self.index = B.Postings(
            np.concatenate([*grams, np.zeros(0, np.uint64)]),
            np.repeat(np.arange(len(items)), n),
            np.concatenate([*(np.arange(x) for x in n), np.zeros(0, np.int64)]).astype(np.int64),
        )

    def regions(self, text: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, lowest diagonal, highest diagonal) of bands with enough shared q-grams."""
        pos, item, offset = self.index.hits(B.byte_grams(text))
        if not len(pos):
            return
        diagonal = pos - offset + (1 << 40)
        step = np.maximum(self.edits[item], 1)
        band = diagonal // step
        # A band is two steps wide and starts at each step, so any e + 1 diagonals lie in one.
        key = np.concatenate([item * (1 << 42) + band, item * (1 << 42) + band - 1])
        key, count = np.unique(key, return_counts=True)
        item, band = key >> 42, key & ((1 << 42) - 1)
        ok = count >= self.least[item]
        for i, b in zip(item[ok], band[ok], strict=True):
            step = max(int(self.edits[i]), 1)
            low = int(b) * step - (1 << 40)
            yield int(i), low, low + 2 * step - 1


def matches(items: Items, text: np.ndarray) -> dict[int, tuple[int, int, int]]:
    """Best verified stretch for each item: (edits, start, end) in squeezed bytes."""
    found: dict[int, tuple[int, int, int]] = {}
    for i, low, high in items.regions(text):
        if found.get(i, (1,))[0] == 0:
            continue
        item, e = items.texts[i], int(items.edits[i])
        begin, end = max(0, low - e), min(len(text), high + len(item) + e)
        part = text[begin:end]
        exact = part.tobytes().find(item.tobytes())
        if exact >= 0:
            got = (0, begin + exact, begin + exact + len(item))
        else:
            cost, s, t = B.banded_alignment(item, part, low - e - begin, high + e - begin)
            got = (cost, begin + s, begin + t)
        if got[0] <= e and (i not in found or got < found[i]):
            found[i] = got
    return found


SCHEMA = "doc_id long, item_id long, edits long, start long, end long"


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of bounded size, each small enough for the driver and a broadcast."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield [(r["item_id"], r["text"]) for r in rows]


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """One row per (document, item) found: doc_id, item_id, edits, start, end (code points of the text).

    ``docs`` has doc_id and text, ``benchmark`` item_id and text.  Null texts
    match nothing, items of fewer than q letters and digits neither; null or
    repeated identifiers are rows like any other; an empty table on either
    side gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], SCHEMA)
    for k, block in enumerate(item_blocks(benchmark)):
        sent = spark.sparkContext.broadcast(block)

        def scan(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = Items(sent.value, rate)
            for batch in batches:
                out: list[list] = [[] for _ in range(5)]
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if not text:
                        continue
                    raw = text.encode("utf-8", "surrogatepass")
                    squeezed, at = squeeze(raw)
                    for i, (edits, start, end) in sorted(matches(items, squeezed).items()):
                        a, b = (int(at[start]), int(at[end - 1]) + 1) if end > start else (0, 0)
                        begin = len(raw[:a].decode("utf-8", "ignore"))
                        row = (doc, items.ids[i], edits, begin, begin + len(raw[a:b].decode("utf-8", "ignore")))
                        for c, v in zip(out, row, strict=True):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc_id", "item_id", "edits", "start", "end"])

        part = map_arrow(rows, scan, SCHEMA)
        out = part if k == 0 else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns kept; no shuffle."""
    at = docs.columns.index("text")
    for block in item_blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = Items(sent.value, rate)
            for batch in batches:
                clean = [not matches(items, squeeze((t or "").encode("utf-8", "surrogatepass"))[0]) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = map_arrow(docs, keep, docs.schema)
    return docs
