"""Texts of Arrow batches as coded words: bounded chunks, split and dictionary-encoded without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def chunks(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Batches (the last column is the text) joined up to ``most`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        texts = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(texts.tolist()):
            if size + total + n > most and (held or i > start):
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(held)
                held, size, start, total = [], 0, i, 0
            total += n
        if batch.num_rows > start:
            held.append(batch.slice(start))
            size += total
    if held:
        yield pa.Table.from_batches(held)


def coded_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes of all words in order, the distinct words, and the number of words of each text (strings without nulls).

    A word is a run of characters other than ``[\\x20\\x09-\\x0D]``.
    """
    plain = pc.ascii_trim_whitespace(texts)
    lists = pc.ascii_split_whitespace(plain)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    every = lists.flatten()
    empty = pc.binary_length(plain).to_numpy(zero_copy_only=False) == 0
    if empty.any():  # an empty text splits into one empty word
        every = every.filter(pc.greater(pc.binary_length(every), 0))
        sizes[empty] = 0
    coded = every.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, sizes


def gather(codes: np.ndarray, sizes: np.ndarray, per_word: np.ndarray, ids: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts, each closed by ``end``; their number per text; and per word, the ends included.

    ``ids`` has the ids of the distinct words one after the other, ``per_word`` of each.
    """
    length = np.append(per_word, 1)
    start = np.cumsum(length) - length
    every = np.append(ids, ids.dtype.type(end))
    line = np.full(len(codes) + len(sizes), len(per_word), np.int64)
    closes = np.cumsum(sizes + 1) - 1
    inner = np.ones(len(line), bool)
    inner[closes] = False
    line[inner] = codes
    n = length[line]
    flat = every[np.repeat(start[line] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    per_text = np.add.reduceat(n, closes - sizes) if len(sizes) else np.zeros(0, np.int64)
    return flat, per_text, n
