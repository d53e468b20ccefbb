"""Packing into fixed windows by best-fit decreasing.

Each document is tokenised and cut into full windows first; what is left
(shorter than a window) is packed by best fit in decreasing order, where a
segment tree indexed by remaining capacity finds the tightest open window.

Remainders are packed in independent groups of about ``group_rows`` pieces
(identifier and length only), so no task holds more than that; each group
leaves at most a few windows partly filled.  Token ids never leave the task
that made them unless ``with_ids`` asks for them.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import checkpoint, forget, map_arrow
from orderlake.llm.wordchunks import chunks, coded_words, gather

WINDOW = 2048
GROUP_ROWS = 100_000
#: Words (and runs of letters) whose ids a worker remembers at most.
CACHE_WORDS = 200_000
#: Bytes of text that a task tokenises at once (a longer text is taken alone); it holds some 25 times as much meanwhile.
CHUNK_BYTES = 4_000_000


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Words(dict):
    """Little-endian unsigned 32-bit ids of words (UTF-8), remembered up to CACHE_WORDS of them.

    For a BPE tokenizer that splits words into runs of letters, single digits
    and runs of marks, the model itself is asked for each such run; any other
    word (and any word that may hold a special token) goes through the whole
    tokenizer.  Both give the same ids.
    """

    #: Characters for which normalising is lower-casing and the pre-tokenizer is the pattern below.
    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    RUNS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.table = {c: to_bytes.pre_tokenize_str(chr(c))[0][0] for c in [*range(0xDF, 0xF7), *range(0xF8, 0x100)]}
        self.runs: dict[str, bytes] = {}
        # The short way is taken only if this tokenizer is built as assumed.
        self.fast = all(self._short(w) == self._whole(w) for w in ("they're", "The,", "Ça-va!'s", "x9É8?", "straße'll", "übermäßig...", "don't", "A1b2"))

    def _short(self, word: str) -> bytes:
        out = []
        for run in self.RUNS.findall(word.lower()):
            ids = self.runs.get(run)
            if ids is None:
                forget(self.runs, CACHE_WORDS)
                plain = run if run.isascii() else run.translate(self.table)
                ids = self.runs[run] = _bytes([t.id for t in self.model.tokenize(plain)])
            out.append(ids)
        return b"".join(out)

    def _whole(self, word: str) -> bytes:
        return _bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def __missing__(self, raw: bytes) -> bytes:
        forget(self, CACHE_WORDS)
        word = raw.decode("utf-8", "replace")
        ids = self[raw] = self._short(word) if self.fast and "<|" not in word and self.PLAIN.fullmatch(word) else self._whole(word)
        return ids


class WordTokenizer:
    """Ids of whole texts through a tokenizer whose pre-tokens never cross ASCII white space.

    The result equals encoding each text as one string.  Texts are split and
    coded in Arrow, so Python sees each distinct word of a chunk once.
    """

    def __init__(self, path: str):
        self.words = Words(path)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Little-endian unsigned 32-bit ids of all texts (strings without nulls), each closed by ``end_id``; their number per text."""
        codes, distinct, sizes = coded_words(texts)
        raw = [self.words[w] for w in distinct.cast(pa.binary()).to_pylist()]
        per_word = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        ids, per_text, _ = gather(codes, sizes, per_word, np.frombuffer(b"".join(raw), "<u4"), end_id)
        return ids, per_text


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The file of an installed public tokenizer; executors have it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece, and the number of bins.

    The tree's leaves are remaining capacities 0..window with the open bins
    that have exactly that much left; the tightest bin for a piece is in the
    leftmost non-empty leaf at or above its length.
    """
    size = 1
    while size <= window:
        size *= 2
    tree = [0] * (2 * size)
    open_bins: list[list[int]] = [[] for _ in range(size)]

    def change(capacity: int, by: int) -> None:
        i = capacity + size
        while i:
            tree[i] += by
            i >>= 1

    bins, offsets, n = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for k in np.argsort(-lengths, kind="stable"):
        need = int(lengths[k])
        i = need + size
        if not tree[i]:  # climb to the first non-empty subtree on the right, then go down to its leftmost leaf
            while i > 1 and not (i % 2 == 0 and tree[i + 1]):
                i >>= 1
            if i > 1:
                i += 1
                while i < size:
                    i = 2 * i if tree[2 * i] else 2 * i + 1
        if i > 1:
            capacity = i - size
            b = open_bins[capacity].pop()
            change(capacity, -1)
        else:
            b, capacity, n = n, window, n + 1
        bins[k], offsets[k] = b, window - capacity
        left = capacity - need
        if left:
            open_bins[left].append(b)
            change(left, 1)
    return bins, offsets, n


def pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int, with_ids: bool, id_col: str, text_col: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            *[T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")],
            *([T.StructField("ids", T.ArrayType(T.LongType()))] if with_ids else []),
        ]
    )

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizers.get(tokenizer)
        if tok is None:
            tok = _tokenizers[tokenizer] = WordTokenizer(tokenizer)
        for part in chunks(batches, chunk_bytes):
            docs = part.column(0).to_pylist()
            every, per_text = tok.encode(pc.fill_null(part.column(1).combine_chunks(), ""), end_id)
            raw = memoryview(every.tobytes())
            first, of, starts, lengths, crcs, ids = 0, [], [], [], [], []
            for k, n in enumerate(per_text.tolist()):
                for start in range(0, n, window):
                    end = min(start + window, n)
                    of.append(k)
                    starts.append(start)
                    lengths.append(end - start)
                    crcs.append(zlib.crc32(raw[4 * (first + start) : 4 * (first + end)]))
                    if with_ids:
                        ids.append(every[first + start : first + end].astype(np.int64))
                first += n
            out = [[docs[k] for k in of], starts, lengths, crcs, per_text[of], *([ids] if with_ids else [])]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, arrow_types, strict=True)], schema.names)

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_types = [to_arrow_type(f.dataType) for f in schema]
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), cut, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    end_id: int = 1,
    with_ids: bool = False,
    group_rows: int = GROUP_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """One row per piece: its place in its document and in its sequence.

    A document is its ids and ``end_id``, so a null or empty text is one piece
    of one id.  Null or repeated identifiers are documents like any other; an
    empty table gives no pieces.  Only the two named columns are read.
    Sequence numbers are unique, not gapless.  ``chunk_bytes`` of text are tokenised
    at once: it changes the memory of a task, not the rows.
    """
    rows = checkpoint(pieces(docs, tokenizer, window, end_id, with_ids, id_col, text_col, chunk_bytes).withColumn("row", F.monotonically_increasing_id()))
    full = rows.where(F.col("length") == window)
    rest = rows.where(F.col("length") < window)
    n_groups = max(1, -(-rest.count() // group_rows))
    # Rounds of the hash, not of the row number, so that every group has all lengths.
    rest = rest.select("row", "length", F.pmod(F.xxhash64("row"), F.lit(n_groups)).cast("int").alias("grp"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        bins, offsets, _ = best_fit_decreasing(pdf["length"].to_numpy(), window)
        return pd.DataFrame({"row": pdf["row"].to_numpy(), "sequence_id": pdf["grp"].to_numpy().astype(np.int64) * 2**32 + bins, "offset": offsets})

    fitted = rest.groupBy("grp").applyInPandas(fit, "row long, sequence_id long, offset long")
    keep = [c for c in ("id", "start", "length", "ids_crc32", "doc_tokens", "ids") if c in rows.columns]
    packed = rows.where(F.col("length") < window).join(fitted, "row").select(*keep, "sequence_id", "offset")
    # Full windows: negative numbers, one for each row.
    alone = full.select(*keep, (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone).withColumnRenamed("id", id_col)
