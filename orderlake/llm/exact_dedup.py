"""Exact deduplication by content sort (DataFrame operations only).

Sampled splitters range-partition the normalised texts, an external sort
places equal texts next to each other, and a window over the sorted rows
compares each text with its neighbour in full.

A text lies in one run of the sort, so its neighbours settle it.  Only texts
that a sample of the rows shows to have many copies are cut: a hash of the row
deals their copies over runs of about ``RUN`` rows, so the range splitters can
fall inside a hot group and no task gets it whole.  The runs of such a text
then meet through its SHA-256 as rows of a few dozen bytes, pre-aggregated
before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import SPACES, checkpoint, per_key

#: One row in so many is sampled for hot texts; a text with SHOWN sampled copies is hot; its runs hold about RUN copies.
SAMPLE, SHOWN, RUN = 16, 16, 128
#: Hot texts at most (24 bytes each, broadcast): the most frequent of the sample, so any other has less than 1/1,024 of the rows.
HOT = 1024
#: Characters of a text that the splitters see; texts with the same prefix are told apart by a hash, then in full.
PREFIX = 32


def normalised(text: Column) -> Column:
    """The text without white space ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _row_hash(seed: int) -> Column:
    """A hash of the row's place in its input split: the same again if the task is run again."""
    return F.xxhash64(F.monotonically_increasing_id(), F.lit(seed))


def hot_texts(docs: DataFrame, text_col: str, sample: int = SAMPLE, shown: int = SHOWN, run: int = RUN) -> DataFrame:
    """(spread, salts): hashes of the texts that a sample shows to have many copies, and the runs to deal them over."""
    rows = docs.select(F.col(text_col).alias("text"), _row_hash(1).alias("r")).where(F.pmod("r", F.lit(sample)) == 0)
    counts = rows.groupBy(F.xxhash64(normalised(F.col("text"))).alias("spread")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= shown)
    most = counts.orderBy(F.desc("n"), "spread").limit(HOT)
    return most.select("spread", F.ceil(F.col("n") * sample / F.lit(run)).cast("long").alias("salts"))


def content_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sampling: int) -> DataFrame:
    """The sorted rows, each with the first row, the size and its place in its run of equal texts.

    ``salted`` rows belong to a hot text, which has several runs; a run of any
    other text holds all its copies.
    """
    hot = F.broadcast(hot_texts(docs, text_col, **sampling))
    rows = docs.select(
        F.col(id_col).alias("id"),
        normalised(F.col(text_col)).alias("norm"),
        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("chars"),
        _row_hash(2).alias("r"),
    )
    # Splitters are drawn from a prefix and a hash, so the sample that reaches the driver stays small.
    rows = rows.select("*", F.substring("norm", 1, PREFIX).alias("prefix"), F.xxhash64("norm").alias("spread")).join(hot, "spread", "left")
    salt = F.when(F.col("salts").isNotNull(), F.pmod("r", F.col("salts"))).otherwise(F.lit(-1))
    rows = rows.select("id", "norm", "chars", "prefix", "spread", salt.cast("long").alias("salt"))
    run = Window.partitionBy("prefix", "spread", "salt", "norm").orderBy(F.desc("chars"), F.asc_nulls_last("id"))
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.repartitionByRange("prefix", "spread", "salt").select(
        "*",
        F.first("id").over(run).alias("run_id"),
        F.first("chars").over(run).alias("run_chars"),
        F.row_number().over(run).alias("run_row"),
        F.count(F.lit(1)).over(whole).alias("run_size"),
    ).select("id", "chars", F.sha2(F.encode("norm", "UTF-8"), 256).alias("sha"), (F.col("salt") >= 0).alias("salted"), "run_id", "run_chars", "run_row", "run_size")


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sampling: int) -> DataFrame:
    """One row per input row: the row that stays for its text, and the size of its group.

    Of equal normalised texts the row with the most code points in its
    original text stays, then the one with the smallest identifier.

    Null texts count as empty; an empty table gives no rows.  A null
    identifier ranks after all others.  Rows that repeat an identifier with an
    equal text of equal length are all ``kept`` if that identifier stays,
    since nothing tells them apart.  Only the two named columns are read.
    ``sampling`` overrides ``sample``, ``shown`` and ``run`` of
    :func:`hot_texts`; the result doesn't depend on them.
    """
    runs = content_runs(docs, id_col, text_col, **sampling)
    runs = checkpoint(runs)
    settled = runs.where(~F.col("salted")).select("id", "chars", "sha", F.col("run_id").alias("i"), F.col("run_chars").alias("c"), F.col("run_size").alias("size"))
    cut = runs.where("salted")
    heads = cut.where("run_row = 1").select("sha", "run_id", "run_chars", "run_size")
    best = F.min(F.struct((-F.col("run_chars")).alias("c"), F.col("run_id").isNull().alias("n"), F.col("run_id").alias("i")))
    texts = per_key(heads, ["sha"], best.alias("best"), F.sum("run_size").alias("size"))
    met = cut.select("id", "chars", "sha").join(texts, "sha").select("id", "chars", "sha", F.col("best.i").alias("i"), (-F.col("best.c")).alias("c"), "size")
    return settled.unionByName(met).select(
        F.col("id").alias(id_col),
        F.col("i").alias("keep_id"),
        F.col("size").cast("long").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("i")) & (F.col("chars") == F.col("c"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each normalised text, the one that stays, all columns kept.

    Rows that repeat both identifier and text collapse to one of them.  The
    decision is carried by identifier and text digest, so the join adds narrow
    rows to the texts.
    """
    keep = content_sort(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("_keep"), F.col("text_sha256").alias("_sha")).distinct()
    sha = F.sha2(F.encode(normalised(F.col(text_col)), "UTF-8"), 256)
    # A null identifier is told apart from the rest by its own flag, so that the join is an ordinary one.
    rows = docs.withColumns({"_sha_": sha, "_id_": F.coalesce(F.col(id_col).cast("string"), F.lit("")), "_null_": F.col(id_col).isNull()})
    keep = keep.select("_sha", F.coalesce(F.col("_keep").cast("string"), F.lit("")).alias("_keep"), F.col("_keep").isNull().alias("_none"))
    rows = rows.join(keep, (F.col("_sha_") == F.col("_sha")) & (F.col("_id_") == F.col("_keep")) & (F.col("_null_") == F.col("_none")), "left_semi")
    return rows.dropDuplicates(["_sha_", "_id_", "_null_"]).select(*docs.columns)
