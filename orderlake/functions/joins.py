"""Joins of rows with a per-key aggregate of themselves, safe under hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_key_for_join(df: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """``groupBy(keys).agg(aggs)`` shaped to be joined back to ``df`` on ``keys``.

    A plain aggregate leaves its shuffle already partitioned by the keys, so
    the sort-merge join back has no exchange on that side, and adaptive
    execution only splits skewed joins whose two inputs are ordinary
    shuffles.  Grouping additionally by a hash of the keys gives the same
    groups but a different partitioning; the join then shuffles the
    (one-row-per-key) aggregate itself, and a key holding a large share of
    the rows is split across tasks by the skew join (``skew=true`` in the
    final plan) while its aggregate row is replicated to them.  The hash comes
    first: where the aggregate sorts, keys that begin alike would be compared
    in full.
    """
    return df.groupBy(F.hash(*keys).alias("_g"), *keys).agg(*aggs).drop("_g")


def join_back(rows: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """Left-join ``rows`` with ``per_key`` built by :func:`per_key_for_join`."""
    return rows.join(per_key, keys, "left")
