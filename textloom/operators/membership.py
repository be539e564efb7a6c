"""Rows that are, or aren't yet, in another table; logs; and flags kept as logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.firstwins import keep_last


def pending(rows: DataFrame, done: DataFrame, key: str, label: str | None = None, skipped: str | None = None) -> DataFrame:
    """Rows whose key isn't in ``done``, that aren't labelled 1 and aren't marked skipped.

    A null label leaves a row out (as a comparison with null does) where the column is
    there at all; a null skip mark is none. A null key is never in ``done``.
    """
    if label and label in rows.columns:
        rows = rows.where(F.col(label) != 1)
    if skipped and skipped in rows.columns:
        rows = rows.where(F.coalesce(skipped, F.lit(0)) == 0)
    return rows.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def pending_counts(rows: DataFrame, done: DataFrame, key: str, label: str | None = None, skipped: str | None = None) -> DataFrame:
    """One row: n_total and n_pending, from one pass over ``rows``."""
    marked = done.select(F.col(key)).where(F.col(key).isNotNull()).distinct().withColumn("done_", F.lit(True))
    waiting = F.lit(True)
    if label and label in rows.columns:
        waiting = waiting & (F.col(label) != 1)
    if skipped and skipped in rows.columns:
        waiting = waiting & (F.coalesce(skipped, F.lit(0)) == 0)
    slim = rows.select(key, waiting.alias("waiting_"))
    return slim.join(marked, key, "left").agg(F.count("*").alias("n_total"), F.count_if(F.col("waiting_") & F.col("done_").isNull()).alias("n_pending"))


def unseen(rows: DataFrame, log: DataFrame, key: str, order: str, scope: dict[str, str] | None = None, limit: int | None = None) -> DataFrame:
    """The first row, in order, of each key that the log doesn't have; rows with a null key are all new.

    ``scope`` (column to value) restricts the log, so that another output table starts
    afresh. A limit counts new rows only.
    """
    for column, value in (scope or {}).items():
        log = log.where(F.col(column) == value)
    fresh = rows.join(log.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    first = fresh.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("first_place_"))
    out = fresh.join(first, key, "left").where(F.col(key).isNull() | (F.col(order) == F.col("first_place_"))).select(*rows.columns)
    return out.orderBy(order).limit(limit) if limit is not None else out


def new_log_rows(rows: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct key rows that the log doesn't have yet: what an insert-or-ignore adds."""
    return rows.select(*keys).distinct().join(log.select(*keys).distinct(), keys, "left_anti")


def with_skip_flag(rows: DataFrame, skips: DataFrame, key: str, flag: str) -> DataFrame:
    """``rows`` with a flag of 1 where the log of skips has the key; an existing flag of 1 stays.

    The source table isn't changed; the flag is derived whenever it is read.
    """
    marked = skips.select(F.col(key)).where(F.col(key).isNotNull()).distinct().withColumn("marked_", F.lit(1))
    old = F.coalesce(F.col(flag), F.lit(0)) if flag in rows.columns else F.lit(0)
    joined = rows.join(marked, key, "left").withColumn("flag_", F.greatest(F.coalesce("marked_", F.lit(0)), old).cast("int"))
    return joined.select(*(F.col("flag_").alias(c) if c == flag else c for c in rows.columns), *([] if flag in rows.columns else [F.col("flag_").alias(flag)]))


def known(column: str, kind: str) -> Column:
    """A column of a type, a NaN as null: a store that can't hold NaN would have given null."""
    return F.nanvl(column, F.lit(None).cast(kind)) if kind in ("double", "float") else F.col(column)


def scored_join(scored: DataFrame, toxicity: DataFrame, key: str, columns: tuple[str, ...], order: str | None = None) -> DataFrame:
    """Inner join on the key; of each column the second table's value counts, the first's where that is null or NaN.

    A NaN on both sides gives null. With ``order`` only the last row of each key of the second table counts.
    """
    latest = keep_last(toxicity.select(key, order, *columns), key, order) if order else toxicity
    right = latest.select(F.col(key), *(known(c, toxicity.schema[c].dataType.simpleString()).alias(f"{c}_right") for c in columns))
    own = {c: known(c, scored.schema[c].dataType.simpleString()) for c in columns}
    joined = scored.join(right, key)
    return joined.select(*(F.coalesce(f"{c}_right", own[c]).alias(c) if c in columns else c for c in scored.columns))
