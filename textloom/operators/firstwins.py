"""First come, first kept: which rows survive when kept rows suppress later ones.

A row is kept exactly if no kept earlier row has an edge to it (the first maximal
independent set in the order of the rows). That isn't the same as dropping every row
with an earlier neighbour, nor as keeping one row of each connected component.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rounds after which what they have accepted is written as one table.
FOLD_ROUNDS = 8


def keep_first(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key in order; rows with a null key are all kept. ``order`` must be unique within a key.

    The least place of each key is found with partial aggregation, so that a key
    of very many rows is never sorted in one task.
    """
    first = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("first_place_"))
    joined = rows.join(first, key, "left")
    return joined.where(F.col(key).isNull() | (F.col(order) == F.col("first_place_"))).select(*rows.columns)


def two_key_first(rows: DataFrame, order: str, one: str, two: str, materialise: Callable[[DataFrame, str], DataFrame], stored: DataFrame | None = None) -> DataFrame:
    """The rows that inserting in order would accept where neither key may repeat an accepted one.

    ``order`` must be unique; a row without a place is left out. A null key conflicts with
    nothing. ``stored`` has rows (with the same key columns) accepted before.

    Works in rounds: a row that is the first undecided one of both its keys is accepted,
    and then every row that shares a key with an accepted one goes. Only the first place
    of each key is compared, so a key that very many rows share costs no pairs.
    """
    waiting = rows.select(F.col(order).alias("place"), F.col(one).alias("one"), F.col(two).alias("two")).where("place IS NOT NULL")
    for k, name in (("one", one), ("two", two)):
        if stored is not None:
            waiting = waiting.join(stored.select(F.col(name).alias(k)).where(F.col(k).isNotNull()).distinct(), k, "left_anti")
    waiting = materialise(waiting.select("place", "one", "two"), "waiting")
    accepted, rounds = None, 0
    while not waiting.isEmpty():
        marked = waiting
        for k in ("one", "two"):
            first = waiting.where(F.col(k).isNotNull()).groupBy(k).agg(F.min("place").alias(f"first_{k}"))
            marked = marked.join(first, k, "left")
        ahead = (F.col("one").isNull() | (F.col("place") == F.col("first_one"))) & (F.col("two").isNull() | (F.col("place") == F.col("first_two")))
        chosen = materialise(marked.where(ahead).select("place", "one", "two"), "accepted")
        accepted = chosen if accepted is None else accepted.unionByName(chosen)
        rounds += 1
        if rounds % FOLD_ROUNDS == 0:  # so that a long chain doesn't make a long plan
            accepted = materialise(accepted, "accepted")
        left = waiting.join(chosen.select("place"), "place", "left_anti")
        for k in ("one", "two"):
            left = left.join(chosen.select(k).where(F.col(k).isNotNull()).distinct(), k, "left_anti")
        waiting = materialise(left.select("place", "one", "two"), "waiting")
    if accepted is None:
        return rows.limit(0)
    return rows.join(accepted.select(F.col("place").alias("kept_place_")), F.col(order) == F.col("kept_place_"), "left_semi")


def keep_last(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key in order (insert or replace); rows with a null key are all kept."""
    last = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(order).alias("last_place_"))
    joined = rows.join(last, key, "left")
    return joined.where(F.col(key).isNull() | (F.col(order) == F.col("last_place_"))).select(*rows.columns)


def replace_last(rows: DataFrame, order: str, one: str, two: str) -> DataFrame:
    """The rows left when inserting in order where a row replaces every row that shares either key with it.

    A row stays exactly if no later row has its first or its second key, whether that one stays or not;
    so the last place of each key decides, without rounds. A null key conflicts with nothing.
    ``order`` must be unique; a row without a place is left out.
    """
    placed = left = rows.where(F.col(order).isNotNull())
    for key in (one, two):
        last = placed.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key_")).agg(F.max(order).alias(f"last_{key}_"))
        left = left.join(last, left[key] == last["key_"], "left").drop("key_")
    stays = [F.col(k).isNull() | (F.col(order) == F.col(f"last_{k}_")) for k in (one, two)]
    return left.where(stays[0] & stays[1]).select(*rows.columns)
