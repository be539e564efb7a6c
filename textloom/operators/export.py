"""The rows of the labelled export and their split into files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.labels import FIELDS, any_labels
from textloom.operators.firstwins import keep_last
from textloom.operators.membership import known

COLUMNS = ("id", "text", "toxicity_label", "toxicity_score", *FIELDS)


def exportable(scored: DataFrame, toxicity: DataFrame, payload: str, skipped: str) -> DataFrame:
    """Rows of ``scored`` joined by id with ``toxicity``: a payload is there, the label (the second table's first) isn't 1, nothing is skipped.

    An id that stands in a table more than once counts by its last row (insert or replace),
    so every id, and every seq, comes out once. A NaN score is none. Null ids join nothing.
    """
    mine = keep_last(scored.where("id IS NOT NULL").select("seq", "id", "text", "toxicity_label", "toxicity_score", payload), "id", "seq")
    last = keep_last(toxicity.where("id IS NOT NULL").select("seq", "id", "toxicity_label", "toxicity_score", skipped), "id", "seq")
    t = last.select("id", F.col("toxicity_label").alias("label_t"), known("toxicity_score", "double").alias("score_t"), F.coalesce(skipped, F.lit(0)).alias("skipped_t"))
    rows = mine.where(F.col(payload).isNotNull() & (F.col(payload) != "")).join(t, "id")
    label, score = F.coalesce("label_t", "toxicity_label"), F.coalesce("score_t", known("toxicity_score", "double"))
    rows = rows.where((F.coalesce(label, F.lit(0)) != 1) & (F.col("skipped_t") == 0))
    return rows.select("seq", "id", "text", label.cast("bigint").alias("toxicity_label"), score.alias("toxicity_score"), F.col(payload).alias("payload"))


def flattened(rows: DataFrame) -> DataFrame:
    """``seq`` and the export columns of rows with a readable payload, flat or wrapped."""
    return rows.withColumn("l", any_labels("payload")).where("l IS NOT NULL").select("seq", "id", "text", "toxicity_label", "toxicity_score", "l.*")


def row_bytes(rows: DataFrame) -> Column:
    """The size of a row as a column store in memory has it: text bytes and an offset for strings, eight for numbers."""
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) + 4 if kind == "string" else F.lit(8) for c, kind in rows.dtypes if c != "seq"]
    total = sizes[0]
    for s in sizes[1:]:
        total = total + s
    return total


def running_total(rows: DataFrame, order: str, value: str, materialise: Callable[[DataFrame, str], DataFrame], keep: tuple[str, ...] = ()) -> DataFrame:
    """``order``, ``value``, ``keep`` and before: the sum of the values of all rows that come earlier.

    Sums are made within ranges of ``order`` (unique) and the ranges' totals, one row a
    partition, are added on top, so no task holds all rows.
    """
    ranged = materialise(rows.select(order, value, *keep).repartitionByRange(order).withColumn("range_", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("range_").agg(F.sum(value).alias("total_"))
    ahead = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    start = totals.select("range_", F.coalesce(F.sum("total_").over(ahead), F.lit(0)).alias("start_"))
    inner = Window.partitionBy("range_").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.withColumn("in_", F.coalesce(F.sum(value).over(inner), F.lit(0))).join(F.broadcast(start), "range_").select(order, value, *keep, (F.col("start_") + F.col("in_")).alias("before"))


def part_numbers(rows: DataFrame, order: str, batch_rows: int, max_bytes: int, materialise: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``order`` (unique) and part (from 0, without gaps) of every row.

    Rows go out in batches of ``batch_rows`` in order. A new file begins with a batch before
    which the bytes of all rows have passed a further multiple of ``max_bytes``; so a batch
    is never torn, and a file holds at most ``max_bytes`` and one batch. Rows and bytes are
    placed in one pass over ranges of ``order``; what is summed after it has one row a batch.
    """
    ranged = materialise(rows.select(order, row_bytes(rows).alias("bytes")).repartitionByRange(order).withColumn("range_", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("range_").agg(F.count("*").alias("n_"))
    ahead = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    start = totals.select("range_", F.coalesce(F.sum("n_").over(ahead), F.lit(0)).alias("start_"))
    inner = F.row_number().over(Window.partitionBy("range_").orderBy(order)) - 1
    placed = ranged.withColumn("in_", inner).join(F.broadcast(start), "range_").select(order, "bytes", F.floor((F.col("start_") + F.col("in_")) / batch_rows).alias("batch"))
    placed = materialise(placed, "placed")
    batches = running_total(placed.groupBy("batch").agg(F.sum("bytes").alias("bytes")), "batch", "bytes", materialise)
    # A batch that starts past a further multiple opens a file; numbers of files without gaps are the ranks of the multiples at which one opens.
    crossed = materialise(batches.select("batch", F.floor(F.col("before") / max_bytes).alias("crossed")), "crossed")
    files = running_total(crossed.select("crossed").distinct().withColumn("one", F.lit(1).cast("bigint")), "crossed", "one", materialise)
    numbered = crossed.join(files.select("crossed", F.col("before").cast("int").alias("part")), "crossed").select("batch", "part")
    return placed.join(numbered, "batch").select(order, "part")
