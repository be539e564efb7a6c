"""Choosing a proportioned batch of the best candidates for annotation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.labels import flat_labels
from textloom.operators.export import running_total

# What a candidate must be like, the weights of its score, and the order of the buckets.
LANGUAGES = ("tatar", "mixed")
BUCKETS = ("medium", "low", "high")
MAX_NOISE, MIN_CLARITY, MIN_USEFULNESS = 0.35, 0.35, 0.4


def source_rows(rows: DataFrame, payload: str, label: str, skipped: str | None = None) -> DataFrame:
    """Rows with a payload whose label is 0 or null and that aren't marked skipped (where there is such a column)."""
    out = rows.where(F.col(payload).isNotNull() & (F.coalesce(label, F.lit(0)) == 0))
    return out.where(F.coalesce(skipped, F.lit(0)) == 0) if skipped and skipped in rows.columns else out


def candidates(rows: DataFrame, id: str, text: str, payload: str, log: DataFrame | None = None, target: str = "prepare_import") -> DataFrame:
    """id, text, density and score of the rows that pass the quality rules.

    Only flat payloads count. ``log`` (id, target) has what was exported before; it is
    left out first. A NaN passes the rules on noise, clarity and usefulness, as in a
    language where every comparison with NaN is false.
    """
    if log is not None:
        rows = rows.join(log.where(F.col("target") == target).select(F.col("id").alias(id)).distinct(), id, "left_anti")
    got = rows.select(F.col(id).alias("id"), F.col(text).alias("text"), flat_labels(payload).alias("l")).where("l IS NOT NULL").select("id", "text", "l.*")

    def beyond(column: str, wrong):
        return ~F.isnan(column) & wrong

    good = got.where(
        F.col("main_language").isin(*LANGUAGES)
        & F.col("error_density").isin(*BUCKETS)
        & ~beyond("noise_score", F.col("noise_score") > MAX_NOISE)
        & ~beyond("meaning_clarity", F.col("meaning_clarity") < MIN_CLARITY)
        & ~beyond("overall_gec_usefulness", F.col("overall_gec_usefulness") < MIN_USEFULNESS)
    )
    score = (
        0.50 * F.col("overall_gec_usefulness") + 0.20 * F.col("meaning_clarity") + 0.15 * F.col("tatar_prob")
        + 0.10 * F.col("error_share") + 0.05 * F.col("non_fluent_prob") - 0.20 * F.col("noise_score")
    )
    return good.select("id", "text", F.col("error_density").alias("density"), score.alias("score"))


@dataclass(frozen=True)
class Quotas:
    medium: int
    low: int
    high: int
    total: int


def quotas(sizes: dict[str, int], limit: int | None, share: float, keep_proportions: bool) -> Quotas:
    """How many to take from each bucket, given their sizes.

    ``share`` (held between 0 and 0.5) goes to low and to high each, rounded half to
    even; the rest is medium's. Without ``keep_proportions`` what medium can't fill goes
    to low (the larger half) and high, and without a limit everything is taken.
    """
    n = {b: sizes.get(b, 0) for b in BUCKETS}
    every = sum(n.values())
    if limit is None and not keep_proportions:
        return Quotas(n["medium"], n["low"], n["high"], every)
    total = max(0, every if limit is None else limit)
    wanted = int(round(total * max(0.0, min(0.5, share))))
    low, high = min(n["low"], wanted), min(n["high"], wanted)
    rest = max(0, total - low - high)
    medium = min(n["medium"], rest)
    rest -= medium
    if rest and not keep_proportions:
        more_low = min(n["low"] - low, (rest + 1) // 2)
        low, high = low + more_low, high + min(n["high"] - high, rest - more_low)
    return Quotas(medium, low, high, total)


def select(found: DataFrame, materialise: Callable[[DataFrame, str], DataFrame], limit: int | None = None, share: float = 0.15, keep_proportions: bool = True) -> DataFrame:
    """The chosen candidates with bucket_rank and place (from 1, medium before low before high).

    Within a bucket the higher score comes first, then the lesser id; candidates that
    agree in both are ordered by text. Only the bucket sizes reach the driver. With a limit
    each bucket is cut to its quota by a distributed sort and limit before the window;
    without one all candidates are placed by a range partitioning.
    """
    found = materialise(found, "candidates")
    sizes = {r.density: r.n for r in found.groupBy("density").agg(F.count("*").alias("n")).collect()}
    q = quotas(sizes, limit, share, keep_proportions)
    order = [F.col("score").desc(), F.col("id"), F.col("text")]
    start = {"medium": 0, "low": q.medium, "high": q.medium + q.low}
    begin = F.when(F.col("density") == "medium", 0).when(F.col("density") == "low", start["low"]).otherwise(start["high"])
    if limit is None:
        # Everything may be chosen: places come from sums over ranges, so no task sorts a whole bucket.
        number = F.when(F.col("density") == "medium", 0).when(F.col("density") == "low", 1).otherwise(2)
        falling = F.when(F.isnan("score"), F.lit(float("-inf"))).otherwise(-F.col("score"))
        rows = found.withColumn("order_", F.struct(number, falling, "id", "text")).withColumn("one_", F.lit(1).cast("bigint"))
        placed = running_total(rows, "order_", "one_", materialise, tuple(found.columns))
        ahead = F.when(F.col("density") == "medium", 0).when(F.col("density") == "low", sizes.get("medium", 0)).otherwise(sizes.get("medium", 0) + sizes.get("low", 0))
        ranked = placed.select(*found.columns, (F.col("before") - ahead + 1).alias("bucket_rank"))
        most = F.when(F.col("density") == "medium", q.medium).when(F.col("density") == "low", q.low).otherwise(q.high)
        ranked = ranked.where(F.col("bucket_rank") <= most)
    else:
        parts = [found.where(F.col("density") == bucket).orderBy(*order).limit(n) for bucket, n in zip(BUCKETS, (q.medium, q.low, q.high))]
        ranked = reduce(DataFrame.unionByName, parts).withColumn("bucket_rank", F.row_number().over(Window.partitionBy("density").orderBy(*order)))
    return ranked.withColumn("place", begin + F.col("bucket_rank")).where(F.col("place") <= q.total)


def shuffled(rows: DataFrame, id: str, seed: int = 0) -> DataFrame:
    """Rows in an order that looks random but is the same every time: by a hash of id and seed."""
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(id)), id)
