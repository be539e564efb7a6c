"""Exact and SimHash near-duplicates of segments, first come first kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions.simhash import bands, hamming, simhash
from textloom.operators.firstwins import FOLD_ROUNDS
from textloom.plans.shared import joinable
from textloom.profile import DEFAULT, Profile


def with_simhash(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with n_tokens and simhash; a null text has neither."""
    return rows.withColumn("tokens_", T.tokens(text)).withColumn("n_tokens", F.size("tokens_")).withColumn("simhash", simhash("tokens_")).drop("tokens_")


def near_pairs(values: DataFrame, distance: int) -> DataFrame:
    """a < b and distance: all pairs of distinct values of column ``simhash`` within the distance. Exact, by bands.

    The bands are merged: Spark takes them for as small as the values they are made from, and would broadcast them.
    """
    keyed = values.select("simhash").where("simhash IS NOT NULL").distinct().select("simhash", F.explode(bands("simhash", distance)).alias("key"))
    a, b = keyed.select("key", F.col("simhash").alias("a")), keyed.select("key", F.col("simhash").alias("b"))
    return a.join(b.hint("merge"), "key").where(F.col("a") < F.col("b")).where(hamming("a", "b") <= distance).select("a", "b", hamming("a", "b").alias("distance")).distinct()


def deduplicate(rows: DataFrame, order: str, text: str, norm_hash: str, materialise: Callable[[DataFrame, str], DataFrame], profile: Profile = DEFAULT, stored: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """``order`` and status of every row: kept, exact_dup, near_dup or already_present.

    A row is dropped if a kept earlier row has its norm_hash, or a SimHash within
    the distance that the *later* row's number of tokens allows. ``stored`` (same
    columns, and a ``simhash`` where it was stored with the rows) holds rows kept before, and
    ``key`` names the id by which rows count as already present. A null norm_hash equals nothing; a null text is kept unless its
    norm_hash is known. ``order`` must be unique; a row without a place is left out.

    Rows with one SimHash, one limit and one norm_hash stand or fall by the first of
    them, so only first ones are compared. They are decided in rounds: one that is the
    first undecided of its norm_hash and of its SimHash, and that no undecided one of a
    near SimHash precedes, is kept; then those that a kept one precedes are dropped.
    Nearness is joined between distinct SimHash values, never between rows. Tables are
    counted before they are joined, so that only small ones are broadcast.
    """
    near, short = profile.near_distance, profile.short_distance
    rows = rows.where(F.col(order).isNotNull())
    present = None
    if stored is not None and key is not None:
        known = stored.select(key).where(F.col(key).isNotNull()).distinct()
        present = rows.join(known, key, "left_semi").select(F.col(order).alias("place"), F.lit("already_present").alias("status"))
        rows = rows.join(known, key, "left_anti")
    limit = F.when(F.col("n_tokens") <= profile.short_tokens, short).otherwise(near)
    made = with_simhash(rows.select(F.col(order).alias("place"), F.col(text).alias("text"), F.col(norm_hash).alias("norm")), "text")
    own = materialise(made.select("place", "norm", "simhash", F.when(F.col("simhash").isNotNull(), limit).alias("limit")), "simhash")
    shape = ["norm", "simhash", "limit"]
    # A row without norm_hash and text is like nothing: it is kept, and not compared.
    first = materialise(own.where("norm IS NOT NULL OR simhash IS NOT NULL").groupBy(*shape).agg(F.min("place").alias("place")), "first")
    kept = first.select("norm", "simhash", "place", F.lit(False).alias("stored")).limit(0)
    if stored is not None:
        had = F.col("simhash") if "simhash" in stored.columns else F.lit(None).cast("bigint")
        old = stored.select(F.col(text).alias("text"), F.col(norm_hash).alias("norm"), had.alias("had"))
        # Only stored rows without their SimHash are hashed again.
        old = old.withColumn("tokens_", F.when(F.col("had").isNull(), T.tokens("text"))).withColumn("simhash", F.coalesce("had", simhash("tokens_")))
        # Rows kept before have no place: they precede everything.
        kept = materialise(old.select("norm", "simhash", F.lit(None).cast(first.schema["place"].dataType).alias("place"), F.lit(True).alias("stored")).distinct(), "stored")
    pairs = materialise(near_pairs(first.select("simhash").unionByName(kept.select("simhash")), max(near, short)), "near")
    n_pairs = 2 * pairs.count()
    pairs = pairs.union(pairs.select("b", "a", "distance"))

    def sizes(table: DataFrame) -> tuple[int, int]:
        """How many rows, and how many with a norm_hash."""
        return tuple(table.agg(F.count("*"), F.count("norm")).first())

    def neighbours(places: DataFrame, most: int) -> DataFrame:
        """For each SimHash the first place among near values, for short and other rows, and whether a stored row is near."""
        near_to, places = joinable(pairs, n_pairs), joinable(places.where("simhash IS NOT NULL"), most)
        met = near_to.join(places, F.col("a") == F.col("simhash"))
        kinds = {"short": short, "near": near}
        columns = [F.min(F.when(F.col("distance") <= d, F.col("first"))).alias(f"first_{k}") for k, d in kinds.items()]
        columns += [F.max(F.col("stored") & (F.col("distance") <= d)).alias(f"stored_{k}") for k, d in kinds.items()]
        return joinable(met.groupBy("b").agg(*columns), n_pairs)

    def by_limit(name: str):
        return F.when(F.col("limit") == short, F.col(f"{name}_short")).otherwise(F.col(f"{name}_near")) if short != near else F.col(f"{name}_near")

    def after_kept(waiting: DataFrame, decided: DataFrame, most: int, most_norms: int) -> DataFrame:
        """The waiting rows that no decided row precedes; of those there are at most so many, and so many with a norm_hash."""
        values = decided.groupBy("simhash").agg(F.min("place").alias("first"), F.max("stored").alias("stored"))
        norms = decided.where("norm IS NOT NULL").select("norm").distinct()
        own_value = values.select("simhash", F.col("first").alias("first_own"), F.col("stored").alias("stored_own"))
        joined = waiting.join(joinable(norms, most_norms), "norm", "left_anti").join(joinable(own_value, most), "simhash", "left")
        joined = joined.join(neighbours(values, most), F.col("simhash") == F.col("b"), "left")
        hit = F.coalesce(F.col("stored_own"), F.lit(False)) | F.coalesce(by_limit("stored"), F.lit(False))
        hit = hit | F.coalesce(F.col("first_own") < F.col("place"), F.lit(False)) | F.coalesce(by_limit("first") < F.col("place"), F.lit(False))
        return joined.where(~hit).select(*shape, "place")

    waiting = first if stored is None else materialise(after_kept(first, kept, *sizes(kept)), "waiting")
    rounds = 0
    while (most := sizes(waiting))[0]:
        values = waiting.groupBy("simhash").agg(F.min("place").alias("first")).withColumn("stored", F.lit(False))
        norms = waiting.where("norm IS NOT NULL").groupBy("norm").agg(F.min("place").alias("first_norm"))
        joined = waiting.join(joinable(values.select("simhash", F.col("first").alias("first_own")), most[0]), "simhash", "left").join(joinable(norms, most[1]), "norm", "left")
        joined = joined.join(neighbours(values, most[0]), F.col("simhash") == F.col("b"), "left")
        ahead = (F.col("simhash").isNull() | (F.col("first_own") == F.col("place"))) & (F.col("norm").isNull() | (F.col("first_norm") == F.col("place")))
        ahead = ahead & F.coalesce(by_limit("first") > F.col("place"), F.lit(True))
        chosen = materialise(joined.where(ahead).select("norm", "simhash", "place", F.lit(False).alias("stored")), "kept")
        kept = kept.unionByName(chosen)
        rounds += 1
        if rounds % FOLD_ROUNDS == 0:
            kept = materialise(kept, "kept")
        left = waiting.join(joinable(chosen.select("place"), most[0]), "place", "left_anti")
        waiting = materialise(after_kept(left, chosen, *most), "waiting")
    kept = materialise(kept.select("norm", "place"), "kept")
    most = sizes(kept)
    # Exact is a row whose norm_hash an earlier kept row has, whatever else it is near.
    seen = kept.where("norm IS NOT NULL").groupBy("norm").agg(F.min("place").alias("norm_place"), F.max(F.col("place").isNull()).alias("norm_stored"))
    is_kept = kept.where("place IS NOT NULL").select("place", F.lit(True).alias("is_kept"))
    status = F.when(F.col("is_kept") | (F.col("norm").isNull() & F.col("simhash").isNull()), "kept").when(F.col("norm_stored") | (F.col("norm_place") < F.col("place")), "exact_dup").otherwise("near_dup")
    out = own.join(joinable(is_kept, most[0]), "place", "left").join(joinable(seen, most[1]), "norm", "left").select("place", status.alias("status"))
    return (out if present is None else out.unionByName(present)).withColumnRenamed("place", order)


def greedy_constant(rows: DataFrame, order: str, text: str, distance: int, materialise: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``order`` and status of every row when only nearness counts, with one distance for texts of any length."""
    like = DEFAULT.__class__(near_distance=distance, short_distance=distance)
    return deduplicate(rows.select(order, text).withColumn("none_", F.lit(None).cast("string")), order, text, "none_", materialise, like)
