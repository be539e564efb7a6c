"""Groups of records that differ by small edits: an exact join on the likeness of their word sets.

Two texts are alike when the words both have are at least ``SIMILARITY`` of the
words either has. Texts with the same word set are one class; the join works on
one representative of each class.

Words are hashed into groups; the counts of a text's words by group are a point,
and the sum of the smaller coordinates of two points bounds how many words their
texts share. The points are kept in R-trees that are joined with themselves from
the top: a pair of nodes is followed only if its bounding boxes leave enough
overlap possible. Pairs that survive are verified on the word sets.

One tree over all texts could not be spread over a cluster, nor would boxes in so
many dimensions part it well. So the trees are forests: every text puts its point
under keys, and each key has its own tree. Words are in one order for all texts,
rare ones first. If texts x and y are alike, they share a word among the first
``n - ceil(SIMILARITY * n) + 1`` of each, and the first k of the shared words are among
the first ``n - ceil(SIMILARITY * n) + k``. The key is the first shared word, or the
first two, three or four where fewer words would gather too many texts;
how many is decided from the words alone, so both texts decide alike. A key that is hot all
the same, also one of a short text, is joined in blocks of points by several tasks. Before the
first shared word nothing is shared, so a point holds the counts of the words from
there on. No pair is missed, and there is no limit on keys or partners.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIMILARITY = 0.6
#: Coordinates of a point.
GROUPS = 16
#: Buckets of the sketch of word frequencies, which fixes the order of words and is broadcast; its size doesn't depend on the data.
SKETCH = 1 << 20
#: Expected texts under a key above which it is extended by a further word.
CROWDED = 2_500
MAX_DEPTH = 4
#: Words of different texts meet more often than chance; the expectation is raised by this factor for each further word.
TOGETHER = 8.0
FAN = 16
#: Pairs of nodes or points handled at once.
AT_ONCE = 1_000_000
#: Points of one key that one task joins; the points of a larger key are dealt out in blocks of this size.
BLOCK = 20_000
#: Points that a task holds before it joins the keys that are complete.
HELD = 100_000
#: Rows of a group of copies whose pairs one task makes.
PAIR_BLOCK = 2_000
#: Below this number of words a text is too short for keys of MAX_DEPTH words.
SHORT = math.ceil(MAX_DEPTH / SIMILARITY)

_WORD = re.compile(r"[^\W_]+")


class _Hashes(dict):
    """Signed 64-bit hashes of words."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word) - (1 << 63)
        return h


def word_set(text: str, hashes: _Hashes) -> list[int]:
    """The hashes of the distinct words of a text in the order of first occurrence; a word is a longest run of letters and digits, lower-cased."""
    return list(dict.fromkeys(map(hashes.__getitem__, _WORD.findall(text.lower()))))


def _word_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in batches:
        sets = [word_set(t, hashes) for t in batch.column(1).to_pylist()]
        classes = [xxhash.xxh64_intdigest(np.array(sorted(s), np.int64).tobytes(), 1) - (1 << 63) for s in sets]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(classes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["key", "class", "words"])


def _first_of_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per class and partition, so that copies cost nothing further."""
    seen: set[int] = set()
    for batch in batches:
        ids = batch.column(0).to_pylist()
        fresh = [i for i, c in enumerate(ids) if c not in seen and not seen.add(c)]
        yield batch.take(pa.array(fresh, pa.int64()))


def bucket(words: np.ndarray) -> np.ndarray:
    return (words.view(np.uint64) >> np.uint64(64 - 20)).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, sets = np.zeros(SKETCH, np.int64), 0
    for batch in batches:
        counts += np.bincount(bucket(batch.column(0).flatten().to_numpy()), minlength=SKETCH)
        sets += batch.num_rows
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(counts[used], sets))], names=["bucket", "n"])


def frequency_sketch(sets: DataFrame) -> tuple[np.ndarray, int]:
    """How many sets have a word of each bucket, and how many sets there are; at most SKETCH + 1 pairs reach the driver."""
    counted = sets.select("words").mapInArrow(_count_words, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(SKETCH + 1, np.int64)
    n[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    return n[:-1].astype(np.int32), int(n[-1])


def overlap_needed(a, b):
    """Words that sets of ``a`` and ``b`` words must share: likeness q needs q / (1 + q) of the sum. (Exact for 0.6: three eighths.)"""
    return np.ceil(SIMILARITY / (1 + SIMILARITY) * (a + b) - 1e-9)


def keys_of(words: np.ndarray, counts: np.ndarray, total: int) -> list[tuple[int, int]]:
    """(key, position of its first word) for a set in the common order; ``counts`` are the words' frequencies."""
    n = len(words)
    first = n - math.ceil(SIMILARITY * n - 1e-9) + 1
    out: list[tuple[int, int]] = []
    if n <= SHORT / SIMILARITY:
        # Pairs with a short text are found under single words, in a space of their own.
        out += [(int(words[i]) ^ 0x5DEECE66D, i) for i in range(min(first, n)) if counts[i] > 1]
        if n < SHORT:
            return out
    numbers, odds = words.tolist(), (counts * (TOGETHER / max(total, 1))).tolist()
    stack = [(i, i, 1, numbers[i], float(counts[i])) for i in range(min(first, n)) if counts[i] > 1]
    while stack:
        start, last, depth, key, expected = stack.pop()
        if expected <= CROWDED or depth == MAX_DEPTH:
            out.append((key, start))
            continue
        for j in range(last + 1, min(first + depth, n)):
            if counts[j] > 1:
                mixed = (key * 0x9E3779B97F4A7C15 + numbers[j] * 0xC2B2AE3D27D4EB4F) & 0xFFFFFFFFFFFFFFFF
                stack.append((start, j, depth + 1, (mixed ^ (mixed >> 29)) & 0x7FFFFFFFFFFFFFFF, expected * min(1.0, odds[j])))
    return out


def pack_counts(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts by group of the words between each start and end, four bits each; 15 stands for any larger count.

    Each group is in two halves; the first result has one half of every group, the second the other.
    """
    half = ((words.view(np.uint64) >> np.uint64(7)) & np.uint64(2 * GROUPS - 1)).astype(np.int64)
    before = np.zeros((len(words) + 1, 2 * GROUPS), np.int32)
    before[np.arange(1, len(words) + 1), half] = 1
    np.cumsum(before, axis=0, out=before)
    count = np.minimum(before[ends] - before[starts], 15).astype(np.uint64)
    places = np.arange(GROUPS, dtype=np.uint64) * np.uint64(4)
    return tuple((count[:, k::2] << places).sum(1, dtype=np.uint64).view(np.int64) for k in (0, 1))


def unpack_counts(packed: np.ndarray) -> np.ndarray:
    """Upper bounds of the counts, a row for each point."""
    count = (packed.view(np.uint64)[:, None] >> (np.arange(GROUPS, dtype=np.uint64) * np.uint64(4)) & np.uint64(15)).astype(np.uint8)
    count[count == 15] = 120
    return count


def halves_allow(one: np.ndarray, two: np.ndarray, a: np.ndarray, b: np.ndarray, needed: np.ndarray) -> np.ndarray:
    """The pairs whose half groups leave the needed overlap possible; 120 stands for any count from 15 on."""
    least = [np.minimum(c[a], c[b]) for c in (one, two)]
    return (least[0].sum(1, dtype=np.int32) + least[1].sum(1, dtype=np.int32) >= needed) | (least[0] == 120).any(1) | (least[1] == 120).any(1)


POINT = "key bigint, id bigint, size int, rest int, counts bigint, counts2 bigint"


class _Tree:
    """Levels of boxes over points sorted by key, size and rest; a box covers points of one key."""

    def __init__(self, key, size, rest, counts):
        self.levels = [(key, size, size, rest, counts, None)]
        self.capped = bool((counts >= 120).any())
        while True:
            key, low, high, rest, counts, _ = self.levels[-1]
            begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            if len(begin) == len(key):
                break
            place = np.arange(len(key)) - np.repeat(begin, np.diff(np.append(begin, len(key))))
            starts = np.flatnonzero(place % FAN == 0)
            self.levels.append((key[starts], np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.maximum.reduceat(rest, starts), np.maximum.reduceat(counts, starts, axis=0), np.append(starts, len(key))))

    def _possible(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of boxes (or points) that leave enough overlap possible."""
        _, low, high, rest, counts, _ = self.levels[level]
        needed = overlap_needed(low[a], low[b])
        keep = (np.minimum(rest[a], rest[b]) >= needed) & (high[a] >= SIMILARITY * low[b] - 1e-9) & (high[b] >= SIMILARITY * low[a] - 1e-9)
        a, b, needed = a[keep], b[keep], needed[keep]
        least = np.minimum(counts[a], counts[b])
        keep = least.sum(1, dtype=np.int32) >= needed
        if self.capped:
            keep |= (least >= 120).any(1)
        return a[keep], b[keep]

    def _below(self, level: int, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs of children of pairs of boxes, each pair once, some at a time."""
        starts = self.levels[level][5]
        na, nb = starts[a + 1] - starts[a], starts[b + 1] - starts[b]
        done = np.cumsum(na * nb)
        at = 0
        while at < len(a):
            to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + AT_ONCE, side="right")))
            size = (na * nb)[at:to]
            which = np.repeat(np.arange(at, to), size)
            inner = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
            x, y = starts[a[which]] + inner // nb[which], starts[b[which]] + inner % nb[which]
            once = (a[which] != b[which]) | (x < y if level == 1 else x <= y)
            yield x[once], y[once]
            at = to

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of points of one key that the boxes don't rule out."""
        top = len(self.levels) - 1
        if top == 0:
            return
        every = np.arange(len(self.levels[top][0]))
        stack = [(top, *self._possible(top, every, every))]
        while stack:
            level, a, b = stack.pop()
            for x, y in self._below(level, a, b):
                x, y = self._possible(level - 1, x, y)
                if len(x) and level == 1:
                    yield x, y
                elif len(x):
                    stack.append((level - 1, x, y))


def _joined(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs of ids among the points of a table that holds every point of its keys."""
    key, ids, size, rest, one, two = (table.column(k).to_numpy() for k in range(6))
    many = np.flatnonzero(np.append(False, key[1:] == key[:-1]) | np.append(key[1:] == key[:-1], False))
    key, ids, size, rest, one, two = (column[many] for column in (key, ids, size, rest, one, two))
    order = np.lexsort((ids, rest, size, key))
    # Copies of a class from different partitions are one point.
    order = order[np.append(True, (key[order][1:] != key[order][:-1]) | (ids[order][1:] != ids[order][:-1]))[: len(order)]]
    key, ids, size, rest, one, two = (column[order] for column in (key, ids, size, rest, one, two))
    one, two, size, rest = unpack_counts(one), unpack_counts(two), size.astype(np.float32), rest.astype(np.float32)
    for x, y in _Tree(key, size, rest, one + two).pairs():
        keep = halves_allow(one, two, x, y, overlap_needed(size[x], size[y]))
        x, y = x[keep], y[keep]
        a, b = np.minimum(ids[x], ids[y]), np.maximum(ids[x], ids[y])
        pair = np.unique(np.stack([a, b], 1)[a != b], axis=0)
        yield pair[:, 0].copy(), pair[:, 1].copy()


#: A candidate pair, or, where id_b is null, a point of a key that has too many of them for one task.
JOINED = "id_a bigint, id_b bigint, key bigint, size int, rest int, counts bigint, counts2 bigint"
_JOINED = [c.split()[0] for c in JOINED.split(", ")]


def _join_points(block: int | None):
    """A function from points in order of key, every point of a key in one partition, to candidate pairs.

    A key of more than ``block`` points isn't joined here; its points come out as they are, so no
    task ever holds them all. Without a block every key is joined.
    """

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for a, b in _joined(table):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *(pa.nulls(len(a), t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names=_JOINED)

    def passed(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for b in table.to_batches():
            yield pa.RecordBatch.from_arrays([b.column(1), pa.nulls(b.num_rows, pa.int64()), b.column(0), *(b.column(k) for k in range(2, 6))], names=_JOINED)

    def whole_keys(table: pa.Table) -> Iterator[pa.RecordBatch]:
        key = table.column(0).to_numpy()
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(begin, len(key)))
        hot = np.repeat(size > block, size) if block else np.zeros(len(key), bool)
        if hot.any():
            yield from passed(table.filter(pa.array(hot)))
            table = table.filter(pa.array(~hot))
        yield from pairs(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, hot = 0, None
        for batch in batches:
            if hot is not None:
                n = int(np.searchsorted(batch.column(0).to_numpy(), hot, side="right"))
                yield from passed(pa.Table.from_batches([batch.slice(0, n)]))
                batch = batch.slice(n)
                if not batch.num_rows:
                    continue
                hot = None
            held.append(batch)
            rows += batch.num_rows
            if rows > HELD:
                # All keys but the last one are complete; if that is hot already, what comes of it passes by.
                table = pa.Table.from_batches(held)
                key = table.column(0).to_numpy()
                cut = int(np.searchsorted(key, key[-1]))
                if cut:
                    yield from whole_keys(table.slice(0, cut))
                last = table.slice(cut)
                if block and last.num_rows > block:
                    hot = int(key[-1])
                    yield from passed(last)
                    held, rows = [], 0
                else:
                    held, rows = last.to_batches(), last.num_rows
        if held:
            yield from whole_keys(pa.Table.from_batches(held))

    return run


def _in_blocks(points: DataFrame) -> DataFrame:
    """Points of hot keys, each key dealt out into blocks and a key of its own for each pair of blocks.

    Any two points of a key meet in a pair of blocks, which has at most about two blocks of points.
    """
    points = points.dropDuplicates(["key", "id"])
    sizes = points.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = points.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    cells = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return cells.select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "id", "size", "rest", "counts", "counts2")


def pairs_within(rows: DataFrame, group: list[str], key: str) -> DataFrame:
    """key_a < key_b, with all columns of ``rows`` as a and b: all pairs of rows of a group.

    A large group is dealt out into blocks, and each pair of blocks is joined by itself,
    so its pairs don't come from one task. ``key`` must be unique within a group.
    """
    sizes = rows.groupBy(*group).agg(F.count("*").alias("n_")).where("n_ > 1").select(*group, F.ceil(F.col("n_") / PAIR_BLOCK).cast("int").alias("blocks_"))
    placed = rows.join(sizes, group).withColumn("block_", F.pmod(F.xxhash64(key), F.col("blocks_")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks_") - 1))
    a = placed.withColumn("x_", F.col("block_")).withColumn("y_", every).alias("a")
    b = placed.withColumn("y_", F.col("block_")).withColumn("x_", every).alias("b")
    same = F.lit(True)
    for c in [*group, "x_", "y_"]:
        same = same & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    return a.join(b, same & (F.col(f"a.{key}") < F.col(f"b.{key}")))


def word_sets(df: DataFrame, key: str, text: str, materialise) -> DataFrame:
    """key, class (a 64-bit hash of the word set) and words of every row that has words, as a table."""
    source = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).where("text IS NOT NULL")
    return materialise(source.mapInArrow(_word_sets, "key bigint, class bigint, words array<bigint>").where(F.size("words") > 0), "sets")


def unique_sets(sets: DataFrame) -> DataFrame:
    """class and words, once per partition that has the class."""
    return sets.select("class", "words").mapInArrow(_first_of_class, "class bigint, words array<bigint>")


def class_links(sets: DataFrame, materialise) -> DataFrame:
    """a < b: the pairs of different classes whose word sets are alike.

    A key is joined in one task if it has at most BLOCK points; the points of a larger one,
    found as they stream by, are joined in blocks. No key, however hot, is held by one task.
    """
    spark = sets.sparkSession
    once = unique_sets(sets)
    shared = spark.sparkContext.broadcast(frequency_sketch(once))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The points of each set, one for each of its keys."""
        sketch, total = shared.value
        for batch in batches:
            ids, sizes = batch.column(0).to_numpy(), np.diff(batch.column(1).offsets.to_numpy())
            words = batch.column(1).flatten().to_numpy()
            count = sketch[bucket(words)]
            row = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((words, count, row))
            words, count = words[order], count[order]
            ends = np.cumsum(sizes)
            keys, starts, rows = [], [], []
            for i, (n, end) in enumerate(zip(sizes.tolist(), ends.tolist())):
                found = keys_of(words[end - n : end], count[end - n : end], total)
                for key, start in found:
                    keys.append(key)
                    starts.append(end - n + start)
                    rows.append(i)
            at, of = np.array(starts, np.int64), np.array(rows, np.int64)
            size, rest = sizes[of], ends[of] - at
            one, two = pack_counts(words, at, ends[of])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ids[of]), pa.array(size.astype(np.int32)), pa.array(rest.astype(np.int32)), pa.array(one), pa.array(two)], names=[c.split()[0] for c in POINT.split(", ")])

    points = once.mapInArrow(put, POINT).repartition("key").sortWithinPartitions("key")
    met = materialise(points.mapInArrow(_join_points(BLOCK), JOINED), "met")
    candidates = met.where("id_b IS NOT NULL").select("id_a", "id_b")
    hot = met.where("id_b IS NULL")
    if not hot.isEmpty():
        cells = _in_blocks(hot.withColumnRenamed("id_a", "id").drop("id_b")).repartition("key").sortWithinPartitions("key")
        candidates = candidates.unionByName(cells.mapInArrow(_join_points(None), JOINED).select("id_a", "id_b"))
    candidates = candidates.distinct()
    a, b = once.select(F.col("class").alias("id_a"), F.col("words").alias("words_a")), once.select(F.col("class").alias("id_b"), F.col("words").alias("words_b"))
    both = candidates.join(a, "id_a").join(b, "id_b")
    shared_words = F.size(F.array_intersect("words_a", "words_b"))
    # Integers, so that the threshold itself is met exactly: q = 3/5.
    alike = both.where(shared_words * 5 >= (F.size("words_a") + F.size("words_b") - shared_words) * 3)
    return alike.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def like_pairs(df: DataFrame, key: str, text: str, materialise) -> DataFrame:
    """key_a < key_b: all pairs of rows with equal or alike word sets.

    A null text and one without words are in no pair. ``key`` must be unique.
    The result has every pair of copies, so it is as large as the copies make it;
    :func:`groups` has one row per record instead.
    """
    sets = word_sets(df, key, text, materialise)
    member = sets.select("key", "class")
    links = materialise(class_links(sets, materialise), "links")
    a, b = member.select(F.col("key").alias("x"), F.col("class").alias("a")), member.select(F.col("key").alias("y"), F.col("class").alias("b"))
    between = links.join(a, "a").join(b, "b").select(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b"))
    within = pairs_within(member, ["class"], "key").select(F.col("a.key").alias("key_a"), F.col("b.key").alias("key_b"))
    return between.unionByName(within)


def components(edges: DataFrame, materialise) -> DataFrame:
    """id and root (the least id it is connected to) of every id of ``edges`` (a, b), by alternating stars.

    Each round is a table; the number of rounds grows with the logarithm of the longest chain.
    """
    edges = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b")
        following = materialise(small.select(F.col("b").alias("a"), F.col("a").alias("b")).distinct(), "edges")
        # Settled when every id has one neighbour below it and no root is itself below another.
        unsettled = following.groupBy("b").count().where("count > 1").limit(1).count() or following.select("a").distinct().join(following.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count()
        edges = following
        if not unsettled:
            return edges.select(F.col("b").alias("id"), F.col("a").alias("root")).union(edges.select(F.col("a").alias("id"), F.col("a").alias("root"))).distinct()


def groups(df: DataFrame, key: str, text: str, materialise) -> DataFrame:
    """key, group (its least key), group_size and n_links (alike texts of another word set) of every row.

    Rows are in one group if a chain of alike texts joins them. A row with a null
    text, or none of whose texts has words, is a group of its own without links.
    """
    sets = word_sets(df, key, text, materialise)
    links = materialise(class_links(sets, materialise), "links")
    degree = links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count("*").alias("n_links"))
    root = components(links, materialise)
    placed = sets.select("key", "class").join(root.select(F.col("id").alias("class"), "root"), "class", "left").join(degree, "class", "left")
    placed = placed.select("key", F.coalesce("root", "class").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    named = placed.groupBy("root").agg(F.min("key").alias("group"), F.count("*").alias("group_size"))
    found = placed.join(named, "root").select("key", "group", "group_size", "n_links")
    alone = df.select(F.col(key).cast("bigint").alias("key")).join(sets.select("key"), "key", "left_anti")
    return found.unionByName(alone.select("key", F.col("key").alias("group"), F.lit(1).cast("bigint").alias("group_size"), F.lit(0).cast("bigint").alias("n_links")))
