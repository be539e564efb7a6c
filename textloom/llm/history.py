"""New batches checked against everything accepted before, through a persistent fingerprint store.

A store is a folder that grows by generations, one for each accepted batch:

``prints`` fingerprints and the classes of texts that have them, in order of fingerprint;
``prints_bloom`` Bloom filters over them;
``sets``   the word set of every class (hashed words), in order of class.

Each table of a generation is split into parts by the leading bits of a hash, as many as
its size asks for, so a part doesn't grow with history. :meth:`FingerprintStore.check`
asks the filters first; of the fingerprints only the row groups in which positives may
stand are read, and of the word sets only those with classes met there. These candidates
are verified by the share of words both have. :meth:`FingerprintStore.add` then appends the
batch: filters, fingerprints and sets. What is stored is never rewritten or read as a
whole, but for :meth:`FingerprintStore.compact`, which joins generations when they have become many.

Fingerprints are of two kinds. Winnowed shingles: of every ``WINDOW`` runs of
``SHINGLE`` consecutive words the one of the least hash. Texts that share a run of
``WINDOW + SHINGLE - 1`` words share one, but reordered or densely edited texts need not,
and a stock phrase would gather any number of texts. So shingles held by more than
``HOLDERS`` classes (of what is read in one go) are passed over, and the rare words of a text are winnowed too: the
keys of :mod:`neardup`, of which alike texts always share one, and of which none is
passed over. They carry group counts that bound the shared words before anything is
verified. The result is exact whatever the edits.

Rows of a batch are compared with one another in the same tasks: they meet under the same
fingerprints, and are verified in the same way.

:class:`KeyLog` is the same for whole keys, as row hashes: filters first, then row groups.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as papq
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.plans.shared import spread

from .neardup import _first_of_class, _Hashes, bucket, frequency_sketch, keys_of, overlap_needed, word_set

SHINGLE, WINDOW = 3, 4
HOLDERS = 50
#: Fingerprints, word sets and keys for which a part of a table is meant: some ten megabytes each.
PART_ROWS, PART_SETS, PART_KEYS = 400_000, 50_000, 100_000
#: A filter answers wrongly for about one in a thousand.
BLOOM_BITS, BLOOM_HASHES = 14, 10
#: Bytes of a row group, the least that is read, of fingerprints and keys, and of word sets; and how many are read in one go.
ROW_GROUP, SET_GROUP, GROUPS_AT_ONCE = 32 << 10, 64 << 10, 16
GROUPS = 16
AT_ONCE = 1_000_000
VERIFIED_AT_ONCE = 200_000


def _mix(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit hashes (splitmix64)."""
    x = x.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def winnow(words: np.ndarray) -> np.ndarray:
    """The winnowed shingles of a text's distinct words in the order of their first occurrence."""
    wide = words.view(np.uint64)
    n = max(1, len(wide) - SHINGLE + 1)
    run = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(wide))):
        run = run * np.uint64(0x100000001B3) + wide[k : n + k]
    run = _mix(run)
    if n <= WINDOW:
        return run[[run.argmin()]]
    return np.unique(np.lib.stride_tricks.sliding_window_view(run, WINDOW).min(1))


def pack_counts(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Counts by group between each start and end, four bits each; 15 stands for any larger count."""
    group = (words.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(60)).astype(np.int64)
    before = np.zeros((len(words) + 1, GROUPS), np.int32)
    before[np.arange(1, len(words) + 1), group] = 1
    np.cumsum(before, axis=0, out=before)
    count = np.minimum(before[ends] - before[starts], 15).astype(np.uint64)
    return (count << (np.arange(GROUPS, dtype=np.uint64) * np.uint64(4))).sum(1, dtype=np.uint64).view(np.int64)


def _shared_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The most words that the sets behind two packed counts can share."""
    a, b = a.view(np.uint64), b.view(np.uint64)
    total = np.zeros(len(a), np.int64)
    for k in range(GROUPS):
        x, y = (a >> np.uint64(4 * k)) & np.uint64(15), (b >> np.uint64(4 * k)) & np.uint64(15)
        least = np.minimum(x, y)
        total += np.where(least == 15, 1_000_000, least).astype(np.int64)
    return total


def _texts_to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in batches:
        classes, sets = [], []
        for text in batch.column(1).to_pylist():
            words = word_set(text, hashes)
            known_by = np.array(sorted(words), np.int64).tobytes() if words else text.encode("utf-8", "surrogatepass") + b"#"
            classes.append(xxhash.xxh64_intdigest(known_by, 1) - (1 << 63))
            sets.append(words)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(classes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["key", "class", "words"])


def text_sets(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, class and hashed words of every row with a text; a text without words is its own class."""
    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text IS NOT NULL")
    return source.mapInArrow(_texts_to_sets, f"key {kind}, class bigint, words array<bigint>")


def unique_classes(sets: DataFrame) -> DataFrame:
    """class and words once per class: copies go within a partition first, so a class of very many rows is small before it is shuffled."""
    return sets.select("class", "words").mapInArrow(_first_of_class, "class bigint, words array<bigint>").dropDuplicates(["class"])


PRINT = "print bigint, class bigint, size int, rest int, counts bigint"
_PRINT_NAMES = [c.split()[0] for c in PRINT.split(", ")]


def _prints(sketch: np.ndarray, total: int):
    """A function from (class, words) to fingerprints; ``rest`` is 0 for shingles, which may be passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = batch.column(0).to_numpy(), np.diff(batch.column(1).offsets.to_numpy())
            words = batch.column(1).flatten().to_numpy()
            ends = np.cumsum(sizes)
            shingles = [winnow(words[e - n : e]) if n else _mix(c) for n, e, c in zip(sizes.tolist(), ends.tolist(), ids.reshape(-1, 1))]
            shingle_of = np.repeat(np.arange(len(sizes)), [len(s) for s in shingles])
            # In the common order; a word that the sketch doesn't know counts as seen twice, as it may come again.
            count = np.maximum(sketch[bucket(words)], 2)
            row = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((words, count, row))
            words, count = words[order], count[order]
            keys, starts, rows = [], [], []
            for i, (n, end) in enumerate(zip(sizes.tolist(), ends.tolist())):
                for key, start in () if not n else keys_of(words[end - n : end], count[end - n : end], total):
                    keys.append(key)
                    starts.append(end - n + start)
                    rows.append(i)
            at, of = np.array(starts, np.int64), np.array(rows, np.int64)
            rare = _mix(np.array(keys, np.int64) ^ np.int64(0x2545F4914F6CDD1D))
            prints = np.concatenate([*shingles, rare]).view(np.int64) if len(ids) else np.zeros(0, np.int64)
            none = np.zeros(len(shingle_of), np.int64)
            # The one fingerprint of a text without words is never passed over.
            wordless = (sizes[shingle_of] == 0).astype(np.int64)
            columns = [
                pa.array(prints), pa.array(np.concatenate([ids[shingle_of], ids[of]])),
                pa.array(np.concatenate([sizes[shingle_of], sizes[of]]).astype(np.int32)),
                pa.array(np.concatenate([wordless, ends[of] - at]).astype(np.int32)),
                pa.array(np.concatenate([none, pack_counts(words, at, ends[of])])),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=_PRINT_NAMES)

    return run


# ---- filters and sorted tables -------------------------------------------------


def _bloom_places(prints: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    h = prints.view(np.uint64)
    step = (h >> np.uint64(17)) | np.uint64(1)
    for k in range(BLOOM_HASHES):
        yield ((h + np.uint64(k) * step) & np.uint64(bits - 1)).astype(np.int64)


def bloom_of(prints: np.ndarray) -> bytes:
    bits = 1 << max(6, int(len(prints) * BLOOM_BITS - 1).bit_length())
    on = np.zeros(bits, bool)
    for places in _bloom_places(prints, bits):
        on[places] = True
    return np.packbits(on).tobytes()


def bloom_has(bits: bytes, prints: np.ndarray) -> np.ndarray:
    """Which fingerprints the filter may hold: all that it holds, and about one in a thousand of the others."""
    packed = np.frombuffer(bits, np.uint8)
    has = np.ones(len(prints), bool)
    for places in _bloom_places(prints, len(packed) * 8):
        has &= (packed[places >> 3] >> (7 - (places & 7)).astype(np.uint8) & 1).astype(bool)
    return has


def _bloom_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filters for the parts whose fingerprints stand together, each over at most PART_ROWS of them."""

    def made(part: int, held: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bloom_of(np.unique(np.concatenate(held)))], pa.binary())], names=["part", "bits"])

    part, held, n = None, [], 0
    for batch in batches:
        of, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        begin = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else []
        for lo, hi in zip(begin, [*begin[1:], len(of)]):
            if held and (of[lo] != part or n >= PART_ROWS):
                yield made(part, held)
                held, n = [], 0
            part = int(of[lo])
            held.append(prints[lo:hi])
            n += hi - lo
    if held:
        yield made(part, held)


def _open(folder: str):
    """The file system of a folder as executors reach it from Python, and the path there."""
    scheme, rest = folder.split("://", 1) if "://" in folder else ("file", folder)
    return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


def parts_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The part of each hash among 2**bits, by its leading bits."""
    return (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def part_column(name: str, bits: int):
    return F.shiftrightunsigned(name, 64 - bits).cast("int") if bits else F.lit(0)


class _Shelf:
    """One generation of a table, read from a task: filters whole, rows by row group."""

    def __init__(self, folder: str, generation: str, table: str, bits: int, count=None):
        self.fs, path = _open(folder)
        self.path, self.bits, self.count = f"{path}/{generation}/{table}", bits, count or (lambda n: None)

    def _files(self, table: str, part: int) -> list[str]:
        at = pafs.FileSelector(f"{table}/part={part}", allow_not_found=True)
        return [i.path for i in self.fs.get_file_info(at) if i.path.endswith(".parquet")]

    def may_have(self, part: int, values: np.ndarray) -> np.ndarray:
        maybe = np.zeros(len(values), bool)
        for file in self._files(f"{self.path}_bloom", part):
            with self.fs.open_input_file(file) as f:
                self.count(f.size())
                for bits in papq.ParquetFile(f).read(columns=["bits"]).column(0).to_pylist():
                    maybe |= bloom_has(bits, values)
        return maybe

    def rows(self, part: int, values: np.ndarray, columns: list[str]) -> Iterator[pa.Table]:
        """The row groups of a part in which one of the sorted values may stand by the first of the columns."""
        for file in self._files(self.path, part):
            with self.fs.open_input_file(file) as f:
                opened = papq.ParquetFile(f)
                self.count(opened.metadata.serialized_size)
                at = [opened.schema_arrow.names.index(c) for c in columns]
                needed: list[int] = []
                for group in range(opened.num_row_groups):
                    about = opened.metadata.row_group(group)
                    known = about.column(at[0]).statistics
                    if known is None or not known.has_min_max or np.searchsorted(values, known.min) < np.searchsorted(values, known.max, side="right"):
                        self.count(sum(about.column(k).total_compressed_size for k in at))
                        needed.append(group)
                for lo in range(0, len(needed), GROUPS_AT_ONCE):
                    yield opened.read_row_groups(needed[lo : lo + GROUPS_AT_ONCE], columns=columns).combine_chunks()


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held).combine_chunks() if held else None


def _runs(at: np.ndarray, lo: np.ndarray, held: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each ``at`` with each of its ``held`` places from ``lo`` on, some at a time."""
    done, here = np.cumsum(held), 0
    while here < len(at):
        to = max(here + 1, int(np.searchsorted(done, (done[here - 1] if here else 0) + AT_ONCE, side="right")))
        n = held[here:to]
        x = np.repeat(at[here:to], n)
        yield x, np.repeat(lo[here:to], n) + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        here = to


def _possible(mine: tuple, theirs: tuple, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose sizes and group counts leave enough shared words possible; each side is (class, size, rest, counts)."""
    (_, size, rest, counts), (_, old_size, old_rest, old_counts) = mine, theirs
    a, b = size[x], old_size[y]
    rare = rest[x] > 0
    needed = overlap_needed(a, b)
    keep = (np.minimum(a, b) >= needed) & (~rare | (np.minimum(rest[x], old_rest[y]) >= needed))
    x, y, rare, needed = x[keep], y[keep], rare[keep], needed[keep]
    keep = ~rare
    keep[rare] = _shared_bound(counts[x[rare]], old_counts[y[rare]]) >= needed[rare]
    return x[keep], y[keep]


CANDIDATE = "new bigint, old bigint, generation int"
#: The generation of a candidate that stands in the batch itself.
WITHIN = -1


def _candidates(new: np.ndarray, old: np.ndarray, generation: int) -> pa.RecordBatch:
    pairs = np.unique(np.stack([new, old], 1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()), pa.array(np.full(len(pairs), generation, np.int32))], names=["new", "old", "generation"])


def _look_up(folder: str, generations: list[tuple[str, dict]], count):
    """A function from the fingerprints of a batch that share their leading bits to candidate pairs of classes, stored ones and those of the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _whole(batches)
        if table is None:
            return
        table = table.sort_by("print")
        prints, *mine = (table.column(c).to_numpy() for c in _PRINT_NAMES)
        first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1]))
        values, held_here = prints[first], np.diff(np.append(first, len(prints)))
        for number, (name, about) in enumerate(generations):
            shelf = _Shelf(folder, name, "prints", about["print_bits"], count)
            of = parts_of(values, shelf.bits)
            for part in np.unique(of):
                at = np.flatnonzero(of == part)
                at = at[shelf.may_have(int(part), values[at])]
                if not len(at):
                    continue
                # Every fingerprint of the batch with every stored one of its value, row group by row group.
                n = held_here[at]
                rows = np.repeat(first[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                for stored in shelf.rows(int(part), values[at], _PRINT_NAMES):
                    stored = stored.filter(pa.array(np.isin(stored.column(0).to_numpy(), values[at])))
                    known, *theirs = (stored.column(c).to_numpy() for c in _PRINT_NAMES)
                    lo, hi = np.searchsorted(known, prints[rows]), np.searchsorted(known, prints[rows], side="right")
                    keep = (hi > lo) & ((mine[2][rows] > 0) | (hi - lo <= HOLDERS))
                    for x, y in _runs(rows[keep], lo[keep], (hi - lo)[keep]):
                        x, y = _possible(mine, theirs, x, y)
                        yield _candidates(mine[0][x], theirs[0][y], number)
        # The rows of the batch among themselves.
        place = np.arange(len(prints)) - np.repeat(first, held_here)
        size = np.repeat(held_here, held_here)
        keep = (place + 1 < size) & ((mine[2] > 0) | (size <= HOLDERS))
        rows = np.flatnonzero(keep)
        for x, y in _runs(rows, rows + 1, (size - place - 1)[keep]):
            x, y = _possible(mine, mine, x, y)
            a, b = np.minimum(mine[0][x], mine[0][y]), np.maximum(mine[0][x], mine[0][y])
            yield _candidates(a[a != b], b[a != b], WITHIN)

    return run


def _verify(folder: str, generations: list[tuple[str, dict]], count):
    """A function from (old, generation, new, words of new), of old classes that share their leading bits, to the pairs that are alike."""

    def verified(table: pa.Table) -> pa.RecordBatch:
        olds, of, news = (table.column(c).to_numpy() for c in ("old", "generation", "new"))
        words = table.column("words").combine_chunks()
        new, old = [], []
        for number in np.unique(of):
            name, about = generations[number]
            shelf = _Shelf(folder, name, "sets", about["set_bits"], count)
            mine = np.flatnonzero(of == number)
            part_of = parts_of(olds[mine], shelf.bits)
            for part in np.unique(part_of):
                rows = mine[part_of == part]
                wanted = np.unique(olds[rows])
                have: dict[int, set] = {}
                for stored in shelf.rows(int(part), wanted, ["class", "words"]):
                    classes = stored.column(0).to_numpy()
                    at = np.flatnonzero(np.isin(classes, wanted))
                    have.update(zip(classes[at].tolist(), map(set, stored.column(1).take(pa.array(at)).to_pylist())))
                for i in rows.tolist():
                    other = have.get(int(olds[i]))
                    if other is not None:
                        ours = words[i].as_py()
                        shared = len(other.intersection(ours))
                        if shared * 5 >= (len(other) + len(ours) - shared) * 3:
                            new.append(int(news[i]))
                            old.append(int(olds[i]))
        return pa.RecordBatch.from_arrays([pa.array(new, pa.int64()), pa.array(old, pa.int64())], names=["new", "old"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= VERIFIED_AT_ONCE:
                yield verified(pa.Table.from_batches(held))
                held = []
        if any(b.num_rows for b in held):
            yield verified(pa.Table.from_batches(held))

    return run


# ---- stores --------------------------------------------------------------------


class _Generations:
    """A folder (a URI that every executor can read and write) of generations, each complete once its ``about`` is there."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        #: Bytes of stored filters, fingerprints, sets and keys that checks have read, as executors report them.
        self.bytes_read = spark.sparkContext.accumulator(0)

    def _path(self, name: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _put(self, name: str, content: bytes) -> None:
        """A small file, whole or not at all."""
        fs, at = self._path(f"{name}.new")
        stream = fs.create(at, True)
        try:
            stream.write(bytearray(content))
        finally:
            stream.close()
        fs.delete(self._path(name)[1], False)
        fs.rename(at, self._path(name)[1])

    def _get(self, name: str) -> bytes:
        fs, at = self._path(name)
        stream = fs.open(at)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def exists(self, name: str) -> bool:
        fs, at = self._path(f"{name}/about.json")
        return fs.exists(at)

    def generations(self) -> list[tuple[str, dict]]:
        """The complete generations in order of name, and what is known about each."""
        fs, at = self._path("")
        names = sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()) if fs.exists(at) else []
        return [(n, json.loads(self._get(f"{n}/about.json"))) for n in names if n.startswith("generation-") and self.exists(n)]

    def remove(self, name: str) -> None:
        fs, at = self._path(name)
        fs.delete(at, True)

    def _write(self, rows: DataFrame, name: str, table: str, order: str, bits: int, filtered: bool) -> None:
        small = {"parquet.block.size": str(ROW_GROUP if filtered else SET_GROUP), "parquet.page.size": str(16 << 10), "compression": "zstd"}
        path = f"{self.folder}/{name}/{table}"
        placed = rows.withColumn("part", part_column(order, bits)).repartitionById(1 << bits, "part")
        if not filtered:
            # Copies of a class from different partitions meet in one part, and are stored once.
            placed = placed.select("class", "words", "part").mapInArrow(_first_of_class, "class bigint, words array<bigint>, part int")
        placed.sortWithinPartitions("part", order).write.options(**small).mode("overwrite").partitionBy("part").parquet(path)
        if filtered:
            written = self.spark.read.schema(f"{order} bigint, part int").parquet(path)
            written.select("part", order).mapInArrow(_bloom_rows, "part int, bits binary").write.mode("overwrite").partitionBy("part").parquet(f"{path}_bloom")

    def _counter(self):
        bytes_read = self.bytes_read
        return lambda n: bytes_read.add(n)

    def _shards(self, rows: int) -> int:
        """Leading bits by which a batch is spread over tasks: enough for the cores, and for PART_ROWS rows a task."""
        return _bits(max(rows, PART_ROWS * self.spark.sparkContext.defaultParallelism), PART_ROWS)


def _bits(rows: int, part_rows: int) -> int:
    """Leading bits for parts of at most about so many rows."""
    return max(0, math.ceil(math.log2(max(1, rows / part_rows))))


class FingerprintStore(_Generations):
    """Texts accepted so far, by generations; ``order`` holds the frequencies that fix the common order of words for good.

    The order only affects how selective the fingerprints are, never the result.
    """

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder)
        self.total, self.sketch = json.loads(self._get("order.json"))["total"], np.frombuffer(self._get("order.bin"), np.int32)
        self.shared = spark.sparkContext.broadcast((self.sketch, self.total))

    @staticmethod
    def there(spark: SparkSession, folder: str) -> bool:
        return _Generations(spark, folder).exists("generation-000000")

    @staticmethod
    def create(sets: DataFrame, folder: str) -> FingerprintStore:
        """A store whose first generation are the given (class, words), which also fix the order of words. An empty start is allowed."""
        spark, folder = sets.sparkSession, folder.rstrip("/")
        sketch, total = frequency_sketch(sets)
        at = _Generations(spark, folder)
        at._put("order.bin", sketch.astype(np.int32).tobytes())
        at._put("order.json", json.dumps({"total": total}).encode())
        store = FingerprintStore(spark, folder)
        store.add(sets, 0)
        return store

    def prints_of(self, classes: DataFrame) -> DataFrame:
        """The fingerprints of (class, words)."""
        shared = self.shared

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _prints(*shared.value)(batches)

        return classes.select("class", "words").mapInArrow(run, PRINT)

    def add(self, sets: DataFrame, number: int, prints: DataFrame | None = None) -> None:
        """Accept (class, words) as a generation: append sets, fingerprints and their filters.

        A number that is complete stays as it is, so a repeated update changes nothing; an
        update that was broken off is written anew. ``prints`` may be given where they are made already.
        """
        name = f"generation-{number:06d}"
        if self.exists(name):
            return
        rows = sets.count()
        set_bits, print_bits = _bits(rows, PART_SETS), _bits(rows * 24, PART_ROWS)
        self._write(sets.select("class", "words").mapInArrow(_first_of_class, "class bigint, words array<bigint>"), name, "sets", "class", set_bits, False)
        stored = self.spark.read.schema("class bigint, words array<bigint>").parquet(f"{self.folder}/{name}/sets")
        self._write(self.prints_of(spread(stored)) if prints is None else prints, name, "prints", "print", print_bits, True)
        self._put(f"{name}/about.json", json.dumps({"set_bits": set_bits, "print_bits": print_bits}).encode())

    def compact(self) -> None:
        """All generations as one, of more parts; for when there are many. Reads the sets once."""
        old = self.generations()
        if len(old) < 2:
            return
        sets = self.spark.read.schema("class bigint, words array<bigint>").option("recursiveFileLookup", "true").parquet(*(f"{self.folder}/{n}/sets" for n, _ in old))
        self.add(sets, int(old[-1][0].split("-")[1]) + 1)
        for name, _ in old:
            self.remove(name)

    def check(self, classes: DataFrame, prints: DataFrame, rows: int, before: int | None, materialise) -> DataFrame:
        """new, old, within: the alike pairs of the classes of a batch with stored ones (equal ones included) and, ``within``, with one another.

        ``classes`` (class, words) has a class once, ``prints`` are its fingerprints and
        ``rows`` how many classes there are; only generations numbered below ``before`` (if given) count.
        """
        generations = [g for g in self.generations() if before is None or int(g[0].split("-")[1]) < before]
        bits = self._shards(rows * 24)
        placed = prints.withColumn("shard", part_column("print", bits)).repartitionById(1 << bits, "shard").drop("shard")
        candidates = materialise(placed.mapInArrow(_look_up(self.folder, generations, self._counter()), CANDIDATE).distinct(), "candidates")
        words = classes.select(F.col("class").alias("new"), "words")
        asked = candidates.where(F.col("generation") != WITHIN).join(words, "new")
        asked = asked.withColumn("shard", part_column("old", bits)).repartitionById(1 << bits, "shard").drop("shard")
        stored = asked.mapInArrow(_verify(self.folder, generations, self._counter()), "new bigint, old bigint").withColumn("within", F.lit(False))
        inside = candidates.where(F.col("generation") == WITHIN).join(words, "new").join(classes.select(F.col("class").alias("old"), F.col("words").alias("words_old")), "old")
        shared = F.size(F.array_intersect("words", "words_old"))
        inside = inside.where(shared * 5 >= (F.size("words") + F.size("words_old") - shared) * 3).select("new", "old", F.lit(True).alias("within"))
        return stored.unionByName(inside)


def check_and_add(store: FingerprintStore, sets: DataFrame, number: int | None, materialise) -> tuple[DataFrame, DataFrame]:
    """The keys of rows (key, class, words) of a batch that are known from the store, and those alike an earlier row of the batch; then the batch is added.

    The order of rows within the batch is that of ``key``. Rows are judged by their
    class, so copies cost nothing further. The batch becomes generation ``number``;
    the check only reads generations before it, so a repeated call gives the same rows.
    Without a number the batch is checked against everything and not added.
    """
    sets = materialise(sets, "batch")
    classes = materialise(unique_classes(sets), "classes")
    prints = materialise(store.prints_of(classes), "prints")
    links = materialise(store.check(classes, prints, classes.count(), number, materialise), "links")
    if number is not None:
        store.add(classes, number, prints)
    rows = sets.select("key", "class")
    stored = rows.join(links.where("NOT within").select(F.col("new").alias("class")).distinct(), "class", "left_semi").select("key")
    within = links.where("within").select(F.col("new").alias("a"), F.col("old").alias("b"))
    return stored, known_in_batch(rows.withColumn("place", F.col("key")), within)


def known_in_batch(sets: DataFrame, links: DataFrame) -> DataFrame:
    """key of every row of (key, place, class) that is alike, or equal to, a row of a lower place.

    ``links`` (a, b) are the pairs of alike classes among the rows. Per class only its
    least place matters, so the work doesn't grow with the copies of a text.
    """
    least = sets.groupBy("class").agg(F.min("place").alias("least"))
    both = links.select("a", "b").union(links.select("b", "a"))
    nearest = both.join(least, both["b"] == least["class"]).groupBy("a").agg(F.min("least").alias("other"))
    bound = least.join(nearest, least["class"] == nearest["a"], "left").select("class", F.least("least", "other").alias("least"))
    return sets.join(bound, "class").where(F.col("place") > F.col("least")).select("key")


class KeyLog(_Generations):
    """Keys accepted so far (as row hashes), by generations, with filters; asked without reading what the filters rule out."""

    @staticmethod
    def _hashed(keys: DataFrame, key: str) -> DataFrame:
        return keys.select(F.xxhash64(key).alias("print"), F.xxhash64(F.lit("#"), key).alias("check"), F.col(key).alias("key")).where("key IS NOT NULL")

    def add(self, keys: DataFrame, key: str, number: int) -> None:
        """Append the distinct keys as a generation; one that is complete stays as it is."""
        name = f"generation-{number:06d}"
        if not self.exists(name):
            bits = _bits(keys.count(), PART_KEYS)
            self._write(self._hashed(keys, key).select("print", "check").distinct(), name, "keys", "print", bits, True)
            self._put(f"{name}/about.json", json.dumps({"key_bits": bits}).encode())

    def known(self, keys: DataFrame, key: str) -> DataFrame:
        """The distinct keys that are logged, compared by 128 bits, in column ``key``."""
        generations, folder, count = self.generations(), self.folder, self._counter()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = _whole(batches)
            if table is None:
                return
            table = table.sort_by("print")
            prints, checks = table.column(0).to_numpy(), table.column(1).to_numpy()
            hit = np.zeros(len(prints), bool)
            for name, about in generations:
                shelf = _Shelf(folder, name, "keys", about["key_bits"], count)
                of = parts_of(prints, shelf.bits)
                for part in np.unique(of):
                    at = np.flatnonzero((of == part) & ~hit)
                    at = at[shelf.may_have(int(part), prints[at])]
                    for stored in shelf.rows(int(part), prints[at], ["print", "check"]) if len(at) else ():
                        logged = set(zip(stored.column(0).to_pylist(), stored.column(1).to_pylist()))
                        hit[[i for i in at.tolist() if (int(prints[i]), int(checks[i])) in logged]] = True
            yield pa.RecordBatch.from_arrays([table.column("key").combine_chunks().take(pa.array(np.flatnonzero(hit)))], names=["key"])

        asked = self._hashed(keys.select(key).distinct(), key)
        bits = self._shards(0)
        placed = asked.withColumn("shard", part_column("print", bits)).repartitionById(1 << bits, "shard").drop("shard")
        return placed.mapInArrow(run, "key string")
