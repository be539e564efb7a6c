"""Near-duplicates within a table and against history, against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import history, neardup
from textloom.plans.shared import materialise, shared_dir


def words(text):
    return set(neardup._WORD.findall(text.lower()))


def alike(a, b):
    x, y = words(a), words(b)
    return bool(x and y) and 5 * len(x & y) >= 3 * len(x | y)


def corpus(seed, n, vocabulary=300):
    """Texts of all lengths with copies, small edits, reorderings and a stock phrase in a third of them."""
    rng = random.Random(seed)
    texts = []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.45:
            w = rng.choice(texts).split()
            for _ in range(rng.randint(0, max(1, len(w) // 4))):
                at = rng.randrange(len(w)) if w else 0
                edit = rng.randrange(4)
                if edit == 0 and w:
                    w[at] = f"w{rng.randrange(vocabulary)}"
                elif edit == 1:
                    w.insert(at, f"w{rng.randrange(vocabulary)}")
                elif edit == 2 and len(w) > 1:
                    w.pop(at)
                else:
                    rng.shuffle(w)
            texts.append(" ".join(w))
        else:
            w = [f"w{int(rng.paretovariate(0.6)) % vocabulary}" for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 12, 25, 60]))]
            texts.append(" ".join(w + ["бу", "бер", "гадәти", "гыйбарә"] * (i % 3 == 0)))
    return texts


@pytest.mark.parametrize("crowded", [neardup.CROWDED, 3])
def test_all_pairs_are_found(spark, monkeypatch, crowded):
    # With the low bound almost every key is extended to several words.
    monkeypatch.setattr(neardup, "CROWDED", crowded)
    texts = corpus(3, 500)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(9001, None), (9002, ""), (9003, "!!")], "seq long, text string").withColumn("class", F.lit("clash")).withColumn("words", F.lit(1))
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if alike(texts[i], texts[j])}
    found = [(r.key_a, r.key_b) for r in neardup.like_pairs(df, "seq", "text", materialise).collect()]
    assert len(found) == len(set(found)) and set(found) == want
    assert len(want) > 100


def test_keys_meet():
    """Two alike sets always share a key, at any depth of keys."""
    rng = random.Random(8)
    for crowded in (1, 5, 40, 10**9):
        neardup.CROWDED, before = crowded, neardup.CROWDED
        try:
            for _ in range(400):
                n = rng.randint(1, 40)
                x = rng.sample(range(200), n)
                y = [w for w in x if rng.random() > 0.15] + rng.sample(range(200, 260), rng.randint(0, n // 6 + 1))
                if not (y and 5 * len(set(x) & set(y)) >= 3 * len(set(x) | set(y))):
                    continue
                keys = []
                for s in (x, y):
                    w = np.array(sorted(set(s)), np.int64)
                    count = np.array([10 + v % 50 for v in w])
                    order = np.lexsort((w, count))
                    keys.append({k for k, _ in neardup.keys_of(w[order], count[order], 1000)})
                assert keys[0] & keys[1]
        finally:
            neardup.CROWDED = before


def test_tree_is_all_pairs():
    rng = np.random.default_rng(2)
    n = 700
    key, size = rng.integers(0, 4, n), rng.integers(5, 40, n).astype(float)
    rest, counts = (size * rng.uniform(0.5, 1, n)).round(), rng.integers(0, 4, (n, neardup.GROUPS)).astype(np.uint8)
    order = np.lexsort((rest, size, key))
    key, size, rest, counts = key[order], size[order], rest[order], counts[order]
    tree = neardup._Tree(key, size, rest, counts)
    got = [tuple(sorted(p)) for x, y in tree.pairs() for p in zip(x.tolist(), y.tolist())]
    want = set()
    for i in range(n):
        for j in range(i + 1, n):
            need = neardup.overlap_needed(size[i], size[j])
            if key[i] == key[j] and min(rest[i], rest[j]) >= need and min(size[i], size[j]) >= 0.6 * max(size[i], size[j]) and np.minimum(counts[i], counts[j]).sum() >= need:
                want.add((i, j))
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50
    assert len(tree.levels) == 4 or len(tree.levels) == 3


def test_long_texts_keep_their_bound():
    words_ = np.arange(1, 4001, dtype=np.int64) * 2654435761
    one, two = neardup.pack_counts(words_, np.array([0]), np.array([4000]))
    assert (neardup.unpack_counts(one) == 120).all() and (neardup.unpack_counts(two) == 120).all()


def test_groups(spark):
    texts = ["а б в г д", "а б в г е", "а б в ж е", "а б в г д", "я", None, "", "x y z"]
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, text string")
    got = {r.key: (r.group, r.group_size, r.n_links) for r in neardup.groups(df, "seq", "text", materialise).collect()}
    assert got == {0: (0, 4, 1), 1: (0, 4, 2), 2: (0, 4, 1), 3: (0, 4, 1), 4: (4, 1, 0), 5: (5, 1, 0), 6: (6, 1, 0), 7: (7, 1, 0)}
    assert neardup.groups(df.limit(0), "seq", "text", materialise).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 30)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.id: r.root for r in neardup.components(spark.createDataFrame(edges, "a long, b long"), materialise).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert neardup.components(spark.createDataFrame([], "a long, b long"), materialise).count() == 0


def test_bloom_holds_all():
    rng = np.random.default_rng(1)
    prints = np.sort(rng.integers(-(2**63), 2**63 - 1, 5000))
    batch = history.pa.RecordBatch.from_arrays([history.pa.array(np.full(5000, 3, np.int32)), history.pa.array(prints)], names=["part", "print"])
    (row,) = history._bloom_rows(iter([batch]))
    bits = row.column(1)[0].as_py()
    assert history.bloom_has(bits, prints).all() and history.bloom_has(bits, rng.integers(-(2**63), 2**63 - 1, 50000)).mean() < 0.003


def sets_of(df):
    return history.text_sets(df, "seq", "text")


@pytest.mark.parametrize("holders, part_rows", [(history.HOLDERS, history.PART_ROWS), (0, 500)])
def test_history_batch_by_batch(spark, monkeypatch, holders, part_rows):
    # Without shingles the rare words alone must find everything; small parts make many files.
    monkeypatch.setattr(history, "HOLDERS", holders)
    monkeypatch.setattr(history, "PART_ROWS", part_rows)
    monkeypatch.setattr(history, "PART_SETS", part_rows // 8)
    old, new = corpus(11, 260), corpus(12, 60) + corpus(11, 300)[200:]
    new += ["\U0001f642", "\U0001f642", "", None]
    stored = spark.createDataFrame(list(enumerate(old)), "seq long, text string")
    store = history.FingerprintStore.create(sets_of(stored).select("class", "words"), f"{shared_dir(spark)}/store-{holders}")
    rows = spark.createDataFrame(list(enumerate(new)), "seq long, text string").withColumn("class", F.lit("clash"))
    found = []
    for number, (lo, hi) in enumerate(((0, 70), (70, len(new))), 1):
        known, earlier = history.check_and_add(store, sets_of(rows.where(f"seq >= {lo} AND seq < {hi}")), number, materialise)
        found.append({r.key for r in known.union(earlier).collect()})
        store = history.FingerprintStore(spark, store.folder)
    want, seen = set(), list(old)
    for i, t in enumerate(new):
        if t is not None and any(t == s or alike(t, s) for s in seen if s is not None):
            want.add(i)
        seen.append(t)
    assert found[0] | found[1] == want and len(want) > 30
    # A batch that is handled again sees what it saw before, and leaves the store as it is.
    assert [n for n, _ in store.generations()] == [f"generation-00000{k}" for k in range(3)]
    again = [history.check_and_add(store, sets_of(rows.where("seq < 70")), 1, materialise)]
    assert {r.key for known, earlier in again for r in known.union(earlier).collect()} == found[0] and len(store.generations()) == 3
    store.compact()
    assert len(store.generations()) == 1
    known, _ = history.check_and_add(store, sets_of(rows), None, materialise)
    assert {r.key for r in known.collect()} == {i for i, t in enumerate(new) if t is not None} and len(store.generations()) == 1


def test_only_what_is_needed_is_read(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(history, "PART_ROWS", 5_000)
    monkeypatch.setattr(history, "ROW_GROUP", 20 << 10)
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(4000)}" for _ in range(20)) for _ in range(3000)]
    store = history.FingerprintStore.create(materialise(sets_of(spark.createDataFrame(list(enumerate(texts)), "seq long, text string")).select("class", "words"), "old"), f"file://{tmp_path}/store")
    size = {kind: sum(p.stat().st_size for p in (tmp_path / "store" / "generation-000000" / kind).rglob("*.parquet")) for kind in ("sets", "prints", "prints_bloom")}
    before = store.bytes_read.value
    unlike = [" ".join(f"v{rng.randrange(9000)}" for _ in range(20)) for _ in range(40)]
    known, _ = history.check_and_add(store, sets_of(spark.createDataFrame(list(enumerate(unlike)), "seq long, text string")), 1, materialise)
    assert known.count() == 0
    unlike_read = store.bytes_read.value - before
    # Filters at most, and the few row groups that they let through by mistake.
    assert unlike_read < size["prints_bloom"] * 2 and unlike_read * 5 < sum(size.values())
    before = store.bytes_read.value
    known, _ = history.check_and_add(store, sets_of(spark.createDataFrame([(7, texts[7] + " v1")], "seq long, text string")), 2, materialise)
    assert known.count() == 1
    assert store.bytes_read.value - before < 0.5 * sum(size.values())


def test_empty_history(spark):
    none = spark.createDataFrame([], "seq long, text string")
    store = history.FingerprintStore.create(sets_of(none).select("class", "words"), f"{shared_dir(spark)}/store-empty")
    some = spark.createDataFrame([(1, "а б в"), (2, "а б в"), (3, None)], "seq long, text string")
    known, earlier = history.check_and_add(store, sets_of(some), 1, materialise)
    assert known.count() == 0 and [r.key for r in earlier.collect()] == [2]
    known, earlier = history.check_and_add(store, sets_of(none), 2, materialise)
    assert known.count() == 0 and earlier.count() == 0
    known, _ = history.check_and_add(store, sets_of(some.where("seq = 1")), 3, materialise)
    assert [r.key for r in known.collect()] == [1]


def test_key_log(spark, tmp_path):
    log = history.KeyLog(spark, f"file://{tmp_path}/log")
    ask = spark.createDataFrame([("a",), ("b",), ("b",), ("x",), (None,)], "k string")
    assert log.known(ask, "k").count() == 0
    log.add(spark.createDataFrame([("a",), ("a",), (None,), ("c",)], "k string"), "k", 0)
    log.add(spark.createDataFrame([("b",)], "k string"), "k", 1)
    log.add(spark.createDataFrame([("x",)], "k string"), "k", 1)  # complete already
    assert sorted(r.key for r in log.known(ask, "k").collect()) == ["a", "b"]


def test_a_store_lasts(spark, tmp_path):
    """With a folder of its own the store serves the next run, which gives the same rows."""
    from textloom.llm.queries import QUERIES

    small = "/root/testdata/sf0.001"
    want = {r.seq for r in QUERIES["p3_found"](spark, small).collect()}
    spark.conf.set("textloom.history", f"file://{tmp_path}/kept")
    try:
        for _ in range(2):
            assert {r.seq for r in QUERIES["p3_found"](spark, small).collect()} == want
        assert len(history.FingerprintStore(spark, f"file://{tmp_path}/kept/texts").generations()) == 4
    finally:
        spark.conf.unset("textloom.history")


def test_a_hot_key_is_dealt_out(spark, monkeypatch):
    """A third of the rows share their rarest words; their keys are joined in blocks, and nothing is lost."""
    monkeypatch.setattr(neardup, "BLOCK", 20)
    monkeypatch.setattr(neardup, "HELD", 50)
    monkeypatch.setattr(neardup, "PAIR_BLOCK", 7)
    rng = random.Random(9)
    texts = ["бу бер дә " + " ".join(rng.choice("абвгдеж") for _ in range(rng.randrange(1, 4))) for _ in range(150)] + corpus(4, 300)
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, text string")
    met = []
    keep = lambda d, tag: met.append((tag, materialise(d, tag))) or met[-1][1]
    found = [(r.key_a, r.key_b) for r in neardup.like_pairs(df, "seq", "text", keep).collect()]
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if alike(texts[i], texts[j])}
    assert len(found) == len(set(found)) and set(found) == want
    assert dict(met)["met"].where("id_b IS NULL").count() > 20
