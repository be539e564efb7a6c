"""First come, first kept; SimHash; near-duplicates."""

import hashlib
import os
import random

import pyarrow as pa

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions.simhash import bands, hamming, simhash_lists
from textloom.operators import dedup, firstwins
from textloom.plans import shared
from textloom.plans.catalogue import QUERIES
from textloom.plans.shared import materialise, scratch
from textloom.profile import Profile


def plain_simhash(tokens):
    ones = [0] * 64
    for t in tokens:
        h = int.from_bytes(hashlib.md5(t.encode()).digest()[8:], "big")
        for i in range(64):
            ones[i] += h >> i & 1
    value = sum(1 << i for i in range(64) if 2 * ones[i] > len(tokens))
    return value - (1 << 64) if value >> 63 else value


@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "d", "e"]), max_size=6), min_size=1, max_size=8))
@settings(max_examples=40, deadline=None)
def test_simhash(lists):
    assert simhash_lists(pa.array(lists, pa.list_(pa.string()))).tolist() == [plain_simhash(x) for x in lists]


def test_bands_lose_nothing(spark):
    rng = random.Random(1)
    values = []
    for _ in range(40):
        v = rng.getrandbits(64)
        values += [v, v ^ (1 << rng.randrange(64)), v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "simhash long")
    got = {(r.a, r.b, r.distance) for r in dedup.near_pairs(df, 2).collect()}
    want = {(a, b, d) for a in set(signed) for b in set(signed) if a < b and (d := bin((a ^ b) & (1 << 64) - 1).count("1")) <= 2}
    assert got == want
    assert df.select(F.size(bands("simhash", 2)), hamming("simhash", "simhash")).first()[:] == (10, 0)


def test_members_and_pairs_give_all_near_segments(spark, tmp_path):
    """Other texts of one SimHash, copies of near ones, empty texts and a null one; against all pairs."""
    given = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/dedup_segments.parquet").where("text IS NOT NULL").sort("seq").limit(60).collect()]
    texts = [*given, *(t.upper() for t in given[:9]), *(" ".join(reversed(t.split())) for t in given[5:12]), *(f"{t} {t.split()[0]}" for t in given), "", "!", None]
    spark.createDataFrame(list(enumerate(texts, 1)), "seq long, text string").write.parquet(f"file://{tmp_path}/dedup_segments.parquet")
    of = {r.seq: r.simhash for r in dedup.with_simhash(spark.read.parquet(f"file://{tmp_path}/dedup_segments.parquet"), "text").where("simhash IS NOT NULL").collect()}
    want = {(a, b) for a in of for b in of if a < b and bin((of[a] ^ of[b]) & (1 << 64) - 1).count("1") <= 2}
    assert any(of[a] == of[b] for a, b in want) and any(of[a] != of[b] for a, b in want)
    members = {r.seq: (r.first_seq, r.n_links) for r in QUERIES["near_dup_members"](spark, f"file://{tmp_path}").collect()}
    classes = {first: [s for s in members if members[s][0] == first] for first, _ in members.values()}
    got = {(a, b) for rows in classes.values() for a in rows for b in rows if a < b}
    for r in QUERIES["near_dup_pairs"](spark, f"file://{tmp_path}").collect():
        got |= {(min(a, b), max(a, b)) for a in classes[r.seq_a] for b in classes[r.seq_b]}
    assert got == want and members.keys() == of.keys()
    assert {s: n for s, (_, n) in members.items()} == {s: sum(s in p for p in want) for s in of}


def test_two_keys(spark):
    def run(rows, stored=None):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, id string, h string")
        old = None if stored is None else spark.createDataFrame(stored, "id string, h string")
        return [r.seq for r in firstwins.two_key_first(df, "seq", "id", "h", materialise, old).orderBy("seq").collect()]

    assert run([("A", "X"), ("B", "X"), ("B", "Y")]) == [0, 2]
    assert run([("A", "X"), ("A", "Y"), ("B", "Y")]) == [0, 2]
    assert run([("A", "X"), ("A", "X"), (None, None), (None, None), (None, "X"), ("C", None)]) == [0, 2, 3, 5]
    assert run([("A", "X"), ("B", "Y"), ("C", "Z")], [("A", "Q"), ("R", "Y")]) == [2]


def test_first_and_last_of_a_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "seq long, k string")
    assert {r.seq for r in firstwins.keep_first(df, "k", "seq").collect()} == {1, 3, 4}
    assert {r.seq for r in firstwins.keep_last(df, "k", "seq").collect()} == {2, 3, 4}
    assert firstwins.keep_first(df.limit(0), "k", "seq").count() == 0


def plain_dedup(rows, profile, stored=()):
    import regex

    def facts(text):
        t = regex.findall(r"[\p{L}\d]+(?:'[\p{L}\d]+)?", text.lower())
        return plain_simhash(t) & (1 << 64) - 1, len(t)

    kept = [(None if h is None else h, facts(t)[0]) for t, h in stored]
    out = {}
    for seq, text, h in rows:
        s, n = facts(text)
        k = profile.short_distance if n <= profile.short_tokens else profile.near_distance
        if h is not None and any(h == o for o, _ in kept):
            out[seq] = "exact_dup"
        elif any(bin(s ^ o).count("1") <= k for _, o in kept):
            out[seq] = "near_dup"
        else:
            out[seq] = "kept"
            kept.append((h, s))
    return out


def test_greedy_dedup(spark):
    rng = random.Random(5)
    profile = Profile(near_distance=9, short_distance=4, short_tokens=5)
    words = [f"w{i}" for i in range(12)]
    rows = []
    for i in range(90):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 9)))
        rows.append((i, text, rng.choice([None, f"h{hash(text) % 50}", f"h{rng.randrange(40)}"])))
    df = spark.createDataFrame(rows, "seq long, text string, norm_hash string")
    got = {r.seq: r.status for r in dedup.deduplicate(df, "seq", "text", "norm_hash", materialise, profile).collect()}
    assert got == plain_dedup(rows, profile)
    stored = [(t, h) for _, t, h in rows[:6]]
    old = spark.createDataFrame([(f"id{i}", t, h) for i, (t, h) in enumerate(stored)], "id string, text string, norm_hash string")
    fresh = df.where("seq >= 4").withColumn("id", F.concat(F.lit("id"), "seq"))
    got = {r.seq: r.status for r in dedup.deduplicate(fresh, "seq", "text", "norm_hash", materialise, profile, old, "id").collect()}
    assert {s for s, v in got.items() if v == "already_present"} == {4, 5}
    assert {s: v for s, v in got.items() if s > 5} == plain_dedup(rows[6:], profile, stored)
    assert dedup.deduplicate(df.limit(0), "seq", "text", "norm_hash", materialise).count() == 0


def test_null_texts_are_kept(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, None), (3, None, "h"), (4, "x", "h")], "seq long, text string, norm_hash string")
    got = {r.seq: r.status for r in dedup.deduplicate(df, "seq", "text", "norm_hash", materialise).collect()}
    assert got == {1: "kept", 2: "kept", 3: "kept", 4: "exact_dup"}


def test_tables_in_the_shared_folder(spark):
    with scratch(spark):
        df = materialise(spark.range(3), "t")
        file = df.inputFiles()[0].removeprefix("file:").removeprefix("//")
        assert df.count() == 3 and spark.conf.get("spark.checkpoint.dir").rstrip("/") in df.inputFiles()[0] and os.path.exists(file)
    assert not os.path.exists(file)


def test_insert_or_replace(spark):
    """The rows left are those of a table whose keys are both unique and whose rows give way to new ones."""
    rng = random.Random(6)
    for n in (0, 1, 12, 60):
        rows = [(i, rng.choice([None, *"abcdefgh"]), rng.choice([None, *"uvwxyz"])) for i in range(n)]
        left = []
        for r in rows:
            left = [o for o in left if not (r[1] is not None and o[1] == r[1] or r[2] is not None and o[2] == r[2])] + [r]
        df = spark.createDataFrame([*rows, (None, "a", "u")], "seq long, id string, norm_hash string")
        assert sorted(tuple(r) for r in firstwins.replace_last(df, "seq", "id", "norm_hash").collect()) == left


def test_stored_simhashes_are_used(spark):
    """A stored SimHash counts as it is; one that is missing is made."""
    old = spark.createDataFrame([("а б в г д е ж з и к", "x", None), ("q", "y", 5)], "text string, norm_hash string, simhash long").withColumn("id", F.col("norm_hash"))
    new = spark.createDataFrame([(1, "а б в г д е ж з и к", "z")], "seq long, text string, norm_hash string").withColumn("id", F.lit("new"))
    assert [r.status for r in dedup.deduplicate(new, "seq", "text", "norm_hash", materialise, stored=old, key="id").collect()] == ["near_dup"]
    other = old.where("norm_hash = 'y'").withColumn("text", F.lit("а б в г д е ж з и к"))
    assert [r.status for r in dedup.deduplicate(new, "seq", "text", "norm_hash", materialise, stored=other, key="id").collect()] == ["kept"]


def test_large_tables_are_not_broadcast(spark, monkeypatch):
    """However small Spark takes a table to be: joins of more rows than may be broadcast are merged, the bands of SimHash values always."""
    plans = []

    def run(df):
        got = df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())  # the last plan, as it ran
        return got

    def watched(df, tag):
        run(df)
        return materialise(df, tag)

    rng = random.Random(8)
    words = [f"w{i}" for i in range(12)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(3, 9))), None) for i in range(60)]
    df = spark.createDataFrame(rows, "seq long, text string, norm_hash string")
    assert run(dedup.near_pairs(dedup.with_simhash(df, "text"), 9)) and "BroadcastExchange" not in plans[-1]
    monkeypatch.setattr(shared, "BROADCAST_ROWS", -1, raising=False)
    got = {r.seq: r.status for r in run(dedup.greedy_constant(df, "seq", "text", 9, watched))}
    assert got == plain_dedup(rows, Profile(near_distance=9, short_distance=9)) and len(set(got.values())) == 2
    assert sum("SortMergeJoin" in p for p in plans) > 3 and not any("BroadcastExchange" in p for p in plans)
