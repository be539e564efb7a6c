"""Label payloads, selection and its quotas, membership, exports."""

import json
import random

import pytest
from pyspark.sql import functions as F

from textloom.functions import labels as L
from textloom.operators import export, membership, selection
from textloom.plans.shared import materialise

PAYLOAD = {
    "main_language": "tatar", "tatar_prob": 0.95, "russian_share": 0.05, "error_share": 0.2, "error_density": "medium", "main_error_type": "spelling",
    "non_fluent_prob": 0.25, "meaning_clarity": 0.8, "noise_score": 0.1, "overall_gec_usefulness": 0.85,
}


def payload(**changes):
    return json.dumps({k: v for k, v in (PAYLOAD | changes).items() if v != "drop"})


def test_payloads(spark):
    cases = [
        (payload(), True, True), (json.dumps({"labels": PAYLOAD}), False, True), (payload(tatar_prob="0.9", extra=1), True, True), (payload(tatar_prob=True), True, True),
        (payload(tatar_prob=None), False, False), (payload(tatar_prob="drop"), False, False), (payload(main_language=3), False, False), (payload(noise_score="x"), False, False),
        ("{bad", False, False), ("", False, False), (None, False, False), ("[]", False, False), ("3", False, False), (payload(noise_score=7), True, True),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, j string")
    got = df.select("i", L.flat_labels("j").isNotNull(), L.any_labels("j").isNotNull()).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [c[1:] for c in cases]
    first = df.where("i = 1").select(L.any_labels("j").alias("l")).select("l.*").first().asDict()
    assert first == PAYLOAD
    enums = df.where("i IN (0, 6)").select(L.valid_enums(L.flat_labels("j"))).collect()
    assert [r[0] for r in enums] == [True, None]
    assert json.loads(df.where("i = 0").select(L.payload_json(L.flat_labels("j"))).first()[0]) == PAYLOAD


def test_responses(spark):
    item = {"id": "x1", "labels": PAYLOAD}
    bad = {"id": "x2", "labels": PAYLOAD | {"main_language": "bad"}}
    texts = [
        "```json\n" + json.dumps([item]) + "\n```", json.dumps([item, bad]), "Here: " + json.dumps([item]) + " done", "", None, "no", json.dumps({"id": "x1"}),
        json.dumps([item, {"id": "x2"}]),
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    tolerant = [r[0] for r in df.select(F.size(L.tolerant_items("t")), "i").orderBy("i").collect()]
    assert [None if n in (-1, None) else n for n in tolerant] == [1, None, 1, None, None, None, None, None]
    plain = [r[0] for r in df.select(F.size(L.scored_items("t")), "i").orderBy("i").collect()]
    assert [None if n in (-1, None) else n for n in plain] == [None, 2, None, None, None, None, None, None]


def test_quotas():
    sizes = {"low": 10, "medium": 100, "high": 10}
    assert selection.quotas(sizes, 10, 0.15, True) == selection.Quotas(6, 2, 2, 10)
    assert selection.quotas(sizes, 3, 0.5, True) == selection.Quotas(0, 2, 2, 3)
    assert selection.quotas(sizes, None, 0.9, False) == selection.Quotas(100, 10, 10, 120)
    assert selection.quotas({"low": 10, "medium": 2, "high": 10}, 11, 0.1, False) == selection.Quotas(2, 5, 4, 11)
    assert selection.quotas({}, 5, 0.1, True) == selection.Quotas(0, 0, 0, 5) and selection.quotas(sizes, -4, 0.1, True).total == 0


def candidates(spark, rows):
    return spark.createDataFrame(rows, "id string, text string, density string, score double")


def test_selection(spark):
    rows = [(f"m{i}", "t", "medium", 0.5) for i in range(8)] + [(f"l{i}", "t", "low", i / 10) for i in range(4)] + [(f"h{i}", "t", "high", 0.1) for i in range(4)]
    df = candidates(spark, rows)
    got = {(r.id, r.bucket_rank) for r in selection.select(df, materialise, 10, 0.15, True).collect()}
    assert got == {(f"m{i}", i + 1) for i in range(6)} | {("l3", 1), ("l2", 2), ("h0", 1), ("h1", 2)}
    assert {r.id for r in selection.select(df, materialise, 3, 0.5, True).collect()} == {"l3", "l2", "h0"}
    assert selection.select(df, materialise, None, 0.1, False).count() == 16 and selection.select(df.limit(0), materialise, 5).count() == 0
    again = [r.id for r in selection.shuffled(df, "id", 3).collect()]
    assert again == [r.id for r in selection.shuffled(df.orderBy(F.rand(1)), "id", 3).collect()] and sorted(again) == sorted(r[0] for r in rows)


def test_candidates(spark):
    rows = [("a", "t", payload()), ("b", "t", payload(noise_score="NaN")), ("c", "t", payload(noise_score=0.36)), ("d", "t", payload(main_language="russian")), ("e", "t", json.dumps({"labels": PAYLOAD})), ("f", "t", None), ("g", "t", payload(meaning_clarity=0.3)), ("h", "t", payload(error_density="odd"))]
    df = spark.createDataFrame(rows, "id string, text string, j string").withColumn("toxicity_label", F.lit(None).cast("int"))
    df = selection.source_rows(df, "j", "toxicity_label", "skipped")
    got = {r.id: r.score for r in selection.candidates(df, "id", "text", "j").collect()}
    assert set(got) == {"a", "b"} and got["a"] == pytest.approx(0.5 * 0.85 + 0.2 * 0.8 + 0.15 * 0.95 + 0.1 * 0.2 + 0.05 * 0.25 - 0.2 * 0.1)
    log = spark.createDataFrame([("a", "prepare_import"), ("b", "other")], "id string, target string")
    assert {r.id for r in selection.candidates(df, "id", "text", "j", log).collect()} == {"b"}


def test_membership(spark):
    rows = spark.createDataFrame([(1, "a", 0, None), (2, "b", 1, 0), (3, "c", None, 0), (4, "d", 0, 1), (5, None, 0, 0), (6, "e", 0, 0)], "seq long, id string, toxicity_label int, skipped int")
    done = spark.createDataFrame([("e",), (None,), ("e",)], "id string")
    assert [r.seq for r in membership.pending(rows, done, "id", "toxicity_label", "skipped").orderBy("seq").collect()] == [1, 5]
    assert membership.pending_counts(rows, done, "id", "toxicity_label", "skipped").first()[:] == (6, 2)
    assert membership.pending(rows, done, "id", "no_such_column").count() == 5
    log = spark.createDataFrame([("a", "x")], "id string, dataset string")
    assert {r.seq for r in membership.unseen(rows, log, "id", "seq", {"dataset": "x"}).collect()} == {2, 3, 4, 5, 6}
    assert {r.seq for r in membership.unseen(rows, log, "id", "seq", {"dataset": "y"}, limit=2).collect()} == {1, 2}
    flagged = membership.with_skip_flag(rows, spark.createDataFrame([("a",)], "id string"), "id", "skipped")
    assert {r.seq for r in flagged.where("skipped = 1").collect()} == {1, 4} and flagged.columns == rows.columns
    assert "flag" in membership.with_skip_flag(rows, done, "id", "flag").columns
    new = membership.new_log_rows(rows.select("id", F.lit("t").alias("target")), spark.createDataFrame([("a", "t")], "id string, target string"), ["id", "target"])
    assert {r.id for r in new.collect()} == {"b", "c", "d", None, "e"}


def test_running_total(spark):
    rng = random.Random(2)
    values = [(i * 7 % 1000, rng.randrange(5)) for i in range(1000)]
    df = spark.createDataFrame(values, "k long, v long")
    want, total = {}, 0
    for k, v in sorted(values):
        want[k], total = total, total + v
    assert {r.k: r.before for r in export.running_total(df, "k", "v", materialise).collect()} == want
    assert export.running_total(df.limit(0), "k", "v", materialise).count() == 0


def test_parts_have_no_gaps_and_keep_batches(spark):
    rows = [(i, f"id{i}", "x" * (i % 40), 0, 0.0, *[PAYLOAD[f] for f in L.FIELDS]) for i in range(97)]
    kinds = ", ".join(f"{f} {'string' if f in L.WORDS else 'double'}" for f in L.FIELDS)
    df = spark.createDataFrame(rows, f"seq long, id string, text string, toxicity_label long, toxicity_score double, {kinds}")
    size = {r.seq: r.b for r in df.select("seq", export.row_bytes(df).alias("b")).collect()}
    for batch, most in ((1, 1), (4, 500), (10, 10**9)):
        part = {r.seq: r.part for r in export.part_numbers(df, "seq", batch, most, materialise).collect()}
        numbers = [part[i] for i in range(97)]
        assert numbers == sorted(numbers) and set(numbers) == set(range(max(numbers) + 1))
        assert all(len({part[j] for j in range(i, min(97, i + batch))}) == 1 for i in range(0, 97, batch))
        bound = most + max(sum(size[j] for j in range(i, min(97, i + batch))) for i in range(0, 97, batch))
        assert all(sum(size[i] for i in range(97) if part[i] == p) <= bound for p in set(numbers))
