"""Classifiers, the rules of the request scheduler, and the scheduler itself."""

import pytest
from pyspark.sql import functions as F

from textloom.functions.labels import NUMBERS, checked_labels, read_response
from textloom.operators import scoring as S
from textloom.plans.shared import materialise
from textloom.sources import messages as M


def test_rules():
    assert S.spread_pause(0, 0.2) == 0 and S.spread_pause(60, 0.1, lambda a, b: b) == pytest.approx(66) and S.spread_pause(60, 0.1, lambda a, b: a) == pytest.approx(54)
    assert S.spread_pause(60, 0) == 60
    assert S.grown(64, 512) == 77 and S.grown(500, 512) == 512 and S.shrunk(64) == 48 and S.shrunk(2) == 1 and S.shrunk(1) == 1
    assert S.missing_work(list("abcd"), 4, 4) == ([["a", "b"], ["c", "d"]], []) and S.missing_work(["a"], 4, 4) == ([["a"]], []) and S.missing_work(["a"], 1, 1) == ([], ["a"])
    assert S.batch_prompt(" p ", [{"id": 1, "text": None}]).startswith('p\n{\n  "task"')
    assert S.status_of(Exception("429 RESOURCE_EXHAUSTED")) == "cooldown" and S.status_of(Exception("model is overloaded")) == "overloaded" and S.status_of(TimeoutError("x")) == "timeout"


class Clock:
    now = 0.0

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.now += max(seconds, 0.01)


def scheduler(call, keys=("key1", "key2"), **options):
    clock = Clock()
    return S.Scheduler({"acc": list(keys)}, call, clock=clock, sleep=clock.sleep, **options)


ROWS = [{"id": f"r{i}", "text": f"text {i}"} for i in range(1, 5)]


def test_missing_rows_are_asked_again():
    asked = []

    def call(key, rows):
        asked.append([r["id"] for r in rows])
        return {r["id"]: {} for r in rows if len(asked) > 1 or r["id"] in ("r1", "r2")}

    out = scheduler(call, batch=4).run(ROWS)
    assert asked[0] == ["r1", "r2", "r3", "r4"] and asked[1] == ["r3", "r4"]
    assert len(out.labels) == 4 and not out.skipped and out.remaining == 0 and out.stats["rows_ok"] == 4


def test_quota_expires_a_key():
    used = []

    def call(key, rows):
        used.append(key)
        if key == "key1":
            raise RuntimeError("RESOURCE_EXHAUSTED")
        return {r["id"]: {} for r in rows}

    out = scheduler(call, batch=1).run(ROWS[:1])
    assert used[:2] == ["key1", "key2"] and out.expired == {"key1"} and len(out.labels) == 1 and out.stats["cooldown"] == 1


def test_rows_that_never_work_are_given_up():
    def call(key, rows):
        if any(r["id"] == "r3" for r in rows):
            raise ValueError("not JSON")
        return {r["id"]: {} for r in rows}

    out = scheduler(call, batch=4).run(ROWS)
    assert set(out.labels) == {"r1", "r2", "r4"} and set(out.skipped) == {"r3"}
    tired = scheduler(lambda k, r: (_ for _ in ()).throw(RuntimeError("503 overloaded")), batch=4).run(ROWS)
    assert len(tired.skipped) == 4 and tired.stats["overloaded"] == S.MAX_ATTEMPTS + 1


def test_without_keys_rows_remain():
    out = scheduler(lambda k, r: (_ for _ in ()).throw(RuntimeError("quota")), keys=("k",), batch=2).run(ROWS)
    assert out.remaining == 4 and out.expired == {"k"} and not out.labels
    with pytest.raises(ValueError):
        S.Scheduler({"a": ["k"]}, None, expired={"k"})


def _service():
    return lambda key, rows: {r["id"]: {"n": len(r["text"])} for r in rows if r["id"] != "r2"}


def test_scoring_in_spark(spark):
    df = spark.createDataFrame(ROWS)
    scored = S.score_with_service(df, {"a": ["k"], "b": ["k"]}, _service, materialise, batch=1, pause=False)
    stats, expired = S.account_reports(scored)
    assert stats["rows_ok"] == 3 and stats["rows_skipped"] == 1 and stats["requests"] >= 4 and not expired
    got = {r.id: r.status for r in scored.where("status <> 'account'").collect()}
    assert got == {"r1": "ok", "r2": "skipped", "r3": "ok", "r4": "ok"}
    assert S.score_with_service(df.limit(0), {"a": ["k"]}, _service, materialise, pause=False).count() == 0


def _model():
    return lambda texts: [("LABEL_1" if "bad" in t else "LABEL_0", None if t == "" else 0.9) for t in texts]


def _odd_model():
    return lambda texts: [("toxic", 1.0) for _ in texts]


def test_classifier(spark):
    df = spark.createDataFrame([(1, "bad"), (2, "ok"), (3, None)], "seq long, text string")
    got = S.classify(df, "text", _model)
    assert {(r.seq, r.toxicity_label, r.toxicity_score) for r in got.collect()} == {(1, 1, 0.9), (2, 0, 0.9), (3, 0, 0.0)}
    assert {r.seq for r in S.drop_toxic(got, 0.5).collect()} == {3} and {r.seq for r in S.drop_toxic(got, 0.5, "toxic_score").collect()} == {2, 3}
    assert S.drop_toxic(got, None).count() == 3
    odd = spark.createDataFrame([(1, float("nan")), (1, None)], "toxicity_label int, toxicity_score double")
    assert S.drop_toxic(odd, 0.1).count() == 2
    with pytest.raises(Exception, match="unexpected label"):
        S.classify(df, "text", _odd_model).collect()
    with pytest.raises(ValueError):
        S.drop_toxic(df, 0.5, "other")


def test_accounts(tmp_path):
    assert M.clean_accounts({"a": ["k1", "k2"], "b": "k3", "c": [" ", "k4"]}) == {"a": ["k1", "k2"], "b": ["k3"], "c": ["k4"]}
    assert M.clean_accounts(["k1", "k2", "  "]) == {"account_1": ["k1"], "account_2": ["k2"]}
    assert M.all_keys({"a": ["k1"], "b": ["k2", "k3"]}) == ["k1", "k2", "k3"]
    for bad in (None, [], {}, "x", [" "], {"a": None}):
        with pytest.raises(ValueError):
            M.clean_accounts(bad)
    path = tmp_path / "keys" / "expired.json"
    assert M.load_expired(str(path)) == set()
    M.save_expired(str(path), {"b", "a"})
    assert M.load_expired(str(path)) == {"a", "b"}
    path.write_text("x\n\ny\n")
    assert M.load_expired(str(path)) == {"x", "y"}
    (tmp_path / "k.json").write_text('["k"]')
    assert M.load_accounts(str(tmp_path / "k.json")) == {"account_1": ["k"]}
    with pytest.raises(FileNotFoundError):
        M.load_accounts(str(tmp_path / "none"))


def test_sources(spark):
    rows = [(1, "", None, "x", None, 5), (2, None, "m", "", "y", 0), (3, None, "", None, None, 0), (4, "u", "m", "t", "y", 7)]
    df = spark.createDataFrame(rows, "seq long, url string, message_url string, text string, message string, id long").withColumn("raw_text", F.lit("clash"))
    got = {r.seq: (r.source_id, r.raw_text) for r in M.resolved(df, "seq").collect()}
    assert got == {1: ("5", "x"), 2: ("m", "y"), 3: ("url:3", ""), 4: ("u", "t")}


def test_readers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k long, t string")
    for ending, write in (("parquet", df.write.parquet), ("json", df.write.json), ("orc", df.write.orc)):
        write(str(tmp_path / f"x.{ending}"))
        assert {tuple(r) for r in M.read_any(spark, str(tmp_path / f"x.{ending}")).select("k", "t").collect()} == {(1, "a"), (2, None)}
    df.write.csv(str(tmp_path / "x.csv"), header=True)
    assert M.read_any(spark, str(tmp_path / "x.csv")).count() == 2
    (tmp_path / "names.json").write_text('["A"]')
    assert M.load_names(str(tmp_path / "names.json")) == ["A"]


def _whole(text):
    labels = {"main_language": "Tatar", "error_density": "low", "main_error_type": "spelling"} | {n: "0.5" for n in NUMBERS}
    return {"id": text, "labels": labels}


def test_responses():
    import json

    good = json.dumps([_whole("a"), _whole("b")])
    read = read_response(f"```json\n{good}\n```")
    assert set(read) == {"a", "b"} and read["a"]["main_language"] == "tatar" and read["a"]["noise_score"] == 0.5
    assert read_response(f"Here it is: {good} Enjoy") == read and read_response(good, False)["a"]["main_language"] == "Tatar"
    with pytest.raises(ValueError, match="noise_score"):
        checked_labels(_whole("a")["labels"] | {"noise_score": "much"})
    with pytest.raises(ValueError, match="main_language"):
        checked_labels(_whole("a")["labels"] | {"main_language": "klingon"})
    assert checked_labels(_whole("a")["labels"] | {"main_language": "klingon"}, False)["main_language"] == "klingon"
    for bad in ("", "no JSON", "[1]", '{"id": 1}', '[{"id": "a"}]'):
        with pytest.raises(ValueError):
            read_response(bad)


def _model_that_says():
    import json

    def send(key, prompt, settings):
        assert settings["temperature"] == 0.1 and settings["response_schema"]["type"] == "array"
        items = json.loads(prompt.split("\n", prompt.split("{")[0].count("\n"))[-1])["items"]
        return "```json\n" + json.dumps([_whole(i["id"]) for i in items]) + "\n```", {"prompt_tokens": len(prompt), "total_tokens": None}

    return send


def _slow_model():
    import time

    return lambda key, prompt, settings: time.sleep(2) or "[]"


def test_a_model_is_a_service(spark):
    call = S.model_service(_model_that_says)()
    labels, used = call("k", ROWS)
    assert set(labels) == {"r1", "r2", "r3", "r4"} and used["prompt_tokens"] > 100
    with pytest.raises(TimeoutError):
        S.model_service(_slow_model, timeout=0.1)()("k", ROWS)
    stats, _ = S.account_reports(S.score_with_service(spark.createDataFrame(ROWS), {"a": ["k"]}, S.model_service(_model_that_says), materialise, batch=2, pause=False, check=checked_labels))
    assert stats["rows_ok"] == 4 and stats["prompt_tokens"] > 200 and stats["total_tokens"] == 0


def _failing_first_key():
    def call(key, rows):
        if key == "spent":
            raise RuntimeError("429 quota")
        return {r["id"]: {"n": 1} for r in rows}

    return call


def test_waves(spark):
    """Each wave is committed by itself; rows of an account without keys go to the others; spent keys come back."""
    rows = spark.createDataFrame([{"id": f"r{i}", "text": "t"} for i in range(40)])
    waves = []
    stats, expired = S.label_in_waves(rows, {"a": ["spent"], "b": ["good"]}, _failing_first_key, materialise, lambda s: waves.append({r.id for r in s.where("status = 'ok'").collect()}), batch=2, max_batch=4, wave_batches=1, pause=False)
    assert len(waves) >= 5 and sum(map(len, waves)) == len(set().union(*waves)) == 40
    assert expired == {"spent"} and stats["rows_ok"] == 40 and stats["rows_remaining"] == 0 and stats["waves"] == len(waves)
    stats, expired = S.label_in_waves(rows, {"a": ["spent"]}, _failing_first_key, materialise, lambda s: None, pause=False)
    assert stats["rows_remaining"] == 40 and expired == {"spent"}
    assert S.label_in_waves(rows.limit(0), {"a": ["spent"]}, _failing_first_key, materialise, lambda s: None, pause=False)[0]["rows_total"] == 0


def test_revisions(tmp_path):
    markers = str(tmp_path / "m")
    assert M.check_revision(str(tmp_path), "train", markers, lambda d: "x") == (False, "local")
    assert M.check_revision("a/b", "train", markers) == (False, "local")
    assert M.check_revision("a/b", "train", markers, lambda d: "r1") == (True, "r1") and M.check_revision("a/b", "train", markers, lambda d: "r1") == (False, "r1")
    assert M.check_revision("a/b", "train", markers, lambda d: 1 / 0) == (False, "r1") and M.check_revision("a/b", "test", markers) == (False, "local")
    assert [p.name for p in (tmp_path / "m").iterdir()] == ["a_b__train.revision"]
