"""The seven steps end to end, again without effect, and as a stream."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from textloom.operators import sinks
from textloom.pipeline import CurationPipeline
from textloom.plans.shared import materialise, shared_dir, spread
from textloom.plans.store import Store
from textloom.sources.tables import read_table, valid_identifier
from textloom.streaming.ingest import stream_ingest, windowed_rates

SMALL = "/root/testdata/sf0.001"


def _model():
    return lambda texts: [("LABEL_1" if len(t) % 7 == 0 else "LABEL_0", 0.8) for t in texts]


def _service():
    import hashlib

    def labels(t):
        h = int(hashlib.sha1(t.encode()).hexdigest(), 16)
        return {
            "main_language": "tatar", "tatar_prob": 0.9, "russian_share": 0.1, "error_share": 0.2, "error_density": ("low", "medium", "high")[h % 3], "main_error_type": "spelling",
            "non_fluent_prob": 0.2, "meaning_clarity": 0.9, "noise_score": 0.1, "overall_gec_usefulness": h % 100 / 100,
        }

    return lambda key, rows: {r["id"]: labels(r["text"]) for r in rows if len(r["text"]) % 11}


def test_run(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    pipe = CurationPipeline(store, names=["Айгөл"])
    raw = read_table(spark, SMALL, "raw_messages")
    first = pipe.ingest(raw, "seq", "wall")
    assert first["rows_total"] == first["rows_new"] and first["segments_generated"] >= first["segments_kept"] >= first["segments_inserted"] and first["rows_new"] + first["rows_skipped_seen"] == raw.count()
    assert first["segments_inserted"] > 100 and first["rows_new"] == raw.select("url", "message_url", "text", "message").distinct().count()
    assert pipe.ingest(raw, "seq", "wall")["segments_inserted"] == 0
    clean = store.read("clean_segments")
    assert clean.select("id").distinct().count() == clean.select("norm_hash").distinct().count() == clean.count() == clean.agg(F.max("seq")).first()[0] + 1
    kept = pipe.dedup()
    assert kept["kept"] == store.read("dedup_segments").count() and kept["rows_total"] == sum(n for k, n in kept.items() if k != "rows_total") == clean.count()
    assert store.read("dedup_segments").where("simhash IS NULL").count() == 0
    assert "kept" not in pipe.dedup()
    counts = pipe.toxicity(_model)
    assert counts["toxic"] + counts["non_toxic"] == kept["kept"] and pipe.toxicity(_model)["rows_total"] == 0
    done = pipe.label({"a": ["k"], "b": ["k"]}, _service, pause=False, max_batch=8, wave_batches=1, expired_path=f"{tmp_path}/expired.json", report=f"file://{tmp_path}/label.json")
    assert json.loads((tmp_path / "label.json").read_text())["rows_ok"] == done["ok"] and done["waves"] > 1 and done["requests"] > 0
    assert {r["name"]: r["n"] for r in store.read("label_metrics").collect()}["rows_ok"] == done["ok"]
    assert done["ok"] + done["skipped"] == counts["non_toxic"] and pipe.label({"a": ["k"]}, _service, pause=False) == {}
    report = pipe.export_labelled(f"file://{tmp_path}/out", max_bytes=1, batch_rows=10)
    files = sorted(p.name for p in (tmp_path / "out").glob("*.parquet"))
    assert report["rows_written"] == done["ok"] and files == [f"train-{i:05d}.parquet" for i in range(-(-done["ok"] // 10))]
    assert json.loads((tmp_path / "out" / "export_report.json").read_text())["file_count"] == len(files)
    assert spark.read.parquet(f"file://{tmp_path}/out/*.parquet").count() == done["ok"]
    with pytest.raises(FileExistsError):
        pipe.export_labelled(f"file://{tmp_path}/out")
    assert pipe.export_labelled(f"file://{tmp_path}/out", overwrite=True)["file_count"] == 1
    assert sorted(p.name for p in (tmp_path / "out").glob("*.parquet")) == ["train-00000.parquet"]
    dry = pipe.prepare_import(f"file://{tmp_path}/a.json", limit=20, dry_run=True)
    assert sum(dry.values()) == 20 and not (tmp_path / "a.json").exists()
    assert pipe.prepare_import(f"file://{tmp_path}/a.json", limit=20) == dry
    pipe.prepare_import(f"file://{tmp_path}/b.json", limit=20)
    a, b = (json.loads((tmp_path / f).read_text()) for f in ("a.json", "b.json"))
    assert len(a) == 20 and not {x["id"] for x in a} & {x["id"] for x in b}
    pipe.export_parquet(f"file://{tmp_path}/snap")
    assert spark.read.parquet(f"file://{tmp_path}/snap").count() == counts["non_toxic"]


def _prompted():
    def send(key, prompt, settings):
        items = json.loads(prompt[prompt.index('{\n  "task"') :])["items"]
        good = _service()("k", items)
        return json.dumps([{"id": i, "labels": x} for i, x in good.items()])

    return send


def test_command_line(spark, tmp_path):
    """The seven steps from the command line, with models named by module and function."""
    from textloom.__main__ import run

    store = ["--store", f"file://{tmp_path}/store"]
    (tmp_path / "keys.json").write_text('{"a": ["k1"], "b": ["k2"]}')
    first = run(spark, ["ingest", *store, "--dataset", f"{SMALL}/raw_messages.parquet", "--report", f"file://{tmp_path}/ingest.json"])
    assert json.loads((tmp_path / "ingest.json").read_text()) == first and first["segments_inserted"] > 100
    assert run(spark, ["dedup", *store, "--distance", "1"])["kept"] > 50
    assert run(spark, ["toxicity", *store, "--model", "test_pipeline:_model"])["rows_total"] > 50
    done = run(spark, ["label", *store, "--model", "test_pipeline:_prompted", "--keys", f"{tmp_path}/keys.json", "--max-rows", "60"])
    assert done["rows_total"] == 60 and done["ok"] + done.get("skipped", 0) == 60
    assert run(spark, ["export-labelled", *store, "--path", f"file://{tmp_path}/out"])["rows_written"] == done["ok"]
    assert run(spark, ["prepare-import", *store, "--path", f"file://{tmp_path}/lines", "--lines"])
    assert run(spark, ["export-parquet", *store, "--path", f"file://{tmp_path}/snap"])["path"].endswith("snap")
    with pytest.raises(SystemExit):
        run(spark, ["label", *store, "--keys", f"{tmp_path}/keys.json"])


def test_empty_run(spark, tmp_path):
    pipe = CurationPipeline(Store(spark, f"file://{tmp_path}/store"))
    raw = read_table(spark, SMALL, "raw_messages").limit(0)
    assert pipe.ingest(raw, "seq", "wall")["segments_inserted"] == 0 and pipe.dedup() == {}
    assert pipe.prepare_import(f"file://{tmp_path}/a.json") == {}
    with pytest.raises(ValueError):
        pipe.export_parquet(f"file://{tmp_path}/snap")
    assert pipe.export_labelled(f"file://{tmp_path}/out")["file_count"] == 0


def test_stream_is_the_batch(spark, tmp_path):
    raw = read_table(spark, SMALL, "raw_messages")
    source = tmp_path / "in"
    for part in (0, 1):
        raw.where(F.col("seq") % 2 == part).coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    one, two = Store(spark, f"file://{tmp_path}/one"), Store(spark, f"file://{tmp_path}/two")
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://")) / "textloom"
    before = set(shared.glob("*"))
    stream_ingest(stream, CurationPipeline(one), "seq", "wall", f"file://{tmp_path}/check").awaitTermination()
    # A micro-batch leaves no intermediate tables behind.
    assert set(shared.glob("*")) <= before
    CurationPipeline(two).ingest(raw, "seq", "wall")
    hashes = [{r.norm_hash for r in s.read("clean_segments").select("norm_hash").collect()} for s in (one, two)]
    assert hashes[0] == hashes[1] and one.read("ingest_log").count() == two.read("ingest_log").count()


def test_windowed_rates(spark):
    rows = [("2025-03-01 10:05:00", "a", True), ("2025-03-01 10:50:00", "a", False), ("2025-03-01 11:00:00", None, True)]
    df = spark.createDataFrame(rows, "t string, source string, bad boolean").withColumn("t", F.to_timestamp("t"))
    got = {(str(r.window_start), r.source): (r.n, r.n_flagged) for r in windowed_rates(df, "t", "source", "bad").collect()}
    assert got == {("2025-03-01 10:00:00", "a"): (2, 1), ("2025-03-01 11:00:00", None): (1, 1)}


def test_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(9).coalesce(1)).rdd.getNumPartitions() == cores and spread(spark.range(9).coalesce(1)).count() == 9
    whole = spark.range(9).repartition(cores)
    assert spread(whole) is whole


def test_shared_folder_is_asked_for(spark):
    """On a cluster there is no folder but the one that is set."""

    class Cluster:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        conf, sparkContext = {}, Cluster()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_identifiers():
    assert valid_identifier("a_1") == "a_1"
    for bad in ("", "1a", "a-b", "a\n", "a b"):
        with pytest.raises(ValueError):
            valid_identifier(bad)


def test_sinks(spark, tmp_path):
    none, some = spark.createDataFrame([], "id string, text string"), spark.createDataFrame([("a", "т")], "id string, text string")
    sinks.write_snapshot([none, some], f"file://{tmp_path}/s")
    assert spark.read.parquet(f"file://{tmp_path}/s").count() == 1
    assert sinks.write_json_array(none, f"file://{tmp_path}/e.json") == 0 and (tmp_path / "e.json").read_text() == "[]"
    assert sinks.write_json_array(some, f"file://{tmp_path}/o.json") == 1 and json.loads((tmp_path / "o.json").read_text()) == [{"id": "a", "text": "т"}]
    sinks.write_report(some, f"file://{tmp_path}/r/report.json", {"y": 1, "x": 2})
    assert json.loads((tmp_path / "r" / "report.json").read_text()) == {"x": 2, "y": 1}
    assert sinks.write_json_lines(some, f"file://{tmp_path}/lines") == 1
    assert materialise(none, "n").count() == 0


@pytest.mark.parametrize("name", [n for n in entry.queries() if not n.startswith("p")] + ["pending_anti_join", "pending_counts", "part_assignment"])
def test_queries_match_their_sql(spark, name):
    import duckdb

    got = entry.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in got.select(sorted(got.columns)).collect()]
    if name in entry.oracle_sql():
        db = duckdb.connect()
        for t in ("raw_messages", "ingest_log", "clean_segments", "dedup_segments", "toxicity_segments", "llm_segments", "toxicity_reviews"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
        want = db.execute(f"SELECT {', '.join(sorted(got.columns))} FROM ({entry.oracle_sql()[name]})").fetchall()

        def plain(rows):
            return sorted(tuple("null" if v is None else "NaN" if v != v else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)

        assert plain(rows) == plain(want)
    assert rows or name in ("selection_free_fill",)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
