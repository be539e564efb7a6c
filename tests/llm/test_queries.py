"""Every query of the training-data operators over small tables, and over empty ones."""

import pytest
from pyspark.sql import functions as F

from textloom.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"
TABLES = ("clean_segments", "dedup_segments", "documents", "eval_items", "incoming_segments", "ingest_log", "label_payload", "level_samples", "llm_segments", "raw_messages", "toxicity_reviews", "toxicity_segments")
#: The result of these has the columns that are fixed for it.
FOUND = {
    "p1_found": {"id": "string"}, "p2_found": {"seq_a": "bigint", "seq_b": "bigint"}, "p3_found": {"seq": "bigint"}, "p4_found": {"kind": "string", "item_key": "string", "language": "string"},
    "p5_found": {"seq": "bigint"}, "p6_found": {"seq_a": "bigint", "seq_b": "bigint"}, "p7_ids": {"doc_id": "bigint", "ids": "array<int>"}, "p8_found": {"doc_id": "bigint", "item_id": "bigint"}, "p9_found": {"doc_id": "bigint"},
}


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for t in TABLES:
        spark.read.parquet(f"{SMALL}/{t}.parquet").limit(0).write.parquet(f"{folder}/{t}.parquet")
    return f"file://{folder}"


@pytest.fixture(scope="module")
def dirty(spark, tmp_path_factory):
    """Small tables with a row of nulls alone, twice, and with further columns named like those the operators make."""
    folder = tmp_path_factory.mktemp("dirty")
    for t in TABLES:
        df = spark.read.parquet(f"{SMALL}/{t}.parquet")
        nulls = spark.createDataFrame([(None,) * len(df.columns)] * 2, df.schema)
        df = df.unionByName(nulls)
        for clash in ("key", "form", "words", "class", "place", "language", "level_score", "ids", "toxicity", "piece", "bucket", "n", "k0", "a", "b"):
            if clash not in df.columns:
                df = df.withColumn(clash, F.lit("clash"))
        df.coalesce(1).write.parquet(f"{folder}/{t}.parquet")
    return f"file://{folder}"


@pytest.mark.parametrize("name", QUERIES)
def test_nulls_and_clashes(spark, dirty, name):
    """Rows of nulls add nothing to what is found, and further columns change nothing."""
    got = [tuple(r) for r in QUERIES[name](spark, dirty).collect()]
    assert got
    if name in FOUND and name != "p7_ids":
        plain = {tuple(r) for r in QUERIES[name](spark, SMALL).collect()}
        assert {r for r in got if None not in r} == plain and all(None not in r for r in got)


@pytest.mark.parametrize("name", QUERIES)
def test_small_and_empty(spark, empty, name):
    got = QUERIES[name](spark, SMALL)
    if name in FOUND:
        assert dict(got.dtypes) == FOUND[name]
    rows = got.collect()
    assert rows
    if name in FOUND and name != "p7_ids":
        assert len(rows) == len(set(map(tuple, rows)))
    none = QUERIES[name](spark, empty)
    assert none.dtypes == got.dtypes and none.count() == 0


@pytest.mark.parametrize("name", SQL)
def test_sql(spark, name):
    import duckdb

    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = QUERIES[name](spark, SMALL)
    want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
