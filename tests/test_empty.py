"""Every query of the catalogue over empty tables."""

import pytest
from pyspark.sql import functions as F

from textloom.plans.catalogue import QUERIES

SMALL = "/root/testdata/sf0.001"
TABLES = ("clean_segments", "dedup_segments", "ingest_log", "llm_segments", "raw_messages", "toxicity_reviews", "toxicity_segments")


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for t in TABLES:
        spark.read.parquet(f"{SMALL}/{t}.parquet").limit(0).write.parquet(f"{folder}/{t}.parquet")
    return f"file://{folder}"


@pytest.mark.parametrize("name", QUERIES)
def test_empty(spark, empty, name):
    rows = QUERIES[name](spark, empty).collect()
    assert [r[:] for r in rows] == ([(0, 0)] if name == "pending_counts" else [])


@pytest.fixture(scope="module")
def dirty(spark, tmp_path_factory):
    """Small tables with two rows of nulls alone, and with further columns named like those the operators make."""
    folder = tmp_path_factory.mktemp("dirty")
    for t in TABLES:
        df = spark.read.parquet(f"{SMALL}/{t}.parquet")
        df = df.unionByName(spark.createDataFrame([(None,) * len(df.columns)] * 2, df.schema))
        for clash in ("raw_text", "source_id", "place", "norm", "simhash", "l", "label_t", "batch", "part", "reason", "key", "n_tokens"):
            if clash not in df.columns:
                df = df.withColumn(clash, F.lit("clash"))
        df.coalesce(1).write.parquet(f"{folder}/{t}.parquet")
    return f"file://{folder}"


#: Counts and numbered batches change with two further rows; the others keep every row they had.
COUNTED = {"filter_reason_histogram", "message_reasons", "dedup_status_counts", "pending_counts", "batch_prompts", "part_assignment"}


@pytest.mark.parametrize("name", QUERIES)
def test_nulls_and_clashes(spark, dirty, name):
    got = {str(r[:]) for r in QUERIES[name](spark, dirty).collect()}
    if name not in COUNTED:
        assert {str(r[:]) for r in QUERIES[name](spark, SMALL).collect()} <= got
