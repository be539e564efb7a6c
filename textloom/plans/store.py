"""A folder of Parquet tables that only ever grow by appending whole batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.sources.tables import valid_identifier

SEGMENT = "seq bigint, id string, parent_digest string, text string, norm_hash string"
SCHEMAS = {
    "clean_segments": SEGMENT,
    "dedup_segments": f"{SEGMENT}, simhash bigint",
    "toxicity_segments": f"{SEGMENT}, toxicity_label int, toxicity_score double, skipped int",
    "llm_segments": f"{SEGMENT}, toxicity_label int, toxicity_score double, labels_json string, labels_error string",
    "ingest_log": "row_hash string, dataset string, split string, revision string, source_id string, created_at timestamp",
    "export_log": "id string, target string, exported_at timestamp",
    "skip_log": "id string, reason string",
    "label_metrics": "name string, n bigint, made_at timestamp",
}


class Store:
    """Tables by name under one folder; a table without files is empty with its known schema."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{valid_identifier(table)}"

    def exists(self, table: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return fs.exists(at) and len(fs.listStatus(at)) > 0

    def schema(self, table: str, like: str | None = None) -> T.StructType:
        return T.StructType.fromDDL(SCHEMAS[like or table])

    def read(self, table: str, like: str | None = None) -> DataFrame:
        """The table, with columns that older files lack filled with nulls."""
        if self.exists(table):
            return self.spark.read.option("mergeSchema", "true").parquet(self.path(table))
        return self.spark.createDataFrame([], self.schema(table, like))

    def append(self, table: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path(table))

    def next_seq(self, table: str) -> int:
        """One more than the greatest seq; min and max come from the files' statistics."""
        top = self.read(table).agg(F.max("seq")).first()[0] if self.exists(table) else None
        return 0 if top is None else top + 1
