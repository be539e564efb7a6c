"""Reading the tables of a data folder."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def valid_identifier(name: str) -> str:
    """``name`` if it is a plain identifier, else ValueError (no trailing newline either)."""
    if not name or not _NAME.fullmatch(name):
        raise ValueError(f"not a table name: {name!r}")
    return name


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of ``folder``; columns and filters are pruned by the scan."""
    return spark.read.parquet(f"{folder}/{valid_identifier(name)}.parquet")
