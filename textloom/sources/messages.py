"""Raw messages: which text, which source id, which hash; and small local configuration."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T


def resolve_source(rows: DataFrame, order: str, field: str = "url") -> Column:
    """The first usable of field, url, message_url, permalink and id as text, else ``url:`` and the row's place.

    Empty strings, nulls and numeric zeros are unusable. Columns that aren't there are passed over.
    """
    kinds = dict(rows.dtypes)
    usable = []
    for name in dict.fromkeys((field, "url", "message_url", "permalink", "id")):
        if name in kinds:
            value = F.col(name)
            usable.append(F.when(value.cast("string") != "", value.cast("string")) if kinds[name] in ("string",) else F.when(value != 0, value.cast("string")))
    return F.coalesce(*usable, F.concat(F.lit("url:"), F.col(order).cast("string")))


def resolved(rows: DataFrame, order: str, text_field: str = "text", source_field: str = "url") -> DataFrame:
    """``rows`` with raw_text (first filled of the text columns), source_id, parent_digest and row_hash."""
    texts = [c for c in dict.fromkeys((text_field, "text", "message")) if c in rows.columns]
    out = rows.withColumn("raw_text", T.first_filled(*texts) if texts else F.lit("")).withColumn("source_id", resolve_source(rows, order, source_field))
    return out.withColumn("parent_digest", T.source_digest("source_id")).withColumn("row_hash", T.row_hash("source_id", "raw_text"))


def read_any(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A dataset by the ending of its path: .json/.jsonl, .csv, .orc, .txt, else Parquet."""
    reader = spark.read.schema(schema) if schema else spark.read
    ending = os.path.splitext(path.rstrip("/"))[1].lower()
    if ending in (".json", ".jsonl"):
        return reader.json(path)
    if ending == ".csv":
        return reader.csv(path, header=True, multiLine=True, escape='"')
    if ending == ".orc":
        return reader.orc(path)
    return spark.read.text(path) if ending == ".txt" else reader.parquet(path)


def load_names(path: str) -> list[str]:
    """Stand-in names: a JSON array of strings."""
    names = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(names, list) or not all(isinstance(n, str) for n in names):
        raise ValueError("names must be a JSON array of strings")
    return names


def clean_accounts(config) -> dict[str, list[str]]:
    """Keys by account from a parsed mapping (account to key or keys) or list (account_1, account_2, ... by position); blanks are left out."""
    if not config:
        raise ValueError("the key file is empty")
    if isinstance(config, dict):
        entries = [(str(k), v) for k, v in config.items()]
    elif isinstance(config, list):
        entries = [(f"account_{i}", v) for i, v in enumerate(config, 1)]
    else:
        raise ValueError("the key file must hold a list or a mapping")
    out = {}
    for name, value in entries:
        keys = [str(k).strip() for k in (value if isinstance(value, list) else [value]) if k and str(k).strip()]
        if keys:
            out[name] = keys
    if not out:
        raise ValueError("the key file has no usable keys")
    return out


def load_accounts(path: str) -> dict[str, list[str]]:
    """:func:`clean_accounts` of a JSON file, or of a YAML file where a YAML reader is installed."""
    content = Path(path).read_text(encoding="utf-8")
    try:
        return clean_accounts(json.loads(content))
    except json.JSONDecodeError:
        try:
            import yaml
        except ImportError as missing:
            raise ValueError("the key file isn't JSON, and no YAML reader is installed") from missing
        return clean_accounts(yaml.safe_load(content))


def all_keys(accounts: dict[str, list[str]]) -> list[str]:
    return [k for keys in accounts.values() for k in keys]


def load_expired(path: str) -> set[str]:
    """Expired keys: a JSON list, else one key a line; none if there is no file."""
    if not os.path.exists(path):
        return set()
    content = Path(path).read_text(encoding="utf-8")
    try:
        found = json.loads(content)
        return {str(k) for k in found} if isinstance(found, list) else set()
    except json.JSONDecodeError:
        return {line.strip() for line in content.splitlines() if line.strip()}


def save_expired(path: str, keys: set[str]) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(sorted(keys), indent=2), encoding="utf-8")


def revision_marker(markers: str, dataset: str, split: str) -> Path:
    """The file that keeps the revision of a dataset and split that was read last."""
    name = "__".join(re.sub(r"[^\w]|_", "_", part) for part in (dataset, split))
    return Path(markers) / f"{name}.revision"


def check_revision(dataset: str, split: str, markers: str, remote: Callable[[str], str | None] | None = None) -> tuple[bool, str]:
    """Whether a dataset is to be fetched anew, and its revision: what ``remote`` says, else the one kept, else ``local``.

    A local path has no remote revision; a ``remote`` that fails has none either. The marker is only
    written where the remote revision is known.
    """
    latest = None
    if remote is not None and not os.path.exists(dataset):
        try:
            latest = remote(dataset)
        except Exception:
            latest = None
    marker = revision_marker(markers, dataset, split)
    kept = marker.read_text(encoding="utf-8").strip() if marker.exists() else None
    if latest:
        marker.parent.mkdir(parents=True, exist_ok=True)
        marker.write_text(latest, encoding="utf-8")
    return bool(latest) and latest != kept, latest or kept or "local"
