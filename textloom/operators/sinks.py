"""Writing results: snapshots, numbered files of bounded size, JSON arrays, reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.export import COLUMNS, part_numbers


def _fs(df: DataFrame, path: str):
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at, spark._jvm.org.apache.hadoop.fs.Path


def write_snapshot(tables: list[DataFrame], path: str, label: str = "toxicity_label") -> str:
    """id and text of the first table that has rows, as Parquet; rows labelled 1 or null are left out where there is a label. ValueError if none has rows."""
    for table in tables:
        if not table.isEmpty():
            rows = table.where(F.col(label) != 1) if label in table.columns else table
            rows.select("id", "text").write.mode("overwrite").parquet(path)
            return path
    raise ValueError("there is nothing to export")


def write_parts(rows: DataFrame, folder: str, materialise, max_bytes: int = 512 << 20, batch_rows: int = 2000, overwrite: bool = False, report: dict | None = None) -> dict:
    """Rows (seq and the export columns) as train-00000.parquet, ... in order of seq, zstd; and a report.

    Refuses a folder that holds Parquet files unless ``overwrite``, which removes them and
    the report. No rows give no files. The files of a part are written by one task; a part
    is bounded by ``max_bytes`` and one batch.
    """
    fs, at, Path = _fs(rows, folder)
    old = [s.getPath() for s in (fs.listStatus(at) if fs.exists(at) else []) if s.getPath().getName().endswith(".parquet")]
    if old and not overwrite:
        raise FileExistsError(f"{folder} already holds Parquet files")
    for p in [*old, Path(at, "export_report.json")]:
        fs.delete(p, False)
    made = Path(at, "_parts")
    numbered = rows.join(part_numbers(rows, "seq", batch_rows, max_bytes, materialise), "seq")
    numbered.repartition("part").sortWithinPartitions("part", "seq").select("part", *COLUMNS).write.mode("overwrite").partitionBy("part").option("compression", "zstd").parquet(made.toString())
    there = any(x.isDirectory() for x in fs.listStatus(made))
    written = rows.sparkSession.read.parquet(made.toString()).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n")).collect() if there else []
    # One task names its files alike in several folders.
    counts = {tuple(r.file.rsplit("/", 2)[1:]): r.n for r in written}
    files = []
    for folder_ in sorted((x.getPath() for x in fs.listStatus(made) if x.isDirectory()), key=lambda p: int(p.getName().split("=")[1])):
        for p in sorted((x.getPath() for x in fs.listStatus(folder_) if x.getPath().getName().endswith(".parquet")), key=lambda p: p.getName()):
            to = Path(at, f"train-{len(files):05d}.parquet")
            fs.rename(p, to)
            files.append({"path": to.toString(), "rows": counts[folder_.getName(), p.getName()], "bytes": fs.getFileStatus(to).getLen()})
    fs.delete(made, True)
    said = (report or {}) | {
        "rows_written": sum(counts.values()), "files": files, "file_count": len(files), "total_bytes": sum(f["bytes"] for f in files), "max_file_size_mb": max_bytes / (1 << 20), "compression": "zstd",
    }
    write_text(rows, f"{folder}/export_report.json", json.dumps(said, ensure_ascii=False, indent=2))
    return said


def write_text(df: DataFrame, path: str, content: str) -> None:
    """A small text file on the file system of ``path``, parents made as needed."""
    fs, at, _ = _fs(df, path)
    stream = fs.create(at, True)
    try:
        stream.write(bytearray(content.encode("utf-8")))
    finally:
        stream.close()


def write_json_array(chosen: DataFrame, path: str) -> int:
    """id and text of a chosen batch, in the order it comes in, as one JSON array; streamed through the driver row by row, a partition at a time.

    For a selection too large for one file :func:`write_json_lines` writes in parallel.
    """
    fs, at, _ = _fs(chosen, path)
    stream, n = fs.create(at, True), 0
    try:
        stream.write(bytearray(b"["))
        for r in chosen.select("id", "text").toLocalIterator():
            item = json.dumps({"id": r.id, "text": r.text}, ensure_ascii=False, indent=2).replace("\n", "\n  ")
            stream.write(bytearray(f"{',' if n else ''}\n  {item}".encode()))
            n += 1
        stream.write(bytearray(b"\n]" if n else b"]"))
    finally:
        stream.close()
    return n


def write_json_lines(chosen: DataFrame, folder: str) -> int:
    """id and text of a selection as JSON lines, in parallel, in files whose names are in its order."""
    chosen.select("id", "text").write.mode("overwrite").option("ignoreNullFields", "false").json(folder)
    return chosen.sparkSession.read.schema("id string").json(folder).count()


def write_report(df: DataFrame, path: str, counts: dict) -> None:
    """The counters of a step as a JSON file, by name."""
    write_text(df, path, json.dumps(dict(sorted(counts.items())), ensure_ascii=False, indent=2))
