"""The seven steps of a curation run, each from tables of a store to tables of a store."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions.labels import checked_labels
from textloom.operators import dedup, export, firstwins, membership, scoring, segment, selection, sinks
from textloom.plans.shared import materialise, scratch
from textloom.plans.store import Store
from textloom.profile import DEFAULT, Profile
from textloom.sources import messages


def step(method):
    """A step that removes its intermediate tables at its end, and writes its counters where ``report`` names a file."""

    @functools.wraps(method)
    def run(self, *args, report: str | None = None, **options):
        with scratch(self.store.spark):
            out = method(self, *args, **options)
        if report is not None:
            sinks.write_report(self.store.spark.range(0), report, out if isinstance(out, dict) else {"path": out})
        return out

    return run


class CurationPipeline:
    """ingest, dedup, toxicity, label, export_parquet, export_labelled and prepare_import.

    Each step only handles rows that its output doesn't have yet, appends, and returns its
    counters; running a step again changes nothing. Every step takes ``report``, a path for its counters as JSON.
    """

    def __init__(self, store: Store, profile: Profile = DEFAULT, names: list[str] | tuple[str, ...] = ()):
        self.store, self.profile, self.names = store, profile, tuple(names)

    @step
    def ingest(self, rows: DataFrame, order: str, dataset: str, split: str = "train", revision: str = "local", output: str = "clean_segments", text_field: str = "text", source_field: str = "url", limit: int | None = None) -> dict:
        """Clean, segment and filter the messages not yet logged for this dataset and output table."""
        scope = f"{dataset}:{output}"
        found = materialise(membership.unseen(messages.resolved(rows, order, text_field, source_field), self.store.read("ingest_log"), "row_hash", order, {"dataset": scope}, limit), "new")
        processed = materialise(segment.process_messages(found, "source_id", "raw_text", self.names, self.profile, (order,)), "processed")
        kept = processed.where("reason = 'pass'").withColumn("norm_hash", F.sha1(T.normal_form("text"))).withColumn("place", F.struct(F.col(order), "segment_no"))
        stored = self.store.read(output, "clean_segments").select("id", "norm_hash")
        accepted = materialise(firstwins.two_key_first(kept, "place", "id", "norm_hash", materialise, stored), "accepted")
        self._append(output, accepted.select("place", "id", "parent_digest", "text", "norm_hash"), "place")
        self.store.append("ingest_log", found.select("row_hash", F.lit(scope).alias("dataset"), F.lit(split).alias("split"), F.lit(revision).alias("revision"), "source_id", F.current_timestamp().alias("created_at")))
        counts = {r["name"]: r["n"] for r in segment.ingest_counters(processed).collect()}
        # With a limit rows beyond it are neither new nor seen before; they aren't counted.
        seen = {} if limit is not None else {"rows_skipped_seen": rows.count() - found.count()}
        return counts | seen | {"rows_new": found.count(), "segments_inserted": accepted.count()}

    @step
    def dedup(self, source: str = "clean_segments", output: str = "dedup_segments") -> dict:
        """First-come-first-kept deduplication; the SimHash of what is kept is stored with it, so it is never made again."""
        stored = self.store.read(output, "dedup_segments")
        rows = membership.pending(self.store.read(source), self.store.read(output, "dedup_segments").limit(0), "id", "toxicity_label")
        status = materialise(dedup.deduplicate(rows, "seq", "text", "norm_hash", materialise, self.profile, stored if self.store.exists(output) else None, "id"), "status")
        kept = rows.join(status.where("status = 'kept'").select("seq"), "seq", "left_semi").select("seq", "id", "parent_digest", "text", "norm_hash")
        self._append(output, materialise(dedup.with_simhash(kept, "text").drop("n_tokens"), "kept"), "seq")
        counts = {r.status: r.n for r in status.groupBy("status").agg(F.count("*").alias("n")).collect()}
        return counts | {"rows_total": sum(counts.values())} if counts else {}

    @step
    def toxicity(self, load: Callable, source: str = "dedup_segments", output: str = "toxicity_segments", threshold: float | None = None, mode: str = "score") -> dict:
        waiting = membership.pending(self.store.read(source), self.store.read(output, "toxicity_segments"), "id", "toxicity_label")
        scored = materialise(scoring.classify(waiting.select("seq", "id", "parent_digest", "text", "norm_hash"), "text", load), "classified")
        kept = materialise(scoring.drop_toxic(scored, threshold, mode).withColumn("skipped", F.lit(0)), "kept")
        self._append(output, kept, "seq")
        n, m = scored.count(), kept.count()
        return {"rows_total": n, "dropped_threshold": n - m} | {("toxic" if r.toxicity_label else "non_toxic"): r.n for r in kept.groupBy("toxicity_label").agg(F.count("*").alias("n")).collect()}

    @step
    def label(self, accounts: dict[str, list[str]], connect: Callable, source: str = "toxicity_segments", output: str = "llm_segments", max_rows: int | None = None, pause: bool = True, expired_path: str | None = None, validate: bool = True, **options) -> dict:
        """Ask the service for every pending row, wave by wave, each committed before the next.

        Rows given up go to the log of skips, the source stays as it is. Labels are checked before they are
        stored (``validate``); counters go to ``label_metrics`` and are returned, also when all keys are spent. ``expired_path`` names
        the file that keeps expired keys from one run to the next.
        """
        rows = membership.with_skip_flag(self._current(source, "toxicity_segments"), self.store.read("skip_log"), "id", "skipped")
        waiting = membership.pending(rows, self.store.read(output, "llm_segments"), "id", "toxicity_label", "skipped")
        waiting = materialise(waiting.orderBy("seq").limit(max_rows) if max_rows is not None else waiting, "waiting")

        def commit(scored: DataFrame) -> None:
            done = waiting.join(scored.where("status = 'ok'").select("id", "labels_json"), "id").select("seq", "id", "parent_digest", "text", "norm_hash", "toxicity_label", "toxicity_score", "labels_json", F.lit(None).cast("string").alias("labels_error"))
            self._append(output, materialise(done, "labelled"), "seq")
            self.store.append("skip_log", scored.where("status = 'skipped'").select("id", "reason"))
            if expired_path is not None:
                known = messages.load_expired(expired_path)
                spent = scoring.account_reports(scored)[1]
                if spent - known:
                    messages.save_expired(expired_path, known | spent)

        spent = messages.load_expired(expired_path) if expired_path is not None else set()
        stats, spent_now = scoring.label_in_waves(waiting, accounts, connect, materialise, commit, expired=spent, pause=pause, check=checked_labels if validate else None, **options)
        if expired_path is not None and spent_now - spent:
            messages.save_expired(expired_path, spent_now)
        if not stats["rows_total"]:
            return {}
        told = self.store.spark.createDataFrame(sorted(stats.items()), "name string, n bigint").withColumn("made_at", F.current_timestamp())
        self.store.append("label_metrics", told)
        named = {"ok": stats["rows_ok"], "skipped": stats["rows_skipped"], "remaining": stats["rows_remaining"]}
        return {k: n for k, n in named.items() if n} | dict(stats)

    @step
    def export_parquet(self, path: str, source: str = "toxicity_segments", fallback: str = "dedup_segments") -> str:
        return sinks.write_snapshot([self._current(source, "toxicity_segments"), self.store.read(fallback, "dedup_segments")], path)

    @step
    def export_labelled(self, folder: str, source: str = "llm_segments", toxicity: str = "toxicity_segments", max_bytes: int = 512 << 20, batch_rows: int = 2000, limit: int | None = None, overwrite: bool = False) -> dict:
        """The labelled export; a limit counts rows before unreadable payloads are left out."""
        flagged = membership.with_skip_flag(self._current(toxicity, "toxicity_segments"), self.store.read("skip_log"), "id", "skipped")
        rows = export.exportable(self._current(source, "llm_segments"), flagged, "labels_json", "skipped")
        rows = materialise(rows.orderBy("seq").limit(limit) if limit is not None else rows, "exportable")
        flat = materialise(export.flattened(rows), "flat")
        report = {"source_table": source, "toxicity_table": toxicity, "rows_skipped_invalid_json": rows.count() - flat.count()}
        return sinks.write_parts(flat, folder, materialise, max_bytes, batch_rows, overwrite, report)

    @step
    def prepare_import(self, path: str, source: str = "llm_segments", limit: int | None = None, share: float = 0.15, keep_proportions: bool = True, dry_run: bool = False, seed: int = 0, target: str = "prepare_import", lines: bool = False) -> dict:
        """Choose a batch for annotation and write it as one JSON array, or, with ``lines``, in parallel as JSON lines."""
        rows = selection.source_rows(self._current(source, "llm_segments"), "labels_json", "toxicity_label", "skipped")
        found = selection.candidates(rows, "id", "text", "labels_json", self.store.read("export_log"), target)
        chosen = materialise(selection.select(found, materialise, limit, share, keep_proportions), "chosen")
        counts = {r.density: r.n for r in chosen.groupBy("density").agg(F.count("*").alias("n")).collect()}
        if not dry_run and counts:
            (sinks.write_json_lines if lines else sinks.write_json_array)(selection.shuffled(chosen, "id", seed), path)
            ids = membership.new_log_rows(chosen.select("id", F.lit(target).alias("target")), self.store.read("export_log"), ["id", "target"])
            self.store.append("export_log", materialise(ids.withColumn("exported_at", F.current_timestamp()), "log"))
        return counts

    def _current(self, table: str, like: str) -> DataFrame:
        """A table of scored rows as insert-or-replace on id and norm_hash leaves it; the files only grow."""
        return firstwins.replace_last(self.store.read(table, like), "seq", "id", "norm_hash")

    def _append(self, table: str, rows: DataFrame, order: str) -> None:
        """Append rows numbered on from the table's last seq, in order; numbers come from running totals, not from one task."""
        like = rows.withColumn("one", F.lit(1).cast("bigint"))
        placed = export.running_total(like.select(order, "one"), order, "one", materialise).select(order, (F.col("before") + self.store.next_seq(table)).alias("seq_"))
        self.store.append(table, rows.join(placed, order).select(F.col("seq_").alias("seq"), *(c for c in rows.columns if c not in ("seq", order))))
