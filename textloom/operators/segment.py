"""Messages into segments: cleaned, made anonymous, packed to size and filtered."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions.privacy import anonymised
from textloom.profile import DEFAULT, Profile

_WORD = T.python_pattern(T.WORD)
_STOP = T.python_pattern(rf"(?<=[.!?…])[{T.WHITE}]+")
_ENDS = T.python_pattern(T.ENDS)
_REGULAR = [(T.python_pattern(p), by) for p, by in T.REGULAR_SPACE]
_CONTACT = T.python_pattern(rf"{T.WORD_START}{T.URL}|{T.EMAIL}|{T.PHONE}", ignore_case=True)
_TELLING = T.python_pattern(rf"[^\p{{P}}\p{{S}}{T.SPACE}]")
_SIGN = T.python_pattern(rf"@|://|www\.|{T.PHONE_SIGN}", ignore_case=True)


def split_by_marks(text: str) -> list[str]:
    """The default sentence splitter: after . ! ? … before white space."""
    return [s for part in _STOP.split(text) if (s := part.strip())]


def count_words(text: str) -> int:
    return len(_WORD.findall(text.lower()))


def word_runs(sentence: str, profile: Profile) -> list[str]:
    """The lower-cased words of a sentence in runs; a run ends with the word at which it reaches either limit.

    Where a run ends is looked up among the running sums of the words' lengths.
    """
    words = _WORD.findall(sentence.lower())
    ends = list(accumulate(len(w) + 1 for w in words))
    out, at = [], 0
    while at < len(words):
        reached = bisect_left(ends, (ends[at - 1] if at else 0) + profile.max_chars + 1, at)
        to = min(reached + 1, at + max(1, profile.max_words))
        out.append(" ".join(words[at:to]))
        at = to
    return out


def pack(text: str, profile: Profile = DEFAULT, splitter: Callable[[str], list[str]] = split_by_marks) -> list[str]:
    """The segments of a text: as many whole sentences each as both limits hold, in order; an oversized sentence in word runs.

    Words never cross the blank that joins two sentences, so words and characters are
    running sums over the sentences, and the furthest end of a segment is found in both by bisection.
    """
    if len(text) <= profile.max_chars and count_words(text) <= profile.max_words:
        return [whole] if (whole := text.strip()) else []
    sentences = splitter(text)
    words = [0, *accumulate(count_words(s) for s in sentences)]
    chars = [0, *accumulate(len(s) + 1 for s in sentences)]
    out, at = [], 0
    while at < len(sentences):
        to = min(bisect_right(words, words[at] + profile.max_words), bisect_right(chars, chars[at] + profile.max_chars + 1)) - 1
        out += [" ".join(sentences[at:to]).strip()] if to > at else word_runs(sentences[at], profile)
        at = max(to, at + 1)
    return [s for s in out if s]


def segments_of(text: Column | str, profile: Profile = DEFAULT, splitter: Callable[[str], list[str]] = split_by_marks) -> Column:
    """The segments of a text as an array. A text within the limits stays in the JVM; null gives null."""
    column = F.col(text) if isinstance(text, str) else text

    @F.pandas_udf("array<string>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda t: None if t is None else pack(t, profile, splitter))

    # Too long by characters is cheap to see; only the others have their words counted.
    fits = (F.length(column) <= profile.max_chars) & (T.count_tokens(column) <= profile.max_words)
    whole = F.filter(F.array(T.strip(column)), lambda s: s != "")
    made = run(F.when(~fits, column))
    return F.when(made.isNotNull(), made).when(column.isNotNull(), whole)


def contact_only(text: str) -> bool:
    """True if nothing but contacts, punctuation, symbols and white space is there; so for an empty text."""
    if not _SIGN.search(text):
        return not _TELLING.search(text)
    return not _TELLING.search(_CONTACT.sub(" ", text))


def regular_space(text: str) -> str:
    for pattern, by in _REGULAR:
        text = pattern.sub(by, text)
    return text


def message_parts(texts: list[str], names: tuple[str, ...], profile: Profile, splitter: Callable[[str], list[str]]) -> list[tuple[str | None, list[str]]]:
    """For each raw text why it is rejected as a whole (or None), and its segments."""
    out: list[tuple[str | None, list[str]]] = [(None, [])] * len(texts)
    clean: dict[int, str] = {}
    for i, raw in enumerate(texts):
        stripped = _ENDS.sub("", raw)
        if not raw:
            out[i] = ("reject_empty", [])
        elif not stripped or stripped in profile.system_messages:
            out[i] = ("reject_system_message", [])
        elif contact_only(stripped):
            out[i] = ("reject_contact_only_raw", [])
        else:
            clean[i] = regular_space(stripped)
    touched = [i for i, t in clean.items() if "[[" in t or _SIGN.search(t)]
    clean.update(zip(touched, anonymised([clean[i] for i in touched], names)))
    for i, text in clean.items():
        out[i] = ("reject_contact_only_clean", []) if contact_only(text) else (None, pack(text, profile, splitter))
    return out


def process_messages(messages: DataFrame, source: str, raw: str, names: list[str] | tuple[str, ...] = (), profile: Profile = DEFAULT, keep: tuple[str, ...] = (), splitter: Callable[[str], list[str]] = split_by_marks) -> DataFrame:
    """One row per message that is rejected and per segment that a message gives.

    Columns: ``keep``, parent_digest, id, segment_no, text, reason. A rejected message
    has null id, segment_no and text, and its reason (reject_empty, reject_system_message,
    also for blank ones, reject_contact_only_raw, reject_contact_only_clean). A segment
    has reason ``pass`` or the first rule it breaks. A null raw text is an empty one; a
    null source has a null digest and id. Segment numbers count rejected segments too.

    Every pattern runs once a text: one Arrow step takes raw texts to segments, and
    the rules for segments follow in the JVM. No shuffle.
    """
    names = tuple(names)
    rows = messages.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), T.source_digest(source).alias("digest"), F.coalesce(raw, F.lit("")).alias("raw"))
    kinds = [f"k{i} {messages.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    last = len(keep) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, numbers, texts, early = [], [], [], []
            for i, (reason, parts) in enumerate(message_parts(batch.column(last).to_pylist(), names, profile, splitter)):
                at += [i] * max(1, len(parts))
                early += [reason] * max(1, len(parts))
                numbers += range(len(parts)) if parts else [None]
                texts += parts or [None]
            which = pa.array(at, pa.int64())
            cols = [pa.array(numbers, pa.int32()), pa.array(texts, pa.string()), pa.array(early, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(which) for k in range(last)), *cols], names=[*(f"k{i}" for i in range(len(keep))), "digest", "segment_no", "part", "early"])

    found = rows.mapInArrow(run, ", ".join([*kinds, "digest string, segment_no int, part string, early string"]))
    return found.select(
        *(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)),
        F.col("digest").alias("parent_digest"),
        F.when(F.col("part").isNotNull(), F.concat("digest", F.lit("#"), F.col("segment_no"))).alias("id"),
        "segment_no",
        F.col("part").alias("text"),
        F.coalesce("early", T.reject_reason("part", profile), F.lit("no_segments")).alias("reason"),
    )


def reason_counts(processed: DataFrame) -> DataFrame:
    """How often each reason occurs."""
    return processed.groupBy("reason").agg(F.count("*").alias("n"))


def ingest_counters(processed: DataFrame) -> DataFrame:
    """name and n: the reasons, and rows_total (messages), segments_generated and segments_kept of a run's messages.

    ``processed`` comes from :func:`process_messages`; a message has one row without, or a first one with, a segment number.
    """
    message = F.coalesce("segment_no", F.lit(0)) == 0
    totals = processed.agg(F.count_if(message).alias("rows_total"), F.count("segment_no").alias("segments_generated"), F.count_if(F.col("reason") == "pass").alias("segments_kept"))
    rows = totals.select(F.explode(F.create_map(*(x for c in totals.columns for x in (F.lit(c), F.col(c))))).alias("name", "n"))
    named = F.when(F.col("reason").startswith("reject_") | (F.col("reason") == "no_segments"), F.col("reason")).otherwise(F.concat(F.lit("segment_reject_"), "reason"))
    return rows.unionByName(reason_counts(processed.where("reason <> 'pass'")).select(named.alias("name"), "n"))
