"""Splitting oversized texts at natural boundaries by recursive bisection.

A text above the limit is cut at the strongest boundary near its midpoint, and
each half is cut again while it is longer than the limit minus the overlap. The
halves, in order, are the *cores*: joined they give the text back unchanged. Each
piece after the first begins with the end of the core before it, at most
``overlap`` code points and whole words where there are any.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 500
OVERLAP = 50
#: A boundary is looked for within this share of the length on either side of the midpoint.
REACH = 0.25

# Boundaries from strong to weak; a match ends where the right half begins.
_BOUNDARIES = [
    re.compile(r"\n[^\S\n]*\n\s*"),
    re.compile(r"[\n\r\u2028\u2029\x0b\x0c\x85]+[^\S\n]*"),
    re.compile(r"[.!?…。！？]+[)\]»\"'’”]*\s+"),
    re.compile(r"[;:—–][)\]»\"'’”]*\s+"),
    re.compile(r",\s+"),
    re.compile(r"\s+"),
]
_EXTEND = re.compile("[\u0300-\u036f\u0483-҉\u200c\u200d\ufe00-\ufe0f\U0001f3fb-\U0001f3ff\u20d0-\u20ff]")


def _inside_cluster(text: str, at: int) -> bool:
    """True if a cut at ``at`` would part a base character from its marks or an emoji sequence."""
    return bool(_EXTEND.match(text[at])) or text[at - 1] == "\u200d"


def cut_near_middle(text: str, start: int, end: int) -> int:
    """The place of the strongest boundary near the middle of ``text[start:end]``; ties go to the nearer, then the left."""
    middle, reach = (start + end) // 2, max(1, int((end - start) * REACH))
    low, high = max(start + 1, middle - reach), min(end - 1, middle + reach)
    for pattern in _BOUNDARIES:
        best = None
        for m in pattern.finditer(text, start, end):
            at = m.end()
            if low <= at <= high and (best is None or abs(at - middle) < abs(best - middle)):
                best = at
            if m.start() > high:
                break
        if best is not None:
            return best
    for away in range(reach):
        for at in (middle - away, middle + away):
            if low <= at <= high and not _inside_cluster(text, at):
                return at
    return middle


def cores(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """The spans of the cores of ``text``; one span if it isn't longer than ``limit``."""
    if len(text) <= limit:
        return [(0, len(text))]
    done, todo = [], [(0, len(text))]
    while todo:
        start, end = todo.pop()
        if end - start <= limit - overlap:
            done.append((start, end))
        else:
            at = cut_near_middle(text, start, end)
            todo += [(at, end), (start, at)]
    return done


def overlap_start(text: str, start: int, end: int, overlap: int = OVERLAP) -> int:
    """Where the repeated end of the core ``text[start:end]`` begins: at a word start if one is near enough."""
    low = max(start, end - overlap)
    if low == start:
        return low
    if text[low - 1].isspace():
        return low
    for at in range(low, end):
        if text[at].isspace():
            while at < end and text[at].isspace():
                at += 1
            if at < end:
                return at
            break
    while low < end and _inside_cluster(text, low):
        low += 1
    return low


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(begin, core begin, end) of each piece of ``text``; the piece is ``text[begin:end]``."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be at least 0 and below the limit")
    out, before = [], None
    for start, end in cores(text, limit, overlap):
        out.append((start if before is None or not overlap else overlap_start(text, *before, overlap), start, end))
        before = (start, end)
    return out


PIECE = "piece_no int, n_pieces int, core_start int, core_end int, overlap_len int, piece string"


def split_oversized(df: DataFrame, text: str, keep: list[str], limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """One row per piece of every text longer than ``limit`` code points.

    Columns: ``keep``, then piece_no (from 0), n_pieces, core_start, core_end,
    overlap_len and piece. A null, empty or short text gives no rows; repeated rows
    give repeated pieces. Only oversized rows reach Python: the length filter runs
    in the scan's own stage, and nothing is shuffled.
    """
    clash = {c.split()[0] for c in PIECE.split(", ")} & set(keep)
    if clash:
        raise ValueError(f"columns to keep have names of the result: {sorted(clash)}")
    source = df.where(F.length(text) > limit).select(*keep, F.col(text).alias("piece_text_in"))
    fields = [f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, made = [], []
            for i, text in enumerate(batch.column(len(keep)).to_pylist()):
                got = pieces(text, limit, overlap)
                for n, (begin, start, end) in enumerate(got):
                    rows.append(i)
                    made.append((n, len(got), start, end, start - begin, text[begin:end]))
            kept = [batch.column(k).take(pa.array(rows, pa.int64())) for k in range(len(keep))]
            kinds = [pa.int32()] * 5 + [pa.string()]
            cols = [pa.array([x[k] for x in made], kinds[k]) for k in range(6)]
            names = [*keep, *(c.split()[0] for c in PIECE.split(", "))]
            yield pa.RecordBatch.from_arrays([*kept, *cols], names=names)

    return source.mapInArrow(run, ", ".join([*fields, PIECE]))
