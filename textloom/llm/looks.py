"""Characters that look alike, and texts brought to one consistent form.

The repair is script-aware. Within a token that mixes Latin and Cyrillic letters,
the dominant script is the one with more letters that have no look-alike in the
other script; look-alikes of the other script are replaced, provided the
token then stands in the vocabulary of the corpus. Tokens made only of
look-alikes follow the dominant script of their text, under the same condition.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .neardup import pairs_within

# Letters of the two scripts with the same shape, Latin then Cyrillic.
LATIN = "aceopxyijshəɵABCEHIJKMOPSTXYƏƟ"
CYRILLIC = "асеорхуіјѕһәөАВСЕНІЈКМОРЅТХҮӘӨ"
TO_CYRILLIC = str.maketrans(LATIN, CYRILLIC)
TO_LATIN = str.maketrans(CYRILLIC + "У", LATIN + "Y")

# Characters without any width or mark of their own.
INVISIBLE = "\u00ad\u034f\u061cᅟᅠ\u17b4\u17b5\u180e\u200b\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufeff"
#: Spaces of any width; line breaks are not among them.
SPACES = "\t\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"

_SIMPLE = {ord(c): None for c in INVISIBLE} | {ord(c): " " for c in SPACES} | {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
_SIMPLE[0x2026] = "..."
# Ligatures, which look like their letters.
_SIMPLE |= {0xFB00: "ff", 0xFB01: "fi", 0xFB02: "fl", 0xFB03: "ffi", 0xFB04: "ffl", 0xFB05: "st", 0xFB06: "st"}
# Joiners and variation selectors shape emoji; anywhere else they show nothing.
_EMOJI = "[←-⯿〰〽㊗㊙\ufe0f\u200d\U0001f000-\U0001faff]"
_JOINERS = re.compile(f"\u200c|(?<!{_EMOJI})\u200d|\u200d(?!{_EMOJI})|(?<![0-9#*])(?<!{_EMOJI})[\ufe00-\ufe0f]")
_ODD = re.compile("[^\n -~Ѐ-ԯ«»\U0001f300-\U0001faff]")
_TOKEN = re.compile(r"[^\W\d_]+")
_HAS_LATIN, _HAS_CYRILLIC = re.compile("[A-Za-zÀ-ɏƏəɵƟ]"), re.compile("[Ѐ-ԯ]")


def settle(text: str) -> str:
    """Wide forms, spaces, invisible characters and composed marks in their one form; letters stay as they are."""
    if not _ODD.search(text):
        return text
    return unicodedata.normalize("NFC", _JOINERS.sub("", text.translate(_SIMPLE)))


def own_letters(word: str) -> tuple[int, int]:
    """How many Latin and Cyrillic letters of ``word`` have no look-alike in the other script."""
    latin = sum(1 for c in word if _HAS_LATIN.match(c) and c not in LATIN)
    cyrillic = sum(1 for c in word if _HAS_CYRILLIC.match(c) and c not in CYRILLIC + "У")
    return latin, cyrillic


def text_script(text: str) -> str:
    """``latin`` or ``cyrillic``, by the letters of ``text`` that belong to one script alone; ties are Cyrillic."""
    latin, cyrillic = own_letters(text)
    return "latin" if latin > cyrillic else "cyrillic"


def candidates(word: str, around: str) -> list[str]:
    """Forms of ``word`` in a single script, best first; empty if it needs no repair or has none.

    ``around`` is the dominant script of the text, used where the word's own letters don't decide.
    """
    has_latin, has_cyrillic = bool(_HAS_LATIN.search(word)), bool(_HAS_CYRILLIC.search(word))
    latin, cyrillic = own_letters(word)
    if has_latin and has_cyrillic:
        order = ["latin", "cyrillic"] if latin > cyrillic or latin == cyrillic and around == "latin" else ["cyrillic", "latin"]
        forms = [word.translate(TO_LATIN if s == "latin" else TO_CYRILLIC) for s in order]
        return [f for f in forms if not (_HAS_LATIN.search(f) and _HAS_CYRILLIC.search(f))]
    if has_latin and not latin and around == "cyrillic":
        return [word.translate(TO_CYRILLIC)]
    if has_cyrillic and not cyrillic and around == "latin":
        return [word.translate(TO_LATIN)]
    return []


def doubtful(text: str) -> dict[str, list[str]]:
    """The words of a settled text that may need repair, each with its candidate forms."""
    if not (_HAS_LATIN.search(text) and _HAS_CYRILLIC.search(text)):
        return {}
    around = text_script(text)
    return {w: c for w in set(_TOKEN.findall(text)) if (c := candidates(w, around))}


def apply_repairs(text: str, repairs: dict[str, str]) -> str:
    """``text`` with every whole word that is a key of ``repairs`` replaced."""
    return _TOKEN.sub(lambda m: repairs.get(m[0], m[0]), text) if repairs else text


def _settle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key, settled text, the doubtful words with their candidates, as word, newline, candidates, and the two hashes of the text as it was."""
    for batch in batches:
        settled = [None if t is None else settle(t) for t in batch.column(1).to_pylist()]
        words = [None if t is None else ["\n".join([w, *c]) for w, c in sorted(doubtful(t).items())] for t in settled]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(settled, pa.string()), pa.array(words, pa.list_(pa.string())), batch.column(2), batch.column(3)], names=["key", "settled", "words", "r1", "r2"])


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct lower-cased words in one script of a partition's texts, those written so at least once."""
    seen: set[str] = set()
    for batch in batches:
        new = {w for t in batch.column(0).to_pylist() if t for w in map(str.lower, _TOKEN.findall(t)) if not (_HAS_LATIN.search(w) and _HAS_CYRILLIC.search(w))} - seen
        if len(seen) > 500_000:
            seen.clear()
        seen |= new
        yield pa.RecordBatch.from_arrays([pa.array(sorted(new), pa.string())], names=["word"])


def consistent_form(df: DataFrame, key: str, text: str, materialise) -> DataFrame:
    """``key``, ``form``, and ``r1``, ``r2`` (128 bits of hash of the text as it was): every text of ``df`` in one consistent form.

    A null text has a null form, an empty one an empty form. Repeated rows stay.
    ``key`` must be unique where a text needs repair (else the repairs of its rows
    are joined, which changes nothing, as they are of the same words). A word is
    repaired to its first candidate that stands in the corpus vocabulary: the
    words written in a single script somewhere in ``df``, and the candidates on
    which two different spellings agree. Case doesn't matter for the vocabulary.

    Vocabulary and repairs are tables joined by word, never collected: only the
    doubtful words are exploded, and the vocabulary is distinct before its shuffle.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("raw"), F.xxhash64(text).alias("r1"), F.xxhash64(F.lit("#"), text).alias("r2"))
    settled = materialise(rows.mapInArrow(_settle_rows, f"key {kind}, settled string, words array<string>, r1 bigint, r2 bigint"), "settled")
    asked = settled.where(F.size("words") > 0).select("key", F.explode("words").alias("ask"))
    words = (
        asked.select("ask").distinct().withColumn("parts", F.split("ask", "\n"))
        .select("ask", F.col("parts")[0].alias("word"), F.posexplode(F.slice("parts", 2, 9)).alias("rank", "candidate"))
        .withColumn("low", F.lower("candidate"))
    )
    known = settled.select("settled").mapInArrow(_vocabulary, "word string").distinct()
    agreed = words.groupBy("low").agg(F.count_distinct(F.lower("word")).alias("spellings")).where("spellings > 1").select(F.col("low").alias("word"))
    vocabulary = known.join(words.select(F.col("low").alias("word")).distinct(), "word", "left_semi").union(agreed).distinct()
    chosen = (
        words.join(vocabulary, words["low"] == vocabulary["word"], "left_semi")
        .groupBy("ask").agg(F.min_by(F.struct("word", "candidate"), "rank").alias("repair"))
    )
    repairs = asked.join(chosen, "ask").groupBy("key").agg(F.collect_set("repair").alias("repairs"))
    touched = settled.where(F.size("words") > 0).select("key", "settled", "r1", "r2").join(repairs, "key", "left")

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = [
                apply_repairs(t, {r["word"]: r["candidate"] for r in rs or []})
                for t, rs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(forms, pa.string()), batch.column(3), batch.column(4)], names=["key", "form", "r1", "r2"])

    fixed = touched.select("key", "settled", "repairs", "r1", "r2").mapInArrow(repair, f"key {kind}, form string, r1 bigint, r2 bigint")
    plain = settled.where(F.coalesce(F.size("words"), F.lit(-1)) <= 0).select("key", F.col("settled").alias("form"), "r1", "r2")
    return plain.unionByName(fixed)


def look_classes(df: DataFrame, key: str, text: str, materialise) -> DataFrame:
    """key, r1, r2 (hash of its text) and h1, h2 (hash of its form) of every row with a text, as a table."""
    forms = consistent_form(df, key, text, materialise).where("form IS NOT NULL")
    return materialise(forms.select("key", "r1", "r2", F.xxhash64("form").alias("h1"), F.xxhash64(F.lit("#"), "form").alias("h2")), "looks")


def same_look_pairs(df: DataFrame, key: str, text: str, materialise) -> DataFrame:
    """``key_a`` < ``key_b``: rows with different texts of one consistent form.

    Rows with a null text are in no pair; equal texts are no pair. Groups are
    found on a 128-bit hash of the form; only groups that hold two different raw
    texts are joined with themselves, large ones in blocks. The result has every pair,
    so it is as large as the copies make it; :func:`same_look_members` has one row per record.
    """
    rows = look_classes(df, key, text, materialise)
    mixed = rows.groupBy("h1", "h2").agg(F.min("r1").alias("lo"), F.max("r1").alias("hi"), F.min("r2").alias("lo2"), F.max("r2").alias("hi2")).where("lo <> hi OR lo2 <> hi2").select("h1", "h2")
    few = rows.join(mixed, ["h1", "h2"], "left_semi")
    return pairs_within(few, ["h1", "h2"], "key").where("a.r1 <> b.r1 OR a.r2 <> b.r2").select(F.col("a.key").alias("key_a"), F.col("b.key").alias("key_b"))


def same_look_members(df: DataFrame, key: str, text: str, materialise) -> DataFrame:
    """key, first (the least key of its look), n_rows and n_texts (different texts) of its look, and n_links (rows of the look with another text) of every row with a text."""
    rows = look_classes(df, key, text, materialise)
    texts = rows.groupBy("h1", "h2", "r1", "r2").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    looks = texts.groupBy("h1", "h2").agg(F.min("first").alias("first"), F.sum("n").alias("n_rows"), F.count("*").alias("n_texts"))
    linked = texts.select("h1", "h2", "r1", "r2", "n").join(looks, ["h1", "h2"])
    return rows.join(linked, ["h1", "h2", "r1", "r2"]).select("key", "first", "n_rows", "n_texts", (F.col("n_rows") - F.col("n")).alias("n_links"))
