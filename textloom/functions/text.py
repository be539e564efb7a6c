"""Scalar functions over text as Catalyst expressions.

White space and digits are those of Unicode throughout, spelled out as classes, so
that a pattern means the same in the JVM and in SQL engines without look-around.
Every function of a null is null.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.profile import DEFAULT, Profile

# Patterns of contacts, placeholders, words and white space.
SPACE = r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: White space as patterns have it; what is stripped from ends (above) has the four separators besides.
WHITE = SPACE.replace(r"\x{1c}-\x{20}", r"\x{20}")
LINE_BREAK = r"[\x{a}\x{b}\x{c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
URL = rf"(?:https?://|www\.)[^{WHITE}]+"
EMAIL = r"[\p{L}0-9._%+-]+@[\p{L}0-9.-]+\.[a-z]{2,}"
PHONE = rf"(?:\+?7|8)?[{WHITE}-]?(?:\(\p{{Nd}}{{3}}\)|\p{{Nd}}{{3}})[{WHITE}-]?\p{{Nd}}{{3}}[{WHITE}-]?\p{{Nd}}{{2}}[{WHITE}-]?\p{{Nd}}{{2}}"
#: What every phone number has: two pairs of digits with at most one mark between them.
PHONE_SIGN = rf"\p{{Nd}}{{2}}[{WHITE}-]?\p{{Nd}}{{2}}"
NAME_PLACEHOLDER = r"\[\[([^\[\]]+)\]\]"
SINGLE_BRACKET = r"(?:^|[^\[])\[[^\[\]]+\](?:$|[^\]])"
WORD = r"[\p{L}\p{Nd}]+(?:'[\p{L}\p{Nd}]+)?"
#: A link begins where no word character stands before it.
WORD_START = r"(^|[^\p{L}\p{Nd}_])"


_INNER = SPACE.replace(r"\x{9}-\x{d}", r"\x{9}\x{b}-\x{d}")
#: White space made regular, step by step: what is replaced by what. Blank lines stay.
REGULAR_SPACE = (
    (r"[\x{d}\x{200b}\x{feff}\x{2060}]", ""),
    (LINE_BREAK, "\n"),
    (r"\n\z", ""),
    (r"[ \x{9}\x{a0}]+", " "),
    (rf"\n[{_INNER}]+", "\n"),
    (rf"[{_INNER}]+\n", "\n"),
    (rf"\A[{_INNER}]+|[{_INNER}]+\z", ""),
)
ENDS = rf"\A[{SPACE}]+|[{SPACE}]+\z"


def python_pattern(pattern: str, ignore_case: bool = False) -> regex.Pattern:
    """A pattern of this module for the ``regex`` package."""
    spelled = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: re.escape(chr(int(m[1], 16))), pattern).replace(r"\z", r"\Z")
    return regex.compile(spelled, regex.I if ignore_case else 0)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(text: Column | str) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(_column(text), ENDS, "")


def first_filled(*values: Column | str) -> Column:
    """The first value that is neither null nor empty, else the empty string."""
    return F.coalesce(*(F.nullif(_column(v), F.lit("")) for v in values), F.lit(""))


def normalise_whitespace(text: Column | str) -> Column:
    """Lines stripped and joined by one newline each, inner blanks collapsed, zero-width characters and CR removed; blank lines stay."""
    t = _column(text)
    for pattern, by in REGULAR_SPACE:
        t = F.regexp_replace(t, pattern, by)
    return t


def let(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` of a value that is computed once, however often ``make`` uses it."""
    return F.transform(F.array(value), make)[0]


def has_contact_sign(text: Column | str) -> Column:
    """Whether a contact is possible at all: a cheap test that most texts fail."""
    t = _column(text)
    return t.contains("@") | t.contains("://") | t.rlike(r"(?i)www\.") | t.rlike(PHONE_SIGN)


def without_contacts(text: Column | str) -> Column:
    """Links, mail addresses and phone numbers replaced by a blank."""
    t = _column(text)
    return F.when(has_contact_sign(t), F.regexp_replace(t, rf"(?i){WORD_START}{URL}|{EMAIL}|{PHONE}", " ")).otherwise(t)


def is_contact_only(text: Column | str) -> Column:
    """True if nothing but contacts, punctuation, symbols and white space is there; so for an empty text."""
    return ~without_contacts(text).rlike(rf"[^\p{{P}}\p{{S}}{SPACE}]")


def count_links(text: Column | str) -> Column:
    t = _column(text)
    return F.when(t.contains("://") | t.rlike(r"(?i)www\."), F.regexp_count(t, F.lit(rf"(?i){WORD_START}{URL}"))).when(t.isNotNull(), 0)


def count_emails(text: Column | str) -> Column:
    t = _column(text)
    return F.when(t.contains("@"), F.regexp_count(t, F.lit(rf"(?i){EMAIL}"))).when(t.isNotNull(), 0)


def count_phones(text: Column | str) -> Column:
    t = _column(text)
    return F.when(t.rlike(PHONE_SIGN), F.regexp_count(t, F.lit(PHONE))).when(t.isNotNull(), 0)


def tokens(text: Column | str) -> Column:
    """The words of the lower-cased text: letters and digits, with one inner apostrophe."""
    return F.regexp_extract_all(F.lower(_column(text)), F.lit(WORD), F.lit(0))


def count_tokens(text: Column | str) -> Column:
    return F.regexp_count(F.lower(_column(text)), F.lit(WORD))


def count_letters(text: Column | str, letters: str) -> Column:
    """How many characters of the text are in a set of characters."""
    t = _column(text)
    return F.length(t) - F.length(F.translate(t, letters, ""))


def count_class(text: Column | str, letters: str) -> Column:
    """How many characters of the text are of a regular expression class."""
    return F.length(F.regexp_replace(_column(text), f"[^{letters}]+", ""))


def source_digest(source: Column | str) -> Column:
    return F.sha1(_column(source))


def row_hash(source: Column | str, raw: Column | str) -> Column:
    """SHA-1 of source id, newline and raw text."""
    return F.sha1(F.concat(_column(source), F.lit("\n"), _column(raw)))


def normal_form(text: Column | str) -> Column:
    """Stripped, lower-cased, runs of white space made one blank: equal forms are exact duplicates."""
    return F.regexp_replace(F.lower(strip(text)), rf"[{WHITE}]+", " ")


def safe_token(value: Column | str) -> Column:
    """Characters that aren't letters or digits made underscores, for file names."""
    return F.regexp_replace(_column(value), r"[^\p{L}\p{N}]", "_")


def sentences(text: Column | str) -> Column:
    """Split after . ! ? … before white space; blank parts are left out."""
    parts = F.split(_column(text), rf"(?<=[.!?…])[{WHITE}]+")
    return F.filter(F.transform(parts, strip), lambda p: p != "")


def reject_reason(text: Column | str, profile: Profile = DEFAULT) -> Column:
    """The first rule that a segment breaks, else ``pass``; null for a null text."""
    t = _column(text)
    words, chars, script = count_tokens(t), F.length(t), count_class(t, profile.script)
    rules = []
    if profile.one_script_only:
        rules += [("latin_present", t.rlike(profile.foreign_script)), ("non_cyrillic_letters", script != count_class(t, r"\p{L}"))]
    rules += [
        ("min_letters", script < profile.min_letters),
        ("min_tatar_letters", count_letters(t, profile.marker_letters) < profile.min_marker_letters),
        ("min_words", words < profile.min_words),
        ("max_words", words > profile.max_words),
        ("min_chars", chars < profile.min_chars),
        ("max_chars", chars > profile.max_chars),
        ("single_bracket_placeholder", t.rlike(SINGLE_BRACKET)),
    ]
    # A plain chain is compiled, and stops at the first rule that is broken.
    out = F.when(t.isNull(), F.lit(None).cast("string"))
    for name, broken in rules:
        out = out.when(broken, name)
    return out.otherwise("pass")
