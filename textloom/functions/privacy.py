"""Contacts and name placeholders replaced by stable stand-ins.

A replacement depends on each match, which no built-in function can do, so it is
an Arrow function over whole batches; callers hand it only the texts that have
something to replace. A text is split at the matches of a pattern; the matches of all
texts of a batch are hashed and laid out together, and put between the pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import text as T

# What is replaced, in this order, how a stand-in is written, and its
# numbers, each as (divisor, modulus, offset) of the 32-bit hash of the match. A
# phone-like run inside a link becomes a number with blanks, at which the link then
# ends; a blank before a phone number belongs to its match.
STAND_INS = (
    (rf"({T.EMAIL})", "mail%05d@example.com", ((1, 100_000, 0),)),
    (rf"({T.PHONE})", "+7 %03d %03d-%02d-%02d", ((1, 90, 900), (100, 1_000, 0), (100, 100, 0), (1, 100, 0))),
    (rf"(\b{T.URL})", "https://%06d.com", ((1, 1_000_000, 0),)),
)
_STAND_INS = [(T.python_pattern(p, ignore_case=True), layout, numbers) for p, layout, numbers in STAND_INS]
_NAME = T.python_pattern(T.NAME_PLACEHOLDER)


def stable_hash(seed: str) -> int:
    """32 bits of XXH32 with seed 0."""
    return xxhash.xxh32_intdigest(seed)


def _filled(texts: list[str], pattern, make) -> list[str]:
    """The texts with every match of a pattern replaced by what ``make`` gives for the list of all matches (the pattern's one group)."""
    pieces = [pattern.split(t) for t in texts]
    made = iter(make([seed for p in pieces for seed in p[1::2]]))
    for p in pieces:
        for at in range(1, len(p), 2):
            p[at] = next(made)
    return ["".join(p) for p in pieces]


def hide_contacts(texts: list[str]) -> list[str]:
    """Mail addresses, then phone numbers, then links replaced; the whole match is the seed."""
    for pattern, layout, numbers in _STAND_INS:

        def made(seeds: list[str], layout=layout, numbers=numbers) -> list[str]:
            h = np.array([stable_hash(s) for s in seeds], np.int64)
            return [layout % row for row in zip(*((h // d % m + o).tolist() for d, m, o in numbers))]

        texts = _filled(texts, pattern, made)
    return texts


def fill_names(texts: list[str], names: list[str] | tuple[str, ...]) -> list[str]:
    """``[[name]]`` replaced by a name chosen by the hash of what is inside; removed if there are no names."""
    return _filled(texts, _NAME, lambda inner: [names[stable_hash(i.strip()) % len(names)] if names else "" for i in inner])


def anonymised(texts: list[str], names: list[str] | tuple[str, ...]) -> list[str]:
    return hide_contacts(fill_names(texts, names))


def anonymise(text: Column | str, names: list[str] | tuple[str, ...] = ()) -> Column:
    """Names filled in, contacts hidden. Texts with neither never leave the JVM; null stays null."""
    column = F.col(text) if isinstance(text, str) else text
    names = list(names)

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            there = part.notna()
            out = part.astype(object).where(there, None)
            out[there] = anonymised(part[there].tolist(), names)
            yield out

    touched = column.contains("[[") | T.has_contact_sign(column)
    return F.coalesce(run(F.when(touched, column)), column)
