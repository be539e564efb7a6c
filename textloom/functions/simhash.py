"""64-bit SimHash and Hamming distance.

A token's hash is the low half of its MD5; a bit of the result is set where more than
half of the tokens (each occurrence counts) have it set. A text without tokens has 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 64


#: Token occurrences whose bits are summed at once.
AT_ONCE = 200_000


def simhash_lists(lists: pa.ListArray) -> np.ndarray:
    """The SimHash of each list of tokens as a signed 64-bit number; 0 for an empty or null list."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    out = np.zeros(len(sizes), np.int64)
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return out
    # Each distinct token of the batch is hashed once.
    tokens = lists.flatten().dictionary_encode()
    low = b"".join(hashlib.md5(t.as_py().encode("utf-8", "surrogatepass")).digest()[8:] for t in tokens.dictionary)
    bits = np.unpackbits(np.frombuffer(low, np.uint8).reshape(-1, 8), axis=1)
    ids = tokens.indices.to_numpy()
    ends = np.cumsum(sizes[filled])
    at = 0
    while at < len(filled):
        first = ends[at] - sizes[filled[at]]
        to = max(at + 1, int(np.searchsorted(ends, first + AT_ONCE, side="right")))
        starts = ends[at:to] - sizes[filled[at:to]] - first
        ones = np.add.reduceat(bits[ids[first : ends[to - 1]]], starts, axis=0, dtype=np.int32)
        out[filled[at:to]] = np.packbits(ones * 2 > sizes[filled[at:to], None], axis=1).view(">i8").ravel().astype(np.int64)
        at = to
    return out


def simhash(tokens: Column | str) -> Column:
    """The SimHash of an array of tokens; null for null."""

    @F.arrow_udf("bigint")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array(simhash_lists(part))

    column = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.when(column.isNotNull(), run(column))


def hamming(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return F.bit_count(a.bitwiseXOR(b))


#: Blocks of bits that a key joins: values that differ in d bits agree in three of d + 3 blocks.
JOINED = 3


def bands(value: Column | str, distance: int) -> Column:
    """An array of (band, bits): values within ``distance`` agree in at least one band.

    The 64 bits are cut into distance + JOINED blocks, and a band is a choice of JOINED of
    them; so a key has about 38 bits at distance 2, few enough values share one even
    among very many, and no pair is lost.
    """
    value = F.col(value) if isinstance(value, str) else value
    blocks = distance + JOINED
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    bits = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(bits, JOINED)]
    return F.array(*(F.struct(F.lit(k).alias("band"), value.bitwiseAND(F.lit(m - (1 << BITS) if m >> (BITS - 1) else m).cast("bigint")).alias("bits")) for k, m in enumerate(masks)))
