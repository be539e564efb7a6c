"""Encoding a corpus with a byte-level BPE by reuse of content-defined chunks.

A rolling hash over the last ``WINDOW`` characters decides where a text is cut,
so the same passage is cut in the same places in whatever document it stands.
Each distinct chunk is encoded once per worker and looked up afterwards.

Cutting at arbitrary characters changes the tokens around the cut. A *safe
boundary* is a place where the split pattern of the tokenizer always begins a new
piece, whatever stands around it: before a space that follows a letter,
digit or ASCII punctuation mark. (No piece but white space contains white space
after its first character, the pattern looks ahead only inside runs of white
space, and merges never cross a piece.) A chunk therefore keeps the ids between
its first and its last safe boundary; the join of two chunks is repaired by
encoding the characters from the last safe boundary of the left one to the first
of the right one. A chunk without a safe boundary is carried into the join whole,
up to the whole text if it has none. The result equals encoding the text at once.
"""

from __future__ import annotations

import base64
import importlib.util
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW = 4
#: One character in so many ends a chunk on average (a power of two).
MEAN_CHUNK = 64
#: Entries kept per worker and cache before the cache starts afresh; it bounds memory, not results.
CACHE_ENTRIES = 150_000
#: Batches are cut so that one holds about so many characters.
BATCH_CHARS = 4_000_000

_LEFT = re.compile(r"[0-9A-Za-zЀ-ԯ!-/:-@\[-`{-~]")
# Fixed value: the split pattern of the public byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer_dir() -> str:
    """The folder of the public vocabularies: the installed package, else /opt/tokenizers."""
    spec = importlib.util.find_spec("public_tokenizers")
    return os.path.dirname(spec.origin) if spec and spec.origin else "/opt/tokenizers"


def load_encoder(path: str):
    """A tiktoken encoding of a rank file, without special tokens."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def cut_points(texts: list[str]) -> list[np.ndarray]:
    """For each text the inner positions at which a chunk ends, from a rolling hash of its own characters."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    ends = np.cumsum([len(t) for t in texts])
    if not len(codes):
        return [np.empty(0, np.int64) for _ in texts]
    h = np.zeros(len(codes), np.uint64)
    power = np.uint64(1)
    for back in range(WINDOW):
        h[back:] += codes[: len(codes) - back] * power
        power = np.uint64(int(power) * 1_000_003 % 2**64)
    h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - int(MEAN_CHUNK).bit_length() + 1)
    cuts = np.flatnonzero(h == 0) + 1
    out, start = [], 0
    for end in ends:
        lo, hi = np.searchsorted(cuts, (start + WINDOW, end))
        out.append(cuts[lo:hi] - start)
        start = int(end)
    return out


class ChunkEncoder:
    """Encodes texts through a cache of chunks and one of repaired joins."""

    def __init__(self, encode, cache_entries: int = CACHE_ENTRIES):
        self.encode, self.limit = encode, cache_entries
        self.chunks: dict[str, tuple | None] = {}
        self.joins: dict[str, list[int]] = {}

    def _chunk(self, text: str):
        first = text.find(" ", 1)
        while first > 0 and not _LEFT.match(text[first - 1]):
            first = text.find(" ", first + 1)
        if first < 0:
            made = None
        else:
            last = text.rfind(" ", first)
            while not _LEFT.match(text[last - 1]):
                last = text.rfind(" ", first, last)
            made = (text[:first], self.encode(text[first:last]) if last > first else [], text[last:])
        if len(self.chunks) >= self.limit:
            self.chunks.clear()
        self.chunks[text] = made
        return made

    def _join(self, text: str) -> list[int]:
        made = self.encode(text)
        if len(self.joins) >= self.limit:
            self.joins.clear()
        if len(text) <= 4 * MEAN_CHUNK:
            self.joins[text] = made
        return made

    def text(self, text: str, cuts) -> list[int]:
        out: list[int] = []
        carry, start, chunks, joins = "", 0, self.chunks, self.joins
        for end in [*cuts, len(text)]:
            piece = text[start:end]
            start = end
            try:
                made = chunks[piece]
            except KeyError:
                made = self._chunk(piece)
            if made is None:
                carry += piece
                continue
            carry += made[0]
            if carry:
                got = joins.get(carry)
                out += self._join(carry) if got is None else got
            out += made[1]
            carry = made[2]
        if carry:
            got = joins.get(carry)
            out += self._join(carry) if got is None else got
        return out

    def texts(self, texts: list[str]) -> list[list[int]]:
        return [self.text(t, c.tolist()) for t, c in zip(texts, cut_points(texts))]



_ENCODERS: dict[str, ChunkEncoder] = {}


def worker_encoder(vocabulary: str) -> ChunkEncoder:
    """The encoder of this worker process, with its caches; tasks that follow in the same process go on with it."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = ChunkEncoder(load_encoder(vocabulary).encode_ordinary)
    return _ENCODERS[vocabulary]


def encode_corpus(df: DataFrame, key: str, text: str, vocabulary: str) -> DataFrame:
    """``key`` and ``ids`` (array of int) for every row of ``df``.

    ``vocabulary`` is the path of a rank file that every executor can read. A null
    and an empty text give an empty list; repeated rows give repeated rows. Text is
    always ordinary text: strings that look like special tokens are encoded as
    characters. No shuffle: the vocabulary and the caches live in the worker process from
    one task to the next, so a passage is encoded once per worker instead of being sent
    across the cluster.
    """
    source = df.select(df[key].alias("key"), df[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(vocabulary)
        for batch in batches:
            keys, texts = batch.column(0), [x or "" for x in batch.column(1).to_pylist()]
            start = 0
            while start < len(texts):
                end, chars = start, 0
                while end < len(texts) and (end == start or chars + len(texts[end]) <= BATCH_CHARS):
                    chars += len(texts[end])
                    end += 1
                lists = encoder.texts(texts[start:end])
                offsets = np.zeros(len(lists) + 1, np.int32)
                np.cumsum([len(x) for x in lists], out=offsets[1:])
                flat = np.fromiter((i for x in lists for i in x), np.int32, int(offsets[-1]))
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([keys.slice(start, end - start), ids], names=["key", "ids"])
                start = end

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)
