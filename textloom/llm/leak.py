"""Evaluation items found in a corpus by a generalised suffix automaton over words.

The automaton recognises every run of consecutive words of every item. A document
streams through it word by word; the length of the longest match that ends at
each word is tracked, and where it reaches the minimum, the items that contain
those words are reported, with the span they cover.

Words are compared after letter case, punctuation, white space, invisible
characters and look-alike letters are set aside.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .looks import INVISIBLE, TO_CYRILLIC

MIN_WORDS = 10
#: Code points of items in one automaton; more items make more passes over the corpus, not a larger broadcast.
SHARD_CHARS = 2_000_000
# What stands for the one word that leads on from a state if there is none, or if there are several.
NOWHERE, FORKED = -1, -2

_DROP = re.compile(f"[{INVISIBLE}\u200c\u200d\ufe00-\ufe0f\u0300-\u0305\u0307\u0309-\u036f]")
_WORD = re.compile(r"[^\W_]+")
# Lower-cased letters of one look, as small or as capital ones; both sides are folded.
_FOLD = TO_CYRILLIC | str.maketrans("kmtbhһүY", "кмтвнн" + "уу")


def words_of(text: str) -> list[str]:
    """The words of a text in the form in which they are compared."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _DROP.sub("", text))
    return _WORD.findall(text.lower().translate(_FOLD))


def word_spans(text: str) -> list[tuple[int, int]]:
    """Where each word of :func:`words_of` stands in ``text`` itself; character by character, for matched documents only."""
    spans: list[list[int]] = []
    open_word = False
    for at, char in enumerate(text):
        if _DROP.match(char) or unicodedata.combining(char):
            if open_word:
                spans[-1][1] = at + 1
            continue
        if _WORD.search(unicodedata.normalize("NFKC", char)):
            if open_word:
                spans[-1][1] = at + 1
            else:
                spans.append([at, at + 1])
            open_word = True
        else:
            open_word = False
    return [(a, b) for a, b in spans]


class ItemAutomaton:
    """A generalised suffix automaton of word sequences, with the items of every state that is long enough to be reported.

    States are in arrays. Most states have one way on, which stands in two of them; only
    states with several have a dictionary.
    """

    def __init__(self, items: list[tuple[int, list[str]]], min_words: int = MIN_WORDS):
        self.min_words = min_words
        self.ids: dict[str, int] = {}
        self.link, self.length = array("i"), array("i")
        self.code, self.to, self.fork = array("i"), array("i"), {}
        self._state(0)
        coded = [(item, array("i", [self.ids.setdefault(w, len(self.ids)) for w in words])) for item, words in items]
        for _, codes in coded:
            last = 0
            for code in codes:
                last = self._extend(last, code)
        # The word sequences of each item, for coverage.
        self.words: dict[int, list[array]] = {}
        for item, codes in coded:
            self.words.setdefault(item, []).append(codes)
        # An item belongs to the states of its prefixes and to all their suffix links.
        seen, states, owners = array("i", [-1]) * len(self.link), array("i"), array("q")
        for number, (item, codes) in enumerate(coded):
            state = 0
            for code in codes:
                up = state = self.following(state, code)
                while self.length[up] >= min_words and seen[up] != number:
                    seen[up] = number
                    states.append(up)
                    owners.append(item)
                    up = self.link[up]
        order = np.argsort(np.frombuffer(states, np.int32), kind="stable") if len(states) else np.zeros(0, np.int64)
        self.members = array("q", np.frombuffer(owners, np.int64)[order].tobytes()) if len(states) else owners
        counts = np.bincount(np.frombuffer(states, np.int32), minlength=len(self.link)) if len(states) else np.zeros(len(self.link), np.int64)
        self.first_member = array("i", np.append(0, np.cumsum(counts)).astype(np.int32).tobytes())

    def following(self, state: int, code: int) -> int:
        """The state after one more word, or -1."""
        return self.to[state] if self.code[state] == code else self.fork[state].get(code, -1) if self.code[state] == FORKED else -1

    def _lead(self, state: int, code: int, to: int) -> None:
        held = self.code[state]
        if held == FORKED:
            self.fork[state][code] = to
        elif held in (NOWHERE, code):
            self.code[state], self.to[state] = code, to
        else:
            self.fork[state] = {held: self.to[state], code: to}
            self.code[state] = FORKED

    def _state(self, length: int, like: int | None = None) -> int:
        new = len(self.link)
        self.length.append(length)
        self.link.append(-1 if like is None else self.link[like])
        self.code.append(NOWHERE if like is None else self.code[like])
        self.to.append(-1 if like is None else self.to[like])
        if like in self.fork:
            self.fork[new] = dict(self.fork[like])
        return new

    def _extend(self, last: int, word: int) -> int:
        known = self.following(last, word)
        if known >= 0:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, known, word)
        new, at = self._state(self.length[last] + 1), last
        while at >= 0 and (known := self.following(at, word)) < 0:
            self._lead(at, word, new)
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            self.link[new] = known if self.length[known] == self.length[at] + 1 else self._split(at, known, word)
        return new

    def _split(self, at: int, known: int, word: int) -> int:
        copy = self._state(self.length[at] + 1, known)
        self.link[known] = copy
        while at >= 0 and self.following(at, word) == known:
            self._lead(at, word, copy)
            at = self.link[at]
        return copy

    def runs(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(item, first word, word count) of every run of each item in a document that reaches min_words and that no word on either side prolongs."""
        out: list[tuple[int, int, int]] = []
        begun: dict[int, int] = {}  # item: first word of its run that ends at the word before
        state = length = 0
        codes, tos, fork, link, lengths, least = self.code, self.to, self.fork, self.link, self.length, self.min_words
        members, first_member = self.members, self.first_member
        for at, code in enumerate(map(self.ids.get, words)):
            if code is None:
                state = length = 0
            else:
                while True:
                    held = codes[state]
                    got = tos[state] if held == code else fork[state].get(code, -1) if held == FORKED else -1
                    if got >= 0:
                        state, length = got, length + 1
                        break
                    if not state:
                        length = 0
                        break
                    state = link[state]
                    length = lengths[state]
            if length < least and not begun:
                continue
            here: dict[int, int] = {}
            if length >= least:
                # Longer runs belong to the state itself, shorter ones to more items further up.
                up, run = state, length
                while run >= least:
                    for item in members[first_member[up] : first_member[up + 1]]:
                        here.setdefault(item, at - run + 1)
                    up = link[up]
                    run = lengths[up]
            if begun:
                out += [(item, first, at - first) for item, first in begun.items() if here.get(item) != first]
            begun = here
        out += [(item, first, len(words) - first) for item, first in begun.items()]
        return sorted(out)

    def matches(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(item, first word, word count) of the longest run of each item in a document that reaches min_words; ties go to the first."""
        return _longest(self.runs(words))

    def covered(self, item: int, passages: list[list[str]]) -> tuple[int, int]:
        """How many words of an item stand in the passages, wherever the item has them, and how many it has; of rows with one id the one covered most."""
        best = (0, 1)
        coded = [array("i", [self.ids[w] for w in p]) for p in passages]
        for words in self.words[item]:
            seen: set[int] = set()
            for passage in coded:
                for at in range(len(words) - len(passage) + 1):
                    if words[at] == passage[0] and words[at : at + len(passage)] == passage:
                        seen.update(range(at, at + len(passage)))
            if words and len(seen) * best[1] > best[0] * len(words):
                best = (len(seen), len(words))
        return best


def _longest(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    best: dict[int, tuple[int, int]] = {}
    for item, first, run in runs:
        if run > best.get(item, (0, 0))[1]:
            best[item] = (first, run)
    return [(item, first, run) for item, (first, run) in sorted(best.items())]


def _shards(items: Iterable[tuple[int, str]]) -> Iterator[list[tuple[int, list[str]]]]:
    """The items, in order of id, with their words, in lists of at most SHARD_CHARS code points (or one id)."""
    shard, chars = [], 0
    for item, text in items:
        if shard and chars + len(text) > SHARD_CHARS and shard[-1][0] != item:
            yield shard
            shard, chars = [], 0
        shard.append((item, words_of(text)))
        chars += len(text)
    if shard:
        yield shard


RESULT = "item_id bigint, first_word int, n_words int, item_words int, item_covered int, doc_words int, char_start int, char_end int"


def find_leaks(corpus: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, materialise, min_words: int = MIN_WORDS, longest: bool = False) -> DataFrame:
    """One row per document, item and run of at least ``min_words`` consecutive words that they share, each as long as it goes.

    Runs of one item may overlap, and the same passage counts wherever it stands.
    With ``longest`` there is one row per document and item, for its longest run.

    Columns: ``key``, item_id, first_word, n_words, item_words, item_covered (how many
    words of the item stand in any run of the document), doc_words, char_start,
    char_end (the span in the document's own text). Null and empty
    texts match nothing, on either side; an item without an id is left out; items shorter than ``min_words`` words
    cannot match; of items with one id each row counts by itself; repeated
    documents are reported each.

    Items stream through the driver in order of id, a shard of bounded size at a time;
    each shard makes one automaton and one pass over the corpus, without a shuffle.
    Where there are several shards, the rows of a pass are written before the next shard
    is read, so that one automaton is alive at a time, in the driver and in the workers.
    """
    source = corpus.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text IS NOT NULL")
    kind = source.schema["key"].dataType.simpleString()
    rows = items.where(F.col(item_key).isNotNull() & F.col(item_text).isNotNull()).select(item_key, item_text).orderBy(item_key, item_text)
    done, part = [], None
    for shard in _shards((r[0], r[1]) for r in rows.toLocalIterator()):
        if part is not None:
            done.append(materialise(part, "leaks"))
            automaton.destroy()
        automaton = corpus.sparkSession.sparkContext.broadcast(ItemAutomaton(shard, min_words))

        def run(batches: Iterator[pa.RecordBatch], automaton=automaton) -> Iterator[pa.RecordBatch]:
            auto = automaton.value
            for batch in batches:
                at, rows = [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    words = words_of(text)
                    if len(words) < auto.min_words:
                        continue
                    found = auto.runs(words)
                    if found:
                        passages: dict[int, list[list[str]]] = {}
                        for item, first, run in found:
                            passages.setdefault(item, []).append(words[first : first + run])
                        known = {item: auto.covered(item, p) for item, p in passages.items()}
                        spans = word_spans(text)
                        exact = len(spans) == len(words)
                        for item, first, run in _longest(found) if longest else found:
                            at.append(i)
                            covered, item_words = known[item]
                            rows.append((item, first, run, item_words, covered, len(words), spans[first][0] if exact else None, spans[first + run - 1][1] if exact else None))
                kinds = [pa.int64()] + [pa.int32()] * 7
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array([r[k] for r in rows], kinds[k]) for k in range(8))],
                    names=["key", *(c.split()[0] for c in RESULT.split(", "))],
                )

        part = source.mapInArrow(run, f"key {kind}, {RESULT}")
    if part is None:
        part = corpus.sparkSession.createDataFrame([], f"key {kind}, {RESULT}")
    return reduce(DataFrame.unionByName, done, part).withColumnRenamed("key", key)


def without_leaks(corpus: DataFrame, key: str, text: str, leaks: DataFrame, min_run: int = MIN_WORDS, max_coverage: float = 0.5) -> DataFrame:
    """``key``, ``text`` and ``leak_action`` of every document, with leaked spans taken out.

    ``leaks`` comes from :func:`find_leaks`, with every run. A run of at least ``min_run`` words is
    removed; where the removed runs cover more than ``max_coverage`` of a document's
    words, or a span isn't known, the text becomes null (``dropped``). Otherwise
    ``cut`` or ``kept``. Null texts stay null and ``kept``. ``key`` must be unique
    among documents with leaks; repeated keys share their spans.
    """
    spans = (
        leaks.where(F.col("n_words") >= min_run)
        .groupBy(key).agg(F.array_sort(F.collect_list(F.struct("first_word", "n_words", "char_start", "char_end"))).alias("spans"), F.max("doc_words").alias("doc_words"))
    )
    joined = corpus.select(key, F.col(text).alias("text")).join(spans, key, "left")
    kind = corpus.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, actions = [], []
            for text, spans, total in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                if text is None or not spans:
                    texts.append(text)
                    actions.append("kept")
                    continue
                covered = {w for s in spans for w in range(s["first_word"], s["first_word"] + s["n_words"])}
                if len(covered) > max_coverage * total or any(s["char_start"] is None for s in spans):
                    texts.append(None)
                    actions.append("dropped")
                    continue
                out, at = [], 0
                for s in sorted(spans, key=lambda s: s["char_start"]):
                    if s["char_start"] > at:
                        out.append(text[at : s["char_start"]])
                    at = max(at, s["char_end"])
                texts.append("".join([*out, text[at:]]))
                actions.append("cut")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(actions, pa.string())], names=["key", "text", "leak_action"])

    return joined.select(key, "text", "spans", "doc_words").mapInArrow(run, f"key {kind}, text string, leak_action string").withColumnRenamed("key", key)
